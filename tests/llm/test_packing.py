"""Containers: nothing lost, nothing over the brim, nothing split that need not be."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilspark.llm import packing as pk


def sized(spark, sizes):
    return spark.createDataFrame([(i, int(s), i * 7919 % 1000) for i, s in enumerate(sizes)], "id long, size long, place long")


RNG = random.Random(5)
CASES = {
    "mixed": [RNG.randrange(0, 900) for _ in range(3000)],
    "copies": [130] * 2000,
    "large": [5000, 0, 512, 513, 1024, 1, 511, 512 * 3],
    "zeros": [0] * 20,
    "one": [3],
    "none": [],
}


@pytest.mark.parametrize("name", CASES)
def test_packing_is_sound(spark, name):
    sizes, capacity = CASES[name], 512
    out = pk.pack(sized(spark, sizes), [("s", capacity), ("l", 2048), ("bad", 0), ("none", None)], block=256).collect()
    for size_name, cap in (("s", 512), ("l", 2048)):
        rows = [r for r in out if r.size_name == size_name]
        load: dict = {}
        pieces: dict = {}
        for r in rows:
            load[r.container_id] = load.get(r.container_id, 0) + r.n_tokens
            pieces.setdefault(r.doc_id, []).append((r.start_token, r.n_tokens))
        assert all(v <= cap for v in load.values())
        assert set(pieces) == set(range(len(sizes)))
        for i, ps in pieces.items():
            assert sum(n for _, n in ps) == sizes[i] and (len(ps) == 1 or sizes[i] > cap)
            assert sorted(s for s, _ in ps) == [j * cap for j in range(len(ps))]
        if name == "mixed":
            assert sum(load.values()) / (len(load) * cap) > 0.95
    assert {r.size_name for r in out} <= {"s", "l"}


def test_hilbert_visits_neighbours():
    n = 8
    grid = np.array([[x, y] for x in range(n) for y in range(n)])
    keys = pk.hilbert(grid, 3)
    assert sorted(keys) == list(range(n * n))
    path = grid[np.argsort(keys)]
    assert all(abs(a - b).sum() == 1 for a, b in zip(path, path[1:]))


def test_alike_documents_lie_together(spark):
    rng = random.Random(1)
    words = {g: [rng.randrange(50_000) for _ in range(120)] for g in range(6)}
    docs = [(i, [rng.choice(words[i % 6]) for _ in range(120)]) for i in range(240)]
    s = pk.sizes(spark.createDataFrame([*docs, (240, []), (241, None)], "doc_id long, ids array<int>"))
    assert {r.id: r["size"] for r in s.collect()} == {i: 120 if i < 240 else 0 for i in range(242)}

    def groups(sized):
        packed = pk.pack(sized, [("c", 1200)]).filter(F.col("n_tokens") > 0).select("container_id", (F.col("doc_id") % 6).alias("g"))
        return packed.groupBy("container_id").agg(F.count_distinct("g").alias("groups")).agg(F.avg("groups")).first()[0]

    # ten documents each, of six groups; without the curve about five groups meet in a container
    assert groups(s) < groups(s.withColumn("place", F.xxhash64("id"))) - 0.8


def test_repeats_keep_their_rows(spark):
    df = spark.createDataFrame([(1, 10, 0), (1, 10, 0), (2, 600, 0)], "id long, size long, place long")
    out = pk.pack(df, [("s", 512)]).collect()
    assert sorted((r.doc_id, r.piece, r.n_tokens) for r in out) == [(1, 0, 10), (1, 0, 10), (2, 0, 512), (2, 1, 88)]
