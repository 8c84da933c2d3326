"""Fill fixed-capacity containers with documents that lie near each other.

A document's token ids are hashed into a count vector, projected to six dimensions
by a fixed random matrix and placed on a Hilbert curve. The documents are range-
sorted by their place on the curve and each range is packed along it: block after
block of some hundred neighbours, largest first into the fullest container that still
has room; containers that stay loose are opened again for the next block. Only a document larger than the
capacity is split, into full containers and a rest.

Defined results: null and empty documents have size 0 and go into a container like
any other; repeated rows are packed each; equal documents lie side by side and are
spread over ranges by a hash of their id, so no range grows with a group of copies;
sizes without a capacity of at least 1 are ignored; an empty table gives no rows.
"""
from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.session import cut

DIMENSIONS, BITS, BUCKETS = 6, 5, 256
#: Neighbours on the curve that are packed together, whatever the size of the table; below so many tokens of
#: capacity in proportion more, since few documents share a container and fitting ones are rarer.
BLOCK, ROOMY = 320, 2560
#: A container at least this full is closed at the end of a block.
TIGHT = 0.985


def hilbert(points, bits: int):
    """Place on the Hilbert curve of integer points (n x dimensions), by the transpose method."""
    import numpy as np

    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow``: id, number of tokens and place on the curve of lists of token ids."""
    import numpy as np

    matrix = np.random.default_rng(20_24).standard_normal((BUCKETS, DIMENSIONS))
    for b in batches:
        lists = b.column(1)
        sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
        flat = np.asarray(lists.flatten())
        row = np.repeat(np.arange(len(sizes)), sizes)
        # multiplicative hash of a token id to a bucket
        bucket = ((flat.astype(np.uint64) * np.uint64(2654435761)) >> np.uint64(7)) % np.uint64(BUCKETS)
        counts = np.log1p(np.bincount(row * BUCKETS + bucket.astype(np.int64), minlength=len(sizes) * BUCKETS).reshape(-1, BUCKETS))
        norm = np.linalg.norm(counts, axis=1, keepdims=True)
        spot = (counts / np.where(norm > 0, norm, 1)) @ matrix
        grid = np.clip(((np.tanh(spot * 0.8) + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(hilbert(grid, BITS))], names=["id", "size", "place"])


def fill(items: list[tuple], capacity: int) -> list[tuple[int, list]]:
    """Best fit, largest first: containers as (room left, items)."""
    rooms: list[tuple[int, int]] = []
    held: list[list] = []
    for item in sorted(items, key=lambda x: -x[3]):
        s = item[3]
        i = bisect_left(rooms, (s, -1))
        if i < len(rooms):
            room, c = rooms.pop(i)
            held[c].append(item)
        else:
            room, c = capacity, len(held)
            held.append([item])
        insort(rooms, (room - s, c))
    return [(room, held[c]) for room, c in rooms]


def packer(block: int, tight: float):
    """A ``mapInPandas`` function over rows sorted along the curve."""

    fewest = block

    def run(frames):
        import pandas as pd
        from pyspark import TaskContext

        block = fewest

        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        made = 0
        name, capacity, waiting = None, 0, []

        def rows(closed) -> pd.DataFrame:
            nonlocal made
            out = []
            for _, items in closed:
                out += [(name, part + made, *x) for x in items]
                made += 1
            return pd.DataFrame(out, columns=["size_name", "container_id", "id", "piece", "start_token", "n_tokens"])

        def close(final: bool):
            nonlocal waiting
            bins = fill(waiting, capacity)
            if final:
                waiting = []
                return bins
            bins.sort(key=lambda x: x[0])
            done, loose, held = [], [], 0
            for room, items in bins:
                if room <= (1 - tight) * capacity or held + len(items) > block // 2:
                    done.append((room, items))
                else:
                    held += len(items)
                    loose += items
            waiting = loose
            return done

        done: list = []  # closed containers, handed on some thousands at a time
        for f in frames:
            for n, cap, ident, size in zip(f["size_name"], f["capacity"], f["id"], f["size"]):
                if n != name:
                    if waiting or done:
                        yield rows(done + close(True))
                        done = []
                    name, capacity, block = n, cap, max(fewest, fewest * ROOMY // cap)
                start = piece = 0
                while size - start > capacity:  # only a document above the capacity is split
                    done.append((0, [(ident, piece, start, capacity)]))
                    start, piece = start + capacity, piece + 1
                waiting.append((ident, piece, start, size - start))
                if len(waiting) >= block:
                    done += close(False)
                if len(done) >= block:
                    yield rows(done)
                    done = []
        if waiting or done:
            yield rows(done + close(True))

    return run


def sizes(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, size, place)`` of encoded documents, written once."""
    kind = encoded.schema[id_col].dataType.simpleString()
    return cut(encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(curve_places, f"id {kind}, size bigint, place bigint"))


def pack(sized: DataFrame, capacities: Sequence[tuple[str, int]], id_col: str = "doc_id", block: int = BLOCK, tight: float = TIGHT) -> DataFrame:
    """``(size_name, container_id, id_col, piece, start_token, n_tokens)`` for every capacity."""
    known = [(str(n), int(c)) for n, c in capacities if n is not None and c is not None and c >= 1]
    kind = sized.schema["id"].dataType.simpleString()
    out = f"size_name string, container_id bigint, id {kind}, piece int, start_token bigint, n_tokens bigint"
    if not known:
        return sized.sparkSession.createDataFrame([], out).withColumnRenamed("id", id_col)
    caps = F.array(*[F.struct(F.lit(n).alias("size_name"), F.lit(c).cast("bigint").alias("capacity")) for n, c in known])
    rows = sized.select(F.explode(caps).alias("c"), "id", "size", "place").select("c.*", "id", "size", "place", F.xxhash64("id").alias("spread"))
    ordered = rows.repartitionByRange("size_name", "place", "spread").sortWithinPartitions("size_name", "place", "spread")
    return ordered.select("size_name", "capacity", "id", "size").mapInPandas(packer(block, tight), out).withColumnRenamed("id", id_col)
