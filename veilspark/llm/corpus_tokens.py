"""Token ids of a whole collection under a public byte-level BPE tokenizer.

Texts up to ``chunk`` code points are encoded where they are read. Longer texts are
cut into overlapping chunks that are pre-tokenised in parallel; two neighbouring
chunks are stitched at the first place in their overlap where both have a pre-token
boundary between a non-space character and a space. From such a place on both go on
alike, since the pattern never looks back. The pieces between the stitches are encoded in
parallel and their ids put in order. A text with a seam where the chunks do not meet
(a run longer than the overlap) is encoded whole.

Defined results: null and empty texts give an empty list; strings that look like
special tokens are plain text; every row gives a row, repeated rows too; an empty
table gives an empty result; other columns are dropped.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilspark.session import cut, spread

CHUNK, OVERLAP = 4_096, 512
#: Boundaries this close to the end of a chunk that goes on may depend on what follows.
MARGIN = 16
#: Chunks are stitched before one of these: there a pre-token ends whatever version of Unicode the letters are of.
SAFE = " \n\t\r"
#: The vocabulary as ranks, and as a file of the ``tokenizers`` library; their ids are the same.
RANKS, VOCABULARY = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The encoder's pattern engine cannot take runs of white space far above this; such texts are pre-tokenised outside it.
LONG_RUN = 10_000


def vocabulary_path(name: str = VOCABULARY, folder: str | None = None) -> str:
    """Place of a vocabulary file: ``folder`` is a parameter, by default the installed files."""
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The vocabulary in the ``tokenizers`` library, which tests compare with."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file, each the bytes it stands for."""
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoding(path: str):
    """The encoder of a worker, made once per process."""
    import tiktoken

    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=1)
def pre_tokens():
    import regex

    return regex.compile(PATTERN)


def ids_of(path: str, text: str) -> list[int]:
    """The ids of one text, without special tokens."""
    e = encoding(path)
    if len(text) > LONG_RUN and re.search(rf"\s{{{LONG_RUN}}}", text):
        return [i for m in pre_tokens().finditer(text) for i in e._encode_single_piece(m.group())]
    return e.encode_ordinary(text)


def _lists(rows: list, kind: pa.DataType) -> pa.Array:
    return pa.array(rows, type=pa.list_(kind))


def _slices(batch: pa.RecordBatch, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes each, so no step holds much more than one text."""
    if batch.nbytes <= most or batch.num_rows <= 1:
        yield batch
        return
    half = batch.num_rows // 2
    yield from _slices(batch.slice(0, half), most)
    yield from _slices(batch.slice(half), most)


def encoder(path: str, keep: int):
    """A ``mapInArrow`` function: the first ``keep`` columns, and the ids of the column after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for whole in batches:
            for b in _slices(whole):
                ids = [ids_of(path, x) if x else [] for x in b.column(keep).to_pylist()]
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(offsets[-1]))
                yield pa.RecordBatch.from_arrays([*b.columns[:keep], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[*b.schema.names[:keep], "ids"])

    return run


def boundaries(chunk: int, overlap: int):
    """Pre-token boundaries of each chunk in the overlaps at its two ends, as places in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = pre_tokens().finditer
        for b in batches:
            heads, tails = [], []
            for k, last, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                stop = len(text) if last else len(text) - MARGIN
                cuts = [a for m in find(text) if 0 < (a := m.start()) < stop and (a < overlap or a >= chunk) and text[a] in SAFE and not text[a - 1].isspace()]
                base = k * chunk
                heads.append([base + a for a in cuts if a < overlap] if k else [])
                tails.append([base + a for a in cuts if a >= chunk])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(heads, pa.int64()), _lists(tails, pa.int64())], names=["key", "k", "head", "tail"])

    return run


def pieces(whole: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(key, k, text)``: the parts between the stitches of each (key, text); ids of the parts in order are ids of the text."""
    parts = F.ceil(F.length("text") / F.lit(chunk)).cast("int")
    chunks = whole.select("key", F.explode(F.sequence(F.lit(0), parts - 1)).alias("k"), parts.alias("parts"), "text").select(
        "key", "k", (F.col("k") == F.col("parts") - 1).alias("is_last"), F.substring(F.col("text"), F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("text")
    )
    width = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = whole.schema["key"].dataType.simpleString()
    seams = chunks.repartition(width, "key", "k").mapInArrow(boundaries(chunk, overlap), f"key {kind}, k int, head array<bigint>, tail array<bigint>")
    met = F.array_min(F.array_intersect("head", F.lag("tail").over(Window.partitionBy("key").orderBy("k"))))
    # one number per chunk of a document; a seam that does not meet leaves the document in one piece
    cuts = (
        seams.select("key", "k", met.alias("at"))
        .filter("k > 0")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list("at")).alias("ats"), F.count("*").alias("seams"))
        .select("key", F.when(F.size("ats") == F.col("seams"), F.col("ats")).otherwise(F.array().cast("array<bigint>")).alias("ats"))
    )
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.coalesce("ats", F.array().cast("array<bigint>")))
    placed = whole.join(cuts, "key", "left").select("key", "text", starts.alias("starts"))
    end = lambda s, i: F.coalesce(F.get(s, i + 1), F.length("text").cast("bigint"))
    return placed.select("key", "text", "starts", F.posexplode("starts").alias("k", "start")).select(
        "key", "k", F.substring(F.col("text"), (F.col("start") + 1).cast("int"), (end(F.col("starts"), F.col("k")) - F.col("start")).cast("int")).alias("text")
    )


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(id_col, ids)`` for every row of ``df``."""
    path = path or vocabulary_path(RANKS)
    if overlap <= MARGIN or overlap > chunk:
        raise ValueError("the overlap must exceed the margin and not the chunk")
    spark = df.sparkSession
    rows = spread(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id")
    kind = rows.schema["id"].dataType.simpleString()
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    short = rows.filter(~is_long).mapInArrow(encoder(path, 1), f"id {kind}, ids array<int>")
    # written once with a number for each row, so that only numbers are keys of what follows
    whole = cut(rows.filter(is_long).withColumn("key", F.monotonically_increasing_id()))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded = pieces(whole, chunk, overlap).repartition(width, "key", "k").mapInArrow(encoder(path, 2), "key bigint, k int, ids array<int>")
    joined = coded.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))
    long = whole.select("key", "id").join(joined, "key").select("id", "ids")
    return short.unionByName(long).select(F.col("id").alias(id_col), "ids")


def decoder(path: str):
    """A ``mapInArrow`` function: id and the text of a list of ids, by joining the tokens' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {i: t for t, i in ranks(path).items()}
        for b in batches:
            texts = [b"".join(map(token.__getitem__, x or [])).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return run


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``(id_col, text)``: the inverse of :func:`encode` (null comes back as empty)."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(decoder(path or vocabulary_path(RANKS)), f"id {kind}, text string").select(F.col("id").alias(id_col), "text")
