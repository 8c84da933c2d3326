"""Ids against encoding each text in one piece."""
import random

import pytest

from veilspark.llm import corpus_tokens as ct

T = ct.tokenizer(ct.vocabulary_path())


def whole(text):
    return T.encode(text or "", add_special_tokens=False).ids


def texts():
    rng = random.Random(2)
    out = [None, "", " ", "a", "<|endoftext|>", "it's we'll  I'd\n\n  x", "éÅ🙂 हिन्दी में", "z" * 5000, " " * 3000, "\n" * 500 + "x", "१२३ 456", "á" * 300]
    for _ in range(40):
        out.append("".join(rng.choice(["word", " ", "  ", "\n", "'s", "'", "9", "-", "é", "ह", ".", "\t"]) for _ in range(rng.randrange(800))))
    return out


@pytest.mark.parametrize("chunk,overlap", [(65_536, 2_048), (200, 60), (64, 40)])
def test_chunks_do_not_show(spark, chunk, overlap):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([*rows, rows[7], rows[15]], "doc_id long, text string")
    got = [(r.doc_id, list(r.ids)) for r in ct.encode(df, chunk=chunk, overlap=overlap).collect()]
    assert len(got) == len(rows) + 2
    for i, ids in got:
        assert ids == whole(rows[i][1]), (rows[i][1] or "")[:60]


def test_decoding_is_the_inverse(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    back = {r.doc_id: r.text for r in ct.decode(ct.encode(df, chunk=200, overlap=60)).collect()}
    assert back == {i: t or "" for i, t in rows}


def test_empty_table_ids_of_other_types_and_extra_columns(spark):
    df = spark.createDataFrame([("k", "a b", 1), (None, None, 2)], "id string, text string, ids int")
    got = {r.id: list(r.ids) for r in ct.encode(df, "id").collect()}
    assert got == {"k": whole("a b"), None: []}
    assert ct.encode(df.limit(0), "id").count() == 0
    with pytest.raises(ValueError):
        ct.encode(df, "id", chunk=10, overlap=20)


def test_long_texts_are_chunked_by_default(spark):
    rng = random.Random(5)
    rows = [(str(i), "".join(rng.choice(["word ", "and ", "it's ", "9", "é", ".\n", "ह "]) for _ in range(8000))) for i in range(3)] + [("run", "z" * 20_000)]
    got = ct.pieces(spark.createDataFrame(rows, "key string, text string")).collect()
    for key, text in rows:
        parts = [r.text for r in sorted((r for r in got if r.key == key), key=lambda r: r.k)]
        assert "".join(parts) == text
        assert len(parts) == (1 if key == "run" else -(-len(text) // ct.CHUNK)) and (key == "run" or len(parts) > 3)
    ids = {r.key: list(r.ids) for r in ct.encode(spark.createDataFrame(rows, "key string, text string"), "key").collect()}
    assert ids == {key: whole(text) for key, text in rows}


def test_pattern_ends_where_the_tokenizer_does():
    """Every character of the basic plane: the places where chunks may be stitched, and the ids."""
    text = "".join(f"a{chr(i)}b {chr(i)}{chr(i)} 1" for i in range(1, 0xFFFF) if not 0xD800 <= i < 0xE000)
    at = {m.start() for m in ct.pre_tokens().finditer(text)}
    want = {a for _, (a, _) in T.pre_tokenizer.pre_tokenize_str(text)}
    safe = {i for i in range(1, len(text)) if text[i] in ct.SAFE and not text[i - 1].isspace()}
    assert safe <= at and safe <= want
    assert ct.ids_of(ct.vocabulary_path(ct.RANKS), text) == whole(text)
