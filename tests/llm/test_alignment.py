"""Token alignment against a plain version with the tokenizers' own libraries."""

import hashlib
from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gramline.llm import alignment


@pytest.fixture(scope="module")
def sides():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.TOKENIZER_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.TOKENIZER_B)


def _bytes_a(tokens):
    alphabet = alignment._byte_of_character()
    return [bytes(alphabet[c] for c in t) for t in tokens]


def _bytes_b(pieces):
    return [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in pieces]


def _ends(parts):
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def _groups(text, sides):
    """[(a ids, b ids)] of one text."""
    if not text:
        return []
    a = sides[0].encode(" " + text, add_special_tokens=False)
    a_ids = a.ids
    ids_b = sides[1].encode(text)
    parts_a, parts_b = _bytes_a(a.tokens), _bytes_b([sides[1].id_to_piece(i) for i in ids_b])
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return []
    ends_a, ends_b = _ends(parts_a), _ends(parts_b)
    out, low_a, low_b = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        high_a, high_b = bisect_right(ends_a, end), bisect_right(ends_b, end)
        out.append((a_ids[low_a:high_a], ids_b[low_b:high_b]))
        low_a, low_b = high_a, high_b
    return out


def _expected(texts, sides):
    groups = [_groups(t, sides) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    held = Counter(pair for own in links for pair in own)
    top: dict = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    for g, own in zip(groups, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        yield (
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()),
            sum(n for p, n in own.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        )


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _got(df):
    return sorted(((r["doc_id"], *(r[c] for c in NUMBERS)) for r in df.collect()), key=str)


ODD = [
    (1, "The cat sat on the mat."), (2, "The cat sat on the mat."), (2, "naïve Ünïcode 漢字 ✓ 🙂🙂"), (3, None), (4, ""), (None, "x"),
    (5, "▁ is not a space"), (6, "two  spaces\n\tand <s> <0x0A> <|endoftext|>\r\n"), (7, " leading"), (8, " "), (9, "\x00\x01"),
    (10, "word " * 30000), (11, "a" * 5000), (12, "🙂é" * 3000),
]


def test_odd_texts(spark, sides):
    df = spark.createDataFrame(ODD, "doc_id bigint, text string").repartition(3)
    df = df.withColumns({c: F.lit("own") for c in ("ref", "a", "b", "n", "best", "times", "n_a", "pair")})
    expected = sorted(((i, *n) for (i, _), n in zip(ODD, _expected([t for _, t in ODD], sides), strict=True)), key=str)
    assert _got(alignment.link_statistics(df)) == expected


def test_large_groups_and_joined_counts(spark, sides, monkeypatch):
    monkeypatch.setattr(alignment, "SMALL_GROUP", 1)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 200)
    real = alignment.lookup_join
    monkeypatch.setattr(alignment, "lookup_join", lambda *a, **k: real(*a, **k, limit=0))
    df = spark.createDataFrame(ODD[:10], "doc_id bigint, text string").coalesce(1)
    expected = sorted(((i, *n) for (i, _), n in zip(ODD, _expected([t for _, t in ODD[:10]], sides))), key=str)
    assert _got(alignment.link_statistics(df)) == expected


def test_given_documents(spark, sides):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    expected = sorted(((r["doc_id"], *n) for r, n in zip(rows, _expected([r["text"] for r in rows], sides), strict=True)), key=str)
    assert _got(alignment.link_statistics(docs)) == expected


def test_alignments(spark, sides):
    df = spark.createDataFrame([(1, "Hello wonderful wörld"), (2, None), (3, "ab")], "doc_id bigint, text string")
    for row in alignment.alignments(df).collect():
        groups, at = [], [0, 0]
        for n_a, n_b in zip(row["a_size"], row["b_size"], strict=True):
            groups.append((row["a"][at[0] : at[0] + n_a], row["b"][at[1] : at[1] + n_b]))
            at = [at[0] + n_a, at[1] + n_b]
        text = {1: "Hello wonderful wörld", 2: None, 3: "ab"}[row["doc_id"]]
        assert groups == _groups(text, sides)
        assert not groups or row["end"][-1] == len((" " + text).encode())


def test_empty_table(spark):
    assert alignment.link_statistics(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
