import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gramline.functions import words as w
from gramline.functions.stem import stem
from gramline.operators import text

# Pairs published with the stemming algorithm.
STEMS = """consign consign, consigned consign, consigning consign, consignment consign, consistency consist,
consistently consist, consolation consol, consolatory consolatori, consolidate consolid, consolingly consol,
conspicuously conspicu, conspiracy conspiraci, conspirators conspir, constable constabl, constancy constanc,
knack knack, knackeries knackeri, knavish knavish, kneaded knead, kneeling kneel, knightly knight, knitted knit,
knives knive, knocker knocker, knots knot, generously generous, communism communism, hopping hop, hoping hope,
tied tie, cries cri, by by, say say, cry cri, early earli, skies sky, innings inning, proceeded proceed,
relational relat, conditional condit, rational ration, luxuriated luxuri, falling fall, happy happi, enjoy enjoy"""


@pytest.mark.parametrize("pair", STEMS.replace("\n", " ").split(", "))
def test_stem(pair):
    word, expected = pair.split()
    assert stem(word) == expected


def test_stem_tokens_keeps_shape(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, ["Running", None, "", "the,", "dogs'"])], "id int, t array<string>")
    got = [r["s"] for r in text.stem_tokens(rows, "t", "s").orderBy("id").collect()]
    assert got == [None, [], ["run", None, "", "the,", "dog"]]


def _grams(text: str, lo: int, hi: int) -> list[str]:
    """Brute force: slide windows of every length over every padded word."""
    out = []
    for word in text.lower().split():
        padded = f" {word} "
        for n in range(lo, hi + 1):
            if n >= len(padded):
                out.append(padded)
                break
            out += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return out


TEXTS = st.text(alphabet="aBcé \n\t  ß😀", max_size=20)


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=8), st.integers(1, 4), st.integers(0, 4))
def test_char_wb_ngrams(spark, texts, lo, more):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    made = rows.select(
        "id",
        w.char_wb_ngrams(F.col("t"), lo, lo + more).alias("a"),
        F.expr(w.char_wb_ngrams_sql("t", lo, lo + more)).alias("b"),
    )
    for row in made.collect():
        assert row["a"] == row["b"] == _grams(texts[row["id"]], lo, lo + more)


def test_one_letter_word_is_one_gram(spark):
    row = spark.range(1).select(w.char_wb_ngrams(F.lit("a"), 4, 7).alias("g")).first()
    assert row["g"] == [" a "]


def test_cleaning(spark):
    rows = spark.createDataFrame(
        [("The  dogs, \"running\" the", "x"), ("the and", "x"), ("", "x"), (None, "x"), ("gone", None)],
        "tweet string, target string",
    )
    got = [r["tweet"] for r in text.prepare_text(rows).collect()]
    assert got == [" dogs, running", "", ""]


def test_tokens_between_spaces(spark):
    rows = spark.createDataFrame([(" a  b ",), ("",)], "t string")
    assert [r["k"] for r in text.tokenize_space(rows, "t", "k").collect()] == [["", "a", "", "b", ""], [""]]


def test_unknown_language(spark):
    with pytest.raises(ValueError):
        text.stem_tokens(spark.range(1), "id", "s", "klingon")
