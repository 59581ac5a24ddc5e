"""Column expressions on text and token arrays. All of them run in the JVM and keep one row per input row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that separate words.
# Latin ones are listed one by one and the others guarded by a range test, which makes the class as fast as \s.
WHITESPACE = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]+"
)


def split_on_space(text: Column) -> Column:
    """Tokens between single spaces; leading and doubled spaces give empty tokens, '' gives ['']."""
    return F.split(text, " ", -1)


def join_with_space(tokens: Column) -> Column:
    return F.concat_ws(" ", tokens)


def strip_quotes(text: Column) -> Column:
    return F.replace(text, F.lit('"'), F.lit(""))


def words(text: Column) -> Column:
    """Lower-cased words of a text, in order, without the empty strings at either end."""
    return F.filter(F.split(F.lower(text), WHITESPACE, -1), lambda w: w != "")


def padded_word(word: Column) -> Column:
    return F.concat(F.lit(" "), word, F.lit(" "))


def gram_lengths(padded: Column, lo: int, hi: int) -> Column:
    """Gram lengths that a padded word yields.

    Lengths stop at the word's own length, and a word shorter than `lo` still yields itself once.
    """
    return F.sequence(F.lit(lo), F.greatest(F.lit(lo), F.least(F.lit(hi), F.length(padded))))


def gram_starts(padded: Column, n: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) + 1 - n))


def _word_grams(padded: Column, lo: int, hi: int) -> Column:
    return F.flatten(
        F.transform(
            gram_lengths(padded, lo, hi),
            lambda n: F.transform(gram_starts(padded, n), lambda i: F.substring(padded, i, n)),
        )
    )


def check_range(lo: int, hi: int) -> None:
    if not 1 <= lo <= hi:
        raise ValueError(f"n-gram range {lo}..{hi} is empty")


def char_wb_ngrams(text: Column, lo: int, hi: int) -> Column:
    """Character n-grams inside word boundaries, as one array per row, with repeats."""
    check_range(lo, hi)
    return F.flatten(F.transform(F.transform(words(text), padded_word), lambda w: _word_grams(w, lo, hi)))


def distinct_char_wb_ngrams(text: Column, lo: int, hi: int) -> Column:
    """The different n-grams of a row. Repeated words are dropped before they are cut."""
    check_range(lo, hi)
    padded = F.transform(F.array_distinct(words(text)), padded_word)
    return F.array_distinct(F.flatten(F.transform(padded, lambda w: _word_grams(w, lo, hi))))


def char_wb_ngrams_sql(column: str, lo: int, hi: int) -> str:
    """`char_wb_ngrams` as SQL text, for `SQLTransformer`, whose statement is saved with the model."""
    check_range(lo, hi)
    return (
        "flatten(transform("
        f"transform(filter(split(lower({column}), r'{WHITESPACE}'), w -> w <> ''), w -> concat(' ', w, ' ')), "
        f"w -> flatten(transform(sequence({lo}, greatest({lo}, least({hi}, length(w)))), "
        "n -> transform(sequence(1, greatest(1, length(w) + 1 - n)), i -> substring(w, i, n))))))"
    )
