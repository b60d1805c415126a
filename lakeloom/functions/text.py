"""Text expressions: cleaning, counting, weighting and tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.common import as_column, let

# Unicode white space plus the four separator controls.
SPACE = r"[\s\x1c-\x1f]"
SPACE_CHARACTERS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                     0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def strip(c: Column | str) -> Column:
    """Drop white space of any kind at both ends."""
    return F.btrim(as_column(c), F.lit(SPACE_CHARACTERS))


def collapse(c: Column | str) -> Column:
    """Turn each run of white space into one blank and strip the ends."""
    return F.trim(F.regexp_replace(as_column(c), rf"(?U){SPACE}+", " "))


def clean(c: Column | str) -> Column:
    """X7+X8: lower-case and collapse; NULL becomes empty."""
    return collapse(F.lower(F.coalesce(as_column(c), F.lit(""))))


def language_code(c: Column | str, default: str = "en",
                  remap: dict[str, str] | None = None) -> Column:
    """Stripped lower-case code, ``default`` for NULL, with a few codes renamed."""
    code = F.lower(strip(F.coalesce(as_column(c), F.lit(default))))
    out = code
    for old, new in (remap if remap is not None else {"cn": "zh"}).items():
        out = F.when(code == old, new).otherwise(out)
    return out


def filled(c: Column | str, default: str = "") -> Column:
    """X10 then X6: default for NULL, then strip."""
    return strip(F.coalesce(as_column(c), F.lit(default)))


def longer_than(c: Column | str, n: int) -> Column:
    """Stripped text has more than ``n`` characters."""
    return F.length(filled(c)) > n


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words; NULL and blank count 0."""
    text = collapse(F.coalesce(as_column(c), F.lit("")))
    return F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "))) + 1)


def weighted_text(parts: Sequence[tuple[Column | str, int]]) -> Column:
    """Join the non-empty parts, each repeated by its weight."""
    pieces = [
        F.when(as_column(c) != "", F.repeat(F.concat(as_column(c), F.lit(" ")), weight))
        for c, weight in parts
    ]
    return collapse(F.concat_ws(" ", *pieces))


def default_stop_words(language: str = "english") -> list[str]:
    """Spark's stop-word list; pass your own list to the operators to replace it."""
    return StopWordsRemover.loadDefaultStopWords(language)


def tokens(c: Column | str, stop_words: Sequence[str] = ()) -> Column:
    """Lower-cased words of two or more characters without the stop words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(as_column(c), F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~w.isin(*stop_words))


def pairs(words: Column) -> Column:
    """Neighbouring words joined by a blank."""
    rest = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.transform(rest, lambda word, i: F.concat(F.get(words, i), F.lit(" "), word))


def terms(c: Column | str, stop_words: Sequence[str] = ()) -> Column:
    """One- and two-word terms, the pairs built after stop words are gone."""
    return let(tokens(c, stop_words), lambda words: F.concat(words, pairs(words)))


def is_id_query(c: Column | str) -> Column:
    """A query of digits only asks for an id, any other for a title."""
    return as_column(c).rlike("^[0-9]+$")


def title_key(c: Column | str) -> Column:
    """The form in which titles and title queries are compared."""
    return strip(F.lower(as_column(c)))
