"""Text statistics as Spark columns, computed in a chain of projections without Python.

Every step that uses an array more than once stands in a projection of its own,
so that the array is computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of the languages that the corpus holds.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec ou son",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí",
}

HELPERS = _TEXT, _WORDS, _LINES, _CODES, _HASHES, _ORDERED, _REPEATED = tuple(
    f"__{name}" for name in ("text", "words", "lines", "codes", "hashes", "ordered", "repeated")
)


def stop_words() -> list[str]:
    return sorted({word for words in STOP_WORDS.values() for word in words.split()})


def with_words(df: DataFrame, text: str) -> DataFrame:
    """Adds the text (null: empty), its words and its lines that hold a word, all under names that begin with two underscores."""
    words = F.array_remove(F.split(F.col(_TEXT), BLANKS), "")
    lines = F.filter(F.split(F.col(_TEXT), "\n"), lambda line: line.rlike(NOT_BLANK))
    return df.withColumn(_TEXT, F.coalesce(F.col(text), F.lit(""))).withColumns({_WORDS: words, _LINES: lines})


def with_repeats(df: DataFrame) -> DataFrame:
    """Adds the ordered positions of all three-word windows that the text holds at least twice.

    Windows are compared by a 64-bit hash. They are sorted only in texts where a hash comes up again.
    """
    words = F.transform(_WORDS, lambda word: F.xxhash64(word))
    windows = F.transform(_CODES, lambda code, i: F.xxhash64(code, F.get(_CODES, i + 1), F.get(_CODES, i + 2)))
    hashes = F.slice(windows, 1, F.greatest(F.size(_CODES) - 2, F.lit(0)))
    ordered = F.when(
        F.size(F.array_distinct(_HASHES)) < F.size(_HASHES),
        F.sort_array(F.arrays_zip(F.col(_HASHES).alias("h"), F.sequence(F.lit(0), F.size(_HASHES) - 1).alias("i"))),
    )

    def again(window: Column, at: Column) -> Column:
        before = F.get(_ORDERED, at - 1).getField("h")
        after = F.get(_ORDERED, at + 1).getField("h")
        return F.coalesce(before == window.getField("h"), F.lit(False)) | F.coalesce(after == window.getField("h"), F.lit(False))

    return (
        df.withColumn(_CODES, words)
        .withColumn(_HASHES, hashes)
        .withColumn(_ORDERED, ordered)
        .withColumn(_REPEATED, F.transform(F.filter(_ORDERED, again), lambda window: window.getField("i")))
    )


def matches(of: str) -> Column:
    """How often a class of characters comes up in the text."""
    return (F.size(F.split(_TEXT, of)) - 1).cast("long")


def basic() -> dict[str, Column]:
    """Counts over the columns that with_words and with_repeats add, all as long."""
    covered = F.array_distinct(F.flatten(F.transform(_REPEATED, lambda i: F.array(i, i + 1, i + 2))))
    return {
        "n_words": F.size(_WORDS).cast("long"),
        "word_chars": F.length(F.array_join(_WORDS, "")).cast("long"),
        "n_symbols": matches(SYMBOLS),
        "n_dup_lines": (F.size(_LINES) - F.size(F.array_distinct(_LINES))).cast("long"),
        "n_repeat_words": F.coalesce(F.size(covered), F.lit(0)).cast("long"),
    }


def n_lines() -> Column:
    """Lines that hold a word."""
    return F.size(_LINES).cast("long")


def n_stop_words() -> Column:
    """Words that are a stop word, in lower case or with a capital letter first."""
    forms = sorted({form for word in stop_words() for form in (word, word.capitalize())})
    return F.size(F.filter(_WORDS, lambda word: word.isin(*forms))).cast("long")
