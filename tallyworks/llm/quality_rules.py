"""Quality rules: a table of thresholds, compiled into one projection of ratios."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import statistics


@dataclass(frozen=True)
class Rule:
    """Holds where low <= 100 * counted / per <= high; a missing bound is open. A text with no unit to count per fails."""

    name: str
    counted: str
    per: str
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        share, whole = F.col(self.counted) * 100, F.col(self.per)
        bounds = [whole > 0]
        if self.low is not None:
            bounds.append(share >= whole * self.low)
        if self.high is not None:
            bounds.append(share <= whole * self.high)
        found = bounds[0]
        for bound in bounds[1:]:
            found = found & bound
        return found


BASE = (
    Rule("enough_words", "n_words", "__one", low=50 * 100),
    Rule("repeated_windows", "n_repeat_words", "n_words", high=50),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("stop_words", "n_stop_words", "n_words", low=10),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=40),
)


def judge(df: DataFrame, text: str = "text", base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds the counts of each text, base_failed (a base rule fails), failed (names of the rules that fail) and kept.

    A null or empty text, or one of blanks, has no words: all counts are 0 and it fails the base.
    Rows are judged one by one, so that ties and repeated rows all get the same verdict and an empty table gives none.
    Columns of the input that have the name of an added column are replaced. Write the rows before a filter on what is added:
    Catalyst would push it below the counts and compute each of them many times over.
    """
    counts = statistics.basic() | {"n_lines": statistics.n_lines(), "n_stop_words": statistics.n_stop_words()}
    kept = [name for name in df.columns if name not in {*counts, "base_failed", "failed", "kept"}]
    counted = statistics.with_repeats(statistics.with_words(df, text)).select(
        *kept, *[count.alias(name) for name, count in counts.items()]
    )
    failed = F.filter(F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]), lambda name: name.isNotNull())
    base_failed = F.lit(False)
    for rule in base:
        base_failed = base_failed | ~rule.holds()
    return (
        counted.withColumn("__one", F.lit(1))
        .withColumns({"base_failed": base_failed, "failed": failed})
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
        .drop("__one")
    )


def op3_quality_rules(spark, folder: str) -> DataFrame:
    """The verdict on every document."""
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return judge(documents).select("doc_id", *columns)


def oracle() -> str:
    forms = sorted({form for word in statistics.stop_words() for form in (word, word.capitalize())})
    listed = ", ".join("'" + form.replace("'", "''") + "'" for form in forms)
    return rf"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT *, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS s FROM words
), places AS (
  SELECT doc_id, unnest(s) AS gram, generate_subscripts(s, 1) AS i FROM windows
), repeated AS (
  SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM repeated, (VALUES (0), (1), (2)) AS t(d) GROUP BY doc_id
), counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({listed})))::BIGINT AS n_stop_words
  FROM windows LEFT JOIN covered USING (doc_id)
), based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1200 * n_words
       AND 100 * n_symbols <= 10 * n_words AND 100 * n_stop_words >= 10 * n_words
       AND 100 * n_dup_lines <= 40 * n_lines AS kept
FROM based
"""
