"""Preference pairs of conversations: a common prompt once, and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, SHUT = "<|", "|>\n"
END = "<|end|>\n"
TRAINED = "assistant"
#: Answers are exchanged within blocks of so many conversation numbers.
BLOCK = 16


def turns_of(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: key, and its turns as an array of (role, text) in order.

    Rows of one turn number follow each other in the order of role and text, and repeated rows stay. Null roles and texts count
    as empty; rows without a key are left out; a null number comes first. An empty table gives no rows.
    """
    row = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    return grouped.withColumn("turns", F.transform("turns", lambda one: F.struct(one["role"].alias("role"), one["text"].alias("text"))))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(SHUT), turn["text"], F.lit(END))


def format_pairs(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Adds what two arrays of turns have in common from the start, rendered once as prompt, and the rests as completions.

    n_common is the number of common turns. A completion is the text of its turns, and its mask an array of (length, trained):
    the runs of characters in turn, trained for what an assistant says and the mark of its end, but not for names of roles.
    A null array counts as empty; equal conversations have empty completions. Columns of the input with these names are
    replaced.
    """
    one, two = (F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType)) for name in (chosen, rejected))
    same = F.array_position(F.zip_with(one, two, lambda a, b: F.coalesce(a == b, F.lit(False))), False)
    common = F.when(same > 0, same - 1).otherwise(F.size(one)).cast("int")
    found = df.withColumn("n_common", common)
    n = F.col("n_common")
    prompt = F.array_join(F.transform(F.slice(one, F.lit(1), n), rendered), "")

    def completion(turns: Column) -> Column:
        rest = F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0)))
        runs = F.transform(
            rest,
            lambda turn: F.array(
                F.struct(F.length(F.concat(F.lit(OPEN), turn["role"], F.lit(SHUT))).alias("length"), F.lit(False).alias("trained")),
                F.struct((F.length(turn["text"]) + len(END)).alias("length"), (turn["role"] == TRAINED).alias("trained")),
            ),
        )
        return F.struct(F.array_join(F.transform(rest, rendered), "").alias("text"), F.flatten(runs).alias("mask"))

    return found.withColumns({"prompt": prompt, "chosen_completion": completion(one), "rejected_completion": completion(two)})


def answer_pairs(turns: DataFrame, key: str = "conv_id", block: int = BLOCK) -> DataFrame:
    """Adds a chosen and a rejected conversation to each one of a table (key, turns): both up to its last assistant turn, the rejected
    one with the last assistant turn of another conversation in its place.

    The other one is the next with an assistant turn in the block of so many whole-number keys, after the last of a block its first.
    A conversation that is alone so has no rejected answer, and one without an assistant turn is the same on both sides;
    both keep their row.
    """
    last = F.expr("array_max(transform(sequence(1, size(turns)), i -> if(turns[i - 1].role = 'ROLE', i, 0)))".replace("ROLE", TRAINED))
    found = turns.withColumn("__last", last)
    found = found.withColumn("__answer", F.when(F.col("__last") > 0, F.element_at("turns", F.col("__last"))))
    group = Window.partitionBy(F.col(key) - F.pmod(key, F.lit(block)), F.col("__last") > 0)
    order = group.orderBy(key)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lead("__answer").over(order), F.first("__answer").over(whole))
    found = found.withColumn("__other", F.when(F.count(F.lit(1)).over(group) > 1, other))
    before = F.slice("turns", F.lit(1), F.greatest(F.col("__last") - 1, F.lit(0)))
    rejected = F.concat(before, F.when(F.col("__other").isNull(), F.slice("turns", 1, 0)).otherwise(F.array("__other")))
    answered = F.col("__last") > 0
    return found.select(
        key,
        F.when(answered, F.slice("turns", F.lit(1), F.col("__last"))).otherwise(F.col("turns")).alias("chosen"),
        F.when(answered, rejected).otherwise(F.col("turns")).alias("rejected"),
    )


def op9_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with its last answer as chosen and that of another conversation as rejected: the prompt that both share, both
    completions, and their masks as length:trained in turn."""
    whole = format_pairs(answer_pairs(turns_of(spark.read.parquet(f"{folder}/conversations.parquet"))))

    def mask(name: str) -> Column:
        runs = F.transform(F.col(name)["mask"], lambda run: F.concat(run["length"], F.lit(":"), run["trained"].cast("int")))
        return F.array_join(runs, ",")

    return whole.select(
        "conv_id",
        F.col("n_common").cast("long").alias("n_common"),
        "prompt",
        F.col("chosen_completion.text").alias("chosen"),
        mask("chosen_completion").alias("chosen_mask"),
        F.col("rejected_completion.text").alias("rejected"),
        mask("rejected_completion").alias("rejected_mask"),
    )


def oracle() -> str:
    said = "list_transform({0}, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10))"
    runs = (
        "list_transform({0}, lambda x: (length(x.role) + 5)::VARCHAR || ':0,' || (length(x.text) + 8)::VARCHAR || ':'"
        " || CASE WHEN x.role = 'assistant' THEN '1' ELSE '0' END)"
    )

    def joined(shape: str, part: str, mark: str) -> str:
        return f"array_to_string({shape.format(part)}, '{mark}')"

    return f"""
WITH turns AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), ended AS (
  SELECT *, coalesce(list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')), 0) AS last FROM turns
), paired AS (
  SELECT *, coalesce(lead(t[last]) OVER w, first_value(t[last]) OVER w) AS other, count(*) OVER (PARTITION BY conv_id // 16, last > 0) AS n
  FROM ended WINDOW w AS (PARTITION BY conv_id // 16, last > 0 ORDER BY conv_id)
), sides AS (
  SELECT conv_id, CASE WHEN last = 0 THEN t ELSE t[1:last] END AS a,
    CASE WHEN last = 0 THEN t WHEN n = 1 THEN t[1:last - 1] ELSE list_append(t[1:last - 1], other) END AS b FROM paired
), counted AS (
  SELECT *, coalesce(list_min(list_filter(range(1, 1 + greatest(len(a), len(b))), lambda i: a[i] IS DISTINCT FROM b[i])) - 1,
                     len(a)) AS n FROM sides
)
SELECT conv_id, n::BIGINT AS n_common, {joined(said, "a[1:n]", "")} AS prompt,
  {joined(said, "a[n + 1:]", "")} AS chosen, {joined(runs, "a[n + 1:]", ",")} AS chosen_mask,
  {joined(said, "b[n + 1:]", "")} AS rejected, {joined(runs, "b[n + 1:]", ",")} AS rejected_mask
FROM counted
"""
