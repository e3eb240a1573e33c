"""Bounded scans. A bad row never fails a job; it is dropped or nulled and reported as a reject."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tallyworks.functions import text, values
from tallyworks.operators.prefix import running_total
from tallyworks.operators.skew import small_side
from tallyworks.session import work_folder

_READERS = {
    T.LongType: values.to_long,
    T.DoubleType: values.to_double,
    T.DateType: values.to_day,
    T.TimestampType: values.to_event_time,
}


def typed(column: str, kind: T.DataType) -> Column:
    """The text column as the wanted type; NULL where it does not fit, and for an empty text."""
    reader = _READERS.get(type(kind), lambda value: F.nullif(text.strip(value), F.lit("")))
    return reader(F.col(column)).alias(column)


def conform(raw: DataFrame, layout: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejects of a DataFrame of text columns. Works on streams, too.

    Rows keep a bad optional value as NULL. A row with a bad or missing required
    value is only in the rejects. The rejects give the row as text and the names
    of its bad columns, so a row with a bad optional value is in both.
    """
    required = [f.name for f in layout.fields if not f.nullable]
    others = [c for c in raw.columns if c not in layout.fieldNames()]
    rows = raw.select(*others, *[typed(f.name, f.dataType) for f in layout.fields])
    for name in required:
        rows = rows.where(F.col(name).isNotNull())
    line, bad_columns = _complaint(layout)
    rejects = raw.select(*others, line.alias("line"), bad_columns.alias("bad_columns"))
    return rows, rejects.where(F.size("bad_columns") > 0)


def _complaint(layout: T.StructType) -> tuple[Column, Column]:
    """The row as text, and the names of its bad columns."""
    flags = []
    for f in layout.fields:
        bad = typed(f.name, f.dataType).isNull()
        if f.nullable:
            bad = bad & (F.length(text.strip(F.col(f.name))) > 0)
        flags.append(F.when(bad, F.lit(f.name)))
    whole = F.concat_ws(",", *[F.coalesce(F.col(n), F.lit("")) for n in layout.fieldNames()])
    return whole, F.array_compact(F.array(*flags))


_LINE, _BAD, _KEPT = "__line", "__bad_columns", "__kept"


def conform_once(raw: DataFrame, layout: T.StructType) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The rows and rejects of ``conform`` from one pass over the input, and how many there are.

    The pass writes both, tagged, to a table in the shared folder, from which any number of
    results read the columns that they need; the counts are observed on the way. They
    are ``read``, ``rows``, ``rejects``, and ``bad <column>`` for each column.
    """
    spark = raw.sparkSession
    others = [c for c in raw.columns if c not in layout.fieldNames()]
    line, bad_columns = _complaint(layout)
    required = F.array(*[F.lit(f.name) for f in layout.fields if not f.nullable]).cast("array<string>")
    tagged = raw.select(
        *others,
        *[typed(f.name, f.dataType) for f in layout.fields],
        F.when(F.size(bad_columns) > 0, line).alias(_LINE),
        bad_columns.alias(_BAD),
        (~F.arrays_overlap(bad_columns, required)).alias(_KEPT),
    )
    counts = {"read": F.lit(True), "rows": F.col(_KEPT), "rejects": F.size(_BAD) > 0}
    counts |= {f"bad {name}": F.array_contains(_BAD, name) for name in layout.fieldNames()}
    seen = Observation()
    place = work_folder(spark, "scanned")
    observed = tagged.observe(seen, *[F.count_if(rule).alias(name) for name, rule in counts.items()])
    observed.write.partitionBy(_KEPT).parquet(place)
    written = spark.read.schema(observed.schema).parquet(place)
    rows = written.where(F.col(_KEPT)).drop(_LINE, _BAD, _KEPT)
    rejects = written.where(F.size(_BAD) > 0).select(*others, F.col(_LINE).alias("line"), F.col(_BAD).alias("bad_columns"))
    return rows, rejects, dict(seen.get)


def scan_delimited(
    spark: SparkSession, path: str, layout: T.StructType, header: bool = False, separator: str = ","
) -> tuple[DataFrame, DataFrame]:
    """Rows and rejects of delimited text files, each with or without a header line.

    Fields have no quoting: every separator splits. Surplus fields are ignored.
    """
    return conform(_fields(spark, path, layout, header, separator), layout)


def scan_delimited_once(
    spark: SparkSession, path: str, layout: T.StructType, header: bool = False, separator: str = ","
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """What ``scan_delimited`` gives, and the counts, with the files read and parsed once for all results."""
    return conform_once(_fields(spark, path, layout, header, separator), layout)


def _fields(spark: SparkSession, path: str, layout: T.StructType, header: bool, separator: str) -> DataFrame:
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in layout.fieldNames()])
    reader = spark.read.schema(as_text).option("header", header).option("sep", separator).option("quote", "")
    return reader.csv(path)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as one row per line, in the column ``value``."""
    return spark.read.text(path)


def scan_numbered_lines(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Text lines in ``value`` with ``seq``, their number over all files in file name order, from 0 on.

    A read block knows the order of its own lines. The blocks, not the lines,
    are counted; a running total over the blocks gives the number at which each starts.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    blocks = lines.groupBy("file", "block").agg(F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
    skipped = F.when(F.col("block") == 0, 1).otherwise(0) if header else F.lit(0)
    starts, _ = running_total(blocks, ["file", "block"], F.col("rows") - skipped, "start")
    starts = starts.select("file", "block", "first_id", "start")
    place = F.col("row_id") - F.col("first_id") - skipped
    numbered = lines.join(small_side(starts), ["file", "block"])
    return numbered.where(place >= 0).select((F.col("start") + place).alias("seq"), "value")


def split_lines(lines: DataFrame, layout: T.StructType, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejects of delimited text lines, as they come from a topic.

    Other columns of the lines, such as the arrival number, stay in front.
    """
    stripped = text.strip(F.col(column))
    others = [c for c in lines.columns if c != column]
    return conform(lines.select(*others, *text.fields(stripped, layout.fieldNames())), layout)


def scan_ids(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """A lookup list with one trimmed id per line; blank lines are left out."""
    ids = scan_lines(spark, path).select(text.strip(F.col("value")).alias(name))
    return ids.where(F.length(name) > 0).distinct()


def literal(spark: SparkSession, items: Iterable, name: str = "value", kind: str = "bigint") -> DataFrame:
    """A few values given in the program."""
    return spark.createDataFrame([(item,) for item in items], f"{name} {kind}")
