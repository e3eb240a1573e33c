"""Topics as folders of files: publish, replay in order, subscribe, envelope.

The operators on top only need a streaming DataFrame, so a broker source with
the same columns can take the place of a folder.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyworks.operators.prefix import running_total
from tallyworks.session import remove_folder, work_folder

_RANK, _WAVE = "__rank", "__wave"


def exact_glob(path: str) -> str:
    """A glob for just this path: a stream source takes a single file only through a glob."""
    return f"{path[:-1]}[{path[-1]}]"


def subscribe(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    form: str = "parquet",
    files_per_batch: int | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """The files of a folder, and those that arrive later, as a stream.

    ``arrival`` names a column for the time at which the file of a row was written, so
    that windows over arrival time need no stamp of the program that writes.
    """
    reader = spark.readStream.schema(schema).format(form)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(path)
    if arrival is None:
        return stream
    return stream.select("*", F.col("_metadata.file_modification_time").alias(arrival))


def open_topic(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet") -> None:
    """Make an empty topic, so that it can be subscribed to before anything is published."""
    publish(spark.createDataFrame([], schema), path, form)


def publish(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Append bounded rows to a topic."""
    df.write.mode("append").format(form).save(path)


def replay(df: DataFrame, seq: str, path: str, waves: int, stamp: str | None = None) -> Iterator[int]:
    """Publish a table in arrival order, in waves of equally many rows with consecutive ``seq``.

    Yields the number of each wave after it was written, so that the caller can
    let a stream take it in before the next one comes. Inside a wave the order
    is the ``seq`` column, which every row keeps. ``stamp`` names a column for the
    time at which the wave is published, for windows over arrival time. Rows without
    a number come first. The table is read once; waves are cut by rank, so gaps of
    ``seq`` do not matter, and wait in the shared folder.
    """
    spark = df.sparkSession
    ranked, total = running_total(df, [seq], F.lit(1), _RANK)
    if not total:
        return
    waiting = work_folder(spark, "waves")
    wave_of = F.expr(f"{_RANK} * {waves} div {total}").cast("int")
    ranked.withColumn(_WAVE, wave_of).drop(_RANK).write.partitionBy(_WAVE).parquet(waiting)
    for wave in range(waves):
        rows = spark.read.parquet(waiting).where(F.col(_WAVE) == wave).drop(_WAVE)
        publish(rows if stamp is None else rows.withColumn(stamp, F.current_timestamp()), path)
        yield wave
    remove_folder(spark, waiting)


# Fixed value: the wording of a message.
SEND_NUMBER = "Send number: "


def envelope(number: Column) -> list[Column]:
    """A message for a number: the payload and the attribute ``even``."""
    even = F.when(number % 2 == 0, "True").otherwise("False")
    return [
        F.concat(F.lit(SEND_NUMBER), number.cast("string")).alias("value"),
        F.create_map(F.lit("even"), even).alias("attributes"),
    ]
