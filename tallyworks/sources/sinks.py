"""Bounded sinks. Every one writes its partitions in parallel, one file or more per task."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    """Write one formatted text line per row."""
    df.select(line.cast("string").alias("value")).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, form: str = "parquet", **options: str) -> None:
    df.write.mode("overwrite").options(**options).format(form).save(path)


def fan_out(source: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]], form: str = "parquet") -> None:
    """Write several results of one input, each to its own path.

    Every result reads only the columns and rows it needs, which for files is
    cheaper than keeping the whole input. Keep the source with ``persist`` first
    if it is costly to make.
    """
    for path, transform in outputs.items():
        write_table(transform(source), path, form)


def write_tagged(df: DataFrame, path: str, tag: str = "tag", form: str = "parquet") -> None:
    """Write the rows of every tag to its own folder ``tag=...`` in one pass over the input."""
    df.write.mode("overwrite").partitionBy(tag).format(form).save(path)
