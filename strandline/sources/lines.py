"""Text files as numbered lines with their file name.

A report is small, but there are many; lines are numbered inside their file by the
order in which a whole file is read, so files are the unit of parallelism.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line (from 1), text of text files (compressed ones too)."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    body = F.regexp_replace("value", "\r\n?", "\n")
    return whole.select("file", F.posexplode(F.split(F.regexp_replace(body, "\n$", ""), "\n")).alias("line", "text")).withColumn("line", F.col("line") + 1)


def sample_of(file: Column, pattern: str = r"([^/]+?)(?:\.[^/]*)?$") -> Column:
    """A name from a file path."""
    return F.regexp_extract(file, pattern, 1)


def tagged(df: DataFrame, tag: str, names: list[str], sep: str = "\t") -> DataFrame:
    """The rows of one section of a report whose first token names the section."""
    parts = F.split("text", sep)
    rows = df.where(parts[0] == tag)
    return rows.select("file", "line", *[F.trim(F.get(parts, F.lit(i + 1))).alias(n) for i, n in enumerate(names)])


def key_values(df: DataFrame, sep: str = "\t", until_blank: bool = False) -> DataFrame:
    """file, metric, value of 'key<sep>value' lines (D13); ``until_blank`` stops at a file's first empty line."""
    rows = df
    if until_blank:
        w = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
        rows = df.withColumn("__b", F.max((F.trim("text") == "").cast("int")).over(w)).where("__b = 0").drop("__b")
    parts = F.split("text", sep, 2)
    return rows.where(F.size(parts) == 2).select("file", F.trim(parts[0]).alias("metric"), F.trim(parts[1]).alias("value"))


def header_row(df: DataFrame, starts: str, names: list[str], sep: str = "\t") -> DataFrame:
    """The line after the first one that starts with ``starts``, by the header's names."""
    at = df.where(F.col("text").startswith(starts)).groupBy("file").agg(F.min_by("text", "line").alias("__head"), (F.min("line") + 1).alias("line"))
    row = df.join(at, ["file", "line"]).select("file", F.split("__head", sep).alias("h"), F.split("text", sep).alias("v"))
    place = lambda n: F.array_position("h", F.lit(n)).cast("int")
    return row.select("file", *[F.when(place(n) > 0, F.get("v", place(n) - 1)).alias(n.lower()) for n in names])
