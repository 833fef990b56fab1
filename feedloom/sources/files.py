"""File sources and sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.schemas import ARTICLE


def exists(spark: SparkSession, path: str) -> bool:
    """True if a path exists in its file system."""
    if "://" not in path:
        return os.path.exists(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_feeds(spark: SparkSession, feeds: dict[str, str], schema: T.StructType = ARTICLE) -> DataFrame:
    """JSON-array files by label, missing files skipped, in the declared order: (feed_no, feed, pos, fields).

    pos counts the elements of a file. Files are arrays of one line or many; each is one split, so large feeds belong in parquet or JSON lines.
    """
    out = None
    for no, (label, path) in enumerate(feeds.items()):
        if not exists(spark, path):
            continue
        one = spark.read.schema(schema).json(path, multiLine=True).withColumns({"feed_no": F.lit(no), "feed": F.lit(label), "pos": F.monotonically_increasing_id()})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        empty = T.StructType([*schema.fields, T.StructField("feed_no", T.IntegerType()), T.StructField("feed", T.StringType()), T.StructField("pos", T.LongType())])
        return spark.createDataFrame([], empty)
    return out


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """lineno, line of a text file; empty if it is missing."""
    if not exists(spark, path):
        return spark.createDataFrame([], "lineno bigint, line string")
    one = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("lineno", "line"))
    return one.select((F.col("lineno") + 1).cast("bigint").alias("lineno"), "line")


def write_rows(df: DataFrame, path: str, fmt: str = "parquet", partition: str | None = None, mode: str = "overwrite") -> None:
    """Rows as parquet or JSON, partitioned where asked."""
    w = df.write.mode(mode)
    (w.partitionBy(partition) if partition else w).format(fmt).save(path)


def resume(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the finished ones."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def report_name(prefix: str, start: str, end: str) -> str:
    return f"{prefix}_{start.replace('-', '')}_{end.replace('-', '')}"
