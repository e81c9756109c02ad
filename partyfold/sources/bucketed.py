"""Parquet tables bucketed on a key, by path.

A bucketed table is one of Spark's own (``bucketBy``): rows of one key hash are in the same
bucket files, so a join or an aggregate on that key reads it without a shuffle; only the other
side moves. The files lie in a folder the caller names and stay readable as plain
parquet. Such a folder is used through a table entry of the session's catalog, which says how
it is bucketed; the number of buckets is a fixed property of a deployment (as the number of
partitions of a shuffle), passed in wherever a folder is written or read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, keys, buckets: int, aligned: bool = False) -> DataFrame:
    """Write ``df`` bucketed on ``keys`` at ``path`` (which must be new) and return the table.
    ``aligned`` rows are already dealt by the keys (they come from a bucketed table or a join on
    them) and are written where they are; others are shuffled once, one file a bucket."""
    name = f"kept_{uuid.uuid4().hex}"
    rows = df if aligned else df.repartition(buckets, *keys)
    (rows.write.mode("errorifexists").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, keys, buckets: int) -> DataFrame:
    """The table that ``write_bucketed`` left at ``path``."""
    name = f"kept_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)
