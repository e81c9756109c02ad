"""A1-A5: land a feed's CSV file into its lake table.

The file is read with a header and every column as text, columns are taken
by header name, and only the known number / boolean / date columns are
converted. Reading phones as text keeps their leading zeros, which schema
inference would drop. Quoted line ends and doubled quotes are part of a value
(so one file is one task: have a large drop arrive as several files). Columns
the feed does not know land as text too. An empty value is null; texts such as
``NA`` or ``nan`` are kept as they are. A missing path lands no rows; any other
failure to read is an error.

A number may be written with a decimal point (``12.0`` is 12); a filled value
that is no number lands as null and is counted (``unreadable``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import BOOLEAN_COLUMNS, CSV_COLUMNS, CSV_FILE, DATE_COLUMNS, NUMBER_COLUMNS
from .tables import counted, read_or_none

LANDED_ON = "landed_on"


def text_schema(feed: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS[feed]])


def _number(c: str) -> Column:
    return F.col(c).try_cast("decimal(38,6)").try_cast("bigint")


def typed_columns(feed: str) -> list[Column]:
    out = []
    for c in CSV_COLUMNS[feed]:
        if c in DATE_COLUMNS.get(feed, ()):
            out.append(F.try_to_timestamp(F.col(c)).cast("timestamp_ntz").alias(c))
        elif c in NUMBER_COLUMNS.get(feed, ()):
            out.append(_number(c).alias(c))
        elif c in BOOLEAN_COLUMNS.get(feed, ()):
            out.append(F.col(c).try_cast("boolean").alias(c))
        else:
            out.append(F.col(c))
    return out


def unreadable(feed: str) -> Column:
    """How many filled number values of a row are no numbers."""
    count = F.lit(0)
    for c in NUMBER_COLUMNS.get(feed, ()):
        count = count + (F.col(c).isNotNull() & _number(c).isNull()).cast("int")
    return count


def _raw(spark: SparkSession, feed: str, path: str) -> DataFrame:
    try:
        raw = spark.read.options(header="true", inferSchema="false", multiLine="true", escape='"').csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], text_schema(feed))
    missing = [c for c in CSV_COLUMNS[feed] if c not in raw.columns]
    return raw.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def read_feed_csv(spark: SparkSession, feed: str, path: str, now: Column, extra: tuple = ()) -> DataFrame:
    """The landed rows of one feed file, stamped insert/update = ``now``."""
    raw = _raw(spark, feed, path)
    unknown = [F.col(f"`{c}`") for c in raw.columns if c not in CSV_COLUMNS[feed]]
    return raw.select(*typed_columns(feed), *unknown, now.alias("insert_datetime"), now.alias("update_datetime"), *extra)


def land_feed(spark: SparkSession, feed: str, csv_dir: str, lake_root: str, now: Column) -> dict:
    """Land today's file of ``feed`` in ``<lake_root>/<feed>``; returns the rows landed and the
    unreadable numbers. The day is a partition that a second run of the same day replaces."""
    rows = read_feed_csv(spark, feed, f"{csv_dir}/{CSV_FILE[feed]}", now,
                         (F.to_date(now).alias(LANDED_ON), unreadable(feed).alias("_unreadable")))
    observed, obs = counted(rows, f"land_{feed}", unreadable=F.coalesce(F.sum("_unreadable"), F.lit(0)))
    replace_day(observed.drop("_unreadable"), f"{lake_root}/{feed}")
    return {"landed": int(obs.get["rows"]), "unreadable": int(obs.get["unreadable"])}


def replace_day(rows: DataFrame, path: str) -> None:
    """Write the day's rows in place of what an earlier run of the same day wrote."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(LANDED_ON).parquet(path))


def lake_day(spark: SparkSession, feed: str, lake_root: str, day: dt.date) -> DataFrame | None:
    """The rows of a feed that landed on ``day``, or None where nothing did. Only that day's folder is
    listed and only its files are opened, however many days the lake holds."""
    root = f"{lake_root}/{feed}"
    return read_or_none(spark, f"{root}/{LANDED_ON}={day.isoformat()}", basePath=root)


def lake(spark: SparkSession, feed: str, lake_root: str) -> DataFrame | None:
    """All landed rows of a feed (columns of every day), or None before the first one."""
    return read_or_none(spark, f"{lake_root}/{feed}", mergeSchema="true")
