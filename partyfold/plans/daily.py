"""The daily batch end to end: land -> slice -> errors -> standardise -> fold.

Paths are passed in by the caller (the scheduler decides where snapshots
live) and only Spark's readers and writers touch them, so any file system they
know works. Lake rows, error rows and error counts of a day are a partition that a second
run of the same day replaces; masters are new snapshots, written once, bucketed by code.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import CSV_COLUMNS, DATE_COLUMNS, ERROR_REASONS
from ..operators.reports import COUNT_SCHEMA, replace_counts
from ..operators.slice import daily_slice
from ..sources.bucketed import default_buckets
from ..sources.conf import Conf
from ..sources.landing import LANDED_ON, lake_day, land_feed
from ..sources.tables import counted, log_counts, read_or_none
from . import pipeline as pl
from .masters import Masters
from .specs import FEED_ORDER


#: Folder of the kept error counts under the error root.
COUNTS = "daily_counts"


def work_columns(feed: str) -> list[str]:
    return [c for c in CSV_COLUMNS[feed] if c not in DATE_COLUMNS.get(feed, ())]


def _write_errors(spark: SparkSession, feed: str, errors, error_root: str, day: dt.date) -> int:
    """Replace the day's error rows of a feed and, with them, its rows of the count table: the number
    of each reason and the largest error number are observed while the rows are written."""
    reasons = {f"r{i}": reason for i, reason in enumerate(ERROR_REASONS)}
    observed, obs = counted(errors, f"errors_{feed}", last=F.coalesce(F.max("error_seq"), F.lit(0)),
                            **{k: F.count_if(F.col("error_reason") == r) for k, r in reasons.items()})
    observed.write.mode("overwrite").parquet(f"{error_root}/{feed}/{LANDED_ON}={day.isoformat()}")
    got = obs.get
    rows = [(day, feed, r, int(got[k]), int(got["last"])) for k, r in reasons.items()]
    replace_counts(spark.createDataFrame(rows, COUNT_SCHEMA), f"{error_root}/{COUNTS}")
    return int(got["rows"])


def _last_error_number(spark: SparkSession, feed: str, error_root: str, day: dt.date) -> int:
    """Largest error number of a feed before ``day``'s rows: a few rows of the count table, never the
    error rows themselves."""
    counts = read_or_none(spark, f"{error_root}/{COUNTS}")
    if counts is None:
        return 0
    earlier = counts.filter((F.col("source") == feed) & (F.col("error_date") != F.lit(day)))
    return int(earlier.agg(F.coalesce(F.max("last_error_seq"), F.lit(0))).first()[0])


def run_daily(spark: SparkSession, csv_dir: str, lake_root: str, error_root: str,
              m_company_in: str, m_person_in: str, m_company_out: str, m_person_out: str,
              run_time: dt.datetime, conf: Conf | None = None, feeds=FEED_ORDER,
              conf_root: str | None = None, index_in: str | None = None, index_out: str | None = None,
              buckets: int | None = None, run_log: str | None = None) -> dict:
    """Run one day. Returns row counts per step (from observations, no extra jobs), which are also
    appended to the table ``run_log`` where one is given. Conf comes from ``conf``, else from the tables stored under ``conf_root``, else from the defaults.

    ``index_in`` is the folder of indexes that the run which wrote the masters left as its ``index_out``
    (same ``buckets``): masters and indexes are then read in place. Without it the masters may be any
    parquet tables, and are bucketed and indexed first."""
    conf = conf or (Conf.stored(spark, conf_root) if conf_root else Conf.default())
    now = F.lit(run_time).cast("timestamp_ntz")
    day = run_time.date()
    buckets = buckets or default_buckets(spark)
    counts: dict = {}
    std = {}
    for feed in feeds:
        landed = land_feed(spark, feed, csv_dir, lake_root, now)
        counts[f"landed_{feed}"], counts[f"unreadable_{feed}"] = landed["landed"], landed["unreadable"]
        rows = lake_day(spark, feed, lake_root, day)
        if rows is None:                     # nothing landed on that day
            counts[f"work_{feed}"] = counts[f"errors_{feed}"] = 0
            continue
        cols = work_columns(feed)
        work = pl.snapshot(daily_slice(rows, day, [(c, c) for c in cols], tie_break=cols, partition=LANDED_ON))
        counts[f"work_{feed}"] = work.count()
        errs = pl.errors(feed, work, conf, now, _last_error_number(spark, feed, error_root, day))
        counts[f"errors_{feed}"] = _write_errors(spark, feed, errs, error_root, day)
        std[feed] = pl.standardized(feed, work, conf)
    m_company, m_person = spark.read.parquet(m_company_in), spark.read.parquet(m_person_in)
    if index_in is not None:
        masters = Masters.load(spark, m_company_in, m_person_in, index_in, (m_company.schema, m_person.schema), buckets)
    else:
        masters = Masters.build(m_company, m_person, conf, buckets)
    masters = pl.fold(std, masters, conf, now, feeds)
    _, written = masters.saved(m_company_out, m_person_out, index_out)
    counts |= written
    if run_log is not None:
        log_counts(spark, run_log, run_time, counts)
    return counts
