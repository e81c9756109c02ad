"""Table scans and sinks on parquet.

Masters and error tables are plain parquet directories. A write never goes
to the path being read: every master state is a new snapshot directory.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Whole-table scan of one of the driver's parquet tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_columns(spark: SparkSession, path: str, columns) -> DataFrame:
    """Pruned scan (only ``columns`` reach the parquet reader)."""
    return spark.read.parquet(path).select(*columns)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet in the checkpoint folder and read it back: a durable cut of the
    lineage whose columns can be pruned and whose size the planner knows."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def files_there(df: DataFrame) -> bool:
    """Whether the files that a plain table scan ``df`` reads still exist (the first stands for all)."""
    files = df.inputFiles()
    if not files:
        return True
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(files[0])
    return path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).exists(path)


def read_or_none(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """The table at ``path``, or None when there is none (an empty folder included); any
    other failure is an error."""
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def append(df: DataFrame, path: str) -> None:
    """Append sink."""
    df.write.mode("append").parquet(path)


def log_counts(spark: SparkSession, path: str, run_time, counts: dict) -> None:
    """Append the row counts of a run's steps to the run log (run_time, step, row_count)."""
    append(spark.createDataFrame([(run_time, k, int(v)) for k, v in counts.items()],
                                 "run_time timestamp_ntz, step string, row_count bigint"), path)


def counted(df: DataFrame, label: str, **more):
    """Attach a row-count observation; read it after an action via ``.get``."""
    from pyspark.sql import Observation
    obs = Observation(label)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[v.alias(k) for k, v in more.items()]), obs
