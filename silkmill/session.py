"""Session helpers shared by every operator; nothing here holds data."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; the schema comes from the Parquet footer, so only used columns are read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster always names one. Only where it is unset (local tests) is a temporary folder chosen.
    """
    context = spark.sparkContext
    set_already = context._jsc.sc().getCheckpointDir()
    if set_already.isDefined():
        return set_already.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="silkmill-", dir=os.environ.get("TMPDIR"))
    context.setCheckpointDir(named)
    return named


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared checkpoint folder, for tables that are written to be read again."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4()}"


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and returns it read back: lost executors cannot take it along."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def few_rows(df: DataFrame, most: int, what: str) -> list[Row]:
    """All rows of a table that is small by its nature, such as settings; more than ``most`` fail, none are dropped."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} {what}")
    return rows


def broadcast_if_small(df: DataFrame, limit_bytes: int = 32 << 20) -> DataFrame:
    """``df`` marked for a broadcast join if its estimated size is at most ``limit_bytes``; beyond, it is joined by a shuffle.

    The estimate of a scan comes from the size of its files, which are compressed: memory may be a few times as much.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= limit_bytes else df
