"""Session-level helpers: size-checked broadcast and lineage cuts that survive executor loss."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 200_000


def join_hint(
    measured: DataFrame, max_rows: int = BROADCAST_ROWS, larger: str | None = None
) -> Callable[[DataFrame], DataFrame]:
    """A hint for joins against `measured` or against what a projection or filter leaves of it.

    Rows are counted up to `max_rows + 1`. Within the bound the hint is a broadcast; a larger side
    gets the hint `larger`, if any, and the join runs as a shuffle join whose hot keys adaptive
    execution splits.
    """
    if measured.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast
    return (lambda df: df.hint(larger)) if larger else (lambda df: df)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, hinted for broadcast if it is small."""
    return join_hint(df, max_rows)(df)


def computed_once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """`keep` and the new columns, each computed once per row.

    A filter on a plain projected column is moved below the projection with the whole expression
    copied into it; costly text rules would then run several times. Columns that come out of a
    generator stay where they are.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder of the cluster.

    The cluster names it in `spark.checkpoint.dir`; the setting is read and never changed. Only a
    local master may leave it unset, as in tests: then a folder of this machine is taken. Anywhere
    else executors would write to disks of their own, so an unset folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/skyledger-{uuid.uuid4().hex}"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="skyledger-")


def materialize(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Several reports then share one computation, scan only their own columns, and lose nothing when
    an executor goes away.
    """
    path = scratch_folder(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
