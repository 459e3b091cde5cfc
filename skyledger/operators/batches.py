"""Hooks for user code over batches of rows, for DataFrames and for SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T, udtf

BATCH_ROWS = 10_000


def process_in_batches(df: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Run `work` on Arrow batches of `df` in parallel and return what it returns.

    Batch size is `spark.sql.execution.arrow.maxRecordsPerBatch`. An exception in `work` fails the
    job.
    """

    def run(batches):
        for batch in batches:
            yield work(batch)

    return df.mapInPandas(run, schema)


def batch_function(
    work: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | Callable[[T.StructType], T.StructType],
    batch_rows: int | None = BATCH_ROWS,
):
    """`work` as a table function: `SELECT * FROM name(TABLE(t) [PARTITION BY ... [ORDER BY ...]])`.

    `schema` is the result's columns, or a function that gives them for the table's. `work` gets up to
    `batch_rows` rows at a time, never of two groups, or whole groups where that is None; then a group
    must fit in memory. Missing values of the result become NULL. Without PARTITION BY batches are parts
    of tasks. An exception in `work`, or a result with other columns, fails the job.
    """
    given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    class Batches:
        @staticmethod
        def analyze(table: udtf.AnalyzeArgument) -> udtf.AnalyzeResult:
            if not table.isTable:
                raise ValueError("a batch function takes a table: name(TABLE(...))")
            return udtf.AnalyzeResult(given if isinstance(given, T.StructType) else given(table.dataType))

        def __init__(self, analyzed: udtf.AnalyzeResult):
            self.names, self.held = analyzed.schema.names, []

        def eval(self, row: Row) -> Iterator[tuple]:
            self.held.append(row)
            if len(self.held) == batch_rows:
                yield from self._done()

        def terminate(self) -> Iterator[tuple]:
            if self.held:
                yield from self._done()

        def _done(self) -> Iterator[tuple]:
            rows, self.held = self.held, []
            out = work(pd.DataFrame([tuple(r) for r in rows], columns=rows[0].__fields__))
            if list(out.columns) != self.names:
                raise ValueError(f"the batch function gave {list(out.columns)} and not {self.names}")
            yield from zip(*(_with_nulls(out[n]) for n in self.names))

    return F.udtf(Batches)


def _with_nulls(column: pd.Series) -> list:
    """The values of a column, None where one is missing. Whole tables of objects cost small groups far more."""
    absent = column.isna().to_numpy()
    values = column.astype(object).tolist()
    return [None if gone else v for v, gone in zip(values, absent)] if absent.any() else values


def register_batch_function(spark: SparkSession, name: str, work, schema, batch_rows: int | None = BATCH_ROWS) -> None:
    """Makes `work` callable from the session's SQL as `name(TABLE(...))`."""
    spark.udtf.register(name, batch_function(work, schema, batch_rows))


# The function travels with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["BATCH_ROWS"]))
