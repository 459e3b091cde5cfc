"""User code over batches, called from SQL."""

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import types as T

from skyledger.operators import batches as B


@pytest.fixture
def numbers(spark):
    spark.range(1000).selectExpr("id % 7 as g", "id", "if(id % 5 = 0, null, cast(id as double)) as x").createOrReplaceTempView("numbers")


@pytest.fixture
def sizes():
    def count(batch):
        return pd.DataFrame({"g": [batch["g"].iloc[0]], "n": [len(batch)], "groups": [batch["g"].nunique()], "total": [batch["x"].sum()]})

    return count


def test_whole_groups_and_batches_of_groups(spark, numbers, sizes):
    B.register_batch_function(spark, "whole", sizes, "g long, n long, groups int, total double", batch_rows=None)
    got = spark.sql("select g, n, groups, total from whole(table(numbers) partition by g)")
    expected = spark.sql("select g, count(*) n, 1 groups, coalesce(sum(x), 0) total from numbers group by g")
    assert rows(got) == rows(expected)
    B.register_batch_function(spark, "parts", sizes, "g long, n long, groups int, total double", batch_rows=40)
    found = spark.sql("select * from parts(table(numbers) partition by g)").collect()
    assert max(r.n for r in found) == 40 and all(r.groups == 1 for r in found) and sum(r.n for r in found) == 1000
    free = spark.sql("select sum(n) as n, max(n) as most from parts(table(numbers))").first()
    assert free.n == 1000 and free.most == 40
    assert spark.sql("select * from whole(table(select * from numbers where id < 0) partition by g)").collect() == []


def test_schema_from_the_table_nulls_and_order(spark, numbers):
    def more(columns: T.StructType) -> T.StructType:
        return T.StructType([*columns.fields, T.StructField("before", T.DoubleType())])

    B.register_batch_function(spark, "before", lambda b: b.assign(before=b["x"].shift()), more, batch_rows=None)
    got = spark.sql("select g, id, x, before from before(table(numbers) partition by g order by id desc)")
    expected = spark.sql("select g, id, x, lag(x) over (partition by g order by id desc) as before from numbers")
    assert rows(got) == rows(expected)


def test_errors(spark, numbers, sizes):
    def fail(batch):
        raise ValueError("user code failed")

    B.register_batch_function(spark, "failing", fail, "g long")
    with pytest.raises(Exception, match="user code failed"):
        spark.sql("select * from failing(table(numbers))").collect()
    B.register_batch_function(spark, "other", sizes, "g long, n long")
    with pytest.raises(Exception, match="and not"):
        spark.sql("select * from other(table(numbers))").collect()
    with pytest.raises(Exception, match="takes a table"):
        spark.sql("select * from other(5)").collect()


def test_missing_values_by_column():
    made = B._with_nulls(pd.Series([1.5, float("nan"), None]))
    assert made == [1.5, None, None]
    assert B._with_nulls(pd.Series([1, 2])) == [1, 2] and B._with_nulls(pd.Series([pd.Timestamp("2020-01-01"), pd.NaT])) == [pd.Timestamp("2020-01-01"), None]
