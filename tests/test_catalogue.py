"""Every query with SQL gives the same rows as DuckDB; the others run and keep their schema."""

import oracle
import pytest

from tessera import catalogue

SQL = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert oracle.difference(catalogue.queries()[name](spark, oracle.DATA), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(SQL)))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, oracle.DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["classify", "regress"])
def test_every_row_is_predicted(spark, name):
    got = catalogue.queries()[name](spark, oracle.DATA)
    assert got.count() == spark.read.parquet(f"{oracle.DATA}/embeddings.parquet").count()
    assert {r[0] for r in got.select("held_out").distinct().collect()} == {True, False}
