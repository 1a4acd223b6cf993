"""Every catalogue query against its SQL in DuckDB, or against naive Python where SQL can't say it."""

import math
from collections import Counter

import duckdb
import pytest

from quillgrid.plans import catalog
from quillgrid.plans.fixtures import TABLES, sql_of, table

from .conftest import SMALL

STAR = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in STAR:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows_of(rows, names):
    return Counter(tuple(plain(r[n]) for n in names) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    cur = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    df = catalog.QUERIES[name](spark, SMALL)
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.collect(), names) == Counter(tuple(map(plain, r)) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(TABLES))
def test_layout_tables_agree(spark, duck, name):
    df = table(spark, SMALL, name)
    cur = duck.execute(sql_of(name))
    assert rows_of(df.collect(), [d[0] for d in cur.description]) == Counter(cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_rows_only(spark, name):
    df = catalog.QUERIES[name](spark, SMALL)
    assert df.columns and df.count() >= 0


def test_no_python_in_native_queries(spark):
    for name in ("q01_smallest_container", "q12_title_scores", "q21_facets", "q31_similar_pairs", "q36_average_precision"):
        plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_running_number_of_more_rows_than_a_sample_and_nulls(spark):
    """Ranges are cut by samples: the sizes that number the rows must be those of the same cut."""
    from pyspark.sql import functions as F

    from quillgrid.sources.sinks import running_number

    null = F.lit(None).cast("long")
    rows = spark.range(60_000, numPartitions=3).select(F.when(F.col("id") % 1000 != 7, F.pmod(F.xxhash64("id"), F.lit(500))).otherwise(null).alias("a"), F.col("id").alias("b"), F.concat(F.lit("c"), "id").alias("c"))
    got = running_number(rows, ["a", "b"], "n").collect()
    want = sorted(got, key=lambda r: (r.a is None, r.a or 0, r.b))  # DuckDB's order: nulls are last
    assert [r.n for r in want] == list(range(1, 60_001))
    assert all(r.c == f"c{r.b}" for r in got)
