"""Every registered query with SQL agrees with DuckDB on the small tables; streams agree with the batch form."""

from collections import Counter

import duckdb
import pytest

from visloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    out = duckdb.connect()
    for t in TABLES:
        out.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return out


def tidy(rows):
    return Counter(tuple("nan" if isinstance(x, float) and x != x else round(x, 8) if isinstance(x, float) else x for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    got = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    expected = con.sql(f"SELECT {', '.join(columns)} FROM ({catalog.SQL[name]})").fetchall()
    assert tidy(tuple(r[c] for c in columns) for r in got.collect()) == tidy(expected)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
