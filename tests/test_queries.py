"""Every registered query with SQL gives the same rows as the SQL engine."""

import math

import duckdb
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from docmill.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, bool) or not hasattr(v, "__float__"):
        return str(v)
    return f"{float(v):.6f}"


def rows(df):
    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, sf_dir, duck, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    want = duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs_without_sql(spark, sf_dir, name):
    assert registry.queries()[name](spark, sf_dir).count() > 0


def test_entry_point_registers_everything(spark):
    import __spark_entry__ as e

    assert set(registry.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_text_quality_of_odd_texts_equals_sql(spark, tmp_path):
    """Null and empty texts, a vertical tab, letters newer than Java's, and means halfway between two roundings."""
    texts = [("null", None), ("null", None), ("some", None), ("some", "a b"), (None, "é 1"), (None, None), ("empty", ""), ("empty", "ab"), ("tab", "a\x0bb \x0c\x85\x1c ")]
    texts += [("new", "ࡰ\U00010570\U00011f02\U000323af ࢏\U0002ebf0"), ("ascii", "x" * 41 + "-" * 599), ("blank", " " * 41 + "-" * 599), ("beyond", "é" * 41 + "-" * 599)]
    texts += [("mean", "x" * (1 + (i < 41))) for i in range(640)] + [("long", "y" * (i * i % 997 + 1)) for i in range(300)]
    pq.write_table(pa.table({"doc_id": range(len(texts)), "text": [t for _, t in texts], "lang": [k for k, _ in texts]}), tmp_path / "documents.parquet")
    want = duckdb.connect().sql(registry.oracle_sql()["str10_text_quality_by_lang"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet'"))
    got = registry.queries()["str10_text_quality_by_lang"](spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
