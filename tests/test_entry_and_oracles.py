"""Driver contract: entry, registry consistency and a DuckDB comparison at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from valuora.sources.tables import TABLES

CHECK = ["sales_table", "drift_report", "contract_violations", "stratified_split", "temporal_comparison",
         "model_selection_fallback", "target_encoding", "request_counters", "consensus_votes"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["section", "feature", "metric", "value"]


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) > 80


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def n(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", CHECK)
def test_matches_duckdb(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    ddb = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm(df.collect(), df.columns) == _norm(ddb, dcols)
