"""Differential check: every registered batch query against its DuckDB SQL twin, plus the entry smoke."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from clicklens.plans.registry import batch_queries
from clicklens.sources.tables import TABLES
from tests.conftest import SF_SMALL


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(round(r[i], 9) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i]
                         for i in order))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    from clicklens.plans import oracle_sql, queries
    assert set(queries()) == set(oracle_sql()) and set(queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(batch_queries()))
def test_batch_query_matches_oracle(spark, duck, name):
    df = batch_queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _norm(got, df.columns) == _norm(res.fetchall(), cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["category_id", "click_count", "order_count", "pay_count"]
    assert 0 < df.count() <= 10


@pytest.mark.parametrize("name", ["visit_log", "ads_log_parse", "ads_trend_10s", "blacklist_users", "page_avg_dwell"])
def test_results_do_not_depend_on_the_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = batch_queries()[name](spark, SF_SMALL)
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(E.oracle_sql()[name])
    assert _norm(got, df.columns) == _norm(res.fetchall(), [d[0] for d in res.description])


def test_headline_results_have_the_declared_columns(spark):
    from clicklens import schemas
    from clicklens.sources import adlines, tables
    q = batch_queries()
    expect = {"hot_category_top10": schemas.CATEGORY_TOP10,
              "hot_category_session_top10": schemas.CATEGORY_SESSION_TOP10,
              "page_conversion": schemas.PAGE_CONVERSION, "page_avg_dwell": schemas.PAGE_AVG_DWELL,
              "ads_click_daily": schemas.ADS_CLICK_DAILY, "ads_area_top3_json": schemas.ADS_AREA_TOP3_JSON,
              "ads_trend_10s": schemas.ADS_TREND, "blacklist_users": schemas.BLACKLIST}
    for name, cols in expect.items():
        assert q[name](spark, SF_SMALL).columns == cols, name
    parsed = adlines.parse_lines(adlines.encode_lines(tables.ads_log(spark, SF_SMALL)))
    assert sorted(parsed.columns) == sorted(schemas.ADS_LOG.fieldNames())
    assert tables.visit_log(spark, SF_SMALL).columns == [
        f for f in schemas.VISIT_LOG.fieldNames() if f in tables.visit_log(spark, SF_SMALL).columns]


def test_column_types_match_the_oracle(spark, duck):
    spark_to_duck = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER"}
    bad = {}
    for name, fn in batch_queries().items():
        got = {f.name: spark_to_duck.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in fn(spark, SF_SMALL).schema.fields}
        rel = duck.sql(E.oracle_sql()[name])
        want = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        if got != want:
            bad[name] = (got, want)
    assert not bad
