"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from driftglass import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["events", "lineitem", "orders"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_query_equals_sql(spark, con, name):
    got, want = catalog.queries()[name](spark, SF).toArrow(), con.sql(catalog.oracles()[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    rows = lambda t: sorted(str(tuple(r[c] for c in columns)) for r in t.to_pylist())
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracles())))
def test_other_queries_run(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_sorted_dates_has_no_cap(spark, con):
    got = [r.dt for r in catalog.queries()["sorted_dates"](spark, SF).collect()]
    n = con.sql("SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders").fetchall()[0][0]
    assert len(got) == n > 500 and got == sorted(got)


def test_ranked_runs_with_halfway_means(spark, tmp_path):
    """Values in cents, 16 a user: every mean lies halfway between two roundings. Two files share the users; one has no value, one seven digits."""
    con = duckdb.connect()
    con.sql("SET threads = 1")
    con.sql("""CREATE TABLE events AS SELECT k * 500 + u AS event_id, CASE u WHEN 499 THEN 1234567 ELSE u END AS user_id,
      CASE WHEN u <> 498 THEN ((k * 7919 + u * 104729) % 9973 * 16 + CASE k WHEN 0 THEN 2 * (u % 8 * 2 + 1) ELSE 0 END) / 100 END AS value FROM range(500) a(u), range(16) b(k) ORDER BY 1""")
    (tmp_path / "events.parquet").mkdir()
    for n, part in enumerate(("event_id < 3300", "event_id >= 3300")):
        con.sql(f"COPY (FROM events WHERE {part} ORDER BY event_id) TO '{tmp_path}/events.parquet/{n}.parquet' (FORMAT parquet)")
    got, want = catalog.queries()["ranked_runs"](spark, str(tmp_path)).collect(), con.sql(catalog.oracles()["ranked_runs"]).fetchall()
    assert {r.run_id: r.value for r in got} == {w[0]: w[3] for w in want}
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(want) == 500
