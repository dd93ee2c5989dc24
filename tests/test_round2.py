"""Edges that the driver's larger tables reach: queries against their SQL on small tables of such rows."""

import duckdb
import pytest

from gridloom.queries import QUERIES, SQL


@pytest.fixture
def against(spark, tmp_path):
    """Rows of a query and of its SQL over given tables (name: SELECT)."""

    def run(name, **tables):
        con = duckdb.connect()
        for t, select in tables.items():
            con.execute(f"COPY ({select}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
        found = con.execute(SQL[name])
        names = [d[0] for d in found.description]
        key = lambda r: tuple((x is None, str(x)) for x in r)
        got = QUERIES[name](spark, str(tmp_path)).select(*(f"`{n}`" for n in names)).collect()
        return sorted((tuple(r) for r in got), key=key), sorted(found.fetchall(), key=key)

    return run


def test_series_files_follow_the_data(spark, tmp_path):
    from gridloom.sources import tables

    rows = spark.range(300).selectExpr("cast(id as int) cell_id", "0 row", "0 col", "'ndvi' si", "date'2000-01-01' + cast(id % 2 * 400 as int) date", "cast(id as int) value")
    tables.write_series(rows, f"{tmp_path}/s")
    assert len(list((tmp_path / "s").rglob("*.parquet"))) <= 20
    back = spark.read.parquet(f"{tmp_path}/s")
    assert {(r.cell_id, r.si, r.year, r.value) for r in back.collect()} == {(i, "ndvi", 2000 + i % 2, i) for i in range(300)}


EVENTS = "SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_days(CAST(i AS INTEGER)) AS ts, 1::BIGINT AS user_id, 'view' AS event_type, v AS value, '{}' AS props FROM (SELECT unnest(range(6)) AS i, unnest([20.0, 560.0, 30.0, 10.0, 600.0, 700.0]) AS v)"


@pytest.mark.parametrize("name", ["op_A14_numnegdelta", "op_A14_numposdelta"])
def test_values_beyond_the_valid_range(against, name):
    got, want = against(name, events=EVENTS)
    assert got == want


def test_points_on_the_edges_of_polygons(against):
    """Points on every edge of a triangle, where differences of two decimals round."""
    points = "SELECT row_number() OVER () AS c_custkey, '' AS c_name, n::INTEGER AS c_nationkey, round(b + d, 2) AS c_acctbal, '' AS c_mktsegment FROM (SELECT unnest([10.03, 884.56, 1234.56, 57.1, 4811.07]) AS b), (SELECT unnest([0.0, 50.0, 150.0, 250.0, 350.0, 49.99, 350.01]) AS d), range(0, 8) t(n)"
    boxes = "SELECT row_number() OVER () AS s_suppkey, '' AS s_name, n::INTEGER AS s_nationkey, b AS s_acctbal FROM (SELECT unnest([10.03, 884.56, 1234.56, 57.1, 4811.07]) AS b), range(0, 4) t(n)"
    got, want = against("op_J12_points_in_polygons", customer=points, supplier=boxes)
    assert got == want


def test_low_values_at_the_limit(spark, tmp_path):
    """Series whose 5th percentile makes a limit that a value meets."""
    from gridloom.operators import series

    con = duckdb.connect()
    # By series n values: some at 3/4 of v, then one below v and others above it, so that the percentile is v or next to it.
    con.execute("""CREATE TABLE t AS WITH p AS (SELECT px, 20 + px % 400 AS n, 4 * (1 + px % 97) AS v, px % 3 * 4 AS less FROM range(3000) r(px)), q AS (SELECT *, (n - 1) * 5 // 100 AS low, ((n - 1) * 5 % 100) / 100e0 AS part FROM p)
     SELECT px, DATE '2000-01-01' + CAST(i AS INTEGER) AS date, CAST(CASE WHEN i < low THEN v * 3 // 4 WHEN i = low THEN v - less WHEN part > 0 THEN v - less + round(less / part) ELSE v END AS INTEGER) AS value FROM q, range(419) s(i) WHERE i < n""")
    con.execute(f"COPY t TO '{tmp_path}/t.parquet' (FORMAT parquet)")
    sql = SQL["op_R6_low_values"]
    want = con.execute("WITH ts AS (SELECT * FROM t), " + sql[sql.index(" p AS (") :]).fetchall()
    got = series.low_values_to_zero(spark.read.parquet(f"{tmp_path}/t.parquet"), ["px"]).select("px", "date", "value").collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("name", ["op_index_bai", "op_index_baim"])
def test_burned_next_to_its_point(against, name):
    """Distances of a few units of the last digit, and none; powers of C may miss the last bit."""
    price = "6300.0 + (i - 50) / 100e0" if name == "op_index_bai" else "5250.0 + (i - 50) / 100e0"
    got, want = against(name, lineitem=f"SELECT i AS l_orderkey, {'0' if name == 'op_index_bai' else '20'}::BIGINT AS l_partkey, i % 7 AS l_suppkey, 1 AS l_linenumber, 5e0 AS l_quantity, round({price}, 2) AS l_extendedprice, 0e0 AS l_discount, 0e0 AS l_tax, TIMESTAMP '1995-01-01' + to_days(CAST(i AS INTEGER)) AS l_shipdate FROM range(101) r(i)")
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert any(r[2] is None for r in want)
    for (*_, a), (*_, b) in zip(got, want, strict=True):
        assert a == b or (a is not None and b is not None and abs(a - b) <= 3e-16 * abs(b))


def test_many_indices_are_no_single_method(spark):
    """Java interprets methods of more than 8,000 bytes."""
    plan = QUERIES["op_29_point_indices"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    parts = plan.debug().codegenToSeq()
    assert max([parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())], default=0) < 8000


def test_series_tasks_grow_with_rows(spark, monkeypatch):
    from gridloom.operators import series
    from gridloom.queries import base

    monkeypatch.setattr(series, "TASK_ROWS", 100)
    rows = base.ts(spark, "/root/testdata/sf0.001")
    n = base.obs(spark, "/root/testdata/sf0.001").count()
    assert rows.rdd.getNumPartitions() == n // 100 + 1
    plan = QUERIES["op_A8_maxd"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["op_J10_points_in_boxes", "op_J18_overlapping_boxes", "op_J12_points_in_polygons"])
def test_crowded_cells_are_dealt_out(spark, against, monkeypatch, name):
    from gridloom.operators import joins

    monkeypatch.setattr(joins, "TASK_PAIRS", 50)
    points = "SELECT i AS c_custkey, i % 5 AS c_nationkey, i % 50 * 10e0 AS c_acctbal FROM range(500) r(i)"
    boxes = "SELECT i AS s_suppkey, i % 3 AS s_nationkey, i % 4 * 100e0 AS s_acctbal FROM range(60) r(i)"
    got, want = against(name, customer=points, supplier=boxes)
    assert got == want and len(want) > 1000


def test_cells_fit_boxes(spark):
    """Flat boxes: cells as low as they are."""
    from gridloom.operators import joins

    boxes = spark.range(100).selectExpr("id", "0.0 x0", "cast(id as double) y0", "300.0 x1", "id + 2.0 y1")
    assert joins._cell_sides([(boxes, ["x0", "y0", "x1", "y1"])], 500.0, 0.5) == [150.0, 1.0]


def test_gaps_are_filled_in_blocks(monkeypatch):
    """A few steps for all missing values of a series, not one each; the same values by single ones."""
    import numpy as np

    from gridloom.operators import series

    r = np.random.default_rng(4)
    x = np.sort(r.choice(3000, 1200, replace=False))
    y = np.where(r.random(1200) < 0.5, np.nan, r.integers(100, 9000, 1200).astype(float))
    calls, plain = [], np.round
    monkeypatch.setattr(np, "round", lambda *a, **k: calls.append(1) or plain(*a, **k))
    got = series.prefilled(x, y)
    assert len(calls) < 10
    monkeypatch.setattr(series, "FILL_CELLS", 5000)
    assert np.array_equal(series.prefilled(x, y), got, equal_nan=True)
    for i in np.flatnonzero(np.isnan(y))[::10]:
        near = [b for a, b in zip(x, y, strict=True) if b == b and 1 <= abs(t := round((a - x[i]) / 365.25)) <= 2 and abs(a - x[i] - 365.25 * t) <= 30]
        assert got[i] == np.mean(near) if len(near) >= 2 else np.isnan(got[i])
    # The spans that count: none known, none missing.
    assert np.isnan(series.prefilled(x, y * np.nan)).all() and series.prefilled(x[:0], y[:0]).size == 0


@pytest.mark.parametrize("cells", [3, 65_536])
def test_summary_keeps_no_values(spark, monkeypatch, cells):
    """No group's values in one place; quantiles of crowded, spread and repeated values are those of a sorted list, without a season and an index as well."""
    import math

    from gridloom.operators import scores

    monkeypatch.setattr(scores, "CELLS", cells)
    rows = spark.range(6000).selectExpr(
        "case when id % 5 > 1 then 'a' when id % 5 = 1 then 'b' end si", "case id % 3 when 0 then 'dry' when 1 then 'wet' end season",
        "case when id % 5 = 1 then 7e8 + pmod(hash(id), 1000) when id % 7 = 0 then 0e0 else pow(-1, id) * pow(10, pmod(hash(id), 90) / 10) end pre", "case id % 4 when 0 then 0e0 when 1 then 3e0 else -pmod(hash(id, 1), 100000) / 7e0 end post",
    )
    out = scores.pre_post_summary(rows, ["si"], "season").select("si", "season", "n", *(f"delta_{level}" for level in scores.LEVELS))
    assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()
    # An index has one row for all seasons and one for rows without a season; they are told apart by their number.
    data, got = rows.collect(), {(r["si"], r["season"], r["n"]): r for r in out.collect()}
    want = {}
    for si in ("a", "b", None):
        for every, season in ((True, None), (False, None), (False, "dry"), (False, "wet")):
            d = sorted(r["pre"] - r["post"] for r in data if r["si"] == si and (every or r["season"] == season))
            want[si, season or "ALL", len(d)] = d
    assert got.keys() == want.keys()
    for k, d in want.items():
        for level in scores.LEVELS:
            at = (len(d) - 1) * (level / 100)
            low, high = d[math.floor(at)], d[math.ceil(at)]
            x = low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high
            assert abs(got[k][f"delta_{level}"] - x) <= 1, (k, level)


def test_summary_of_values_without_end(spark, monkeypatch):
    from gridloom.operators import scores

    rows = spark.sql("SELECT 'a' si, 'dry' season, explode(array(-double('inf'), -1e300, -1e-310, -0e0, 0e0, 5e-324, 12e0, 1.7976931348623157e308, double('inf'))) pre, 0e0 post")
    monkeypatch.setattr(scores, "LEVELS", (50, 75))
    assert {tuple(r) for r in scores.pre_post_summary(rows, ["si"], "season").select("season", "n", "delta_50", "delta_75").collect()} == {("ALL", 9, 0, 12), ("dry", 9, 0, 12)}


def test_curves_of_many_series_are_fitted_together(monkeypatch):
    """One solution a step and length for all series, with the values of single fits."""
    import numpy as np

    from gridloom.operators import series

    r = np.random.default_rng(8)
    xs = [np.sort(r.choice(400, n, replace=False)) for n in (5, 7, 20, 33) for _ in range(30)]
    ys = [2000 + 900 * np.sin(x / 58) + r.integers(0, 1500, len(x)) for x in xs]
    out = np.arange(0, 400, 25)
    calls, plain = [], np.linalg.solve
    monkeypatch.setattr(np.linalg, "solve", lambda *a: calls.append(1) or plain(*a))
    got = series._fitted("dbl", xs, ys, out, 3)
    assert len(calls) <= 3 * 40
    monkeypatch.setattr(series, "FIT_CELLS", 1000)  # few series at once
    for x, y, z in zip(xs, ys, got, strict=True):
        assert np.allclose(series.double_logistic(x, y, out), z, rtol=1e-9)
    # The fit itself, by its own formula: no worse than the first guess.
    u, y, z = (xs[-1] - xs[-1][0]) / (xs[-1][-1] - xs[-1][0]), ys[-1], series.double_logistic(xs[-1], ys[-1], xs[-1])
    guess = y.min() + np.ptp(y) * (1 / (1 + np.exp(-12 * (u - 0.3))) - 1 / (1 + np.exp(-12 * (u - 0.7))))
    assert ((z - y) ** 2).sum() < ((guess - y) ** 2).sum()


@pytest.mark.parametrize("method", ["dbl", "sg"])
def test_smoothed_series_are_dealt_out(spark, monkeypatch, method):
    """The bytes of series are few, the work is not."""
    from gridloom.operators import series

    monkeypatch.setattr(series, "TASK_ROWS", 50)
    df = QUERIES[f"op_R4_smooth_{method}"](spark, "/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert df.rdd.getNumPartitions() == n // 50 + 1
