"""Range statements and building updates against loops over all parameters."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import Affine, InvalidArgument, run_many
from tableferry.operators import ranges
from tableferry.operators.ranges import Cells


@pytest.mark.parametrize("n", [0, 1, 2, 5, 64, 100])
def test_cells_by_halving(spark, n):
    bounds = tuple(float(3 * k) for k in range(n))
    values = [-1.5, 0.0, 2.9, 3.0, 150.0, 1e9, float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", Cells(bounds).of(F.col("v")).alias("c")).collect()
    assert [r.c for r in rows] == [None if v is None else sum(b <= v for b in bounds) for v in values]


def drawn(seed, n_params, hot):
    """Rows and ranges with nulls, ties, empty ranges and a lower end that many ranges share."""
    draw = random.Random(seed)
    rows = [(i, draw.choice([None, draw.randrange(0, 200), 50]), draw.randrange(3)) for i in range(300)]
    params = []
    for i in range(n_params):
        low = draw.choice([50, None] if draw.random() < hot else [draw.randrange(-20, 220)])
        high = None if draw.random() < 0.05 else (low or 0) + draw.choice([-5, 0, 1, 7, 90, 400])
        params.append((low, high, draw.choice([None, *range(10)]), f"p{draw.randrange(40)}", draw.randrange(3)))
    return rows, params


def fits(v, low, high, open_low=False, open_high=False):
    return v is not None and (open_low or low is not None and v >= low) and (open_high or high is not None and v <= high)


@pytest.mark.parametrize("ends,keyed,n_params,a_cell", [
    (("low", "high"), False, 150, 1), (("low", "high"), True, 150, 1), (("low", None), False, 60, 1), ((None, "high"), True, 60, 2), (("low", "high"), False, 0, 16)])
def test_ranges_equal_loops(spark, monkeypatch, ends, keyed, n_params, a_cell):
    monkeypatch.setattr(ranges, "RANGES_A_CELL", a_cell)
    rows, params = drawn(n_params + a_cell, n_params, 0.4)
    target = spark.createDataFrame(rows, "id int, v int, k int").withColumn("name", F.lit("own"))
    table = spark.createDataFrame(params, "low int, high int, seq int, new string, key int")
    on, between = ({"k": "key"} if keyed else {}), {"v": ends}
    is_open = [e is None for e in ends]
    hits = {i: [p for p in params if fits(v, p[0], p[1], *is_open) and (not keyed or p[4] == k)] for i, v, k in rows}

    got = run_many(target, table, on, "select", between=between)
    assert sorted((r.id, r.new) for r in got.frame.collect()) == sorted((i, p[3]) for i, ps in hits.items() for p in ps)
    assert got.affected.first().n == sum(map(len, hits.values()))

    got = run_many(target, table, on, "delete", between=between)
    assert sorted(r.id for r in got.frame.collect()) == [i for i, ps in hits.items() if not ps]
    assert got.affected.first().n == sum(bool(ps) for ps in hits.values())

    got = run_many(target, table, on, "delete", between=between, where="new > 'p2'")
    assert sorted(r.id for r in got.frame.collect()) == [i for i, ps in hits.items() if not any(p[3] > "p2" for p in ps)]

    got = run_many(target, table, on, "update", assign={"name": "new"}, order_by="seq", between=between)
    last = {i: max(ps, key=lambda p: (p[2] is not None, p[2] or 0, p[3]))[3] if ps else "own" for i, ps in hits.items()}
    assert {r.id: r.name for r in got.frame.collect()} == last and got.frame.columns == target.columns
    assert got.affected.first().n == sum(map(len, hits.values()))


@pytest.mark.parametrize("ends,keyed", [(("low", "high"), False), (("low", "high"), True), (("low", None), False), ((None, "high"), False)])
def test_cells_cut_again_equal_loops(spark, monkeypatch, ends, keyed):
    """More ranges than the cells of quantiles are enough for; some ends are not finite, some come often."""
    monkeypatch.setattr(ranges, "RANGES_A_CELL", 1)
    monkeypatch.setattr(ranges, "MOST_CELLS", 4)
    rows, params = drawn(7, 400, 0.3)
    odd = [float("inf"), float("-inf"), float("nan")]
    rows = [(i, None if v is None else float(v), k) for i, v, k in rows] + [(300 + i, v, 0) for i, v in enumerate(odd[:2])]
    params = [tuple(None if x is None else float(x) for x in p[:2]) + p[2:] for p in params] + [(odd[1], odd[0], 3, "p7", 0), (60.0, odd[0], 2, "p8", 1)]
    target = spark.createDataFrame(rows, "id int, v double, k int").withColumn("name", F.lit("own"))
    table = spark.createDataFrame(params, "low double, high double, seq int, new string, key int")
    on, is_open = ({"k": "key"} if keyed else {}), [e is None for e in ends]
    hits = {i: [p for p in params if fits(v, p[0], p[1], *is_open) and (not keyed or p[4] == k)] for i, v, k in rows}
    got = run_many(target, table, on, "update", assign={"name": "new"}, order_by="seq", between={"v": ends})
    last = {i: max(ps, key=lambda p: (p[2] is not None, p[2] or 0, p[3]))[3] if ps else "own" for i, ps in hits.items()}
    assert {r.id: r.name for r in got.frame.collect()} == last
    assert got.affected.first().n == sum(map(len, hits.values()))
    got = run_many(target, table, on, "delete", between={"v": ends})
    assert sorted(r.id for r in got.frame.collect()) == [i for i, ps in hits.items() if not ps]


@pytest.mark.parametrize("n", [1000, 8000])
def test_rows_meet_few_pieces_however_many_ranges(spark, monkeypatch, n):
    monkeypatch.setattr(ranges, "RANGES_A_CELL", 2)
    monkeypatch.setattr(ranges, "MOST_CELLS", 16)
    target = spark.range(10).selectExpr("double(id) AS v")
    # All begin at few values and end at many; half of the ends lie close together.
    table = spark.range(n).selectExpr("double(id % 5) AS low", "IF(id % 2 = 0, 5 + id / 1000000, 5D + id) AS high")
    found = ranges.ranges_of(target, table, {}, {"v": ("low", "high")}, [])
    assert ranges.covered(found, F.lit(True)).agg(F.max(F.size("__pieces"))).first()[0] <= 16


def test_ranges_of_other_types(spark):
    day = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([(i, day + dt.timedelta(i), decimal.Decimal(i) / 4) for i in range(20)], "id int, d date, x decimal(9,2)")
    table = spark.createDataFrame([(day, day + dt.timedelta(2), decimal.Decimal("1.25"), 2.0)], "a date, b date, c decimal(5,2), e double")
    assert sorted(r.id for r in run_many(rows, table, {}, between={"d": ("a", "b")}).frame.collect()) == [0, 1, 2]
    assert sorted(r.id for r in run_many(rows, table, {}, between={"x": ("c", "e")}).frame.collect()) == [5, 6, 7, 8]
    # Numbers beyond the precision of a double share a cell and are told apart there.
    large = spark.createDataFrame([(2**62 + i,) for i in range(6)], "v bigint")
    ends = spark.createDataFrame([(2**62 + i, 2**62 + i + 1) for i in range(0, 6, 3)], "a bigint, b bigint")
    assert sorted(r.v - 2**62 for r in run_many(large, ends, {}, between={"v": ("a", "b")}).frame.collect()) == [0, 1, 3, 4]


def test_refused_ranges(spark):
    rows, table = spark.createDataFrame([(1, "x")], "v int, s string"), spark.createDataFrame([(1, 2, "y")], "a int, b int, t string")
    for between in ({"s": ("t", "t")}, {"v": (None, None)}, {"v": ("a", "b"), "s": ("t", None)}, {"v": ("a", "t")}):
        with pytest.raises(InvalidArgument):
            run_many(rows, table, {}, "delete", between=between)
    with pytest.raises(InvalidArgument):
        run_many(rows, table, {}, "update", assign={"s": "t"}, between={"v": ("a", "b")})
    with pytest.raises(InvalidArgument):
        run_many(rows, table, {}, "update", assign={"v": Affine(plus="a")}, order_by="a", between={"v": ("a", "b")})


def test_no_row_meets_more_than_one_partner(spark):
    """Thousands of ranges around each value: an update's join still gives every row once."""
    target = spark.range(500).selectExpr("CAST(id AS INT) AS v", "'own' AS name")
    table = spark.range(4000).selectExpr("CAST(id % 7 AS INT) AS low", "CAST(400 + id % 90 AS INT) AS high", "id AS seq", "CAST(id AS STRING) AS new")
    frame = run_many(target, table, {}, "update", assign={"name": "new"}, order_by="seq", between={"v": ("low", "high")}).frame
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    rows = {r.v: r.name for r in frame.collect()}
    for v in (0, 3, 6, 250, 400, 450, 489, 499):
        fit = [i for i in range(4000) if i % 7 <= v <= 400 + i % 90]
        assert rows[v] == (str(fit[-1]) if fit else "own")


@pytest.mark.parametrize("kind", ["bigint", "decimal(12,2)", "double"])
def test_changes_build_up_in_order(spark, kind):
    draw = random.Random(kind)
    rows = [(i, draw.choice([None, i])) for i in range(30)]
    changes = [(draw.choice([None, *range(25)]), draw.choice([None, *range(6)]), draw.choice([1, 1, 2, None]), draw.choice([0, 1, 5, None]), draw.random() < 0.2)
               for _ in range(250)]
    # A key with a third of all changes, of one order.
    changes += [(3, 9, 1, 1, False)] * 120
    target = spark.createDataFrame(rows, "k int, v int").withColumn("v", F.col("v").cast(kind)).withColumn("s", F.lit("a"))
    table = spark.createDataFrame(changes, "key int, seq int, times int, plus int, fresh boolean").repartition(5)
    got = run_many(target, table, {"k": "key"}, "update", order_by="seq",
                   assign={"v": Affine(plus="plus", times="times", fresh="fresh"), "s": "seq"})
    want = {}
    for k, v in rows:
        # Of equal orders: not fresh first, then by factor and summand, nulls before numbers; a fresh value has factor 0.
        number = lambda x: (x is not None, x or 0)
        own = sorted((c for c in changes if c[0] == k), key=lambda c: (number(c[1]), c[4], number(0 if c[4] else c[2]), number(c[3])))
        for _, _, times, plus, fresh in own:
            v = plus if fresh else (None if None in (v, times, plus) else v * times + plus)
        want[k] = (v, own[-1][1] if own else "a")
    assert {r.k: (r.v if r.v is None else int(r.v), r.s if r.s == "a" or r.s is None else int(r.s)) for r in got.frame.collect()} == want
    assert got.affected.first().n == sum(c[0] is not None and c[0] < 30 for c in changes)
    assert got.frame.schema["v"].dataType.simpleString() == kind


def test_increments_of_text_are_refused(spark):
    target, table = spark.createDataFrame([(1, "x")], "k int, s string"), spark.createDataFrame([(1, 1)], "key int, p int")
    with pytest.raises(InvalidArgument):
        run_many(target, table, {"k": "key"}, "update", assign={"s": Affine(plus="p")}, order_by="p")


def test_a_dense_select_is_stored_in_a_few_bits_a_row(spark, tmp_path, monkeypatch):
    """20,000 rows in no order of their values and 4,000 ranges that hold a twentieth of them each, of which a file's dictionary takes 2,048, as it takes 131,072 of many more."""
    monkeypatch.setattr(ranges, "ROWS_A_TASK", 1000, raising=False)
    target = spark.range(20_000).select(((F.col("id") * 2_654_435_761) % 1_000_003).alias("id"), F.col("id").cast("double").alias("v")).repartition(2, "id")
    table = spark.range(4000).select((F.col("id") * 7919 % 1_000_003).alias("p"), (F.col("id") * 7919 % 4000 * 4.75).alias("low")).withColumn("high", F.col("low") + 1000)
    frame = run_many(target, table, {}, "select", between={"v": ("low", "high")}).frame.select("p", "id", "v")
    frame.write.option("parquet.dictionary.page.size", 16_384).parquet(str(tmp_path / "out"))
    stored = 8 * sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet"))
    rows = spark.read.parquet(str(tmp_path / "out")).count()
    assert rows == sum(1 for low in range(4000) for _ in range(-(-low * 19 // 4), min(19_999, (low * 19 + 4000) // 4) + 1))
    assert stored < 6 * rows, stored / rows


def test_a_hot_value_is_dealt_to_shares(spark, monkeypatch):
    monkeypatch.setattr(ranges, "ROWS_A_SHARE", 100)
    monkeypatch.setattr(ranges, "ROWS_A_TASK", 100)
    monkeypatch.setattr(ranges, "ROWS_A_BLOCK", 8)
    target = spark.range(2000).selectExpr("id", "CASE WHEN id % 10 > 0 THEN 5 ELSE id END AS v", "map('k', id) AS m")
    table = spark.createDataFrame([(1, 5, 5), (2, 0, 4), (3, 5, 700), (4, None, 9), (5, 6, 3)], "p int, low int, high int")
    got = run_many(target, table, {}, "select", between={"v": ("low", "high")})
    kept = got.frame.select("p", "id", "v", F.col("m")["k"].alias("k"), F.spark_partition_id().alias("task")).collect()
    values = {i: 5 if i % 10 else i for i in range(2000)}
    assert sorted((r.p, r.id, r.v, r.k) for r in kept) == sorted(
        (p, i, v, i) for p, low, high in ((1, 5, 5), (2, 0, 4), (3, 5, 700)) for i, v in values.items() if low <= v <= high)
    assert got.affected.first().n == len(kept)
    assert len({r.task for r in kept if r.p == 1}) > 4


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_blocks_keep_rows_with_nulls_and_the_schema(spark, monkeypatch, broadcast):
    monkeypatch.setattr(ranges, "RANGES_A_CELL", 1)
    monkeypatch.setattr(ranges, "ROWS_A_BLOCK", 4)
    draw = random.Random(7)
    nan = float("nan")
    rows = [(draw.randrange(40), draw.choice([None, nan, float("inf"), -0.0, *map(float, range(30))]), draw.choice([None, "a", "b"])) for _ in range(400)]
    params = [(i, draw.choice([None, nan, *map(float, range(30))]), draw.choice([None, nan, 40.0, *map(float, range(30))]), draw.choice([None, "a", "z"])) for i in range(60)]
    target = spark.createDataFrame(rows, "id int NOT NULL, v double, `a.b` string").withColumn("id", F.col("id").alias("id", metadata={"tag": 1}))
    table = spark.createDataFrame(params, "__p int, low double, high double, other string")
    order = lambda v: (2, 0) if v is None else (1, 0) if v != v else (0, v)
    fits = lambda v, low, high: None not in (v, low, high) and order(low) <= order(v) <= order(high)
    text = lambda x: tuple(map(repr, x))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        frame = run_many(target, table, {}, "select", between={"v": ("low", "high")}, where="other IS NULL OR other <> `a.b`").frame
        assert frame.schema == T.StructType([*table.schema, *target.schema])
        assert sorted(text(r) for r in frame.collect()) == sorted(
            text((*p, *r)) for r in rows for p in params if fits(r[1], p[1], p[2]) and (p[3] is None or r[2] is not None and p[3] != r[2]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
