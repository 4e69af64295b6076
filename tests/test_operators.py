import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gristmill.operators import aggregates, cleaning, joins, ordered, quality, reshape, windows
from tests.conftest import rows, same


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds a third of the rows, and in it one value a third again."""
    from gristmill.scratch import materialize

    df = spark.range(9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("g"),
        F.when(F.col("id") % 9 == 0, 50.0).otherwise((F.col("id") * 7919 % 1000) / 10).alias("x"),
    )
    edge = spark.createDataFrame([(9001, None, 1.0), (9002, 0, None), (9003, None, None)], "id bigint, g bigint, x double")
    return materialize(df.union(edge), "skewed")


def over(groups, descending=True):
    order = F.desc_nulls_first("x") if descending else F.asc_nulls_last("x")
    return Window.partitionBy(*groups).orderBy(order)


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks_match_windows(skewed, groups, descending):
    window = over(groups, descending)
    want = skewed.withColumns({"r": F.rank().over(window).cast("bigint"), "d": F.dense_rank().over(window).cast("bigint")})
    same(ordered.ranks(skewed, groups, "x", "r", "d", descending), want)


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_positions_and_tiles_match_windows(skewed, groups):
    order = [F.asc_nulls_last("x"), F.asc("id")]
    window = Window.partitionBy(*groups).orderBy(*order)
    same(ordered.positions(skewed, groups, order, "n"), skewed.withColumn("n", F.row_number().over(window).cast("bigint")))
    same(ordered.tiles(skewed, groups, order, 7, "t"), skewed.withColumn("t", F.ntile(7).over(window)))


def test_more_tiles_than_rows(spark):
    few = spark.range(3)
    got = ordered.tiles(few, [], [F.asc("id")], 5, "t")
    same(got, few.withColumn("t", F.ntile(5).over(Window.orderBy("id"))))


def test_totals_before_matches_window(skewed):
    order = [F.asc("id")]
    window = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    df = skewed.withColumn("w", F.col("id") % 11)
    want = df.withColumn("before", F.coalesce(F.sum("w").over(window), F.lit(0)))
    same(ordered.totals_before(df, ["g"], order, {"before": "w"}), want)
    with pytest.raises(ValueError):
        ordered.totals_before(df.withColumn("__range", F.lit(1)), ["g"], order, {"before": "w"})


def test_medians_match_builtin(skewed):
    want = skewed.groupBy("g").agg(F.median("x").alias("median_x"), F.median("id").alias("median_id"))
    same(ordered.medians(skewed, ["g"], ["x", "id"]), want)


def test_smallest_share_takes_the_exact_share(skewed):
    flagged = ordered.smallest_share(skewed.where("g IS NOT NULL"), "g", ["id"], 0.25, "t")
    got = flagged.groupBy("g").agg(F.count("*").alias("n"), F.count_if("t").alias("k")).collect()
    assert all(r["k"] == int(r["n"] * 0.25 + 0.5) for r in got)


@pytest.mark.parametrize("share", [0.0, 0.25, 0.6, 1.0])
def test_smallest_hashes_equal_sorted_rows(spark, share):
    rows = [(None if i % 11 == 0 else i % 3, i, None if i == 40 else f"{(i // 2 * 7919) % 4096:03x}") for i in range(200)]
    df = spark.createDataFrame(rows, "g int, id int, h string")
    got = {r["id"]: r["t"] for r in ordered.smallest_hashes(df, "g", "h", "id", share, "t", step=1).collect()}
    want = {}
    for g in (None, 0, 1, 2):
        own = sorted((h or "", i) for x, i, h in rows if x == g)
        want |= {i: n < int(len(own) * share + 0.5) for n, (_, i) in enumerate(own)}
    assert got == want
    assert ordered.smallest_hashes(df.limit(0), "g", "h", "id", share, "t").count() == 0


def test_gated_write_equals_the_gate_and_reads_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = [(i % 7 or None, None if i % 5 == 0 else "x", i - 3) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, name string, n int")
    gate = (["k", "name"], {"n": F.col("n") <= 0})
    written, checks = quality.gated_write(df.mapInArrow(counted, df.schema), "k", *gate)
    same(checks, quality.load_gate(df, "k", *gate))
    same(written, df)
    assert reads.value == 40
    with pytest.raises(quality.GateError):
        quality.require_gate(checks)


def test_auc_matches_pair_count(spark):
    scores = [(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1), (0.8, 1), (0.8, 0), (0.9, 1)]
    df = spark.createDataFrame(scores, "s double, y int")
    pos, neg = [s for s, y in scores if y], [s for s, y in scores if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert ordered.area_under_curve(df, "s", "y").first()["auc"] == pytest.approx(want)
    assert ordered.area_under_curve(df.where("y = 1"), "s", "y").first()["auc"] is None


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_top_ranks_keep_all_ties(skewed, groups):
    want = skewed.withColumn("r", F.rank().over(over(groups)).cast("bigint")).where("r BETWEEN 2 AND 6")
    same(windows.top_ranks(skewed, groups, "x", 6, "r", low=2), want)


def test_top_rows_limit_before_the_shuffle(skewed):
    top = windows.top_rows(skewed, ["g"], [F.desc("x"), F.asc("id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert "Partial" in plan


def test_group_stats_do_not_shuffle_the_rows(skewed):
    got = joins.attach_group_stats(skewed, ["g"], {"n": F.count("*"), "m": F.sum("id")})
    window = Window.partitionBy("g")
    same(got, skewed.withColumns({"n": F.count("*").over(window), "m": F.sum("id").over(window)}))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("pairs_a_task", [1_000_000, 20])
@pytest.mark.parametrize("least", [1, 2, 3])
def test_pair_counts_match_brute_force(spark, monkeypatch, pairs_a_task, least):
    monkeypatch.setattr(joins, "PAIRS_A_TASK", pairs_a_task)
    a = spark.range(600).selectExpr("id % 37 AS k", "id * 31 % 11 AS a")
    a = a.union(spark.range(300).selectExpr("1 AS k", "id % 60 AS a"))
    b = spark.range(500).selectExpr("id % 41 AS k", "id * 17 % 7 AS b")
    b = b.union(spark.range(300).selectExpr("1 AS k", "id % 50 AS b")).union(spark.sql("SELECT 2L, NULL"))
    b = b.union(spark.range(300).selectExpr("2 AS k", "id % 50 AS b"))
    want = a.join(b, "k").where("b IS NOT NULL").groupBy("a", "b").agg(F.count_distinct("k").alias("n")).where(f"n >= {least}")
    same(joins.pair_counts(a, b, "k", "a", "b", least, "n"), want)


def test_unique_join_raises_on_repeats(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x")], "k int, r string")
    with pytest.raises(joins.RepeatedKeyError):
        joins.inner_join(left, right, ["k"], unique_left=True, unique_right=True)
    assert joins.inner_join(left, right, ["k"], unique_right=True).count() == 2


def test_keep_first_and_repeats(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c"), (None, 1, "d"), (None, 2, "e")], "k int, o int, v string")
    assert rows(cleaning.keep_first(df, ["k"], [F.asc("o")]), "v") == [("a",), ("c",), ("d",)]
    assert rows(quality.duplicate_rows(df, ["k"])) == [(4, 2)]
    assert rows(cleaning.rows_of_duplicated_keys(df.where("k IS NOT NULL"), ["k"]), "v") == [("a",), ("b",)]


def test_missing_values_break_no_rule(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "b double")
    rule = {"negative": F.col("b") < 0}
    assert rows(cleaning.keep_valid(df, rule)) == [(1.0,), (None,)]
    assert rows(quality.rule_violations(df, rule)) == [("negative", 1)]


def test_profile_rounds_half_even(spark):
    df = spark.createDataFrame([(None, 1)] + [("x", 1)] * 7, "a string, b int")
    assert rows(quality.missing_profile(df)) == [("a", "string", 1, 12.5), ("b", "int", 0, 0.0)]
    assert quality.missing_worst_first(df).first()["column_name"] == "a"


def test_gate(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, t string")
    gate = quality.load_gate(df, "k", ["t"], {"short": F.length("t") > 5})
    assert dict(rows(gate)) == {"row_count": 2, "duplicate_k": 1, "missing_t": 1, "invalid_short": 0}
    with pytest.raises(quality.GateError):
        quality.require_gate(gate)
    quality.require_gate(quality.load_gate(df.limit(1), "k", ["k"], {}))


def test_grain_counts_null_parts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a"), (1, "a")], "a int, b string")
    assert rows(quality.grain_proof(df, ["a", "b"], ("n", "d", "r"))) == [(4, 3, 1)]


def test_join_report_matches_join(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, None), (1, "x"), (3, "y"), (None, "z")], "k int, v string")
    got = joins.join_report(left, right, ["k"], "v").first().asDict()
    joined = left.join(right, "k")
    assert got["joined_rows"] == joined.count() == 4
    assert got["joined_missing"] == joined.where("v IS NULL").count()
    assert (got["left_rows"], got["right_rows"], got["left_repeats"], got["right_repeats"]) == (4, 4, 1, 1)


def test_pivot_and_long(spark):
    df = spark.createDataFrame(
        [(1990, "violin", "A"), (1990, "violin", None), (2000, "harbour", "B"), (2000, "rare", "C"), (2000, "harbour", "D"), (None, "violin", "E")],
        "decade int, word string, title string",
    )
    wide = reshape.count_pivot(df, "decade", "word", "title", 2)
    assert rows(wide, "decade", "harbour", "violin") == [(1990, 0, 1), (2000, 2, 0)]
    long = reshape.to_long(wide, ["decade"], ["harbour", "violin"])
    assert rows(long) == [(1990, "harbour", 0.0), (1990, "violin", 1.0), (2000, "harbour", 2.0), (2000, "violin", 0.0)]
    assert rows(aggregates.keep_top_values(df, "word", 1), "word") == [("violin",)] * 3


def test_shares_and_rates(spark):
    df = spark.createDataFrame([("a", 1, "t")] * 3 + [("b", 0, "t")] * 1 + [(None, 1, "t")], "g string, f int, k string")
    assert rows(aggregates.supported_rate(df, "g", "k", "f", 2)) == [("a", 3, 1.0)]
    total = aggregates.value_shares(df, "g", "n", "pct", 100.0).agg(F.sum("pct")).first()[0]
    assert total == pytest.approx(100)


def test_neighbours_use_present_rows(spark):
    df = spark.createDataFrame([("d", 2020, 1, 5), ("d", 2020, 3, 9), ("e", 2020, 1, 1)], "g string, y int, s int, n int")
    got = windows.neighbours(df, ["g"], [F.asc("y"), F.asc("s")], "n", previous="p", change="c")
    assert rows(got, "g", "s", "p", "c") == [("d", 1, None, None), ("d", 3, 5, 4), ("e", 1, None, None)]


@pytest.mark.parametrize("groups", [["g"], []])
def test_neighbours_and_frames_equal_windows(spark, monkeypatch, groups):
    """Blocks of seven rows against windows over whole groups."""
    monkeypatch.setattr(windows, "BLOCK_ROWS", 7)
    df = spark.range(200).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'a' ELSE 'b' END AS g",
                                     "CASE WHEN id % 5 > 0 AND id > 9 THEN id * 37 % 41 END AS v").repartition(4)
    order, whole = [F.asc("id")], Window.partitionBy(*groups).orderBy("id")
    got = windows.neighbours(df, groups, order, "v", previous="p", following="f", change="c")
    want = df.withColumns({"p": F.lag("v").over(whole), "f": F.lead("v").over(whole), "c": F.col("v") - F.lag("v").over(whole)})
    same(got, want)
    same(windows.moving(df, groups, order, "v", 6, {"m": "max", "n": "count"}),
         df.withColumns({"m": F.max("v").over(whole.rowsBetween(-5, 0)), "n": F.count("v").over(whole.rowsBetween(-5, 0))}))
    same(windows.running(df, groups, order, "v", "s"), df.withColumn("s", F.sum("v").over(whole.rowsBetween(Window.unboundedPreceding, 0))))
    tied = Window.partitionBy(*groups).orderBy("v").rangeBetween(Window.unboundedPreceding, 0)
    present = df.where("v IS NOT NULL")
    same(windows.running(present, groups, [F.asc("v")], "id", "s", by_range=["v"]), present.withColumn("s", F.sum("id").over(tied)))
    ends = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same(windows.ends_of_series(df, groups, order, "id", "a", "z"),
         df.withColumns({"a": F.first("id").over(ends), "z": F.last("id").over(ends)}))
    with pytest.raises(ValueError, match="reach"):
        windows.moving(df, groups, order, "v", 20, {"m": "max"})


@pytest.mark.parametrize("groups", [["g"], []])
def test_looks_along_a_series_equal_windows_and_number_the_rows_once(spark, monkeypatch, groups):
    monkeypatch.setattr(windows, "BLOCK_ROWS", 7)
    numbered = []
    monkeypatch.setattr(windows, "positions", lambda *a, own=windows.positions: numbered.append(a) or own(*a))
    df = spark.range(200).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'a' ELSE 'b' END AS g",
                                     "CASE WHEN id % 5 > 0 AND id > 30 THEN id * 37 % 41 END AS v").repartition(4)
    whole = Window.partitionBy(*groups).orderBy("id")
    ends = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    frames = {"p": ("max", "v", -1, -1), "f": ("max", "v", 1, 1), "m": ("min", "v", -4, 0), "n": ("count", "v", -2, 3)}
    got = windows.along(df, groups, [F.asc("id")], frames, {"s": "v"}, {"v": ("a", "z")})
    same(got, df.withColumns({
        "p": F.lag("v").over(whole), "f": F.lead("v").over(whole), "m": F.min("v").over(whole.rowsBetween(-4, 0)),
        "n": F.count("v").over(whole.rowsBetween(-2, 3)), "s": F.sum("v").over(whole.rowsBetween(Window.unboundedPreceding, 0)),
        "a": F.first("v").over(ends), "z": F.last("v").over(ends),
    }))
    assert len(numbered) == 1
    same(windows.along(df, groups, [F.asc("id")], {"p": ("max", "v", -1, -1)}), df.withColumn("p", F.lag("v").over(whole)))


def test_shares_and_top_values_read_their_input_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(100).selectExpr("id % 4 AS g").mapInArrow(seen, "g long")
    assert {r["n"] for r in aggregates.value_shares(df, "g", "n", "r").collect()} == {25} and read.value == 100
    assert aggregates.keep_top_values(df, "g", 2).count() == 50 and read.value == 200
    unique = spark.range(50).selectExpr("id AS g").mapInArrow(seen, "g long")
    assert joins.inner_join(unique, unique, ["g"], unique_left=True).count() == 50 and read.value == 300


def test_positions_move_rows_once(spark):
    """A hot group over many ranges, a null group and many small ones; rows are shuffled by range alone."""
    values = [(None if i % 7 == 0 else "hot" if i % 3 else f"g{i % 40}", i * 37 % 5000) for i in range(5000)]
    df = spark.createDataFrame(values, "g string, v int").repartition(6)
    placed = ordered.positions(df, ["g"], [F.col("v").asc()], "place")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    expected = {}
    for g in {g for g, _ in values}:
        for place, v in enumerate(sorted(v for h, v in values if h == g), 1):
            expected[g, v] = place
    assert {(r["g"], r["v"]): r["place"] for r in placed.collect()} == expected
    assert ordered.positions(df.limit(0), ["g"], [F.col("v").asc()], "place").count() == 0


def test_wide_correlations_equal_those_of_pairs(spark):
    import random

    random.seed(4)
    names = [f"v{i}" for i in range(12)] + ["flat", "empty", "once"]
    values = [
        [None if random.random() < 0.2 else 1e6 + i + random.gauss(0, 1) for i in range(12)] + [0.1, None, 3.0 if k == 5 else None]
        for k in range(300)
    ]
    df = spark.createDataFrame(values, ", ".join(f"{n} double" for n in names)).repartition(4)
    wide = {(r["feature"], r["other"]): r["corr"] for r in aggregates.wide_correlations(df, names).collect()}
    pairs = {(r["feature"], r["other"]): r["corr"] for r in aggregates.correlations(df, names).collect()}
    assert wide.keys() == pairs.keys()
    for pair, value in pairs.items():
        if {"flat", "empty", "once"} & set(pair):
            assert wide[pair] is None and value is None
        else:
            assert wide[pair] == pytest.approx(value, abs=1e-9)
    odd = spark.createDataFrame([(1.0, 2.0, None), (float("nan"), 3.0, 1.0), (2.0, 5.0, 2.0), (None, 1.0, 3.0)], "a double, b double, c double")
    got = {(r["feature"], r["other"]): r["corr"] for r in aggregates.wide_correlations(odd, ["a", "b", "c"]).collect()}
    assert got["a", "b"] != got["a", "b"] and got["b", "c"] == pytest.approx(-0.5)
    assert all(r["corr"] is None for r in aggregates.wide_correlations(odd.limit(0), ["a", "b"]).collect())


def test_wide_correlations_of_two_hundred_columns(spark):
    names = [f"v{i}" for i in range(200)]
    df = spark.range(400).select(*[F.cos(F.col("id") * (i + 1)).alias(n) for i, n in enumerate(names)])
    got = aggregates.wide_correlations(df, names)
    assert got.count() == 40_000
    want = df.agg(F.corr("v3", "v150")).first()[0]
    assert got.where("feature = 'v3' AND other = 'v150'").first()["corr"] == pytest.approx(want, abs=1e-9)
