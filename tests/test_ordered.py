"""The running scan against brute force, with and without slicing."""

import random

import pytest

from chalkline.operators import mastery
from chalkline.operators.ordered import Scan, hot_groups, ordered_scan

SCAN = Scan(
    running_max={"best": "v"}, running_sum={"total": "w"}, running_count="n", previous={"prev": "v"}, group_size="size"
)


def brute(data):
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    out = []
    for members in groups.values():
        members = sorted(members, key=lambda r: (r[1] is None, r[1] or "", r[2]))
        best = total = prev = None
        for n, (k, d, i, v, w) in enumerate(members, 1):
            best = v if best is None else best if v is None else max(best, v)
            total = w if total is None else total if w is None else total + w
            out.append((k, d, i, v, w, best, total, n, prev, len(members)))
            prev = v
    return out


def as_key(row):
    return [(v is None, str(v)) for v in row]


@pytest.mark.parametrize("hot_rows", [10_000, 40, 7])
def test_matches_brute_force(spark, hot_rows):
    rng = random.Random(hot_rows)
    data = []
    for i in range(400):
        key = rng.choice(["hot"] * 6 + [None] * 3 + list("abc"))
        day = rng.choice([None, "2025-01-01", "2025-01-02", "2025-02-01"])
        data.append((key, day, i, rng.choice([None, *range(50)]), rng.choice([None, 1, 2])))
    df = spark.createDataFrame(data, "k string, d string, i int, v int, w int").repartition(5)
    got = ordered_scan(df, ["k"], ["d", "i"], SCAN, hot_rows).select(
        "k", "d", "i", "v", "w", "best", "total", "n", "prev", "size"
    )
    assert sorted((tuple(r) for r in got.collect()), key=as_key) == sorted(brute(data), key=as_key)


def test_identical_copies_are_split_and_counted(spark):
    """One group made of copies of one row: every count occurs once."""
    df = spark.range(500).selectExpr("'x' AS k", "'2025-01-01' AS d", "1.0D AS v")
    out = ordered_scan(df, ["k"], ["d"], Scan(running_max={"best": "v"}, running_count="n"), hot_rows=50)
    got = out.collect()
    assert sorted(r.n for r in got) == list(range(1, 501))
    assert {r.best for r in got} == {1.0}


def test_hot_groups_are_found_by_size(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 6, "k string")
    sizes, groups, total = hot_groups(df, ["k"], 4)
    assert (groups, total) == (2, 11)
    assert {(r[0], r[1]) for r in sizes.collect()} == {("a", 5), (None, 6)}
    assert hot_groups(df, ["k"], 6) is None


def test_two_keys_and_streaks(spark, rows):
    values = [1, 1, 9, 1, 1, 1, 9, 9]
    data = [("s", "t", i, v) for i, v in enumerate(values)] + [("s", "u", 0, 9)]
    df = spark.createDataFrame(data, "a string, b string, i int, v int")
    for hot_rows in (100, 2):
        out = mastery.longest_streak(df, ["a", "b"], ["i"], df.v < 5, hot_rows=hot_rows)
        assert rows(out) == [("s", "t", 3), ("s", "u", 0)]


@pytest.mark.parametrize("hot_rows", [100, 2])
def test_trend_halves(spark, rows, hot_rows):
    data = [("one", 1, 10.0)] + [("three", i, v) for i, v in ((1, 90.0), (2, 60.0), (3, 30.0))]
    df = spark.createDataFrame(data, "s string, d int, max_score_to_date double")
    out = mastery.halves_trend(df, "s", ["d"], hot_rows=hot_rows)
    assert rows(out) == [("three", 90.0, 45.0)]


def test_falling_best_finds_planted_drop(spark, rows):
    df = spark.createDataFrame([("s", 1, 5.0), ("s", 2, 7.0), ("s", 3, 6.0)], "s string, d int, max_score_to_date double")
    for hot_rows in (100, 1):
        out = mastery.falling_best(df, ["s"], ["d"], hot_rows=hot_rows)
        assert rows(out, "d", "prev_max") == [(3, 7.0)]


def test_hot_and_usual_path_agree_on_events(spark, rows):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "event_type", "ts", "value")
    outs = [
        mastery.running_best(events, ["event_type"], "ts", "value", ["event_id"], hot_rows=n).drop("ts") for n in (10**9, 20)
    ]
    assert rows(outs[0]) == rows(outs[1])


def jobs_started(spark, build):
    """Jobs that run while a plan is built."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    df = build()
    return df, len(set(tracker.getJobIdsForGroup(None)) - before)


def test_plans_are_built_without_a_job(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS d", "id AS v")
    _, jobs = jobs_started(spark, lambda: ordered_scan(df, ["k"], ["d"], SCAN_OF_V, 10))
    assert jobs == 0


SCAN_OF_V = Scan(running_max={"best": "v"}, running_count="n")


def test_carrying_is_dropped_where_no_group_is_hot(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_id", "value")
    out = ordered_scan(df, ["user_id"], ["ts", "event_id"], Scan(running_max={"best": "value"}))
    assert out.count() == df.count()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Window") == 1 and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("hot_rows", [10_000, 9])
def test_ties_fall_alike_whether_sliced_or_not(spark, rows, hot_rows):
    data = [("k", i // 40, v, 100 * i) for i, v in enumerate(random.Random(2).choices(range(9), k=200))]
    out = ordered_scan(spark.createDataFrame(data, "k string, d int, v int, id int").repartition(3), ["k"], ["d"], SCAN_OF_V, hot_rows)
    want, best = [], -1
    for n, row in enumerate(sorted(data, key=lambda r: (r[1], r[2], r[3])), 1):
        best = max(best, row[2])
        want.append((*row, best, n))
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)


def test_running_sums_of_doubles_are_refused(spark):
    df = spark.createDataFrame([("a", 1, 0.1)], "k string, d int, v double")
    with pytest.raises(ValueError, match="decimals"):
        ordered_scan(df, ["k"], ["d"], Scan(running_sum={"total": "v"}))
    exact = df.withColumn("v", df.v.cast("decimal(9, 2)"))
    assert ordered_scan(exact, ["k"], ["d"], Scan(running_sum={"total": "v"}), 1).count() == 1
