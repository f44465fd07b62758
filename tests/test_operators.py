from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratastar import operators as op
from stratastar.session import materialise
from stratastar.functions import unknown_key

D = datetime


def test_latest_version(spark):
    rows = [("a", D(2025, 1, 1), 1), ("a", D(2025, 1, 3), 2), ("a", D(2025, 1, 2), 3), ("b", D(2025, 1, 1), 5), ("b", D(2025, 1, 1), 4)]
    rows += [("c", None, 6), ("c", D(2025, 1, 1), 7), (None, D(2025, 1, 1), 8)]
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, n int")
    assert {r.k: r.n for r in op.latest_version(df, ["k"], ["at"]).collect()} == {"a": 2, "b": 4, "c": 7}
    assert {r.k: r.n for r in op.latest_version(df, ["k"], ["at"], nulls="first").collect()} == {"a": 2, "b": 4, "c": 6}
    plan = op.latest_version(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange


def test_latest_of_extract(spark):
    rows = [("a", "2025-01-02", 1), ("a", "n/a", 2), ("b", "2025-01-01", 3), ("b", "2025-01-01", 4)]
    df = spark.createDataFrame(rows, "k string, updated_at string, n int")
    assert {r.k: r.n for r in op.latest_of_extract(df, "k", sequence="n").collect()} == {"a": 2, "b": 4}
    assert {r.k: r.n for r in op.latest_of_extract(df.drop("updated_at"), "k", sequence="n").collect()} == {"a": 2, "b": 4}
    assert op.latest_of_extract(df, "missing").count() == 4


def test_deleted_policy(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 1, False)], "k string, v int, gone boolean")
    after = op.latest_version(df, ["k"], ["v"], deleted="gone")
    before = op.latest_version(df, ["k"], ["v"], deleted="gone", deleted_policy="before")
    assert {r.k: r.v for r in after.collect()} == {"b": 1}
    assert {r.k: r.v for r in before.collect()} == {"a": 1, "b": 1}


def test_lookup_never_changes_the_row_count(spark):
    fact = spark.createDataFrame([(1, "x"), (2, None), (3, "missing")], "id int, fk string")
    dim = spark.createDataFrame([("x", "KX"), ("y", "KY")], "code string, key string")
    spec = op.Lookup("dim", "fk", "code", "key")
    for spread in (None, ["id"]):
        found = {r.id: r.key for r in op.lookup(fact, dim, spec, spread_by=spread).collect()}
        unknown = spark.range(1).select(unknown_key()).first()[0]
        assert found == {1: "KX", 2: unknown, 3: unknown}


def test_lookup_by_shuffle_with_a_hot_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fk = F.when(F.col("id") % 3 == 0, "k1").when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 700))
        fact = spark.range(0, 60000, 1, 6).select("id", fk.alias("fk"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        dim = spark.range(500).select(F.concat(F.lit("k"), "id").alias("code"), F.concat(F.lit("K"), "id").alias("key"))
        found = op.lookup(fact, dim, op.Lookup("dim", "fk", "code", "key"), spread_by=["id"])
        counts = {r.key: r["count"] for r in found.groupBy("key").count().collect()}
        unknown = spark.range(1).select(unknown_key()).first()[0]
        assert found.count() == 60000
        assert counts["K1"] == 20000 + sum(1 for i in range(60000) if i % 3 == 2 and i % 700 == 1)
        assert counts[unknown] == 20000 + sum(1 for i in range(60000) if i % 3 == 2 and i % 700 >= 500)
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_status_lookup(spark):
    statuses = op.domain_values({"A": (spark.createDataFrame([(" signee ",), ("SIGNEE",), (None,)], "s string"), "s")})
    assert sorted(r.statut_value for r in statuses.collect()) == ["SIGNEE", "__UNKNOWN__"]
    fact = spark.createDataFrame([(1, "Signee "), (2, None), (3, "OTHER")], "id int, s string")
    keys = {r.id: r.statut_key for r in op.status_lookup(fact, statuses, "A", "s", spread_by=["id"]).collect()}
    unknown = spark.range(1).select(unknown_key("A")).first()[0]
    assert keys[2] == keys[3] == unknown != keys[1]


def test_unknown_member_rejects_foreign_columns(spark):
    with pytest.raises(ValueError):
        op.with_unknown(spark.createDataFrame([(1,)], "a int"), {"b": 1})


def quality(spark, values, kinds):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    log = op.quality_log({"t": df}, [op.Check("t", "v", k) for k in kinds], F.lit("2025-01-01").cast("timestamp_ntz"))
    return {r.check_type: (r.records_checked, r.records_failed, float(r.pass_rate), r.status) for r in log.collect()}


def test_quality_log(spark):
    kinds = ["null_check", "range_check", "duplicate_check"]
    assert quality(spark, [], kinds) == {
        "null_check": (0, None, 0.0, "fail"),
        "range_check": (0, None, 0.0, "fail"),
        "duplicate_check": (0, 0, 0.0, "pass"),
    }
    assert quality(spark, range(100), kinds)["null_check"] == (100, 0, 100.0, "pass")
    assert quality(spark, [None, *range(99)], kinds)["null_check"] == (100, 1, 99.0, "warn")
    assert quality(spark, [-1] * 5 + list(range(95)), kinds)["range_check"] == (100, 5, 95.0, "fail")
    assert quality(spark, [1, 1, None, None], kinds)["duplicate_check"] == (4, 3, 25.0, "fail")


def test_data_tests(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    assert op.not_null_failures(df, "v").count() == 1
    assert [tuple(r) for r in op.unique_failures(df, "v").collect()] == [("a", 2)]
    assert [tuple(r) for r in op.accepted_values_failures(df, "v", ["a"]).collect()] == [("b", 1)]


def test_unique_failures_of_all_columns_at_once(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("b", 2, None), ("c", 2, "x"), ("c", 3, "y"), (None, 4, "z")]
    df = spark.createDataFrame(rows, "`p.q` string, n int, m string").withColumn("alone", F.monotonically_increasing_id())
    names = ["p.q", "n", "alone", "m"]
    found = {r.column_name: r.n_failures for r in op.unique_failure_counts(df, names).collect()}
    assert found == {"p.q": 2, "n": 1, "alone": 0, "m": 1}
    assert {r.n_failures for r in op.unique_failure_counts(df.where("false"), names).collect()} == {0}


def test_distinct_counts_add_up(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), rng.choice([None, 1, 2]), rng.choice([None, *range(70_000)])) for _ in range(4000)] + [("c", 1, None), ("d", 1, 5)]
    df = spark.createDataFrame(rows, "g string, h int, v int")
    numbers = op.member_numbers(df.select("v"))
    assert sorted(r.number for r in numbers.collect()) == list(range(1, len({v for *_, v in rows if v is not None}) + 1))
    state = op.distinct_state(df, ["g", "h"], F.col("v"), numbers)
    for groups in (["g", "h"], ["h"], ["g"], []):
        at = [("g", "h").index(g) for g in groups]
        expected = {}
        for row in rows:
            expected.setdefault(tuple(row[i] for i in at), set()).add(row[2])
        got = {tuple(r[g] for g in groups): r.n for r in op.distinct_counts(state, groups, "n").collect()}
        assert got == {k: len(s) for k, s in expected.items()}
        # States of two halves put under each other count each value once.
        halves = [op.distinct_state(df.where(f), ["g", "h"], F.col("v"), numbers) for f in ("v % 2 = 0", "v % 2 <> 0 or v is null or v < 100")]
        merged = op.merged_state(halves[0].unionByName(halves[1]), groups)
        assert {tuple(r[g] for g in groups): r.n for r in op.distinct_counts(merged, groups, "n").collect()} == got
    shown = op.distinct_state(df, ["g"], F.col("v"), numbers, where=F.col("v") < 5)
    assert {r.g: r.n for r in op.distinct_counts(shown, ["g"], "n").collect()} == {g: len({v for a, _, v in rows if a == g and v is not None and v < 5}) or None for g in "abcd"}
    with pytest.raises(Exception, match="no member number for 1"):
        op.distinct_counts(op.distinct_state(df.selectExpr("g", "-1 AS v"), ["g"], F.col("v").cast("string").substr(2, 9), numbers.where("false")), ["g"], "n").collect()


def test_holidays(spark):
    years = spark.createDataFrame([(2024,), (2025,), (2008,), (1954,), (1981,)], "year int")
    days = {(r.year, r.day) for r in op.public_holidays(years).collect()}
    for year, easter in {2024: date(2024, 3, 31), 2025: date(2025, 4, 20), 2008: date(2008, 3, 23), 1954: date(1954, 4, 18), 1981: date(1981, 4, 19)}.items():
        assert (year, easter + timedelta(1)) in days and (year, easter + timedelta(39)) in days and (year, easter + timedelta(50)) in days
        assert (year, date(year, 7, 14)) in days
    assert sum(1 for y, _ in days if y == 2025) == 11
    assert sum(1 for y, _ in days if y == 2008) == 10  # Ascension falls on 1 May


def test_business_days(spark):
    days = op.candidate_days(spark, date(2025, 4, 17), date(2025, 4, 23))
    assert sorted(r.day.day for r in op.business_days(days).collect()) == [17, 18, 22, 23]
    assert sorted(r.day.day for r in op.business_days(days, exclude_holidays=False).collect()) == [17, 18, 21, 22, 23]
    following = {r.day: r.business_day for r in op.next_business_day(days).collect()}
    assert following[date(2025, 4, 19)] == date(2025, 4, 22) and following[date(2025, 4, 17)] == date(2025, 4, 17)
    year_end = op.next_business_day(op.candidate_days(spark, date(2027, 12, 31), date(2028, 1, 1)))
    assert {r.day: r.business_day for r in year_end.collect()}[date(2028, 1, 1)] == date(2028, 1, 3)
    closures = op.candidate_days(spark, date(2025, 4, 17), date(2025, 5, 26))
    closed = {r.day: r.business_day for r in op.next_business_day(days, closures=closures).collect()}
    assert len(closed) == 7 and set(closed.values()) == {date(2025, 5, 27)}
    wide = op.candidate_days(spark, date(2025, 4, 1), date(2028, 4, 1))
    far = op.next_business_day(days.unionByName(spark.createDataFrame([(None,)], "day date")), closures=wide).collect()
    assert {r.business_day for r in far} == {date(2028, 4, 3)} and len(far) == 7
    assert op.next_business_day(days.where("false")).collect() == []
    with pytest.raises(ValueError):
        op.candidate_days(spark, date(2025, 1, 2), date(2025, 1, 1))
    assert op.candidate_days(spark).first().day == date.today() - timedelta(days=1)


def test_days_to_process(spark):
    days = op.candidate_days(spark, date(2025, 4, 14), date(2025, 4, 18))
    log = spark.createDataFrame([(date(2025, 4, 15),), (date(2025, 4, 15),)], "date_cible date")
    assert sorted(r.day.day for r in op.days_to_process(days, log).collect()) == [14, 16, 17, 18]
    assert op.days_to_process(days, log, force=True).count() == 5


def test_next_at_or_after_over_any_number_of_buckets(spark):
    rng = random.Random(3)
    offered = sorted(rng.sample(range(10_000), 40))
    wanted = [rng.randrange(10_500) for _ in range(500)]
    sides = [spark.createDataFrame([(v,) for v in values], "v int") for values in ([*wanted, None], [*offered, None])]
    found = op.next_at_or_after(*sides, "v", "next", lambda v: F.floor(v / 50)).collect()
    assert {(r.v, r.next) for r in found} == {(v, next((o for o in offered if o >= v), None)) for v in wanted} | {(None, None)}
    assert len(found) == len(set(wanted)) + 1


@pytest.mark.parametrize("range_rows", [1_000_000, 100, 10, 3])
def test_previous_version_with_a_hot_key(spark, range_rows):
    rng = random.Random(7)
    rows, n = [], 0
    for _ in range(4000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}"
        when = None if rng.random() < 0.01 else D(2025, 1, 1) + timedelta(minutes=rng.randrange(3000))
        rows.append((key, when, n, rng.choice("ABC")))
        n += 1
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, seq int, s string").repartition(5)
    found = op.previous_version(df, "k", ["at", "seq"], {"before": "s", "before_seq": "seq"}, range_rows=range_rows)
    expected = {}
    for key in {r[0] for r in rows}:
        last = None
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or D.min, r[2])):
            expected[r[2]] = (last[3], last[2]) if last else (None, None)
            last = r
    assert {r.seq: (r.before, r.before_seq) for r in found.collect()} == expected


def test_previous_version_at_one_instant_and_without_keys(spark):
    """All versions of one key at one instant are cut by the second order column; rows without a key have none before."""
    rows = [("hot", D(2025, 1, 1), n) for n in range(3000)] + [(None, D(2025, 1, 1), n) for n in range(3000, 3100)]
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, seq int").repartition(5)
    found = {r.seq: r.before for r in op.previous_version(df, "k", ["at", "seq"], {"before": "seq"}, range_rows=100).collect()}
    assert found == {n: n - 1 if 0 < n < 3000 else None for n in range(3100)}
    sizes = op.in_ranges(df, ["k", "at", "seq"], 100).groupBy("__range").count().collect()
    assert len(sizes) >= 28 and max(r["count"] for r in sizes) <= 400


def test_transitions_keep_moves_after_a_version_without_a_time(spark):
    rows = [("a", None, 1, "x"), ("a", D(2025, 1, 1), 2, "y"), ("a", D(2025, 1, 3), 3, "z"), ("b", None, 1, None), ("b", None, 2, "y"), (None, None, 1, "x")]
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, seq int, s string")
    found = {(r.from_status, r.to_status): (r.n_moves, r.mean_days) for r in op.status_transitions(df, "k", "s", ["at", "seq"]).collect()}
    assert found == {("x", "y"): (1, None), ("y", "z"): (1, 2.0), (None, "y"): (1, None)}


def exchanges(df, column):
    """Shuffles in the physical plan that carry a column, adaptive execution off."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, found = [plan], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange" and any(node.output().apply(i).name() == column for i in range(node.output().size())):
            found += 1
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_star_by_keys_only(spark):
    """Seven lookups, a third of each key hot, a tenth missing, a tenth unknown: one shuffle of the wide row."""
    rng = random.Random(5)
    lookups = [op.Lookup(f"dim{i}", f"fk{i}", f"n{i}", f"key{i}") for i in range(7)]
    dims = {f"dim{i}": spark.createDataFrame([(f"k{j}",) for j in range(50)], f"n{i} string").withColumn(f"key{i}", F.sha2(f"n{i}", 256)) for i in range(7)}

    def value():
        draw = rng.random()
        return "k1" if draw < 0.33 else None if draw < 0.43 else f"missing{rng.randrange(9)}" if draw < 0.53 else f"k{rng.randrange(50)}"

    rows = [(n, *(value() for _ in range(7)), "wide" * 5) for n in range(3000)] + [(n, *[None] * 7, "w") for n in range(3000, 3500)]
    fact = spark.createDataFrame(rows, "id int, " + ", ".join(f"fk{i} string" for i in range(7)) + ", wide string")
    fact = materialise(fact, "fact")
    dims = {name: materialise(df, name) for name, df in dims.items()}
    targets = [op.lookup_target(dims[x.dimension], x, hashed=True) for x in lookups]
    direct = {tuple(r) for r in op.find_keys(fact, targets, ["id"]).collect()}
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        by_keys = op.find_keys(fact, targets, ["id"])
        assert exchanges(by_keys, "wide") == 1
        assert exchanges(op.find_keys(fact, targets[:1], ["id"]), "wide") == 1
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        found = by_keys.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept[0])
        spark.conf.set("spark.sql.adaptive.enabled", kept[1])
    assert len(found) == 3500 and {tuple(r) for r in found} == direct
    some = op.find_keys(fact, targets, ["id"], direct_up_to=10**9)
    assert {tuple(r) for r in some.collect()} == direct


def test_combinations_of_keys_are_told_apart(spark):
    """Keys that look alike when put together, and keys in each other's place."""
    fact = spark.createDataFrame([("a", None), (None, "a"), ("1:a", "b"), ("1", "a1:b"), ("", None), (None, ""), ("-", None), (None, None)], "x string, y string")
    dims = [spark.createDataFrame([("a",), ("1",), ("",)], "n string"), spark.createDataFrame([("b",), ("",)], "m string")]
    targets = [op.Target(d, F.col(c), f"{c}_key", F.lit("unknown"), F.concat(F.lit("key "), F.col(c))) for d, c in zip(dims, "xy", strict=True)]
    found = {(r.x, r.y): (r.x_key, r.y_key) for r in op.find_keys(materialise(fact, "f"), targets, direct_up_to=-1).collect()}
    known = ({"a", "1", ""}, {"b", ""})
    assert found == {k: tuple(f"key {v}" if v in names else "unknown" for v, names in zip(k, known, strict=True)) for k in found} and len(found) == 8


def test_only_missed_keys_are_answered(spark):
    """Combinations whose keys all have members send nothing back; a missed key is told from a like one of another target."""
    fact = spark.createDataFrame([("a", "b"), ("a", None), ("b", "a"), ("a", "a"), (None, None)], "x string, y string")
    dims = [spark.createDataFrame([("a",)], "n string"), spark.createDataFrame([("b",)], "m string")]
    targets = [op.Target(d, F.col(c), f"{c}_key", F.lit("unknown"), F.col(c)) for d, c in zip(dims, "xy", strict=True)]
    answers = op.membership(materialise(fact, "f"), targets)
    assert dict(answers.dtypes)[answers.columns[0]] == "bigint"
    assert sorted(sorted(r["__missed"]) for r in answers.collect()) == [["0:b", "1:a"], ["1:a"]]


def test_keys_of_combinations_travel_once(spark):
    """Combinations are not made distinct by a shuffle of their own; equal ones still share one answer."""
    fact = materialise(spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", None)], "x string, y string"), "f")
    dims = [materialise(spark.createDataFrame([(v,)], "n string"), "d") for v in "ax"]
    answers = op.membership(fact, [op.Target(d, F.col(c), f"{c}_key", F.lit("unknown"), F.col(c)) for d, c in zip(dims, "xy", strict=True)])
    assert "keys=[__f0" not in answers._jdf.queryExecution().executedPlan().toString()
    assert sorted(list(r["__missed"]) for r in answers.collect()) == [["0:b"], ["0:c"]]


def test_latest_versions_are_not_shuffled_again_for_large_dimensions(spark):
    """Lookups over latest versions by the row's own key: the wide row is in one shuffle, which both readers share."""
    rng = random.Random(6)
    value = lambda: rng.choice([None, "k1", "k1", "missing", *[f"k{j}" for j in range(20)]])
    rows = [(f"r{n % 700}", n, value(), value(), "wide" * 5) for n in range(1500)]
    newest = op.latest_version(materialise(spark.createDataFrame(rows, "id string, at int, x string, y string, wide string"), "v"), ["id"], ["at"])
    dims = [materialise(spark.createDataFrame([(f"k{j}",) for j in range(0, 20, s)], "n string"), "d") for s in (1, 2)]
    targets = [op.Target(d, F.col(c), f"{c}_key", F.lit("unknown"), F.concat(F.lit("key "), F.col(c))) for d, c in zip(dims, "xy", strict=True)]
    direct = {tuple(r) for r in op.find_keys(newest, targets, ["id"]).collect()}
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        by_row = op.find_keys(newest, targets, ["id"], row="id")
        assert exchanges(by_row, "wide") == 1 and "ReusedExchange" in by_row._jdf.queryExecution().executedPlan().toString()
        assert exchanges(op.find_keys(newest, targets[:1], ["id"], row="id"), "wide") == 1
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        found = by_row.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept[0])
        spark.conf.set("spark.sql.adaptive.enabled", kept[1])
    assert len(found) == 700 and {tuple(r) for r in found} == direct


def test_latest_columns_decide_ties_by_the_columns_left_out(spark):
    rows = [("a", 1, 1, "p", "z"), ("a", 2, 1, "q", "y"), ("b", 3, 1, "r", "x"), ("b", 3, 1, "s", "w"), ("b", 3, 1, "t", "v")]
    rows += [("c", None, None, "u", "2"), ("c", None, None, "u", "1"), (None, 9, 9, "n", "n"), ("d", 5, None, "o", "o"), ("d", 5, 0, "m", "k")]
    df = spark.createDataFrame(rows, "id string, at int, made int, value string, last string")
    whole = op.latest_version(df, ["id"], ["at", "made"])
    for columns in (["value"], ["last", "id"], ["id", "last", "at"]):
        stored = []
        some = op.latest_columns(df, ["id"], ["at", "made"], columns, lambda t: stored.append(t) or materialise(t, "t"))
        assert sorted(map(tuple, some.collect()), key=str) == sorted(map(tuple, whole.select(*columns).collect()), key=str)
        plan = stored[0]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") >= 2 and len(stored) == 2
        assert (plan.count("last#") == 1) == ("last" not in columns)  # otherwise it is in the scan alone


def test_group_members(spark):
    rows = [("big", i) for i in range(500)] + [("small", i) for i in range(3)] + [("small", 1), (None, 1), ("small", None)]
    df = spark.createDataFrame(rows, "g string, m int")
    found = op.group_members(df, "g", "m").collect()
    assert sorted((r.g, r.m, r.group_size) for r in found) == [("big", i, 500) for i in range(500)] + [("small", i, 3) for i in range(3)]
    pages = op.member_pages(df, "g", "m", 10).collect()
    big = [r for r in pages if r.g == "big"]
    assert sorted(m for r in big for m in r.members) == list(range(500)) and len(big) == 10
    assert [(r.members, r.group_size) for r in op.member_pages(df, "g", "m", 1).collect() if r.g == "small"] == [([0, 1, 2], 3)]


def test_investors_without_agency_stay(spark):
    investors = spark.createDataFrame([("i1", "a"), ("i2", "b"), ("i3", None)], "investisseur_id string, ville string")
    agencies = spark.createDataFrame([("a", "r1")], "ville string, region_id string")
    programmes = spark.createDataFrame([("p", "a")], "programme_id string, ville string")
    lots = spark.createDataFrame([("p", "l", "DISPONIBLE")], "programme_id string, lot_id string, statut_lot string")
    found = {tuple(r) for r in op.same_region(investors, lots, programmes, agencies).collect()}
    assert found == {("i1", "r1", 1, "l"), ("i2", None, 0, None), ("i3", None, 0, None)}


def test_null_keys_without_placeholder_go(spark):
    df = spark.createDataFrame([(None, "s", 1), ("a", None, 1), ("a", None, 2)], "id string, scope string, v int")
    found = op.latest_version(df, ["id", "scope"], ["v"], placeholders={"scope": "NONE"}).collect()
    assert [tuple(r) for r in found] == [("a", None, 2)]


def test_reconcile_stock(spark):
    programmes = spark.createDataFrame(
        [("p1", "EN_COMMERCIALISATION"), ("p2", "COMMERCIALISE"), ("p3", "LIVRE")], "programme_id string, statut_programme string"
    )
    lots = spark.createDataFrame([("p1", "VENDU"), ("p2", "DISPONIBLE"), ("p2", None)], "programme_id string, statut_lot string")
    found = {r.programme_id: (r.nombre_lots_disponibles, r.statut_programme) for r in op.reconcile_stock(programmes, lots).collect()}
    assert found == {"p1": (0, "COMMERCIALISE"), "p2": (1, "EN_COMMERCIALISATION"), "p3": (0, "LIVRE")}


def test_run_log(spark):
    rows = [("1", "u", "SELECT", D(2025, 1, 7), 1999, 0), ("2", "u", "USE", D(2025, 1, 7), 10, 0), ("3", "u", "SELECT", D(2024, 12, 1), 10, 0)]
    rows += [("4", "u", None, D(2025, 1, 7), 10, 0), ("5", "u", "INSERT", D(2025, 1, 1), 5, 42)]
    df = spark.createDataFrame(rows, "run_id string, pipeline_name string, statement_type string, start_time timestamp_ntz, elapsed_ms long, error_code int")
    df = df.withColumns({"status": F.lit("ok"), "end_time": F.col("start_time"), "row_count": F.lit(1)})
    log = op.run_log(df, F.lit("2025-01-08").cast("timestamp_ntz"))
    assert {r.run_id: (r.duration_seconds, r.error_message) for r in log.collect()} == {"1": (1, None), "5": (0, "42")}


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_latest_columns_shuffles_no_row_to_meet_tied_keys(spark, threshold):
    from stratastar.operators.versions import latest_columns, latest_version

    rows = [(f"k{i % 40}", i % 3, i % 2, f"v{i * 7 % 11}", i * 5 % 13) for i in range(400)] + [(None, 1, 1, "x", 0), ("alone", None, None, None, 1)]
    df = spark.createDataFrame(rows, "id string, t int, c int, v string, w int")
    plans = []

    def store(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return materialise(frame, "latest")

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = latest_columns(df, ["id"], ["t", "c"], ["id", "v"], store)
        assert sorted(found.collect()) == sorted(latest_version(df, ["id"], ["t", "c"]).select("id", "v").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not any("SortMergeJoin" in plan for plan in plans)


def test_all_tests_of_a_table_work_it_out_once(spark, tmp_path):
    """Never-null and unique tests share one scan; unless a print came twice, nothing reads the table again."""
    rows = [("a", 1, None), ("a", 2, "y"), (None, 2, None), (None, 3, "y"), ("d", 4, "z")]
    df = materialise(spark.createDataFrame(rows, "`p.q` string, n int, m string").withColumn("alone", F.monotonically_increasing_id()), "tested")
    found = {(r.column_name, r.test): r.n_failures for r in op.column_failures(df, ["p.q", "n", "m", "m"], ["n", "alone", "p.q"]).collect()}
    assert found == {("p.q", "not_null"): 2, ("n", "not_null"): 0, ("m", "not_null"): 2, ("n", "unique"): 1, ("alone", "unique"): 0, ("p.q", "unique"): 1}
    calm = op.column_failures(df, ["p.q"], ["alone"])
    assert "tested" not in calm._jdf.queryExecution().executedPlan().toString()
    assert {(r.column_name, r.test, r.n_failures) for r in calm.collect()} == {("p.q", "not_null", 2), ("alone", "unique", 0)}
    assert {r.n_failures for r in op.column_failures(df.where("false"), ["n"], ["n"]).collect()} == {0}


def test_only_tied_keys_are_projected_again(spark):
    """The second pass drops all other keys before their columns are worked out, not after."""
    from stratastar.operators.versions import latest_columns

    table = materialise(spark.createDataFrame([(f"k{i % 90}", i % 45, i) for i in range(360)] + [("one", 1, 1)], "id string, t int, w int"), "v")
    df = table.select("id", "t", F.sha2(F.col("w").cast("string"), 256).alias("dear"))
    stored = []
    found = latest_columns(df, ["id"], ["t"], ["id", "dear"], lambda frame: stored.append(frame) or materialise(frame, "latest"))
    assert sorted(found.collect()) == sorted(op.latest_version(df, ["id"], ["t"]).select("id", "dear").collect())
    plan = stored[1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sha2(") < plan.index("LeftSemi")
