"""Operators against brute force in plain Python, and on edge rows."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

import seed
from matricula.functions import bands, dates, exact
from matricula.operators import constraints, extract, load, quality, registration, rollup, scd2, security, temporal
from matricula.plans import dims, facts
from matricula.sources.reference_data import literal_table, states
from matricula.schemas import schema_of


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- expressions ---


def test_exact_rounding(spark):
    rng = random.Random(1)
    pairs = [(1005, 1000), (285, 1000), (-285, 1000), (1, 3), (0, 7), (5, 0), (-75, 10)]
    pairs += [(rng.randint(-10**12, 10**12), rng.randint(1, 10**6)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = df.select("n", "d", exact.ratio(F.col("n"), F.col("d"), 2).alias("q"), exact.decimal_ratio(F.col("n"), F.col("d"), 1, 18).alias("p")).collect()
    for r in got:
        if r.d == 0:
            assert r.q is None and r.p is None
            continue
        fraction = Decimal(r.n) / Decimal(r.d)
        assert r.q == float(fraction.quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert r.p == fraction.quantize(Decimal("0.1"), ROUND_HALF_UP)


def test_dates(spark):
    days = spark.createDataFrame([(date(2024, 8, 31),), (date(2024, 9, 1),), (date(2025, 7, 4),), (date(2025, 1, 1),)], "d date")
    got = days.select(dates.date_key(F.col("d")), dates.academic_year(F.col("d")), dates.season(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        (20240831, "2023/2024", "Vacation"), (20240901, "2024/2025", "First Semester"),
        (20250704, "2024/2025", "Vacation"), (20250101, "2024/2025", "First Semester"),
    ]
    moments = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000))], "a timestamp_ntz, b timestamp_ntz")
    assert moments.select(dates.seconds_between(F.col("a"), F.col("b"))).first()[0] == 1
    assert moments.select(dates.days_between(F.col("a"), F.col("b"))).first()[0] == 0


def test_bands(spark):
    values = ["4.50", "4.49", "3.50", "2.40", "2.39", "1.50", "1.49", None]
    df = spark.createDataFrame([(Decimal(v) if v else None,) for v in values], "g decimal(4,2)")
    assert [r[0] for r in df.select(bands.class_of_degree(F.col("g"))).collect()] == [
        "1st Class", "2nd Class Upper", "2nd Class Upper", "2nd Class Lower", "3rd Class", "3rd Class", "Pass / Probation", "Pass / Probation",
    ]
    flags = df.select(*[c.cast("int") for c in bands.standing_flags(F.col("g")).values()]).collect()
    assert [tuple(r).index(1) if 1 in tuple(r) else None for r in flags] == [0, 1, 1, 2, 3, 3, 4, None]
    names = spark.createDataFrame([("Ada", None)], "f string, l string")
    assert names.select(bands.full_name(F.col("f"), F.col("l"))).first()[0] == "Ada "


# --- loads ---


def test_upsert_and_friends(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, keep int")
    batch = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(load.type1_upsert(target, batch, "k").fillna("-")) == [(1, "a", 10), (2, "-", 20), (3, "c", None)]
    once = load.idempotent_append(target, spark.createDataFrame([(2, "x", 0), (4, "d", 0)], target.schema), ["k"])
    assert rows(once) == [(1, "a", 10), (2, "b", 20), (4, "d", 0)]
    assert rows(load.idempotent_append(once, once, ["k"])) == rows(once)
    replaced = load.replace_affected_keys(target, spark.createDataFrame([(2, "n", 1), (2, "m", 2)], target.schema), spark.createDataFrame([(2,), (9,)], "k int"), ["k"])
    assert rows(replaced) == [(1, "a", 10), (2, "m", 2), (2, "n", 1)]
    changed = load.update_by_keys(target, spark.createDataFrame([(1,), (2,)], "k int"), ["k"], {"v": F.lit("z")}, F.col("keep") > 10)
    assert rows(changed) == [(1, "a", 10), (2, "z", 20)]
    assert rows(load.with_defaults(spark.createDataFrame([(1, None)], "k int, v string"), {"v": "x", "w": 5})) == [(1, "x", 5)]


def test_watermarks(spark):
    from matricula.sources.reference_data import ENTITIES

    first, until = datetime(1900, 1, 1), datetime(2025, 1, 1)
    table = literal_table(spark, [(e, first, 0, first) for e in ENTITIES], schema_of("etl_watermark"))
    assert set(extract.read_watermarks(table).values()) == {first}
    moved = extract.advance_watermarks(table, until)
    marks = extract.read_watermarks(moved)
    assert set(marks.values()) == {until} and len(marks) == 7
    assert moved.where(F.col("last_extracted_at") == F.lit(first).cast("timestamp_ntz")).count() == 4
    assert set(extract.read_watermarks(moved, force_full=True).values()) == {first}
    stamps = spark.createDataFrame([(first,), (until,), (until + timedelta(1),)], "updated_at timestamp_ntz")
    assert extract.changed_since(stamps, first, until).count() == 1


# --- history ---

DIM = "sk bigint, id bigint, a string, b string, effective_date date, expiry_date date, is_current boolean"


def test_scd2_against_python(spark):
    rng = random.Random(2)
    dim = spark.createDataFrame([], DIM)
    open_, closed = {}, []
    for step in range(5):
        day = date(2024, 1, 1) + timedelta(days=step // 2)  # two loads on most days
        snap = {i: (rng.choice("xy"), rng.choice(["p", None])) for i in rng.sample(range(12), 7)}
        merged = scd2.scd2_merge(dim, spark.createDataFrame([(i, *v) for i, v in snap.items()], "id bigint, a string, b string"), "id", ["a", "b"], day, "sk")
        counted = scd2.scd2_counts(merged).first()
        expected = Counter()
        for i, value in snap.items():
            if i not in open_:
                expected["created"] += 1
                open_[i] = (1, *value, day)
            elif open_[i][1:3] != value:
                expected["opened"] += 1
                closed.append((i, *open_[i], day))
                open_[i] = (open_[i][0] + 1, *value, day)
        assert (counted.rows_inserted, counted.rows_updated, counted.rows_closed) == (expected["created"], expected["opened"], expected["opened"])
        all_rows = spark.createDataFrame(merged.drop("action").collect(), DIM)
        now_closed = all_rows.where("not is_current").collect()
        assert {(r.id, r.sk % 10**6, r.a, r.b, r.effective_date, r.expiry_date) for r in now_closed} == {c for c in closed[len(closed) - expected["opened"]:]}
        dim = all_rows.where("is_current")
        assert {(r.id, r.sk % 10**6, r.a, r.b, r.effective_date) for r in dim.collect()} == {(i, *v) for i, v in open_.items()}


def test_versions_and_time_travel(spark):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    changes = [(rng.randrange(4), start + timedelta(hours=rng.randrange(400), minutes=rng.choice([0, 30])), n, f"v{n}") for n in range(300)]
    df = spark.createDataFrame(changes, "id int, at timestamp_ntz, n int, v string")
    last = {}
    for i, at, n, v in changes:
        last[(i, at)] = max(last.get((i, at), (-1, "")), (n, v))
    expected = []
    for i in range(4):
        moments = sorted(at for k, at in last if k == i)
        expected += [(i, a, last[(i, a)][1], b) for a, b in zip(moments, moments[1:] + [datetime(9999, 12, 31)])]
    versions = temporal.versions_from_changes(df, "id", "at", ["v"], "n")
    assert rows(versions.select("id", "valid_from", "v", "valid_to")) == sorted(expected)
    daily = temporal.versions_from_changes(df.withColumn("at", F.col("at").cast("date")), "id", "at", ["v"], "n")
    gaps = daily.groupBy("id").agg(F.count("*").alias("n"), F.count_if(F.col("valid_to") == F.lit(date(9999, 12, 31))).alias("open"))
    assert all(r.open == 1 for r in gaps.collect())
    t = start + timedelta(hours=200)
    assert rows(temporal.system_time(versions, "as_of", t).select("id", "v")) == sorted((i, v) for i, a, v, b in expected if a <= t < b)
    u = t + timedelta(hours=10)
    between = temporal.system_time(versions, "between", t, u)
    assert between.count() == sum(a <= u and b > t for _, a, _, b in expected)
    assert temporal.system_time(versions, "all").count() == len(expected)
    with pytest.raises(ValueError):
        temporal.system_time(versions, "sometimes")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_asof_lookup_against_python(spark, how):
    rng = random.Random(4)
    base = date(2020, 1, 1)
    versions = []
    for key in range(5):
        days = sorted(rng.sample(range(1200), 12))
        versions += [(key, base + timedelta(a), base + timedelta(b) if b else date(9999, 12, 31), f"{key}-{a}") for a, b in zip(days, days[1:] + [None])]
    facts_ = [(n, rng.randrange(6), base + timedelta(rng.randrange(1500))) for n in range(300)]
    got = temporal.asof_lookup(
        spark.createDataFrame(facts_, "n int, key int, day date"),
        spark.createDataFrame(versions, "key int, valid_from date, valid_to date, v string"), "key", "day", ["v"], how=how,
    )
    expected = []
    for n, key, day in facts_:
        hit = [v for k, a, b, v in versions if k == key and a <= day < b]
        expected += [(n, key, day, hit[0])] if hit else [(n, key, day, None)] if how == "left" else []
    assert sorted(map(str, rows(got))) == sorted(map(str, expected))
    empty = spark.createDataFrame([], "n int, key int, day date")
    assert temporal.asof_lookup(empty, spark.createDataFrame(versions, "key int, valid_from date, valid_to date, v string"), "key", "day", ["v"]).count() == 0


def test_asof_lookup_of_one_busy_key(spark):
    """A key's facts spread over partitions; its version is carried over the borders, at moments as at days."""
    base = datetime(2020, 1, 1)
    versions = [(1, base + timedelta(hours=70 * i), base + timedelta(hours=70 * (i + 1)), i) for i in range(20)] + [(2, base, base, 98), (2, base, base + timedelta(days=400), 99)]
    days = [(n, 1 if n % 9 else 2 if n % 2 else None, base + timedelta(minutes=37 * n)) for n in range(-50, 3000)] + [(-99, 1, None)]
    facts_ = spark.createDataFrame(days, "n int, key int, at timestamp_ntz")
    found = temporal.asof_lookup(facts_.repartition(6), spark.createDataFrame(versions, "key int, valid_from timestamp_ntz, valid_to timestamp_ntz, v int"), "key", "at", ["v"])
    want = [(n, key, at, next((v for k, a, b, v in versions if at is not None and k == key and a <= at < b), None)) for n, key, at in days]
    assert sorted(map(str, rows(found))) == sorted(map(str, want))
    plan = found._jdf.queryExecution().toString()
    assert "_month" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_late_changes(spark):
    """Batches in any order give the versions of one build; keys without a late change keep their rows."""
    rng = random.Random(6)
    base = datetime(2021, 5, 1)
    changes = [(rng.randrange(8), base + timedelta(hours=rng.randrange(60)), rng.choice("abc"), n) for n in range(200)]
    schema = "id int, at timestamp_ntz, v string, n int"
    whole = temporal.versions_from_changes(spark.createDataFrame(changes, schema), "id", "at", ["v"], "n")
    rng.shuffle(changes)
    kept = spark.createDataFrame([], "id int, valid_from timestamp_ntz, valid_to timestamp_ntz, v string, n int")
    for k in range(0, 200, 67):
        kept = temporal.merge_changes(kept, spark.createDataFrame(changes[k:k + 67], schema), "id", "at", ["v"], "n")
    assert rows(kept.select("id", "valid_from", "v", "valid_to")) == rows(whole.select("id", "valid_from", "v", "valid_to"))
    one = spark.createDataFrame([(1, base, "z", 999)], schema)
    after = temporal.merge_changes(whole.withColumn("n", F.lit(1)), one, "id", "at", ["v"], "n")
    assert rows(after.where("id <> 1").drop("n")) == rows(whole.where("id <> 1").select("id", "valid_from", "valid_to", "v"))


def test_rollup(spark):
    rng = random.Random(9)
    data = [(rng.randrange(3), rng.choice("xy"), rng.choice((None, rng.randrange(100_000), rng.randrange(5)))) for _ in range(2000)]
    df = spark.createDataFrame(data, "period int, g string, id bigint")
    by_period = [rollup.distinct_rollup(df.where(F.col("period") == p), ("period", "g"), "id") for p in range(3)]
    kept = by_period[0].unionByName(by_period[1]).unionByName(by_period[2])
    assert rows(rollup.distinct_counts(kept, ("g",), "n")) == sorted((g, len({i for _, x, i in data if x == g and i is not None})) for g in "xy")
    assert rollup.distinct_counts(kept, (), "n").first()[0] == len({i for _, _, i in data if i is not None})


def test_registry_plan_has_no_join(spark):
    s = seed.source(spark)
    plan = lambda user: security.visible_rows(s["student"], s["security_user_map"], user, s)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan("registry_admin") and "Join" not in plan("student_one") and plan("lecturer_one").count("Join LeftSemi") == 2


# --- checks ---


def test_constraint_kinds(spark):
    tables = {
        "child": spark.createDataFrame([(1, "a", 7), (2, "a", None), (3, None, 8), (4, None, 8)], "id int, code string, parent_id int"),
        "parent": spark.createDataFrame([(7,)], "id int"),
    }
    found = constraints.violations(
        tables, tables,
        checks=(constraints.Check("child", "small", "parent_id < 8"),), not_nulls=(constraints.NotNull("child", ("code",)),),
        uniques=(constraints.Unique("child", ("code",)),), references=(constraints.Reference("child", "parent_id", "parent", "id"),),
    )
    assert rows(found) == sorted([
        ("check:child.small", "3", 1), ("check:child.small", "4", 1), ("not_null:child.code", "3", 1), ("not_null:child.code", "4", 1),
        ("unique:child.code", "1:a", 2), ("unique:child.code", "null", 2), ("reference:child.parent_id->parent", "8", 2),
    ])


def _full(found):
    return {(r["rule"], r["key"]): r["violations"] for r in found.collect()}


def test_changed_violations(spark):
    """Checking the keys that a change touches gives the difference of two full checks."""
    rng = random.Random(11)
    rules = {
        "checks": (constraints.Check("child", "small", "parent_id < 8"),), "not_nulls": (constraints.NotNull("child", ("code", "parent_id")),),
        "uniques": (constraints.Unique("child", ("code",)), constraints.Unique("child", ("code", "parent_id")), constraints.Unique("parent", ("id",)), constraints.Unique("child", ("day",))),
        "references": (constraints.Reference("child", "parent_id", "parent", "id"), constraints.Reference("other", "ref", "parent", "id")),
    }
    some = lambda values: rng.choice((*values, None))
    child = lambda n: [(rng.randrange(40), some("abcd"), some(range(12)), some((date(2020, 1, 1), date(2020, 1, 2)))) for _ in range(n)]
    frame = {
        "child": lambda rows: spark.createDataFrame(rows, "id int, code string, parent_id int, day date"),
        "parent": lambda rows: spark.createDataFrame(rows, "id bigint"), "other": lambda rows: spark.createDataFrame(rows, "ref bigint"),
    }
    before = {"child": child(60), "parent": [(i,) for i in (0, 1, 2, 3, 3, 4, 5, 6)], "other": [(some(range(9)),) for _ in range(30)]}
    for gone, came in (
        ({"child": before["child"][:9], "parent": before["parent"][2:4]}, {"child": child(11), "parent": [(8,), (6,)]}),
        ({}, {"parent": [(7,)]}), ({"child": before["child"][:5]}, {"child": before["child"][:5]}), ({"child": before["child"]}, {}), ({}, {}),
    ):
        after = {t: list(held) for t, held in before.items()}
        for t, out in gone.items():
            for r in out:
                after[t].remove(r)
        for t, put in came.items():
            after[t] += put
        tables = lambda m: {t: frame[t](held) for t, held in m.items()}
        old, new = (_full(constraints.violations(tables(m), m, **rules)) for m in (before, after))
        want = sorted((*k, old.get(k, 0), new.get(k, 0)) for k in {*old, *new} if old.get(k, 0) != new.get(k, 0))
        assert rows(constraints.changed_violations(tables(before), tables(gone), tables(came), before, **rules)) == want


def test_checks_on_damaged_data(spark):
    s = seed.source(spark)
    s["student"] = s["student"].withColumn("programme_id", F.when(F.col("student_id") > 2, F.col("programme_id")))
    s["student"] = s["student"].withColumn("student_matric_no", F.when(F.col("student_id") < 4, "X").otherwise(F.col("student_matric_no")))
    s["course_result"] = s["course_result"].withColumn("total_score", F.when(F.col("result_id") == 1, F.lit("69.5").cast("decimal(6,2)")).otherwise(F.col("total_score")))
    s["course"] = s["course"].withColumn("credit_units", F.lit(6))
    s["course_registration"] = s["course_registration"].withColumn("registration_status", F.when(F.col("registration_id") == 22, "Dropped").otherwise("Registered"))
    got = {r.check_id: r.records_flagged for r in quality.check_counts(s, date(2025, 3, 15)).collect() if r.records_flagged}
    assert got == {"DQ-01": 2, "DQ-04": 5, "DQ-05": 2, "DQ-06": 1, "DQ-07": 1, "DQ-08": 5, "DQ-09": 1, "DQ-10": 21}
    assert tuple(quality.gate(quality.run_checks(s, date(2025, 3, 15))).first()) == (4, 4, False)


def test_continued_state(spark):
    """Continuing a state gives the running sums of the whole, whatever sessions changed."""
    rng = random.Random(13)
    gpas = {(s, y): rng.choice((None, Decimal(rng.randrange(100, 500)) / 100)) for s in range(30) for y in range(1, 9) if rng.random() < 0.8}
    frame = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], "student_id bigint, session_id bigint, session_gpa decimal(4,2)")
    before = {k: v for k, v in gpas.items() if rng.random() < 0.7}
    changed = {k: v for k, v in gpas.items() if k not in before} | {k: Decimal("3.33") for k in rng.sample(sorted(before), 5)}
    after = facts.continued_state(facts.running_state(frame(before)), frame(changed))
    assert rows(after) == rows(facts.running_state(frame(before | changed)))
    assert rows(facts.continued_state(facts.running_state(frame(before)), frame(changed).limit(0))) == rows(facts.running_state(frame(before)))


# --- facts on edge rows ---


def warehouse(spark, s):
    now = datetime(2025, 3, 15)
    t = dict(s)
    t["dim_geography"] = states(spark)
    t["dim_academic_period"] = dims.upsert_academic_period(s, dims.empty(spark, "dim_academic_period"))
    t["dim_course"] = dims.upsert_course(s, dims.empty(spark, "dim_course"), now)
    t["dim_staff"] = dims.upsert_staff(s, dims.empty(spark, "dim_staff"), now)
    t["dim_student"] = dims.merge_student(dims.empty(spark, "dim_student"), dims.student_snapshot(s), now.date(), now, 1).drop("action")
    return t, now


def test_enrollment_edges(spark):
    s = seed.source(spark)
    two = [(seed.course_id("CSC301"), 5, 2), (seed.course_id("CSC301"), 5, 1)]
    s["course_assignment"] = literal_table(spark, two, schema_of("course_assignment"))
    first = F.col("result_id") == 1
    s["course_result"] = s["course_result"].withColumns({
        "grade": F.when(~first, F.col("grade")), "grade_point": F.when(~first, F.col("grade_point")), "remark": F.when(first, "Withheld").otherwise(F.col("remark")),
    })
    s["student"] = s["student"].withColumn("state_of_origin", F.when(F.col("student_id") == 3, " oSUN ").otherwise(F.col("state_of_origin")))
    t, now = warehouse(spark, s)
    one = facts.enrollment_rows(t, 1, now).collect()
    assert len(one) == 5 and {r.staff_sk for r in one} == {1, None} and {r.geo_sk for r in one} == {None}
    (odd,) = [r for r in one if r.grade is None]
    assert not (odd.is_pass or odd.is_fail or odd.is_distinction or odd.is_credit or odd.is_absent)
    assert facts.enrollment_rows(t, 1, now, fanout=True).count() == 6
    t["student"] = t["student"].withColumn("state_of_origin", F.when(F.col("student_id") == 3, "oSUN ").otherwise(F.col("state_of_origin")))
    assert {r.geo_sk for r in facts.enrollment_rows(t, 1, now, case_insensitive=True).collect()} == {30}
    assert facts.enrollment_rows(t, 1, now, watermark=datetime(2024, 2, 1)).count() == 0
    (gpa,) = facts.gpa_rows(t, 1, now).collect()
    # The result without a grade gives no points but its units count.
    assert (gpa.session_gpa, gpa.total_credits_attempted, gpa.courses_passed) == (Decimal("2.60"), 15, 4)


def test_facts_at_the_version_of_registration(spark):
    t, now = warehouse(spark, seed.source(spark))
    dim = t["dim_student"]
    old = dim.where("student_id = 3").withColumns({
        "student_sk": F.col("student_sk") + 1, "effective_date": F.lit(date(2020, 1, 1)), "expiry_date": F.lit(date(2024, 1, 1)), "is_current": F.lit(False),
    })
    t["dim_student"] = dim.unionByName(old)
    assert {r.student_sk for r in facts.enrollment_rows(t, 1, now).collect()} == {3_000_001}
    past = facts.enrollment_rows(t, 1, now, at_registration=True).collect()
    assert len(past) == 5 and {r.student_sk for r in past} == {3_000_002} and {r.geo_sk for r in past} == {30}


def test_running_cgpa_counts_sessions_without_gpa(spark):
    sessions = spark.createDataFrame([(1, 1, Decimal("4.00"), 10), (1, 2, None, 5), (1, 3, Decimal("3.01"), 30)], "student_id int, session_id int, session_gpa decimal(4,2), credits_attempted int")
    assert [r.cgpa for r in facts.running_cgpa(sessions).orderBy("session_id").collect()] == [Decimal("4.00"), Decimal("2.00"), Decimal("2.34")]
    weighted = [r.cgpa for r in facts.running_cgpa(sessions, weighted=True).orderBy("session_id").collect()]
    assert weighted == [Decimal("4.00"), Decimal("2.67"), Decimal("2.90")]


def test_snapshot_sees_renamed_faculty(spark):
    s = seed.source(spark)
    later = datetime(2025, 1, 1)
    s["faculty"] = s["faculty"].withColumn("updated_at", F.when(F.col("faculty_id") == 14, F.lit(later).cast("timestamp_ntz")).otherwise(F.col("updated_at")))
    since = datetime(2024, 1, 1)
    assert dims.student_snapshot(s, since).count() == 0
    assert dims.student_snapshot(s, since, touch=True).count() == 5


# --- registration ---


def greedy(requests, units, held, cap):
    """Requests one by one."""
    load, taken, out = dict(held), set(), {}
    for rid, student, course, semester in requests:
        group = (student, semester)
        if (student, course, semester) in taken:
            out[rid] = "duplicate"
        elif load.get(group, 0) + units[course] > cap:
            out[rid] = "over"
        else:
            out[rid] = "ok"
            taken.add((student, course, semester))
            load[group] = load.get(group, 0) + units[course]
    return out


@pytest.mark.parametrize("seed_", range(3))
def test_unit_cap_against_one_by_one(spark, seed_):
    rng = random.Random(seed_)
    units = {c: rng.choice([0, 1, 2, 3, 4, 6, 12, 30]) for c in range(60)}
    units[60] = 5
    # Half of all requests come from one student and semester.
    requests = [(n, 1 if rng.random() < 0.5 else rng.randrange(5), rng.randrange(61), rng.choice([1, 1, 2])) for n in range(600)]
    registered = [(Decimal(-1), 2, 60, 1), (Decimal(-2), 3, 60, 1), (Decimal(-3), 3, 60, 2)]
    held = Counter()
    for _, student, course, semester in registered:
        held[(student, semester)] += units[course]
    day = datetime(2025, 1, 1)
    df = spark.createDataFrame([(r[0], r[0], r[1], r[2], r[3], "ELECTIVE", day) for r in requests],
                               "request_id bigint, sequence bigint, student_id bigint, course_id bigint, semester_id bigint, course_type string, requested_at timestamp_ntz")
    semester = spark.createDataFrame([(1, date(2025, 2, 1)), (2, date(2025, 2, 1))], "semester_id bigint, reg_deadline date")
    course = spark.createDataFrame(list(units.items()), "course_id bigint, credit_units int")
    none = spark.createDataFrame([], "course_id bigint, required_course_id bigint, min_grade string")
    held_rows = literal_table(spark, [(*r, day, "Registered", "MAJOR", day) for r in registered], schema_of("course_registration"))
    results = literal_table(spark, [], schema_of("course_result"))
    got = {r.request_id: r.message for r in registration.validate_registrations(df, semester, course, none, held_rows, results).collect()}
    word = lambda m: "ok" if m.startswith("SUCCESS") else "duplicate" if "Already" in m else "over"
    taken = {(s, c, m) for _, s, c, m in registered}
    # A held course is refused before it can use units.
    want = greedy_with_held(requests, units, held, taken)
    assert {n: word(m) for n, m in got.items()} == want


def greedy_with_held(requests, units, held, taken):
    fresh = [r for r in requests if r[1:4] not in taken]
    out = greedy(fresh, units, held, 24)
    return {r[0]: out.get(r[0], "duplicate") for r in requests}
