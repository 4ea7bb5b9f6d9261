"""The incremental load: checks, extraction by watermark, dimensions, facts, publication, run log."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import FIRST_WATERMARK
from .. import session
from ..operators import constraints, extract, quality
from ..operators.load import latest_runs, replace_affected_keys, type1_upsert, unmatched
from ..operators.scd2 import version_number
from ..schemas import schema_of
from ..sources.reference_data import ENTITIES, literal_table, states
from ..sources.store import Parts, Store
from . import dims, facts

# Default number of parts after which an append-only table's parts are merged: for
# closed student versions all of them, for events those of one period.
MERGE_AFTER = 100
# Default number of parts of the GPA fact; a load rewrites those its students are in.
GPA_PARTS = 64

# Default number of parts of the open student versions; a load reads and rewrites those its students are in.
STUDENT_PARTS = 16
# Default number of parts of the index from registrations to the periods their facts are in.
INDEX_PARTS = 64

CURRENT = "current"
INDEX = "registration_period"
ROLLUP = "period_students"
WAREHOUSE_TABLES = (
    "dim_date", "dim_geography", "dim_student", "dim_course", "dim_academic_period", "dim_staff",
    "fact_enrollment", "fact_student_gpa", "fact_registration_event",
)


class LoadBlocked(RuntimeError):
    """Error checks flagged something; nothing was loaded."""


class Run:
    """One load into a store.

    ``until`` is fixed before anything is read: facts changed in
    ``(watermark, until]`` are extracted and ``until`` becomes the watermark,
    so a change made during the run is left for the next one.  Dimension rows
    are read without an upper bound, so that a fact always finds the rows it
    refers to; the next run reads those past ``until`` again, which changes nothing.
    """

    def __init__(
        self, store: Store, source: Mapping[str, DataFrame], run_id: int, until: datetime, now: datetime,
        merge_after: int = MERGE_AFTER, gpa_parts: int = GPA_PARTS, student_parts: int = STUDENT_PARTS, index_parts: int = INDEX_PARTS,
    ):
        self.store, self.source, self.run_id, self.until, self.now = store, source, run_id, until, now
        self.merge_after, self.gpa_parts, self.student_parts, self.index_parts = merge_after, gpa_parts, student_parts, index_parts
        self.changed: dict[str, Parts] = {}
        self.staged: dict[str, DataFrame] = {}
        self._counts: dict[str, list[int]] = {"inserted": [], "updated": [], "closed": []}

    def count(self, **rows: int) -> None:
        for what, n in rows.items():
            self._counts[what].append(n)

    def total(self, what: str) -> int:
        """Rows of one kind over all loads of the run."""
        return sum(self._counts[what])

    @staticmethod
    def together(*loads) -> None:
        """Loads that do not read each other's output, side by side, so their jobs share the cluster."""
        with ThreadPoolExecutor(len(loads)) as pool:
            for done in [pool.submit(load) for load in loads]:
                done.result()

    @property
    def tables(self) -> Mapping[str, DataFrame]:
        """Source tables, and the warehouse as this run has made it so far."""
        return ChainMap(self.staged, self.source)

    def stage(self, table: str, parts: Parts) -> None:
        self.changed[table] = parts
        self.staged[table] = self.store.read(table, parts)

    def delta(self, table: str, rows: DataFrame) -> DataFrame:
        """Incoming rows, stored: read more than once, of known size, and counted."""
        parts = self.store.write(table, rows, self.run_id, label="delta")
        return self.store.read(table, parts)

    # --- dimensions ---

    def calendar(self, days: DataFrame) -> None:
        stored = self.store.parts("dim_date")
        missing = dims.new_days(days, self.store.read("dim_date"))
        parts = self.store.write("dim_date", missing, self.run_id, label=f"run-{self.run_id}")
        self.stage("dim_date", {**stored, **parts} if not stored or self.store.rows("dim_date", parts) else stored)

    def geography(self, rows: DataFrame) -> None:
        """Static: written once."""
        stored = self.store.parts("dim_geography")
        self.stage("dim_geography", stored or self.store.write("dim_geography", rows, self.run_id))

    def type1(self, table: str, source: DataFrame, key: str, update=None) -> None:
        """Upserts; rows inserted and rows updated both count as inserted.  Two rows of one key stop the run."""
        rows = self.delta(table, source)
        refuse_repeated(rows, [key], table)
        target = self.store.read(table)
        self.stage(table, self.store.write(table, type1_upsert(target, rows, key, update), self.run_id))
        self.count(inserted=rows.count())

    def students(self, watermark: datetime, touch: bool = False) -> None:
        """Rewrites the open versions of the changed students' parts; closed versions go to a part of their own and are
        not touched again.

        Open versions are dealt by student, so a student's open version is in one known part; the other parts are
        neither read nor written."""
        table, closed = "dim_student", f"closed-{self.run_id}"
        stored = self.store.parts(table)
        open_parts = {k for k in stored if k.startswith(CURRENT)}
        part = lambda student: F.concat(F.lit(f"{CURRENT}-"), F.pmod(student, F.lit(self.student_parts)).cast("string"))
        snapshot = self.delta(table, dims.student_snapshot(self.source, watermark, None, touch)).select(*dims.SNAPSHOT)
        refuse_repeated(snapshot, ["student_id"], table)
        touched = {r[0] for r in snapshot.select(part(F.col("student_id"))).distinct().collect()}  # at most student_parts
        if open_parts - {f"{CURRENT}-{i}" for i in range(self.student_parts)}:
            touched |= open_parts  # the number of parts was changed: all are dealt anew
        current = self.store.read(table, {k: v for k, v in stored.items() if k in touched & open_parts})
        # Every key with a version has an open one, so its part of the open slice holds all its known keys.
        merged = dims.merge_student(current, snapshot, self.now.date(), self.now, self.run_id)
        place = F.when(F.col("is_current"), part(F.col("student_id"))).otherwise(closed)
        parts = self.store.write(table, merged, self.run_id, place)
        first = F.count_if(version_number(F.col("student_sk")) == 1)
        opened = self.store.read(table, {k: v for k, v in parts.items() if k != closed}).where(F.col("etl_run_id") == self.run_id)
        new, both = opened.agg(first, F.count("*")).first()
        self.count(inserted=new, updated=both - new, closed=self.store.rows(table, {k: v for k, v in parts.items() if k == closed}))
        whole = {**{k: v for k, v in stored.items() if k not in touched}, **parts}
        self.stage(table, self.merge_parts(table, whole, keep=tuple(k for k in whole if k.startswith(CURRENT))))

    # --- facts ---

    def enrollment(self, watermark: datetime) -> None:
        """Replaces the changed registrations, rewriting only the periods they are or were in.

        Where they were is looked up in the index from registrations to periods, of which only the parts of changed
        registrations are read; the fact itself is read in the periods that are rewritten alone."""
        table, period = "fact_enrollment", F.col("period_sk").cast("string")
        stored = self.store.parts(table)
        rows = facts.enrollment_rows(self.tables, self.run_id, self.now, watermark, self.until)
        if not stored:
            parts = self.store.write(table, rows, self.run_id, period, gather=False)
            self.count(inserted=self.store.rows(table, parts))
            self.stage(table, parts)
            self.rollup(parts)
            return self.index(self.store.read(table, parts))
        if not self.store.parts(INDEX):
            self.index(self.store.read(table))
        new = self.delta(table, rows)
        affected = session.stored(facts.affected_registrations(self.source, watermark, self.until), "affected")
        known = self.indexed(affected)
        # Of the affected registrations, those that the fact holds: few where results come once.
        held = session.stored(known.join(affected, "registration_id", "left_semi").select("registration_id", "period_sk"), "held")
        touched = {str(r[0]) for r in new.select("period_sk").distinct().union(held.select("period_sk")).distinct().collect()}
        target = self.store.read(table, {k: v for k, v in stored.items() if k in touched})
        rewritten = self.store.write(table, replace_affected_keys(target, new, held, ["registration_id"]), self.run_id, period, gather=False)
        self.count(inserted=new.count())
        self.index(unmatched(new.select(*schema_of(INDEX).names).distinct(), known, schema_of(INDEX).names))
        self.stage(table, {**{k: v for k, v in stored.items() if k not in touched}, **rewritten})
        return self.rollup(rewritten if self.store.parts(ROLLUP) and not self.departments_moved() else self.changed[table])

    def departments_moved(self) -> bool:
        """Whether a known course has another department's name than before this run."""
        name = F.col("department_name")
        was = self.store.read("dim_course").select("course_sk", name.alias("was"))
        return not self.tables["dim_course"].select("course_sk", name).join(was, "course_sk").where(~name.eqNullSafe(F.col("was"))).isEmpty()

    def rollup(self, periods: Parts) -> None:
        """Makes the distinct students of these periods anew; those of the others stay."""
        rows = facts.period_students(self.tables, self.store.read("fact_enrollment", periods))
        written = self.store.write(ROLLUP, rows, self.run_id, F.col("period_sk").cast("string"))
        self.stage(ROLLUP, {**{k: v for k, v in self.store.parts(ROLLUP).items() if k in self.changed["fact_enrollment"] and k not in periods}, **written})

    def index_part(self):
        return F.pmod(F.xxhash64("registration_id"), F.lit(self.index_parts)).cast("string")

    def index_parts_stored(self) -> Parts:
        return self.changed.get(INDEX) or self.store.parts(INDEX)

    def indexed(self, registrations: DataFrame) -> DataFrame:
        """The index's rows in the parts that these registrations are in; some may be of others in the same parts."""
        stored = self.index_parts_stored()
        wanted = {r[0] for r in registrations.select(self.index_part()).distinct().collect()}  # at most index_parts
        foreign = {k.partition("@")[0] for k in stored} - {str(i) for i in range(self.index_parts)}
        return self.store.read(INDEX, {k: v for k, v in stored.items() if foreign or k.partition("@")[0] in wanted})

    def index(self, rows: DataFrame) -> None:
        """Appends to the index where these facts are; a registration that moved keeps its earlier periods, which are
        looked into in vain."""
        stored = self.index_parts_stored()
        written = self.store.write(INDEX, rows.select(*schema_of(INDEX).names), self.run_id, self.index_part(), label=f"index-{len(stored)}")
        parts = {**stored, **{f"{k}@{self.run_id}": path for k, path in written.items()}}
        for number in written:
            parts = self.merge_parts(INDEX, parts, keep=tuple(k for k in parts if k.partition("@")[0] != number), label=f"{number}@merged-{self.run_id}")
        self.stage(INDEX, parts)

    def gpa(self, watermark: datetime) -> None:
        """Recomputes the students with changed results, whatever version their old facts point at, as of ``until``.

        The fact is kept in parts by student; only the parts of these students are read and rewritten."""
        table = "fact_student_gpa"
        stored = self.store.parts(table)
        new = self.delta(table, facts.gpa_rows(self.tables, self.run_id, self.now, watermark, self.until))
        refuse_repeated(new, ["student_sk", "period_sk"], table)
        affected = facts.affected_students(self.source, watermark, self.until)
        part = lambda student: F.pmod(student, F.lit(self.gpa_parts)).cast("string")
        touched = {r[0] for r in affected.select(part(F.col("student_id"))).distinct().collect()}  # at most gpa_parts
        if set(stored) - {str(i) for i in range(self.gpa_parts)}:
            touched |= set(stored)  # the number of parts was changed: all are dealt anew
        keyed = facts.with_student_id(self.store.read(table, {k: v for k, v in stored.items() if k in touched}))
        merged = replace_affected_keys(keyed, facts.with_student_id(new), affected, ["student_id"])
        rewritten = self.store.write(table, merged, self.run_id, part(F.col("student_id")))
        self.stage(table, {**{k: v for k, v in stored.items() if k not in touched}, **rewritten})
        self.count(inserted=new.count())

    def events(self, watermark: datetime) -> None:
        """Appends the attempts the fact lacks; of the fact only the periods of the new attempts are read."""
        table = "fact_registration_event"
        stored = self.store.parts(table)
        of = lambda part: part.partition("@")[0]
        periods = {str(r[0]) for r in facts.attempted_periods(self.source, watermark, self.until).collect()}
        existing = facts.with_student_id(self.store.read(table, {k: v for k, v in stored.items() if of(k) in periods}))
        rows = facts.event_rows(self.tables, self.run_id, self.now, watermark, self.until, existing)
        written = self.store.write(table, rows, self.run_id, F.col("period_sk").cast("string"), gather=False)
        self.count(inserted=self.store.rows(table, written))
        parts = {**stored, **{f"{period}@{self.run_id}": path for period, path in written.items()}}
        for period in written:
            parts = self.merge_parts(table, parts, keep=tuple(k for k in parts if of(k) != period), label=f"{period}@merged-{self.run_id}")
        self.stage(table, parts)

    def merge_parts(self, table: str, parts: Parts, keep: tuple[str, ...] = (), label: str = "merged") -> Parts:
        many = {k: v for k, v in parts.items() if k not in keep}
        if len(many) <= self.merge_after:
            return parts
        whole = self.store.write(table, self.store.read(table, many), self.run_id, label=label)
        return {**{k: parts[k] for k in keep if k in parts}, **whole}

    def broken(self) -> DataFrame:
        """rule, key, before, after of the warehouse rules whose violations this run's changes alter.

        Only directories that the run replaced or wrote are compared; rows that were merely moved cancel out."""
        old = {t: self.store.parts(t) for t in WAREHOUSE_TABLES}
        new = {t: self.changed.get(t, old[t]) for t in WAREHOUSE_TABLES}
        gone = {t: {k: v for k, v in old[t].items() if v not in new[t].values()} for t in WAREHOUSE_TABLES}
        came = {t: {k: v for k, v in new[t].items() if v not in old[t].values()} for t in WAREHOUSE_TABLES}
        read = lambda parts: {t: self.store.read(t, p) for t, p in parts.items() if p}
        return constraints.changed_violations({t: self.store.read(t) for t in WAREHOUSE_TABLES}, read(gone), read(came), WAREHOUSE_TABLES)

    def watermarks(self, table: DataFrame) -> None:
        moved = extract.advance_watermarks(table, self.until)
        self.stage("etl_watermark", self.store.write("etl_watermark", moved, self.run_id))


def refuse_repeated(rows: DataFrame, keys: list[str], table: str) -> None:
    """Stops the run if incoming rows hold a key more than once."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1").select(*keys).first()
    if repeated:
        raise ValueError(f"{table}: more than one incoming row for {repeated.asDict()}")


def stored_watermarks(store: Store) -> DataFrame:
    """The watermark table, seeded with every entity at the first watermark."""
    if store.parts("etl_watermark"):
        return store.read("etl_watermark")
    rows = [(entity, FIRST_WATERMARK, 0, FIRST_WATERMARK) for entity in ENTITIES]
    return literal_table(store.spark, rows, schema_of("etl_watermark"))


def _log_row(store: Store, run: Run, status: str, finished: datetime | None, triggered_by: str, errors=0, warnings=0, message=None) -> None:
    row = (run.run_id, run.now, finished, status, run.total("inserted"), run.total("updated"), run.total("closed"), errors, warnings, message, triggered_by)
    store.append_log("etl_log", literal_table(store.spark, [row], schema_of("etl_log")))


def run_incremental(
    store: Store,
    source: Mapping[str, DataFrame],
    until: datetime,
    *,
    force_full: bool = False,
    touch: bool = False,
    triggered_by: str = "scheduler",
    calendar: DataFrame | None = None,
    geography: DataFrame | None = None,
    clock=None,
    merge_after: int = MERGE_AFTER,
    gpa_parts: int = GPA_PARTS,
    student_parts: int = STUDENT_PARTS,
    index_parts: int = INDEX_PARTS,
    validate: bool = False,
    **limits,
) -> DataFrame:
    """One incremental load of ``source`` into ``store`` as of ``until``; returns the run's log row.

    Raises ``LoadBlocked`` when an error check flags anything.  Whatever
    fails, the run is logged as FAILED and the published tables stay as they
    were.  With ``touch`` a renamed programme, department or faculty counts as a
    change of its students.  ``clock`` gives the finish time (default: ``until``); ``merge_after``
    is the number of parts after which closed versions, or a period's events, are merged; ``gpa_parts``,
    ``student_parts`` and ``index_parts`` are the numbers of parts of the GPA fact, the open student versions and the
    index of registrations; ``limits`` are thresholds of the checks.  With ``validate`` the declared rules of the
    warehouse are checked on what the run changes before it is published; rules with new violations are logged as
    errors and block the load.
    """
    spark = store.spark
    last = store.log("etl_log").agg(F.max("etl_run_id")).first()[0]
    run = Run(store, source, (last or 0) + 1, until, until, merge_after, gpa_parts, student_parts, index_parts)
    finished = clock or (lambda: until)
    errors = warnings = 0
    _log_row(store, run, "RUNNING", None, triggered_by)
    try:
        flagged = quality.run_checks(source, until.date(), **limits).collect()  # at most ten rows
        if flagged:
            logged = [(f.check_name, f.check_category, f.severity, f.records_flagged, f.detail, until, run.run_id) for f in flagged]
            store.append_log("dq_check_log", literal_table(spark, logged, schema_of("dq_check_log")))
        errors = sum(f.severity == quality.ERROR for f in flagged)
        warnings = sum(f.severity == quality.WARNING for f in flagged)
        if errors:
            raise LoadBlocked(f"{errors} DQ errors blocked the load.")

        marks = stored_watermarks(store)
        wm = extract.read_watermarks(marks, force_full)
        run.together(
            lambda: run.students(wm["student"], touch),
            lambda: run.type1("dim_course", dims.course_source(source, until, wm["course"]), "course_id", dims.COURSE_REFRESHED),
            lambda: run.type1("dim_staff", dims.staff_source(source, until, wm["staff"]), "staff_id", dims.STAFF_REFRESHED),
            lambda: run.type1("dim_academic_period", dims.period_source(source, wm["semester"]), "semester_id"),
            lambda: run.calendar(dims.dim_date(spark) if calendar is None else calendar),
            lambda: run.geography(states(spark) if geography is None else geography),
        )
        run.together(
            lambda: run.enrollment(wm["course_result"]),
            lambda: run.gpa(wm["course_result"]),
            lambda: run.events(wm["course_registration"]),
        )
        if validate:
            broken = run.broken().where("after > before").groupBy("rule").agg(F.count("*").alias("keys"), F.sum(F.col("after") - F.col("before")).alias("rows")).collect()  # at most one row per rule
            if broken:
                logged = [(b["rule"], "CONSTRAINT", quality.ERROR, b["rows"], f"{b['keys']} keys broke the rule.", until, run.run_id) for b in broken]
                store.append_log("dq_check_log", literal_table(spark, logged, schema_of("dq_check_log")))
                errors += len(broken)
                raise LoadBlocked(f"{len(broken)} declared rules would be broken.")
        run.watermarks(marks)
        store.publish(run.run_id, run.changed)
    except Exception as problem:
        _log_row(store, run, "FAILED", finished(), triggered_by, errors, warnings, str(problem))
        raise
    _log_row(store, run, "SUCCESS", finished(), triggered_by, errors, warnings)
    return run_log(store).where(F.col("etl_run_id") == run.run_id)


def run_log(store: Store) -> DataFrame:
    """The state of every run."""
    return latest_runs(store.log("etl_log"))


def published(store: Store) -> dict[str, DataFrame]:
    """The warehouse tables the reports read."""
    tables = {name: store.read(name) for name in store.names()}
    return {**tables, "etl_log": run_log(store)}
