"""The stored tables as Parquet folders, written from the executors, listed by a commit log.

``detections`` holds attacks and flagged rows, ``traffic_counts`` one row per batch and
label, ``batches`` one row per batch with its totals and how long it took, ``alert_parts``
what each batch adds to the alerts.  A micro-batch writes folders of its own and then one commit that makes all of them
visible together; running it again - after a crash before or after that - replaces its
rows.  Nothing else ever changes or removes a file that a reader may be using: deleting,
replaying and compacting are commits too, and ``vacuum`` clears what no commit of the
last hours names.

The log keeps the range of labels, event times and processing times of every piece, so
readers choose files before Spark opens one.  Batch ids restart at zero with a new
checkpoint; a run id separates the lives of a stream.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import cached_property, reduce

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wardline.functions.expressions import total
from wardline.operators import rollups
from wardline.operators.prepare import detections, kept_rows, narrowed, sort_for_storage, traffic_counts
from wardline.schema import (
    ALERT_PARTS_SCHEMA,
    BATCHES_SCHEMA,
    COUNTS_SCHEMA,
    DISPLAY_TIME_ZONE,
    INCOMPLETE,
    RECORD_SCHEMA,
    UNPARSEABLE,
    detections_schema,
)
from wardline.sources import files
from wardline.streaming.commits import CommitConflict, CommitLog, State, both

#: When a row of each table was processed, and the event it tells of (epoch seconds, if any).
CLOCKS = {
    "detections": "processed_at", "traffic_counts": "batch_time", "batches": "batch_time", "alert_parts": "batch_time"
}
EVENT_TIME, LABEL = "timestamp", "label"

#: Time ranges that are passed to the files one by one; more are passed as the one that spans them.
RANGES = 200


@dataclass(frozen=True)
class BatchTotals:
    """What one batch contributed; three sums, whatever the batch size."""

    valid: int
    unparseable: int
    incomplete: int

    @property
    def messages(self) -> int:
        return self.valid + self.unparseable + self.incomplete


def _seconds(column: str) -> Column:
    return F.unix_micros(column) / F.lit(1e6)


def _ranges(table: str, columns: Iterable[str]) -> list[Column]:
    """Aggregates that say what a piece of a table holds."""
    clock = _seconds(CLOCKS[table])
    out = [F.count(F.lit(1)).alias("rows"), F.min(clock).alias("clock_low"), F.max(clock).alias("clock_high")]
    for name, column in (("event", EVENT_TIME), ("label", LABEL)):
        if column in columns:
            out += [F.min(column).alias(f"{name}_low"), F.max(column).alias(f"{name}_high")]
    return out


def _piece(path: str, found: dict) -> dict:
    sides = {n: [found.get(f"{n}_low"), found.get(f"{n}_high")] for n in ("clock", "event", "label") if f"{n}_low" in found}
    return {"path": path, "rows": found["rows"], **sides}


def _meets(piece: dict, name: str, spans: Sequence[tuple] | None) -> bool:
    """Whether a piece may hold a value inside one of the spans; one without a range may."""
    low, high = piece.get(name, (None, None))
    return spans is None or low is None or any(a <= high and b >= low for a, b in spans)


@dataclass(frozen=True)
class Snapshot:
    """The tables of a store at one commit."""

    store: Store
    state: State

    def _listed(self, table: str, run_id: str | None) -> list[tuple[dict, str | None]]:
        """Pieces of a table with the merge they belong to."""
        found = [
            (b["pieces"][table], None) for (run, _), b in self.state.batches.items()
            if table in b["pieces"] and run_id in (None, run)
        ]
        for name, merge in self.state.merges.items():
            if run_id is None or run_id in merge["holds"]:
                found += [(piece, name) for piece in merge["pieces"].get(table, ())]
        return found

    def _read(
        self, table: str, run_id: str | None, since: datetime | None,
        labels: Sequence[str] | None = None, spans: Sequence[tuple[float, float]] | None = None,
    ) -> DataFrame:
        spark, layout = self.store.spark, self.store.layout(table, self.state)
        recent = None if since is None else [(since.timestamp(), float("inf"))]
        wanted = [
            (piece, name) for piece, name in self._listed(table, run_id)
            if _meets(piece, "clock", recent) and _meets(piece, "event", spans)
            and _meets(piece, "label", None if labels is None else [(x, x) for x in labels])
        ]
        marked = {name for _, name in wanted if name and self.state.merges[name]["gone"]}
        frames = []
        for group in (None, *sorted(marked)):
            paths = [f"{self.store.base}/{p['path']}" for p, n in wanted if (n if n in marked else None) == group]
            if paths:
                rows = spark.read.schema(layout).parquet(*paths)
                frames.append(rows if group is None else rows.where(~_among(self.state.merges[group]["gone"])))
        if not frames:
            return spark.createDataFrame([], layout)
        rows = reduce(DataFrame.unionByName, frames)
        if run_id is not None:
            rows = rows.where(F.col("run_id") == run_id)
        if since is not None:
            rows = rows.where(F.col(CLOCKS[table]) >= F.lit(since))
        if labels is not None:
            rows = rows.where(F.col(LABEL).isin(list(labels)))
        if spans is not None:
            inside = [F.col(EVENT_TIME).between(F.lit(float(a)), F.lit(float(b))) for a, b in spans]
            rows = rows.where(reduce(Column.__or__, inside, F.lit(False)))
        return rows

    def detections(
        self, run_id: str | None = None, since: datetime | None = None,
        labels: Sequence[str] | None = None, spans: Sequence[tuple[float, float]] | None = None,
    ) -> DataFrame:
        """Stored rows of one run or all, from an instant of processing on, of some labels,
        with event times (epoch seconds) in one of some spans; each chooses files first."""
        return self._read("detections", run_id, since, labels, spans)

    def counts(self, run_id: str | None = None, since: datetime | None = None, labels: Sequence[str] | None = None) -> DataFrame:
        return self._read("traffic_counts", run_id, since, labels)

    def batches(self, run_id: str | None = None) -> DataFrame:
        """One row per batch; those not merged yet are in the log itself."""
        rows = [
            (b["batch"], datetime.fromisoformat(b["at"]), *b["totals"], b["ms"], run)
            for (run, _), b in self.state.batches.items() if run_id in (None, run)
        ]
        layout = self.store.layout("batches", self.state)
        return self.store.spark.createDataFrame(rows, layout).unionByName(self._read("batches", run_id, None))

    def alert_parts(self, run_id: str | None = None, since: datetime | None = None) -> DataFrame:
        return self._read("alert_parts", run_id, since)

    def alerts(self, run_id: str | None = None, zone: str = DISPLAY_TIME_ZONE) -> DataFrame:
        """The alerts of all stored rows, from what each batch has added to them."""
        return rollups.alerts_of(self.alert_parts(run_id), zone)

    def latency_over_time(self, since: datetime | None = None, run_id: str | None = None) -> DataFrame:
        """Latency per minute of processing, from sketches; see ``rollups.latency_of`` for the error."""
        return rollups.latency_of(self.alert_parts(run_id, since))

    def around(self, alert_rows: DataFrame, run_id: str | None = None) -> DataFrame:
        """Stored rows of the minutes that some alerts (``window_start_ts``) fall into.

        The minutes come to the driver if they are few, else the span of all of them;
        either way they choose files and row groups.
        """
        minutes = alert_rows.select(F.unix_seconds("window_start_ts").alias("at")).distinct()
        found = sorted(r["at"] for r in minutes.limit(RANGES + 1).collect())
        if len(found) > RANGES:
            found = list(minutes.agg(F.min("at"), F.max("at")).first())
            spans = [(found[0], found[1] + 60)]
        else:
            spans = [(at, at + 60) for at in found]
        rows = self.detections(run_id, spans=spans)
        minute = F.floor(F.floor(EVENT_TIME) / 60) * 60
        return rows.withColumn("_minute", minute).join(minutes, F.col("_minute") == F.col("at"), "left_semi").drop("_minute")


def _among(batches: Sequence[Sequence]) -> Column:
    """Rows of any of some batches."""
    runs: dict[str, list[int]] = {}
    for run, batch in batches:
        runs.setdefault(run, []).append(batch)
    tests = [(F.col("run_id") == run) & F.col("batch_id").isin(own) for run, own in runs.items()]
    return reduce(Column.__or__, tests)


@dataclass(frozen=True)
class Store:
    """The tables under one root folder."""

    spark: SparkSession
    root: str
    record_schema: StructType = RECORD_SCHEMA

    # --- schemas and places ---

    @property
    def base(self) -> str:
        return self.root.rstrip("/")

    @property
    def detections_type(self) -> StructType:
        return detections_schema(self.record_schema)

    def tables(self) -> dict[str, StructType]:
        return {"detections": self.detections_type, "traffic_counts": COUNTS_SCHEMA, "batches": BATCHES_SCHEMA, "alert_parts": ALERT_PARTS_SCHEMA}

    def layout(self, table: str, state: State) -> StructType:
        """Columns of a table's files: as stored, or as they will be."""
        kept = state.schemas.get(table)
        fields = (StructType.fromJson(kept) if kept else self.tables()[table]).fields
        return StructType([*fields, StructField("run_id", StringType())])

    @cached_property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.base)

    # --- life cycle ---

    def ensure_tables(self) -> None:
        """Create the tables if absent, add new nullable columns; refuse any other change of columns."""
        def change(state: State) -> dict:
            fresh = {}
            for table, wanted in self.tables().items():
                kept = state.schemas.get(table)
                if kept is None or grown(StructType.fromJson(kept), wanted, table):
                    fresh[table] = json.loads(wanted.json())
            return {"schemas": fresh}

        self.log.commit(change)

    def reset(self) -> None:
        """Drop every row of the tables, and their files, and keep the tables."""
        self.log.commit(lambda state: {"reset": True, "schemas": {t: json.loads(s.json()) for t, s in self.tables().items()}})
        for table in self.tables():
            files.delete(self.spark, f"{self.base}/{table}")

    def delete_batch(self, batch_id: int, run_id: str = "main") -> None:
        """Drop one batch, whatever day it is of and whether that is compacted or not."""
        self.log.commit(lambda state: state.without(run_id, batch_id))

    def compact(self, day: date) -> None:
        """Bring what a day's batches have stored so far into few files, ordered by label and time.

        May run at any time, also while the day goes on: batches that come, go or are
        replayed meanwhile keep what they did.  Rows are counted before and after.
        """
        snapshot = self.snapshot()
        own = {k: b for k, b in snapshot.state.batches.items() if b["day"] == str(day)}
        old = {n: m for n, m in snapshot.state.merges.items() if m["day"] == str(day)}
        if not own and (len(old) < 2 and not any(m["gone"] for m in old.values())):
            return
        part = Snapshot(self, State(snapshot.state.version, snapshot.state.schemas, own, old))
        name, pieces = uuid.uuid4().hex, {}
        sources = {"detections": part.detections(), "traffic_counts": part.counts(), "batches": part.batches(), "alert_parts": part.alert_parts()}
        for table, rows in sources.items():
            order = [c for c in (LABEL, EVENT_TIME if EVENT_TIME in rows.columns else CLOCKS[table]) if c in rows.columns]
            folder = f"{table}/{day}/{name}"
            merged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
            merged.write.parquet(f"{self.base}/{folder}")
            written = self.spark.read.schema(rows.schema).parquet(f"{self.base}/{folder}")
            found = written.groupBy(F.input_file_name().alias("file")).agg(*_ranges(table, rows.columns)).collect()
            pieces[table] = [_piece(f"{folder}/{r['file'].rpartition('/')[2]}", r.asDict()) for r in found]
            before, after = rows.count(), sum(p["rows"] for p in pieces[table])
            if before != after:
                raise RuntimeError(f"{table} of {day}: {before} rows before, {after} after; nothing was changed")
        holds: dict[str, list[int]] = {}
        for run, low, high in [(r, b, b) for r, b in own] + [(r, *span) for m in old.values() for r, span in m["holds"].items()]:
            holds[run] = [min(low, *holds.get(run, [low])), max(high, *holds.get(run, [high]))]

        def change(state: State) -> dict:
            if any(n not in state.merges for n in old):
                raise CommitConflict(f"another compaction of {day} came first")
            same = [k for k, b in own.items() if state.batches.get(k) == b]
            gone = [list(k) for k in own if k not in same]  # deleted or replayed since
            gone += [g for n, m in old.items() for g in state.merges[n]["gone"] if g not in m["gone"]]
            # A batch that was replayed before is in own and may be in what was gone from old: it is merged once.
            entry = {"id": name, "day": str(day), "holds": holds, "gone": gone, "pieces": pieces}
            return {"merge": [entry], "unmerge": list(old), "drop": [list(k) for k in same]}

        self.log.commit(change)

    def vacuum(self, keep: timedelta = timedelta(days=1)) -> int:
        """Delete folders that no commit names and that are older than ``keep``; how many there were.

        Readers pinned to an older commit, and writers that have not committed yet, must be younger.
        """
        state, limit, count = self.log.read(), time.time() - keep.total_seconds(), 0
        used = state.folders()
        for table in self.tables():
            for path, changed in files.dated(self.spark, f"{self.base}/{table}/*/*"):
                if "/".join(path.split("/")[-3:]) not in used and changed <= limit:
                    files.delete(self.spark, path)
                    count += 1
        self.log.shorten()
        return count

    # --- reading ---

    def snapshot(self) -> Snapshot:
        """The newest commit; all that is read from it belongs together."""
        return Snapshot(self, self.log.read())

    def detections(self, run_id: str | None = None, since: datetime | None = None, **chosen) -> DataFrame:
        return self.snapshot().detections(run_id, since, **chosen)

    def counts(self, run_id: str | None = None, since: datetime | None = None, **chosen) -> DataFrame:
        return self.snapshot().counts(run_id, since, **chosen)

    def batches(self, run_id: str | None = None) -> DataFrame:
        return self.snapshot().batches(run_id)

    # --- writing ---

    def write_batch(
        self,
        evaluated: DataFrame,
        batch_id: int,
        run_id: str = "main",
        now: datetime | None = None,
        cached: bool = True,
    ) -> BatchTotals:
        """Store one evaluated micro-batch.

        All tables are fed from one cached evaluation that may spill to disk, and that holds
        a word per quiet row and whole rows of detections only.  The counts are written
        first: they read each message once, whatever executor has it, while jobs at the same
        time would have several of them evaluate the same rows.  ``cached=False`` evaluates
        once per table.  One clock value stamps the whole batch.  Nothing but sums and ranges,
        taken while the tables are written, returns to the driver.
        """
        began = time.monotonic()
        clock = now or datetime.now(timezone.utc)
        stamp, tag = F.lit(clock).cast("timestamp"), F.lit(batch_id)
        day = clock.astimezone(timezone.utc).date()
        place = f"{day}/{uuid.uuid4().hex}"

        def written(table: str, rows: DataFrame, extra: Sequence[Column] = ()) -> dict:
            seen = Observation()
            ranged = rows.withColumn("run_id", F.lit(run_id)).observe(seen, *_ranges(table, rows.columns), *extra)
            ranged = sort_for_storage(ranged) if table == "detections" else ranged
            folder = f"{self.base}/{table}/{place}"
            ranged.write.parquet(folder)
            try:
                return seen.get
            except Py4JJavaError:  # a plan that turned out empty may lose its observation
                back = self.spark.read.schema(self.layout(table, State())).parquet(folder)
                return back.agg(*_ranges(table, rows.columns), *extra).first().asDict()

        n = F.col("record_count")
        sums = [
            total(F.when(F.col("label") == UNPARSEABLE, n)).alias("unparseable"),
            total(F.when(F.col("label") == INCOMPLETE, n)).alias("incomplete"),
            total(n).alias("messages"),
        ]
        rows = narrowed(evaluated).persist(StorageLevel.MEMORY_AND_DISK) if cached else evaluated
        kept = detections(kept_rows(rows) if cached else rows, tag, stamp, self.record_schema)
        jobs = {"detections": kept, "alert_parts": rollups.alert_parts(kept)}
        try:
            found = {"traffic_counts": written("traffic_counts", traffic_counts(rows, tag, stamp), sums)}
            with ThreadPoolExecutor(len(jobs)) as pool:
                start = inheritable_thread_target(self.spark)(written)
                running = {table: pool.submit(start, table, job) for table, job in jobs.items()}
                found |= {table: job.result() for table, job in running.items()}
        finally:
            if cached:
                rows.unpersist()
        seen = found["traffic_counts"]
        broken = seen["unparseable"] + seen["incomplete"]
        totals = BatchTotals(seen["messages"] - broken, seen["unparseable"], seen["incomplete"])
        entry = {
            "run": run_id, "batch": batch_id, "day": str(day), "at": clock.astimezone(timezone.utc).isoformat(),
            "totals": [totals.messages, totals.valid, totals.unparseable, totals.incomplete],
            "ms": round(1000 * (time.monotonic() - began)),
            "pieces": {t: _piece(f"{t}/{place}", f) for t, f in found.items() if f["rows"]},
        }
        self.log.commit(lambda state: both(state.without(run_id, batch_id), {"put": [entry]}))
        return totals

    def round_trip(self, run_id: str, written: DataFrame) -> DataFrame:
        """Per label, rows that should be in a run's detections against rows that are, value for value.

        ``written`` has the stored columns; array order and every value must have come back.
        """
        names = [f for f in self.detections_type.fieldNames() if f not in ("batch_id", "processed_at", "latency_seconds")]
        types = self.detections_type
        back = self.detections(run_id=run_id)

        def tallied(rows: DataFrame, side: str) -> DataFrame:
            digest = F.xxhash64(*[F.col(f"`{n}`") for n in names])
            return rows.select("label", digest.alias("digest"), F.lit(side).alias("side"))

        both = tallied(written, "written").unionByName(tallied(back, "read"))
        alike = all(back.schema[n].dataType == types[n].dataType for n in names)
        value = F.col("digest").cast("decimal(38,0)")
        return both.groupBy("label").agg(
            F.count_if(F.col("side") == "written").alias("written"),
            F.count_if(F.col("side") == "read").alias("read_back"),
            F.coalesce(
                F.sum(F.when(F.col("side") == "written", value).otherwise(-value)) == 0, F.lit(False)
            ).alias("same_values"),
            F.lit(alike).alias("same_types"),
        )


def grown(kept: StructType, wanted: StructType, table: str) -> bool:
    """Whether ``wanted`` adds columns to ``kept``; anything but added nullable columns is refused."""
    known = {f.name: f for f in wanted.fields}
    for f in kept.fields:
        if f.name not in known:
            raise ValueError(f"{table}: column {f.name} is stored and would be lost")
        if known[f.name].dataType != f.dataType:
            raise ValueError(f"{table}: column {f.name} is stored as {f.dataType.simpleString()}, not {known[f.name].dataType.simpleString()}")
    added = [f for f in wanted.fields if f.name not in kept.fieldNames()]
    if any(not f.nullable for f in added):
        raise ValueError(f"{table}: added columns must be nullable")
    return bool(added)
