"""A metric store that a stream can run into for months.

Below ``root``:

* ``runs/run=<name>/window_date=<d>/window_type=<t>/`` hold closed windows, which
  no later batch changes; a run is written by one commit and never touched.
* ``open/<name>/`` holds the windows that may still change. A batch's rows are
  upserted into them, and those that the watermark has passed move to a run.
  Their number depends on the watermark delay and not on the history.
* ``manifest/<version>.json`` names the runs, their dates and the open folder.
  A commit writes its folders first and its manifest last, in one rename, so
  that readers see all of a batch or nothing, and a batch that is replayed
  after a crash overwrites its own folders. One that was committed is skipped.

Runs are merged when ``FAN`` of a level have come together, so that a store of
n batches has about FAN * log(n) runs and a row is rewritten log(n) times.
Folders that none of the last ``KEEP`` manifests names are deleted: a reader
has that many commits' time to finish.

The watermark is not visible in ``foreachBatch``. A bound that is never ahead
of it is: events are at or after the start of their window, so the stream's
watermark for a batch is at least the latest window start of the batches before
minus the delay. Rows of older windows than that (corrections from elsewhere)
are not lost: their dates are merged and rewritten.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.operators.reshape import pick_latest
from transitlens.operators.sinks import STORE_PARTITIONS, with_store_partitions
from transitlens.schema import SERIES_KEYS
from transitlens.sources import files

#: Runs of a level that are merged, and manifests whose folders stay.
FAN, KEEP = 8, 3
#: Commits whose touched hours a manifest remembers.
CHANGES = 64
KEYS = [*SERIES_KEYS, "window_end"]


@dataclass(frozen=True)
class Run:
    name: str
    level: int
    dates: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    batch: int = -1
    runs: tuple[Run, ...] = ()
    open: str | None = None
    open_dates: tuple[str, ...] = ()
    closed_until: str | None = None
    latest_start: str | None = None
    expired_before: str | None = None
    schema: str | None = None
    #: (version, hours with rows of its commit, or None for all) of the last CHANGES commits.
    changes: tuple[tuple[int, tuple[str, ...] | None], ...] = ()
    facts: dict = field(default_factory=dict)

    @staticmethod
    def parse(text: str) -> Manifest:
        raw = json.loads(text)
        raw["runs"] = tuple(Run(r["name"], r["level"], tuple(r["dates"])) for r in raw["runs"])
        raw["open_dates"] = tuple(raw["open_dates"])
        raw["changes"] = tuple((version, hours if hours is None else tuple(hours)) for version, hours in raw["changes"])
        return Manifest(**raw)

    def changed(self, hours: Iterable[str] | None) -> Manifest:
        """The next commit touches these hours."""
        entry = (self.version + 1, None if hours is None else tuple(sorted(hours)))
        return replace(self, changes=(*self.changes, entry)[-CHANGES:])

    def touched_since(self, version: int) -> set[str] | None:
        """Hours touched by commits after ``version``; None if they are all or no longer known."""
        if version >= self.version:
            return set()
        if not self.changes or self.changes[0][0] > version + 1:
            return None
        later = [hours for v, hours in self.changes if v > version]
        return None if None in later else {h for hours in later for h in hours}

    @property
    def dates(self) -> list[str]:
        """All dates with rows, newest first."""
        return sorted({*self.open_dates, *(d for r in self.runs for d in r.dates)}, reverse=True)


class MetricStore:
    """One store; a single writer, any number of readers."""

    def __init__(self, spark: SparkSession, root: str, delay: dt.timedelta = dt.timedelta(minutes=1)):
        self.spark, self.root, self.delay = spark, root.rstrip("/"), delay

    # Manifests

    def _versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in files.names(self.spark, f"{self.root}/manifest") if n[0].isdigit())

    def _read(self, version: int) -> Manifest:
        return Manifest.parse(files.read_text(self.spark, f"{self.root}/manifest/{version:012d}.json"))

    def manifest(self) -> Manifest:
        versions = self._versions()
        return self._read(versions[-1]) if versions else Manifest()

    def _publish(self, m: Manifest) -> Manifest:
        m = replace(m, version=m.version + 1)
        files.write_text(self.spark, f"{self.root}/manifest/{m.version:012d}.json", json.dumps(asdict(m)))
        self.vacuum()
        return m

    # Reading

    def _schema(self, m: Manifest) -> T.StructType:
        return T.StructType.fromJson(json.loads(m.schema))

    def _runs(self, m: Manifest, dates: Iterable[str] | None) -> DataFrame:
        """Rows of the runs, only of ``dates`` if given: one scan of just these dates' folders."""
        schema = T.StructType([*(f for f in self._schema(m) if f.name not in STORE_PARTITIONS),
                               T.StructField("window_date", T.DateType()), T.StructField("window_type", T.StringType())])
        wanted = None if dates is None else set(dates)
        # Dates that a run no longer owns (expired or rewritten) may still lie in its folder.
        paths = [f"{self.root}/runs/run={r.name}/window_date={d}" for r in m.runs for d in r.dates if wanted is None or d in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema.add("run", T.StringType())).option("basePath", f"{self.root}/runs").parquet(*paths)
        return rows.drop("run")

    def _open(self, m: Manifest) -> DataFrame | None:
        return self.spark.read.schema(self._schema(m)).parquet(f"{self.root}/open/{m.open}") if m.open else None

    def read(self, start: dt.date | None = None, end: dt.date | None = None, window_type: str | None = None,
             dates: list[str] | None = None, at: Manifest | None = None) -> DataFrame:
        """The current rows with ``window_date``; only the folders of the asked dates are listed and read."""
        m = at or self.manifest()
        if m.schema is None:
            raise FileNotFoundError(f"no metric store at {self.root}")
        dates = [d for d in (m.dates if dates is None else dates)
                 if (start is None or d >= start.isoformat()) and (end is None or d <= end.isoformat())]
        out = self._runs(m, dates)
        opened = self._open(m)
        if opened is not None and set(dates) & set(m.open_dates):
            out = out.unionByName(with_store_partitions(opened).filter(
                F.col("window_date").isin([dt.date.fromisoformat(d) for d in dates])))
        return out if window_type is None else out.filter(F.col("window_type") == window_type)

    def newest(self, n: int, condition: Column | None = None) -> DataFrame:
        """Rows that include the ``n`` latest window ends (of those that meet ``condition``).

        Dates are opened from the newest on, twice as many each time, until
        they hold ``n`` rows; earlier dates can't have later windows.
        """
        m = self.manifest()
        dates, taken = m.dates, 1
        while True:
            rows = self.read(dates=dates[:taken], at=m)
            rows = rows if condition is None else rows.filter(condition)
            if taken >= len(dates) or rows.limit(n).count() >= n:
                return rows
            taken *= 2

    # Writing

    def _write_run(self, rows: DataFrame, name: str) -> None:
        (with_store_partitions(rows).hint("rebalance", *STORE_PARTITIONS).write.mode("overwrite")
         .partitionBy(*STORE_PARTITIONS).parquet(f"{self.root}/runs/run={name}"))

    def _tiered(self, m: Manifest, label: str) -> Manifest:
        """Levels with ``FAN`` runs or more merged into one run of the next level."""
        level = 0
        while level <= max((r.level for r in m.runs), default=-1):
            mine = [r for r in m.runs if r.level == level]
            if len(mine) >= FAN:
                name = f"{label}-level{level + 1}"
                part = replace(m, runs=tuple(mine))
                self._write_run(self._runs(part, None), name)
                dates = tuple(sorted({d for r in mine for d in r.dates}))
                m = replace(m, runs=(*(r for r in m.runs if r.level != level), Run(name, level + 1, dates)))
            level += 1
        return m

    def load(self, rows: DataFrame, facts: dict | None = None) -> Manifest:
        """Rows of closed windows that the store doesn't have yet, as one run.

        ``facts`` may be a callable: it is asked after the write, when observed metrics are known.
        """
        m = self.manifest()
        name = f"load-{m.version + 1:012d}"
        self._write_run(rows, name)
        dates = tuple(sorted(n.partition("=")[2] for n in files.names(self.spark, f"{self.root}/runs/run={name}") if n.startswith("window_date=")))
        schema = m.schema or json.dumps(T.StructType([f for f in rows.schema if f.name != "window_date"]).jsonValue())
        m = replace(m, runs=(*m.runs, Run(name, 0, dates)), schema=schema, facts={**m.facts, **((facts() if callable(facts) else facts) or {})})
        return self._publish(self._tiered(m.changed(None), name))

    def commit(self, batch: DataFrame, batch_id: int) -> bool:
        """Upsert one micro-batch; false if it was committed before."""
        m = self.manifest()
        if batch_id <= m.batch:
            return False
        schema = m.schema or json.dumps(batch.schema.jsonValue())
        m = replace(m, schema=schema)
        name, columns = f"batch-{batch_id:012d}", [f.name for f in self._schema(m)]
        newer = batch.select(*columns).withColumn("_version", F.lit(1)).persist()
        opened = self._open(m)
        merged = newer if opened is None else opened.withColumn("_version", F.lit(0)).unionByName(newer)
        merged = pick_latest(merged, KEYS, "_version").select(*columns).persist()
        try:
            end = F.col("window_end").cast("timestamp")
            limit = F.lit(m.closed_until).cast("timestamp")
            closed = F.coalesce(end <= limit, F.lit(False))
            hours = newer.select(F.date_trunc("hour", "window_start").cast("timestamp_ntz").cast("string")).distinct().collect()
            m = m.changed(r[0] for r in hours)
            stats = merged.groupBy(closed.alias("closed"), F.to_date("window_end").cast("string").alias("date")).agg(
                F.max(F.col("window_start").cast("timestamp")).alias("start"), F.min(end).alias("first")).collect()
            starts = [s["start"] for s in stats] + ([dt.datetime.fromisoformat(m.latest_start)] if m.latest_start else [])
            closed_dates = tuple(sorted(s["date"] for s in stats if s["closed"]))
            if any(r["closed"] for r in stats):
                known = {d for r in m.runs for d in r.dates}
                late = set(closed_dates) & known if self._late(m, merged.filter(closed)) else set()
                rows = merged.filter(closed)
                if late:  # corrections of closed windows: their dates are written anew
                    old = self._runs(m, late).drop("window_date").select(*columns).withColumn("_version", F.lit(0))
                    rows = pick_latest(old.unionByName(rows.withColumn("_version", F.lit(1))), KEYS, "_version").select(*columns)
                    m = replace(m, runs=tuple(x for r in m.runs if (x := replace(r, dates=tuple(d for d in r.dates if d not in late))).dates))
                self._write_run(rows, name)
                m = replace(m, runs=(*m.runs, Run(name, 0, closed_dates)))
            still = [s for s in stats if not s["closed"]]
            if still:
                merged.filter(~closed).write.mode("overwrite").parquet(f"{self.root}/open/{name}")
            latest = max(starts, default=None)
            m = replace(m, batch=batch_id, open=name if still else None, open_dates=tuple(sorted(s["date"] for s in still)),
                        latest_start=latest and latest.isoformat(), closed_until=latest and (latest - self.delay).isoformat())
        finally:
            merged.unpersist()
            newer.unpersist()
        self._publish(self._tiered(m, name))
        return True

    def _late(self, m: Manifest, rows: DataFrame) -> bool:
        """Whether closed rows meet a window that a run already has."""
        dates = [r[0] for r in rows.select(F.to_date("window_end").cast("string")).distinct().collect()]
        known = [d for d in dates if any(d in r.dates for r in m.runs)]
        if not known:
            return False
        both = self._runs(m, known).select(*KEYS).unionByName(rows.select(*KEYS))  # null keys are keys too
        return not both.groupBy(*KEYS).count().filter("count > 1").isEmpty()

    # Retention

    def expire(self, keep_from: dt.date) -> Manifest:
        """Dates before ``keep_from`` leave the store in one commit; their files go with ``vacuum``."""
        m = self.manifest()
        before = max(keep_from.isoformat(), m.expired_before or "")
        runs = tuple(x for r in m.runs if (x := replace(r, dates=tuple(d for d in r.dates if d >= before))).dates)
        opened = self._open(m)
        name, open_dates = m.open, m.open_dates
        if opened is not None and any(d < before for d in open_dates):
            open_dates = tuple(d for d in open_dates if d >= before)
            name = f"expired-{m.version + 1:012d}" if open_dates else None
            if name:
                opened.filter(F.to_date("window_end") >= F.lit(before).cast("date")).write.mode("overwrite").parquet(f"{self.root}/open/{name}")
        return self._publish(replace(m.changed(()), runs=runs, open=name, open_dates=open_dates, expired_before=before))

    def vacuum(self, keep: int = KEEP) -> None:
        """Delete what none of the last ``keep`` manifests names: old manifests, folders, and dates inside runs."""
        versions = self._versions()
        manifests = [self._read(v) for v in versions[-keep:]]
        dates: dict[str, set[str]] = {}
        for m in manifests:
            for r in m.runs:
                dates.setdefault(r.name, set()).update(r.dates)
        for name in (n.removeprefix("run=") for n in files.names(self.spark, f"{self.root}/runs") if n.startswith("run=")):
            if name not in dates:
                files.delete(self.spark, f"{self.root}/runs/run={name}")
                continue
            for part in files.names(self.spark, f"{self.root}/runs/run={name}"):
                if part.startswith("window_date=") and part.partition("=")[2] not in dates[name]:
                    files.delete(self.spark, f"{self.root}/runs/run={name}/{part}")
        opened = {m.open for m in manifests}
        for name in files.names(self.spark, f"{self.root}/open"):
            if name not in opened:
                files.delete(self.spark, f"{self.root}/open/{name}")
        for v in versions[:-keep]:
            files.delete(self.spark, f"{self.root}/manifest/{v:012d}.json")
