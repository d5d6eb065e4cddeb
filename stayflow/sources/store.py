"""Layered tables as immutable Parquet folders plus one small commit record per run.

A table is a set of *segments*; a segment is a folder that is written once and replaced by
a newer folder, never edited. What a run wrote becomes visible in one step, when its
commit record appears: staging, dimensions, facts, marts and feed offsets move together or
not at all, and a run that failed half-way is simply repeated under the same number.

Segments keep the rewrite small:

* staging tables and marts have one segment, replaced whole;
* keyed tables (current dimension rows, facts) are cut by ranges of the business key, and
  a run rewrites only the ranges its delta falls into. New keys usually grow upwards and
  corrections concern recent keys, so old ranges stay untouched;
* closed dimension versions and rejected rows are added, one segment a run; ten segments of a
  level become one of the next, so there are few however many runs there were.

Commit records lie in epochs. The first record of an epoch holds the whole state, so only the
records of the latest epoch are ever read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.schemas import QUARANTINE_SCHEMA, RAW_SCHEMAS, TABLE_SCHEMAS, conform

WHOLE = "all"
# The path of a segment that has no rows.
EMPTY = ""
# Keys per segment of a keyed table; at about 100 bytes a row a full segment is some 10 GB.
SEGMENT_WIDTH = 100_000_000
# Ranges wrap around at this number, so sparse keys cannot make a segment each.
MAX_SEGMENTS = 4096
# Runs of one epoch of commit records, and segments of a level that are folded into one.
EPOCH_RUNS = 10
FOLD = 10
COMMIT_SCHEMA = "run_id bigint, batch_ts string, kind string, name string, item string, value string"


def segment_of(key: str, width: int) -> Column:
    """The key range a row belongs to, as a number. A key of more than 18 digits goes by what stands
    before its last nine digits, hashed, so close ones stay together too."""
    by_range = f"pmod(cast({key} as bigint) div {width}, {MAX_SEGMENTS})"
    digits = f"cast({key} as string)"
    by_head = f"pmod(xxhash64(left({digits}, length({digits}) - 9)), {MAX_SEGMENTS})"
    return F.expr(f"case when abs({key}) < 1000000000000000000 then {by_range} else {by_head} end")


def ranges_bitmap(key: str, width: int) -> Column:
    """Aggregate of the key ranges that rows fall into, to be observed while they are written."""
    return F.bitmap_construct_agg(segment_of(key, width))


def ranges_in(bitmap: bytes | None) -> set[str]:
    return {str(8 * i + bit) for i, byte in enumerate(bitmap or b"") for bit in range(8) if byte >> bit & 1}


@dataclass(frozen=True)
class State:
    """What the commit records up to ``run_id`` say is live."""

    run_id: int = 0
    segments: dict[str, dict[str, str]] = field(default_factory=dict)
    offsets: dict[str, int] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)
    epoch: int | None = None


class Store:
    def __init__(self, spark: SparkSession, root: str, segment_width: int = SEGMENT_WIDTH):
        self.spark = spark
        self.root = root.rstrip("/")
        self.segment_width = segment_width

    # -- paths ---------------------------------------------------------------

    def raw_path(self, feed: str) -> str:
        return f"{self.root}/raw/{feed}"

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    # -- raw layer -----------------------------------------------------------

    def read_raw(self, feed: str) -> DataFrame:
        """The append-only raw table, partitioned by batch; empty before the first load."""
        try:
            return self.spark.read.schema(RAW_SCHEMAS[feed]).parquet(self.raw_path(feed))
        except AnalysisException as err:
            if "PATH_NOT_FOUND" not in str(err):
                raise
            return self.spark.createDataFrame([], RAW_SCHEMAS[feed])

    def append_raw(self, feed: str, rows: DataFrame) -> None:
        """Add whole batches. A replayed batch overwrites its own partition, so loading the
        same batch twice leaves one copy."""
        (
            conform(rows, RAW_SCHEMAS[feed])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch_id")
            .parquet(self.raw_path(feed))
        )

    # -- quarantine ----------------------------------------------------------

    def quarantine_path(self, feed: str) -> str:
        return f"{self.root}/quarantine/{feed}"

    def read_quarantine(self, feed: str) -> DataFrame:
        """Input of a feed that was delivered damaged, partitioned by batch like the raw table."""
        if not self.folders("quarantine", feed):
            return self.spark.createDataFrame([], QUARANTINE_SCHEMA)
        return self.spark.read.schema(QUARANTINE_SCHEMA).parquet(self.quarantine_path(feed))

    def append_quarantine(self, feed: str, rows: DataFrame) -> None:
        """Like ``append_raw``, a replayed batch replaces itself."""
        (
            conform(rows, QUARANTINE_SCHEMA)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch_id")
            .parquet(self.quarantine_path(feed))
        )

    # -- commits -------------------------------------------------------------

    def folders(self, *parts: str) -> list[str]:
        """Names in a folder of the store, none if it is missing."""
        spark = self.spark
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path(*parts))
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []

    def _latest_records(self) -> tuple[int | None, list]:
        """The latest epoch with a record, and its records: at most ``EPOCH_RUNS`` small files. An epoch whose
        first commit did not succeed has none."""
        epochs = (int(name.split("=")[1]) for name in self.folders("commits") if name.startswith("epoch="))
        for epoch in sorted(epochs, reverse=True):
            runs = [r for r in self.folders("commits", f"epoch={epoch}") if r.startswith("run=")]
            if runs:
                paths = [self.path("commits", f"epoch={epoch}", r) for r in runs]
                rows = self.spark.read.schema(COMMIT_SCHEMA).json(paths).collect()
                if rows:
                    return epoch, rows
        return None, []

    def state(self) -> State:
        """Latest committed value of every segment, offset and mark. One short string per live
        segment, and per run one for each that it rewrote."""
        epoch, records = self._latest_records()
        latest = {}
        for row in sorted(records, key=lambda r: r.run_id):
            latest[row.kind, row.name, row.item] = row
        run_id, segments, offsets, marks = 0, {}, {}, {}
        for row in latest.values():
            run_id = max(run_id, row.run_id)
            if row.kind == "segment":
                table = segments.setdefault(row.name, {})
                if row.value is not None:
                    table[row.item] = row.value
            elif row.kind == "offset":
                offsets[row.name] = int(row.value)
            elif row.kind == "mark":
                marks[row.name] = int(row.value)
        return State(run_id, segments, offsets, marks, epoch)

    def read(self, table: str) -> DataFrame:
        """The committed rows of a table; empty with the declared schema before its first load."""
        return self._read_segments(table, self.state().segments.get(table, {}))

    def _read_segments(self, table: str, segments: dict[str, str]) -> DataFrame:
        schema = TABLE_SCHEMAS[table]
        paths = [self.path(p) for p in sorted(segments.values()) if p != EMPTY]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def begin(self, run_id: int, batch_ts: str, state: State | None = None) -> Run:
        """``state`` if the caller has just read it."""
        return Run(self, state or self.state(), run_id, batch_ts)


@dataclass(frozen=True)
class Staged:
    """What was counted while a staging table was written: rows, bytes of text, key ranges."""

    rows: int
    text_bytes: int
    ranges: set[str]


class Run:
    """One run's view of the store: committed tables overlaid with what it wrote so far."""

    def __init__(self, store: Store, base: State, run_id: int, batch_ts: str):
        self.store, self.base, self.run_id, self.batch_ts = store, base, run_id, batch_ts
        self.written: dict[str, dict[str, str]] = {}
        self.folded: dict[str, set[str]] = {}  # segments that are part of a larger one now
        self.marks: dict[str, int] = {}
        self.staged: dict[str, Staged] = {}
        self.touched: dict[str, set[str]] = {}  # key ranges rewritten per table

    # -- reading -------------------------------------------------------------

    def segments(self, table: str) -> dict[str, str]:
        live = {**self.base.segments.get(table, {}), **self.written.get(table, {})}
        return {s: p for s, p in live.items() if s not in self.folded.get(table, ())}

    def read(self, table: str) -> DataFrame:
        return self.store._read_segments(table, self.segments(table))

    def read_ranges(self, table: str, ranges: set[str]) -> DataFrame:
        """Only the key ranges in ``ranges``; the other folders are not even listed."""
        live = {s: p for s, p in self.segments(table).items() if s in ranges}
        return self.store._read_segments(table, live)

    def read_current(self, table: str, ranges: set[str] | None = None) -> DataFrame:
        """Current rows of a versioned dimension, without touching the closed versions."""
        live = {
            s: p
            for s, p in self.segments(table).items()
            if not s.startswith("closed-") and (ranges is None or s in ranges)
        }
        return self.store._read_segments(table, live)

    def mark(self, name: str) -> int:
        return self.marks.get(name, self.base.marks.get(name, 0))

    # -- writing -------------------------------------------------------------

    def folder(self, table: str) -> str:
        return f"tables/{table}/run={self.run_id}"

    def work_path(self, name: str) -> str:
        return self.store.path("work", f"run={self.run_id}", name)

    def replace(self, table: str, df: DataFrame) -> None:
        """Full refresh: the table becomes exactly ``df``."""
        folder = f"{self.folder(table)}/{WHOLE}"
        self._write(table, df, folder)
        self.written[table] = {WHOLE: folder}

    def add(self, table: str, df: DataFrame, kind: str, part: str = "") -> str:
        """Append rows as one more segment of a kind."""
        segment = f"{kind}-0-{self.run_id}{part}"
        folder = f"{self.folder(table)}/{segment}"
        self._write(table, df, folder)
        self.written.setdefault(table, {})[segment] = folder
        return segment

    def leave_out(self, table: str, segment: str) -> None:
        """Leave a segment of this run out of the table again: it came out empty."""
        self.written[table].pop(segment)

    def fold(self, table: str, kind: str) -> None:
        """Write every ``FOLD`` segments of a level as one of the next level. A row is written
        again once a level, and a table has fewer than ``FOLD`` segments of each."""
        level = 0
        while True:
            live = {s: p for s, p in self.segments(table).items() if s.startswith(f"{kind}-{level}-")}
            if len(live) < FOLD:
                return
            level += 1
            segment = f"{kind}-{level}-{self.run_id}"
            folder = f"{self.folder(table)}/{segment}"
            self._write(table, self.store._read_segments(table, live), folder)
            self.written.setdefault(table, {})[segment] = folder
            self.folded.setdefault(table, set()).update(live)

    def replace_ranges(
        self, table: str, key: str, ranges: set[str], df: DataFrame, in_place: bool = False
    ) -> None:
        """Rewrite the given key ranges with ``df``, which must hold all their rows.

        The rebalance hint lets Spark cut a range over as many tasks as its size asks for
        and pack small ranges together, so files come out evenly sized. ``in_place``: the rows
        come straight from a scan of these ranges, so every task already holds one or few of
        them and the shuffle is saved.
        """
        if not ranges:
            return
        self.touched.setdefault(table, set()).update(ranges)
        folder = f"{self.folder(table)}/ranges"
        rows = conform(df, TABLE_SCHEMAS[table]).withColumn(
            "_range", segment_of(key, self.store.segment_width)
        )
        if len(ranges) > 1 and not in_place:
            rows = rows.hint("rebalance", "_range")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("_range").parquet(self.store.path(folder))
        self.written.setdefault(table, {}).update({r: f"{folder}/_range={r}" for r in ranges})

    def replace_parts(self, table: str, ranges: set[str], df: DataFrame, of_range: str) -> None:
        """Rewrite the given ranges of a table without keys of its own; ``of_range`` names the
        column with a row's range. Ranges may come out empty."""
        if not ranges:
            return
        folder = f"{self.folder(table)}/ranges"
        names = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLE_SCHEMAS[table].fields]
        rows = df.select(*names, F.col(of_range).alias("_range"))
        rows.hint("rebalance", "_range").write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy("_range").parquet(self.store.path(folder))
        made = set(self.store.folders(folder))
        live = {r: f"{folder}/_range={r}" if f"_range={r}" in made else EMPTY for r in ranges}
        self.written.setdefault(table, {}).update(live)

    def _write(self, table: str, df: DataFrame, folder: str) -> None:
        conform(df, TABLE_SCHEMAS[table]).write.mode("overwrite").parquet(self.store.path(folder))

    # -- commit --------------------------------------------------------------

    def commit(self, offsets: dict[str, int]) -> None:
        """Publish everything at once by writing the run's single commit file."""
        epoch = self.run_id // EPOCH_RUNS
        whole = epoch != self.base.epoch
        tables = {*self.written, *self.folded, *(self.base.segments if whole else ())}
        records = []
        for table in sorted(tables):
            live = self.segments(table)
            if WHOLE in live:
                live = {WHOLE: live[WHOLE]}
            before = {} if whole else self.base.segments.get(table, {})
            changed = {s: p for s, p in live.items() if before.get(s) != p}
            for item, value in {**changed, **{s: None for s in before if s not in live}}.items():
                records.append(("segment", table, item, value))
        if whole:
            offsets, self.marks = {**self.base.offsets, **offsets}, {**self.base.marks, **self.marks}
        records += [("offset", feed, "", str(hi)) for feed, hi in offsets.items()]
        records += [("mark", name, "", str(value)) for name, value in self.marks.items()]
        rows = [(self.run_id, self.batch_ts, *r) for r in records]
        spark = self.store.spark
        (
            spark.createDataFrame(rows, COMMIT_SCHEMA)
            .coalesce(1)
            .write.mode("overwrite")
            .json(self.store.path("commits", f"epoch={epoch}", f"run={self.run_id}"))
        )
