"""What micro-batches leave behind for later ones: Parquet parts and a manifest of them.

Each micro-batch adds one small part per table. When a level holds ``merge_at`` parts (of a
date, for the history), they become one part of the next level, dealt into ``buckets`` by a
hash of the table's key. A later micro-batch opens the few parts of level 0 and, of all others,
only the buckets that its own keys fall into, so its cost follows its rows and not the history.

The manifest of a micro-batch lists the live parts and is written last: it commits the
batch's outputs and state at once. Readers follow the newest manifest; a replayed batch reads
its predecessor's, whose parts are kept until the next commit, and writes its own parts again.
"""

from __future__ import annotations

import datetime as dt
import json
from collections import defaultdict
from collections.abc import Callable, Collection, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.schema import CORE_COLUMNS, FEED_SCHEMA
from tidewatch.sources.work import (
    delete_folder, file_names, folder_exists, join_path, publish_text, read_text, subfolders,
)

# Parts of a level that are merged into one of the next, and hash buckets of merged parts.
MERGE_AT = 8
BUCKETS = 64

# Keys of a micro-batch up to which they are looked up by value, through the files' filters.
FEW_KEYS = 64

_ACCOUNT = "account_id"
_HISTORY = "history"
# Columns of each table, and the one that deals its rows into buckets.
_COLUMNS = {
    "accounts": {
        _ACCOUNT: "string",
        "last": "struct<epoch: bigint, txn_ts: timestamp, txn_id: string, country: string>",
    },
    "payees": {_ACCOUNT: "string", "beneficiary_id": "string", "paid": "bigint"},
    "keys": {"key": "string"},
    _HISTORY: {field.name: field.dataType.simpleString() for field in FEED_SCHEMA.fields
               if field.name in CORE_COLUMNS},
}
_DEALT_BY = {"accounts": _ACCOUNT, "payees": _ACCOUNT, "keys": "key", _HISTORY: _ACCOUNT}


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key; NULL has one too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def run_together(spark: SparkSession, jobs: Iterable[Callable[[], object]]) -> list:
    """Run independent Spark jobs side by side, so that small ones do not wait for each other."""
    jobs = list(jobs)
    with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


@dataclass(frozen=True)
class Part:
    """A folder with rows of a table; merged parts (level 1 on) hold a folder per bucket."""

    path: str
    level: int
    date: str | None = None
    buckets: tuple[int, ...] = ()

    def folders(self, wanted: Collection[int]) -> list[str]:
        if not self.level:
            return [self.path]
        return [join_path(self.path, f"bucket={b}") for b in self.buckets if b in wanted]


@dataclass
class Manifest:
    """The state after a micro-batch; -1 is the state before the first."""

    batch_id: int = -1
    buckets: int = BUCKETS
    parts: dict[str, list[Part]] = field(default_factory=dict)
    # Parts that this batch merged away; its predecessor still lists them.
    merged: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps({
            "batch_id": self.batch_id, "buckets": self.buckets, "merged": self.merged,
            "parts": {table: [[p.path, p.level, p.date, list(p.buckets)] for p in parts]
                      for table, parts in self.parts.items()},
        })

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        read = json.loads(text)
        parts = {table: [Part(path, level, date, tuple(buckets))
                         for path, level, date, buckets in rows]
                 for table, rows in read["parts"].items()}
        return cls(read["batch_id"], read["buckets"], parts, read["merged"])


class Commits:
    """The manifests below a stream's root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._folder = spark, join_path(root, "state", "manifests")

    def ids(self) -> list[int]:
        """Batch ids of the manifests kept, which are the newest two, ascending."""
        if not folder_exists(self._spark, self._folder):
            return []
        names = file_names(self._spark, self._folder)
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def newest(self, before: int | None = None) -> Manifest | None:
        """The newest manifest, or the newest of an earlier batch than ``before``."""
        known = [number for number in self.ids() if before is None or number < before]
        if not known:
            return None
        return Manifest.from_json(read_text(self._spark, self._path(known[-1])))

    def _path(self, batch_id: int) -> str:
        return join_path(self._folder, f"{batch_id}.json")

    def publish(self, manifest: Manifest) -> None:
        publish_text(self._spark, self._path(manifest.batch_id), manifest.to_json())
        for number in self.ids()[:-2]:
            delete_folder(self._spark, self._path(number))


class StateTables:
    """State below ``root``, a folder that all executors share, as a micro-batch finds it."""

    def __init__(
        self, spark: SparkSession, root: str, batch_id: int, *, merge_at: int = MERGE_AT,
        buckets: int = BUCKETS,
    ) -> None:
        self._spark, self._root, self._batch_id = spark, root, batch_id
        self._merge_at = merge_at
        self._commits = Commits(spark, root)
        known = self._commits.newest(before=batch_id)
        # The number of buckets is settled by the stream's first batch.
        self._before = known or Manifest(buckets=buckets)

    @property
    def buckets(self) -> int:
        return self._before.buckets

    @property
    def committed(self) -> bool:
        """Whether this micro-batch has been written to its end."""
        return self._batch_id in self._commits.ids()

    def _path(self, *parts: str) -> str:
        return join_path(self._root, "state", *parts)

    # ---- reading: everything before this batch --------------------------------

    def _read(self, table: str, folders: list[str]) -> DataFrame:
        columns = ", ".join(f"{name} {kind}" for name, kind in _COLUMNS[table].items())
        if not folders:
            return self._spark.createDataFrame([], columns)
        return self._spark.read.schema(columns).parquet(*map(self._path, folders))

    def _lookup(self, table: str, wanted: Collection[int]) -> DataFrame:
        parts = self._before.parts.get(table, [])
        return self._read(table, [f for part in parts for f in part.folders(wanted)])

    def accounts(self, wanted: Collection[int]) -> DataFrame:
        """The last row known of each account in some buckets, possibly in several parts."""
        return self._lookup("accounts", wanted)

    def payees(self, wanted: Collection[int]) -> DataFrame:
        """Payments counted per account and payee, possibly in several parts."""
        return self._lookup("payees", wanted)

    def keys(self, wanted: Collection[int], few: Collection[str | None] | None = None) -> DataFrame:
        """Unique keys seen in some buckets, possibly more than once; ``few`` narrows them
        to listed keys, which the files' Bloom filters and bounds then answer."""
        known = self._lookup("keys", wanted)
        if few is None:
            return known
        same = F.lit(False)
        for key in few:
            same = same | (F.col("key").isNull() if key is None else F.col("key") == F.lit(key))
        return known.filter(same)

    def history(self, since: Mapping[int, dt.date]) -> DataFrame:
        """Clean rows of earlier batches, per bucket from the date it asks for on.

        Parts of level 0 are read from the earliest of these dates on.
        """
        folders = []
        for part in self._before.parts.get(_HISTORY, []):
            day = dt.date.fromisoformat(part.date)
            folders += part.folders({b for b, first in since.items() if day >= first}) if any(
                day >= first for first in since.values()) else []
        return self._read(_HISTORY, folders).select(*CORE_COLUMNS)

    # ---- writing: this batch ------------------------------------------------

    def record(self, clean: DataFrame, dates: Iterable[dt.date], keys: DataFrame) -> list[Callable]:
        """Jobs that write this batch's parts; ``dates`` are those of the clean rows."""
        row = F.struct(
            F.col("txn_ts").cast("long").alias("epoch"), "txn_ts", "txn_id", "country")
        last = clean.select(_ACCOUNT, row.alias("last"))
        paid = clean.select(_ACCOUNT, "beneficiary_id", F.lit(1).cast("long").alias("paid"))
        dated = clean.select(*CORE_COLUMNS, F.to_date("txn_ts").alias("event_date"))
        self._new = {name: [Part(self._name(name, 0), 0)] for name in ("accounts", "payees", "keys")}
        self._new[_HISTORY] = [
            Part(join_path(self._name(_HISTORY, 0), f"event_date={day}"), 0, str(day))
            for day in sorted(dates)
        ]

        def put(table: str, frame: DataFrame, *partition_by: str) -> Callable[[], None]:
            writer = frame.write.mode("overwrite").partitionBy(*partition_by)
            return lambda: writer.parquet(self._path(self._name(table, 0)))

        return [
            put("accounts", fold_accounts(last)), put("payees", fold_payees(paid)),
            put("keys", keys.distinct()),
            put(_HISTORY, dated.filter(F.col("event_date").isNotNull()), "event_date"),
        ]

    def _name(self, table: str, level: int) -> str:
        return join_path(table, f"{level}-{self._batch_id}")

    def commit(self) -> None:
        """Merge full levels, write the manifest, delete what no replay can ask for."""
        after = Manifest(self._batch_id, self.buckets)
        tables = list(_COLUMNS)
        merged = run_together(self._spark, [
            lambda table=table: self._merged(
                table, self._before.parts.get(table, []) + self._new[table])
            for table in tables
        ])
        for table, (parts, gone) in zip(tables, merged, strict=True):
            after.parts[table] = parts
            after.merged += gone
        self._commits.publish(after)
        for path in self._before.merged:
            delete_folder(self._spark, self._path(path))

    def _merged(self, table: str, parts: list[Part]) -> tuple[list[Part], list[str]]:
        """(live parts, paths merged away), with fewer than ``merge_at`` parts a level and date."""
        gone: list[str] = []
        while True:
            groups: dict[tuple, list[Part]] = defaultdict(list)
            for part in parts:
                groups[part.level, part.date or ""].append(part)
            full = [key for key, group in groups.items() if len(group) >= self._merge_at]
            if not full:
                return parts, gone
            for level, date in full:
                old = groups[level, date]
                parts = [p for p in parts if p not in old]
                parts.append(self._merge(table, old, level + 1, date or None))
                gone += [part.path for part in old]

    def _merge(self, table: str, parts: list[Part], level: int, date: str | None) -> Part:
        every = range(self.buckets)
        rows = self._read(table, [f for part in parts for f in part.folders(every)])
        key = _DEALT_BY[table]
        dealt = _FOLDS[table](rows).withColumn("bucket", bucket_of(F.col(key), self.buckets))
        path = self._name(table, level)
        if date:
            path = join_path(path, f"event_date={date}")
        writer = dealt.repartition("bucket").sortWithinPartitions("bucket", key).write
        writer.mode("overwrite").option(
            f"parquet.bloom.filter.enabled#{key}", "true"
        ).partitionBy("bucket").parquet(self._path(path))
        found = [int(name.removeprefix("bucket=")) for name in
                 subfolders(self._spark, self._path(path)) if name.startswith("bucket=")]
        return Part(path, level, date, tuple(sorted(found)))


def fold_accounts(parts: DataFrame) -> DataFrame:
    """One row per account: the latest by time, then id."""
    return parts.groupBy(_ACCOUNT).agg(F.max("last").alias("last"))


def fold_payees(parts: DataFrame) -> DataFrame:
    return parts.groupBy(_ACCOUNT, "beneficiary_id").agg(F.sum("paid").alias("paid"))


_FOLDS = {
    "accounts": fold_accounts, "payees": fold_payees,
    "keys": lambda rows: rows.distinct(), _HISTORY: lambda rows: rows,
}
