"""The stream with state per key in Spark's state store instead of tables.

A micro-batch then costs what its own rows cost, however long the history is: state has an
item per unique key seen, and per account its last row, one per payee, and one per day with
totals per second, for a day and the stated lateness. Keys are dealt into groups by hash, so
that a task works out many accounts at once instead of calling Python for each; the items of a
group lie in pages, so that a task asks the state store once for many of them.
Rows that arrive up to the lateness after the newest row of their account are judged as
``micro_batch`` judges them; later ones against what is kept. Needs the RocksDB state store.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping
from typing import Any
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import (
    StatefulProcessor, StatefulProcessorHandle, StreamingQuery,
)

from tidewatch.functions import money
from tidewatch.functions.rules import compile_rules
from tidewatch.operators.features import DAY_SECONDS, HOUR_SECONDS, NO_TIME
from tidewatch.operators.gate import label_failures, split_dq
from tidewatch.operators.reports import batch_counters, top_batch_alerts
from tidewatch.operators.scoring import configured_alerts, project_alerts, score_derived, tag_run
from tidewatch.schema import CORE_COLUMNS
from tidewatch.sources.feed import stream_feed
from tidewatch.sources.work import cached, join_path
from tidewatch.streaming.micro_batch import FILES_PER_TRIGGER, TRIGGER_SECONDS
from tidewatch.streaming.state import Commits, Manifest, bucket_of, run_together

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"

_TIES = [name for name in CORE_COLUMNS if name not in ("account_id", "txn_id", "txn_ts")]
_ROW_ORDER = ["txn_ts", "txn_id", *_TIES]
_SUMS = ["n", *money.ARRAY_COUNTS]
# How much later than an account's newest row a row may come and still meet all it should.
LATENESS_SECONDS = 7 * DAY_SECONDS


# Groups that keys are dealt into; fixed for a stream's life, like its shuffle partitions.
BUCKETS = 128
_UNDECIDED = -1
# Epochs of any date and the accounts of a group share one 64-bit number.
_EPOCH_SPAN = 2**38
# Characters of a page of state items, beyond which it is cut into sixteen.
PAGE_CHARS = 16_384
_PAGED = ("page string", "items string")
_CUT = "cut"


def _named(values: pd.Series) -> pd.Series:
    """Values as state keys; a missing one has its own."""
    return values.map(lambda value: "-" if pd.isna(value) else f"+{value}").astype(object)


def _earliest_first(rows: pd.DataFrame, ties: list[str]) -> pd.DataFrame:
    """Arrival order of the batch gate: by time, without a time last, then by the ``ties``."""
    rows = rows.sort_values(ties, kind="stable", na_position="first")
    return rows.sort_values("txn_ts", kind="stable", na_position="last")


def _digits(name: str) -> str:
    return f"{crc32(name.encode('utf-8', 'surrogatepass')):08x}"


class Pages:
    """Items by name in a map state, many of them in one entry.

    A page holds the items whose names' hashes begin with its own name, as JSON. One that grows
    beyond ``PAGE_CHARS`` is cut by the next digit, so pages stay small however many items there
    are; an item larger than that has a page of its own.
    """

    def __init__(self, state) -> None:
        self._state = state
        self._pages: dict[str, dict[str, Any] | None] = {}
        self._home: dict[str, str] = {}
        self._changed: set[str] = set()

    def open(self, names: Iterable[str]) -> None:
        """Read the pages of some names, which can then be asked for and changed."""
        new = [name for name in dict.fromkeys(names) if name not in self._home]
        self._descend("", [(name, _digits(name)) for name in new])

    def _descend(self, page: str, names: list[tuple[str, str]]) -> None:
        if page not in self._pages:
            held = self._state.getValue((page,))
            text = held[0] if held else "{}"
            self._pages[page] = None if text == _CUT else json.loads(text)
        if self._pages[page] is not None:
            self._home.update((name, page) for name, _ in names)
            return
        below = defaultdict(list)
        for name, digits in names:
            below[digits[len(page)]].append((name, digits))
        for digit, some in below.items():
            self._descend(page + digit, some)

    def get(self, name: str) -> Any:
        return self._pages[self._home[name]].get(name)

    def put(self, name: str, item: Any) -> None:
        page = self._home[name]
        self._pages[page][name] = item
        self._changed.add(page)

    def remove(self, name: str) -> None:
        page = self._home[name]
        if self._pages[page].pop(name, None) is not None:
            self._changed.add(page)

    def save(self) -> None:
        """Write the changed pages; nothing can be asked for afterwards."""
        for page in self._changed:
            self._write(page, self._pages[page])
        self._pages, self._home, self._changed = {}, {}, set()

    def _write(self, page: str, items: dict[str, Any]) -> None:
        if page and not items:
            self._state.removeKey((page,))
            return
        text = json.dumps(items)
        if len(text) <= PAGE_CHARS or len(items) == 1 or len(page) == 8:
            self._state.updateValue((page,), (text,))
            return
        self._state.updateValue((page,), (_CUT,))
        below = defaultdict(dict)
        for name, item in items.items():
            below[_digits(name)[len(page)]][name] = item
        for digit, some in below.items():
            self._write(page + digit, some)


class FirstOfKey(StatefulProcessor):
    """Flags every row of a key but the first one ever, earliest of its micro-batch.

    A group holds many keys. Rows without a key are dealt over all groups: the first of them
    in each group stays undecided, with a missing flag, for :class:`FirstOfMissing` to settle.
    """

    def __init__(self, key: str, ties: list[str]) -> None:
        self._key, self._ties = key, ties

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getMapState("seen", *_PAGED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        seen = Pages(self._seen)
        best = None
        for chunk in rows:
            chunk = chunk.assign(name=_named(chunk[self._key]))
            seen.open(chunk["name"])
            old = np.array([seen.get(name) is not None for name in chunk["name"]], dtype=bool)
            # Hold back the best row of each new key so far; all others are settled.
            pool = chunk[~old] if best is None else pd.concat([best, chunk[~old]])
            shared = pool["name"].duplicated(keep=False)
            contest = _earliest_first(pool[shared], self._ties)
            repeated = contest["name"].duplicated()
            best = pd.concat([pool[~shared], contest[~repeated]])
            settled = pd.concat([chunk[old], contest[repeated]])
            if len(settled):
                yield settled.drop(columns="name").assign(is_duplicate=True)
        if best is not None and len(best):
            for name in best["name"]:
                seen.put(name, 1)
            seen.save()
            flags = best["name"].map(lambda name: None if name == "-" else False).astype(object)
            yield best.drop(columns="name").assign(is_duplicate=flags)

    def close(self) -> None:
        pass


class FirstOfMissing(StatefulProcessor):
    """Settles the undecided rows, at most one per group of :class:`FirstOfKey` ever."""

    def __init__(self, ties: list[str]) -> None:
        self._ties = ties

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        if key[0] != _UNDECIDED:
            yield from rows
            return
        pool = _earliest_first(pd.concat(list(rows)), self._ties)
        duplicate = np.ones(len(pool), dtype=bool)
        if not self._seen.exists():
            duplicate[0] = False
            self._seen.update((True,))
        yield pool.assign(is_duplicate=duplicate)

    def close(self) -> None:
        pass


class AccountHistory(StatefulProcessor):
    """History columns of clean rows; other rows pass with NULLs.

    A group holds many accounts, and all of a micro-batch's rows in it are worked out at once.
    State has an item per account (its last row, the days kept), per account and day (totals
    per second) and per account and payee, so a row rewrites its own day only, and what shares
    a page with it.
    """

    def __init__(self, lateness: int) -> None:
        self._kept = DAY_SECONDS + lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last, self._day, self._paid = (
            handle.getMapState(name, *_PAGED) for name in ("last", "day", "paid"))

    def _known(
        self, names: list[str], code: np.ndarray, epoch: np.ndarray, last_rows: Pages, days: Pages
    ) -> tuple[list[list | None], pd.DataFrame]:
        """(last row and days per account, kept seconds that the rows can reach).

        A row later than the account's last one may follow any day kept; others reach theirs
        and the day before.
        """
        columns = ["code", "epoch", *_SUMS, "huge", "country"]
        parts: list[list] = [[] for _ in columns]
        last_rows.open(names)
        lasts = [last_rows.get(name) for name in names]
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        reached = []
        for number, own in enumerate(np.split(epoch, starts[1:])):
            last = lasts[number]
            kept = set(last[2]) if last else set()
            if last and own[0] >= last[0]:
                near = set((own // DAY_SECONDS).tolist())
                kept &= near | {day - 1 for day in near}
            reached += [(number, _day_name(names[number], day)) for day in sorted(kept)]
        days.open(name for _, name in reached)
        for number, name in reached:
            held = days.get(name)
            parts[0] += [number] * len(held[0])
            for part, values in zip(parts[1:], held):
                part += values
        frame = pd.DataFrame(dict(zip(columns, parts)))
        whole = {name: "int64" for name in ["code", "epoch", *_SUMS]}
        return lasts, frame.astype({**whole, "huge": "float64"})

    def _ordinals(self, names: list[str], code: np.ndarray, payees: pd.Series) -> np.ndarray:
        """1, 2, ... per account and payee, continuing the counts of earlier batches."""
        pair = pd.MultiIndex.from_arrays([code, _named(payees)])
        number, pairs = pd.factorize(pair)
        times = np.bincount(number, minlength=len(pairs))
        paid = Pages(self._paid)
        # The length of the account tells where the payee begins.
        entries = [f"{len(names[account])} {names[account]}{payee}" for account, payee in pairs]
        paid.open(entries)
        before = np.array([paid.get(entry) or 0 for entry in entries], dtype="int64")
        for entry, known in zip(entries, (before + times).tolist()):
            paid.put(entry, known)
        paid.save()
        place = pd.Series(number).groupby(number).cumcount().to_numpy()
        return place + 1 + before[number]

    def _advance(self, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(name=_named(rows["account_id"]))
        rows = rows.sort_values(["name", "second", *_ROW_ORDER], kind="stable", na_position="first")
        code, found = pd.factorize(rows["name"])
        names = list(found)
        epoch = rows["second"].fillna(NO_TIME).to_numpy("int64")
        last_rows, days = Pages(self._last), Pages(self._day)
        lasts, recent = self._known(names, code, epoch, last_rows, days)
        amount = rows["amount"].to_numpy("float64", na_value=np.nan)
        added = pd.DataFrame({
            "code": code, "epoch": epoch, "n": 1,
            **money.array_parts(amount, rows["has_amount"].to_numpy(bool)),
            "country": rows["country"].to_numpy(object),
        })

        def place(frame: pd.DataFrame) -> np.ndarray:
            seconds = np.clip(frame["epoch"].to_numpy("int64"), -_EPOCH_SPAN, _EPOCH_SPAN)
            return frame["code"].to_numpy("int64") * (4 * _EPOCH_SPAN) + seconds

        here = place(added)
        spans = {span: [(part, np.searchsorted(at, here - span, "left"),
                         np.searchsorted(at, here, "right"))
                        for part, at in ((recent, place(recent)), (added, here))]
                 for span in (HOUR_SECONDS, DAY_SECONDS)}

        def rolling(name: str, span: int) -> np.ndarray:
            result = np.zeros(len(here), "int64")
            for part, first, end in spans[span]:
                # Sums over all accounts may wrap around; their differences do not mind.
                sums = np.concatenate([[0], np.cumsum(part[name].to_numpy("int64"))])
                result += sums[end] - sums[first]
            return result

        def rolling_huge() -> np.ndarray:
            result = np.zeros(len(here))
            for part, first, end in spans[DAY_SECONDS]:
                value = part["huge"].to_numpy("float64")
                hits = np.concatenate([[0], np.cumsum(value != 0)])
                for row in np.flatnonzero(hits[end] > hits[first]):
                    result[row] = money.huge_total([result[row], *value[first[row]:end[row]]])
            return result

        day = {name: rolling(name, DAY_SECONDS) for name in money.ARRAY_COUNTS}
        day["huge"] = rolling_huge()
        amounts = pd.array(money.array_total(day), dtype=object)
        amounts[day["amounts"] == 0] = None
        previous_epoch, previous_country = _previous(added, recent, place, lasts)
        result = rows.drop(columns="name").assign(
            txns_last_hour=rolling("n", HOUR_SECONDS), amount_last_day=amounts,
            prev_country=previous_country, prev_epoch=previous_epoch,
            beneficiary_seq=self._ordinals(names, code, rows["beneficiary_id"]),
        )
        self._keep(names, lasts, pd.concat([recent, added]), added, last_rows, days)
        return result

    def _keep(
        self, names: list[str], lasts: list[list | None], both: pd.DataFrame, added: pd.DataFrame,
        last_rows: Pages, days: Pages,
    ) -> None:
        """Write the days that got rows, each account's last row, and drop days out of reach."""
        def day_of(frame: pd.DataFrame) -> pd.Series:
            return frame["epoch"] // DAY_SECONDS

        both = both.assign(day=day_of(both))
        touched = added[["code"]].assign(day=day_of(added)).drop_duplicates()
        both = both.merge(touched, on=["code", "day"]).sort_values(
            ["code", "epoch"], kind="stable", ignore_index=True)
        code, epoch = both["code"].to_numpy("int64"), both["epoch"].to_numpy("int64")
        starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (epoch[1:] != epoch[:-1])])
        ends = np.r_[starts[1:], len(both)] - 1
        huge = np.zeros(len(starts))
        if both["huge"].any():
            second = np.repeat(np.arange(len(starts)), ends - starts + 1)
            huge = both["huge"].groupby(second).agg(money.huge_total).to_numpy("float64")
        country = both["country"].to_numpy(object)[ends]
        held = [values.tolist() for values in (
            epoch[starts], *(np.add.reduceat(both[name].to_numpy("int64"), starts) for name in _SUMS),
            huge, np.where(pd.isna(country), None, country))]
        code, day = code[starts], both["day"].to_numpy("int64")[starts]
        first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (day[1:] != day[:-1])]).tolist()
        items, got = {}, defaultdict(set)
        for start, end in zip(first, [*first[1:], len(code)]):
            number, date = int(code[start]), int(day[start])
            items[_day_name(names[number], date)] = [values[start:end] for values in held]
            got[number].add(date)
        newest = added.groupby("code").tail(1)
        gone = []
        for number, epoch, country in zip(
                newest["code"].tolist(), newest["epoch"].tolist(), newest["country"]):
            last = lasts[number]
            if last is not None and last[0] > epoch:
                epoch, country = last[0], last[1]
            kept = got[number] | set(last[2] if last else ())
            old = {day for day in kept if (day + 1) * DAY_SECONDS <= epoch - self._kept}
            gone += [_day_name(names[number], day) for day in old]
            last_rows.put(
                names[number], [epoch, None if pd.isna(country) else country, sorted(kept - old)])
        days.open([*items, *gone])
        for name, item in items.items():
            days.put(name, item)
        for name in gone:
            days.remove(name)
        days.save()
        last_rows.save()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        clean = []
        for chunk in rows:
            held = chunk[~chunk["dq_passed"]]
            clean.append(chunk[chunk["dq_passed"]])
            if len(held):
                yield held.assign(txns_last_hour=None, amount_last_day=None, prev_country=None,
                                  prev_epoch=None, beneficiary_seq=None)
        ready = pd.concat(clean)
        if len(ready):
            yield self._advance(ready)

    def close(self) -> None:
        pass


def _day_name(account: str, day: int) -> str:
    return f"{day} {account}"


def _previous(
    added: pd.DataFrame, recent: pd.DataFrame, place, lasts: list[list | None]
) -> tuple[pd.api.extensions.ExtensionArray, np.ndarray]:
    """Second and country of the row before each: this batch's, or the state's if later."""
    never = np.iinfo("int64").min
    code, epoch = added["code"].to_numpy("int64"), added["epoch"].to_numpy("int64")
    first = np.r_[True, code[1:] != code[:-1]]
    before = np.where(first, never, np.r_[never, epoch[:-1]])
    country = added["country"].to_numpy(object)
    before_place = np.where(first, None, np.r_[np.array([None], object), country[:-1]])

    known_code = np.r_[-1, recent["code"].to_numpy("int64")]
    known_epoch = np.r_[never, recent["epoch"].to_numpy("int64")]
    known_place = np.r_[np.array([None], object), recent["country"].to_numpy(object)]
    at = np.searchsorted(place(recent), place(added), "right")
    at[known_code[at] != code] = 0
    known, where = known_epoch[at], known_place[at]
    last_epoch = np.array([never if last is None else last[0] for last in lasts])[code]
    last_place = np.array([None if last is None else last[1] for last in lasts], object)[code]
    old = (known == never) & (last_epoch <= epoch)
    known, where = np.where(old, last_epoch, known), np.where(old, last_place, where)
    later = known > before
    found = np.where(later, known, before)
    seconds = pd.Series(found, dtype="Int64").mask(found <= NO_TIME)
    return seconds.array, np.where(later, where, before_place)


def annotate_keyed(
    stream: DataFrame, dq_config: Mapping[str, Any], buckets: int = BUCKETS
) -> DataFrame:
    """The gate on an unbounded feed; duplicates are told by state per unique key.

    Keys are dealt into ``buckets`` groups. Rows without one are dealt by their content, and
    one of them per group takes part in a second comparison.
    """
    key = dq_config.get("unique_key")
    if not key:
        return label_failures(stream, dq_config)
    dealt = stream.withColumn("deal", F.when(
        F.col(key).isNull(), bucket_of(F.struct(*stream.columns), buckets)
    ).otherwise(bucket_of(F.col(key), buckets)))
    schema = T.StructType([*dealt.schema.fields, T.StructField("is_duplicate", T.BooleanType())])
    ties = [name for name in stream.columns if name not in (key, "txn_ts")]

    def flagged(rows: DataFrame, processor: StatefulProcessor) -> DataFrame:
        return rows.groupBy("deal").transformWithStateInPandas(
            statefulProcessor=processor, outputStructType=schema, outputMode="Append",
            timeMode="None")

    first = flagged(dealt, FirstOfKey(key, ties))
    asked = first.withColumn(
        "deal", F.when(F.col("is_duplicate").isNull(), F.lit(_UNDECIDED)).otherwise(F.col("deal")))
    settled = flagged(asked, FirstOfMissing(ties)).drop("deal")
    return label_failures(settled, dq_config, F.col("is_duplicate")).drop("is_duplicate")


def derive_keyed(
    annotated: DataFrame, lateness: int = LATENESS_SECONDS, buckets: int = BUCKETS
) -> DataFrame:
    """History columns for an annotated unbounded feed, from state per account.

    Accounts are dealt into ``buckets`` groups; rows that failed the gate, which have no
    history, into any of them by their content.
    """
    # State processors see no column whose name starts with an underscore.
    timed = annotated.withColumns({
        "second": F.col("txn_ts").cast("long"), "has_amount": F.col("amount").isNotNull(),
        "deal": F.when(F.col("dq_passed"), bucket_of(F.col("account_id"), buckets)).otherwise(
            bucket_of(F.struct(*annotated.columns), buckets)),
    })
    schema = T.StructType([
        *timed.schema.fields,
        T.StructField("txns_last_hour", T.LongType()),
        T.StructField("amount_last_day", T.DoubleType()),
        T.StructField("prev_country", T.StringType()),
        T.StructField("prev_epoch", T.LongType()),
        T.StructField("beneficiary_seq", T.IntegerType()),
    ])
    stateful = timed.groupBy("deal").transformWithStateInPandas(
        statefulProcessor=AccountHistory(lateness), outputStructType=schema, outputMode="Append",
        timeMode="None",
    )
    return stateful.drop("has_amount", "deal").withColumnRenamed("second", "_epoch").withColumns({
        "hours_since_prev": (F.col("_epoch") - F.col("prev_epoch")) / F.lit(3600.0),
        "txn_hour": F.hour("txn_ts"),
    })


def start_keyed_stream(
    spark: SparkSession,
    landing: str,
    root: str,
    dq_config: Mapping[str, Any],
    rules_config: Mapping[str, Any],
    *,
    checkpoint: str | None = None,
    available_now: bool = False,
    capture: bool = False,
    max_files: int | None = FILES_PER_TRIGGER,
    trigger_seconds: int = TRIGGER_SECONDS,
    run_id: str = "stream",
    lateness: int = LATENESS_SECONDS,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Start the keyed job; outputs are laid out as those of ``start_stream``."""
    compile_rules(rules_config)
    if not spark.conf.get(PROVIDER_SETTING).endswith("RocksDBStateStoreProvider"):
        raise ValueError(f"set {PROVIDER_SETTING} to {ROCKSDB}")
    feed = stream_feed(spark, landing, max_files=max_files, capture=capture)
    derived = derive_keyed(annotate_keyed(feed, dq_config, buckets), lateness, buckets)
    scored = score_derived(derived, rules_config)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = cached(batch)
        clean, held = split_dq(rows)
        alerts = project_alerts(
            tag_run(configured_alerts(clean, rules_config), run_id), flags=True
        )
        rows.count()  # fill the cache once, before the outputs read it side by side
        outputs = {
            "alerts": alerts,
            "quarantine": held.select(*feed.columns, "dq_failures"),
            "counters": batch_counters(rows, alerts, batch_id).drop("batch_id"),
            "top": top_batch_alerts(alerts),
        }

        def put(table: str, frame: DataFrame) -> None:
            frame.write.mode("overwrite").parquet(join_path(root, table, f"batch_id={batch_id}"))

        run_together(spark, [
            lambda table=table, frame=frame: put(table, frame) for table, frame in outputs.items()
        ])
        Commits(spark, root).publish(Manifest(batch_id))
        rows.unpersist()

    writer = scored.writeStream.foreachBatch(on_batch).option(
        "checkpointLocation", checkpoint or join_path(root, "checkpoint")
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()
