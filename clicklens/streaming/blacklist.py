"""Q4 as one stateful operator: the counters and the listing of a user live together in Spark's state.

``transformWithStateInPandas`` (RocksDB state store) keyed by a bucket of users: a user is in one of ``BUCKETS`` by the
hash of the id. A task sees the new clicks of a bucket's users and their state, so the list feeds back into the counting
without any store being read: whatever a batch lists is known to the next one. Both processors emit what changed, as
absolute values: ``count`` rows (a counter of a day, ad and user) and ``listed`` rows. Emitting absolute values makes a
replayed batch write the same rows again.

Each access to the state is a message between Python and the JVM, dearer than the few values it carries. So a bucket's
state is one entry for each day, read and written once in a batch that has clicks of that day, not one for each
(day, ad, user): a batch costs a bounded number of messages for each bucket and day.

Clicks are thinned before the shuffle, inside the scanning tasks (Arrow): per block of clicks the micro-batch rule
needs only a count for each (day, ad, user), the event-time rule only the first ``threshold`` clicks of each. A bot
with a third of a batch's clicks sends a few rows for each block of ``HELD`` clicks.

State is bounded by what can still matter: once a user is listed, the micro-batch rule needs no counter of theirs,
and the event-time rule no click after the listing (a listing only ever moves to an earlier click). With a watermark
a timer drops a bucket's days that have closed: every click of a closed day lies before the watermark, and Spark drops
such clicks before the operator (``numRowsDroppedByWatermark`` in the query's progress counts them).
"""

from __future__ import annotations

import datetime
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

CHANGES = "kind string, dt string, adid string, userid string, clicks long, since long"
THINNED = "dt string, adid string, userid string, us long, id long, n long, wall timestamp"
NO_ID = -(1 << 63)      # a click without an id comes before those with one
BUCKETS = 512           # the key of a stream's state: fixed for as long as checkpoints live
HELD = 100_000          # thinned clicks that a scanning task holds


def _day_end_ms(dt: str) -> int:
    """The end of a day in ms since the epoch; a text that is no day never ends."""
    try:
        day = datetime.date.fromisoformat(dt)
    except ValueError:
        return (1 << 62)
    return ((day - datetime.date(1970, 1, 1)).days + 1) * 86_400_000


class _Days(StatefulProcessor):
    """A bucket's days in the state, each a mapping by (userid, adid), and the timers that close them."""

    expires = False

    def read(self, dt: str | None) -> dict:
        raise NotImplementedError

    def write(self, dt: str | None, groups: dict) -> None:
        raise NotImplementedError

    def put(self, dt: str | None, groups: dict) -> None:
        if groups:
            self.write(dt, groups)
        elif self.groups.containsKey((dt,)):
            self.groups.removeKey((dt,))

    def read_others(self, days: dict) -> None:
        """Add the days of the state that are not yet in ``days``."""
        for (dt,) in list(self.groups.keys()):
            if dt not in days:
                days[dt] = self.read(dt)

    def watch(self, day: str | None) -> None:
        if self.expires and day is not None:
            end = _day_end_ms(day)
            if end < 1 << 62:
                self.handle.registerTimer(end)     # one timer a day: equal times are one

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        for (dt,) in list(self.groups.keys()):
            if dt is not None and _day_end_ms(dt) <= now:
                self.groups.removeKey((dt,))
        return iter(())

    def close(self) -> None:
        pass


def _changed(counts: dict, listed: dict) -> Iterator[pd.DataFrame]:
    """``CHANGES`` of counters {(dt, userid, adid): clicks} and of listings {userid: since}."""
    if counts:
        dt, userid, adid = zip(*counts)
        yield pd.DataFrame({"kind": "count", "dt": dt, "adid": adid, "userid": userid, "clicks": list(counts.values()), "since": None})
    if listed:
        yield pd.DataFrame({"kind": "listed", "dt": None, "adid": None, "userid": list(listed), "clicks": None,
                            "since": pd.Series(list(listed.values()), dtype=object)})


class CountUntilListed(_Days):
    """The micro-batch rule: a batch's clicks of users not listed before it are counted, then users are listed."""

    def __init__(self, threshold: int, expires: bool):
        self.threshold, self.expires = threshold, expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.groups = handle.getMapState("counters", "dt string", "userid array<string>, adid array<string>, clicks array<long>")
        self.listed = handle.getValueState("listed", "userid array<string>")

    def read(self, dt: str | None) -> dict:
        value = self.groups.getValue((dt,))
        return dict(zip(zip(value[0], value[1]), value[2])) if value else {}

    def write(self, dt: str | None, groups: dict) -> None:
        self.groups.updateValue((dt,), ([g[0] for g in groups], [g[1] for g in groups], list(groups.values())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        value = self.listed.get()
        listed = set(value[0]) if value else set()
        added: dict = defaultdict(Counter)
        for df in rows:
            for dt, adid, userid, n in zip(*(df[c].tolist() for c in ("dt", "adid", "userid", "n"))):
                if userid not in listed:
                    added[dt][userid, adid] += n
        days, totals, hit = {}, {}, {}
        for dt, groups in added.items():
            known = days[dt] = self.read(dt)
            if not known:
                self.watch(dt)
            for group, n in groups.items():
                known[group] = totals[dt, *group] = total = known.get(group, 0) + n
                if total >= self.threshold:
                    hit[group[0]] = None
        changed = set(days)
        if hit:
            self.listed.update(([*listed, *hit],))
            self.read_others(days)     # later clicks are dropped, so these totals are final
            for dt, known in days.items():
                final = [g for g in known if g[0] in hit]
                for g in final:
                    del known[g]
                if final:
                    changed.add(dt)
        for dt in changed:
            self.put(dt, days[dt])
        yield from _changed(totals, hit)


class FirstClicks(_Days):
    """The event-time rule: the first ``threshold`` clicks of each (day, ad) up to the user's listing."""

    def __init__(self, threshold: int, expires: bool):
        self.threshold, self.expires = threshold, expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.groups = handle.getMapState("clicks", "dt string", "userid array<string>, adid array<string>, us array<long>, id array<long>")
        self.listed = handle.getValueState("listed", "userid array<string>, us array<long>, id array<long>")

    def read(self, dt: str | None) -> dict:
        value = self.groups.getValue((dt,))
        groups: dict = {}
        for userid, adid, us, id_ in zip(*value) if value else ():
            groups.setdefault((userid, adid), []).append((us, id_))
        return groups

    def write(self, dt: str | None, groups: dict) -> None:
        clicks = [(*g, *c) for g, first in groups.items() for c in first]
        self.groups.updateValue((dt,), tuple(list(column) for column in zip(*clicks)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        value = self.listed.get()
        since = dict(zip(value[0], zip(value[1], value[2]))) if value else {}
        fresh: dict = defaultdict(lambda: defaultdict(list))
        for df in rows:
            for dt, adid, userid, *click in zip(*(df[c].tolist() for c in ("dt", "adid", "userid", "us", "id"))):
                click = tuple(click)
                if userid not in since or click <= since[userid]:
                    fresh[dt][userid, adid].append(click)
        days, sizes, moved = {}, {}, {}
        for dt, groups in fresh.items():
            known = days[dt] = self.read(dt)
            if not known:
                self.watch(dt)
            for group, clicks in groups.items():
                first = known[group] = sorted(known.get(group, []) + clicks)[:self.threshold]
                sizes[dt, *group] = len(first)
                userid = group[0]
                if len(first) == self.threshold and (userid not in since or first[-1] < since[userid]):
                    since[userid] = first[-1]
                    moved[userid] = None
        changed = set(days)
        if moved:
            # the listings are new or earlier: what lies after them counts no longer
            self.read_others(days)
            for dt, known in days.items():
                for group in [g for g in known if g[0] in moved]:
                    kept = [c for c in known[group] if c <= since[group[0]]]
                    if len(kept) < len(known[group]):
                        sizes[dt, *group] = len(kept)
                        changed.add(dt)
                        if kept:
                            known[group] = kept
                        else:
                            del known[group]
            self.listed.update((list(since), [s[0] for s in since.values()], [s[1] for s in since.values()]))
        for dt in changed:
            self.put(dt, days[dt])
        yield from _changed(sizes, {u: since[u][0] for u in moved})


def _thin(t: pa.Table, keep: int | None) -> pa.Table:
    """``THINNED`` rows as one for each (dt, adid, userid) (``keep`` is None), or as the first ``keep`` of each."""
    code = np.zeros(t.num_rows, dtype=np.int64)
    for name in ("dt", "adid", "userid"):
        d = t.column(name).combine_chunks().dictionary_encode()
        code = code * (len(d.dictionary) + 1) + d.indices.fill_null(len(d.dictionary)).to_numpy(zero_copy_only=False)
    order = np.lexsort((t.column("id").to_numpy(), t.column("us").to_numpy(), code))
    starts = np.flatnonzero(np.concatenate(([True], np.diff(code[order]) != 0)))
    size = np.diff(np.append(starts, len(order)))
    if keep is not None:
        place = np.arange(len(order)) - np.repeat(starts, size)
        return t.take(pa.array(order[place < keep]))
    # the group's newest click stands for all
    n = np.add.reduceat(t.column("n").to_numpy()[order], starts)
    t = t.take(pa.array(order[starts + size - 1]))
    return t.set_column(t.schema.get_field_index("n"), "n", pa.array(n))


def thinned(clicks: DataFrame, keep: int | None) -> DataFrame:
    """Clicks of each block thinned per (dt, adid, userid): to their number (``keep`` is None), or to the first ``keep``.

    A task thins each Arrow batch, and again what it holds of several whenever that comes to ``HELD`` rows."""
    src = clicks.select("dt", "adid", "userid", F.unix_micros("ts").alias("us"), F.coalesce("event_id", F.lit(NO_ID)).alias("id"),
                        F.lit(1).cast("long").alias("n"), F.col("ts").alias("wall"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(_thin(pa.Table.from_batches([b]), keep))
            rows += held[-1].num_rows
            if rows >= HELD:
                held = [_thin(pa.concat_tables(held), keep)]
                rows = held[0].num_rows
                if rows > HELD // 2:    # mostly single clicks: send them on
                    yield from held[0].combine_chunks().to_batches()
                    held, rows = [], 0
        if held:
            yield from _thin(pa.concat_tables(held), keep).combine_chunks().to_batches()
    return src.mapInArrow(run, THINNED)


def blacklist_changes(clicks: DataFrame, threshold: int, mode: str, retain_days: int | None = None) -> DataFrame:
    """Streaming frame of ``CHANGES``: the counters and listings that each batch changes."""
    rows = thinned(clicks, threshold if mode == "event_time" else None)
    if retain_days is not None:
        # a click with a wrong, far-future time moves the watermark to the present at most
        rows = rows.withColumn("wall", F.least("wall", F.current_timestamp())).withWatermark("wall", f"{retain_days} days")
    # only what the rule reads: each value of a row is a Python object there
    read = [*(["us", "id"] if mode == "event_time" else ["n"]), *(["wall"] if retain_days is not None else [])]
    rows = rows.select(F.pmod(F.hash("userid"), F.lit(BUCKETS)).alias("bucket"), "dt", "adid", "userid", *read)
    rule = FirstClicks if mode == "event_time" else CountUntilListed
    return rows.groupBy("bucket").transformWithStateInPandas(rule(threshold, retain_days is not None), CHANGES, "update",
                                                             "eventTime" if retain_days is not None else "none")
