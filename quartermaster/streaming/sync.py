"""T5 by the source's rule: a run is in sync when no expected dataset has a
file without a dataset or a dataset without a file.

Each created dataset makes a look at its run. With nothing unmatched the run
is in sync and one signal goes out; with fewer than ``FEW_MISSING`` unmatched a
second look follows after a delay (a file that comes later makes no look of
its own); with more the run waits for its next dataset.

Looks are taken in event time: the state keeps when an item's file and dataset
first came, and a second look due before an event is taken before it, so the
signals don't depend on how events in time order fall into micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Fixed value (must equal the source system's): unmatched datasets below which a second look follows.
FEW_MISSING = 3
SIGNALS = "assessment_id string, signal string, signal_at timestamp, second_look boolean, n_matched int, n_absent int"
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
_OUT = "assessment_id string, signal string, at_ms long, second_look boolean, n_matched int, n_absent int"
_NEVER = 1 << 62
_LAST = "2262-04-11 00:00:00 UTC"  # pandas has no later times


class Rounds:
    """The rule for one run: ``step`` takes events and what is known of the run
    (``seen``: item -> first file and dataset; the looks due; when it was
    signalled) and leaves what is known after them."""

    def __init__(self, expected: Sequence[str], signal: str, delay_ms: int, keep_ms: int):
        self.expected, self.signal, self.delay_ms, self.keep_ms = list(dict.fromkeys(expected)), signal, delay_ms, keep_ms
        self.wanted = frozenset(self.expected)

    def look(self, seen: dict) -> tuple[int, int, int]:
        """Expected items matched, absent (neither file nor dataset) and unmatched."""
        both = [seen.get(x, (_NEVER, _NEVER)) for x in self.expected]
        matched = sum(max(x) < _NEVER for x in both)
        absent = sum(min(x) == _NEVER for x in both)
        return matched, absent, len(both) - matched - absent

    def out(self, key, at: int, second: bool, seen: dict) -> Row:
        matched, absent, _ = self.look(seen)
        return Row(assessment_id=key[0], signal=self.signal, at_ms=at, second_look=second, n_matched=matched, n_absent=absent)

    def step(self, key, events: list, seen: dict, looks: list, done: int | None) -> tuple[list, dict, list, int | None]:
        """``events`` in order: (time, dataset or file, item); of one time a file comes before a dataset."""
        last, found = events[-1][0], []
        if done is not None and last <= done + self.keep_ms:
            return found, seen, looks, done  # all passed over: the state stays as it is
        seen, looks = dict(seen), list(looks)
        unmatched = self.look(seen)[2]  # kept up to date by item, not counted anew at each event
        for at, is_dataset, item in events:
            if done is not None and at > done + self.keep_ms:
                done, seen, looks, unmatched = None, {}, [], 0  # forgotten by then
            while done is None and looks and looks[0] < at:
                due = looks.pop(0)
                if unmatched == 0:
                    found.append(self.out(key, due, True, seen))
                    done = due
            if done is not None:
                if last <= done + self.keep_ms:
                    break
                if at <= done + self.keep_ms:
                    continue
                done, seen, looks, unmatched = None, {}, [], 0
            file_at, dataset_at = seen.get(item, (_NEVER, _NEVER))
            lone = (file_at < _NEVER) != (dataset_at < _NEVER)
            file_at, dataset_at = (file_at, min(dataset_at, at)) if is_dataset else (min(file_at, at), dataset_at)
            seen[item] = file_at, dataset_at
            if item in self.wanted:
                unmatched += ((file_at < _NEVER) != (dataset_at < _NEVER)) - lone
            if is_dataset:
                if unmatched == 0:
                    found.append(self.out(key, at, False, seen))
                    done = at
                elif unmatched < FEW_MISSING and (not looks or looks[-1] < at + self.delay_ms):
                    looks.append(at + self.delay_ms)  # events and delay are in order, so these are
                elif unmatched < FEW_MISSING and at + self.delay_ms not in looks:
                    looks = sorted([*looks, at + self.delay_ms])
        return found, seen, looks, done

    def due(self, key, seen: dict, looks: list, done: int | None, watermark: int) -> tuple[list, list, int | None]:
        """Take the looks that no event can come before any more."""
        found, looks = [], list(looks)
        while done is None and looks and looks[0] <= watermark:
            at = looks.pop(0)
            if seen and self.look(seen)[2] == 0:
                found.append(self.out(key, at, True, seen))
                done = at
        return found, looks, done


class SyncGate(Rounds, StatefulProcessor):
    """The rule over rows, for ``transformWithState``. State of a run: ``items``
    (item, its first file and dataset) with a timer for each second look; once
    signalled only the time of that, which a timer removes after ``keep_ms``."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getListState("items", "item string, file_ms long, dataset_ms long")
        self.signalled = handle.getValueState("signalled", "at_ms long")

    def held_items(self) -> dict:
        return {x[0]: (x[1], x[2]) for x in self.items.get()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        events = sorted([(r["at_ms"], r["kind"] == "dataset", r["item"]) for r in rows])
        done = self.signalled.get()[0] if self.signalled.exists() else None
        if done is not None and events[-1][0] <= done + self.keep_ms:
            return  # all passed over
        timers = set(self.handle.listTimers())
        before = self.held_items() if done is None else {}
        found, seen, looks, done = self.step(key, events, before, sorted(timers) if done is None else [], done)
        yield from found
        self.store(before, seen, timers, set(looks), done)

    def store(self, before: dict, seen: dict, timers: set, looks: set, done: int | None) -> None:
        if done is not None:
            self.items.clear()
            self.signalled.update((done,))
            looks = {done + self.keep_ms}
        else:
            self.signalled.clear()
            if seen != before:  # at most the expected items, by one call
                self.items.put([(item, *times) for item, times in seen.items()])
        for t in timers - looks:
            self.handle.deleteTimer(t)
        for t in looks - timers:
            self.handle.registerTimer(t)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        if self.signalled.exists():
            if due >= self.signalled.get()[0] + self.keep_ms:
                self.signalled.clear()
            return
        seen = self.held_items()
        found, _, done = self.due(key, seen, [due], None, due)
        if found:
            yield from found
            self.store({}, seen, set(self.handle.listTimers()) - {due}, set(), done)

    def close(self) -> None:
        pass


class SyncRounds(Rounds):
    """The rule over groups, for ``applyInPandasWithState``: a run's state comes
    with its events, many runs in a batch, where ``SyncGate`` asks the JVM for
    each piece of it. An event is a time and its place among the files, then the
    datasets, of the items by name. State of a run: the items' places and times
    and the looks due; once signalled only the time of that."""

    STATE = "items array<int>, files array<long>, datasets array<long>, looks array<long>, signalled long"

    def __init__(self, expected: Sequence[str], signal: str, delay_ms: int, keep_ms: int):
        super().__init__(expected, signal, delay_ms, keep_ms)
        self.names = sorted(self.expected)
        self.position = {name: i for i, name in enumerate(self.names)}

    def __call__(self, key, frames, state):
        import pandas as pd
        items, files, datasets, looks, done = state.get if state.exists else ((), (), (), (), None)
        seen = {self.names[i]: (f, d) for i, f, d in zip(items, files, datasets)}
        found, n, watermark = [], len(self.names), state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            codes = sorted((at, place) for frame in frames for at, place in zip(frame["at_ms"].tolist(), frame["place"].tolist()))
            found, seen, looks, done = self.step(key, [(at, place >= n, self.names[place % n]) for at, place in codes], seen, looks, done)
        more, looks, done = self.due(key, seen, looks, done, watermark)
        self.keep(state, seen, looks, done, watermark)
        if found or more:
            yield pd.DataFrame([r.asDict() for r in found + more])

    def keep(self, state, seen: dict, looks: list, done: int | None, watermark: int) -> None:
        if done is not None:
            seen, looks = {}, [done + self.keep_ms]  # forgotten then
            if looks[0] <= watermark:
                if state.exists:
                    state.remove()
                return
        state.update(([self.position[x] for x in seen], [f for f, _ in seen.values()], [d for _, d in seen.values()],
                      [] if done is not None else looks, done))
        if looks:  # a group's time is up once the watermark is beyond it
            state.setTimeoutTimestamp(max(looks[0] - 1, 1))


def _stepped(gate: SyncRounds):
    def step(key, frames, state):
        return gate(key, frames, state)
    return step


def sync_gate(events: DataFrame, expected: Sequence[str], signal: str, time_col: str = "status_timestamp", item_col: str = "item",
              file_statuses: Sequence[str] = ("File_Received",), dataset_statuses: Sequence[str] = ("Dataset_Created",),
              delay_s: float = 3600, keep_s: float = 30 * 86400, late: str = "10 minutes") -> DataFrame:
    """Signals (``SIGNALS``) of a stream of status events (assessment_id,
    ``item_col``, status, ``time_col``): one for each run when it is in sync.

    ``delay_s`` is the wait before a second look, ``keep_s`` how long a finished
    run is remembered (after that its events start a new round), ``late`` how
    late events may come; later ones are dropped. Items that aren't expected,
    other statuses and events without run or time are passed over. For the
    watermark a time after ``_LAST`` counts as that. The state of an unfinished
    run is bounded by the expected items and the looks that are due. The
    ``STATE_STORE`` setting keeps it outside the heap.
    """
    gate = SyncRounds(expected, signal, int(delay_s * 1000), int(keep_s * 1000))
    item = F.array_position(F.array(*[F.lit(x) for x in gate.names]), F.col(item_col))  # 0: not expected
    made = F.when(F.col("status").isin(list(file_statuses)), 0).when(F.col("status").isin(list(dataset_statuses)), len(gate.names))
    at = F.col(time_col).cast("timestamp")
    rows = events.select(F.col("assessment_id").cast("string").alias("assessment_id"), F.when(item > 0, item - 1 + made).alias("place"),
                         F.unix_millis(at).alias("at_ms"), F.least(at, F.lit(_LAST).cast("timestamp")).alias("event_at"))
    rows = rows.dropna().withWatermark("event_at", late)
    found = rows.groupBy("assessment_id").applyInPandasWithState(_stepped(gate), _OUT, gate.STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select("assessment_id", "signal", F.timestamp_millis("at_ms").alias("signal_at"), "second_look", "n_matched", "n_absent")
