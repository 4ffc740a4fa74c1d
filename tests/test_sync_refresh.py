"""T5 by the source's rule, T6 / T8 in the lifecycle: replays in other batches,
retried batches, second looks, forgotten runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quartermaster.streaming import lifecycle as L
from quartermaster.streaming import refresh as R
from quartermaster.streaming.commit import BatchTables
from quartermaster.streaming.sources import change_event
from quartermaster.streaming.sync import SIGNALS

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
ITEMS = ["a", "b", "c", "d"]
DELAY, KEEP, LATE = 60, 600, 5


def simulate(events, newest):
    """events of one run, in order: (second, is_dataset, item) -> signals (second, second look)."""
    out, first, looks, done = [], {}, [], None

    def unmatched():
        return sum((False in first.get(i, {})) != (True in first.get(i, {})) for i in ITEMS)
    for at, made, item in sorted(events) + [(None, None, None)]:
        last = at is None
        if done is not None and not last and at > done + KEEP:
            done, first, looks = None, {}, []
        while done is None and looks and (looks[0] <= newest - LATE if last else looks[0] < at):
            due = looks.pop(0)
            if unmatched() == 0:
                out.append((due, True))
                done = due
        if last or done is not None and at <= done + KEEP:
            continue
        if done is not None:
            done, first, looks = None, {}, []
        first.setdefault(item, {}).setdefault(made, at)
        if made:
            n = unmatched()
            if n == 0:
                out.append((at, False))
                done = at
            elif n < 3:
                looks = sorted({*looks, at + DELAY})
    return out


def write_events(spark, path, events, files):
    """Files written one after the other, in time order."""
    events = sorted(events, key=lambda e: e[1])
    for part in range(files):
        write_file(spark, path, events[part * len(events) // files:(part + 1) * len(events) // files])


def write_file(spark, path, events):
    rows = [(run, f"{item}-dataset-{run}", "Dataset_Created" if made else "File_Received", START + dt.timedelta(seconds=at), "INSERT", i)
            for i, (run, at, made, item) in enumerate(events)]
    df = spark.createDataFrame(rows, "a string, d string, s string, ts timestamp, k string, i long")
    rec = change_event(F.col("a"), F.col("d"), F.col("s"), F.col("ts"), F.col("k"), F.col("i"), F.col("i"))
    df.select("ts", F.to_json(rec).alias("value")).coalesce(1).select("value").write.mode("append").text(path)


def signals_of(spark, tables):
    return sorted((r.assessment_id, round((r.at - START.timestamp())), r.second_look) for r in tables.read("signals").select(
        "assessment_id", F.unix_seconds("signal_at").alias("at"), "second_look").collect())


def test_signals_equal_a_simulation_in_any_batches(spark, tmp_path):
    rng = random.Random(2)
    times = rng.sample(range(4000), 260)
    events = [(str(rng.randrange(4)), at, rng.random() < 0.5, rng.choice([*ITEMS, "other"])) for at in times]
    ours = [e for e in events if e[3] in ITEMS]
    newest = max(at for _, at, _, _ in ours)
    want = sorted((run, at, second) for run in "0123" for at, second in simulate([e[1:] for e in ours if e[0] == run], newest))
    assert any(x[2] for x in want) and len(want) > len({x[0] for x in want})  # second looks, and runs that start anew
    source = spark.range(6).select(F.pmod("id", F.lit(3)).cast("string").alias("assessment_id"), "id")
    for files in (1, 7):
        base = str(tmp_path / f"base{files}")
        write_events(spark, f"{base}/events", events, files)
        L.run_lifecycle(spark, f"{base}/events", base, ITEMS, gate=False, state_partitions=2, source=source,
                        sync={"delay_s": DELAY, "keep_s": KEEP, "late": f"{LATE} seconds"})
        tables = R.refresh_tables(spark, base, source)
        assert signals_of(spark, tables) == want
        audit = tables.read("audit").collect()
        runs = {r.assessment_id: [x.status for x in sorted(audit, key=lambda x: x.batch_id) if x.assessment_id == r.assessment_id] for r in audit}
        for run, statuses in runs.items():
            assert statuses[0] == ("NO_DATASET" if run == "3" else "REFRESHED")
            assert set(statuses[1:]) <= {"NO_DATASET" if run == "3" else "UNCHANGED"}
        assert R.current_target(tables).count() == sum(2 for run in runs if run != "3")


def batch_of(spark, *runs):
    return spark.createDataFrame([(r, "S", START, False, 1, 0) for r in runs], SIGNALS)


def test_a_retried_batch_changes_nothing(spark, tmp_path, monkeypatch):
    source = spark.createDataFrame([("1", 5), ("1", 6), ("2", 7)], "assessment_id string, x long")
    tables = R.refresh_tables(spark, str(tmp_path), source)
    assert tables.read("audit").count() == 0
    run = R.publish(tables, source)
    run(batch_of(spark, "1", "9"), 0)
    want = sorted((r.assessment_id, r.status, r.source_rows, r.target_rows) for r in tables.read("audit").collect())
    assert want == [("1", "REFRESHED", 2, None), ("9", "NO_DATASET", None, None)]
    run(batch_of(spark, "1", "9"), 0)  # committed before
    assert tables.read("audit").count() == 2 and R.current_target(tables).count() == 2
    # a failure between two tables: nothing of the batch is read, and its second run is the only one
    real = BatchTables.write

    def failing(self, name, batch_id, rows):
        if name == "status":
            raise OSError("lost")
        return real(self, name, batch_id, rows)
    monkeypatch.setattr(BatchTables, "write", failing)
    more = spark.createDataFrame([("1", 5), ("1", 6), ("1", 8), ("2", 7)], "assessment_id string, x long")
    with pytest.raises(OSError):
        R.publish(tables, more)(batch_of(spark, "1", "2"), 1)
    assert tables.read("audit").count() == 2 and R.current_target(tables).count() == 2
    monkeypatch.setattr(BatchTables, "write", real)
    R.publish(tables, more)(batch_of(spark, "1", "2"), 1)
    got = sorted((r.assessment_id, r.status, r.source_rows, r.target_rows) for r in tables.read("audit").filter("batch_id = 1").collect())
    assert got == [("1", "REFRESHED", 3, 2), ("2", "REFRESHED", 1, None)]
    assert sorted(tuple(r) for r in R.current_target(tables).collect()) == [("1", 5), ("1", 6), ("1", 8), ("2", 7)]
    R.publish(tables, more)(batch_of(spark, "2"), 2)
    assert [r.status for r in tables.read("audit").filter("batch_id = 2").collect()] == ["UNCHANGED"]
    assert sorted(r.assessment_id for r in tables.read("status").collect()) == ["1", "1", "2"]


def test_other_stems_are_not_refreshed(spark, tmp_path):
    source = spark.createDataFrame([("1", 5)], "assessment_id string, x long")
    tables = R.refresh_tables(spark, str(tmp_path), source)
    R.publish(tables, source, stem="RD-IX")(batch_of(spark, "1"), 0)
    assert tables.read("audit").count() == 0 and tables.read("signals").count() == 1


def test_a_run_makes_few_state_calls_whatever_its_events():
    """Items are read and written by one call each, and not counted anew at each event."""
    from quartermaster.streaming.sync import SyncGate
    calls = []

    class State:
        def __init__(self):
            self.rows = []

        def __getattr__(self, name):
            def call(*args):
                calls.append(name)
                if name == "exists":
                    return False
                return iter(self.rows) if name in ("get", "iterator") else None
            return call

    class Handle:
        def __getattr__(self, name):
            return lambda *args: State() if name.startswith("get") else calls.append(name) or iter(())

    gate = SyncGate(ITEMS, "S", DELAY * 1000, KEEP * 1000)
    gate.init(Handle())
    looks, look = [], gate.look
    gate.look = lambda seen: looks.append(1) or look(seen)
    # a file of every item and a dataset of one, over and over: three stay unmatched, no look is due
    events = [{"at_ms": 10 * i, "kind": "dataset" if i % 5 == 4 else "file", "item": ITEMS[i % 5 % 4]} for i in range(400)]
    assert list(gate.handleInputRows(("r",), iter(events), None)) == []
    assert len(calls) <= 6 and len(looks) <= 1, (calls, len(looks))


def test_groups_give_the_signals_of_a_simulation():
    """The rule with state that comes with the events: any batches, time-outs, runs that start anew, times of any year."""
    from quartermaster.streaming.sync import SyncRounds

    class State:
        get, exists, timeout, updates = None, False, None, 0

        def __init__(self):
            self.watermark, self.hasTimedOut = 0, False

        def getCurrentWatermarkMs(self):
            return self.watermark

        def update(self, value):
            self.get, self.exists, self.updates = value, True, self.updates + 1

        def remove(self):
            self.get, self.exists = None, False

        def setTimeoutTimestamp(self, at):
            assert at >= self.watermark
            self.timeout = at

    import pandas as pd
    names = sorted(ITEMS)
    far = 7_000_000_000 * 1000  # beyond the years of pandas' times
    for seed in range(30):
        rng = random.Random(seed)
        start = far if seed % 2 else 1_000_000
        events = sorted((at, rng.random() < 0.5, rng.choice(ITEMS)) for at in rng.sample(range(4000), 80))
        gate, state, got = SyncRounds(ITEMS, "S", DELAY * 1000, KEEP * 1000), State(), []
        cuts = [0, *sorted(rng.sample(range(1, 80), rng.randrange(6))), 80, 80]
        for a, b in zip(cuts, cuts[1:]):
            state.hasTimedOut = a == b
            if a == b and (state.timeout is None or state.timeout >= state.watermark):
                continue
            frame = pd.DataFrame([(start + at * 1000, names.index(item) + len(names) * made) for at, made, item in events[a:b]], columns=["at_ms", "place"])
            state.timeout, state.updates = None, 0
            for out in gate(("r",), iter([] if a == b else [frame]), state):
                got += [((x - start) // 1000, s) for x, s in zip(out["at_ms"], out["second_look"])]
            assert state.updates <= 1
            state.watermark = start + (events[b - 1][0] - LATE) * 1000
        assert got == simulate(events, events[-1][0]), seed


def test_change_events_are_made_after_they_are_dealt_out(spark):
    from quartermaster.streaming.queries import json_in_order
    ev = spark.createDataFrame([(START, 1, 2, "view", 7.0, "{}")], "ts timestamp, event_id long, user_id long, event_type string, value double, props string")
    rec = change_event(F.col("user_id"), F.col("event_type"), F.lit("File_Received"), F.col("ts"), F.lit("INSERT"), F.col("event_id"), F.col("event_id"))
    above, below = json_in_order(ev, rec)._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert "StructsToJson" in above and "StructsToJson" not in below and "props" not in below.split("\n")[1]
