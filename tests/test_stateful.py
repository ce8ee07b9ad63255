"""State of the query: late-tolerant windows and ranked lists against plain loops."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bookdemand.streaming import stateful
from bookdemand.streaming.core import file_stream, idempotent_batch_sink, run_available_now
from bookdemand.streaming.stateful import late_windows, ranked_windows, ranking_of, state_store, windows_of

SCHEMA = "event_id long, ts timestamp, user_id long, value double"
EPOCH = dt.datetime(2024, 1, 1)
HOUR = 3_600_000_000


def land(spark, path, batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return file_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)


def run(spark, out, tmp_path):
    with state_store(spark):
        q = run_available_now(out, f"{tmp_path}/ck", foreach_batch=idempotent_batch_sink(f"{tmp_path}/out"), output_mode="update")
    return q, spark.read.parquet(f"{tmp_path}/out")


def feed(n, seed):
    pick = random.Random(seed)
    rows = []
    for k in range(n):
        at = 12 * k + pick.randrange(60)  # minutes
        comes = at + pick.choice([0, 0, 0, 90, 2000])
        rows.append((comes, (k, EPOCH + dt.timedelta(minutes=at), pick.choice([1, 2, None]), pick.choice([None, float(k), 1.5]))))
    rows.append((500, (10_000, None, 1, 1.0)))
    rows = [r for _, r in sorted(rows, key=lambda x: (x[0], x[1][0]))]
    return [rows[k:k + n // 6 + 1] for k in range(0, len(rows), n // 6 + 1)]


def test_late_windows_equal_a_plain_version(spark, tmp_path):
    batches = feed(90, 4)
    assert len(batches) >= 6
    land(spark, f"{tmp_path}/in", batches)
    out = late_windows(stream(spark, f"{tmp_path}/in"), time_col="ts", key="user_id", value_col="value", id_col="event_id",
                       size_us=4 * HOUR, slide_us=HOUR, watermark="2 hours")
    q, changes = run(spark, out, tmp_path)

    windows, late, newest = {}, [], None
    for batch in batches:
        watermark = newest - dt.timedelta(hours=2) if newest else dt.datetime(1970, 1, 1)
        for event, ts, user, value in batch:
            if ts is None:
                continue
            last = ts.replace(minute=0, second=0)
            for k in range(4):
                start = last - dt.timedelta(hours=k)
                end = start + dt.timedelta(hours=4)
                if end <= watermark:
                    late.append((event, start, user, value))
                else:
                    windows.setdefault((start, user), []).append(value)
        newest = max([newest or EPOCH, *(r[1] for r in batch if r[1])])
    got = {(r["window_start"], r["user_id"]): (r["events"], r["counted"], round(r["total"], 6), r["top"]) for r in windows_of(changes, "user_id").collect()}
    known = {w: [x for x in v if x is not None] for w, v in windows.items()}
    assert got == {w: (len(v), len(known[w]), round(sum(known[w]), 6), max(known[w], default=None)) for w, v in windows.items()}
    behind = changes.where("kind = 'late'").select("event_id", "window_start", "user_id", "total").collect()
    assert sorted(map(tuple, behind), key=repr) == sorted(late, key=repr) and late
    # some windows changed in more than one batch, and timers leave only open ones in the state
    assert changes.where("kind = 'window'").groupBy("window_start", "user_id").count().where("count > 1").count() > 0
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 3 * 2  # a list and a timer for each user


def test_late_windows_keep_a_state_per_shard_not_per_key(spark, tmp_path):
    pick = random.Random(11)
    users = 400
    batches = [[(1000 * b + k, EPOCH + dt.timedelta(minutes=300 * b + pick.randrange(300)), k % users, float(pick.randrange(9))) for k in range(600)] for b in range(3)]
    batches[2] += [(9000 + k, EPOCH + dt.timedelta(minutes=k), k, 1.0) for k in range(50)]  # every window of theirs is closed
    land(spark, f"{tmp_path}/in", batches)
    out = late_windows(stream(spark, f"{tmp_path}/in"), time_col="ts", key="user_id", value_col="value", id_col="event_id",
                       size_us=2 * HOUR, slide_us=HOUR, watermark="1 hour", shards=16)
    q, changes = run(spark, out, tmp_path)
    assert 0 < q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 16 * 2  # a list and a timer for each shard
    late = changes.where("kind = 'late'")
    assert late.where("event_id >= 9000").count() == 100
    both = windows_of(changes, "user_id").select("window_start", "user_id", "events", "total", "top").unionByName(
        late.select("window_start", "user_id", "events", "total", "top"))
    got = both.groupBy("window_start", "user_id").agg(F.sum("events").alias("events"), F.sum("total").alias("total"), F.max("top").alias("top"))
    want = {}
    for _, ts, user, value in [r for batch in batches for r in batch]:
        for k in range(2):
            want.setdefault((ts.replace(minute=0, second=0) - dt.timedelta(hours=k), user), []).append(value)
    assert {(r["window_start"], r["user_id"]): (r["events"], r["total"], r["top"]) for r in got.collect()} == {w: (len(v), sum(v), max(v)) for w, v in want.items()}


class Shard:
    """A handle that holds one shard's state and timers."""

    def __init__(self):
        self.value, self.timers, self.writes = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.writes = value, self.writes + 1

    def clear(self):
        self.value = None

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_window_keeper_adds_up_many_keys_in_small_steps(monkeypatch):
    monkeypatch.setattr(stateful, "MERGE_ROWS", 7)
    pick, shard, size, slide = random.Random(5), Shard(), 4_000_000, 1_000_000
    keeper = stateful.WindowKeeper(size, slide)
    keeper.init(shard)
    rows = [(pick.choice(["a", "b", None]), 250_000 * k, pick.choice([None, -2.0, float(k)])) for k in range(200)]
    frames = [pd.DataFrame({"key": pd.Series([r[0] for r in part], dtype=object), "t": [r[1] for r in part], "value": pd.Series([r[2] for r in part], dtype=float),
                            "known": [r[2] is not None for r in part], "row_id": "x"}) for part in (rows[k:k + 9] for k in range(0, 200, 9))]
    last, late = {}, 0
    for batch, watermark in ((frames[:10], 0), (frames[10:], 15_000), ([], 49_000)):
        if batch:
            found = pd.concat(list(keeper.handleInputRows((3,), iter(batch), Watermark(watermark))))
            late += int((found["kind"] == "late").sum())
            for r in found[found["kind"] == "window"].itertuples():
                last[None if pd.isna(r.key) else r.key, r.start] = (r.events, r.counted, r.total, None if pd.isna(r.top) else r.top)
        else:
            list(keeper.handleExpiredTimer((3,), Watermark(watermark), None))
            shard.timers = {t for t in shard.timers if t > watermark}
        starts = keeper._held()["start"]
        assert len(shard.timers) == 1 and shard.timers == {(starts.min() + size) // 1000 + 1}
        assert (starts + size > watermark * 1000).all()
    want = {}
    for key, t, value in rows:
        for k in range(4):
            want.setdefault((key, t - t % slide - k * slide), []).append(value)
    known = {w: [x for x in v if x is not None] for w, v in want.items()}
    assert late == 0 and last == {w: (len(v), len(known[w]), sum(known[w]), max(known[w], default=None)) for w, v in want.items()}
    assert shard.writes == 3  # once a batch and once a timer, however many keys
    list(keeper.handleExpiredTimer((3,), Watermark(60_000), None))
    assert not shard.exists()


def test_ranked_lists_survive_a_restart_and_stay_bounded(spark, tmp_path):
    pick = random.Random(8)
    rows = [(k, EPOCH + dt.timedelta(minutes=20 * k), k % 3, pick.choice([None, 1.0, 2.0, float(pick.randrange(50))])) for k in range(400)]
    batches = [rows[k:k + 50] for k in range(0, 400, 50)]
    batches[3] = batches[3] + batches[3][:10]  # copies
    columns = ["event_id", "user_id", "value"]
    want = {}
    for event, ts, user, value in rows:
        want.setdefault(ts.replace(hour=0, minute=0), []).append((value is None, -(value or 0), event))
    want = sorted((day, k + 1, x[2]) for day, v in want.items() for k, x in enumerate(sorted(v)[:2]))

    def go():
        out = ranked_windows(stream(spark, f"{tmp_path}/in"), time_col="ts", score="value", id_col="event_id", columns=columns,
                             n=2, size="1 day", watermark="1 hour", shards=3)
        return run(spark, out, tmp_path)

    land(spark, f"{tmp_path}/in", batches[:4])
    go()
    land(spark, f"{tmp_path}/in", batches[4:])
    q, changes = go()  # from the checkpoint: the lists of the first half are still there
    got = ranking_of(changes, score="value", id_col="event_id", n=2)
    assert sorted((r["window_start"], r["rank"], r["event_id"]) for r in got.collect()) == want
    assert changes.groupBy("batch_id", "window_start", "shard").count().where("count > 2").count() == 0
    open_days = 2
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= open_days * 3 * (2 + 2)

    # a row behind the watermark comes out as late and changes no list
    land(spark, f"{tmp_path}/in", [[(900, EPOCH, 1, 1e9)]])
    _, changes = go()
    assert [r["event_id"] for r in changes.where("kind = 'late'").collect()] == [900]
    again = ranking_of(changes, score="value", id_col="event_id", n=2)
    assert sorted((r["window_start"], r["rank"], r["event_id"]) for r in again.collect()) == want


def test_state_store_setting_comes_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with pytest.raises(RuntimeError), state_store(spark):
        assert "RocksDB" in spark.conf.get(key)
        raise RuntimeError
    assert spark.conf.get(key, None) == before
