"""Stream = batch, replay idempotence, and the reference's micro-batch blacklist rule."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from clicklens import operators as op
from clicklens.session import shared_dir
from clicklens.sources import encode_lines, parse_lines, read_line_stream
from clicklens.streaming import blacklist, jobs
from clicklens.streaming.blacklist import thinned
from tests.conftest import rows

ADS_SCHEMA = "event_id long, ts timestamp, dt string, area string, city string, userid string, adid string"
BASE = dt.datetime(2024, 1, 1, 23, 59, 0)


def ads(spark, recs):
    data = []
    for e, sec, area, city, u, a in recs:
        ts = BASE + dt.timedelta(seconds=sec)
        data.append((e, ts, ts.strftime("%Y-%m-%d"), area, city, str(u), str(a)))
    return spark.createDataFrame(data, ADS_SCHEMA)


def sample(spark, n=400):
    return ads(spark, [(i, i * 0.7, "AB"[i % 2], f"c{i % 3}", i % 5, i % 4 + 1) for i in range(n)])


def write_lines(df, path):
    encode_lines(df).write.mode("append").text(path)


def run_once(spark, start, inp, out, cp, per_trigger=1):
    clicks = parse_lines(read_line_stream(spark, "text", path=inp, maxFilesPerTrigger=per_trigger))
    q = start(clicks, out, cp, trigger={"availableNow": True})
    q.awaitTermination()
    return q


def test_stream_equals_batch_in_any_order(spark):
    root = shared_dir(spark)
    df = sample(spark)
    # three files with clicks of both days each: arrival is out of event order
    write_lines(df.repartition(3), f"{root}/in")
    run_once(spark, jobs.ads_click_daily_stream, f"{root}/in", f"{root}/o1", f"{root}/cp1")
    assert rows(jobs.read_ads_click_daily(spark, f"{root}/o1")) == rows(op.ads_click_daily(df))
    run_once(spark, jobs.ads_area_top3_stream, f"{root}/in", f"{root}/o2", f"{root}/cp2")
    assert rows(jobs.read_ads_area_top3(spark, f"{root}/o2")) == rows(op.ads_area_top3_json(df))
    run_once(spark, lambda c, o, cp, trigger: jobs.ads_window_stream(c, o, cp, 60, 10, trigger=trigger),
             f"{root}/in", f"{root}/o3", f"{root}/cp3")
    assert rows(jobs.read_ads_windows(spark, f"{root}/o3")) == rows(op.ads_sliding_60s(df))
    start_bl = lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, 20, trigger=trigger)
    run_once(spark, start_bl, f"{root}/in", f"{root}/o4", f"{root}/cp4")
    assert rows(jobs.read_blacklist(spark, f"{root}/o4", 20)) == rows(op.blacklist_users(df, 20))
    assert rows(jobs.read_blacklist_counts(spark, f"{root}/o4", 20)) == rows(op.blacklist_filtered_counts(df, 20))


def test_replay_with_same_checkpoint_adds_nothing(spark):
    root = shared_dir(spark)
    df = sample(spark, 120)
    write_lines(df.repartition(2), f"{root}/in")
    run_once(spark, jobs.ads_click_daily_stream, f"{root}/in", f"{root}/out", f"{root}/cp")
    first = rows(jobs.read_ads_click_daily(spark, f"{root}/out"))
    q = run_once(spark, jobs.ads_click_daily_stream, f"{root}/in", f"{root}/out", f"{root}/cp")
    assert sum(p["numInputRows"] for p in q.recentProgress) == 0
    assert rows(jobs.read_ads_click_daily(spark, f"{root}/out")) == first
    # new data continues from the stored state: totals are absolute, not re-counted
    write_lines(df.limit(10), f"{root}/in")
    run_once(spark, jobs.ads_click_daily_stream, f"{root}/in", f"{root}/out", f"{root}/cp")
    assert rows(jobs.read_ads_click_daily(spark, f"{root}/out")) == rows(op.ads_click_daily(df.unionByName(df.limit(10))))


def test_micro_batch_blacklist_follows_the_reference_rule(spark):
    root = shared_dir(spark)
    n = 3
    b0 = ads(spark, [(1, 0, "A", "c", 1, 1), (2, 1, "A", "c", 1, 1)])
    b1 = ads(spark, [(3, 2, "A", "c", 1, 1), (4, 3, "A", "c", 1, 2), (5, 4, "A", "c", 2, 1)])
    b2 = ads(spark, [(6, 5, "A", "c", 1, 2), (7, 6, "A", "c", 2, 1)])
    start = lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, n, mode="micro_batch", trigger=trigger)  # noqa
    for b in (b0, b1, b2):   # one run per arriving batch -> batch ids 0, 1, 2
        write_lines(b.coalesce(1), f"{root}/in")
        run_once(spark, start, f"{root}/in", f"{root}/out", f"{root}/cp", per_trigger=100)
    assert rows(jobs.read_blacklist(spark, f"{root}/out", n, "micro_batch")) == [("1", 1)]
    counts = {(r.userid, r.adid): r.clicks for r in jobs.read_blacklist_counts(spark, f"{root}/out", n,
                                                                                "micro_batch").collect()}
    assert counts == {("1", "1"): 3, ("1", "2"): 1, ("2", "1"): 2}
    # the batch twin with the same batch numbering agrees
    allb = (b0.withColumn("batch", F.lit(0)).unionByName(b1.withColumn("batch", F.lit(1)))
            .unionByName(b2.withColumn("batch", F.lit(2))))
    assert rows(op.blacklist_users_by_batch(allb, n)) == [("1", 1)]
    assert os.path.basename(root).startswith("run-")


def test_many_batches_match_batch_and_touch_only_their_days(spark):
    root = shared_dir(spark)
    day = 86_400
    df = ads(spark, [(i, (i % 3) * day + i * 0.7, "AB"[i % 2], f"c{i % 3}", i % 5, i % 4 + 1) for i in range(300)])
    write_lines(df.repartition(6), f"{root}/in")
    run_once(spark, jobs.ads_area_top3_stream, f"{root}/in", f"{root}/o1", f"{root}/cp1")
    assert rows(jobs.read_ads_area_top3(spark, f"{root}/o1")) == rows(op.ads_area_top3_json(df))
    files = lambda d: sorted(os.listdir(f"{root}/o1/top3/dt={d}".replace("file:", "")))
    days = sorted(r.dt for r in df.select("dt").distinct().collect())
    before = {d: files(d) for d in days}
    more = df.filter(F.col("dt") == days[-1]).limit(5)
    write_lines(more.coalesce(1), f"{root}/in")              # a batch of one day: the others keep their files
    run_once(spark, jobs.ads_area_top3_stream, f"{root}/in", f"{root}/o1", f"{root}/cp1")
    assert [d for d in days if files(d) != before[d]] == days[-1:]
    assert rows(jobs.read_ads_area_top3(spark, f"{root}/o1")) == rows(op.ads_area_top3_json(df.unionByName(more)))
    start_bl = lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, 15, trigger=trigger)
    run_once(spark, start_bl, f"{root}/in", f"{root}/o2", f"{root}/cp2")
    both = df.unionByName(more)
    assert rows(jobs.read_blacklist(spark, f"{root}/o2", 15)) == rows(op.blacklist_users(both, 15))
    assert rows(jobs.read_blacklist_counts(spark, f"{root}/o2", 15)) == rows(op.blacklist_filtered_counts(both, 15))


def test_counters_are_read_from_the_state(spark):
    root = shared_dir(spark)
    df = sample(spark, 200)
    write_lines(df.repartition(3), f"{root}/in")
    run_once(spark, jobs.ads_click_daily_stream, f"{root}/in", f"{root}/out", f"{root}/cp")
    state = jobs.read_counter_state(spark, f"{root}/cp")
    assert state.columns == ["dt", "area", "city", "adid", "clicks"]
    assert rows(state) == rows(op.ads_click_daily(df))


def test_watermarked_jobs_match_batch_on_in_order_data(spark):
    root = shared_dir(spark)
    df = sample(spark, 200)
    write_lines(df.orderBy("ts").coalesce(1), f"{root}/in")
    start = lambda c, o, cp, trigger: jobs.ads_click_daily_stream(c, o, cp, trigger, watermark="1 hour")  # noqa
    run_once(spark, start, f"{root}/in", f"{root}/o1", f"{root}/cp1")
    assert rows(jobs.read_ads_click_daily(spark, f"{root}/o1")) == rows(op.ads_click_daily(df))
    start = lambda c, o, cp, trigger: jobs.ads_window_stream(c, o, cp, 10, trigger=trigger, watermark="1 minute",  # noqa
                                                             echo=3)
    run_once(spark, start, f"{root}/in", f"{root}/o2", f"{root}/cp2")
    trend = rows(jobs.read_ads_windows(spark, f"{root}/o2"), "win_start", "clicks")
    assert trend == rows(op.ads_trend_10s(df))


def test_arrival_time_trend_counts_each_arrival_window(spark):
    # one micro-batch: every line arrives at the same time, so each arrival window holds all of them
    root = shared_dir(spark)
    df = sample(spark, 90)
    write_lines(df.coalesce(1), f"{root}/in")
    start = lambda c, o, cp, trigger: jobs.ads_arrival_trend_stream(c, o, cp, trigger=trigger, echo=True)  # noqa
    run_once(spark, start, f"{root}/in", f"{root}/out", f"{root}/cp", per_trigger=10)
    got = jobs.read_ads_arrival_trend(spark, f"{root}/out")
    windows = got.select("win_start").distinct().count()
    assert windows == 6                                  # 60 s window, 10 s slide
    expected = rows(op.ads_trend_10s(df))
    for w in [r.win_start for r in got.select("win_start").distinct().collect()]:
        assert rows(got.filter(F.col("win_start") == w), "bucket", "clicks") == expected


def test_a_batch_that_fails_midway_is_replayed_exactly(spark, monkeypatch):
    # the Q6 sink dies after writing batch 1's totals but before its documents; a restart from the
    # same checkpoint replays batch 1 into the same partitions and the result equals the batch twin
    root = shared_dir(spark)
    df = sample(spark, 240)
    write_lines(df.repartition(4), f"{root}/in")
    real = jobs.ads_area_top3_json
    calls = {"n": 0}

    def flaky(current, n):
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("executor lost")
        return real(current, n)

    monkeypatch.setattr(jobs, "ads_area_top3_json", flaky)
    try:
        run_once(spark, jobs.ads_area_top3_stream, f"{root}/in", f"{root}/out", f"{root}/cp")
    except Exception:  # noqa: BLE001 - the injected failure surfaces as a StreamingQueryException
        pass
    assert calls["n"] == 2
    run_once(spark, jobs.ads_area_top3_stream, f"{root}/in", f"{root}/out", f"{root}/cp")
    assert rows(jobs.read_ads_area_top3(spark, f"{root}/out")) == rows(op.ads_area_top3_json(df))
    start_bl = lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, 12, trigger=trigger)
    run_once(spark, start_bl, f"{root}/in", f"{root}/bl", f"{root}/blcp")
    again = run_once(spark, start_bl, f"{root}/in", f"{root}/bl", f"{root}/blcp")
    assert sum(p["numInputRows"] for p in again.recentProgress) == 0
    assert rows(jobs.read_blacklist_counts(spark, f"{root}/bl", 12)) == rows(op.blacklist_filtered_counts(df, 12))


def test_blacklist_with_scattered_arrival_equals_batch(spark):
    # every click in a batch of its own choice: listings move to earlier clicks that come later, ids are missing
    root = shared_dir(spark)
    recs = [(i, (i * 37) % 500, "A", "c", i % 6, i % 2 + 1) for i in range(240)]
    df = ads(spark, recs).withColumn("event_id", F.when(F.col("event_id") % 9 != 0, F.col("event_id")))
    start = lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, 7, trigger=trigger)
    for part in range(4):
        write_lines(df.filter(F.pmod(F.hash("ts", "userid", "adid"), F.lit(4)) == part).coalesce(1), f"{root}/in")
        run_once(spark, start, f"{root}/in", f"{root}/out", f"{root}/cp")
        seen = df.filter(F.pmod(F.hash("ts", "userid", "adid"), F.lit(4)) <= part)
        assert rows(jobs.read_blacklist(spark, f"{root}/out", 7)) == rows(op.blacklist_users(seen, 7))
        assert rows(jobs.read_blacklist_counts(spark, f"{root}/out", 7)) == rows(op.blacklist_filtered_counts(seen, 7))


def _state_days(spark, cp, name):
    state = spark.read.format("statestore").option("stateVarName", name).load(cp)
    return {r[0] for r in state.select("user_map_key.dt").distinct().collect()}


@pytest.mark.parametrize("mode,name", [("event_time", "clicks"), ("micro_batch", "counters")])
def test_closed_days_leave_the_state_and_their_counters_stay(spark, mode, name):
    root = shared_dir(spark)
    day = 86400
    recs = [(d * 1000 + i, d * day + 60 + i * 7, "A", "c", i % 4 if i % 3 else 50 + i, i % 2 + 1) for d in range(6) for i in range(60)]
    df = ads(spark, recs)
    start = lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, 50, mode, trigger, retain_days=1)
    for d in range(6):   # one run per day, in day order
        write_lines(df.filter(F.floor(F.col("event_id") / 1000) == d).coalesce(1), f"{root}/in")
        run_once(spark, start, f"{root}/in", f"{root}/out", f"{root}/cp")
    got = rows(jobs.read_blacklist_counts(spark, f"{root}/out", 50, mode))
    assert got == rows(op.blacklist_filtered_counts(df, 50))
    days = sorted(r.dt for r in df.select("dt").distinct().collect())
    assert _state_days(spark, f"{root}/cp", name) <= set(days[-3:])          # closed days left the state
    # a click of a closed day is dropped, counted, and changes nothing
    write_lines(df.filter("event_id < 3").coalesce(1), f"{root}/in")
    q = run_once(spark, start, f"{root}/in", f"{root}/out", f"{root}/cp")
    assert jobs.dropped_rows(q) > 0
    assert rows(jobs.read_blacklist_counts(spark, f"{root}/out", 50, mode)) == got


def test_a_far_future_click_closes_nothing_of_today(spark):
    root = shared_dir(spark)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    mk = lambda e, ts, u: (e, ts, ts.strftime("%Y-%m-%d"), "A", "c", u, "1")
    start = lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, 3, trigger=trigger, retain_days=1)
    batches = [[mk(1, now, "u"), mk(2, now + dt.timedelta(days=20_000), "u")], [mk(3, now, "u")], [mk(4, now, "u"), mk(5, now, "v")]]
    for b in batches:
        write_lines(spark.createDataFrame(b, ADS_SCHEMA).coalesce(1), f"{root}/in")
        run_once(spark, start, f"{root}/in", f"{root}/out", f"{root}/cp")
    all_clicks = spark.createDataFrame([r for b in batches for r in b], ADS_SCHEMA)
    assert rows(jobs.read_blacklist_counts(spark, f"{root}/out", 3)) == rows(op.blacklist_filtered_counts(all_clicks, 3))
    with pytest.raises(ValueError):
        jobs.blacklist_stream(all_clicks, f"{root}/x", f"{root}/y", mode="nonsense")


def test_thinning_keeps_what_the_rules_need(spark):
    df = ads(spark, [(i, i % 50, "A", "c", i % 3, i % 2 + 1) for i in range(3000)])
    counted = thinned(df, None)
    assert rows(counted.groupBy("dt", "adid", "userid").agg(F.sum("n").alias("clicks"))) == rows(op.ad_user_daily_counts(df))
    assert counted.count() <= 6 * counted.rdd.getNumPartitions()
    first = thinned(df.coalesce(1), 5)
    want = op.first_clicks(df, 5).select("dt", "adid", "userid", F.unix_micros("ts").alias("us"), F.col("event_id").alias("id"))
    assert rows(first.select("dt", "adid", "userid", "us", "id")) == rows(want)


def test_watermarked_days_follow_the_session_time_zone(spark):
    # under +05:30 a local day spans two UTC days; expiry windows must not split its counts
    root = shared_dir(spark)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = sample(spark, 300)
        write_lines(df.orderBy("ts").coalesce(1), f"{root}/in")
        start = lambda c, o, cp, trigger: jobs.ads_click_daily_stream(c, o, cp, trigger, watermark="1 hour")  # noqa
        run_once(spark, start, f"{root}/in", f"{root}/out", f"{root}/cp")
        got = rows(jobs.read_ads_click_daily(spark, f"{root}/out"))
        want = rows(op.ads_click_daily(parse_lines(encode_lines(df))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want


def test_blacklist_echo_prints_changed_counters(spark, capsys):
    root = shared_dir(spark)
    write_lines(sample(spark, 60).coalesce(1), f"{root}/in")
    start = lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, 3, trigger=trigger, echo=5)
    run_once(spark, start, f"{root}/in", f"{root}/out", f"{root}/cp", per_trigger=10)
    out = capsys.readouterr().out
    assert "userid" in out and "clicks" in out


def test_lines_are_split_in_one_pass(spark):
    root = shared_dir(spark)
    lines = ["1704110400000 A B u 1", "nonsense", "9223372036854775807 A B 1 2", "1704110400000 A B u 1 77"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/in")
    split = lambda c, o, cp, trigger: jobs.split_lines_stream(read_line_stream(spark, "text", path=f"{root}/in"), o, cp, trigger)
    q = run_once(spark, split, f"{root}/in", f"{root}/out", f"{root}/cp")
    assert jobs.line_counts(q) == {"read": 4, "good": 2, "bad": 2}
    assert rows(jobs.read_bad_lines(spark, f"{root}/out")) == [("9223372036854775807 A B 1 2",), ("nonsense",)]
    assert rows(jobs.read_clicks(spark, f"{root}/out"), "userid", "dt") == [("u", "2024-01-01")] * 2
    jobs.ads_click_daily_stream(jobs.clicks_from(spark, f"{root}/out"), f"{root}/out", f"{root}/cp2", {"availableNow": True}).awaitTermination()
    assert rows(jobs.read_ads_click_daily(spark, f"{root}/out"), "adid", "clicks") == [("1", 2)]
    spark.createDataFrame([("1704110400000 A B v 2",), ("x",)], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
    run_once(spark, split, f"{root}/in", f"{root}/out", f"{root}/cp")
    jobs.ads_click_daily_stream(jobs.clicks_from(spark, f"{root}/out"), f"{root}/out", f"{root}/cp2", {"availableNow": True}).awaitTermination()
    assert rows(jobs.read_ads_click_daily(spark, f"{root}/out"), "adid", "clicks") == [("1", 2), ("2", 1)]
    assert jobs.read_bad_lines(spark, f"{root}/out").count() == 3


def test_arrival_windows_follow_a_declared_clock(spark):
    # two deliveries 20 s apart, clicks years old: each counts in the six windows of its arrival
    root = shared_dir(spark)
    for name, e in (("2030-01-01 00%3A00%3A00", 1), ("2030-01-01 00%3A00%3A20", 2)):
        encode_lines(ads(spark, [(e, 5, "A", "c", 1, 1)])).coalesce(1).write.text(f"{root}/in/arrival={name}")
    lines = read_line_stream(spark, "text", path=f"{root}/in", maxFilesPerTrigger=1, partitions="arrival timestamp")
    clicks = parse_lines(lines, ["arrival"])
    jobs.ads_arrival_trend_stream(clicks, f"{root}/out", f"{root}/cp", trigger={"availableNow": True}, arrival="arrival").awaitTermination()
    got = {r.win_start: r.clicks for r in jobs.read_ads_arrival_trend(spark, f"{root}/out").collect()}
    assert len(got) == 8 and got["2030-01-01 00:00:00"] == 2 and got["2029-12-31 23:59:30"] == 2
    assert got["2029-12-31 23:59:10"] == 1 and got["2030-01-01 00:00:20"] == 1


@pytest.mark.parametrize("mode,name", [("event_time", "clicks"), ("micro_batch", "counters")])
def test_users_of_a_bucket_share_an_entry_of_state_for_each_day(spark, monkeypatch, mode, name):
    # 40 users in two buckets, three days, scattered over four batches; a few are listed, some by clicks that come later
    root = shared_dir(spark)
    monkeypatch.setattr(blacklist, "BUCKETS", 2)
    recs = [(i, (i * 7919) % (3 * 86_400), "A", "c", i % 40 if i % 3 else i % 4, i % 2 + 1) for i in range(600)]
    df = ads(spark, recs).withColumn("batch", F.pmod(F.hash("event_id"), F.lit(4)))
    start = lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, 6, mode=mode, trigger=trigger)
    for part in range(4):
        write_lines(df.where(F.col("batch") == part).drop("batch").coalesce(1), f"{root}/in")
        run_once(spark, start, f"{root}/in", f"{root}/out", f"{root}/cp")
    users, counts = jobs.read_blacklist(spark, f"{root}/out", 6, mode), jobs.read_blacklist_counts(spark, f"{root}/out", 6, mode)
    twin = (op.blacklist_users, op.blacklist_filtered_counts) if mode == "event_time" else (op.blacklist_users_by_batch, op.blacklist_filtered_counts_by_batch)
    assert 0 < users.count() < 40
    assert rows(users) == rows(twin[0](df, 6))
    assert rows(counts) == rows(twin[1](df, 6))
    days = df.select("dt").distinct().count()
    state = spark.read.format("statestore").option("stateVarName", name).load(f"{root}/cp")
    assert 0 < state.count() <= 2 * days     # not one for each (day, ad, user)


def test_clicks_are_thinned_over_the_batches_of_a_task(spark, monkeypatch):
    df = ads(spark, [(i, i % 50, "A", "c", i % 3, i % 2 + 1) for i in range(3000)]).coalesce(1)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    try:
        first, counted = thinned(df, 5).collect(), thinned(df, None).collect()
        monkeypatch.setattr(blacklist, "HELD", 7)     # more than a task may hold: thinned less, nothing lost
        some = thinned(df, None)
        assert some.count() > 6
        assert rows(some.groupBy("dt", "adid", "userid").agg(F.sum("n").alias("clicks"))) == rows(op.ad_user_daily_counts(df))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(first) == 30 and sorted(r.n for r in counted) == [500] * 6
