import datetime as dt

from clicklens import operators as op
from clicklens.sources import bad_lines, encode_lines, parse_lines
from tests.conftest import rows

ADS_SCHEMA = "event_id long, ts timestamp, dt string, area string, city string, userid long, adid long"
BASE = dt.datetime(2024, 1, 1, 12, 0, 0)


def ads(spark, recs):
    """recs: (event_id, seconds, area, city, userid, adid)"""
    data = []
    for e, sec, area, city, u, a in recs:
        ts = BASE + dt.timedelta(seconds=sec)
        data.append((e, ts, ts.strftime("%Y-%m-%d"), area, city, u, a))
    return spark.createDataFrame(data, ADS_SCHEMA)


def test_top3_fewer_ads_and_ties(spark):
    recs = [(1, 0, "N", "c1", 1, 7), (2, 1, "N", "c1", 1, 7), (3, 2, "N", "c2", 1, 9)]
    e = 10
    for ad in (4, 3, 2, 1):  # four tied ads in area S
        e += 1
        recs.append((e, e, "S", "c3", 2, ad))
    df = ads(spark, recs)
    got = {(r.area): r.top3 for r in op.ads_area_top3_json(df).collect()}
    assert got == {"N": '{"7":2,"9":1}', "S": '{"1":1,"2":1,"3":1}'}


def test_click_daily_and_rollup(spark):
    df = ads(spark, [(1, 0, "N", "c1", 1, 7), (2, 1, "N", "c2", 2, 7), (3, 86400, "N", "c1", 1, 7)])
    assert rows(op.ads_click_daily(df)) == [("2024-01-01", "N", "c1", 7, 1), ("2024-01-01", "N", "c2", 7, 1),
                                            ("2024-01-02", "N", "c1", 7, 1)]
    assert rows(op.ads_area_rollup(df)) == [("2024-01-01", "N", 7, 2), ("2024-01-02", "N", 7, 1)]


def test_precounted_rows_give_the_same_counts(spark):
    df = ads(spark, [(i, i, "N", "c1", i % 3, i % 2) for i in range(30)])
    direct = rows(op.ads_click_daily(df))
    counted = op.ad_user_daily_counts(df).join(df.select("userid", "area", "city").distinct(), "userid")
    assert rows(op.ads_click_daily(counted)) == direct


def test_trend_sliding_and_last_minute(spark):
    df = ads(spark, [(1, 1, "N", "c", 1, 1), (2, 9, "N", "c", 1, 1), (3, 10, "N", "c", 1, 1),
                     (4, 75, "N", "c", 1, 1)])
    assert rows(op.ads_trend_10s(df)) == [("2024-01-01 12:00:00", 2), ("2024-01-01 12:00:10", 1),
                                          ("2024-01-01 12:01:10", 1)]
    sliding = {r.win_start: r.clicks for r in op.ads_sliding_60s(df).collect()}
    assert sliding["2024-01-01 11:59:10"] == 2        # covers 11:59:10 .. 12:00:10 (exclusive)
    assert sliding["2024-01-01 12:00:10"] == 1        # 12:00:10 .. 12:01:10: only the 12:00:10 click
    assert sliding["2024-01-01 12:00:20"] == 1        # only 12:01:15
    last = rows(op.ads_last_minute(df))               # newest bucket 12:01:10 -> window 12:00:20 .. 12:01:20
    assert last == [("2024-01-01 12:01:10", 1)]


def test_blacklist_threshold_is_per_day_and_ad(spark):
    n = 3
    recs, e = [], 0
    def add(user, ad, day, k):
        nonlocal e
        for _ in range(k):
            e += 1
            recs.append((e, day * 86400 + e, "N", "c", user, ad))
    add(1, 1, 0, n - 1)          # below
    add(2, 1, 0, n)              # exactly N -> listed
    add(3, 1, 0, n + 1)          # above -> listed, 4th click dropped
    add(4, 1, 0, 2); add(4, 2, 0, 2)    # N split over two ads -> not listed
    add(5, 1, 0, 2); add(5, 1, 1, 2)    # N split over two days -> not listed
    add(3, 2, 1, 2)              # listed user, other ad, later day -> dropped
    df = ads(spark, recs)
    listed = rows(op.blacklist_users(df, n), "userid")
    assert listed == [(2,), (3,)]
    counts = {(r.userid, r.adid, r.dt): r.clicks for r in op.blacklist_filtered_counts(df, n).collect()}
    assert counts[(3, 1, "2024-01-01")] == n
    assert (3, 2, "2024-01-02") not in counts
    assert counts[(1, 1, "2024-01-01")] == n - 1 and counts[(5, 1, "2024-01-02")] == 2


def test_blacklist_micro_batch_counts_the_listing_batch(spark):
    df = ads(spark, [(1, 0, "N", "c", 1, 1), (2, 1, "N", "c", 1, 1), (3, 2, "N", "c", 1, 1),
                     (4, 3, "N", "c", 1, 2), (5, 4, "N", "c", 1, 2)])
    from pyspark.sql import functions as F
    b = df.withColumn("batch", F.when(F.col("event_id") <= 2, 0).when(F.col("event_id") <= 4, 1).otherwise(2))
    # batch 1 makes ad 1 reach 3 -> listed after batch 1; batch 1's own ad-2 click still counts, batch 2 dropped
    assert rows(op.blacklist_users_by_batch(b, 3)) == [(1, 1)]
    got = {r.adid: r.clicks for r in op.blacklist_filtered_counts_by_batch(b, 3).collect()}
    assert got == {1: 3, 2: 1}


def test_line_round_trip_and_bad_lines(spark):
    df = ads(spark, [(1, 0.25, "MIDDLE-EAST", "NATION_3", 10, 4)])
    lines = encode_lines(df)
    back = parse_lines(lines).collect()[0]
    # ids are text on the wire and stay text
    assert (back.area, back.city, back.userid, back.adid, back.event_id) == ("MIDDLE-EAST", "NATION_3", "10", "4", 1)
    assert back.ts == BASE + dt.timedelta(seconds=0.25)
    good = ["1704110400000 A B 1 2", "1546300800000 A B u-17 3", "1546300800000 A B 007 3", "-1 A B 7 3"]
    bad = ["1 A B 1", "x A B 1 2", "9223372036854775807 A B 1 2", "253402300800000 A B 1 2", "1 A B  2", "", "99999999999999999999 A B 1 2"]
    raw = spark.createDataFrame([(x,) for x in [*good, *bad, None]], "value string")
    got = {(r.userid, r.adid, r.dt) for r in parse_lines(raw).collect()}
    assert got == {("1", "2", "2024-01-01"), ("u-17", "3", "2019-01-01"), ("007", "3", "2019-01-01"), ("7", "3", "1969-12-31")}
    assert sorted((r.value for r in bad_lines(raw).collect()), key=str) == sorted([*bad, None], key=str)


def test_edge_parameters(spark):
    df = ads(spark, [(1, 0, "N", "c", 1, 1), (2, 5, "N", "c", 1, 2), (3, 9, "N", "c", 2, 1)])
    # threshold 1: a user is listed by their first click; nothing after it counts
    assert rows(op.blacklist_users(df, 1), "userid") == [(1,), (2,)]
    assert {(r.userid, r.adid): r.clicks for r in op.blacklist_filtered_counts(df, 1).collect()} == \
        {(1, 1): 1, (2, 1): 1}
    # no clicks at all: the newest-minute subquery is null and the result is empty, not an error
    assert op.ads_last_minute(df.limit(0)).count() == 0
    assert op.ads_area_top3_json(df.limit(0)).count() == 0
