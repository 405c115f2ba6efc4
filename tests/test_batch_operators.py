"""Golden edge cases (FIXTURES.md section 5) on tiny hand-written visit logs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clicklens import operators as op
from tests.conftest import rows

VISIT_SCHEMA = ("event_id long, date string, user_id long, session_id string, page_id long, "
                "action_time timestamp_ntz, click_category_id long, order_category_ids string, "
                "pay_category_ids string")


def t(sec: float) -> dt.datetime:
    return dt.datetime(2024, 1, 1, 10, 0, 0) + dt.timedelta(seconds=sec)


def visits(spark, recs):
    """recs: (event_id, session, page, seconds, click, order, pay)"""
    data = [(e, "2024-01-01", 1, s, p, t(sec), c, o, pay) for e, s, p, sec, c, o, pay in recs]
    return spark.createDataFrame(data, VISIT_SCHEMA)


def test_action_routing_first_match_wins(spark):
    v = visits(spark, [
        (1, "s", 1, 0, 3, "4", None),        # click wins over order
        (2, "s", 1, 1, -1, "  ", "5"),       # blank order -> pay
        (3, "s", 1, 2, -1, None, None),      # nothing
        (4, "s", 1, 3, None, "1,1", None),   # null click = no click; duplicates count twice
        (5, "s", 1, 4, -1, ",", None),       # only commas -> no ids
    ])
    got = rows(op.action_routing(v, keep=["event_id"]))
    assert got == [(1, "3", "click"), (2, "5", "pay"), (4, "1", "order"), (4, "1", "order")]


def test_metric_pivot_missing_metric_is_zero(spark):
    v = visits(spark, [(1, "s", 1, 0, 2, None, None), (2, "s", 1, 1, -1, "2,3", None)])
    got = rows(op.category_metric_pivot(v))
    assert got == [("2", 1, 1, 0), ("3", 0, 1, 0)]


def test_top10_ties_go_to_smallest_category_string(spark):
    recs = [(i, "s", 1, i, c, None, None) for i, c in enumerate(range(1, 12))]
    got = [r.category_id for r in op.hot_category_top10(visits(spark, recs)).collect()]
    assert got == sorted(str(c) for c in range(1, 12))[:10]


def test_top10_ordering_click_then_order_then_pay(spark):
    recs = [(1, "s", 1, 0, 1, None, None), (2, "s", 1, 1, 2, None, None), (3, "s", 1, 2, -1, "2", None),
            (4, "s", 1, 3, -1, None, "1")]
    got = [r.category_id for r in op.hot_category_top10(visits(spark, recs), 2).collect()]
    assert got == ["2", "1"]


def test_task_id_is_one_value_per_run(spark):
    v = visits(spark, [(1, "s", 1, 0, 1, None, None), (2, "s", 1, 1, 2, None, None)])
    out = op.hot_category_top10(v, task_id="run-7")
    assert {r.task_id for r in out.collect()} == {"run-7"}


def test_session_top_n_per_category(spark):
    recs = []
    e = 0
    for sess, n in [("a", 3), ("b", 1), ("c", 3), ("d", 2)]:
        for _ in range(n):
            e += 1
            recs.append((e, sess, 1, e, 5, None, None))
    got = rows(op.hot_category_session_top10(visits(spark, recs), 10, 2))
    assert got == [("5", "a", 3), ("5", "c", 3)]


@pytest.mark.parametrize("slice_s", [None, 60, 1])
def test_transitions_use_unfiltered_order(spark, slice_s):
    v = visits(spark, [(1, "x", 1, 0, -1, None, None), (2, "x", 9, 5, -1, None, None),
                       (3, "x", 2, 10, -1, None, None), (4, "y", 1, 0, -1, None, None),
                       (5, "y", 2, 3, -1, None, None), (6, "z", 1, 0, -1, None, None)])
    got = rows(op.page_conversion(v, "1,2", slice_width_s=slice_s, hot_sample=None))
    assert got == [(1, 2, 1, 3, 1 / 3)]
    assert rows(op.page_visits(v, "1,2")) == [(1, 3), (2, 2)]


def test_flow_pairs():
    assert op.flow_pairs("1,2,3") == [(1, 2), (2, 3)]
    assert op.flow_pairs("1,2,1,2") == [(1, 2), (2, 1)]
    assert op.flow_pairs("5") == []


def test_single_row_session_has_no_transition_or_dwell(spark):
    v = visits(spark, [(1, "solo", 3, 0, -1, None, None)])
    assert op.page_transitions(v).count() == 0
    assert op.page_dwell(v).count() == 0


def test_dwell_integer_mean_in_ms(spark):
    v = visits(spark, [(1, "s", 4, 0, -1, None, None), (2, "s", 7, 1, -1, None, None),
                       (3, "u", 4, 0, -1, None, None), (4, "u", 8, 2.001, -1, None, None)])
    # second precision: 0 -> 1 s = 1000 ms, 0 -> 2.001 s = 2000 ms -> mean 1500
    assert rows(op.page_avg_dwell(v)) == [(4, 1500)]


@pytest.mark.parametrize("width", [1, 7, 60])
def test_sliced_next_equals_plain_lead_on_a_hot_session(spark, width):
    # one hot session spanning many slices, ties in time broken by event_id, plus small sessions
    recs = [(i, "hot", i % 10 + 1, i // 3, -1, None, None) for i in range(300)]
    recs += [(1000 + i, f"s{i % 7}", i % 5 + 1, i * 11, -1, None, None) for i in range(40)]
    v = visits(spark, recs)
    plain = rows(op.page_steps(v, None))
    sliced = rows(op.page_steps(v, width, hot_sample=None))   # every session takes the sliced path
    assert sliced == plain and len(plain) == 299 + 40 - 7
    assert rows(op.page_dwell(v, width, hot_sample=None)) == rows(op.page_dwell(v, None))


def test_hot_sessions_are_routed_to_the_sliced_path(spark):
    # a 3,000-row bot session among small ones; a generous sample finds it
    recs = [(i, "bot", i % 10 + 1, i // 4, -1, None, None) for i in range(3000)]
    recs += [(10_000 + i, f"s{i % 50}", i % 5 + 1, i * 13, -1, None, None) for i in range(400)]
    v = visits(spark, recs)
    assert [r.session_id for r in op.hot_keys(v, "session_id", fraction=0.5).collect()] == ["bot"]
    plain = rows(op.page_steps(v, None))
    assert rows(op.page_steps(v, 60, hot_sample=0.5)) == plain      # bot sliced, the rest plain
    assert rows(op.page_steps(v, 60, hot_sample=None)) == plain     # every session sliced
    assert rows(op.page_dwell(v, 60, hot_sample=0.5)) == rows(op.page_dwell(v, None))
    assert len(plain) == 2999 + 400 - 50


@pytest.mark.parametrize("width,sample", [(None, None), (7, None), (60, 0.5)])
def test_keep_last_returns_every_visit_once(spark, width, sample):
    recs = [(i, "bot", i % 10 + 1, i // 4, -1, None, None) for i in range(3000)]
    recs += [(10_000 + i, f"s{i % 50}", i % 5 + 1, i * 13, -1, None, None) for i in range(400)]
    v = visits(spark, recs)
    got = op.session_pairs(v, ["page_id"], (), width, sample, keep_last=True)
    assert got.count() == 3400
    assert got.filter("next_page_id IS NULL").count() == 51          # one last visit per session
    assert rows(got.filter("next_page_id IS NOT NULL"), "event_id", "next_page_id") == \
        rows(op.session_pairs(v, ["page_id"], (), None, None), "event_id", "next_page_id")


@pytest.mark.parametrize("rps", [50, 400, 1_000_000])
def test_adaptive_slices_for_hot_sessions(spark, rps):
    # a 3,000-row bot spread over many minutes plus a burst of 600 rows in one second
    recs = [(i, "bot", i % 10 + 1, i * 20, -1, None, None) for i in range(3000)]
    recs += [(5000 + i, "bot", i % 7 + 1, 30_000 + i / 1000, -1, None, None) for i in range(600)]
    recs += [(10_000 + i, f"s{i % 50}", i % 5 + 1, i * 13, -1, None, None) for i in range(400)]
    v = visits(spark, recs)
    hot = op.hot_keys(v, "session_id", 0.5, time_us=F.unix_micros(F.col("action_time").cast("timestamp")),
                      rows_per_slice=rps)
    assert [r.session_id for r in hot.collect()] == ["bot"]
    plain = rows(op.page_steps(v, None))
    assert rows(op.page_steps(v, 60, hot_sample=0.5, rows_per_slice=rps)) == plain
    assert rows(op.page_dwell(v, 60, hot_sample=0.5, rows_per_slice=rps)) == rows(op.page_dwell(v, None))


def test_flow_of_one_page_has_no_hops(spark):
    v = visits(spark, [(1, "x", 1, 0, -1, None, None), (2, "x", 2, 5, -1, None, None)])
    assert op.page_conversion(v, "1").count() == 0
    assert op.page_conversion(v, [1], include_zero=True).count() == 0
    assert rows(op.page_conversion(v, [1, 2])) == [(1, 2, 1, 1, 1.0)]


def test_hot_routing_does_not_depend_on_row_placement(spark):
    # many sessions near the threshold, a null session, and a thin session with a burst; shuffled input
    recs = [(i, f"s{i % 40}", i % 9 + 1, i // 5, -1, None, None) for i in range(8000)]
    recs += [(20_000 + i, None, i % 4 + 1, i // 2, -1, None, None) for i in range(1500)]
    recs += [(30_000 + i, "thin", i % 6 + 1, i * 3600, -1, None, None) for i in range(30)]
    recs += [(40_000 + i, "thin", i % 6 + 1, 50_000 + i / 500, -1, None, None) for i in range(3000)]
    base = visits(spark, recs)
    key = lambda r: [x if x is not None else "" for x in r]
    plain = sorted((tuple(r) for r in op.page_steps(base, None).collect()), key=key)
    counts = rows(op.page_conversion(base, "1,2,3", slice_width_s=None))
    for v in (base.repartition(4), base.repartition(7, "page_id"), base.dropDuplicates()):
        got = op.page_steps(v, 60, hot_sample=0.5, rows_per_slice=100)
        assert sorted((tuple(r) for r in got.collect()), key=key) == plain
        assert rows(op.page_conversion(v, "1,2,3", hot_sample=0.5, rows_per_slice=100)) == counts
