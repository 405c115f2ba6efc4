"""Spans that begin at one place stand in the order of their kinds."""

from clicklens.llm import pii
from tests.llm import brute

TEXT = "10.0.0.1@host.com +14155552671@sms.example.com 4111111111111111@x.com"


def test_kinds_that_begin_at_one_place(spark):
    (row,) = pii.find_pii(spark.createDataFrame([(TEXT,)], "text string")).collect()
    want = brute.base_spans(TEXT)
    # each address begins with the other kind; its digits may be a card or a phone number as well
    assert [next(k for k, a, _ in want if a == at) for at in (0, 18, 47)] == ["email"] * 3
    assert {"ip", "phone", "card"} <= {k for k, a, _ in want if a in (0, 18, 47)}
    assert [(s.kind, s.start, s.end) for s in row.pii if s.kind in pii.BASE] == want
    (red,) = pii.redact(spark.createDataFrame([(TEXT,)], "text string")).collect()
    assert red.text == "[EMAIL] [EMAIL] [EMAIL]"
