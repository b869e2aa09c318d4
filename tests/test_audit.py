"""Rejected rows accounted for."""

import pytest
from pyspark.sql import functions as F

from daymart.operators import audit
from daymart.operators.clean import clean_events, validate_events
from daymart.plans.order_events import raw_order_texts
from daymart.schemas import ALLOWED_REGIONS, ALLOWED_SETTLEMENTS, CASE_NUMBER, EVENT_TIME, KEPT_COLUMNS, REGION, SETTLEMENT

FORMAT = "yyyy-MM-dd HH:mm"


@pytest.fixture
def good(spark):
    row = {name: "1" for name in KEPT_COLUMNS} | {EVENT_TIME: "2024-01-02 03:04", REGION: ALLOWED_REGIONS[0], SETTLEMENT: ALLOWED_SETTLEMENTS[0]}
    return row


def test_each_rule_and_all_together(spark, good, tmp_path):
    number = next(f.name for f in clean_schema() if f.name not in (CASE_NUMBER, EVENT_TIME) and f.dataType.typeName() in ("long", "integer", "bigint"))
    changes = [
        {},
        {CASE_NUMBER: "X1"},
        {CASE_NUMBER: "9" * 40},
        {EVENT_TIME: "2024-13-02 03:04"},
        {number: "1,5"},
        {number: None, REGION: "NA"},
        {REGION: "elsewhere", SETTLEMENT: "maybe", CASE_NUMBER: "?", EVENT_TIME: "soon"},
    ]
    raw = spark.createDataFrame([tuple((good | c)[n] for n in KEPT_COLUMNS) for c in changes], ", ".join(f"`{n}` string" for n in KEPT_COLUMNS))
    counts = audit.audit_events(raw.repartition(3), str(tmp_path / "a"), FORMAT)
    assert counts == {"read": 7, "kept": 1, "rejected": 6, "missing": 1, "case_number": 3, "unreadable": 3, "region": 1, "settlement": 1}
    assert audit.read_kept(spark, str(tmp_path / "a"), FORMAT).count() == 1
    rules = sorted(tuple(r["rules"]) for r in audit.read_rejected(spark, str(tmp_path / "a")).collect())
    assert rules == [("case_number",)] * 2 + [("case_number", "unreadable", "region", "settlement"), ("missing",), ("unreadable",), ("unreadable",)]
    assert audit.audit_events(raw.limit(0), str(tmp_path / "b"), FORMAT)["read"] == 0


def clean_schema():
    from daymart.schemas import CLEAN_EVENTS

    return CLEAN_EVENTS.fields


def test_kept_events_are_those_of_cleaning(spark, tmp_path):
    raw = raw_order_texts(spark, "/root/testdata/sf0.001")
    counts = audit.audit_events(raw, str(tmp_path / "a"), FORMAT)
    kept = audit.read_kept(spark, str(tmp_path / "a"), FORMAT)
    want = validate_events(clean_events(raw, FORMAT))
    assert sorted(map(str, kept.collect())) == sorted(map(str, want.collect()))
    assert counts["read"] == raw.count() == counts["kept"] + counts["rejected"]
    assert counts["unreadable"] == 0


def test_a_store_that_lost_rows_is_refused(spark, good, tmp_path, monkeypatch):
    raw = spark.createDataFrame([tuple(good[n] for n in KEPT_COLUMNS)], ", ".join(f"`{n}` string" for n in KEPT_COLUMNS))
    stored = audit._stored
    monkeypatch.setattr(audit, "_stored", lambda *a: stored(*a).filter(F.lit(False)))
    with pytest.raises(RuntimeError, match="holds"):
        audit.audit_events(raw, str(tmp_path / "a"), FORMAT)
