from datetime import date, datetime, timezone

import pytest

from caselake.plans import domain
from caselake.sources import csv_intake, periods
from caselake.specs import ContractViolation, Slice
from caselake.streaming import serve


def test_slice_layout():
    part = Slice("2026-07-26", "day", "2024-01-01")
    path = part.under("/lake/bronze/")
    assert path == "/lake/bronze/processing_date=2026-07-26/granularity=day/reference_period=2024-01-01"
    assert Slice.parse(path, "/lake/bronze") == part
    assert Slice.parse("/r/processing_date=2026-07-26/granularity=month").reference_period is None


@pytest.mark.parametrize("path", [
    "/r/processing_date=2026-07-26/granularity=month/reference_period=2024-01-01",
    "/r/processing_date=2026-07-26/granularity=day/reference_period=2024-02-31",
    "/r/processing_date=2026-07-26/granularity=week", "/r/granularity=day",
])
def test_bad_slices(path):
    with pytest.raises(ContractViolation):
        Slice.parse(path)


def test_slice_outside_its_root():
    with pytest.raises(ContractViolation):
        Slice.parse("/a/processing_date=2026-07-26/granularity=day", "/b")


def test_period_ranges():
    assert periods.period_range("month", "12-2024") == (date(2024, 12, 1), date(2025, 1, 1))
    assert periods.period_range("month", "2024-02") == (date(2024, 2, 1), date(2024, 3, 1))
    assert periods.period_range("day", "31-12-2024") == (date(2024, 12, 31), date(2025, 1, 1))
    with pytest.raises(ContractViolation):
        periods.period_range("day", "2024-02-31")


def planned(spark, *args, limit=domain.MAX_BACKFILL_PERIODS):
    return [r[0] for r in periods.backfill_plan(spark, *args, limit).orderBy("starts_on").collect()]


def test_backfill_plans(spark):
    assert planned(spark, "month", "2024-11", "2025-02") == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert planned(spark, "day", "2024-01-30", "2024-02-01") == ["2024-01-30", "2024-01-31", "2024-02-01"]
    for bad in (("month", "2025-02", "2024-11"), ("day", "2020-01-01", "2024-01-01"), ("day", "2024-02-31", "2024-03-01")):
        with pytest.raises(ContractViolation):
            planned(spark, *bad)


def test_headers():
    assert csv_intake.header_names(["DT_NOTIFIC", "Code"], "DT_NOTIFIC") == ["dt_notific", "code"]
    for bad in (["DT_NOTIFIC", ""], ["DT_NOTIFIC", "a-b", "A B"], ["code"]):
        with pytest.raises(ContractViolation):
            csv_intake.header_names(bad, "DT_NOTIFIC")
    with pytest.raises(ContractViolation):
        csv_intake.header_names(["DT_NOTIFIC", "b"], "DT_NOTIFIC", known=["DT_NOTIFIC", "c"])


def test_scopes():
    assert serve.scope_of() == ("GLOBAL", None)
    assert serve.scope_of("state", "sp") == ("STATE", "SP")
    for bad in (("GLOBAL", "x"), ("STATE", ""), ("STATE", "a#b"), ("CITY", "x")):
        with pytest.raises(ContractViolation):
            serve.scope_of(*bad)


def test_windows():
    now = datetime(2026, 8, 3, 17, 7, 30, tzinfo=timezone.utc)
    first, last = serve.window_of(now=now)
    assert (first.minute, last.minute) == (6, 7)
    first, last = serve.window_of("2026-08-03T14:00:30-03:00", "2026-08-03T14:02:59-03:00")
    assert (first.hour, first.minute, last.minute) == (17, 0, 2)
    for bad in (("2026-08-03T14:00:00Z", None), ("2026-08-03T14:00:00", "2026-08-03T14:01:00"),
                ("2026-08-03T14:05:00Z", "2026-08-03T14:01:00Z"), (None, None, 0), (None, None, 1441),
                (None, None, "x"), ("no", "instant")):
        with pytest.raises(ContractViolation):
            serve.window_of(*bad)
    assert len(serve.STATES) == 27
