"""Event-time days of a stream: closed once, late, repeated and invalid rows."""

from __future__ import annotations

from datetime import datetime

import pytest

from tallyhouse.streaming import closed_days

SCHEMA = "id bigint, moment timestamp, note string"


def at(day: int, hour: int = 0) -> datetime:
    return datetime(2026, 3, day, hour)


@pytest.fixture()
def feed(spark, tmp_path):
    """Sends rows as the next files of a stream and lets it take them in."""
    sent = []

    def send(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{len(sent)}")
        sent.append(rows)
        source = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in/*")
        closed_days.start(
            source, f"{tmp_path}/out", f"{tmp_path}/checkpoint", "moment", "id", "1 day", shards=2
        ).awaitTermination()
        return f"{tmp_path}/out"

    return send


def test_days_close_once_and_late_rows_are_kept(spark, feed):
    out = feed((1, at(1, 5), "a"), (2, at(1, 6), "b"), (2, at(1, 6), "b"), (3, at(2), "c"))
    # The watermark stands at the first day's start: nothing is closed.
    assert closed_days.closed_days(spark, out).count() == 0
    # The next rows move it to the third day's start; an older open day still counts.
    feed((4, at(1, 23), "d"), (1, at(1, 5), "a"), (5, at(4), "e"))
    days = {str(r.day): r.rows for r in closed_days.closed_days(spark, out).collect()}
    assert days == {"2026-03-01": 3, "2026-03-02": 1}
    feed((6, at(1), "late"), (7, at(2, 1), "late"), (8, at(9), "f"))
    days = {str(r.day): r.rows for r in closed_days.closed_days(spark, out).collect()}
    assert days == {"2026-03-01": 3, "2026-03-02": 1, "2026-03-04": 1}
    late = closed_days.late_rows(spark, out).collect()
    assert sorted(str(r.day) for r in late) == ["2026-03-01", "2026-03-02"]
    assert all('"note":"late"' in r.row for r in late)


def test_rows_without_moment_or_key_are_reported(spark, feed):
    out = feed((None, at(1), "no key"), (1, None, "no moment"), (None, None, None))
    assert closed_days.invalid_rows(spark, out).count() == 3
    assert closed_days.closed_days(spark, out).count() == 0
    assert closed_days.late_rows(spark, out).count() == 0


def test_no_rows(spark, feed):
    out = feed()
    assert closed_days.closed_days(spark, out).count() == 0
