from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from callmill.operators import instants


def us(y, m, d, h=0, mi=0, s=0, u=0, tz="UTC", fold=0):
    at = datetime(y, m, d, h, mi, s, u, ZoneInfo(tz), fold=fold)
    return int((at - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))


CASES = [
    ("24/05/2024 00:00:00", "Europe/London", "dmy", us(2024, 5, 24, tz="Europe/London")),
    ("5/20/2025", "America/Chicago", "mdy", us(2025, 5, 20, tz="America/Chicago")),
    ("23/5/7", "Asia/Tokyo", "ymd", us(2023, 5, 7, tz="Asia/Tokyo")),
    ("2025/07/26", "America/Chicago", "mdy", us(2025, 7, 26, tz="America/Chicago")),
    ("05/11/24", "Europe/Paris", "dmy", us(2024, 11, 5, tz="Europe/Paris")),
    ("2024-12-09T11:05:40.412Z", None, None, us(2024, 12, 9, 11, 5, 40, 412000)),
    ("20231029T001300Z", "Europe/Paris", "dmy", us(2023, 10, 29, 0, 13)),
    ("20241119", "Europe/London", "dmy", us(2024, 11, 19, tz="Europe/London")),
    ("1720281779", None, None, 1720281779000000),
    ("1737218158453", None, None, 1737218158453000),
    ("46001.625", "Europe/Madrid", "dmy", us(2025, 12, 10, 15, tz="Europe/Madrid")),
    ("2024-10-27T01:20:00+02:00", "Europe/Madrid", "dmy", us(2024, 10, 26, 23, 20)),
    ("2025-08-23T07:52:49-03:00[America/Sao_Paulo]", None, None, us(2025, 8, 23, 10, 52, 49)),
    ("2025-03-09 01:49:00 America/Los_Angeles", None, None, us(2025, 3, 9, 9, 49)),
    ("Tue, 28 Nov 2023 12:22:41 -0500", None, None, us(2023, 11, 28, 17, 22, 41)),
    ("26 Aug 2023 14:07:01 CEST", "Europe/London", "dmy", us(2023, 8, 26, 12, 7, 1)),
    ("10 Jul 2024 23:04:22 JST", None, None, us(2024, 7, 10, 14, 4, 22)),
    ("13 de marzo de 2024", "America/Sao_Paulo", "dmy", us(2024, 3, 13, tz="America/Sao_Paulo")),
    ("22. Dezember 2025, 11:28 Uhr", "America/Chicago", "mdy", us(2025, 12, 22, 17, 28)),
    ("1er février 2025 13h48", "Europe/London", "dmy", us(2025, 2, 1, 13, 48)),
    ("June 22, 2023", "Europe/London", "dmy", us(2023, 6, 22, tz="Europe/London")),
    ("10th March 2024", "UTC", "dmy", us(2024, 3, 10)),
    ("2025年2月5日 3時05分", "Asia/Tokyo", "ymd", us(2025, 2, 5, 3, 5, tz="Asia/Tokyo")),
    ("11/06/2023 12:30 AM", "Europe/Madrid", "dmy", us(2023, 6, 11, 0, 30, tz="Europe/Madrid")),
    ("10/05/2023 12:45 PM", "Europe/Madrid", "dmy", us(2023, 5, 10, 12, 45, tz="Europe/Madrid")),
    # twice: the earlier instant; skipped: forward by the gap
    ("2024-11-03 01:30:00", "America/New_York", "mdy", us(2024, 11, 3, 5, 30)),
    ("2024-03-10 02:30:00", "America/New_York", "mdy", us(2024, 3, 10, 7, 30)),
    ("  2025-3-22 14:03 ", "Asia/Singapore", "dmy", us(2025, 3, 22, 14, 3, tz="Asia/Singapore")),
    ("２０２５-０３-２２", "UTC", "dmy", us(2025, 3, 22)),
    *[(x, "Europe/London", "dmy", None) for x in ("", " ", "rolling", "2026", "30.02.2026 10:00", "2026-13-04", "99:99", "2026-W37", "Q2 2026", "31/02/2026", "June 2026", "2025-01-01 25:00", "2025-01-01 10:00 Nowhere/City", None)],
    ("24/05/2024", None, None, None),
    ("46001", None, None, None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "i int, raw string, tz string, date_order string")
    return {r.i: r.instant_us for r in instants.parse(rows).collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=lambda i: repr(CASES[i][0]))
def test_parse(parsed, i):
    assert parsed[i] == CASES[i][3]


def test_session_zone_plays_no_part(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = spark.createDataFrame([("2024-05-24 10:00", "UTC", "dmy"), ("45000.5", "UTC", "dmy")], "raw string, tz string, date_order string")
        assert [r.instant_us for r in instants.parse(rows).collect()] == [us(2024, 5, 24, 10), us(2023, 3, 15, 12)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dictionary_grows(spark, tmp_path):
    make = lambda *texts: spark.createDataFrame([(i, t, "UTC", "dmy", 7) for i, t in enumerate(texts)], "k int, raw string, tz string, date_order string, instant_us int")
    kept = str(tmp_path / "d")
    first = instants.normalise(make("2024-01-01", "2024-01-01", "x", None), "raw", "tz", "date_order", "k", kept)
    assert sorted((r.k, r.instant_us) for r in first.collect()) == [(0, us(2024, 1, 1)), (1, us(2024, 1, 1)), (2, None), (3, None)]
    second = instants.normalise(make("2024-01-01", "2024-01-02"), "raw", "tz", "date_order", "k", kept)
    assert [r.instant_us for r in second.orderBy("k").collect()] == [us(2024, 1, 1), us(2024, 1, 2)]
    assert spark.read.parquet(f"{kept}/v{instants.PARSER_VERSION}").count() == 3


def test_dictionary_shared_by_one_query(spark, tmp_path):
    """Results that were made while the dictionary grew keep what each needs when they are read together."""
    make = lambda first, texts: spark.createDataFrame([(first + i, t, "UTC", "dmy") for i, t in enumerate(texts)], "k int, raw string, tz string, date_order string")
    days = [f"2024-01-{n:02}" for n in range(1, 29)]
    parts = [instants.normalise(make(100 * n, days[: 9 * (n + 1)]), "raw", "tz", "date_order", "k", str(tmp_path / "d")) for n in range(3)]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert {r.k: r.instant_us for r in together.collect()} == {100 * n + i: us(2024, 1, i + 1) for n in range(3) for i in range(9 * (n + 1))}


def test_query(spark, tables):
    rows = {"desk": "LDN"}
    made = dict(
        desks=[{"desk": "LDN", "tz": "Europe/London", "date_order": "dmy"}],
        target_list=[{"list_row": 1, "published_at": "24/05/2024", **rows}, {"list_row": 1, "published_at": "24/05/2024", **rows, "loaded_at": datetime(2026, 1, 1)}, {"list_row": 2, "published_at": "24/05/2024"}, {"list_row": None, "published_at": "24/05/2024"}],
        reference_list=[{"ref_row": 1, "pub_date": None, **rows}],
        output_calls=[{"call_id": 5, "out_date": "x" * 50_000, **rows}],
    )
    found = instants.p5_found(spark, tables(extra={"raw": 1, "tz": "x", "instant_us": 3, "_key": "k"}, **made)).collect()
    assert [tuple(r) for r in found] == [("target_list", 1, us(2024, 5, 24, tz="Europe/London"))]
    empty = instants.p5_found(spark, tables(**{k: [] for k in made}))
    assert empty.count() == 0 and empty.columns == ["table_name", "row_key", "instant_us"]
    assert empty.select(F.col("row_key")).dtypes == [("row_key", "bigint")]


def test_two_runs_at_once_give_no_row_twice(spark, tmp_path):
    """A text that two runs have added to the kept dictionary stands in it twice and gives its row once."""
    rows = spark.createDataFrame([(1, "2026-01-02", "UTC", "dmy"), (2, "2026-01-02", "UTC", "dmy")], "k bigint, raw string, tz string, o string")
    first = {r.k: r.instant_us for r in instants.normalise(rows, "raw", "tz", "o", "k", str(tmp_path / "d")).collect()}
    kept = f"{tmp_path / 'd'}/v{instants.PARSER_VERSION}"
    spark.read.parquet(kept).select("_key", "instant_us").write.parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.parquet(f"{kept}/added=other")
    again = instants.normalise(rows, "raw", "tz", "o", "k", str(tmp_path / "d")).collect()
    assert len(again) == 2 and {r.k: r.instant_us for r in again} == first
