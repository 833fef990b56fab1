from datetime import datetime, timezone

import pytest

from feedloom.operators.timestamps import normalise_timestamps


def ms(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1000)


FEEDS = [("utc", "UTC", "dmy"), ("ny", "America/New_York", "mdy"), ("lon", "Europe/London", "dmy"), ("none", None, "dmy"), ("ber", "Europe/Berlin", "dmy"), ("cn", "Asia/Shanghai", "dmy")]
CASES = [
    ("utc", "2025-07-15T22:50:55Z", ms(2025, 7, 15, 22, 50, 55)),
    ("ny", "2025-07-15T22:50:55", ms(2025, 7, 16, 2, 50, 55)),
    ("none", "2025-07-15 22:50:55,123", ms(2025, 7, 15, 22, 50, 55) + 123),
    ("ny", "2025-07-15T22:50:55.999999+05:30", ms(2025, 7, 15, 17, 20, 55) + 999),
    ("ny", "2025-07-15T22:50:55-0330", ms(2025, 7, 16, 2, 20, 55)),
    ("ny", "2025-07-15T22:50:55+01", ms(2025, 7, 15, 21, 50, 55)),
    ("utc", "2026-06-16T06:57:42+02:00[Europe/Berlin]", ms(2026, 6, 16, 4, 57, 42)),
    ("ny", "1747263910", 1747263910000),
    ("ny", "1747176132867", 1747176132867),
    ("ny", "1793004425.529", 1793004425529),
    ("utc", "20250922T024520Z", ms(2025, 9, 22, 2, 45, 20)),
    ("ny", "Fri, 19 Jun 2026 03:02:10 +0200", ms(2026, 6, 19, 1, 2, 10)),
    ("utc", "Sun, 4 Oct 2026 01:45:22 EDT", ms(2026, 10, 4, 5, 45, 22)),
    ("utc", "21.10.2026 19:17", ms(2026, 10, 21, 19, 17)),
    ("cn", "2026年1月27日 10:10", ms(2026, 1, 27, 2, 10)),
    ("utc", "2026年3月21日 02:12（北京时间）", ms(2026, 3, 20, 18, 12)),
    ("ny", "02/03/2026 21:53", ms(2026, 2, 4, 2, 53)),
    ("lon", "02/03/2026 9:53 PM", ms(2026, 3, 2, 21, 53)),
    ("utc", "2026/11/09", ms(2026, 11, 9)),
    ("utc", "06-Jan-26 05:35", ms(2026, 1, 6, 5, 35)),
    ("utc", "5. März 2025, 12:09 Uhr", ms(2025, 3, 5, 12, 9)),
    ("utc", "30 mars 2025 à 19h40", ms(2025, 3, 30, 19, 40)),
    ("utc", "6 de marzo de 2026, 16:51", ms(2026, 3, 6, 16, 51)),
    ("utc", "Nov 2, 2026 at 12:28 AM ET", ms(2026, 11, 2, 5, 28)),
    ("utc", "\xa0Mar 11, 2025 at 7:50 PM\t", ms(2025, 3, 11, 19, 50)),
    ("ny", "2025-03-09T02:30:00", ms(2025, 3, 9, 7, 30)),  # skipped: offset before the change
    ("ny", "2025-11-02T01:30:00", ms(2025, 11, 2, 5, 30)),  # twice: first occurrence
    ("ber", "2025-03-30 02:30:00", ms(2025, 3, 30, 1, 30)),
    ("utc", "2026-02-30T10:00:00Z", None),
    ("utc", "2025-13-04", None),
    ("utc", "0000-00-00 00:00:00", None),
    ("utc", "10:45", None),
    ("utc", "last week", None),
    ("utc", "", None),
    ("utc", None, None),
    ("unknown source", "2025-07-15T22:50:55", ms(2025, 7, 15, 22, 50, 55)),
]


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(i, s, t, "extra") for i, (s, t, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "pos long, source string, published_at string, time_zone string"), spark.createDataFrame(FEEDS, "source string, time_zone string, date_order string")


def test_cases(frames):
    a, f = frames
    got = {r.pos: r.epoch_ms for r in normalise_timestamps(a, "pos", "published_at", "source", f).collect()}
    want = {i: m for i, (_, _, m) in enumerate(CASES) if m is not None}
    assert {CASES[k][1]: got.get(k) for k in want} == {CASES[k][1]: v for k, v in want.items()}
    assert set(got) == set(want)


def test_policies(spark, frames):
    _, f = frames
    a = spark.createDataFrame([(1, "ny", "2025-03-09T02:30:00"), (2, "ny", "2025-11-02T01:30:00"), (3, "ny", "2025-06-01T00:00:00")], "pos long, source string, published_at string")
    last = {r.pos: r.epoch_ms for r in normalise_timestamps(a, "pos", "published_at", "source", f, ambiguous="last", nonexistent="null").collect()}
    assert last == {2: ms(2025, 11, 2, 6, 30), 3: ms(2025, 6, 1, 4)}
    none = normalise_timestamps(a, "pos", "published_at", "source", f, ambiguous="null").collect()
    assert sorted(r.pos for r in none) == [1, 3]
    with pytest.raises(ValueError):
        normalise_timestamps(a, "pos", "published_at", "source", f, ambiguous="maybe")


def test_empty(frames):
    a, f = frames
    assert normalise_timestamps(a.limit(0), "pos", "published_at", "source", f).count() == 0
    assert normalise_timestamps(a.limit(3), "pos", "published_at", "source", f.limit(0)).count() == 3
