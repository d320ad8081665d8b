"""Streams whose watermark closes windows and forgets keys, across restarts."""

import datetime

from hearth.streaming import ingest


def at(month, day, hour=0):
    return datetime.datetime(2024, month, day, hour)


def test_closed_windows_take_no_late_rows_and_open_ones_do(spark, tmp_path):
    rows = [
        (at(1, 1, 5), "a", 1), (at(1, 1, 6), "a", 1), (at(1, 3, 5), None, 1), (at(1, 5, 1), "a", 1), (None, "a", 1),
        (at(1, 1, 7), "a", 2), (at(1, 4, 9), "a", 2), (at(1, 5, 2), "a", 2), (at(1, 9, 0), "b", 2),
        (at(1, 8, 1), "b", 3), (at(1, 2, 1), "b", 3), (at(1, 12, 1), "b", 3), (at(1, 12, 2), "b", None),
    ]
    df = spark.createDataFrame(rows, "at timestamp, key string, part int")
    got = ingest.drained_by_part(df, "part", str(tmp_path / "w"), lambda r: ingest.by_window(r, "at", "1 day", "6 hours", "key"), ["key"])
    # Part 1 closes what ends by the 4th, 19:00; so part 2's row of the 1st is late, those of the 4th and 5th are not.
    # Part 2 closes what ends by the 8th, 18:00; the 8th itself is open for part 3, the 2nd is not; the 12th stays open.
    want = {(at(1, 1), "a"): 2, (at(1, 3), None): 1, (at(1, 4), "a"): 1, (at(1, 5), "a"): 2, (at(1, 8), "b"): 1, (at(1, 9), "b"): 1}
    found = got.collect()
    assert {(r.start, r.key): r.n for r in found} == want and len(found) == len(want)


def test_keys_are_forgotten_after_their_time(spark, tmp_path):
    rows = [(at(1, 1), 1, 1), (at(1, 1), 1, 1), (at(1, 2), 1, 2), (at(1, 2), 2, 2), (at(1, 20), 3, 3), (at(1, 21), 1, 4), (at(1, 21), 3, 4), (at(1, 21), None, 4), (at(1, 22), None, 5)]
    df = spark.createDataFrame(rows, "at timestamp, key int, part int")
    got = ingest.drained_by_part(df, "part", str(tmp_path / "w"), lambda r: ingest.once_per_key(r, ["key"], "at", "2 days"), [])
    # Key 1 is forgotten once the 20th has come, so it comes again; keys 2, 3 and null do not.
    assert sorted((r.key or 0, r.at) for r in got.collect()) == [(0, at(1, 21)), (1, at(1, 1)), (1, at(1, 21)), (2, at(1, 2)), (3, at(1, 20))]


def test_no_rows_give_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "at timestamp, key string, part int")
    got = ingest.drained_by_part(df, "part", str(tmp_path / "w"), lambda r: ingest.by_window(r, "at", "1 day", "6 hours", "key"), ["key"])
    assert got.columns == ["start", "key", "n"] and got.count() == 0
