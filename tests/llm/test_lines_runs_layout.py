"""Operators 11 to 13 against brute force and held-out labels, with the cases their docstrings define."""

import datetime
import hashlib
import random
import re
import zlib
from fractions import Fraction

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearth.llm import late_layout, line_quality, periodic
from hearth.llm.common import work_path
from hearth.llm.queries import LATE_FROM, QUERIES

SF = "/root/testdata/sf0.001"
BLANKS = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, h string, n int, bad int, kept int, levels int"
ODD = [None, "", " \n\t ", "one", "a b\x0bc\x0cd\re", "a b c d e f g h i\n" * 3, "x " * 300 + "é ü ö\x85 z", "tail\n\n# $ * % & | < >\ntail\ntail", "lo " * 40_000]


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "h", 1, 2, 3, 4) for i, t in zip(ids, texts, strict=True)], DOCS)


# ------------------------------------------------------------------ 11


def counted(text):
    text = text or ""
    words = re.findall(BLANKS, text)
    windows: dict = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(BLANKS, line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated), failed


def test_base_counts_equal_brute_force(spark):
    given_rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = given_rows + [(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id at all"), (5, "again"), (5, "again")]
    got = line_quality.judge(documents(spark, [t for _, t in rows], [i for i, _ in rows]), line_quality.Model()).collect()
    shown = lambda r: (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert sorted(map(shown, got)) == sorted((str(i), *counted(t)) for i, t in rows)
    assert all(r.kept == (not r.base_failed) for r in got)  # without a model every line is content
    assert line_quality.judge(documents(spark, []), line_quality.Model()).count() == 0


def test_viterbi_and_gradient_equal_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 7):
        scores, pairs = rng.normal(size=n).tolist(), rng.normal(size=(2, 2))
        weight = lambda y: sum(s * v for s, v in zip(scores, y, strict=True)) + sum(pairs[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: E731, B023
        assert tuple(line_quality.decoded(scores, pairs)) == max(itertools.product((0, 1), repeat=n), key=weight)
    chains = [np.stack([rng.integers(0, len(b) + 1, n) for b in line_quality.LEVELS.values()], axis=1) for n in (5, 3, 3, 1)]
    labels = np.array([1, 1, 0, 0, 1, 0, 1, 1, 1, 0, 1, 0])
    size = int(line_quality._OFFSETS[-1])
    made = lambda w: line_quality.Model(w[:size], w[size], w[size + 1 :].reshape(2, 2))

    def likelihood(w):
        model, total = made(w), 0.0
        for chain, y in zip(chains, np.split(labels, [5, 8, 11]), strict=True):
            s = model.scores(chain)
            weigh = lambda v: float(s @ np.array(v)) + sum(model.pairs[a, b] for a, b in zip(v, v[1:], strict=False))  # noqa: E731, B023
            total += weigh(tuple(y.tolist())) - np.logaddexp.reduce([weigh(v) for v in itertools.product((0, 1), repeat=len(chain))])
        return total

    w = rng.normal(size=size + 5) * 0.3
    lines, bias, pairs = line_quality.gradient(made(w), chains, labels)
    for i, g in enumerate([*lines, bias, *pairs.reshape(-1)]):
        step = np.zeros(size + 5)
        step[i] = 1e-5
        assert abs((likelihood(w + step) - likelihood(w - step)) / 2e-5 - g) < 1e-4


def test_field_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op11_line_quality"](spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    clean = [r for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    junk = [r for r in labels if r.quality == 0]
    assert len(clean) > 30 and len(junk) > 5
    assert sum(got[r.doc_id].kept for r in clean) >= 0.97 * len(clean)
    assert sum(not got[r.doc_id].kept for r in junk) >= 0.9 * len(junk)


def test_share_of_content_decides(spark):
    """A page of prose below a bar of links stays, a bar of links above one sentence goes; the field labels line by line."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = line_quality.fit(docs, labels)
    prose = [t for t in (r.text for r in docs.join(labels, "doc_id").where("quality = 1 and toxic = 0").orderBy("doc_id").collect()) if len(t) > 1500][0]
    bar = " | ".join("home shop about contact help terms news jobs press blog login cart".split()) + " |"
    found = {r.doc_id: r for r in line_quality.judge(documents(spark, [bar + "\n" + prose, (bar + "\n") * 4 + prose[:80]]), model).collect()}
    assert found[0].kept and found[0].n_boilerplate >= 1
    assert not found[1].kept


# ------------------------------------------------------------------ 12


def all_runs(w, least=6, power=4):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        b = 0
        while b + p < len(w):
            e = b + p
            while e < len(w) and w[e] == w[e - p]:
                e += 1
            if e - b >= max(least, power * p) and (b, e) not in found:
                found[b, e] = p
            b = max(e - p + 1, b + 1) if e > b + p else b + 1
    return sorted(((b, e, p) for (b, e), p in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(0, 9), st.integers(0, 40))
def test_runs_equal_brute_force(noise, word, times, at):
    w = noise[:at] + word * times + noise[at:]
    assert periodic.runs(w) == all_runs(w)


def described(doc_id, text):
    words = re.findall(BLANKS, text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [x if i < a else words[a + (i - a) % p] for i, x in enumerate(words)]
    found = all_runs(words)
    gone = {i for b, e, p in found for i in range(b + p, e)}
    best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2])) if found else None
    top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return str(doc_id), len(found), *top, digest("".join(f"{b},{e - b},{p}\n" for b, e, p in found)), digest(" ".join(x for i, x in enumerate(words) if i not in gone))


def test_periodic_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 12_000]
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(str(r[c]) if c == "doc_id" else r[c] for c in columns) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == docs.count()
    assert [got[i] for i, _ in rows] == [described(i, t) for i, t in rows]
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_periodic_runs_of_odd_rows(spark):
    texts = ODD[:-1] + ["a a a a a", "a a a a a a", "b a b a b a b a", "a b c " * 4 + "a b d " * 4, "r r r r r r r"]
    ids = [*range(len(texts) - 2), None, 3]
    got = periodic.find(documents(spark, texts, ids), looped=True).collect()
    shown = sorted((str(r.doc_id), r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in got)
    assert [tuple(map(str, r)) for r in shown] == sorted(tuple(map(str, described(i, t))) for i, t in zip(ids, texts, strict=True))
    long = periodic.find(documents(spark, ["lo " * 60_000 + "end " + "la li " * 60_000])).first()
    assert (long.n_runs, long.start, long.length, long.period, long.n_kept) == (2, 0, 60_000, 1, 1 + 1 + 2)
    assert periodic.find(documents(spark, [])).count() == 0
    assert periodic.overlap() == 5


# ------------------------------------------------------------------ 13

EPOCH = datetime.datetime(1970, 1, 1)
MICRO = datetime.timedelta(microseconds=1)
SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int"


def day(at):
    return -1 if at is None else (at - EPOCH) // datetime.timedelta(days=1)


def laid(rows, size):
    """(day, file) -> rows of a layout, from tuples of the sales columns."""
    best = {}
    order = lambda r: tuple((v is not None, v) if v is not None else (False, 0) for v in (r[5], *r[:5], r[6]))
    for r in rows:
        if r[0] not in best or order(r) > order(best[r[0]]):
            best[r[0]] = r
    days = {}
    for r in best.values():
        days.setdefault(day(r[4]), []).append(r)
    out = {}
    for d, held in days.items():
        held.sort(key=lambda r: ((r[4] is not None, r[4] or EPOCH), (r[0] is not None, r[0] or 0)))
        for i in range(0, len(held), size):
            out[d, i // size] = held[i : i + size]
    return best, out


def expected(rows, size, limit):
    early = [r for r in rows if r[5] is not None and (r[5] - EPOCH) // MICRO < limit]
    before, start = laid(early, size)
    best, final = laid(rows, size)
    late = {k: r for k, r in best.items() if r[5] is None or (r[5] - EPOCH) // MICRO >= limit}
    touched = {day(r[4]) for r in late.values()} | {day(before[k][4]) for k in late if k in before}
    micros = lambda t: "" if t is None else str((t - EPOCH) // MICRO)
    import math

    cents = lambda t: 0 if t is None else math.floor(100 * t + 0.5)
    text = lambda v: "" if v is None else str(v)
    for (d, k), held in final.items():
        assert d in touched or start[d, k] == held
        crc = sum(zlib.crc32(f"{text(r[0])}:{micros(r[4])}:{micros(r[5])}".encode()) for r in held)
        yield d, k, len(held), sum(cents(r[3]) for r in held), crc, hashlib.sha256(",".join(text(r[0]) for r in held).encode()).hexdigest(), d in touched


def with_copies(rows):
    out = list(rows)
    for r in rows:
        h = zlib.crc32(str(r[0]).encode())
        if r[0] is not None and h % 3 == 0 and day(r[4]) % 7 == 0:
            plus = lambda t, n: None if t is None else t + datetime.timedelta(days=n)
            out.append((*r[:3], None if r[3] is None else r[3] + 1, plus(r[4], h % 2), plus(r[5], 1 + h % 97), r[6]))
    return out


def files_below(folder):
    import os

    return {os.path.join(at, f) for at, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_late_overwrite_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/sales.parquet").collect()]
    got = QUERIES["op13_late_overwrite"](spark, SF).collect()
    shown = sorted((r.day, r.file_no, r.n_rows, r.cents, r.rows_crc, r.ids_sha256, r.rewritten) for r in got)
    assert shown == sorted(expected(with_copies(rows), 1 + len(rows) // 700, LATE_FROM))
    assert any(r.rewritten for r in got) and not all(r.rewritten for r in got)
    plain = {r.path.removeprefix("file:") for r in got}
    assert files_below(got[0].path.removeprefix("file:").rsplit("/", 3)[0]) == plain
    assert all(",".join(pq.ParquetFile(p).schema_arrow.names) == got[0].columns == "sale_id,client_id,status,total,sold_at,arrived_at,priority" for p in plain)


@pytest.mark.parametrize("seed", range(3))
def test_layouts_of_hot_days_ties_and_moving_sales(spark, seed):
    """Many sales at one time, keys of any size, days that lose their rows, null keys and times, repeated rows."""
    rng = random.Random(seed)
    at = lambda d, s=0: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d, seconds=s)
    rows = [(rng.choice([-(2**62), 2**62, 0]) + i, 1, "s", i / 7, at(rng.choice([0, 0, 0, 1, 9])), at(rng.randint(0, 30)), 1) for i in range(400)]
    rows += [(i, 1, "s", 1.0, at(3, rng.randint(0, 50)), at(5), 1) for i in range(1000, 1150)]
    rows += [(i, 1, "s", 2.0, at(4, i), at(25), 2) for i in range(1000, 1150)]  # day 3 loses all of its rows
    rows += [(i, 1, None, None, None, at(rng.randint(0, 30)), None) for i in range(2000, 2040)]
    rows += [(None, 1, "n", 1.0, at(2), at(2), 1), (None, 1, "n", 2.0, at(2), at(3), 1), (3000, 1, "x", 1.0, at(2), None, 1), (3000, 1, "x", 1.0, at(6), at(1), 1), (3001, 1, "x", 1.0, at(7), None, 1)]
    rows += rows[:50]
    limit = (at(20) - EPOCH) // MICRO
    folder = work_path(spark, "layout")
    got = late_layout.overwrite_late(spark, spark.createDataFrame(rows, SALES), 23, folder, work_path(spark, "stand"), limit).collect()
    assert sorted((r.day, r.file_no, r.n_rows, r.cents, r.rows_crc, r.ids_sha256, r.rewritten) for r in got) == sorted(expected(rows, 23, limit))
    assert files_below(folder.removeprefix("file:")) == {r.path.removeprefix("file:") for r in got}


def test_layout_keeps_untouched_files_and_clashing_columns(spark):
    folder = work_path(spark, "layout")
    rows = [(i, datetime.datetime(2024, 1, 1 + i % 3), datetime.datetime(2024, 2, 1 + i % 5), 7, "f", 1, i) for i in range(60)]
    shape = "sale_id long, sold_at timestamp_ntz, arrived_at timestamp_ntz, day int, file_no string, r int, t long"
    limit = (datetime.datetime(2024, 2, 9) - EPOCH) // MICRO
    late = [(7, datetime.datetime(2024, 1, 2, 5), datetime.datetime(2024, 2, 20), 8, "g", 2, 0)]
    data = lambda: {p: open(p, "rb").read() for p in files_below(folder.removeprefix("file:"))}  # noqa: E731, SIM115
    seen = {}
    write = late_layout.write

    def watched(*args):
        write(*args)
        seen.setdefault("first", data())

    late_layout.write = watched
    try:
        got = late_layout.overwrite_late(spark, spark.createDataFrame(rows + late, shape), 6, folder, work_path(spark, "stand"), limit).collect()
    finally:
        late_layout.write = write
    assert got[0].columns == "sale_id,sold_at,arrived_at,day,file_no,r,t"
    assert {r.day - 19723 for r in got if r.rewritten} == {1}
    now = data()
    assert all(now[r.path.removeprefix("file:")] == seen["first"][r.path.removeprefix("file:")] for r in got if not r.rewritten)
    assert sum(r.n_rows for r in got) == 60
    empty = late_layout.overwrite_late(spark, spark.createDataFrame([], SALES), 5, work_path(spark, "layout"), work_path(spark, "stand"), limit)
    assert empty.count() == 0 and "rewritten" in empty.columns


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = spark.createDataFrame([(datetime.datetime(2024, 3, 31, 2, 30, 1, 5),), (None,), (datetime.datetime(1969, 12, 31, 23, 59, 59, 999999),)], "at timestamp_ntz")
    try:
        for name in ("UTC", "America/New_York", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", name)
            got = [r[0] for r in rows.select(late_layout.micros(rows, "at")).collect()]
            assert got == [(datetime.datetime(2024, 3, 31, 2, 30, 1, 5) - EPOCH) // MICRO, None, -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows.select(late_layout.day_of(F.lit(-1).cast("long"))).first()[0] == -1
