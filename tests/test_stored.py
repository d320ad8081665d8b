"""Tables that loads change in place, pages with broken markup, samples, quantiles of odd columns, and the pairs that fuzzy duplicates compare."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hearth.functions import markup
from hearth.functions.markup import Field
from hearth.operators import dedup, quantiles, sample, stats
from hearth.sources import buckets, pages, tables

ROW = "id string, source string, score int, processing_timestamp timestamp, price double"


def test_a_load_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    import datetime

    at = datetime.datetime(2024, 1, 1)
    old = [(f"k{i}", "a", 50, at, float(i)) for i in range(400)] + [(None, "a", 50, at, -1.0)]
    path = str(tmp_path / "table")
    buckets.create(spark.createDataFrame(old, ROW), path, ["id"], 16)
    before = {f[0]: f for f in buckets.files(spark, path, 16)}
    load = [("k3", "b", 60, at, 1000.0), ("k4", "b", 40, at, 1000.0), ("k5", "b", 50, at + datetime.timedelta(days=1), 1000.0), ("k6", "b", None, None, 0.0), ("new", "b", 1, at, 7.0), (None, "b", 51, at, 8.0)]
    staged = spark.createDataFrame(load, ROW)
    counts = buckets.merge_into(spark, path, staged, ["id"], buckets.by_score, 16)
    got = {r.id: (r.source, r.price) for r in buckets.read(spark, path, 16).collect()}
    want = {r[0]: (r[1], r[4]) for r in old} | {r[0]: (r[1], r[4]) for r in load if r[0] in ("k3", "k5", "new", None)}
    assert got == want
    assert (counts["inserted"], counts["updated"], counts["skipped"]) == (1, 3, 2)
    touched = {f"bucket={r[0]}" for r in staged.select(buckets._bucket(["id"], 16)).collect()}
    after = {f[0]: f for f in buckets.files(spark, path, 16)}
    kept = {p for p in before if not any(f"/{t}/" in p for t in touched)}
    assert 0 < len(kept) < len(before) and all(before[p] == after[p] for p in kept)
    assert not any(p in after for p in before if p not in kept)
    assert buckets.merge_into(spark, path, staged.limit(0), ["id"], None, 16)["inserted"] == 0
    # Every column is replaced, by two keys, without a rule.
    assert buckets.merge_into(spark, path, spark.createDataFrame([("k9", "z", 0, at, 0.0)], ROW), ["id", "source"], None, 16)["inserted"] == 1


def test_day_partitions_are_pruned_by_the_joined_days(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(400).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("dt"))
    tables.write_days(rows.repartition("dt"), path)
    stored = spark.read.parquet(path)
    joined = tables.join_days(stored, tables.days_before(spark.range(1).select(F.lit("2024-01-07").cast("date").alias("last")), 3))
    assert joined.count() == 30
    plan = joined._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()
    assert len(joined.select("dt").distinct().collect()) == 3
    files = {r[0] for r in joined.select(F.input_file_name()).distinct().collect()}
    assert {f.split("dt=")[1][:10] for f in files} == {"2024-01-05", "2024-01-06", "2024-01-07"}
    latest = tables.read_latest(spark, path, "2024-01-20", 90)
    assert {str(r.dt) for r in latest.select("dt").distinct().collect()} == {"2024-01-20"}


BROKEN = """<html><head><title>A &amp; B</title><script>if (1 < 2) "</div>"</script></head><body>
<div class="list js"><div class="card new"><h3>One<span class=name> uno </span></h3><a class='go' href="/1?a=1&amp;b=2">go</a><p>first<p>second<div class="card"><h3>Inner</h3></div></div>
<div class=card><h3>Two<br>lines</h3><a href=/2>x</a><ul><li>a<li>b</ul></span></div><!-- <div class="card"></div> -->
<div class="cardboard"><h3>None</h3></div><div class="card"><h3>Cut off"""


def test_markup_reads_broken_pages():
    cards = markup.read(BROKEN, [Field("title", "h3"), Field("link", "a", "href"), Field("name", "h3 span.name"), Field("items", "li", None, True), Field("text", "p", None, True)], "div.card")
    assert [c.get("title") for c in cards] == [["One uno"], ["Inner"], ["Two lines"], ["Cut off"]]
    assert [c.get("link") for c in cards] == [["/1?a=1&b=2"], None, ["/2"], None]
    assert cards[0]["name"] == ["uno"] and cards[0]["text"] == ["first", "second"] and cards[2]["items"] == ["a", "b"]
    assert markup.read(BROKEN, [Field("t", "head title"), Field("n", "body title")]) == [{"t": ["A & B"]}]
    assert markup.read(None, [Field("t", "p")]) == [{}] and markup.read("", [], "p") == []
    assert markup.read('<a "' * 20_000 + "<p>end", [Field("p", "p")]) is not None
    deep = markup.read("<div>" * 5000 + "<p>x</p>", [Field("p", "p")])
    assert deep in ([{}], [{"p": ["x"]}])


@pytest.mark.parametrize("seed", range(4))
def test_markup_equals_a_plain_reader_on_random_trees(seed):
    """Well-formed trees with random nesting: texts of all elements on a path, against a recursive walk."""
    rng = random.Random(seed)

    def tree(depth):
        return (rng.choice(("div", "span", "b", "em")), rng.choice(("", "x", "y", "x y")), [tree(depth - 1) if depth and rng.random() < 0.6 else f"t{rng.randint(0, 99)} " for _ in range(rng.randint(0, 4))])

    shown = lambda t: t if isinstance(t, str) else f'<{t[0]} class="{t[1]}">' + "".join(map(shown, t[2])) + f"</{t[0]}>"
    text = lambda t: t if isinstance(t, str) else "".join(map(text, t[2]))
    found = []

    def walk(t, above):
        if not isinstance(t, str):
            if t[0] == "span" and any(a[0] == "div" and "x" in a[1].split() for a in above):
                found.append(" ".join(text(t).split()))
            for c in t[2]:
                walk(c, [*above, t])

    root = ("div", "x", [tree(6) for _ in range(6)])
    walk(root, [])
    assert sorted(markup.read(shown(root), [Field("s", "div.x span", None, True)])[0].get("s", [])) == sorted(found)


def test_records_and_cards_of_odd_pages(spark):
    rows = spark.createDataFrame([(1, BROKEN), (2, None), (None, "<p>x</p>"), (4, "")], "page_id int, html string")
    got = pages.records(rows, "page_id", "html", [Field("t", "title"), Field("p", "p", None, True)]).collect()
    assert [(r.page_id, r.t, r.p) for r in got] == [(1, "A & B", ["first", "second"]), (2, None, []), (None, None, ["x"]), (4, None, [])]
    cards = pages.records(rows, "page_id", "html", [Field("h", "h3")], ".card").collect()
    assert [(r.page_id, r.position, r.h) for r in cards] == [(1, 0, "One uno"), (1, 1, "Inner"), (1, 2, "Two lines"), (1, 3, "Cut off")]


def test_sample_is_the_same_on_any_partitioning(spark):
    rows = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2010, "small").alias("s"))
    once = {(r.k, r.s) for r in sample.least_hashes(rows, ["s"], "k", 50).collect()}
    again = {(r.k, r.s) for r in sample.least_hashes(rows.repartition(7, "k"), ["s"], "k", 50, parts=3).collect()}
    assert once == again
    assert [sum(s == v for _, s in once) for v in ("hot", "small", None)] == [50, 10, 50]


@pytest.mark.parametrize("odd", [[math.inf], [-math.inf] * 3, [math.nan, math.inf], [1.7e308, -1.7e308], [5e-324, 0.0], []])
def test_quantiles_of_odd_columns_end(spark, odd):
    plain = [float(i % 977) for i in range(9000)] + odd
    rows = spark.createDataFrame([(v,) for v in plain] + [(None,)], "v double")
    ordered = sorted(plain, key=lambda v: (math.isnan(v), v if not math.isnan(v) else 0))
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.exact(rows, "v", shares)
    for s, g in zip(shares, got, strict=True):
        p = (len(ordered) - 1) * s
        a, b = ordered[math.floor(p)], ordered[math.ceil(p)]
        want = a if a == b or p == math.floor(p) else a + (p - math.floor(p)) * (b - a)
        assert g == want or (math.isnan(g) and math.isnan(want)) or abs(g - want) < 1e-9
    only = spark.createDataFrame([(math.inf,), (math.nan,)], "v double")
    assert quantiles.exact(only, "v", [0.0]) == [math.inf] and math.isnan(quantiles.exact(only, "v", [1.0])[0])


def test_features_chosen_by_variance_and_strength(spark):
    rows = spark.range(200).select(F.col("id").cast("double").alias("y"), (F.col("id") * 2.0).alias("a"), F.lit(3.0).alias("flat"), (F.col("id") % 7).cast("double").alias("noise"), F.when(F.col("id") % 2 == 0, -F.col("id")).cast("double").alias("half"))
    matrix = stats.covariances(rows, ["y", "a", "flat", "noise", "half"])
    assert [r.name for r in stats.chosen_features(matrix, "y", 0.0, 2).collect()] == ["a", "half"]
    assert [r.n for r in matrix.where("a = 'half' and b = 'half'").collect()] == [100]


LISTING = "listing_key string, province string, district string, ward string, street string, price double, area double, bedroom int, latitude double, longitude double, score int, processing_timestamp timestamp"


@pytest.mark.parametrize("threshold", [0.85, 0.9, 0.7, 0.5])
def test_fuzzy_candidates_lose_no_pair_and_are_few(spark, threshold):
    import datetime

    rng = random.Random(5)
    words = "an binh cau dong hoa long minh phu tan xuan".split()
    rows = []
    for i in range(300):
        street = rng.choice([None, "", " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))])
        rows.append((f"k{i:03}", rng.choice(["ha noi", "ha-noi"]), rng.choice(["q1", None]), rng.choice([None, "p1", "xp1"]), street, rng.choice([2e9, 2.001e9, 2.05e9]), rng.choice([50.0, 52.0, 58.0, 0.0]),
                     rng.choice([2, 2, None, 3]), rng.choice([10.0, 10.0005]), 106.0, i, datetime.datetime(2024, 1, 1)))
    rows += [rows[0], rows[1]]
    data = spark.createDataFrame(rows, LISTING).cache()
    got = sorted((r.a, r.b, round(r.similarity, 6)) for r in dedup.similar_pairs(data, threshold).collect())
    blocked = data.withColumn("block", dedup.loose_key())
    both = blocked.alias("x").join(blocked.alias("y"), (F.col("x.block") == F.col("y.block")) & (F.col("x.listing_key") < F.col("y.listing_key")))
    every = both.withColumn("s", dedup.similarity("x", "y"))
    want = sorted((r[0], r[1], round(r.s, 6)) for r in every.where(F.col("s") >= threshold - 1e-9).select("x.listing_key", "y.listing_key", "s").collect())
    assert got == want and len(want) > 20
    if threshold >= 0.85:
        assert dedup.candidates(data, threshold).count() < 0.5 * every.count()
    data.unpersist()


def test_fuzzy_candidates_on_the_given_listings(spark):
    from hearth.plans.dedup import scored

    rows = scored(spark, "/root/testdata/sf0.01")
    blocks = rows.groupBy(dedup.loose_key().alias("b")).count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    assert dedup.candidates(rows).count() < 0.02 * blocks
