"""What must hold on larger and odder tables: references cut off in pages, sums beyond 2^53, copies of listings."""

import random
import time
from datetime import datetime

from pyspark.sql import functions as F

from hearth.functions import markup
from hearth.functions.markup import Field
from hearth.operators import dedup, models, search, stats
from hearth.plans import dedup as dedup_plans
from hearth.plans import registry
from hearth.sources import adapters, buckets, tables


def test_markup_reads_references_with_their_semicolon_only():
    page = '<title>a&amp;b &#x27;c&#39; &lt;d&gt; &amp;lt; &notit; and&amp</title><a href="/?a=1&copy=2&amp;b=3">x</a>'
    assert markup.read(page, [Field("t", "title"), Field("l", "a", "href")]) == [{"t": ["a&b 'c' <d> &lt; &notit; and&amp"], "l": ["/?a=1&copy=2&b=3"]}]


def test_whole_sums_do_not_depend_on_the_order_of_rows(spark):
    """One large number and many small ones, in either order: by doubles the small ones are lost after the large one."""
    small = spark.range(4000).select("id", F.lit(1.0).alias("v"))
    for place in (-1, 4000):
        rows = small.unionByName(spark.range(1).select(F.lit(place).cast("long").alias("id"), F.lit(2.0**54).alias("v"))).coalesce(1).sortWithinPartitions("id")
        assert rows.agg(stats.whole_sum("v")).first()[0] == 2**54 + 4000


LISTING = "listing_key string, province string, district string, ward string, street string, price double, area double, bedroom int, latitude double, longitude double, score int, processing_timestamp timestamp"


def test_copies_of_listings_add_no_links_and_lose_no_duplicate(spark):
    """Copies with other keys and spots are one profile, and what stays is what all pairs of a block leave, also where a short distance decides."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        base = ("p", "d", "w", rng.choice(["lo duc", "lo duc b", "hang bai"]), rng.choice([2e9, 2.05e9]), rng.choice([50.0, 57.0]), rng.choice([2, 3, None]))
        for _ in range(rng.randint(1, 5)):
            rows.append((f"k{len(rows):03}", *base, 10.0 + rng.choice([0.0, 0.0005, 0.003, 0.008, 0.1, 3.0]), rng.choice([106.0, 106.0005, -179.9999, 179.9999, None]), rng.randint(1, 4), datetime(2024, 1, rng.randint(1, 3))))
    data = spark.createDataFrame(rows, LISTING).cache()
    keyed = data.withColumn("block", dedup.loose_key())
    pairs = keyed.alias("x").join(keyed.alias("y"), "block").where("x.listing_key < y.listing_key").withColumn("s", dedup.similarity("x", "y"))
    blocked = pairs.where(F.col("s") >= dedup.THRESHOLD - 1e-9).select("x.*", F.col("y.listing_key").alias("peer"), F.col("y.score").alias("s2"), F.col("y.processing_timestamp").alias("t2")).collect()
    lost = {r.peer if (r.score, r.processing_timestamp) >= (r.s2, r.t2) else r.listing_key for r in blocked}
    got = {r.listing_key for r in dedup.without_fuzzy(data).select("listing_key").collect()}
    assert got == {r[0] for r in rows} - lost and len(lost) > 20
    profiles = lambda d: dedup.addressed(d).groupBy("profile").agg(*[F.any_value(c).alias(c) for c in dedup.PROFILE])
    more = data.crossJoin(spark.range(3).select(F.col("id").alias("copy"))).withColumn("listing_key", F.concat("listing_key", F.col("copy").cast("string"))).drop("copy")
    assert dedup.links(profiles(more), dedup.THRESHOLD).count() == dedup.links(profiles(data), dedup.THRESHOLD).count()
    data.unpersist()


def test_the_sides_of_a_words_join_are_dealt_out_once(spark):
    """Each listing is filed under its first words only, and both sides read one exchange."""
    rows = dedup_plans.scored(spark, "/root/testdata/sf0.01")
    placed = rows.select("listing_key", "price", "area", "bedroom", dedup.loose_key().alias("block"), dedup.address().alias("address"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = dedup.filed_pairs(placed, ["listing_key", "price", "area", "bedroom"], dedup.THRESHOLD)
        pairs = parts[0].select("x.listing_key", F.col("y.listing_key").alias("peer"), "x.address", F.col("y.address").alias("other"), "x.price", F.col("y.price").alias("p2"), "x.area", F.col("y.area").alias("a2"))
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan.split("Generate")[-1] or plan.count("Generate explode") == 1


def test_a_place_is_searched_for_contained_addresses_once_for_each_address(spark):
    rows = [("p", "ba dinh ha noi"), ("p", "12 ba dinh ha noi"), ("p", "ha noi"), ("q", "3 ba dinh ha noi"), ("p", "a dinh ha n")]
    data = spark.createDataFrame(rows * 50, "place string, address string")
    got = {tuple(r) for r in dedup.contained(data).collect()}
    assert got == {("p", a, b) for x, a in rows for y, b in rows if x == y == "p" and a != b and a in b} and dedup.contained(data).count() == len(got)


def test_stored_rows_leave_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    made = tables.stored(spark.range(1000).repartition(7, "id"))
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert files() <= before and made.count() == 1000


def test_only_the_best_of_copies_is_looked_at_again(spark, monkeypatch):
    """Copies that are alike enough without their spots are not dealt out: what may stay has one row of them."""
    rows = [(f"k{i:03}", "p", "d", "w", "lo duc", 2e9, 50.0, 2, 10.0 + i, 106.0, i % 7, datetime(2024, 1, 1)) for i in range(70)]
    rows += [("m1", None, None, None, None, 2e9, 50.0, 2, 10.0, 106.0, 1, datetime(2024, 1, 1)), ("m2", "p", "d", "w", "cau giay", 2e9, 90.0, None, 10.0, 107.0, 1, None)]
    written = []
    keep = tables.stored
    monkeypatch.setattr(tables, "stored", lambda rows: written.append(keep(rows)) or written[-1])
    data = spark.createDataFrame(rows, LISTING)
    got = dedup.without_fuzzy(data, keep=["score", "listing_key"])
    assert {tuple(r) for r in got.collect()} == {(6, "k006"), (1, "m1"), (1, "m2")} and got.columns == ["score", "listing_key"]
    assert all(len(w.columns) <= 14 for w in written)
    spots = [w for w in written if "beat" in w.columns and "latitude" in w.columns]
    assert len(spots) == 1 and spots[0].count() == 1  # before: rows of all spots were joined


SF = "/root/testdata/sf0.001"


def _plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_a_price_band_reaches_the_lines(spark):
    """The lines are put together once and cut by the anchor's band before the joins (before: twice, in full)."""
    plan = _plan(registry.QUERIES["similar"](spark, SF))
    assert plan.count("Relation [l_orderkey") == 1
    assert "l_extendedprice" in plan.split("Relation [l_orderkey")[0].split("Filter")[-1]


def test_the_district_of_an_anchor_reaches_the_suppliers(spark):
    plan = _plan(registry.QUERIES["recommend"](spark, SF))
    assert plan.count("Relation [l_orderkey") == 1
    assert "s_nationkey" in plan.split("Relation [s_suppkey")[0].split("Filter")[-1].split("=", 1)[0]


def test_compared_keys_reach_the_lines(spark):
    plan = _plan(registry.QUERIES["id_in_compare"](spark, SF))
    assert plan.count("Relation [l_orderkey") == 1
    assert "concat_ws" in plan.split("Relation [l_orderkey")[0].split("Filter")[-1]


def test_leading_listings_pass_over_lines_without_their_sides(spark, tmp_path):
    """Lines of the least keys that have no part are no listings; where they are all that is looked at, all lines are."""
    for t in ("supplier", "nation", "region", "orders", "part"):
        adapters.table(spark, SF, t).write.parquet(f"{tmp_path}/{t}.parquet")
    lines = adapters.table(spark, SF, "lineitem")
    least = lines.orderBy(adapters.listing_key()).limit(7)
    lines.unionByName(least.withColumns({"l_orderkey": F.lit(0).cast("long"), "l_partkey": -F.col("l_partkey")})).write.parquet(f"{tmp_path}/lineitem.parquet")
    want = [r[0] for r in adapters.listings(spark, SF).select("listing_key").orderBy("listing_key").limit(4).collect()]
    for sought in (3, 9, 1000):
        found = adapters.leading_listings(spark, str(tmp_path), 4, sought).select("listing_key").distinct().orderBy("listing_key").limit(4)
        assert [r[0] for r in found.collect()] == want
    none = adapters.listings(spark, SF).limit(0)
    assert search.similar(none, none).count() == search.recommended(none, none).count() == 0


def test_lines_are_dealt_out_before_names_are_joined(spark):
    plan = _plan(adapters.listings(spark, SF))
    assert plan.index("= n_nationkey") < plan.index("= p_partkey") < plan.index("= o_orderkey") < plan.index("= s_suppkey")


def test_exact_duplicates_are_dealt_out_by_bytes(spark):
    rows = dedup_plans.fingerprinted(spark, SF)
    assert [t for _, t in rows.dtypes] == ["binary", "string", "int", "timestamp_ntz", "int"]
    assert "windowspecdefinition(key#" in _plan(registry.QUERIES["dedup_exact"](spark, SF))


def test_both_sightings_of_a_listing_come_from_one_row(spark):
    assert _plan(registry.QUERIES["dedup_recrawled"](spark, SF)).count("Relation [l_orderkey") == 1


def test_training_rows_are_dealt_over_all_cores_in_a_fixed_order(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k")).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    parts = models.dealt(rows, 1000, "k").rdd.glom().collect()
    assert len(parts) == cores and all(parts) and sorted(r.k for p in parts for r in p) == sorted(map(str, range(1000)))
    assert models.dealt(rows.repartition(3), 1000, "k").rdd.glom().collect() == parts
    assert models.dealt(rows, cores * models.TASK_ROWS + 1, "k").rdd.getNumPartitions() == 2 * cores


def test_sides_are_stored_once_and_listings_grouped_where_the_joins_dealt_them(spark, monkeypatch):
    """One row of an id in both sides together, ids as bytes; the choice among lines of one key needs no exchange of its own."""
    seen = []
    monkeypatch.setattr(dedup_plans, "stored", lambda rows: seen.append(rows) or rows)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5k")
    try:
        new, old = dedup_plans.sides(spark, SF)
        plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(seen) == 1 and dict(new.dtypes)["id"] == dict(old.dtypes)["id"] == "binary"
    assert "hashpartitioning(id" not in plan and "hashpartitioning(l_orderkey#" in plan and ", l_linenumber#" not in "".join(x for x in plan.split("\n") if "hashpartitioning" in x)
    both = new.unionByName(old)
    assert both.count() == both.select("id").distinct().count() == adapters.listings(spark, SF).select("id").distinct().count()


def test_a_load_deals_out_each_side_once(spark, tmp_path, monkeypatch):
    """Old and new rows meet by bucket, as they are written, and no shuffle files stay."""
    path = f"{tmp_path}/t"
    buckets.create(spark.range(300).select("id", F.lit(1).alias("v")), path, ["id"], 8)
    plans = []
    write = buckets._write
    monkeypatch.setattr(buckets, "_write", lambda rows, *a: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or write(rows, *a))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = buckets.merge_into(spark, path, spark.range(200, 500).select("id", F.lit(2).alias("v")), ["id"], buckets=8)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts == {"inserted": 200, "updated": 100, "skipped": 0, "kept": 200}
    assert plans[0].count("Exchange") == 2 and len(buckets.files(spark, path, 8)) == 8
    assert {tuple(r) for r in buckets.read(spark, path, 8).groupBy("v").count().collect()} == {(1, 200), (2, 300)}
    assert spark.conf.get(buckets.BY_ALL_KEYS) == "true"


def test_the_counts_of_a_forest_leave_room_on_an_executor(spark):
    """Four tasks of 1 GB each filled an executor (before)."""
    assert 4 * models.forest(["x"]).getStages()[-1].getMaxMemoryInMB() <= 1024
