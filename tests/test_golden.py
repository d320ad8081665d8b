"""Hand-derived rows of the parsing, scoring, distance and duplicate rules."""

import pytest
from pyspark.sql import functions as F

from hearth.functions import geo, parse, quality
from hearth.operators import clean, conform, dedup, merge, models, search
from hearth.sources import tables
from hearth.streaming import ingest


def one(spark, schema, row, *columns):
    return tuple(spark.createDataFrame([row], schema).select(*columns).first())


@pytest.mark.parametrize(
    ("text", "value"),
    [("5,2 tỷ", 5.2e9), ("850 triệu", 8.5e8), ("1.250 triệu", 1.25e9), ("2.5 tỷ", 2.5e10), ("Thỏa thuận", None), ("1500000000", 1.5e9), ("", None), (None, None)],
)
def test_price(spark, text, value):
    assert one(spark, "t string", (text,), parse.unit_price(F.col("t")))[0] == value


@pytest.mark.parametrize(("text", "value"), [("60 m²", 60.0), ("1.200,5 m²", 1200.5), ("60 m2", 60.0), ("", None), ("abc", None)])
def test_area(spark, text, value):
    assert one(spark, "t string", (text,), parse.local_number(F.col("t")))[0] == value


def test_swapped_price_fields(spark):
    price, per = parse.unswapped(F.col("p"), F.col("m"))
    assert one(spark, "p string, m string", ("35 triệu/m²", "2,1 tỷ"), parse.unit_price(price), parse.unit_price(per)) == (2.1e9, 3.5e7)


def test_invalid_units(spark):
    rows = spark.createDataFrame([("900 nghìn",), ("500k",), ("5 tỷ",), (None,)], "t string")
    assert [r[0] for r in rows.select(parse.invalid_unit(F.col("t"))).collect()] == [True, True, False, False]


@pytest.mark.parametrize(("text", "want"), [("Đông", ("Đông", 1)), ("Đông - Nam", ("Đông Nam", 6)), ("tây bắc", ("Tây Bắc", 7)), ("", ("unknown", -1)), (None, ("unknown", -1))])
def test_direction(spark, text, want):
    assert one(spark, "t string", (text,), *parse.direction(F.col("t"))) == want


@pytest.mark.parametrize(("text", "code"), [("Sổ đỏ/ Sổ hồng", 1), ("SHR", 1), ("Chưa có sổ", 1), ("Đang chờ sổ", 2), ("Không pháp lý", 4), ("Hợp đồng mua bán", 5), (None, -1)])
def test_legal(spark, text, code):
    assert one(spark, "t string", (text,), parse.legal_status(F.col("t"))[1])[0] == code


@pytest.mark.parametrize(("text", "code"), [("Nội thất cao cấp", 1), ("Không nội thất", 4), ("Cơ bản", 3), ("Full nội thất", 2), ("abc", 2), ("k", -1), ("", -1), (None, -1)])
def test_interior(spark, text, code):
    assert one(spark, "t string", (text,), parse.interior(F.col("t"))[1])[0] == code


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Đường Lê Lợi, Phường Bến Thành, Quận 1, Hồ Chí Minh", ("hồ chí minh", "1", "bến thành", "lê lợi")),
        ("Phường 1 (Quận 2 cũ), Thủ Đức, TP. Hồ Chí Minh", ("hồ chí minh", "2", "1", "unknown")),
        ("Hẻm 136/10 Đường X, Xã Y, Huyện Z, Tỉnh Bình Dương", ("bình dương", "z", "y", "x")),
        ("Hà Nội", ("hà nội", "unknown", "unknown", "hà nội")),
        (None, ("unknown",) * 4),
    ],
)
def test_address(spark, text, want):
    parts = parse.address_parts(F.col("t"))
    assert one(spark, "t string", (text,), *[parse.address_key(parts[k], k) for k in ("province", "district", "ward", "street")]) == want


def test_scores(spark):
    rows = [(1.0, 1.0, 1, 1, "somewhere", 10.0, 106.0), (None, 1.0, 1, 1, "somewhere", 10.0, 106.0), (1.0, 1.0, None, None, "somewhere", None, None), (None,) * 7]
    df = spark.createDataFrame(rows, "p double, a double, b int, t int, l string, y double, x double")
    flags = quality.flags(*[F.col(c) for c in "pabtlyx"])
    got = df.select(quality.score(flags).alias("s"), quality.level(quality.score(flags)).alias("v"), quality.issue(flags).alias("i")).collect()
    assert [tuple(r) for r in got] == [(100, "PREMIUM", "NO_ISSUES"), (80, "HIGH", "MISSING_PRICE"), (55, "FAIR", "PARTIAL_DATA"), (0, "LOW", "MISSING_PRICE")]


def test_haversine(spark):
    c = [F.col(x) for x in "abcd"]
    assert one(spark, "a double, b double, c double, d double", (10.762622, 106.660172, 10.7769, 106.7009), geo.haversine(*c))[0] == pytest.approx(4723.77, abs=0.01)


LISTING = "listing_key string, province string, district string, ward string, street string, price double, area double, bedroom int, latitude double, longitude double, score int, processing_timestamp timestamp_ntz"


@pytest.mark.parametrize(
    ("price", "area", "bedroom", "lat", "want"),
    [(5.2e9, 60.0, 3, 10.0, 1.0), (5.2e9 / 0.92, 60.0, 3, None, 0.85), (5.2e9, 60.0, 2, 10.0, 0.85), (5.2e9 / 0.85, 60.0, 3, 10.0, 0.875), (5.2e9 / 0.85, 60.0, 3, None, 0.775)],
)
def test_similarity(spark, price, area, bedroom, lat, want):
    from datetime import datetime

    base = ("a", "p", "d", "w", "s", 5.2e9, 60.0, 3, 10.0, 106.0, 90, datetime(2024, 1, 1))
    other = ("b", "p", "d", "w", "s", price, area, bedroom, lat, 106.0, 90, datetime(2024, 1, 2))
    x, y = (spark.createDataFrame([r], LISTING) for r in (base, other))
    assert x.alias("x").crossJoin(y.alias("y")).select(dedup.similarity("x", "y")).first()[0] == pytest.approx(want)


def test_fuzzy_survivor_is_the_newer_of_equal_scores(spark):
    from datetime import datetime

    rows = [(k, "p", "d", "w", "s", 5.2e9, 60.0, 3, 10.0, 106.0, 90, datetime(2024, 1, d)) for k, d in (("a", 1), ("b", 2), ("c", 1))]
    assert [r.listing_key for r in dedup.without_fuzzy(spark.createDataFrame(rows, LISTING)).collect()] == ["b"]


@pytest.mark.parametrize(
    ("new", "old", "same", "newer", "want"),
    [(90, 70, False, True, "USE_NEW"), (70, 90, False, True, "SKIP_NEW"), (80, 75, False, False, "USE_NEW"), (80, 80, True, True, "USE_NEW"), (80, 80, True, False, "SKIP_NEW")],
)
def test_conflict_rules(spark, new, old, same, newer, want):
    row = (new, old, "a", "a" if same else "b", 2 if newer else 1, 1)
    schema = "new_score int, existing_score int, new_source string, existing_source string, new_processing_timestamp int, existing_processing_timestamp int"
    assert one(spark, schema, row, dedup.resolution())[0] == want


def test_upsert_needs_a_better_row(spark):
    schema = "id string, score int, processing_timestamp int"
    t = spark.createDataFrame([("a", 80, 1), ("b", 80, 1), ("c", 80, 1), ("d", 80, None)], schema)
    s = spark.createDataFrame([("a", 90, 0), ("b", 80, 2), ("c", 80, 1), ("d", 80, 2), ("e", 10, 1)], schema)
    got = {r.id: (r.score, r.processing_timestamp) for r in merge.upsert(t, s).collect()}
    assert got == {"a": (90, 0), "b": (80, 2), "c": (80, 1), "d": (80, None), "e": (10, 1)}
    assert {r.action: r.n for r in merge.upsert_counts(t, s).collect()} == {"inserted": 1, "updated": 2, "skipped": 2}


def test_conform_adds_and_drops(spark):
    from pyspark.sql.types import StructType

    out = conform.conform(spark.createDataFrame([(1, "x")], "a int, extra string"), StructType.fromDDL("b string, a long"))
    assert out.dtypes == [("b", "string"), ("a", "bigint")] and tuple(out.first()) == (None, 1)
    with pytest.raises(ValueError):
        conform.require(out, ["missing"])


def test_search_guards(spark):
    with pytest.raises(ValueError):
        search.search(spark.range(1).toDF("price"), search.SearchFilter(), sort_by="1; drop")
    assert search.like("50%_") == r"%50\%\_%"


def test_checked_filter(spark):
    rows = spark.range(5)
    with pytest.raises(ValueError):
        clean.checked(rows, F.col("id") > 9)
    with pytest.warns(UserWarning):
        clean.checked(rows, F.col("id") == 1, least=0.5)


def test_balance_reads_every_listing(spark):
    from hearth.plans import registry
    from hearth.sources.adapters import listings

    sf = "/root/testdata/sf0.001"
    sizes = sorted(((r["count"], r.province) for r in listings(spark, sf).groupBy("province").count().collect()), key=lambda x: (-x[0], x[1]))
    most = int(sizes[1][0] * 1.2)
    want = {p: min(n, most) if k == 0 else n for k, (n, p) in enumerate(sizes)}
    assert {r.province: r.n for r in registry.QUERIES["balance"](spark, sf).collect()} == want


def test_raw_reader_turns_empty_text_to_null(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"price": "", "title": " x ", "zzz": 1}\n')
    rows = tables.read_raw(spark, str(tmp_path), tables.RAW_A)
    assert len(rows.columns) == 22 and rows.select("price", "title").first() == (None, "x")
    assert len(tables.strings(tables.RAW_B).fields) == 24


def test_hierarchy_has_four_relations(spark):
    schema = "id string, name string, districts array<struct<id:string,name:string,wards:array<struct<id:string,name:string,prefix:string>>,streets:array<struct<id:string,name:string,prefix:string>>>>"
    nested = spark.createDataFrame([("1", "P", [("2", "D", [("3", "W", "Phường")], [("4", "S", "Đường")])])], schema)
    found = tables.hierarchy(nested)
    assert {k: v.count() for k, v in found.items()} == dict.fromkeys(("provinces", "districts", "wards", "streets"), 2)


def test_days_and_sizes(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "date_add(date'2024-01-01', cast(id % 5 as int)) as dt")
    tables.write_days(rows, str(tmp_path / "d"))
    assert tables.read_days(spark, str(tmp_path / "d"), "2024-01-03", 2).count() == 40
    assert tables.read_latest(spark, str(tmp_path / "d"), "2024-03-01").select("dt").distinct().count() == 1
    tables.write_sized(rows, str(tmp_path / "s"), rows_per_file=30)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100
    tables.write_sized(rows, str(tmp_path / "c"), "csv")
    assert tables.read_files(spark, str(tmp_path / "c"), "csv", "*.csv").count() >= 99


def test_store_days_writes_every_day(spark):
    from hearth.plans import registry
    from hearth.sources.adapters import listings

    sf, written = "/root/testdata/sf0.001", []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "write_days", lambda rows, path, f=tables.write_days: (written.append(path), f(rows, path)))
        registry.QUERIES["store_days"](spark, sf)
    stored = spark.read.parquet(written[0])
    posted = listings(spark, sf).select(F.to_date("posted_date").alias("day"))
    count = lambda rows, day: {r[0]: r[1] for r in rows.groupBy(F.col(day).cast("date")).count().collect()}
    assert count(stored, "dt") == count(posted, "day")
    ones = stored.where("price = 1").select(F.date_format(F.col("dt"), "yyyy-MM")).distinct().collect()
    assert [r[0] for r in ones] == ["1996-03"]


def test_trained_models_are_whole(spark, monkeypatch):
    from hearth.plans import streams

    monkeypatch.setattr(streams, "_evaluated", lambda spark, sf, pipeline, *a: pipeline.getStages()[-1])
    forest, trees = (streams.PLANS[n][0](spark, "") for n in ("train_forest", "train_boosted"))
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (200, 15)
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize()) == (200, 6, 0.05)


def test_stream_drops_seen_keys(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-01"), (2, "2024-01-02")], "k int, d string").withColumn("t", F.to_timestamp("d"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = ingest.once_per_key(ingest.read_parquet(spark, str(tmp_path / "in")), ["k"], "t", "10 days")
    assert ingest.run_once(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["d"]).count() == 2


def test_model_registry(spark, tmp_path):
    models.register(spark, str(tmp_path / "r"), "m", {"r2": 0.9, "rmse": 10}, "p", "2024-01-01")
    models.register(spark, str(tmp_path / "r"), "n", {"r2": 0.8, "rmse": 10}, "p", "2024-01-02")
    rows = spark.read.json(str(tmp_path / "r"))
    assert models.best_model(rows).first()[0] == "m" and rows.first().rmse_limit == pytest.approx(11)
