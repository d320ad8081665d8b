"""Paths, tolerant readers, settings, retries and the session's helpers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearth import session
from hearth.config import ModelConfig
from hearth.operators import features, models, quantiles
from hearth.sources import paths, tables
from hearth.streaming import ingest


def test_paths(spark, tmp_path):
    root = str(tmp_path / "a")
    paths.make(spark, root)
    spark.range(3).write.json(f"{root}/x.json")
    spark.range(2).write.json(f"{root}/y.json")
    assert paths.exists(spark, root) and not paths.exists(spark, root + "b")
    assert [p.rsplit("/", 1)[-1] for p, _, _ in paths.listed(spark, f"{root}/*.json")] == ["x.json", "y.json"]
    assert paths.newest(spark, f"{root}/*.json").endswith("y.json") and paths.newest(spark, f"{root}/*.csv") is None
    assert tables.read_any(spark, f"{root}/x.json").count() == 3
    with pytest.raises(ValueError):
        tables.read_any(spark, f"{root}/x.txt")
    assert paths.delete(spark, root) and not paths.exists(spark, root)


def test_tolerant_readers(spark, tmp_path):
    schema = StructType.fromDDL("id long")
    spark.range(4).write.parquet(str(tmp_path / "unified_a.parquet"))
    assert tables.read_present(spark, [str(tmp_path / "unified_*.parquet"), str(tmp_path / "none*")], schema).count() == 4
    assert tables.read_present(spark, [str(tmp_path / "none*")], schema).count() == 0
    (tmp_path / "d.csv").write_text("name,density\na,1.5\nb,many\n")
    assert [tuple(r) for r in tables.read_numbers(spark, str(tmp_path / "c.csv"), str(tmp_path / "d.csv"), ["density"]).collect()] == [("a", 1.5), ("b", None)]
    with pytest.warns(UserWarning):
        assert tables.read_window(spark, "jdbc:none:x", "t", 3, "2024-01-01", 5, {}, schema).count() == 0
    with pytest.raises(ValueError):
        tables.read_window(spark, "jdbc:none:x", "t; drop table t", 3, "2024-01-01", 5, {}, schema)


def test_settings():
    c = ModelConfig.load({"HEARTH_TRAIN_SHARE": "0.7", "HEARTH_MODELS": "forest, linear", "OTHER": "x"}, trees=50)
    assert (c.train_share, c.models, c.trees, c.depth) == (0.7, ("forest", "linear"), 50, 15)
    assert ModelConfig.from_json(c.to_json()) == c
    for bad in ({"train_share": 1.5}, {"outlier_method": "x"}, {"trees": 0}, {"models": ()}):
        with pytest.raises(ValueError):
            ModelConfig.load({}, **bad)


def test_retries():
    tries = []

    def write(batch, number):
        tries.append(number)
        if len(tries) < 3:
            raise OSError("busy")

    ingest.retried(write, wait=0)(None, 7)
    assert tries == [7, 7, 7]
    with pytest.raises(OSError):
        ingest.retried(lambda b, n: (_ for _ in ()).throw(OSError("down")), attempts=2, wait=0)(None, 1)


def test_a_stream_stops_when_it_is_idle(spark, tmp_path):
    spark.range(5).write.json(str(tmp_path / "in"))
    rows = ingest.read_bounded(spark, str(tmp_path / "in"), StructType.fromDDL("id long"))
    query = rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).start()
    ingest.until_idle(query, 2.0, 0.2)
    assert not query.isActive and spark.read.schema("id long").parquet(str(tmp_path / "out")).count() == 5


def test_session_helpers(spark):
    said = []
    with session.timed(spark, "count", said.append):
        spark.range(3).count()
    assert said[0].startswith("count: ")
    assert session.set_options(spark, {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "1g"}) == {"spark.driver.memory": "1g"}
    assert session.chosen(skip=["load"]) == ["bronze", "silver", "gold"] and session.chosen(only=["gold"]) == ["gold"]
    with pytest.raises(ValueError):
        session.chosen(only=["x"])
    cached = spark.range(3).cache()
    session.release(spark, cached)
    assert not cached.is_cached


def test_exact_quantiles(spark):
    values = [float((i * 7919) % 10_007) ** 3 for i in range(30_000)] + [1e15, -5.0, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    shares = [0.0, 0.25, 0.5, 0.9, 0.95, 1.0]
    want = rows.agg(*[F.percentile("v", F.lit(s)) for s in shares]).first()
    assert quantiles.exact(rows, "v", shares) == pytest.approx(list(want))
    assert quantiles.exact(rows.where("v < -10"), "v", shares) == [None] * 6
    assert quantiles.exact(rows.select(F.lit(3).alias("v")), "v", [0.3]) == [3.0]


def test_feature_check_and_registry(spark, tmp_path):
    with pytest.raises(ValueError, match="missing features"):
        features.stored(spark.range(1))
    whole = spark.range(1).select("id", *[F.lit(1.0).alias(c) for c in features.STORED], F.lit(1).alias("more"))
    assert features.stored(whole).columns == [*features.STORED, "id"]
    path = str(tmp_path / "registry")
    models.register(spark, path, "a", {"r2": 0.8, "rmse": 2.0}, "p/a", "2024-01-02")
    models.register(spark, path, "b", {"r2": 0.7, "rmse": 3.0}, "p/b", "2024-01-05")
    entries = models.registered(spark, path)
    assert models.best_registered(entries).first()["model"] == "a" and models.latest_registered(entries).first()["path"] == "p/b"
    with pytest.raises(LookupError):
        models.load_one(entries.where("model = 'c'"))


def test_models_predict_together(spark):
    rows = spark.createDataFrame([(float(i), 3.0 * i + 1) for i in range(50)], "x double, price double")
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    fitted = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"), LinearRegression(featuresCol="f", labelCol="price")]).fit(rows)
    got = models.predict_all(rows, {"one": fitted, "two": fitted}).where("x = 10").first()
    assert got["voices"] == 2 and got["predicted_mean"] == pytest.approx(31.0, abs=1e-3) == pytest.approx(got["predicted_one"], abs=1e-3)
