"""Flush by source, sketches against exact ranks, folds by day, variant documents."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from hearth.functions import documents
from hearth.operators import folds, models, sketches
from hearth.streaming import flush


def test_every_flush_trigger_fires_once(spark, tmp_path):
    """A hot source reaches its rows, a source of large rows its bytes, a quiet one its time; each once, over three micro-batches."""
    at = lambda s: datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC) + datetime.timedelta(seconds=s)
    shape = "source string, size long, at timestamp"
    batches = [[("hot", 1, at(i)) for i in range(60)] + [("large", 400, at(1)), ("quiet", 5, at(2)), (None, 1, at(3))], [("hot", 1, at(70 + i)) for i in range(50)] + [("large", 700, at(71))], [("late", 1, at(5000))]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, shape).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    found = flush.flushes(stream, "source", "size", "at", 100, 1000, 600)
    query = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r.source, r.number, r.reason, r.n, r.bytes) for r in spark.read.schema(flush.FLUSHES).parquet(str(tmp_path / "out")).collect())
    # What the hot source holds beyond its first hundred rows is flushed by time when the stream has moved on, like the null source.
    assert got == [("", 0, "time", 1, 1), ("hot", 0, "rows", 100, 100), ("hot", 1, "time", 10, 10), ("large", 0, "bytes", 2, 1100), ("quiet", 0, "time", 1, 5)]


def test_merged_sketches_stay_within_their_rank_error(spark):
    rng = random.Random(8)
    rows = [(datetime.date(2024, 1, 1 + i % 20), v) for i, v in enumerate([rng.lognormvariate(0, 2) for _ in range(20_000)] + [float("inf"), float("-inf"), float("nan"), None] * 20)]
    daily = sketches.daily(spark.createDataFrame(rows, "day date, v double"), "day", "v")
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["last"]: r for r in sketches.quantiles(sketches.windows(daily, 7), shares).collect()}
    assert len(got) == 20
    for last, r in got.items():
        held = sorted(v for d, v in rows if v is not None and v == v and 0 <= (last - d).days < 7)
        assert r.n == len(held)
        for i, s in enumerate(shares):
            v = r[f"q{i}"]
            low, high = sum(x < v for x in held) / len(held), sum(x <= v for x in held) / len(held)
            assert low - 2 * sketches.RANK_ERROR <= s <= high + 2 * sketches.RANK_ERROR


def test_no_row_is_predicted_by_a_model_that_saw_its_day(spark):
    rows = spark.range(600).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + F.col("id") % 3).alias("log_price"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 10).cast("int")).alias("day"))
    starts = folds.origins(rows, "day", 3)
    parts = folds.folded(rows, "day", starts).groupBy("fold", "part").agg(F.min("day").alias("a"), F.max("day").alias("b"), F.count("*").alias("n")).collect()
    by = {(r.fold, r.part): r for r in parts}
    assert set(by) == {(i, p) for i in range(3) for p in ("train", "test")}
    assert all(by[i, "train"].b < by[i, "test"].a for i in range(3)) and all(by[i, "test"].b < by[i + 1, "test"].a for i in range(2))
    assert sum(by[i, "test"].n for i in range(3)) + by[0, "train"].n == 600
    base = {"x": models.linear(["x"], [])}
    found = folds.stacked(folds.out_of_fold(rows, "day", base, starts), "log_price", ["x"], 3)
    assert found.count() == by[2, "test"].n
    assert found.agg(F.max(F.abs(F.col("predicted_stack") - F.col("log_price")))).first()[0] < 60
    assert folds.origins(rows.limit(0), "day", 3) == []


def test_malformed_documents_are_set_apart(spark):
    texts = ['{"list_id": 7, "price": 5, "subject": "a", "toilets": 2, "list_time": 1747699200123}', '{"list_id": 8, "price_string": "5 tỷ", "price": 6', None, "", "[]", '{"price_string": "", "price": "9", "rooms": {"n": 1}}']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, doc string")
    good, bad = documents.split_malformed(rows, "doc")
    assert sorted(r.i for r in bad.collect()) == [1, 3] and bad.columns == ["i", "doc"]
    record = documents.advertisement_record(F.col("document"))
    got = {r.i: r for r in good.select("i", *[c.alias(n) for n, c in record.items()]).collect()}
    assert (got[0].listing, got[0].price, got[0].bathroom, got[0].posted, got[0].url) == ("7", "5", "2", 1747699200, "https://ads.example/7.htm")
    assert got[5].price == "9" and got[2].title is None and got[4].listing is None
    assert json.loads(texts[0])["list_id"] == 7


@pytest.mark.parametrize("name", ["daily_sketches", "stacked_models"])
def test_queries_without_sql_run(spark, name):
    from hearth.plans import registry

    rows = registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert rows
    if name == "daily_sketches":
        assert all(r.q0 <= r.q1 <= r.q2 for r in rows)
    else:
        assert rows[0].rmse_stack < 1.5 * min(rows[0].rmse_all, rows[0].rmse_numbers)
