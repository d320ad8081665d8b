"""Settings that act, models stored and loaded by day, single and whole predictions, quantiles by group, searches over folds."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from hearth.config import ModelConfig
from hearth.operators import clean, dedup, features, folds, models, quantiles, serving, stats

ROW = "listing_key string, province string, province_id int, district_id int, price double, price_per_m2 double, area double, latitude double, longitude double, bedroom int, bathroom int, floor_count int, house_type string, population_density double, posted_date timestamp, prediction string"


def made(n=900, seed=1):
    rng, first = random.Random(seed), datetime.datetime(2023, 1, 1)
    out = []
    for i in range(n):
        area = rng.uniform(30, 200)
        price = area * 5e7 + rng.uniform(-1e8, 1e8)
        out.append((f"k{i}", "ab"[i % 2], 1 + i % 3, i % 7, price, price / area, area, 10.0, 106.0, 1 + i % 4, 1 + i % 3, 1 + i % 5, "villa" if i % 2 else "flat", 100.0, first + datetime.timedelta(days=i), "mine"))
    return out


def config(**given):
    return ModelConfig(**{"models": ("area", "linear", "total_rooms"), "outlier_method": "none", "least_rows": 100, "balance_cap": 1e9, "ensemble_size": 2} | given).checked()


@pytest.fixture(scope="module")
def rows(spark):
    return features.rooms(spark.createDataFrame(made(), ROW))


@pytest.fixture(scope="module")
def store(rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    for day in ("2025-01-31", "2025-05-31"):
        serving.train_day(rows, config(), path, day)
    return path


def test_settings_reach_the_models(rows):
    grown = serving.built(config(models=("forest", "boosted"), trees=7, depth=3, step=0.2, seed=5))
    forest, boosted = (grown[n].getStages()[-1] for n in ("forest", "boosted"))
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (7, 3, 5) and (boosted.getMaxIter(), boosted.getStepSize()) == (7, 0.2)
    with pytest.raises(ValueError, match="unknown models: oracle"):
        serving.built(config(models=("oracle",)))
    train, test = serving.parts(rows, config(train_months=2, test_months=1), "2024-03-31")
    days = lambda r: r.agg(F.min(F.to_date("posted_date")).cast("string"), F.max(F.to_date("posted_date")).cast("string")).first()
    assert tuple(days(train)) == ("2024-01-01", "2024-02-29") and tuple(days(test)) == ("2024-03-01", "2024-03-31")
    odd = rows.withColumn("price_per_m2", F.when(F.col("listing_key") == "k370", 1e12).otherwise(F.col("price_per_m2")))
    lost = [serving.parts(odd, config(outlier_method=m), "2024-12-31")[0].where("listing_key = 'k370'").count() for m in ("none", "iqr", "zscore")]
    assert lost == [1, 0, 0]
    with pytest.raises(ValueError, match="are needed"):
        serving.train_day(rows, config(least_rows=10_000), "/tmp/unused-store", "2024-12-31")


def test_models_are_loaded_by_day(spark, store):
    service = serving.Service(spark, store, config())
    assert service.load("2025-02-10").day == "2025-01-31" and service.load("2025-04-01").day == "2025-01-31" and service.load("2025-04-02").day == "2025-05-31"
    assert service.load().day == "2025-05-31" and not service.reload()
    assert service.load("2025-02-01").reload() and service.day == "2025-05-31"
    with pytest.raises(LookupError):
        service.load("2020-01-01")
    about = service.about()
    assert set(about["models"]) == {"area", "linear", "total_rooms"} and len(about["ensemble"]) == 2 and "total_rooms" not in about["ensemble"]
    with pytest.raises(LookupError):
        service.predict(spark.range(1), "oracle")


def test_every_row_gets_an_answer(spark, rows, store):
    service = serving.Service(spark, store, config()).load()
    odd = rows.limit(40).withColumns({"area": F.when(F.col("listing_key") != "k3", F.when(F.col("listing_key") == "k4", math.nan).otherwise(F.col("area"))), "bedroom": F.when(F.col("listing_key") != "k5", F.col("bedroom"))})
    odd = features.rooms(odd)
    got = {r["listing_key"]: r for r in service.predict(odd).collect()}
    assert len(got) == 40 and all(r["prediction"] == "mine" for r in got.values())
    # Against the coefficients themselves.
    line = service.models["area"].stages[-1]
    for key, r in got.items():
        if key in ("k3", "k4"):
            assert r["voices"] == 0 and r["predicted_area"] is None and r["predicted_total_rooms"] is not None
        else:
            assert r["predicted_area"] == pytest.approx(line.intercept + line.coefficients[0] * r["area"])
    assert got["k3"]["origin"] == "none" and got["k3"]["predicted_price"] is None
    assert got["k5"]["voices"] == 1 and got["k5"]["predicted_price"] == got["k5"]["predicted_area"]
    whole = got["k6"]
    assert whole["voices"] == 2 and whole["predicted_price"] == pytest.approx((whole["predicted_area"] + whole["predicted_linear"]) / 2)
    assert abs(whole["predicted_linear"] - whole["price"]) / whole["price"] < 0.3  # prices, not logarithms
    assert service.predict(rows.limit(0)).count() == 0


def test_one_listing(spark, store):
    service = serving.Service(spark, store, config()).load()
    found = service.predict_one({"area": 100}, "area")
    assert found["origin"] == "models" and found["price"] == pytest.approx(5e9, rel=0.05) and set(found["by_model"]) == {"area"}
    found = service.predict_one({"area": 100, "province_id": 1, "bedroom": 2}, "linear")
    assert found["origin"] == "guess" and found["price"] == pytest.approx(100 * 8e7 * 1.1)
    assert service.predict_one({})["origin"] == "none"


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_of_groups_equal_those_of_each(spark, seed, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 8)
    monkeypatch.setattr(quantiles, "BINS", 4)
    rng = random.Random(seed)
    odd = [math.inf, -math.inf, math.nan, None, 1.7e308, -1.7e308, 5e-324, 0.0]
    data = [(g, h, rng.choice(odd) if rng.random() < 0.05 else float(rng.randint(0, 400)) ** rng.choice((1, 3))) for g, h, n in (("a", 1, 1500), ("a", None, 700), (None, 1, 3), ("b", 2, 1)) for _ in range(n)]
    data += [("void", 1, None)] + [("same", 1, 5.0)] * 300
    frame = spark.createDataFrame(data, "g string, h int, v double")
    shares = [0.0, 0.3, 0.5, 0.99, 1.0]
    got = quantiles.exact_by(frame, ["g", "h"], "v", shares)
    assert set(got) == {(g, h) for g, h, v in data if v is not None}
    for (g, h), found in got.items():
        ordered = sorted((v for a, b, v in data if (a, b) == (g, h) and v is not None), key=lambda v: (math.isnan(v), 0 if math.isnan(v) else v))
        for s, q in zip(shares, found, strict=True):
            p = (len(ordered) - 1) * s
            want = quantiles._between(dict(enumerate(ordered)), p)
            assert q == want or (math.isnan(q) and math.isnan(want))
    with pytest.raises(ValueError):
        quantiles.exact_by(frame, ["g", "h"], "v", shares, most=3)


def test_errors_of_groups_equal_those_of_each(spark):
    data = [(m, float(i + 1), float(i + 1) * (1 + (i * 7 % 11 - 5) / 20)) for m, n in (("a", 300), ("b", 7), (None, 4)) for i in range(n)]
    frame = spark.createDataFrame(data, "model string, y double, p double")
    by = {r["model"]: r.asDict() for r in stats.price_errors(frame, "y", "p", "model").collect()}
    assert set(by) == {"a", "b", None}
    for m, r in by.items():
        r.pop("model")
        assert r == stats.price_errors(frame.where(F.col("model").eqNullSafe(F.lit(m))), "y", "p").first().asDict()


def test_no_candidate_is_judged_on_days_it_saw(spark, rows):
    starts = folds.origins(rows, "posted_date", 3)
    scores = folds.searched(rows, "posted_date", {c: models.line(c) for c in ("area", "total_rooms")}, "price", starts)
    got = {(r["candidate"], r["fold"]): (r["n"], r["rmse"]) for r in scores.collect()}
    data = [(r["posted_date"].date(), r["area"], r["price"]) for r in rows.select("posted_date", "area", "price").collect()]
    number = lambda d: (d - datetime.date(1970, 1, 1)).days
    for i, (a, b) in enumerate(zip(starts, starts[1:], strict=False)):
        train = [(x, y) for d, x, y in data if number(d) < a]
        mx, my = sum(x for x, _ in train) / len(train), sum(y for _, y in train) / len(train)
        k = sum((x - mx) * (y - my) for x, y in train) / sum((x - mx) ** 2 for x, _ in train)
        test = [(x, y) for d, x, y in data if a <= number(d) < b]
        want = math.sqrt(sum((y - my - k * (x - mx)) ** 2 for x, y in test) / len(test))
        assert got["area", i][0] == len(test) and got["area", i][1] == pytest.approx(want, rel=1e-6)
    best = folds.standing(scores).where("place = 1").first()
    assert best["candidate"] == "area" and best["folds"] == 3


def test_final_ranges_and_newest_rows(spark):
    r = spark.createDataFrame([(1e9, 50.0, None), (1e9, 50.0, 100), (None, 50.0, 3), (1e9, 5.0, 3), (1.0, 5.0, 0)], "price double, area double, floor_count int")
    assert clean.valid(r).count() == 1
    assert [(x["rule"], x["removed"], x["kept"]) for x in clean.removed(r).orderBy("place").collect()] == [("price", 2, 3), ("area", 1, 2), ("floor_count", 1, 1)]
    day = datetime.date(2024, 1, 1)
    seen = spark.createDataFrame([("a", "x", None), ("a", "y", day), ("b", "z", None), ("b", "w", None), (None, "n", day)], "id string, listing_key string, data_date date")
    assert {(x["id"], x["listing_key"]) for x in dedup.newest(seen).collect()} == {("a", "y"), ("b", "w"), (None, "n")}
