"""Models in service: trained by the settings, stored by day, loaded by day, and asked for prices.

A store is a folder with ``train/<day>`` (the rows a day's models learned from), ``models/<day>/<name>`` and the registry.
"""

from __future__ import annotations

import dataclasses

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.config import ModelConfig
from hearth.operators import clean, features, models, stats

CATEGORIES = ("house_type",)
# Price of an area unit by province where no model can tell, and elsewhere.
BASE, ELSEWHERE = {1: 8e7, 2: 6e7}, 3e7


def built(config: ModelConfig) -> dict[str, Pipeline]:
    """The models that the settings name: ``forest``, ``boosted``, ``linear``, or a feature for a straight line over it alone."""
    known = {
        "forest": lambda: models.forest(features.FEATURES, trees=config.trees, depth=config.depth, seed=config.seed),
        "boosted": lambda: models.boosted(features.FEATURES, trees=config.trees, step=config.step, seed=config.seed),
        "linear": lambda: models.in_money(models.linear(features.FEATURES, list(CATEGORIES))),
    } | {c: lambda c=c: models.line(c) for c in features.FEATURES}
    unknown = set(config.models) - set(known)
    if unknown:
        raise ValueError(f"unknown models: {', '.join(sorted(unknown))}")
    return {name: known[name]() for name in config.models}


def inputs(name: str) -> tuple[str, ...]:
    return (name,) if name in features.FEATURES else tuple(features.FEATURES)


def parts(rows: DataFrame, config: ModelConfig, day: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of a day: the test months end with it, the training months end where they begin.

    Only training rows are cleaned of outliers and balanced.
    """
    posted, last = F.to_date("posted_date"), F.lit(day).cast("date")
    border, first = F.add_months(last, -config.test_months), F.add_months(last, -config.test_months - config.train_months)
    known = rows.where((F.col("price") > 0) & (posted > first) & (posted <= last)).withColumn("log_price", F.log("price"))
    train = clean.without_outliers(known.where(posted <= border), config.outlier_method, ["price_per_m2"])
    return clean.balanced(train, "province", config.balance_cap), known.where(posted > border)


def train_day(rows: DataFrame, config: ModelConfig, store: str, day: str) -> int:
    """Train the named models as of a day, store and register them with their errors on the test months; returns the number of training rows.

    The training rows are written once and read by all models, so that a lost executor costs no more than its tasks.
    """
    spark = rows.sparkSession
    train, test = parts(rows, config, day)
    needed = ["price", "log_price", *CATEGORIES, *features.FEATURES]  # nothing else, as further columns may have the models' own names
    train.select(*[c for c in needed if c in train.columns]).write.mode("overwrite").parquet(f"{store}/train/{day}")
    train = spark.read.parquet(f"{store}/train/{day}")
    n = train.count()
    if n < config.least_rows:
        raise ValueError(f"{n} training rows, {config.least_rows} are needed")
    pipelines = built(config)
    fitted = {name: pipeline.fit(train) for name, pipeline in pipelines.items()}
    for name, model in fitted.items():
        models.save(model, f"{store}/models/{day}/{name}")
    asked = asked_of(test, fitted)
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"predicted_{name}").alias("p")) for name in fitted]))
    errors = stats.price_errors(asked.select("price", each.alias("m")).select("price", "m.*"), "price", "p", "model").collect()  # one row a model
    silent = set(fitted) - {r["model"] for r in errors}
    if silent:
        raise ValueError(f"no row to test {', '.join(sorted(silent))} on")
    for r in sorted(errors, key=lambda r: r["model"]):
        models.register(spark, f"{store}/registry", r["model"], {"r2": r["r2"], "rmse": r["rmse"]}, f"{store}/models/{day}/{r['model']}", day)
    return n


def asked_of(rows: DataFrame, fitted: dict[str, PipelineModel]) -> DataFrame:
    """``rows``, all of them, with ``predicted_<name>`` of every model; null where an input of the model is missing.

    Inputs are copied aside, so neither filling them nor the models' own columns touch a row.
    """
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) if c in rows.columns else F.lit(None).cast("double")
    every = sorted({c for name in fitted for c in inputs(name)})
    texts = [F.col(c).cast("string").alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in CATEGORIES]
    out = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), *texts,
        *[F.coalesce(number(c), F.lit(0.0)).alias(c) for c in every], *[number(c).isNotNull().alias(f"_has_{c}") for c in every],
    )
    for name, model in fitted.items():
        whole = F.lit(True)
        for c in inputs(name):
            whole = whole & F.col(f"_has_{c}")
        out = model.transform(out).select(*out.columns, F.when(whole, F.col("prediction")).alias(f"predicted_{name}"))
    return out.select("_row.*", *[f"predicted_{name}" for name in fitted])


def guessed(columns: list[str]) -> Column:
    """A price from area, province and rooms, for listings no model can judge."""
    value = lambda c: F.col(c) if c in columns else F.lit(None).cast("double")
    return features.fallback_price(value("area"), value("province_id"), value("bedroom"), value("bathroom"), BASE, ELSEWHERE)


@dataclasses.dataclass
class Service:
    """The models of one day of a store."""

    spark: SparkSession
    store: str
    config: ModelConfig
    day: str | None = None
    models: dict[str, PipelineModel] = dataclasses.field(default_factory=dict)
    r2: dict[str, float] = dataclasses.field(default_factory=dict)

    def days(self) -> DataFrame:
        """``day`` of every day with a model."""
        return models.registered(self.spark, f"{self.store}/registry").select(F.to_date("day").alias("day")).distinct()

    def load(self, wanted: str | None = None) -> Service:
        """The models of a day, or of the nearest within ``lookback_days`` (the earlier of two); without a day, of the last."""
        near = self.days().orderBy(F.desc("day")).limit(1) if wanted is None else models.nearest_day(self.days(), wanted, self.config.lookback_days)
        found = near.first()
        if found is None:
            raise LookupError("no model is registered" if wanted is None else f"no model within {self.config.lookback_days} days of {wanted}")
        entries = models.registered(self.spark, f"{self.store}/registry").where(F.to_date("day") == F.lit(found["day"])).collect()  # one row a model
        self.day = str(found["day"])
        self.r2 = {e["model"]: e["r2"] for e in entries}
        self.models = {e["model"]: models.load(e["path"]) for e in entries}
        return self

    def reload(self) -> bool:
        """Load the last day's models if it is later than the one in service; tells whether it was."""
        last = self.days().agg(F.max("day").cast("string")).first()[0]
        if last is None or (self.day is not None and last <= self.day):
            return False
        self.load()
        return True

    def voices(self) -> list[str]:
        """The models of the ensemble: the best by R2, by name among equal ones."""
        return sorted(self.r2, key=lambda name: (-self.r2[name], name))[: self.config.ensemble_size]

    def predict(self, rows: DataFrame, *only: str) -> DataFrame:
        """Every row with the prediction of each model, ``predicted_price`` (the mean of the ensemble's, or of ``only``) and its ``origin``: models, guess, or none."""
        missing = set(only) - set(self.models)
        if missing or not self.models:
            raise LookupError(f"not loaded: {', '.join(sorted(missing)) or 'any model'}")
        chosen = list(only) or self.voices()
        asked = asked_of(rows, {n: self.models[n] for n in self.models if not only or n in only})
        meant = models.ensemble_mean(asked, [f"predicted_{n}" for n in chosen])
        guess = guessed(rows.columns)
        origin = F.when(F.col("voices") > 0, "models").when(guess.isNotNull(), "guess").otherwise("none")
        return meant.withColumns({"predicted_price": F.coalesce("predicted_mean", guess), "origin": origin}).drop("predicted_mean")

    def predict_one(self, listing: dict, *only: str) -> dict:
        """The answer for one listing; fields that it lacks are missing inputs."""
        numbers = {c for n in self.models for c in inputs(n)} | {"area", "province_id", "bedroom", "bathroom"}
        values = [None if listing.get(c) is None else float(listing[c]) for c in sorted(numbers)] + [listing.get(c) for c in CATEGORIES]
        schema = ", ".join([f"{c} double" for c in sorted(numbers)] + [f"{c} string" for c in CATEGORIES])
        found = self.predict(self.spark.createDataFrame([tuple(values)], schema), *only).first()
        return {"price": found["predicted_price"], "origin": found["origin"], "day": self.day, "by_model": {n: found[f"predicted_{n}"] for n in self.models if not only or n in only}}

    def about(self) -> dict:
        """Day, models with their R2, ensemble, inputs."""
        return {"day": self.day, "models": dict(self.r2), "ensemble": self.voices(), "inputs": {n: list(inputs(n)) for n in self.models}}
