"""Time-ordered model search: folds with a rolling origin, predictions out of fold, and a second model over them."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.operators import quantiles


def origins(rows: DataFrame, day: str, folds: int) -> list[int]:
    """The first test day of each fold, and the day after the last: days (since 1970) that cut the rows into ``folds`` + 1 parts of like size."""
    number = rows.select(F.unix_date(F.col(day).cast("date")).alias("d"))
    cuts = quantiles.exact(number, "d", [*(i / (folds + 1) for i in range(1, folds + 1)), 1.0])
    if cuts[0] is None:
        return []
    return sorted({math.floor(c) for c in cuts[:-1]}) + [math.floor(cuts[-1]) + 1]


def folded(rows: DataFrame, day: str, starts: list[int]) -> DataFrame:
    """Every row once for each fold it is in, with ``fold`` and ``part``: train (before the fold's first day) or test (up to the next fold)."""
    d = F.unix_date(F.col(day).cast("date"))
    entries = [F.struct(F.lit(i).alias("fold"), F.when(d < a, "train").when(d < b, "test").alias("part")) for i, (a, b) in enumerate(zip(starts, starts[1:], strict=False))]
    return rows.withColumn("_f", F.explode(F.array(*entries))).where("_f.part is not null").select(*rows.columns, "_f.fold", "_f.part")


def out_of_fold(rows: DataFrame, day: str, models: dict[str, Pipeline], starts: list[int]) -> DataFrame:
    """``rows`` of all test parts with ``fold`` and ``predicted_<name>``: no row is predicted by a model that saw its day or a later one.

    Columns with the names that models give theirs are set aside meanwhile.
    """
    out = None
    own = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), "*").drop("prediction", "features", "raw")
    every = folded(own, day, starts)
    for i in range(len(starts) - 1):
        train, test = (every.where((F.col("fold") == i) & (F.col("part") == p)) for p in ("train", "test"))
        for name, pipeline in models.items():
            kept = test.columns
            test = pipeline.fit(train).transform(test).select(*kept, F.col("prediction").alias(f"predicted_{name}"))
        out = test if out is None else out.unionByName(test)
    return out.select("_row.*", "fold", *[f"predicted_{name}" for name in models])


def stacked(predicted: DataFrame, label: str, names: list[str], folds: int) -> DataFrame:
    """The last fold with ``predicted_stack``: a linear model over the base predictions, learned from those of the earlier folds."""
    assemble = VectorAssembler(inputCols=[f"predicted_{n}" for n in names], outputCol="_base", handleInvalid="skip")
    model = Pipeline(stages=[assemble, LinearRegression(featuresCol="_base", labelCol=label, predictionCol="predicted_stack", regParam=0.01)])
    last = folds - 1
    return model.fit(predicted.where(F.col("fold") < last)).transform(predicted.where(F.col("fold") == last)).drop("_base")


def searched(rows: DataFrame, day: str, candidates: dict[str, Pipeline], label: str, starts: list[int]) -> DataFrame:
    """``candidate, fold, n, rmse`` of every candidate on the test part of every fold; rows that one of them cannot predict count for none."""
    found = out_of_fold(rows, day, candidates, starts)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("candidate"), F.col(f"predicted_{n}").alias("p")) for n in candidates]))
    errors = found.select("fold", F.col(label).alias("y"), each.alias("c")).select("fold", "c.candidate", F.pow(F.col("y") - F.col("c.p"), F.lit(2.0)).alias("e"))
    return errors.groupBy("candidate", "fold").agg(F.count("*").alias("n"), F.sqrt(F.avg("e")).alias("rmse"))


def standing(scores: DataFrame) -> DataFrame:
    """``candidate, folds, rmse`` (mean over the folds) and ``place``, the least error first, by name among equal ones; one row a candidate."""
    means = scores.groupBy("candidate").agg(F.count("*").alias("folds"), F.avg("rmse").alias("rmse"))
    return means.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("rmse", "candidate")))
