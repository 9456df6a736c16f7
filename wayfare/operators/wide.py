"""Linear regression whose category weights stay in a table, however many values the categories have.

The normal equations are solved by conjugate gradients.  All vectors over
category values (weights, residuals, directions) are columns of one table with
a row for each value; a step joins the direction to the counted combinations
of values and adds up by value again.  The driver holds the numbers' matrix,
which has a row for each number, and a few sums.  A penalty on squared weights
adds to the equations' diagonal, so penalised models are solved likewise.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators.tips import CATEGORICAL, L2_CANDIDATES, LABEL, NUMERIC, PARALLEL_TRIALS
from wayfare.scratch import fresh_path
from wayfare.sources.storage import Storage

#: What may be left of the equations, against the spread of the labels, and the steps a solution may take.
TOLERANCE, STEPS = 1e-12, 500

#: Steps go on below the tolerance while each still halves what is left, down to what sums of doubles can tell.
ROUNDING = 1e-15


@dataclass(frozen=True)
class WideModel:
    """Numbers' weights as plain numbers, category weights as a table of ``feature, value, weight``."""

    label: str
    intercept: float
    numbers: dict[str, float]  # weight per unit
    means: dict[str, float]  # stand in for absent numbers
    categorical: tuple[str, ...]
    weights: DataFrame

    @property
    def prediction(self) -> str:
        return f"predicted_{self.label}"


@dataclass(frozen=True)
class Trial:
    """A strength of the penalty and the mean squared error on the rows held out."""

    l2: float
    mean_squared_error: float


def _number(column: str) -> Column:
    """A number as double; NULL if there is none."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(Column.__add__, columns, F.lit(0.0))


def _dot(columns: Sequence[Column], factors: np.ndarray) -> Column:
    return _sum([c * F.lit(float(f)) for c, f in zip(columns, factors)])


def train(
    df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL, *, label: str = LABEL,
    l2: float = 0.0, tolerance: float = TOLERANCE, steps: int = STEPS,
) -> WideModel:
    """Least squares on all features, from the rows whose label is known.

    What is least is the mean squared error plus ``l2`` times the sum over all
    weights of squared weight times the feature's variance, so the unit of a
    feature does not matter; the intercept has no penalty.  Absent numbers
    count as the mean, absent categories add nothing.  Where weights are not
    determined (without penalty, every row has one value of each category) the
    predictions are all the same, and the steps find one such solution.  Rows
    are read three times; the steps read counted combinations of values.  A
    table without labels is an error, as are a negative ``l2`` and a solution
    not reached in ``steps``.
    """
    if not l2 >= 0:
        raise ValueError(f"a penalty is at least 0, not {l2}")
    spark = df.sparkSession
    cats = [f"_c{i}" for i in range(len(categorical))]
    nums = [f"_x{j}" for j in range(len(numeric))]
    known = df.select(
        *[F.col(c).cast("string").alias(a) for c, a in zip(categorical, cats)],
        *[_number(c).alias(a) for c, a in zip(numeric, nums)], _number(label).alias("_y"),
    ).filter(F.col("_y").isNotNull())
    told = known.agg(
        F.count("_y").alias("n"), F.avg("_y").alias("_y"),
        F.var_pop("_y").alias("spread"), *[f(a).alias(f"{a}_{f.__name__}") for a in nums for f in (F.avg, F.stddev_pop)],
    ).first()
    if not told["n"]:
        raise ValueError(f"no row has a {label}")
    means = np.array([told[f"{a}_avg"] or 0.0 for a in nums])
    scales = np.array([told[f"{a}_stddev_pop"] or 1.0 for a in nums])

    # Centred and scaled numbers after a column of ones; an absent one is zero.
    ones = ["_one", *nums]
    rows = known.select(*cats, F.lit(1.0).alias("_one"), (F.col("_y") - told["_y"]).alias("_y"), *[
        F.coalesce((F.col(a) - float(m)) / float(s), F.lit(0.0)).alias(a) for a, m, s in zip(nums, means, scales)
    ])
    pairs = [(i, j) for i in range(len(ones)) for j in range(i + 1)]
    sums = rows.agg(*[F.sum(F.col(ones[i]) * F.col(ones[j])) for i, j in pairs], *[F.sum(F.col(a) * F.col("_y")) for a in ones])
    found = list(sums.first())
    matrix = np.zeros((len(ones), len(ones)))
    for (i, j), total in zip(pairs, found):
        matrix[i, j] = matrix[j, i] = total
    matrix += np.diag([0.0, *(l2 * np.diag(matrix)[1:])])
    # A value of n rows has the variance n/N - (n/N)^2.
    penalty = F.col("_one") * (1 - F.col("_one") / told["n"]) * l2
    weight_of = F.col("_one") + penalty  # its place on the diagonal
    r = np.array(found[len(pairs):])
    diagonal = np.where(np.diag(matrix) > 0, np.diag(matrix), 1.0)

    cells_path, path = fresh_path(spark, "cells"), fresh_path(spark, "weights")
    rows.groupBy(*cats).agg(*[F.sum(a).alias(a) for a in (*ones, "_y")]).write.parquet(cells_path)
    cells = spark.read.parquet(cells_path)
    _by_value(cells, cats, [*ones, "_y"]).withColumns(
        {"w": F.lit(0.0), "p": F.col("_y") / weight_of, "q": F.lit(0.0)}
    ).withColumnRenamed("_y", "r").write.parquet(path)
    state = spark.read.parquet(path)

    def size(residual: np.ndarray, table: DataFrame) -> float:
        over_values = table.agg(F.sum(F.col("r") * F.col("r") / weight_of)).first()[0]
        return float((residual**2 / diagonal).sum()) + (over_values or 0.0)

    w, p = np.zeros(len(ones)), r / diagonal
    whole = told["n"] * told["spread"]  # no residual is larger
    left, old, taken = size(r, state), np.inf, 0
    while left > whole * ROUNDING**2 and (left > whole * tolerance**2 or left < old / 4):
        if taken == steps:
            raise RuntimeError(f"not solved in {steps} steps")
        taken += 1
        # What the normal matrix makes of the direction; one written table a step.
        shared = _by_value(_scored(cells, state, cats), cats, ["_hit"]) if len(cats) > 1 else state.select(
            "place", "value", (F.col("_one") * F.col("p")).alias("_hit"))
        crossed = _dot([F.col(a) for a in ones], p)
        before, path = path, fresh_path(spark, "weights")
        state.drop("q").join(shared, ["place", "value"]).withColumn(
            "q", F.col("_hit") + crossed + penalty * F.col("p")).drop("_hit").write.parquet(path)
        state = spark.read.parquet(path)
        Storage(spark).delete(before)
        told_step = state.agg(F.sum(F.col("p") * F.col("q")), *[F.sum(F.col(a) * F.col("p")) for a in ones]).first()
        over, *down = [v or 0.0 for v in told_step]
        q = matrix @ p + np.array(down)
        step = left / (float(p @ q) + over)
        w, r = w + step * p, r - step * q
        state = state.withColumns({"w": F.col("w") + step * F.col("p"), "r": F.col("r") - step * F.col("q")})
        left, old = size(r, state), left
        p = r / diagonal + left / old * p
        state = state.withColumn("p", F.col("r") / weight_of + left / old * F.col("p"))
    named = F.element_at(F.array(*[F.lit(c) for c in categorical]), F.col("place") + 1) if cats else F.lit(None).cast("string")
    numbers = w[1:] / scales
    return WideModel(
        label, float(told["_y"] + w[0]), dict(zip(numeric, numbers.tolist())), dict(zip(numeric, means.tolist())),
        tuple(categorical), state.select(named.alias("feature"), "value", F.col("w").alias("weight")),
    )


def _by_value(cells: DataFrame, cats: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sums over the rows of each category value; tasks add up before the shuffle, so a hot value is a row of each."""
    if not cats:
        return cells.select(F.lit(0).alias("place"), F.lit("").alias("value"), *sums).filter(F.lit(False))
    long = cells.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("place"), F.col(c).alias("value"), *sums) for i, c in enumerate(cats)
    ])))
    return long.filter(F.col("value").isNotNull()).groupBy("place", "value").agg(*[F.sum(s).alias(s) for s in sums])


def _scored(cells: DataFrame, state: DataFrame, cats: Sequence[str]) -> DataFrame:
    """Rows of a cell times the direction of all its values."""
    out, parts = cells.select(*cats, "_one"), []
    for i, c in enumerate(cats):
        listed = state.filter(F.col("place") == i).select(F.col("value").alias(f"_v{i}"), F.col("p").alias(f"_p{i}"))
        out = out.join(listed, F.col(c) == F.col(f"_v{i}"), "left")
        parts.append(F.coalesce(F.col(f"_p{i}"), F.lit(0.0)))
    return out.select(*cats, (F.col("_one") * _sum(parts)).alias("_hit"))


def _with_shares(model: WideModel, df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """What each feature adds to the intercept; weights are joined by value, broadcast or shuffled as their measured size allows."""
    shares = {
        c: F.lit(weight) * F.coalesce(_number(c) - model.means[c], F.lit(0.0)) for c, weight in model.numbers.items()
    }
    for i, c in enumerate(model.categorical):
        listed = model.weights.filter(F.col("feature") == c).select(
            F.col("value").alias(f"_value_{i}"), F.col("weight").alias(f"_weight_{i}"))
        df = df.join(listed, F.col(c).cast("string") == F.col(f"_value_{i}"), "left")
        shares[c] = F.coalesce(F.col(f"_weight_{i}"), F.lit(0.0))
    return df, shares


def predict(model: WideModel, df: DataFrame) -> DataFrame:
    """The rows with ``predicted_<label>``; values that training did not see add nothing."""
    scored, shares = _with_shares(model, df)
    return scored.select(*df.columns, _sum([F.lit(model.intercept), *shares.values()]).alias(model.prediction))


def explain(model: WideModel, df: DataFrame, top_features: int = 3) -> DataFrame:
    """Predictions with the features that moved each of them most.

    The baseline is the prediction with all numbers at their mean and no
    category; it and the shares of all features add up to the prediction.
    Equal shares come in the features' order by name.
    """
    scored, shares = _with_shares(model, df)
    ranked = F.array_sort(F.array(*[
        F.struct((-F.abs(s)).alias("order"), F.lit(c).alias("feature"), s.alias("attribution")) for c, s in shares.items()
    ]))
    best = F.transform(F.slice(ranked, 1, top_features), lambda x: F.struct(x["feature"], x["attribution"]))
    return scored.select(
        *df.columns, _sum([F.lit(model.intercept), *shares.values()]).alias(model.prediction),
        best.alias("top_feature_attributions"), F.lit(model.intercept).alias("baseline_prediction_value"),
        F.lit(0.0).alias("approximation_error"),
    )


def tune(
    df: DataFrame, held_out: Column, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL, *,
    label: str = LABEL, candidates: Sequence[float] = L2_CANDIDATES, parallel: int = PARALLEL_TRIALS,
) -> tuple[WideModel, list[Trial]]:
    """The model of the penalty with the least error on the rows held out, learned from all rows, and every trial.

    ``held_out`` tells those rows apart by their own columns; rows for which it
    is NULL are learned from.  Among equal errors the earlier candidate is
    taken.  Trials run side by side, ``parallel`` at a time.
    """
    held = F.coalesce(held_out, F.lit(False))
    learned, judged = df.filter(~held), df.filter(held)

    def attempt(l2: float) -> Trial:
        model = train(learned, numeric, categorical, label=label, l2=l2)
        error = _number(label) - F.col(model.prediction)
        found = predict(model, judged).agg(F.avg(error * error)).first()[0]
        if found is None:
            raise ValueError(f"no row held out has a {label}")
        return Trial(l2, found)

    with ThreadPoolExecutor(parallel) as pool:
        trials = list(pool.map(attempt, candidates))
    best = min(trials, key=lambda t: t.mean_squared_error)
    return train(df, numeric, categorical, label=label, l2=best.l2), trials
