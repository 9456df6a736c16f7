"""Regression of the tip amount: features, split, training, use, tuning."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.numbers import safe_divide
from wayfare.operators import ranks
from wayfare.scratch import fresh_path
from wayfare.sources.storage import Storage

# The columns of the training table.
NUMERIC = ("passenger_count", "trip_distance", "fare_amount", "tolls_amount")
CATEGORICAL = ("PULocationID", "DOLocationID", "payment_type")
LABEL = "tip_amount"

# Share of the rows that a split keeps for evaluation, and the places its hash
# deals rows out to.
EVALUATION_SHARE = 0.2
PLACES = 1_000_000

# The search space of the tuning and its number of trials.
L1_RANGE = (0.0, 20.0)
L2_CANDIDATES = (0.0, 0.1, 1.0, 10.0)
TRIALS = 5
PARALLEL_TRIALS = 2

# Features up to which Spark solves from sums of products, and numbers up to which
# their products are summed beside each other.
SOLVED_AT_ONCE, MOST_NUMBERS = 4096, 24


def tip_features(trips: DataFrame) -> DataFrame:
    """The training table: trips with a fare, ids as text so that they are categories."""
    columns = ("passenger_count", "trip_distance", *CATEGORICAL, "fare_amount", "tolls_amount", LABEL)
    return trips.filter(F.col("fare_amount") != 0).select(
        *[F.col(c).cast("string").alias(c) if c in CATEGORICAL else F.col(c) for c in columns]
    )


def feature_info(
    df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL,
) -> DataFrame:
    """One row per feature.

    Numbers and categories are read in a pass each over their own columns:
    in one pass every row would be repeated for each column whose values are
    counted.  The median is the lower one and exact at any number of rows; it
    is found here, by a few passes over the numbers.
    """
    medians = ranks.quantile(df, {c: F.col(c) for c in numeric}) if numeric else {}

    def row(name: str, measures: dict[str, Column], categories: Column, nulls: Column) -> Column:
        measured = [m.cast("double").alias(n) for n, m in measures.items()]
        return F.struct(
            F.lit(name).alias("input"), *measured, categories.cast("long").alias("category_count"),
            nulls.alias("null_count"),
        )

    def nulls(c: str) -> Column:
        return F.count_if(F.col(c).isNull())

    numbers = df.agg(*[
        row(c, {
            "min": F.min(c), "max": F.max(c), "mean": F.avg(c),
            "median": F.lit(medians[c]), "stddev": F.stddev_samp(c),
        }, F.lit(None), nulls(c)).alias(c)
        for c in numeric
    ]).select(F.inline(F.array(*numeric)))
    if not categorical:
        return numbers

    # Each value once per task before the shuffle, spread over all tasks after it.
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("input"), F.col(c).cast("string").alias("value")) for c in categorical
    ])))
    counted = values.groupBy("input", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("input").agg(
        F.count("value").alias("category_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
    )
    return numbers.unionByName(counted, allowMissingColumns=True)


def split(
    df: DataFrame, row_key: Sequence[str], share: float = EVALUATION_SHARE
) -> tuple[DataFrame, DataFrame]:
    """Rows to train on and rows to evaluate on, the same ``share`` at every size.

    The side depends on a hash of the row's key alone, so it is the same in
    every run, for every layout of the rows and after a lost task.
    """
    held = _held_out(row_key, share)
    return df.filter(~held), df.filter(held)


def _held_out(row_key: Sequence[str], share: float = EVALUATION_SHARE) -> Column:
    return F.pmod(F.xxhash64(*row_key), F.lit(PLACES)) < round(share * PLACES)


@dataclass(frozen=True)
class TipModel:
    """A trained regression as plain numbers: what scoring needs and no more."""

    label: str
    intercept: float
    numbers: dict[str, float]  # weight per unit
    means: dict[str, float]  # stand in for absent numbers
    categories: dict[str, dict[str, float]]  # weight per value; unknown values have none

    @property
    def prediction(self) -> str:
        return f"predicted_{self.label}"

    @property
    def baseline(self) -> float:
        """The prediction with all numbers at their mean and no category."""
        return self.intercept + sum(w * self.means[c] for c, w in self.numbers.items())


def category_values(df: DataFrame, categorical: Sequence[str]) -> list[list[str]]:
    """The values of each category column in order.

    Each gets a weight, and all weights are on the driver as Spark's solvers
    have it: the driver holds one name and one number for each value, not for
    each row.  Above 4096 features Spark solves by steps instead of at once.
    """
    found = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("value"))
        for i, c in enumerate(categorical)
    ]))).filter(F.col("value").isNotNull()).distinct()
    values: list[list[str]] = [[] for _ in categorical]
    for row in found.toLocalIterator():
        values[row.place].append(row.value)
    return [sorted(v) for v in values]


def _stages(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> list:
    filled, indexed, hot = ([f"_{kind}_{c}" for c in names] for kind, names in (
        ("filled", numeric), ("index", categorical), ("hot", categorical)))
    stages: list = []
    if numeric:
        stages.append(Imputer(strategy="mean", inputCols=_numbers(numeric), outputCols=filled))
    if categorical:
        # Unknown and NULL categories share one extra index; it is last, so it
        # encodes as no category at all.
        for c, index, values in zip(categorical, indexed, category_values(df, categorical)):
            stages.append(StringIndexerModel.from_labels(values, c, index, "keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot))
    stages.append(VectorAssembler(inputCols=[*filled, *hot], outputCol="_features"))
    return stages


def _with_numbers(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """The numbers as doubles in columns of their own; the means need not be whole."""
    return df.withColumns({f"_number_{c}": F.col(c).cast("double") for c in numeric})


def fit(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, regularisation: float = 0.0,
    l1_share: float = 0.0,
) -> PipelineModel:
    """The fitted stages, from the rows whose label is known."""
    known = _with_numbers(df, numeric).filter(F.col(label).isNotNull())
    prepared = Pipeline(stages=_stages(known, numeric, categorical)).fit(known)
    regression = LinearRegression(
        featuresCol="_features", labelCol=label, regParam=regularisation, elasticNetParam=l1_share
    )
    fitted = regression.fit(prepared.transform(known.select(label, *categorical, *_numbers(numeric))))
    return PipelineModel([*prepared.stages, fitted])


def _numbers(numeric: Sequence[str]) -> list[str]:
    return [f"_number_{c}" for c in numeric]


def read_weights(fitted: PipelineModel, numeric: Sequence[str], categorical: Sequence[str], label: str) -> TipModel:
    """The fitted numbers under the names of the features they belong to."""
    regression = fitted.stages[-1]
    weights = iter(regression.coefficients.toArray().tolist())
    numbers = {c: next(weights) for c in numeric}
    indexers = [s for s in fitted.stages if isinstance(s, StringIndexerModel)]
    categories = {c: {v: next(weights) for v in s.labels} for c, s in zip(categorical, indexers)}
    means = fitted.stages[0].surrogateDF.first() if numeric else {}
    return TipModel(
        label, regression.intercept, numbers, {c: means[f"_number_{c}"] for c in numeric}, categories
    )


def train(
    df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL, *,
    label: str = LABEL, regularisation: float = 0.0, l1_share: float = 0.0,
) -> TipModel:
    """Linear regression on all features, from the rows whose label is known.

    Absent numbers count as the mean.  Training sends per-task sums of the
    size of features x features, never rows, to the driver.
    """
    return read_weights(fit(df, numeric, categorical, label, regularisation, l1_share), numeric, categorical, label)


def _with_shares(model: TipModel, df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """What each feature adds to the baseline, as native expressions.

    The weights of a category's values are joined on, broadcast or not as
    their measured size allows.
    """
    shares = {}
    for c, weight in model.numbers.items():
        number = F.col(c).cast("double")
        known = F.when(number.isNotNull() & ~F.isnan(number), number - F.lit(model.means[c])).otherwise(0.0)
        shares[c] = F.lit(weight) * known
    for c, weights in model.categories.items():
        if weights:
            listed = df.sparkSession.createDataFrame(list(weights.items()), f"_value_{c} string, _share_{c} double")
            df = df.join(listed, F.col(c).cast("string") == F.col(f"_value_{c}"), "left")
            shares[c] = F.coalesce(F.col(f"_share_{c}"), F.lit(0.0))
    return df, shares


def _total(model: TipModel, shares: dict[str, Column]) -> Column:
    return sum(shares.values(), F.lit(model.baseline)).alias(model.prediction)


def predict(model: TipModel, df: DataFrame) -> DataFrame:
    """The rows with ``predicted_<label>``."""
    scored, shares = _with_shares(model, df)
    return scored.select(*df.columns, _total(model, shares))


def evaluate(predicted: DataFrame, label: str = LABEL, prediction: str | None = None) -> DataFrame:
    """One row of error measures over the rows whose label is known; the median error is exact."""
    y, p = F.col(label), F.col(prediction or f"predicted_{label}")
    error = y - p
    # log(1 + x) exists for values above -1 only; elsewhere the row is left out.
    log_error = F.when((y > -1) & (p > -1), F.log1p(y) - F.log1p(p))
    known = predicted.filter(y.isNotNull() & p.isNotNull())
    median = ranks.quantile(known, {"error": F.abs(error)})["error"]
    return known.agg(
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        F.avg(error * error).alias("mean_squared_error"),
        F.avg(log_error * log_error).alias("mean_squared_log_error"),
        F.lit(median).cast("double").alias("median_absolute_error"),
        (1 - safe_divide(F.avg(error * error), F.var_pop(y))).alias("r2_score"),
        (1 - safe_divide(F.var_pop(error), F.var_pop(y))).alias("explained_variance"),
    )


def explain(model: TipModel, df: DataFrame, top_features: int = 3) -> DataFrame:
    """Predictions with the features that moved each of them most.

    A number's share is its weight times its distance from the mean, a
    category's share the weight of its value.  The baseline and the shares of
    all features add up to the prediction, so nothing is approximate.
    """
    scored, shares = _with_shares(model, df)
    ranked = F.array_sort(F.array(*[
        F.struct((-F.abs(s)).alias("order"), F.lit(c).alias("feature"), s.alias("attribution"))
        for c, s in shares.items()
    ]))
    best = F.transform(F.slice(ranked, 1, top_features), lambda x: F.struct(x["feature"], x["attribution"]))
    return scored.select(
        *df.columns,
        _total(model, shares),
        best.alias("top_feature_attributions"),
        F.lit(model.baseline).alias("baseline_prediction_value"),
        F.lit(0.0).alias("approximation_error"),
    )


def trial_points(trials: int = TRIALS, seed: int = 7) -> list[tuple[float, float]]:
    """Pairs of L1 and L2 strength: L1 from its range, L2 from its candidates."""
    draw = random.Random(seed)
    return [(draw.uniform(*L1_RANGE), draw.choice(L2_CANDIDATES)) for _ in range(trials)]


def elastic_net(l1: float, l2: float) -> tuple[float, float]:
    """Spark's strength and L1 share for a penalty ``l1 |w| + l2 w²``."""
    strength = l1 + 2 * l2
    return strength, (l1 / strength if strength else 0.0)


def _cell_sums(names: Sequence[str]) -> list[tuple[int, int]]:
    """Pairs of columns, the column of ones first, whose products are summed."""
    return [(i, j) for i in range(len(names) + 1) for j in range(i + 1)]


def _cell_rows(n: int) -> int:
    """Rows that stand for a cell: enough for ``n`` columns and ones, and a power of two, so that shares of counts are exact."""
    return 1 << math.ceil(math.log2(n + 1))


def _rows_of_cells(keys: Sequence[str], names: Sequence[str], means: Sequence[float]) -> Callable:
    """Rows of equal weight with the sums of their cell.

    A cell's matrix of sums is R'R; a reflection of R that makes its column of
    ones even leaves R'R as it is, and its rows are then weighted rows.
    """
    pairs, width, count = _cell_sums(names), len(names) + 1, _cell_rows(len(names))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sums = np.empty((n, width, width))
            for i, j in pairs:
                sums[:, i, j] = sums[:, j, i] = batch.column(f"_s{i}_{j}").to_numpy(zero_copy_only=False)
            size = np.sqrt(np.diagonal(sums, axis1=1, axis2=2))
            unit = np.where(size > 0, size, 1.0)
            values, vectors = np.linalg.eigh(sums / (unit[:, :, None] * unit[:, None, :]))
            root = np.zeros((n, count, width))
            root[:, :width] = np.sqrt(np.maximum(values, 0.0))[:, :, None] * vectors.transpose(0, 2, 1) * size[:, None, :]
            even = size[:, 0] / math.sqrt(count)
            # The farther of the two even columns, so that the mirror is well determined.
            sign = np.where(root[:, :, 0].sum(axis=1) > 0, -1.0, 1.0)
            mirror = root[:, :, 0] - (sign * even)[:, None]
            mirror /= np.linalg.norm(mirror, axis=1)[:, None]
            root -= 2 * mirror[:, :, None] * np.einsum("nr,nrc->nc", mirror, root)[:, None, :]
            found = root * (sign / even)[:, None, None]
            place = pa.array(np.repeat(np.arange(n), count))
            columns = {k: batch.column(k).take(place) for k in keys}
            columns["_weight"] = pa.array(np.repeat(sums[:, 0, 0] / count, count))
            for i, (name, mean) in enumerate(zip(names, means), 1):
                columns[name] = pa.array(found[:, :, i].ravel() + mean)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _condensed(
    known: DataFrame, held: Column, numeric: Sequence[str], categorical: Sequence[str], label: str, path: str,
) -> DataFrame | None:
    """A few weighted rows for all rows with the same categories on the same side of the split.

    Their sums, and sums of products of numbers and label, are those of the
    rows, absent numbers counting as the mean; squared errors of a linear model
    and all it is solved from depend on nothing else.  None where this would
    leave no fewer rows, and for numbers that no model can be learned from.
    """
    names = [*_numbers(numeric), label]
    if len(names) > MOST_NUMBERS:
        return None
    number = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in names}
    side = held.alias("_held")
    texts = [F.col(c).cast("string").alias(c) for c in categorical]
    told = known.agg(
        F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(side, *texts)).alias("cells"),
        F.count_if(number[label].isNull()).alias("unlabelled"),
        *[F.avg(v).alias(f"mean_{i}") for i, v in enumerate(number.values())],
    ).first()
    means = [told[f"mean_{i}"] for i in range(len(names))]
    if told["cells"] * _cell_rows(len(names)) > told["rows"] or told["unlabelled"] or not all(
            m is not None and math.isfinite(m) for m in means):
        return None
    centred = [F.lit(1.0), *[F.coalesce(v - F.lit(m), F.lit(0.0)) for v, m in zip(number.values(), means)]]
    columns = [f"_c{i}" for i in range(len(centred))]
    keys = ["_held", *categorical]
    cells = known.select(side, *texts, *[c.alias(a) for c, a in zip(centred, columns)]).groupBy(*keys).agg(*[
        F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"_s{i}_{j}") for i, j in _cell_sums(names)])
    kind = ", ".join([
        "_held boolean", *[f"`{c}` string" for c in categorical], *[f"`{c}` double" for c in ("_weight", *names)]])
    cells.mapInArrow(_rows_of_cells(keys, names, means), kind).write.parquet(path)
    return known.sparkSession.read.schema(kind).parquet(path)


def tune(
    df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL, *,
    label: str = LABEL, trials: int = TRIALS, parallel: int = PARALLEL_TRIALS, seed: int = 7,
) -> tuple[TipModel, list[dict[str, float]]]:
    """The best of several penalties by squared error on a held-out fifth.

    Rows are held out by a hash of their columns.  Returns the model and one
    entry per trial.  The rows are read three times, however many trials there
    are: these learn from and are judged on a few weighted rows for each
    combination of categories.  Where that leaves no fewer rows, and where
    Spark solves by steps, every trial reads the rows.
    """
    known = _with_numbers(df, numeric).filter(F.col(label).isNotNull())
    wanted = [label, *categorical, *_numbers(numeric)]
    held = _held_out(wanted)
    rows = known.select(*wanted, F.lit(1.0).alias("_weight"), held.alias("_held"))
    path = fresh_path(df.sparkSession, "condensed")
    try:
        condensed = _condensed(known, held, numeric, categorical, label, path)
        prepared = Pipeline(stages=_stages(known if condensed is None else condensed, numeric, categorical)).fit(known)
        hot = sum(len(s.labels) for s in prepared.stages if isinstance(s, StringIndexerModel))
        few = condensed is not None and len(numeric) + hot <= SOLVED_AT_ONCE
        return _tried(prepared, condensed if few else rows, numeric, categorical, label, trials, parallel, seed)
    finally:
        Storage(df.sparkSession).delete(path)


def _tried(
    prepared: PipelineModel, rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, trials: int,
    parallel: int, seed: int,
) -> tuple[TipModel, list[dict[str, float]]]:
    """The trials on weighted rows, and the model of the best one."""
    every = prepared.transform(rows).select(label, "_features", "_weight", "_held")
    learned, judged = every.filter(~F.col("_held")), every.filter("_held")
    points = trial_points(trials, seed)
    evaluator = RegressionEvaluator(
        labelCol=label, predictionCol=f"predicted_{label}", metricName="mse", weightCol="_weight")

    def learn(point: tuple[float, float], part: DataFrame):
        strength, share = elastic_net(*point)
        return LinearRegression(
            featuresCol="_features", labelCol=label, predictionCol=f"predicted_{label}", weightCol="_weight",
            regParam=strength, elasticNetParam=share,
        ).fit(part)

    def attempt(point: tuple[float, float]) -> float:
        return evaluator.evaluate(learn(point, learned).transform(judged))

    with ThreadPoolExecutor(parallel) as pool:
        errors = list(pool.map(attempt, points))
    log = [{"l1_reg": l1, "l2_reg": l2, "mean_squared_error": error} for (l1, l2), error in zip(points, errors)]
    # the chosen penalty, learned from all rows
    best = min(range(len(points)), key=lambda i: (errors[i], i))
    fitted = learn(points[best], every)
    return read_weights(PipelineModel([*prepared.stages, fitted]), numeric, categorical, label), log
