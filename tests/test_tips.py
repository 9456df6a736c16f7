import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.operators import ranks, tips, wide

KIND = "id long, x double, y double, c string, tip_amount double"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    n = 2000
    x, y, c = rng.normal(3, 2, n), rng.normal(0, 1, n), rng.integers(0, 4, n)
    tip = 1 + 2 * x - 3 * y + np.array([0, 1, -1, 5])[c] + rng.normal(0, 0.01, n)
    data = [(i, float(a), float(b), f"z{k}", float(t)) for i, (a, b, k, t) in enumerate(zip(x, y, c, tip))]
    return spark.createDataFrame(data, KIND)


@pytest.fixture(scope="module")
def model(rows):
    return tips.train(rows, ["x", "y"], ["c"])


def test_weights(model):
    assert model.numbers["x"] == pytest.approx(2, abs=0.01) and model.numbers["y"] == pytest.approx(-3, abs=0.01)
    by_value = model.categories["c"]
    steps = {c: w - by_value["z0"] for c, w in by_value.items()}
    assert steps == pytest.approx({"z0": 0, "z1": 1, "z2": -1, "z3": 5}, abs=0.01)


def test_scores_equal_those_of_the_fitted_stages(spark, rows):
    odd = spark.createDataFrame([(-1, None, 0.0, None, None), (-2, 1.0, float("nan"), "new", 1.0)], KIND)
    every = rows.unionByName(odd)
    fitted = tips.fit(every, ["x", "y"], ["c"], "tip_amount", 0.1, 0.5)
    stages = fitted.transform(tips._with_numbers(every, ["x", "y"])).select("id", "prediction")
    model = tips.read_weights(fitted, ["x", "y"], ["c"], "tip_amount")
    both = tips.predict(model, every).join(stages, "id")
    assert both.count() == 2002
    assert both.agg(F.max(F.abs(F.col("prediction") - F.col(model.prediction)))).first()[0] < 1e-9


def test_unknown_and_absent_values(spark, model):
    odd = spark.createDataFrame([(1, None, 0.0, None, None), (2, 1.0, None, "new", 1.0)], KIND)
    predicted = tips.predict(model, odd)
    assert predicted.dtypes == [*odd.dtypes, ("predicted_tip_amount", "double")]
    assert all(r.predicted_tip_amount is not None for r in predicted.collect())


def test_explanations_add_up(spark, rows, model):
    odd = spark.createDataFrame([(-1, None, 0.0, None, None), (-2, 1.0, None, "new", 1.0)], KIND)
    explained = tips.explain(model, rows.unionByName(odd), top_features=3)
    total = F.col("baseline_prediction_value") + F.aggregate(
        "top_feature_attributions", F.lit(0.0), lambda s, a: s + a["attribution"])
    assert explained.agg(F.max(F.abs(total - F.col("predicted_tip_amount")))).first()[0] < 1e-9
    for r in tips.explain(model, rows, top_features=2).limit(50).collect():
        sizes = [abs(a.attribution) for a in r.top_feature_attributions]
        assert len(sizes) == 2 and sizes == sorted(sizes, reverse=True)


def test_evaluate_equals_numpy(rows, model):
    predicted = tips.predict(model, rows)
    row = tips.evaluate(predicted).first()
    y, p = np.array(predicted.select("tip_amount", "predicted_tip_amount").collect()).T
    error, ok = y - p, (y > -1) & (p > -1)
    assert row.mean_absolute_error == pytest.approx(np.abs(error).mean())
    assert row.mean_squared_error == pytest.approx((error**2).mean())
    assert row.mean_squared_log_error == pytest.approx(((np.log1p(y[ok]) - np.log1p(p[ok])) ** 2).mean())
    assert row.r2_score == pytest.approx(1 - (error**2).sum() / ((y - y.mean()) ** 2).sum())
    assert row.explained_variance == pytest.approx(1 - error.var() / y.var())
    below = (np.abs(error) < row.median_absolute_error).mean()
    assert abs(below - 0.5) < 2e-3


def test_split(spark, rows):
    training, held = tips.split(rows, ["id"])
    ids = {r.id for r in held.select("id").collect()}
    assert 300 < len(ids) < 500 and training.count() == 2000 - len(ids)
    _, again = tips.split(rows.repartition(13), ["id"])
    assert ids == {r.id for r in again.select("id").collect()}
    _, of_many = tips.split(spark.range(200_000), ["id"])
    assert 39_000 < of_many.count() < 41_000


def test_feature_info(spark):
    df = spark.createDataFrame([(float(i), f"k{i % 3}") for i in range(1, 102)] + [(None, None)], "x double, c string")
    info = {r.input: r.asDict() for r in tips.feature_info(df, ["x"], ["c"]).collect()}
    assert (info["x"]["min"], info["x"]["max"], info["x"]["mean"], info["x"]["median"]) == (1.0, 101.0, 51.0, 51.0)
    assert (info["x"]["null_count"], info["x"]["category_count"]) == (1, None)
    assert (info["c"]["null_count"], info["c"]["category_count"], info["c"]["mean"]) == (1, 3, None)


def test_features_leave_out_free_trips(spark):
    kind = "passenger_count int, trip_distance double, PULocationID int, DOLocationID int, payment_type int, " \
           "fare_amount double, tolls_amount double, tip_amount double, extra double"
    df = spark.createDataFrame([(1, 1.0, 7, 8, 1, 0.0, 0.0, 1.0, 0.0), (1, 1.0, 7, None, 1, 5.0, 0.0, None, 0.0)], kind)
    features = tips.tip_features(df)
    assert features.count() == 1 and dict(features.dtypes)["PULocationID"] == "string" and "extra" not in features.columns


def test_more_categories_than_one_solver_takes(spark):
    df = spark.range(10_000).select((F.col("id") % 5000).cast("string").alias("c"), (F.col("id") % 2).cast("double").alias("y"))
    assert [len(v) for v in tips.category_values(df, ["c"])] == [5000]
    model = tips.train(df, [], ["c"], label="y")
    assert len(model.categories["c"]) == 5000


def test_tuning_does_not_depend_on_the_layout(rows):
    one, log = tips.tune(rows, ["x", "y"], ["c"], trials=2)
    other, again = tips.tune(rows.repartition(7), ["x", "y"], ["c"], trials=2)
    assert [t["mean_squared_error"] for t in log] == pytest.approx([t["mean_squared_error"] for t in again])
    assert one.numbers == pytest.approx(other.numbers)


def test_tuning(rows):
    model, log = tips.tune(rows, ["x", "y"], ["c"])
    assert len(log) == tips.TRIALS and all(0 <= t["l1_reg"] <= 20 and t["l2_reg"] in tips.L2_CANDIDATES for t in log)
    assert tips.predict(model, rows).count() == 2000
    assert tips.elastic_net(2.0, 1.0) == (4.0, 0.5) and tips.elastic_net(0.0, 0.0) == (0.0, 0.0)


def _rows_with_gaps(spark):
    """Absent, constant and hot values; the label is so wide that penalties leave some weights."""
    draw = random.Random(6)
    rows = []
    for i in range(3000):
        far, fare, zone = draw.gauss(3, 2), draw.gauss(50_000, 700), f"z{min(draw.randrange(12), 5)}"
        tip = 300 * far + 0.2 * fare + 400 * (zone == "z1") + draw.gauss(0, 90)
        rows.append((
            None if i % 17 == 0 else float("nan") if i % 19 == 0 else far, fare, 7, None if i % 11 == 0 else zone,
            draw.randrange(3), "same", None if i % 23 == 0 else tip))
    kind = "far double, fare double, always int, zone string, kind int, one string, tip_amount double"
    return spark.createDataFrame([*rows, *rows[:400]], kind), (["far", "fare", "always"], ["zone", "kind", "one"])


def test_trials_on_condensed_rows_equal_those_on_all_rows(spark, monkeypatch):
    df, features = _rows_with_gaps(spark)
    model, log = tips.tune(df, *features)
    monkeypatch.setattr(tips, "SOLVED_AT_ONCE", 0)
    plain, wanted = tips.tune(df, *features)
    assert [t["mean_squared_error"] for t in log] == pytest.approx([t["mean_squared_error"] for t in wanted], rel=1e-6)
    assert len({t["mean_squared_error"] for t in wanted}) > 1 and plain.numbers["far"] > 100 and plain.categories["zone"]["z1"] > 100
    assert model.intercept == pytest.approx(plain.intercept, rel=1e-6) and model.means == pytest.approx(plain.means)
    assert model.numbers == pytest.approx(plain.numbers, rel=1e-6, abs=1e-6)
    assert model.categories.keys() == plain.categories.keys()
    for c, weights in plain.categories.items():
        assert model.categories[c] == pytest.approx(weights, rel=1e-6, abs=1e-6)
    spread = tips.predict(model, df).join(tips.predict(plain, df).withColumnRenamed(model.prediction, "plain"), ["fare", "kind"])
    assert spread.agg(F.max(F.abs(F.col(model.prediction) - F.col("plain")))).first()[0] < 0.01


def test_condensed_rows_have_the_sums_of_all_rows(spark, tmp_path):
    df, (numeric, categorical) = _rows_with_gaps(spark)
    known = tips._with_numbers(df, numeric).filter("tip_amount IS NOT NULL")
    held = F.col("kind") == 1
    few = tips._condensed(known, held, numeric, categorical, "tip_amount", str(tmp_path / "few"))
    names = [*tips._numbers(numeric), "tip_amount"]
    means = known.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in names]).first()
    full = known.select("zone", held.alias("_held"), F.lit(1.0).alias("_weight"), *[
        F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(means[c])).alias(c) for c in names])

    def sums(rows):
        products = [F.sum(F.col("_weight") * F.col(a) * F.col(b)) for a in names for b in names]
        found = rows.groupBy("zone", "_held").agg(F.sum("_weight"), *[F.sum(F.col("_weight") * F.col(a)) for a in names], *products)
        return {(r[0], r[1]): list(r)[2:] for r in found.collect()}

    got, want = sums(few), sums(full)
    assert few.count() < known.count() / 4 and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-10) for k in want)
    assert few.filter("_number_always <> 7").count() == 0


def test_trials_do_not_read_all_rows(spark):
    df, (numeric, categorical) = _rows_with_gaps(spark)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    n = df.count()
    tips.tune(df.mapInArrow(counted, df.schema), numeric, categorical)
    assert n <= read.value <= 3 * n


def test_tuning_on_rows_that_do_not_condense(spark):
    df = spark.range(400).select(
        (F.col("id") % 10).cast("double").alias("x"), F.col("id").cast("string").alias("c"), (F.col("id") % 10 * 50.0).alias("y"))
    assert tips._condensed(tips._with_numbers(df, ["x"]), F.lit(False), ["x"], ["c"], "y", "/not/written") is None
    model, log = tips.tune(df, ["x"], ["c"], label="y", trials=2)
    assert len(log) == 2 and len(model.categories["c"]) == 400 and model.numbers["x"] > 0


def test_tuning_on_labels_that_are_no_numbers_is_an_error(spark):
    for odd in ("NaN", "Infinity"):
        df = spark.range(200).select(
            (F.col("id") % 7).cast("double").alias("x"), F.lit("a").alias("c"),
            F.when(F.col("id") == 5, float(odd)).otherwise(F.col("id") % 5).alias("y"))
        with pytest.raises(Exception, match="MUST NOT"):
            tips.tune(df, ["x"], ["c"], label="y", trials=1)


@pytest.mark.parametrize("last", [ranks.LAST, 1])
def test_exact_quantiles(spark, monkeypatch, last):
    monkeypatch.setattr(ranks, "LAST", last)
    monkeypatch.setattr(ranks, "BINS", 64)
    rng = np.random.default_rng(4)
    inf, nan = float("inf"), float("nan")
    samples = {
        "spread": rng.normal(0, 1, 500) * 10.0 ** rng.integers(-300, 300, 500), "whole": rng.integers(0, 5, 501).astype(float),
        "same": np.full(300, 3.5), "two": np.array([1.0, 1e308] * 100), "tiny": rng.integers(1, 9, 400) * 5e-324,
        "wide": np.array([-1.7e308, 1.7e308, 0.0, 5.0]), "odd": np.array([-inf, inf, inf, nan, 1.0]), "one": np.array([2.0]),
        "nan": np.array([nan, nan]),
    }
    n = max(map(len, samples.values()))
    rows = [tuple(float(v[i]) if i < len(v) else None for v in samples.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in samples)).withColumn("none", F.lit(None).cast("double"))
    for share in (0.5, 0.01, 1.0):
        got = ranks.quantile(df, {c: F.col(c) for c in df.columns}, share)
        for c, v in samples.items():
            assert repr(got[c]) == repr(float(np.sort(v)[int(np.ceil(share * len(v))) - 1])), (c, share)
        assert got["none"] is None


def test_median_of_two_million_rows(spark):
    df = spark.range(2_000_000).select(((F.col("id") * 1_234_577 % 2_000_003) / 7).alias("x"))
    wanted = np.sort(np.arange(2_000_000) * 1_234_577 % 2_000_003)[999_999] / 7
    assert ranks.quantile(df, {"x": F.col("x")}) == {"x": wanted}
    info = tips.feature_info(df, ["x"], [])
    assert info.first()["median"] == wanted


def _as_a_dense_matrix(rows, numeric, categorical, label):
    """Predictions of ordinary least squares, by numpy."""
    known = [r for r in rows if r[label] is not None]
    means = {c: np.mean([r[c] for r in known if r[c] is not None]) for c in numeric}
    values = [(c, v) for c in categorical for v in sorted({r[c] for r in known if r[c] is not None})]

    def line(row):
        return [1.0, *[means[c] if row[c] is None else row[c] for c in numeric], *[float(row[c] == v) for c, v in values]]

    weights = np.linalg.lstsq(np.array([line(r) for r in known]), np.array([r[label] for r in known]), rcond=None)[0]
    return {r["id"]: float(np.dot(line(r), weights)) for r in rows}


def test_wide_weights_agree_with_a_dense_solution(spark):
    draw = random.Random(5)
    rows = [{
        "id": i, "far": None if draw.random() < 0.05 else draw.gauss(0, 1), "fare": draw.gauss(50, 7),
        "zone": None if draw.random() < 0.1 else f"z{min(draw.randrange(60), 20)}", "kind": str(draw.randrange(4)),
        "tip": None if draw.random() < 0.1 else draw.gauss(2, 1),
    } for i in range(400)]
    df = spark.createDataFrame(rows, "id int, far double, fare double, zone string, kind string, tip double")
    model = wide.train(df, ["far", "fare"], ["zone", "kind"], label="tip")
    got = {r.id: r.predicted_tip for r in wide.predict(model, df).collect()}
    want = _as_a_dense_matrix(rows, ["far", "fare"], ["zone", "kind"], "tip")
    assert got == pytest.approx(want, abs=1e-10)
    assert model.weights.count() == 21 + 4


def test_wide_model_without_categories_numbers_or_spread(spark):
    df = spark.createDataFrame([(1.0, "a", 3.0), (2.0, "b", 5.0), (4.0, "a", 9.0)], "x double, c string, y double")
    line = wide.train(df, ["x"], [], label="y")
    assert (line.intercept + line.numbers["x"] * (10 - line.means["x"])) == pytest.approx(21)
    groups = wide.train(df, [], ["c"], label="y")
    assert [r.predicted_y for r in wide.predict(groups, df).sort("x").collect()] == pytest.approx([6, 5, 6])
    same = wide.train(df.withColumn("y", F.lit(4.0)), ["x"], ["c"], label="y")
    assert [r.predicted_y for r in wide.predict(same, df).collect()] == pytest.approx([4, 4, 4])
    unknown = spark.createDataFrame([(None, "new")], "x double, c string")
    assert wide.predict(same, unknown).first().predicted_y == pytest.approx(4)
    with pytest.raises(ValueError):
        wide.train(df.filter("false"), ["x"], ["c"], label="y")


def _odd_rows(spark):
    draw = random.Random(8)
    rows = [(
        i, draw.gauss(3, 2), draw.gauss(0, 1), f"z{min(draw.randrange(12), 7)}", str(draw.randrange(3)), draw.gauss(5, 4),
    ) for i in range(300)]
    return spark.createDataFrame(rows, "id int, x double, y double, zone string, kind string, tip double")


@pytest.mark.parametrize("l2", [0.1, 3.0])
def test_penalised_wide_weights_equal_those_of_the_solver(spark, l2):
    df = _odd_rows(spark)
    model = wide.train(df, ["x", "y"], ["zone", "kind"], label="tip", l2=l2)
    # The solver measures its penalty by the spread of the labels.
    spread = df.agg(F.stddev_pop("tip")).first()[0]
    other = tips.train(df, ["x", "y"], ["zone", "kind"], label="tip", regularisation=l2 * spread)
    assert model.numbers == pytest.approx(other.numbers, rel=1e-6)
    weights = {c: {} for c in ("zone", "kind")}
    for r in model.weights.collect():
        weights[r.feature][r.value] = r.weight
    for c, values in other.categories.items():
        assert weights[c] == pytest.approx(values, rel=1e-6, abs=1e-9)
    got = wide.predict(model, df).agg(F.avg(model.prediction)).first()[0]
    assert got == pytest.approx(df.agg(F.avg("tip")).first()[0])


def test_a_large_penalty_leaves_the_mean(spark):
    df = _odd_rows(spark)
    model = wide.train(df, ["x"], ["zone"], label="tip", l2=1e12)
    mean = df.agg(F.avg("tip")).first()[0]
    assert wide.predict(model, df).agg(F.max(F.abs(F.col(model.prediction) - mean))).first()[0] < 1e-6
    with pytest.raises(ValueError):
        wide.train(df, ["x"], ["zone"], label="tip", l2=-1.0)


def test_wide_explanations_add_up(spark):
    df = _odd_rows(spark)
    model = wide.train(df, ["x", "y"], ["zone", "kind"], label="tip", l2=0.1)
    odd = spark.createDataFrame([(-1, None, float("nan"), None, "new", None)], df.schema)
    explained = wide.explain(model, df.unionByName(odd), top_features=4)
    total = F.col("baseline_prediction_value") + F.aggregate(
        "top_feature_attributions", F.lit(0.0), lambda s, a: s + a["attribution"])
    assert explained.agg(F.max(F.abs(total - F.col(model.prediction)))).first()[0] < 1e-9
    unknown = explained.filter("id = -1").first()
    assert [(a.feature, a.attribution) for a in unknown.top_feature_attributions] == [
        ("kind", 0.0), ("x", 0.0), ("y", 0.0), ("zone", 0.0)]
    for r in wide.explain(model, df, top_features=2).collect():
        sizes = [abs(a.attribution) for a in r.top_feature_attributions]
        assert len(sizes) == 2 and sizes == sorted(sizes, reverse=True)


def test_wide_tuning(spark):
    df = _odd_rows(spark)
    model, trials = wide.tune(df, F.col("id") % 5 == 0, ["x", "y"], ["zone", "kind"], label="tip", candidates=[0.0, 1.0, 100.0])
    for t in trials:
        alone = wide.train(df.filter("id % 5 <> 0"), ["x", "y"], ["zone", "kind"], label="tip", l2=t.l2)
        judged = tips.evaluate(wide.predict(alone, df.filter("id % 5 = 0")), "tip").first()
        assert t.mean_squared_error == pytest.approx(judged.mean_squared_error)
    best = min(trials, key=lambda t: t.mean_squared_error)
    again = wide.train(df, ["x", "y"], ["zone", "kind"], label="tip", l2=best.l2)
    assert model.numbers == pytest.approx(again.numbers)
    with pytest.raises(ValueError):
        wide.tune(df, F.lit(False), ["x"], [], label="tip", candidates=[1.0])
