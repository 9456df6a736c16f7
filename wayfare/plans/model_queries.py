"""The tip model on line items, with SQL where a closed form exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import tips, wide
from wayfare.plans import bindings as b
from wayfare.plans.registry import query

_FEATURES = f"""SELECT passenger_count, trip_distance, CAST("PULocationID" AS VARCHAR) AS "PULocationID",
    CAST("DOLocationID" AS VARCHAR) AS "DOLocationID", payment_type, fare_amount, tolls_amount, tip_amount
  FROM {b.TRIPS} WHERE fare_amount <> 0"""


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tips.tip_features(b.trips(spark, sf_dir))


@query(_FEATURES)
def tip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


def _sql_number(column: str) -> str:
    return f"""SELECT '{column}' AS input, CAST(MIN({column}) AS DOUBLE) AS min, CAST(MAX({column}) AS DOUBLE) AS max,
      ROUND(AVG({column}), 7) AS mean, CAST(quantile_disc({column}, 0.5) AS DOUBLE) AS median,
      ROUND(stddev_samp({column}), 6) AS stddev, CAST(NULL AS BIGINT) AS category_count,
      COUNT(*) FILTER (WHERE {column} IS NULL) AS null_count FROM f"""


def _sql_category(column: str) -> str:
    return f"""SELECT '{column}', NULL, NULL, NULL, NULL, NULL, COUNT(DISTINCT "{column}"),
      COUNT(*) FILTER (WHERE "{column}" IS NULL) FROM f"""


@query(f"WITH f AS ({_FEATURES}) " + " UNION ALL ".join(
    [*map(_sql_number, tips.NUMERIC), *map(_sql_category, tips.CATEGORICAL)]))
def feature_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = tips.feature_info(_features(spark, sf_dir))
    return info.withColumns({"mean": F.round("mean", 7), "stddev": F.round("stddev", 6)})


def _one_feature(spark: SparkSession, sf_dir: str) -> tuple[tips.TipModel, DataFrame]:
    """Price from quantity, trained on all rows."""
    rows = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return tips.train(rows, ["l_quantity"], [], label="l_extendedprice"), rows


_LINE = """line AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope,
    regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)"""


@query(f"""WITH {_LINE} SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
    ROUND(intercept + slope * l_quantity, 3) AS predicted_l_extendedprice FROM lineitem, line""")
def line_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = _one_feature(spark, sf_dir)
    return tips.predict(model, rows).withColumn(model.prediction, F.round(model.prediction, 3))


@query(f"""WITH {_LINE}, p AS (SELECT l_extendedprice AS y, intercept + slope * l_quantity AS p FROM lineitem, line)
    SELECT ROUND(AVG(abs(y - p)), 3) AS mean_absolute_error, ROUND(AVG((y - p) * (y - p)), 1) AS mean_squared_error,
      ROUND(AVG((ln(1 + y) - ln(1 + p)) ** 2) FILTER (WHERE y > -1 AND p > -1), 6) AS mean_squared_log_error,
      ROUND(quantile_disc(abs(y - p), 0.5), 3) AS median_absolute_error,
      ROUND(1 - AVG((y - p) * (y - p)) / var_pop(y), 6) AS r2_score,
      ROUND(1 - var_pop(y - p) / var_pop(y), 6) AS explained_variance FROM p""")
def line_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = _one_feature(spark, sf_dir)
    measured = tips.evaluate(tips.predict(model, rows), "l_extendedprice")
    digits = {"mean_absolute_error": 3, "mean_squared_error": 1, "mean_squared_log_error": 6, "median_absolute_error": 3,
              "r2_score": 6, "explained_variance": 6}
    return measured.select(*[F.round(c, n).alias(c) for c, n in digits.items()])


def _trained(spark: SparkSession, sf_dir: str) -> tuple[tips.TipModel, DataFrame]:
    rows = _features(spark, sf_dir)
    return tips.train(tips.split(rows, rows.columns)[0]), rows


@query()
def tip_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = _trained(spark, sf_dir)
    return tips.predict(model, rows)


@query()
def tip_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over every row with a known label."""
    model, rows = _trained(spark, sf_dir)
    return tips.evaluate(tips.predict(model, rows))


# One category alone: the weights are the means of its values, so SQL has the
# prediction, its parts and its errors.

_GROUPS = """flag AS (SELECT l_returnflag, AVG(l_extendedprice) AS mean FROM lineitem GROUP BY 1)"""


def _one_category(spark: SparkSession, sf_dir: str) -> tuple[tips.TipModel, DataFrame]:
    rows = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return tips.train(rows, [], ["l_returnflag"], label="l_extendedprice"), rows


@query(f"""WITH {_GROUPS} SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
    ROUND(mean, 3) AS predicted_l_extendedprice FROM lineitem JOIN flag USING (l_returnflag)""")
def category_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = _one_category(spark, sf_dir)
    return tips.predict(model, rows).withColumn(model.prediction, F.round(model.prediction, 3))


@query(f"""WITH {_LINE}, mean AS (SELECT AVG(l_quantity) AS q FROM lineitem)
    SELECT l_orderkey, l_linenumber, 'l_quantity' AS feature, ROUND(slope * (l_quantity - q), 3) AS attribution,
      ROUND(intercept + slope * q, 3) AS baseline_prediction_value, 0.0::DOUBLE AS approximation_error
    FROM lineitem, line, mean""")
def line_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = _one_feature(spark, sf_dir)
    explained = tips.explain(model, rows)
    first = F.col("top_feature_attributions")[0]
    return explained.select(
        "l_orderkey", "l_linenumber", first["feature"].alias("feature"),
        F.round(first["attribution"], 3).alias("attribution"),
        F.round("baseline_prediction_value", 3).alias("baseline_prediction_value"), "approximation_error",
    )


@query()
def tip_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = _trained(spark, sf_dir)
    return tips.explain(model, rows)


@query()
def tip_tuned_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir)
    model, _ = tips.tune(rows)
    return tips.predict(model, rows)


# Category weights in a table. With one category and one number SQL has the closed form: the slope within the values,
# and what is left of each value's mean.


@query("""WITH g AS (SELECT l_partkey, AVG(l_quantity) AS q, AVG(l_extendedprice) AS p FROM lineitem GROUP BY 1),
    s AS (SELECT SUM((l_quantity - q) * (l_extendedprice - p)) / SUM((l_quantity - q) ** 2) AS slope
      FROM lineitem JOIN g USING (l_partkey))
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, ROUND(p + slope * (l_quantity - q), 3)
      AS predicted_l_extendedprice FROM lineitem JOIN g USING (l_partkey), s""")
def wide_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price from quantity and part: as many weights as there are parts, none of them on the driver."""
    rows = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    model = wide.train(rows, ["l_quantity"], ["l_partkey"], label="l_extendedprice")
    return wide.predict(model, rows.drop("l_extendedprice")).withColumn(model.prediction, F.round(model.prediction, 3))


# The normal equations of all features in SQL: sums of products, then elimination one feature a step. Each category
# leaves out its first value, so that the equations have one solution; Spark's predictions don't depend on that choice.

# ROUND leaves a negative zero in SQL and none in Spark, hence the + 0.0 where parts are small.
# With a penalty no value is left out, and the diagonal grows by the penalty times rows and variance.

_GRIDS = """names AS (SELECT name, row_number() OVER (ORDER BY name) AS i FROM (SELECT DISTINCT name FROM x)),
  entries AS (SELECT id, i, x FROM x JOIN names USING (name)),
  learned AS (SELECT entries.* FROM entries JOIN f USING (id) WHERE NOT held),
  products AS (SELECT a.i AS i, c.i AS j, SUM(a.x * c.x) AS v, CASE WHEN a.i = c.i THEN
      SUM(a.x * a.x) - SUM(a.x) * SUM(a.x) / (SELECT COUNT(*) FROM f WHERE NOT held) ELSE 0.0 END AS spread
    FROM learned a JOIN learned c USING (id) GROUP BY 1, 2
    UNION ALL SELECT i, (SELECT COUNT(*) + 1 FROM names), SUM(x * y), 0.0 FROM learned JOIN f USING (id) GROUP BY 1),
  grid AS (SELECT l2, r.i AS i, c.j AS j, COALESCE(v + l2 * spread, 0.0) AS v FROM penalties CROSS JOIN names r
    CROSS JOIN (SELECT unnest(range(1, (SELECT COUNT(*) + 2 FROM names))) AS j) c LEFT JOIN products USING (i, j)),
  grids AS (SELECT l2, 0::BIGINT AS k, list(line ORDER BY i) AS m
      FROM (SELECT l2, i, list(v ORDER BY j) AS line FROM grid GROUP BY l2, i) GROUP BY l2
    UNION ALL SELECT l2, k + 1, list_transform(m, lambda line, i: CASE
      WHEN i = k + 1 THEN list_transform(line, lambda v: v / m[k + 1][k + 1])
      ELSE list_transform(line, lambda v, j: v - line[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END)
    FROM grids WHERE k < len(m)),
  solved AS (SELECT l2, unnest(list_transform(m, lambda line: line[-1])) AS w, generate_subscripts(m, 1) AS i
    FROM grids WHERE k = len(m)),
  p AS (SELECT l2, id, SUM(x * w) AS p FROM entries JOIN solved USING (i) GROUP BY l2, id)"""


def _all(l2: float) -> str:
    """All features of the tip model; every row is learned from."""
    from_value = '"{0}" IS NOT NULL' if l2 else '"{0}" > (SELECT MIN("{0}") FROM f)'
    return f"""f AS (SELECT row_number() OVER () AS id, false AS held, tip_amount AS y, * FROM ({_FEATURES})),
  penalties AS (SELECT {l2}::DOUBLE AS l2),
  x AS (SELECT id, ' one' AS name, 1.0::DOUBLE AS x FROM f
    {" ".join(f"UNION ALL SELECT id, ' {c}', COALESCE({c}, AVG({c}) OVER ()) FROM f" for c in tips.NUMERIC)}
    {" ".join(f"""UNION ALL SELECT id, '{c}=' || "{c}", 1.0 FROM f WHERE {from_value.format(c)}"""
              for c in tips.CATEGORICAL)}),
  {_GRIDS}"""


def _wide(spark: SparkSession, sf_dir: str) -> tuple[wide.WideModel, DataFrame]:
    """All features, trained on all rows."""
    rows = _features(spark, sf_dir)
    return wide.train(rows), rows


@query(f"""WITH RECURSIVE {_all(0.0)} SELECT passenger_count, trip_distance, "PULocationID", "DOLocationID", payment_type,
    fare_amount, tolls_amount, tip_amount, ROUND(p, 5) AS predicted_tip_amount FROM f JOIN p USING (id)""")
def wide_tip_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = _wide(spark, sf_dir)
    return wide.predict(model, rows).withColumn(model.prediction, F.round(model.prediction, 5))


@query(f"""WITH RECURSIVE {_all(0.0)}, e AS (SELECT tip_amount AS y, p FROM f JOIN p USING (id))
    SELECT ROUND(AVG(abs(y - p)), 6) AS mean_absolute_error, ROUND(AVG((y - p) ** 2), 9) AS mean_squared_error,
      ROUND(AVG((ln(1 + y) - ln(1 + p)) ** 2) FILTER (WHERE y > -1 AND p > -1), 9) AS mean_squared_log_error,
      ROUND(quantile_disc(abs(y - p), 0.5), 6) AS median_absolute_error,
      ROUND(1 - AVG((y - p) ** 2) / var_pop(y), 6) AS r2_score,
      ROUND(1 - var_pop(y - p) / var_pop(y), 6) AS explained_variance FROM e""")
def wide_tip_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the all-feature model over every row with a known label."""
    model, rows = _wide(spark, sf_dir)
    measured = tips.evaluate(wide.predict(model, rows))
    return measured.select(*[F.round(c, 9 if "squared" in c else 6).alias(c) for c in measured.columns])


#: Penalty of the model that is explained: it has one solution, so weights can be held against SQL's.
_L2 = 0.1


def _sql_shares() -> str:
    numbers = [
        f"""SELECT id, '{c}' AS feature, w * (COALESCE({c}, AVG({c}) OVER ()) - AVG({c}) OVER ()) AS share
        FROM f, (SELECT w FROM solved JOIN names USING (i) WHERE name = ' {c}')""" for c in tips.NUMERIC]
    categories = [
        f"""SELECT id, '{c}', COALESCE(w, 0.0) FROM f LEFT JOIN (SELECT w, name FROM solved JOIN names USING (i))
        ON name = '{c}=' || "{c}\"""" for c in tips.CATEGORICAL]
    return " UNION ALL ".join([*numbers, *categories])


@query(f"""WITH RECURSIVE {_all(_L2)}, shares AS ({_sql_shares()}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(share) DESC, feature) AS place FROM shares),
    parts AS (SELECT id, SUM(share) AS total, {", ".join(f"MAX(feature) FILTER (WHERE place = {k}) AS feature_{k}, "
      f"ROUND(MAX(share) FILTER (WHERE place = {k}), 5) + 0.0 AS attribution_{k}" for k in (1, 2, 3))} FROM ranked GROUP BY id)
    SELECT passenger_count, trip_distance, "PULocationID", "DOLocationID", payment_type, fare_amount, tolls_amount, tip_amount,
      ROUND(p, 5) + 0.0 AS predicted_tip_amount, ROUND(p - total, 5) + 0.0 AS baseline_prediction_value, 0.0::DOUBLE AS approximation_error,
      feature_1, attribution_1, feature_2, attribution_2, feature_3, attribution_3
    FROM f JOIN p USING (id) JOIN parts USING (id)""")
def wide_tip_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three features that moved each prediction of the penalised model most."""
    rows = _features(spark, sf_dir)
    model = wide.train(rows, l2=_L2)
    best = F.col("top_feature_attributions")
    return wide.explain(model, rows).select(
        *rows.columns, F.round(model.prediction, 5).alias(model.prediction),
        F.round("baseline_prediction_value", 5).alias("baseline_prediction_value"), "approximation_error",
        *[c for k in (1, 2, 3) for c in (
            best[k - 1]["feature"].alias(f"feature_{k}"), F.round(best[k - 1]["attribution"], 5).alias(f"attribution_{k}"))],
    )


# Tuning: SQL learns and judges every candidate. One without a penalty would leave SQL without a single solution.

_STRENGTHS = (0.01, 0.1, 1.0, 10.0)
_TUNED_ON = (("l_quantity", "l_discount"), ("l_linestatus", "l_returnflag"))
_HELD = "substr(md5(CAST(l_orderkey AS {text})), 1, 1) IN ('0', '1', '2')"

_TUNED = f"""f AS (SELECT row_number() OVER () AS id, {_HELD.format(text="VARCHAR")} AS held, l_extendedprice AS y, * FROM lineitem),
  penalties AS (SELECT unnest([{", ".join(f"{v}::DOUBLE" for v in _STRENGTHS)}]) AS l2),
  x AS (SELECT id, ' one' AS name, 1.0::DOUBLE AS x FROM f
    {" ".join(f"UNION ALL SELECT id, ' {c}', COALESCE({c}, (SELECT AVG({c}) FROM f WHERE NOT held)) FROM f" for c in _TUNED_ON[0])}
    {" ".join(f"UNION ALL SELECT id, '{c}=' || {c}, 1.0 FROM f WHERE {c} IS NOT NULL" for c in _TUNED_ON[1])}),
  {_GRIDS}"""


@query(f"""WITH RECURSIVE {_TUNED}, e AS (SELECT l2, AVG((y - p) ** 2) AS e FROM p JOIN f USING (id) WHERE held GROUP BY l2)
    SELECT l2, ROUND(e, 1) AS mean_squared_error, ROUND(e, 1) = (SELECT ROUND(MIN(e), 1) FROM e) AS chosen FROM e""")
def wide_tuned_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of each penalty on the orders held out, three sixteenths of all; price from amount, discount, status and flag."""
    numeric, categorical = _TUNED_ON
    rows = b.table(spark, sf_dir, "lineitem").select("l_orderkey", *numeric, *categorical, "l_extendedprice")
    trials = wide.tune(
        rows, F.expr(_HELD.format(text="STRING")), numeric, categorical, label="l_extendedprice", candidates=_STRENGTHS)[1]
    least = min(t.mean_squared_error for t in trials)
    found = spark.createDataFrame([(t.l2, t.mean_squared_error, t.mean_squared_error == least) for t in trials],
                                  "l2 double, mean_squared_error double, chosen boolean")
    return found.withColumn("mean_squared_error", F.round("mean_squared_error", 1))
