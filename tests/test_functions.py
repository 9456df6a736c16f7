import datetime as dt
import decimal
import math
import random

import pytest
from pyspark.sql import functions as F

from wayfare.functions import columns, numbers, strings, times
from wayfare.schemas import ddl


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in KINDS.items() if k in values))
    return df.select(column.alias("x")).first().x


KINDS = {"t": "string", "d": "double", "e": "double"}


@pytest.mark.parametrize("text, wanted", [
    (" boston celtics ", "Boston Celtics"), ("ST-LOUIS no.7/x_y o'neil", "St-Louis No.7/X_Y O'neil"),
    ("a\tb  c", "A\tB  C"), ("", ""), (None, None), ("(la) \"b\"&c", '(La) "B"&C'), ("été-là", "Été-Là"),
])
def test_title_case(spark, text, wanted):
    assert one(spark, strings.title_case("t"), t=text) == wanted


def code(text):
    """The rule, a row at a time."""
    if text is None or not text[1:].isdigit():
        return None
    number = int(text[1:])
    return ("s/" if number % 7 == 0 else "a/" if number % 3 == 0 else "e/") + f"{number:03x}"


def test_base_code_and_its_udf(spark):
    texts = [f"B{n:05d}" for n in (*range(0, 130), 2884, 99999, 1048576)] + ["B", "", "Bxy", "B12.5", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", strings.base_code("t").alias("a"), strings.base_code_udf("t").alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(code(t), code(t)) for t in texts]


@pytest.mark.parametrize("text, wanted", [
    ("12", 12), (" -7 ", -7), ("12.5", None), ("abc", None), ("", None), (None, None), ("99999999999999999999", None),
])
def test_text_to_whole(spark, text, wanted):
    assert one(spark, numbers.text_to_whole("t"), t=text) == wanted


@pytest.mark.parametrize("text, wanted", [("1.5", 1.5), (".5", 0.5), ("2", 2.0), ("1e3", 1000.0), ("x", None), ("NaN", None)])
def test_text_to_double(spark, text, wanted):
    assert one(spark, numbers.text_to_double("t"), t=text) == wanted


def test_safe_divide(spark):
    assert one(spark, numbers.safe_divide("d", "e"), d=1.0, e=0.0) is None
    assert one(spark, numbers.safe_divide("d", "e"), d=1.0, e=4.0) == 0.25


def test_money_is_exact_in_any_order(spark):
    amounts = [0.1, 0.2, -0.3, 1e9, 0.01, -1e9, None] * 500
    for parts in (1, 7):
        df = spark.createDataFrame([(a,) for a in amounts], "d double").repartition(parts)
        row = df.agg(numbers.money_sum("d").alias("s"), numbers.money_avg("d").alias("m")).first()
        assert row.s == 5.0 and row.m == 5.0 / 3000
    empty = spark.createDataFrame([(None,)], "d double")
    assert empty.agg(numbers.money_sum("d").alias("s"), numbers.money_avg("d").alias("m")).first() == (None, None)


def test_money_keeps_fractions_of_a_cent(spark):
    df = spark.createDataFrame([(0.004,)] * 3, "d double")
    assert df.agg(numbers.money_sum("d").alias("s")).first().s == 0.012


def test_one_nan_makes_the_sum_nan(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "d double")
    assert math.isnan(df.agg(numbers.money_sum("d").alias("s")).first().s)


INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize("amounts, total", [
    ([INF, 1.0], INF), ([-INF, 4.0], -INF), ([INF, -INF], NAN), ([NAN, INF], NAN), ([1e30, 1.0], 1e30), ([9e28] * 20, math.fsum([9e28] * 20)),
    ([-1e30, 1.0, 1e30, 2.5], 3.5), ([1e18, -1e18, 0.3], 0.3), ([2.0**60, 2.0**61, -5.0], 3 * 2.0**60), ([0.1, 0.2], 0.3),
    ([-0.5, 0.25], -0.25), ([1e300, 5.0], 1e300), ([1e15, 1e15, 0.25], 2e15 + 0.25), ([None], None), ([], None), ([-1e-9] * 3, -3e-9),
])
def test_money_of_any_size(spark, amounts, total):
    df = spark.createDataFrame([(a,) for a in amounts], "d double")
    got = df.agg(numbers.money_sum("d").alias("s")).first().s
    assert repr(got) == repr(total)


def test_large_money_is_free_of_order(spark):
    draw = random.Random(3)
    amounts = [draw.uniform(-1, 1) * 10 ** draw.randint(-3, 29) for _ in range(2000)]
    totals = set()
    for _ in range(4):
        draw.shuffle(amounts)
        df = spark.createDataFrame([(a,) for a in amounts], "d double").repartition(draw.randint(1, 6))
        totals.add(df.agg(numbers.money_sum("d").alias("s")).first().s)
    assert len(totals) == 1 and totals.pop() == pytest.approx(math.fsum(amounts), rel=1e-15)


def test_cents_round_away_from_zero(spark):
    for amount, wanted in ((1.005, "1.01"), (1.01, "1.01"), (-2.345, "-2.35")):
        assert one(spark, numbers.cents("d"), d=amount) == decimal.Decimal(wanted)
    assert one(spark, numbers.cents("d"), d=float("nan")) is None


@pytest.mark.parametrize("text, wanted", [("18000.0", 18000), ("12.7", 12), ("-1.9", -1), (" 5 ", 5), ("1e3", 1000), ("x", None)])
def test_whole_numbers_with_decimals(spark, text, wanted):
    assert one(spark, numbers.text_to_whole("t", "int", decimals=True), t=text) == wanted


@pytest.mark.parametrize("text, wanted", [
    ("2025-10-01 00:20:00", dt.datetime(2025, 10, 1, 0, 20)), ("2025-10-01 00:20:00.5", dt.datetime(2025, 10, 1, 0, 20)),
    ("2025-13-01 00:00:00", None), ("soon", None), (None, None),
])
def test_parse_time(spark, text, wanted):
    assert one(spark, times.parse_time("t"), t=text) == wanted


@pytest.mark.parametrize("text, wanted", [
    ("2019-10-22 00:00:00", dt.date(2019, 10, 22)), ("2019-10-22", dt.date(2019, 10, 22)), ("never", None),
])
def test_parse_date(spark, text, wanted):
    assert one(spark, times.parse_date("t"), t=text) == wanted


def test_interval_holds_its_start_and_not_its_end(spark, ts):
    df = spark.createDataFrame([(ts(t),) for t in ("2024-01-01", "2024-01-31T23:59:59.999999", "2024-02-01")], "t timestamp")
    df = df.union(spark.createDataFrame([(None,)], "t timestamp"))
    for condition in (
        times.in_interval("t", "2024-01-01", dt.date(2024, 2, 1)), times.in_month("t", 2024, 1),
        times.in_interval("t", "2024-01-01T00:00:00+00:00", dt.datetime(2024, 2, 1)),
    ):
        assert df.filter(condition).count() == 2
    assert df.filter(times.on_day("t", "2024-01-31")).count() == 1
    assert df.filter(times.in_year("t", 2024)).count() == 3


def test_month_start_of_both_kinds_of_time(spark, ts):
    df = spark.createDataFrame([(ts("2024-02-29T12:00:00"),)], "t timestamp")
    for column in ("t", F.col("t").cast("timestamp_ntz")):
        assert df.select(times.month_start(column).alias("m")).first().m == dt.datetime(2024, 2, 1)


def test_millis_there_and_back(spark, ts):
    df = spark.createDataFrame([(ts("2024-02-29T12:00:00.123"),)], "t timestamp")
    millis = df.select(times.to_millis("t").alias("m"), "t")
    assert millis.first().m == 1709208000123
    assert millis.select(times.from_millis("m").alias("t")).first().t == ts("2024-02-29T12:00:00.123")


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "lpep_pickup_datetime int, ` a b ` int, pulocationid int")
    assert columns.underscore_names(df).columns == ["lpep_pickup_datetime", "a_b", "pulocationid"]
    resolved = columns.resolve_aliases(df, {"pickup": ("tpep_pickup_datetime", "lpep_pickup_datetime"), "zone": ("PU",)})
    assert resolved.columns == ["pickup", " a b ", "pulocationid"]
    assert columns.keep_present(resolved, ["zone", "pulocationid", "pickup"]).columns == ["pulocationid", "pickup"]
    assert columns.common_columns(df, resolved) == [" a b ", "pulocationid"]


def test_casts_never_raise(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01", 1 << 40), ("y", "1.5", "?", 5)], "a string, b string, c string, d long")
    cast = columns.cast_to(df, ddl("a int, b double, c timestamp, d int"))
    assert [tuple(r) for r in cast.collect()] == [
        (1, None, dt.datetime(2024, 1, 1), None), (None, 1.5, None, 5)]


def test_union_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "z int, x int")
    assert sorted(map(tuple, columns.union_by_name([a, b]).collect()), key=str) == [(1, 2, None), (4, None, 3)]
