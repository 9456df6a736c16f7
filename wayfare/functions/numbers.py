from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, NULL where the denominator is zero."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def cents(amount: Column | str) -> Column:
    """A money amount to two decimals, halves away from zero; NULL stays NULL, and what is no number becomes it."""
    return F.round(as_column(amount), 2).try_cast("decimal(38,9)")


#: Amounts below go in whole units and billionths; larger ones in multiples of this and a rest.
_UNIT_RANGE = 2.0**50
_MULTIPLE_RANGE = 2.0**100


def money_sum(amount: Column | str) -> Column:
    """Sum of amounts with up to nine decimals, exact and free of order.

    Adding doubles gives another last digit whenever rows arrive in another
    order, as after a lost executor.  Here every amount is split into whole
    numbers, which add up the same in any order: units and billionths in two
    long lanes, and multiples of 2**50 (1.1e15) in a lane of doubles, where
    whole numbers are exact as long as such amounts come to less than 1e31.
    That lane also takes what is larger than 2**100 or not finite: an infinite
    amount, both infinities or one NaN have the effect that they have on a sum
    of doubles.  Units beyond the range of a long are an error.
    """
    value = as_column(amount).cast("double")
    size = F.abs(value)  # NaN counts as larger than any number
    rest = F.when(size < _UNIT_RANGE, value).when(size < _MULTIPLE_RANGE, value % _UNIT_RANGE)
    units = rest.cast("long")
    low, parts = F.sum(units), F.sum(F.rint((rest - units) * 1e9).cast("long"))
    multiples = F.sum(F.when(size >= _UNIT_RANGE, (value - F.coalesce(rest, F.lit(0.0))) / _UNIT_RANGE))
    near = (low + parts * F.lit("0.000000001").cast("decimal(9,9)")).cast("double")
    far = multiples * _UNIT_RANGE
    return F.when(multiples.isNull(), near).otherwise(F.coalesce(far + near, far))


def money_avg(amount: Column | str) -> Column:
    """Mean from ``money_sum``; NULL for an all-NULL group."""
    return safe_divide(money_sum(amount), F.count(as_column(amount)))


def round_to_long(value: Column | str) -> Column:
    return F.round(as_column(value)).cast("long")


# Text forms of numbers; blanks around them are allowed.
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def text_to_whole(text: Column | str, kind: str = "long", decimals: bool = False) -> Column:
    """Whole number from text, NULL where it is none or does not fit.

    ``decimals`` also takes text with decimals and cuts them off towards zero.
    The pattern goes first because a cast that fails costs an exception, some
    twenty microseconds a row, even where it is caught.
    """
    text = as_column(text)
    whole = F.when(text.rlike(_WHOLE), text.try_cast(kind))
    if not decimals:
        return whole
    return whole.when(text.rlike(_DECIMAL), F.trim(text).try_cast("decimal(38,9)").try_cast(kind))


def text_to_double(text: Column | str) -> Column:
    """Double from text, NULL where it is no finite number."""
    text = as_column(text)
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))
