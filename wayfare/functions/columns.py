"""Helpers on column lists; they run while the plan is built, not on rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType, StringType, StructType

from wayfare.functions.numbers import text_to_double, text_to_whole


def underscore_names(df: DataFrame) -> DataFrame:
    """Strip blanks around names and put ``_`` for those inside."""
    return df.toDF(*[name.strip().replace(" ", "_") for name in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def resolve_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first existing candidate of each target to the target's name.

    Names are compared exactly: ``PULocationID`` and ``pulocationid`` differ.
    """
    present = set(df.columns)
    found = {}
    for target, candidates in aliases.items():
        hit = next((c for c in candidates if c in present), None)
        if hit is not None and hit != target:
            found[hit] = target
    return df.withColumnsRenamed(found)


def keep_present(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """The preferred columns that exist, in the preferred order."""
    present = set(df.columns)
    return df.select(*[c for c in preferred if c in present])


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both frames have, in the order of the left one."""
    other = set(right.columns)
    return [c for c in left.columns if c in other]


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Provenance columns holding one value in every row."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def tolerant_cast(df: DataFrame, name: str, kind: DataType) -> Column:
    """A column of the frame as another type, bad values as NULL."""
    column = F.col(f"`{name}`")
    if df.schema[name].dataType == StringType():
        if isinstance(kind, IntegralType):
            return text_to_whole(column, kind.simpleString(), decimals=True).alias(name)
        if isinstance(kind, (DoubleType, FloatType)):
            return text_to_double(column).cast(kind).alias(name)
    return column.try_cast(kind).alias(name)


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast the columns the schema names, bad values to NULL; leave the rest."""
    wanted = {f.name: f.dataType for f in schema.fields}
    return df.select(*[tolerant_cast(df, c, wanted[c]) if c in wanted else F.col(f"`{c}`") for c in df.columns])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose columns differ; absent ones become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
