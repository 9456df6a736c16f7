"""Documents on their way through an operator that adds columns: their own can't meet those by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEY, TEXT, REST = "_key", "_text", "_rest"


def packed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The id, the text, and all other columns as one struct."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (key, text)]
    return docs.select(F.col(key).alias(KEY), F.col(text).alias(TEXT), (F.struct(*rest) if rest else F.lit(0)).alias(REST))


def columns(docs: DataFrame, key: str, text: str) -> list[Column]:
    """The documents' own columns, taken out of packed rows."""
    own = {key: F.col(KEY), text: F.col(TEXT)}
    return [(own[c] if c in own else F.col(REST)[c]).alias(c) for c in docs.columns]


def unpacked(rows: DataFrame, docs: DataFrame, key: str, text: str, new_text: Column | None = None) -> DataFrame:
    """Back to the columns of the documents, with another text where one is given."""
    own = {key: F.col(KEY), text: F.col(TEXT) if new_text is None else new_text}
    return rows.select(*((own[c] if c in own else F.col(REST)[c]).alias(c) for c in docs.columns))
