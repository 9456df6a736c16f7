from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wayfare.functions.numbers import as_column, text_to_whole

# The punctuation that starts a new word, besides white space.
WORD_DELIMITERS = r"""[](){}/|\<>!?@"^#$&~_,.:;*%+-"""

_DELIMITER_CLASS = "[" + "".join("\\" + c for c in WORD_DELIMITERS) + "]"

_JOINT = "\ue000 "  # a private-use character and a blank: in no name


def clean_code(text: Column | str) -> Column:
    """Upper-case code without surrounding blanks."""
    return F.upper(F.trim(as_column(text)))


def title_case(text: Column | str) -> Column:
    """First letter of every word in upper case, the rest in lower case.

    A word starts after white space or after any of ``WORD_DELIMITERS``.
    Spark's ``initcap`` starts words behind blanks only, so texts with
    punctuation get a joint with a blank behind each mark and lose it again.
    """
    trimmed = F.trim(as_column(text))
    joint = F.lit(_JOINT)
    spaced = F.regexp_replace(trimmed, rf"({_DELIMITER_CLASS}|[^\S ])", "$1" + _JOINT)
    return F.replace(F.initcap(spaced), joint, F.lit(""))


def base_code(base_number: Column | str) -> Column:
    """Class letter and three hex digits from a base number such as ``B02884``.

    Multiples of 7 give ``s/``, other multiples of 3 ``a/``, the rest ``e/``.
    NULL where the part behind the first letter is no whole number.
    """
    text = as_column(base_number)
    number = text_to_whole(text.substr(F.lit(2), F.length(text)))
    letter = (
        F.when(number % 7 == 0, F.lit("s/"))
        .when(number % 3 == 0, F.lit("a/"))
        .otherwise(F.lit("e/"))
    )
    return F.when(number.isNotNull(), F.concat(letter, F.format_string("%03x", number)))


@F.pandas_udf(StringType())
def base_code_udf(base_number: pd.Series) -> pd.Series:
    """``base_code`` over Arrow batches: the UDF form, kept for comparison.

    Prefer ``base_code``; this one leaves the JVM for every batch.
    """
    digits = base_number.str[1:]
    number = digits.where(digits.str.fullmatch(r"[0-9]+").fillna(False).astype(bool)).astype("Int64")
    shown = number.map(lambda n: format(int(n), "03x"), na_action="ignore")
    letter = pd.Series("e/", index=number.index)
    letter = letter.mask((number % 3 == 0).fillna(False), "a/")
    letter = letter.mask((number % 7 == 0).fillna(False), "s/")
    return (letter + shown.astype("object")).where(number.notna(), None)
