"""Lookup helpers on JSON text columns (L1 / L2 as Column functions).

Values come back as text: a JSON number ``9`` is ``"9"``, a nested object
its JSON text. All of it is built-in JSON functions, evaluated per row in
the JVM.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON_MAP = "map<string,string>"


def json_value(col: str | Column, key: str) -> Column:
    """L1 on data: the value stored under ``key`` in a JSON object column."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_element_at(F.from_json(c, JSON_MAP), F.lit(key))


def json_pairs(col: str | Column) -> Column:
    """L2 on data: the object as ``map<string,string>`` (null if not an object)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, JSON_MAP)


def explode_pairs(df: DataFrame, col: str, keep: list[str], key_col: str = "key", value_col: str = "value") -> DataFrame:
    """One row per ``(key, value)`` of a JSON object column, next to ``keep``."""
    return df.select(*keep, F.explode(json_pairs(col)).alias(key_col, value_col))


_NUMBER = r"^\s*([+-]?)([0-9]*)(?:[.]([0-9]*))?(?:[eE]([+-]?[0-9]+))?\s*$"
_HAS_DIGIT = r"^\s*[+-]?[.]?[0-9]"


def number_key(text: Column) -> Column:
    """One text for all spellings of a number's exact value (``9``, ``9.0``, ``90e-1``), null for other texts.

    The significant digits and the power of ten they are multiplied with: nothing is rounded, however long.
    """

    def part(n: int) -> Column:
        return F.regexp_extract(text, _NUMBER, n)

    power = F.when(part(4) == "", F.lit(0).cast("decimal(38,0)")).otherwise(part(4).try_cast("decimal(38,0)"))
    digits = F.regexp_replace(F.concat(part(2), part(3)), "^0+", "")
    short = F.regexp_replace(digits, "0+$", "")
    scaled = power - F.length(part(3)) + F.length(digits) - F.length(short)
    key = F.when(short == "", F.lit("0")).otherwise(F.concat(F.when(part(1) == "-", F.lit("-")).otherwise(F.lit("")), short, F.lit("e"), scaled.cast("decimal(38,0)").cast("string")))
    return F.when(text.rlike(_NUMBER) & text.rlike(_HAS_DIGIT), key)


def number_key_of(value: int | Decimal) -> str:
    """:func:`number_key` of a value on the driver."""
    sign, digits, power = Decimal(value).as_tuple()
    text = "".join(map(str, digits)).lstrip("0")
    short = text.rstrip("0")
    return f"{'-' if sign else ''}{short}e{power + len(text) - len(short)}" if short else "0"


def normal_json(text: Column) -> Column:
    """One text for all spellings of a JSON object or list, null for other texts."""
    return F.when(text.rlike(r"^\s*[\[{]"), F.to_json(F.try_parse_json(text)))
