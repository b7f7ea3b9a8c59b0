"""Conditions → typed Spark Columns (P2–P9, P12), plus a SQL rendering.

Everything here is plan construction on the driver: each condition becomes
a built-in Column expression (comparison, LIKE, RLIKE …) whose literal is
typed after the left side, so predicates stay inside whole-stage codegen and
plain-column comparisons reach the parquet reader as pushed filters.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.status import RuleError, Status

# Accepted operator spellings (compared case-insensitively,
# inner blanks collapsed) and their meaning.
COMPARISON_OPERATORS = {
    "=": "=",
    "==": "=",
    "<=>": "<=>",
    "!=": "!=",
    "<>": "!=",
    "<": "<",
    "<=": "<=",
    ">": ">",
    ">=": ">=",
}
PATTERN_OPERATORS = {
    "LIKE": ("like", False),
    "NOT LIKE": ("like", True),
    "ILIKE": ("ilike", False),
    "NOT ILIKE": ("ilike", True),
    "RLIKE": ("rlike", False),
    "NOT RLIKE": ("rlike", True),
    "REGEXP": ("rlike", False),
    "NOT REGEXP": ("rlike", True),
}
# Only these exact (upper-case) spellings turn the value into a prefix
# pattern by appending '%'; any other spelling of LIKE matches as given.
PREFIX_SPELLINGS = ("LIKE", "NOT LIKE")
CONNECTORS = ("AND", "OR")

_DIGITS = re.compile(r"[0-9]+")
_NUMBER = re.compile(r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
_TIMESTAMP = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?)?")
_LONG_MAX = 2**63 - 1

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class Operator:
    text: str  # as written in the rule
    kind: str  # "cmp" | "like" | "ilike" | "rlike"
    symbol: str  # comparison symbol, or the canonical pattern keyword
    negate: bool = False
    prefix: bool = False


def parse_operator(op: str | None, rule_id: str | None = None) -> Operator:
    """Operator text → allow-listed meaning; anything else is an error."""
    if op is None or not op.strip():
        raise RuleError(Status.BAD_OPERATOR, f"rule {rule_id}: a condition has no operator", rule_id)
    norm = " ".join(op.split()).upper()
    if norm in COMPARISON_OPERATORS:
        return Operator(op, "cmp", COMPARISON_OPERATORS[norm])
    if norm in PATTERN_OPERATORS:
        kind, negate = PATTERN_OPERATORS[norm]
        return Operator(op, kind, norm, negate, prefix=op.strip() in PREFIX_SPELLINGS)
    raise RuleError(Status.BAD_OPERATOR, f"rule {rule_id}: operator {op!r} is not supported", rule_id)


def parse_connector(join: str | None, rule_id: str | None = None) -> str | None:
    """``AND`` / ``OR`` in any case; null or blank means none."""
    if join is None or not join.strip():
        return None
    norm = join.strip().upper()
    if norm not in CONNECTORS:
        raise RuleError(Status.BAD_CONNECTOR, f"rule {rule_id}: connector {join!r} is not AND or OR", rule_id)
    return norm


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cmp(left: Column, symbol: str, right: Column) -> Column:
    if symbol == "=":
        return left == right
    if symbol == "<=>":
        return left.eqNullSafe(right)
    if symbol == "!=":
        return left != right
    if symbol == "<":
        return left < right
    if symbol == "<=":
        return left <= right
    if symbol == ">":
        return left > right
    return left >= right


def numeric_literal(field_name: str, value: str, rule_id: str | None = None) -> int | Decimal | float:
    """A condition's value against a numeric left side; anything but a number is an error."""
    v = value.strip()
    if _DIGITS.fullmatch(v) and int(v) <= _LONG_MAX:
        return int(v)
    if _NUMBER.fullmatch(v) and sum(ch.isdigit() for ch in v) > 38:
        raise RuleError(Status.BAD_VALUE, f"rule {rule_id}: {value!r} has more than 38 digits", rule_id)
    if _NUMBER.fullmatch(v) and "e" not in v.lower():
        return Decimal(v)  # exact: 10.5 on an int column, -5, huge integers
    if _NUMBER.fullmatch(v):
        return float(v)  # exponent form
    raise RuleError(Status.BAD_VALUE, f"rule {rule_id}: {value!r} is not a number but {field_name!r} is numeric", rule_id)


def is_number_text(value: str) -> bool:
    """Whether a value counts as a number against text (so '036' = 36)."""
    return _DIGITS.fullmatch(value) is not None


@dataclass(frozen=True)
class Compiled:
    column: Column | None
    sql: str


def compile_condition(
    field_name: str,
    op: Operator,
    value: str | None,
    dtype: T.DataType | None,
    rule_id: str | None = None,
    left: Column | None = None,
) -> Compiled:
    """One condition → Column (when ``dtype`` is known) and SQL text.

    ``dtype`` is the type of the left side; without it (no table bound) only
    the text is produced, typed the simple way (digits → integer). ``left``
    may pass an already built Column for ``field_name`` (shared across rules).
    """
    if value is None:
        raise RuleError(Status.BAD_VALUE, f"rule {rule_id}: condition on {field_name!r} has no value", rule_id)
    left_sql = f"({field_name})"
    if dtype is None:
        left = None
    elif left is None:
        left = F.expr(field_name)

    if op.kind != "cmp":
        pattern = value + "%" if (op.kind == "like" and op.prefix) else value
        is_string = dtype is None or isinstance(dtype, T.StringType)
        text_sql = left_sql if is_string else f"CAST({left_sql} AS STRING)"
        keyword = {"like": "LIKE", "ilike": "ILIKE", "rlike": "RLIKE"}[op.kind]
        sql = f"{'NOT ' if op.negate else ''}{text_sql} {keyword} {_sql_str(pattern)}"
        if left is None:
            return Compiled(None, sql)
        text = left if is_string else left.cast("string")
        col = getattr(text, op.kind)(pattern)
        return Compiled(~col if op.negate else col, sql)

    sym = op.symbol
    if dtype is None:
        lit_sql = value.strip() if _DIGITS.fullmatch(value.strip()) else _sql_str(value)
        return Compiled(None, f"{left_sql} {sym} {lit_sql}")

    if isinstance(dtype, _NUMERIC):
        lit = numeric_literal(field_name, value, rule_id)
        return Compiled(_cmp(left, sym, F.lit(lit)), f"{left_sql} {sym} {lit}")

    if isinstance(dtype, T.StringType):
        if _DIGITS.fullmatch(value):
            # digits against text compare as numbers (so '036' = 36); text
            # that is not a number simply does not match.
            n = int(value)
            if n >= 10**38:
                raise RuleError(Status.BAD_VALUE, f"rule {rule_id}: {value!r} has more than 38 digits", rule_id)
            target = "bigint" if n <= _LONG_MAX else "decimal(38,0)"
            return Compiled(
                _cmp(left.try_cast(target), sym, F.lit(n if n <= _LONG_MAX else Decimal(n))), f"TRY_CAST({left_sql} AS {target.upper()}) {sym} {n}"
            )
        return Compiled(_cmp(left, sym, F.lit(value)), f"{left_sql} {sym} {_sql_str(value)}")

    if isinstance(dtype, T.BooleanType):
        v = value.strip().lower()
        if v not in ("true", "false"):
            raise RuleError(Status.BAD_VALUE, f"rule {rule_id}: {value!r} is not true/false for {field_name!r}", rule_id)
        return Compiled(_cmp(left, sym, F.lit(v == "true")), f"{left_sql} {sym} {v}")

    if isinstance(dtype, T.DateType):
        v = value.strip()
        if not _DATE.fullmatch(v):
            raise RuleError(Status.BAD_VALUE, f"rule {rule_id}: {value!r} is not a date (yyyy-MM-dd)", rule_id)
        return Compiled(_cmp(left, sym, F.lit(v).cast(dtype)), f"{left_sql} {sym} DATE {_sql_str(v)}")

    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        v = value.strip()
        if not _TIMESTAMP.fullmatch(v):
            raise RuleError(Status.BAD_VALUE, f"rule {rule_id}: {value!r} is not a timestamp", rule_id)
        kw = "TIMESTAMP_NTZ" if isinstance(dtype, T.TimestampNTZType) else "TIMESTAMP"
        return Compiled(_cmp(left, sym, F.lit(v).cast(dtype)), f"{left_sql} {sym} {kw} {_sql_str(v)}")

    raise RuleError(
        Status.BAD_VALUE, f"rule {rule_id}: cannot compare {field_name!r} of type {dtype.simpleString()}", rule_id
    )


def fold_terms(items: list, connectors: list[str | None]):
    """P9 with SQL precedence over a *flat* list: AND binds tighter than OR.

    ``connectors[i]`` links item ``i`` to item ``i+1``. ``a OR b AND c`` is
    ``a OR (b AND c)``; a left fold would wrongly give ``(a OR b) AND c``.
    Works for Columns (``&``/``|``) and for SQL text.
    """
    groups: list[list] = [[items[0]]]
    for conn, item in zip(connectors[:-1], items[1:]):
        if conn == "OR":
            groups.append([item])
        else:
            groups[-1].append(item)
    if isinstance(items[0], str):
        ands = ["(" + " AND ".join(g) + ")" if len(g) > 1 else g[0] for g in groups]
        return " OR ".join(ands) if len(ands) == 1 else "(" + " OR ".join(ands) + ")"
    return balanced([balanced(g, lambda a, b: a & b) for g in groups], lambda a, b: a | b)


def balanced(items: list, combine):
    """Combine with an associative operator as a balanced tree (depth log n),
    so long chains do not become deeply nested expressions."""
    level = list(items)
    while len(level) > 1:
        nxt = [combine(level[i], level[i + 1]) for i in range(0, len(level) - 1, 2)]
        if len(level) % 2:
            nxt.append(level[-1])
        level = nxt
    return level[0]


_PLAIN_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def field_types(df, expressions: list[str]) -> dict[str, T.DataType]:
    """Resolve the type of every left-side expression.

    Plain column names are read from the schema; the remaining expressions
    are typed together in one analysis pass.
    """
    out: dict[str, T.DataType] = {}
    fields = {f.name: f.dataType for f in df.schema.fields}
    rest = []
    for e in dict.fromkeys(expressions):
        name = e.strip()
        if _PLAIN_NAME.fullmatch(name) and name in fields:
            out[e] = fields[name]
        else:
            rest.append(e)
    return {**out, **_analysed_types(df, rest)}


def _analysed_types(df, expressions: list[str]) -> dict[str, T.DataType]:
    uniq = list(dict.fromkeys(expressions))
    if not uniq:
        return {}
    try:
        schema = df.select(*[F.expr(e).alias(f"_f{i}") for i, e in enumerate(uniq)]).schema
    except Exception as exc:  # AnalysisException / ParseException
        # pin down the first bad expression for the message
        for e in uniq:
            try:
                df.select(F.expr(e)).schema
            except Exception as inner:  # noqa: BLE001
                raise RuleError(Status.BAD_FIELD, f"field {e!r} cannot be resolved: {_first_line(inner)}") from inner
        raise RuleError(Status.BAD_FIELD, f"fields cannot be resolved: {_first_line(exc)}") from exc
    return {e: schema.fields[i].dataType for i, e in enumerate(uniq)}


def _first_line(exc: Exception) -> str:
    return str(exc).strip().splitlines()[0] if str(exc).strip() else type(exc).__name__
