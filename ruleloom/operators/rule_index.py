"""Many rules over one table (T2, P9): an index over their conditions.

Every rule is a disjunction of conjunctions. All comparisons of one field with values cut
that field's range at sorted thresholds, so a row's place among them (one binary search) decides
every one of these comparisons at once. For each place the index holds one bit per
conjunction: whether its conditions on that field hold there. The bits of a row's places, AND-ed
over the fields, are the conjunctions it meets. The plan has one input per field, whatever
the number of rules; rows are judged by the batch, in Arrow.

A prefix (``LIKE`` without wildcards) is a range of texts, so thousands of them cost one search too.
Conditions that are no such comparison (other patterns, computed booleans, query tails) are
evaluated once each by Spark and count as a field with two places.
"""

from __future__ import annotations

import datetime as _dt
import math
from bisect import bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import compile_condition, field_types, is_number_text, numeric_literal, parse_operator
from ..plans.chain import RulePlan, Term

#: Conjunctions of one block; a block has its own thresholds, so the index grows in proportion to the rules.
BLOCK = 1024
#: Rows that a task judges at a time (a block's bits of them: 1 MB).
ROWS = 8192
_LONG = range(-(2**63), 2**63)
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Test:
    """One condition: ``axis`` names the search it belongs to, ``value`` is its threshold there.

    A test without symbol is a flag: it holds where the axis' Column is true.
    """

    axis: tuple
    symbol: str | None = None
    value: object = None


@dataclass
class Axis:
    """What a block's conditions compare one left side with; ``source`` is its place among the inputs."""

    source: int
    element: str | None  # type of the thresholds; None for a flag
    thresholds: list = field(default_factory=list)

    @property
    def places(self) -> int:
        """Below, at and between the thresholds, then null; or false, true."""
        return 2 * len(self.thresholds) + 2

    def where(self, test: Test) -> np.ndarray:
        """At which places the test holds."""
        held = np.zeros(self.places, bool)
        if test.symbol is None:
            held[1] = True
            return held
        last = self.places - 1
        if test.symbol == "prefix" or test.symbol == "no prefix":
            # Texts with a prefix are neighbours in the order of their bytes.
            after = _after(test.value)
            low = 2 * self.thresholds.index(test.value) + 1
            held[low : last if after is None else 2 * self.thresholds.index(after) + 1] = True
            if test.symbol == "no prefix":
                held[:last] = ~held[:last]
            return held
        at = 2 * self.thresholds.index(test.value) + 1
        low, high = {"=": (at, at + 1), "<=>": (at, at + 1), "<": (0, at), "<=": (0, at + 1), ">": (at + 1, last), ">=": (at, last), "!=": (0, last)}[test.symbol]
        held[low:high] = True
        if test.symbol == "!=":
            held[at] = False
        return held

    def place(self, values: pa.Array) -> np.ndarray:
        """Rows' places: twice the thresholds not above the value, less one if it equals the last of them."""
        if self.element is None:
            return values.fill_null(False).to_numpy(zero_copy_only=False).astype(np.intp)
        known = self.thresholds
        if self.element in _TEXTS:
            coded = values.dictionary_encode()
            seen = [v.encode() for v in coded.dictionary.to_pylist()]
            upto = [bisect_right(known, v) for v in seen]
            by_value = np.array([2 * n - (n > 0 and known[n - 1] == v) for n, v in zip(upto, seen, strict=True)] or [0], np.intp)
            found = by_value[coded.indices.fill_null(0).to_numpy(zero_copy_only=False)]
        else:
            known = np.array(known)
            x = values.fill_null(0).to_numpy(zero_copy_only=False)
            upto = np.searchsorted(known, x, side="right")
            found = 2 * upto - ((upto > 0) & (known[upto - 1] == x))
        if values.null_count:
            found[values.is_null().to_numpy(zero_copy_only=False)] = self.places - 1
        return found


def _after(prefix: bytes) -> bytes | None:
    """The least byte string above all that begin with ``prefix``."""
    head = prefix.rstrip(b"\xff")
    return head[:-1] + bytes([head[-1] + 1]) if head else None


def _whole(symbol: str, value: Decimal) -> tuple[str, int]:
    """A comparison of whole numbers with a decimal, as one with a whole number."""
    floor = math.floor(value)
    if value == floor:
        return symbol, floor
    return {"<": ("<=", floor), "<=": ("<=", floor), ">": (">=", floor + 1), ">=": (">=", floor + 1)}.get(symbol, (None, None))


def _days(day: _dt.date) -> int:
    return (day - _dt.date(1970, 1, 1)).days


def _plain_text(dtype: T.DataType) -> bool:
    """Whether values compare by their bytes, as text."""
    return dtype == T.StringType() or isinstance(dtype, _INTEGERS)


def _test(term_field: str, op, value: str, dtype: T.DataType, rule_id: str) -> Test | None:
    """The condition as a comparison on a search axis, or None where only its Column says what it means."""
    if value is None:
        return None
    if op.kind == "like" and op.prefix and not set(value) & set("%_\\") and _plain_text(dtype):
        kind = "string" if isinstance(dtype, T.StringType) else "text"
        return Test((term_field, kind), "no prefix" if op.negate else "prefix", value.encode())
    if op.kind != "cmp":
        return None
    if isinstance(dtype, _INTEGERS):
        number = numeric_literal(term_field, value, rule_id)
        if isinstance(number, float):
            return None
        symbol, whole = _whole(op.symbol, Decimal(number))
        return Test((term_field, "bigint"), symbol, whole) if symbol and whole in _LONG else None
    if isinstance(dtype, T.DoubleType):
        number = float(numeric_literal(term_field, value, rule_id))
        return Test((term_field, "double"), op.symbol, number + 0.0) if math.isfinite(number) else None
    if isinstance(dtype, T.StringType) and _plain_text(dtype):
        if not is_number_text(value):
            return Test((term_field, "string"), op.symbol, value.encode())
        return Test((term_field, "digits"), op.symbol, int(value)) if int(value) in _LONG else None
    try:
        if isinstance(dtype, T.DateType):
            return Test((term_field, "date"), op.symbol, _days(_dt.date.fromisoformat(value.strip())))
        if isinstance(dtype, T.TimestampNTZType):
            head, _, part = value.strip().partition(".")
            time = _dt.datetime.fromisoformat(f"{head}.{part[:6]:0<6}" if part else head)
            return Test((term_field, "timestamp_ntz"), op.symbol, (time - _dt.datetime(1970, 1, 1)) // _dt.timedelta(microseconds=1))
    except ValueError:
        return None
    return None


def _groups(terms: Sequence[Term]) -> list[list[Term]]:
    """The conjunctions of a flat condition list (AND binds tighter than OR)."""
    out: list[list[Term]] = [[]]
    for t in terms:
        out[-1].append(t)
        if t.connector == "OR":
            out.append([])
    return out if out[-1] else out[:-1]


#: Integer type that an axis' values and thresholds are compared as.
_ARROW = {"date": pa.int32(), "timestamp_ntz": pa.int64()}
#: Axes whose values are texts.
_TEXTS = ("string", "text")
_CASTS = {"bigint": "bigint", "text": "string"}


class RuleIndex:
    """The rules of a call, typed for ``df``.

    ``entries`` pairs ids with plans. A rule that does not fit the table raises its ``RuleError``
    as its predicate would. With ``day`` an entry holds only on the days of its window
    (first and last, inclusive).
    """

    def __init__(self, df: DataFrame, entries: Sequence[tuple[str, RulePlan]], day: Column | None = None,
                 windows: Sequence[tuple[_dt.date, _dt.date]] | None = None):
        self.rule_ids = [rid for rid, _ in entries]
        types = field_types(df, [f for _, p in entries if p.kind == "predicate" for f in p.fields()])
        self._columns: dict[tuple, Column] = {}
        rules = [self._disjuncts(df, p, types) for _, p in entries]
        if day is not None:
            axis = ("the row's day", "date")
            self._columns[axis] = day
            for disjuncts, (first, last) in zip(rules, windows, strict=True):
                bounds = [Test(axis, ">=", _days(first)), Test(axis, "<=", _days(last))]
                disjuncts[:] = [bounds + d for d in disjuncts]
        self._judge = _Judge(rules, list(self._columns))

    def _disjuncts(self, df: DataFrame, plan: RulePlan, types: dict) -> list[list[Test]]:
        if plan.kind != "predicate":
            return [[self._flag(("tail", plan.tail), lambda: plan.predicate(df))]]
        equal = parse_operator("=", plan.rule_id)
        guards = [self._flag(("null", name), lambda name=name: F.expr(name).isNull()) if value is None else self._read(name, equal, value, types[name], plan.rule_id)
                  for name, value in plan.guards]
        tests = [(t, self._read(t.condition.field_name, parse_operator(t.condition.operator, t.rule_id), t.condition.field_value, types[t.condition.field_name], t.rule_id)) for t in plan.terms]
        return [guards + group for group in _groups(tests)]

    def _read(self, name: str, op, value: str, dtype: T.DataType, rule_id: str) -> Test:
        test = _test(name, op, value, dtype, rule_id)
        if test is None:
            key = ("condition", name, op.kind, op.symbol, op.negate, op.prefix, value)
            return self._flag(key, lambda: compile_condition(name, op, value, dtype, rule_id).column)
        if test.axis not in self._columns:
            column, kind = F.expr(name), test.axis[1]
            self._columns[test.axis] = column.try_cast("bigint") if kind == "digits" else column.cast(_CASTS[kind]) if kind in _CASTS else column
        return test

    def _flag(self, key: tuple, made: Callable[[], Column]) -> Test:
        if key not in self._columns:
            self._columns[key] = made()
        return Test(key)

    def hits(self) -> Column:
        """The ids of the rules a row meets, in the order given (``array<string>``)."""
        if not self.rule_ids:
            return F.array().cast("array<string>")
        judge, names = self._judge, self.rule_ids

        def met(*columns: pa.Array) -> pa.Array:
            return pa.concat_arrays([_named(bits, names) for bits in judge.rules(columns)] or [pa.array([], pa.list_(pa.string()))])

        return F.arrow_udf(met, "array<string>")(*self._columns.values())

    def words(self) -> Column:
        """One bit a rule, by its place in the order given: 64 to a word, the lowest bit first (``array<bigint>``)."""
        if not self.rule_ids:
            return F.array().cast("array<bigint>")
        judge = self._judge
        count = -(-judge.size // 64)

        def met(*columns: pa.Array) -> pa.Array:
            return pa.concat_arrays([_words(bits, count) for bits in judge.rules(columns)] or [pa.array([], pa.list_(pa.int64()))])

        return F.arrow_udf(met, "array<bigint>")(*self._columns.values())

    def texts(self, mark: str = ",") -> Column:
        """The same as one text."""
        if not self.rule_ids:
            return F.lit("")
        judge, names = self._judge, self.rule_ids

        def met(*columns: pa.Array) -> pa.Array:
            return pa.concat_arrays([pc.binary_join(_named(bits, names), mark) for bits in judge.rules(columns)] or [pa.array([], pa.string())])

        return F.arrow_udf(met, "string")(*self._columns.values())

    def count(self, df: DataFrame) -> DataFrame:
        """(rule_pos, n_hits): rows of ``df`` each rule hits, zeros included, in one scan.

        A task hands on one count a rule.
        """
        judge = self._judge

        def counted(batches):
            total = np.zeros(judge.size, np.int64)
            for batch in batches:
                for bits in judge.rules(batch.columns):
                    total += bits.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(judge.size), pa.int32()), pa.array(total)], ["rule_pos", "n_hits"])

        inputs = df.select(*[c.alias(f"x{i}") for i, c in enumerate(self._columns.values())])
        parts = inputs.mapInArrow(counted, "rule_pos int, n_hits long")
        rules = df.sparkSession.range(judge.size).select(F.col("id").cast("int").alias("rule_pos"), F.lit(0).cast("long").alias("n_hits"))
        return parts.unionByName(rules).groupBy("rule_pos").agg(F.sum("n_hits").alias("n_hits"))


def _groups(tests: Sequence[tuple[Term, Test]]) -> list[list[Test]]:
    """The conjunctions of a flat condition list (AND binds tighter than OR)."""
    out: list[list[Test]] = [[]]
    for n, (term, test) in enumerate(tests):
        out[-1].append(test)
        if term.connector == "OR" and n + 1 < len(tests):
            out.append([])
    return out


def _named(bits: np.ndarray, names: list[str]) -> pa.Array:
    rows, rules = np.nonzero(bits)
    ends = np.searchsorted(rows, np.arange(len(bits) + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(names, pa.string()).take(pa.array(rules)))


def _words(bits: np.ndarray, count: int) -> pa.Array:
    packed = np.zeros((len(bits), 8 * count), np.uint8)
    own = np.packbits(bits, axis=1, bitorder="little")
    packed[:, : own.shape[1]] = own
    ends = np.arange(len(bits) + 1) * count
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(packed.view("<i8").ravel()))


class _Judge:
    """The index itself: plain arrays, sent to the tasks."""

    def __init__(self, rules: list[list[list[Test]]], sources: list[tuple]):
        self.size = len(rules)
        at = {key: i for i, key in enumerate(sources)}
        # The first conjunction of every rule, then those that are further ways to meet a rule.
        flat = [d[0] for d in rules] + [c for d in rules for c in d[1:]]
        self.others = [(self.size + n, r) for n, r in enumerate(r for r, d in enumerate(rules) for _ in d[1:])]
        self.blocks = [_block(flat[n : n + BLOCK], at) for n in range(0, len(flat), BLOCK)]

    def rules(self, columns: Sequence[pa.Array]):
        """(rows x rules) booleans, for some rows at a time."""
        for first in range(0, len(columns[0]), ROWS):
            part = [c.slice(first, ROWS) for c in columns]
            bits = [_met(axes, tables, many, part) for axes, tables, many in self.blocks]
            met = bits[0] if len(bits) == 1 else np.concatenate(bits, axis=1)
            for other, rule in self.others:
                met[:, rule] |= met[:, other]
            yield met[:, : self.size]


def _block(conjunctions: list[list[Test]], at: dict[tuple, int]) -> tuple[list[Axis], list[np.ndarray], int]:
    tests: dict[tuple, set] = {}
    for c in conjunctions:
        for t in c:
            tests.setdefault(t.axis, set()).add(t)
    axes = {}
    for key, found in tests.items():
        flag = all(t.symbol is None for t in found)
        cuts = {t.value for t in found} | {_after(t.value) for t in found if t.symbol in ("prefix", "no prefix")}
        axes[key] = Axis(at[key], None if flag else key[1], [] if flag else sorted(cuts - {None}))
    held = {key: np.ones((a.places, len(conjunctions)), bool) for key, a in axes.items()}
    where = {t: axes[key].where(t) for key, found in tests.items() for t in found}
    for bit, c in enumerate(conjunctions):
        for t in c:
            held[t.axis][:, bit] &= where[t]
    return list(axes.values()), [np.packbits(held[key], axis=1) for key in axes], len(conjunctions)


def _met(axes: list[Axis], tables: list[np.ndarray], many: int, columns: Sequence[pa.Array]) -> np.ndarray:
    found = None
    for axis, table in zip(axes, tables, strict=True):
        values = columns[axis.source]
        if _ARROW.get(axis.element) is not None:
            values = values.cast(_ARROW[axis.element])
        own = table[axis.place(values)]
        found = own if found is None else np.bitwise_and(found, own, out=found)
    return np.unpackbits(found, axis=1, count=many).view(bool)
