"""Rules judged at each row's own time (R7): of the versions of a rule, the one in force that day.

A rule id may be defined several times with different validity windows. On a
given day its version is the first definition (document order) that is
switched on and whose window holds the day; the rules it jumps to are looked
up for the same day. Per rule this gives disjoint pieces of time with one plan
each. Rows meet them in two ways, with the same answers: :func:`tag_in_force`
takes a window as two more conditions of the rule and needs no join;
:func:`in_force` is a range join through time bins, for rows of any table or
stream against any table of windows.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.catalog import Rule, RuleCatalog
from ..plans.chain import RulePlan
from ..plans.status import RuleError, Status
from .apply import RuleAddress, rule_plan
from .rule_index import RuleIndex

#: Days of a bin, by level; a window lies in the finest level that it fills at most ``BINS`` bins of.
BIN_DAYS = (32, 2_048, 131_072)
BINS = 64
_DAY = _dt.timedelta(days=1)


@dataclass(frozen=True)
class Piece:
    """From ``first`` to ``last`` (days, inclusive) rule ``rule_id`` is what ``plan`` says."""

    rule_pos: int
    rule_id: str
    first: _dt.date
    last: _dt.date
    plan: RulePlan


class _OnDay:
    """The catalog as it stands on one day: definitions in force only."""

    def __init__(self, catalog: RuleCatalog, day: _dt.date):
        self._catalog, self._day, self.spark = catalog, day, catalog.spark

    def rules_with_id(self, rule_id: str) -> list[Rule]:
        return [r for r in self._catalog.rules_with_id(rule_id) if _holds(r, self._day)]

    def rules_with_ids(self, rule_ids) -> dict[str, list[Rule]]:
        return {i: self.rules_with_id(i) for i in rule_ids}

    def first_usable(self, rule_id: str, as_of: _dt.date, allow_empty: bool = False, candidates=None) -> Rule:
        rules = self.rules_with_id(rule_id) if candidates is None else candidates
        return self._catalog.first_usable(rule_id, as_of, allow_empty, rules)


def _holds(rule: Rule, day: _dt.date) -> bool:
    return rule.active and None not in (rule.valid_from_date, rule.valid_till_date) and rule.valid_from_date <= day <= rule.valid_till_date


def _reached(catalog: RuleCatalog, rule_id: str) -> list[Rule]:
    """All definitions of the rule and of those it may jump to."""
    todo, seen, found = [rule_id.strip()], set(), []
    while todo:
        rid = todo.pop()
        if rid in seen:
            continue
        seen.add(rid)
        for r in catalog.rules_with_id(rid):
            found.append(r)
            if r.is_goto and r.then_value:
                todo.append(r.then_value.strip())
    return found


def version_pieces(catalog: RuleCatalog, rule_ids, guard: bool = False) -> list[Piece]:
    """The pieces of time of every rule, disjoint and in order per rule.

    On days without a definition in force, or whose chain leads to a rule that
    is not, the rule has no piece. A version that is broken otherwise, or no
    rule with the id at all, raises ``RuleError``.
    """
    out = []
    for pos, at in enumerate(rule_ids):
        rid = at.rule_id if isinstance(at, RuleAddress) else at
        rules = [r for r in _reached(catalog, rid) if r.active and None not in (r.valid_from_date, r.valid_till_date)]
        if not catalog.rules_with_id(rid):
            raise RuleError(Status.NOT_CONFIGURED, f"no rule with id {rid!r}", rid)
        cuts = sorted({r.valid_from_date for r in rules} | {r.valid_till_date + _DAY for r in rules if r.valid_till_date < _dt.date.max})
        own: list[Piece] = []
        for first, after in zip(cuts, [*cuts[1:], None]):
            try:
                plan = rule_plan(_OnDay(catalog, first), at, as_of=first, guard=guard)
            except RuleError as exc:
                if exc.status in (Status.NOT_CONFIGURED, Status.GOTO_UNKNOWN):
                    continue
                raise
            last = after - _DAY if after else _dt.date.max
            if own and own[-1].plan == plan and own[-1].last + _DAY == first:
                own[-1] = Piece(pos, rid, own[-1].first, last, plan)
            else:
                own.append(Piece(pos, rid, first, last, plan))
        out += own
    return out


def _day_of(df: DataFrame, time_col: str) -> Column:
    return F.to_date(F.col(f"`{time_col}`"))


def _index(df: DataFrame, pieces: list[Piece], names: list[str], time_col: str) -> RuleIndex:
    return RuleIndex(df, [(n, p.plan) for n, p in zip(names, pieces)], _day_of(df, time_col), [(p.first, p.last) for p in pieces])


def tag_in_force(df: DataFrame, catalog: RuleCatalog, rule_ids, time_col: str, hits_col: str = "hits",
                 guard: bool = False, as_array: bool = False) -> DataFrame:
    """T2 with R7 per row: ``hits`` = rules that, as they were on the row's day, the row meets.

    One pass without a join; also on streams. A row without a time meets none.
    """
    pieces = version_pieces(catalog, rule_ids, guard)
    names = [p.rule_id for p in pieces]
    if not as_array and any("," in n for n in names):
        raise RuleError(Status.NOT_APPLICABLE, "a rule id holds a comma; pass as_array=True")
    index = _index(df, pieces, names, time_col)
    kept = [F.col(f"`{c}`") for c in df.columns if c != hits_col]
    return df.select(*kept, (index.hits() if as_array else index.texts()).alias(hits_col))


def versions_frame(catalog: RuleCatalog, rule_ids, guard: bool = False) -> DataFrame:
    """(rule_pos, rule_id, valid_from, valid_till): the pieces as a table for :func:`in_force`."""
    return _frame(catalog, version_pieces(catalog, rule_ids, guard)).drop("__piece")


def _frame(catalog: RuleCatalog, pieces: list[Piece]) -> DataFrame:
    """The pieces and their numbers, made from Arrow: a local table, whose size Spark knows when it plans a join."""
    columns = {
        "rule_pos": pa.array([p.rule_pos for p in pieces], pa.int32()),
        "rule_id": pa.array([p.rule_id for p in pieces], pa.string()),
        "valid_from": pa.array([p.first for p in pieces], pa.date32()),
        "valid_till": pa.array([p.last for p in pieces], pa.date32()),
        "__piece": pa.array(range(len(pieces)), pa.int32()),
    }
    return catalog.spark.createDataFrame(pa.table(columns))


def _bin(day: Column, level: Column) -> Column:
    days = F.datediff(day, F.lit(_dt.date(1970, 1, 1)))
    width = F.get(F.array(*map(F.lit, BIN_DAYS)), level)
    return F.floor(days / width).cast("int")


def in_force(df: DataFrame, versions: DataFrame, time_col: str, from_col: str = "valid_from", till_col: str = "valid_till") -> DataFrame:
    """Every row of ``df`` with every row of ``versions`` whose window (days, inclusive) holds its day.

    Windows are cut into bins of one of three widths, a row looks into one bin
    of each, and the ends are compared within a bin: an equi-join, whatever
    the windows' lengths. Windows are broadcast where Spark finds them small.
    ``df`` may be a stream (a stream-static join). A window without an end, or
    that ends before it begins, holds no day. ``versions`` must not share
    column names with ``df``.
    """
    clash = {c.lower() for c in df.columns} & {c.lower() for c in versions.columns}
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    first, last = F.col(f"`{from_col}`").cast("date"), F.col(f"`{till_col}`").cast("date")
    length = F.datediff(last, first) + 1
    level = F.lit(len(BIN_DAYS) - 1)
    for n in range(len(BIN_DAYS) - 2, -1, -1):
        level = F.when(length <= BINS * BIN_DAYS[n], F.lit(n)).otherwise(level)
    windows = versions.filter(first <= last).withColumn("__level", level)
    windows = windows.withColumn("__bin", F.explode(F.sequence(_bin(first, F.col("__level")), _bin(last, F.col("__level")))))
    day = F.col("__day")
    own = [F.col(f"`{c}`") for c in df.columns]
    probes = F.array(*[F.struct(F.lit(n).alias("level"), _bin(day, F.lit(n)).alias("bin")) for n in range(len(BIN_DAYS))])
    rows = df.select(*own, _day_of(df, time_col).alias("__day")).filter(day.isNotNull())
    rows = rows.select(*own, day, F.explode(probes).alias("__at")).select(*own, day, F.col("__at.level").alias("__level"), F.col("__at.bin").alias("__bin"))
    held = day.between(first, last)
    return rows.join(windows, ["__level", "__bin"]).filter(held).select(*own, *[F.col(f"`{c}`") for c in versions.columns])


def hits_in_force(df: DataFrame, catalog: RuleCatalog, rule_ids, time_col: str, guard: bool = False) -> DataFrame:
    """The columns of ``df``, then (rule_pos, rule_id, valid_from, valid_till) of each rule met, as it was that day.

    The range join of :func:`in_force` with the rules' pieces; which of them a
    row meets is found once a row, before it. Columns of ``df`` with those
    names give way.
    """
    pieces = version_pieces(catalog, rule_ids, guard)
    versions = _frame(catalog, pieces)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in versions.columns[:-1]]
    met = RuleIndex(df, [(p.rule_id, p.plan) for p in pieces]).words()
    found = in_force(df.select(*kept, met.alias("__met")), versions, time_col)
    piece = F.col("__piece")
    # Never null: else Spark asks for words that are not null below the join, and makes them once more for that.
    word = F.coalesce(F.get("__met", F.shiftright(piece, 6)), F.lit(0))
    return found.filter(F.getbit(word, piece.bitwiseAND(63)) == 1).drop("__met", "__piece")
