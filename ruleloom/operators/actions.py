"""Actions on hits (T2, T3): tag rows, many rules in one scan, derived columns.

Evaluating N rules costs one scan and one projection of bounded size (see
:mod:`.rule_index`); no rule needs its own pass or a shuffle.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException, ArithmeticException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import field_types
from ..plans.chain import RulePlan, transform_column
from ..plans.status import RuleError, RuleResult, Status
from .apply import RuleAddress, rule_plan
from .rule_index import RuleIndex

_log = logging.getLogger(__name__)

#: Rules from which a pass goes through the index: fewer stay in Spark's compiled code, more would
#: outgrow what the JVM compiles. The choice changes the plan only.
INDEXED_RULES = 24

HUGE_METHOD_CONF = "spark.sql.codegen.hugeMethodLimit"
HUGE_METHOD_LIMIT = "8000"


def keep_codegen_jit_friendly(spark) -> None:
    """Lower ``hugeMethodLimit`` to the JIT's limit unless the user set it.

    Spark abandons whole-stage codegen for a method of more bytecode than this
    limit, but the JVM compiles none over 8000 bytes, so passes of some 40 and
    more rules run interpreted under Spark's default (100 rules about four
    times slower). It changes the session for all queries, so nothing here
    calls it: a job that applies many rules may.
    """
    if spark.conf.get(HUGE_METHOD_CONF, "65535") == "65535":
        spark.conf.set(HUGE_METHOD_CONF, HUGE_METHOD_LIMIT)
        _log.info("set %s=%s for this session", HUGE_METHOD_CONF, HUGE_METHOD_LIMIT)


def rule_statuses(catalog, rule_ids, as_of=None, guard: bool = False) -> dict[str | RuleAddress, RuleResult]:
    """The status of every rule of a multi-rule call, resolved by id or address."""
    catalog.rules_with_ids(rule_ids)
    out = {}
    for at in rule_ids:
        rid = at.rule_id if isinstance(at, RuleAddress) else at
        try:
            plan = rule_plan(catalog, at, as_of=as_of, guard=guard)
            out[at] = RuleResult(Status.OK, "usable", rid, plan=plan, chain=plan.chain)
        except RuleError as exc:
            out[at] = RuleResult(exc.status, exc.message, rid)
    return out


def validate_rules(catalog, as_of=None, guard: bool = False) -> DataFrame:
    """R9 with chains: every rule of the document resolved as a call would.

    ``(rule_id, status, message, chain)`` per rule id — dangling or cyclic
    ``goto``, bad connectors, operators or lookups show up here, not only
    switched-off or expired rules (for those, :meth:`RuleCatalog.status` is
    a pure DataFrame view). Resolution uses the driver-side rule index, so
    it is meant for rule documents, not data.
    """
    ids = catalog.all_ids()
    res = rule_statuses(catalog, ids, as_of, guard)
    rows = [(rid, r.status.value, r.message, " -> ".join(r.chain) or None) for rid, r in res.items()]
    return catalog.spark.createDataFrame(rows, "rule_id string, status string, message string, chain string")


def _bind(df: DataFrame, plans: list[RulePlan]) -> list[Column]:
    """All predicates typed against ``df`` with a single analysis pass."""
    types = field_types(df, [f for p in plans if p.kind == "predicate" for f in p.fields()])
    lefts: dict = {}
    return [p.predicate(df, types, lefts) if p.kind == "predicate" else p.predicate(df, types) for p in plans]


def bind_statuses(df: DataFrame, catalog, rule_ids, as_of=None, guard: bool = False) -> dict[str | RuleAddress, RuleResult]:
    """R9 against a table: every rule's status after typing it for ``df`` (bad values, unknown fields, aggregates)."""
    out = rule_statuses(catalog, rule_ids, as_of, guard)
    for at, res in out.items():
        if not res.ok:
            continue
        rid = res.rule_id
        try:
            df.select(F.lit(1)).limit(0) if res.plan is None else df.filter(res.plan.predicate(df)).limit(0)
        except RuleError as exc:
            out[at] = RuleResult(exc.status, exc.message, rid)
        except (AnalysisException, ArithmeticException, ParseException) as exc:
            out[at] = RuleResult(Status.BAD_FIELD, f"rule {rid} does not fit the table: {str(exc).splitlines()[0]}", rid)
    return out


def _fitting(df: DataFrame, catalog, rule_ids, as_of, guard: bool, errors: str) -> list[RulePlan]:
    """Plans for ``rule_ids``; unusable rules raise, or with ``errors="skip"`` those that cannot be
    resolved or typed for ``df`` are left out (see :func:`bind_statuses` for why)."""
    if errors not in ("raise", "skip"):
        raise ValueError("errors must be 'raise' or 'skip'")
    found = (bind_statuses if errors == "skip" else lambda _, *given: rule_statuses(*given))(df, catalog, rule_ids, as_of, guard)
    for res in found.values():
        if not res.ok and errors == "raise":
            raise RuleError(res.status, res.message, res.rule_id)
        if not res.ok:
            _log.warning("rule %s left out: %s", res.rule_id, res.message)
    return [res.plan for res in found.values() if res.ok]


def rule_index(df: DataFrame, catalog, rule_ids, as_of=None, guard: bool = False, errors: str = "raise") -> RuleIndex:
    """The index over the conditions of ``rule_ids``, typed for ``df``."""
    return RuleIndex(df, [(p.rule_id, p) for p in _fitting(df, catalog, rule_ids, as_of, guard, errors)])


def rule_predicates(df: DataFrame, catalog, rule_ids, as_of=None, guard: bool = False,
                    errors: str = "raise") -> list[tuple[str, Column]]:
    """``(rule_id, predicate)`` for every rule, all typed against ``df``."""
    plans = _fitting(df, catalog, rule_ids, as_of, guard, errors)
    return [(p.rule_id, pred) for p, pred in zip(plans, _bind(df, plans))]


def _check_action(df: DataFrame, rule_id: str, name: str) -> None:
    """An action's text must fit the column it sets, else a status instead of a failure at run time."""
    if name in df.columns and df.schema[name].dataType != T.StringType():
        kind = df.schema[name].dataType.simpleString()
        raise RuleError(Status.BAD_VALUE, f"rule {rule_id}: action sets text in {name}, which is {kind}", rule_id)


def tag(df: DataFrame, catalog, rule_id: str, as_of=None, column: str | None = None, value: str | None = None,
        guard: bool = False) -> DataFrame:
    """Set ``then.field_name = then.field_value`` on rows the rule hits.

    Misses keep the column's current value (null if the column is new).
    ``column`` / ``value`` override the rule's action.
    """
    plan = rule_plan(catalog, rule_id, as_of=as_of, guard=guard)
    name = column or plan.action[0]
    val = value if value is not None else plan.action[1]
    if not name or name == "goto":
        raise RuleError(Status.NOT_APPLICABLE, f"rule {rule_id} has no column to tag; pass column=")
    _check_action(df, rule_id, name)
    other = F.col(name) if name in df.columns else F.lit(None).cast("string")
    return df.withColumn(name, F.when(plan.predicate(df), F.lit(val)).otherwise(other))


def tag_all(df: DataFrame, catalog, rule_ids, as_of=None, hits_col: str = "hits", set_actions: bool = False,
            guard: bool = False, errors: str = "raise", as_array: bool = False) -> DataFrame:
    """T2 × N in one pass: ``hits`` = ids of matching rules, in ``rule_ids`` order.

    ``hits`` is comma-separated text, or with ``as_array`` an array of ids; as
    text an id that holds a comma would be ambiguous and is an error. With
    ``set_actions`` each rule's ``then`` column is also set; when several
    rules set the same column the first rule (in ``rule_ids`` order) wins.
    ``errors="skip"`` leaves unusable rules (switched off, expired, …) out
    instead of raising; :func:`rule_statuses` tells which and why.
    """
    plans = _fitting(df, catalog, rule_ids, as_of, guard, errors)
    if not as_array:
        for p in plans:
            if "," in p.rule_id:
                raise RuleError(Status.NOT_APPLICABLE, f"rule id {p.rule_id!r} holds a comma; pass as_array=True", p.rule_id)
    hits = _hits(df, plans, as_array)
    acting = []
    if set_actions:
        for p in plans:
            if p.action[0] and p.action[0] != "goto":
                _check_action(df, p.rule_id, p.action[0])
                acting.append(p)
    actions: dict[str, list[tuple[Column, str]]] = {}
    for p, pred in zip(acting, _bind(df, acting)):
        actions.setdefault(p.action[0], []).append((pred, p.action[1]))
    out = [F.col(f"`{c}`") for c in df.columns if c != hits_col and c not in actions]
    cols = out + [hits.alias(hits_col)]
    for name, cases in actions.items():
        expr = None
        for pred, val in cases:
            expr = F.when(pred, F.lit(val)) if expr is None else expr.when(pred, F.lit(val))
        fallback = F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")
        cols.append(expr.otherwise(fallback).alias(name))
    return df.select(*cols)


def _hits(df: DataFrame, plans: list[RulePlan], as_array: bool) -> Column:
    """Ids of the rules met: one ``CASE`` a rule for a few, the index for more (the ids are the same)."""
    if len(plans) >= INDEXED_RULES:
        index = RuleIndex(df, [(p.rule_id, p) for p in plans])
        return index.hits() if as_array else index.texts()
    cases = [F.when(pred, F.lit(p.rule_id)) for p, pred in zip(plans, _bind(df, plans))]
    if as_array:
        return F.array_compact(F.array(*cases)) if cases else F.array().cast("array<string>")
    return F.concat_ws(",", *cases) if cases else F.lit("")


def rule_hit_counts(df: DataFrame, catalog, rule_ids, as_of=None, guard: bool = False,
                    errors: str = "raise") -> DataFrame:
    """Rows hit per rule, all rules counted in one scan: ``(rule_pos, rule_id, n_hits)``.

    Each task hands on one count a rule. No job runs while the frame is built.
    ``errors="skip"`` leaves unusable rules out.
    """
    plans = _fitting(df, catalog, rule_ids, as_of, guard, errors)
    spark = df.sparkSession
    if not plans:
        return spark.createDataFrame([], "rule_pos int, rule_id string, n_hits bigint")
    if len(plans) >= INDEXED_RULES:
        named = spark.createDataFrame([(i, p.rule_id) for i, p in enumerate(plans)], "rule_pos int, rule_id string")
        counts = RuleIndex(df, [(p.rule_id, p) for p in plans]).count(df)
        return named.join(counts, "rule_pos").select("rule_pos", "rule_id", "n_hits")
    counts = df.agg(*[F.count_if(pred).alias(f"h{i}") for i, pred in enumerate(_bind(df, plans))])
    rows = [F.struct(F.lit(i).alias("rule_pos"), F.lit(p.rule_id).alias("rule_id"), F.col(f"h{i}").alias("n_hits")) for i, p in enumerate(plans)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def transform(df: DataFrame, catalog, rule_id: str, as_of=None) -> DataFrame:
    """Derived column ``then.field_name = expr(then.field_value)``."""
    plan = rule_plan(catalog, rule_id, as_of=as_of)
    if plan.kind != "transform":
        raise RuleError(Status.NOT_APPLICABLE, f"rule {rule_id} is not a transformation")
    name, col = transform_column(plan, df)
    return df.withColumn(name, col)
