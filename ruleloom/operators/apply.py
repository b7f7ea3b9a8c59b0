"""Applying rules to DataFrames.

``evaluate`` is the one entry point behind everything: select the rule,
resolve its chain into a plan, optionally bind it to a DataFrame and filter.
The result is always lazy; filters from consecutive stages collapse into one
``Filter`` over one scan, and plain-column comparisons reach the reader as
pushed filters.
"""

from __future__ import annotations

import datetime as _dt
import logging
from typing import NamedTuple

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

from ..plans.catalog import RuleCatalog
from ..plans.chain import RulePlan, resolve, transform_column, where_filter
from ..plans.status import RuleError, RuleResult, Status
from ..sources.readers import read_table

_log = logging.getLogger(__name__)


def _as_date(as_of) -> _dt.date:
    if as_of is None:
        return _dt.date.today()
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of))


def _success_message(plan: RulePlan, value_key: str | None) -> str:
    if plan.kind == "query":
        return "lookup query returned"
    if plan.kind == "value":
        if value_key and value_key.strip():
            return f"lookup value {plan.value!r} returned for key {value_key.strip()!r}"
        return f"{len(plan.value)} lookup values returned"
    if plan.kind == "group":
        return "group-by lookup returned"
    if plan.kind == "transform":
        return "transformation returned"
    return "condition built from rules " + " -> ".join(plan.chain)


def query_frame(df: DataFrame, tail: str) -> DataFrame:
    """P10: a rule's SQL tail applied to ``df``.

    A pure ``where`` tail becomes ``df.filter(expr)`` (composable, works on
    streams); anything else runs as ``SELECT * FROM {src} <tail>`` with the
    DataFrame bound as a parameter, never as pasted table text.
    """
    found = where_filter(tail, df)
    if found is not None:
        return found[1]
    safe = tail.replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql("SELECT * FROM {src} " + safe, src=df)


def apply_plan(df: DataFrame, plan: RulePlan) -> DataFrame:
    """The lazy DataFrame a plan produces on ``df``."""
    if plan.kind == "predicate":
        return df.filter(plan.predicate(df))
    if plan.kind == "query":
        return query_frame(df, plan.tail)
    if plan.kind == "transform":
        name, col = transform_column(plan, df)
        return df.withColumn(name, col)
    if plan.kind == "group":
        raise RuleError(Status.NOT_APPLICABLE, f"group rule {plan.rule_id} needs aggregates: use group_lookup()")
    raise RuleError(Status.NOT_APPLICABLE, f"value lookup rule {plan.rule_id} is never applied to data")


def evaluate(
    catalog: RuleCatalog,
    process: str,
    process_key: str,
    rule_id: str,
    is_lookup: str = "false",
    value_key: str | None = None,
    df: DataFrame | None = None,
    apply: bool = False,
    as_of=None,
    guard: bool = False,
) -> RuleResult:
    """One rule call: status, message, plan, predicate (bound to ``df``), result.

    Without ``df`` the result carries only the plan and its SQL text (L3).
    With ``df`` the predicate is typed against its schema; with ``apply`` the
    lazy filtered DataFrame is returned too. Lookups are never executed.
    """
    day = _as_date(as_of)
    res = _evaluate(catalog, process, process_key, rule_id, is_lookup, value_key, df, apply, day, guard)
    _log.debug("rule %s (%s/%s, lookup=%s) on %s: %s - %s", res.rule_id, process, process_key, is_lookup, day,
               res.status.value, res.message)
    return res


def _evaluate(catalog, process, process_key, rule_id, is_lookup, value_key, df, apply, day, guard) -> RuleResult:
    try:
        plan = resolve(catalog, process, process_key, rule_id, is_lookup, day, value_key=value_key, guard=guard)
        res = RuleResult(Status.OK, _success_message(plan, value_key), plan.rule_id, plan=plan, chain=plan.chain)
        if plan.kind == "value":
            res.value = plan.value
            return res
        try:
            if df is not None and plan.kind == "predicate":
                res.predicate = plan.predicate(df)
            if df is not None and apply:
                res.df = df.filter(res.predicate) if res.predicate is not None else apply_plan(df, plan)
        except (AnalysisException, ParseException) as exc:  # e.g. a tail naming a missing column
            first = str(exc).strip().splitlines()[0] if str(exc).strip() else type(exc).__name__
            raise RuleError(Status.BAD_QUERY, f"rule {plan.rule_id} does not fit the table: {first}", plan.rule_id) from exc
        return res
    except RuleError as exc:
        return RuleResult(exc.status, exc.message, exc.rule_id or (rule_id or "").strip() or None)


class RuleAddress(NamedTuple):
    """A rule by as much of its 4-tuple as tells it from others of the same id; None leaves a part open."""

    rule_id: str
    process: str | None = None
    process_key: str | None = None
    is_lookup: str | None = None


def rule_plan(catalog: RuleCatalog, rule_id: str | RuleAddress, as_of=None, guard: bool = False, value_key=None) -> RulePlan:
    """Resolve a rule by its id, or by a :class:`RuleAddress` where ids repeat.

    What the address leaves open is taken from the first rule (document order) that fits the rest.
    """
    at = rule_id if isinstance(rule_id, RuleAddress) else RuleAddress(rule_id)
    rules = catalog.rules_with_id(at.rule_id)
    for given, name in ((at.process, "process"), (at.process_key, "process_key"), (at.is_lookup, "is_lookup")):
        if given is not None:
            rules = [r for r in rules if (getattr(r, name) or "").strip() == given.strip()]
    if not rules:
        raise RuleError(Status.NOT_CONFIGURED, f"no rule with id {at.rule_id!r}" if at == RuleAddress(at.rule_id) else f"no rule fits {at}", at.rule_id)
    r = rules[0]
    return resolve(catalog, r.process, r.process_key, r.id, r.is_lookup, _as_date(as_of), value_key=value_key, guard=guard)


def apply_rule(df: DataFrame, catalog: RuleCatalog, rule_id: str | RuleAddress, as_of=None, guard: bool = False) -> DataFrame:
    """T1 by rule id (or address): the lazy DataFrame the rule produces; raises ``RuleError``."""
    return apply_plan(df, rule_plan(catalog, rule_id, as_of=as_of, guard=guard))


def apply_stages(df: DataFrame, catalog: RuleCatalog, rule_ids, as_of=None, guard: bool = False) -> DataFrame:
    """C4: run rules one after the other (filtration, then identification …).

    Each stage's output is the next one's input; nothing is materialised in
    between, so Catalyst merges the filters into one scan.
    """
    out = df
    for rid in rule_ids:
        out = apply_rule(out, catalog, rid, as_of=as_of, guard=guard)
    return out


_LOADED: dict[tuple[str, str], RuleCatalog] = {}


def catalog_for(spark: SparkSession, catalog: RuleCatalog | str) -> RuleCatalog:
    """A catalog as given, or loaded once per session from a document path."""
    if isinstance(catalog, RuleCatalog):
        return catalog
    key = (spark.sparkContext.applicationId, str(catalog))
    if key not in _LOADED or _LOADED[key].spark is not spark:
        _LOADED[key] = RuleCatalog.load(spark, str(catalog))
    return _LOADED[key]


def generate(
    spark: SparkSession,
    catalog: RuleCatalog | str,
    process: str,
    process_key: str,
    rule_id: str,
    lookup: str,
    value_key: str | None = None,
    table_name: str | DataFrame | None = None,
    apply_query: bool = False,
    as_of=None,
    guard: bool = False,
    fresh: bool = False,
):
    """The 5-tuple call shape ``(params_ok, rule_ok, message, text_or_value, df)``.

    ``catalog`` is a :class:`RuleCatalog` or the path of a rule document
    (loaded once per session; ``fresh=True`` re-reads it for this call, for
    documents edited between calls). ``table_name`` may be a registered table /
    view name (S4) or a DataFrame; blank or None means "no table": only the
    text is returned.
    """
    catalog = catalog_for(spark, catalog)
    if fresh:
        catalog.refresh()
    df = None
    if isinstance(table_name, DataFrame) or (table_name is not None and str(table_name).strip()):
        df = read_table(spark, table_name)
    res = evaluate(catalog, process, process_key, rule_id, lookup, value_key, df, apply_query and df is not None, as_of, guard)
    params_ok, rule_ok, message, payload, out = res.as_tuple()
    if res.plan is not None and res.plan.kind in ("predicate", "query"):
        payload = statement_text(res, table_name)
    return params_ok, rule_ok, message, payload, out


def statement_text(res: RuleResult, table_name=None) -> str:
    """The call's SQL statement: ``SELECT * FROM <table> WHERE …`` for a named
    table, else the ``WHERE …`` clause (a query tail as written). Literals are
    typed as in the Column when a table was bound, so running the statement
    with ``spark.sql`` selects the same rows."""
    clause = res.text if res.plan.kind == "query" else f"WHERE {res.text}"
    if isinstance(table_name, str) and table_name.strip():
        return f"SELECT * FROM {table_name.strip()} {clause}"
    return clause
