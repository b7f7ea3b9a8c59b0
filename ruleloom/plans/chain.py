"""Rule selection and goto chains → a ``RulePlan``.

A plan is the resolved, table-independent meaning of one call: a flat list
of conditions with their connectors (for a builder chain), or a query tail,
a lookup value, a group-by tail, or a derived column. ``bind`` turns a
predicate plan into one Column for a given DataFrame schema.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import compile_condition, field_types, fold_terms, parse_connector, parse_operator
from .catalog import LOOKUP_KEYS, Condition, Rule, RuleCatalog
from .status import RuleError, Status


@dataclass
class Term:
    rule_id: str
    condition: Condition
    connector: str | None  # links this term to the next one; None on the last


@dataclass
class RulePlan:
    kind: str  # "predicate" | "query" | "value" | "group" | "transform"
    rule_id: str
    chain: list[str] = field(default_factory=list)
    terms: list[Term] = field(default_factory=list)
    guards: list[tuple[str, str | None]] = field(default_factory=list)  # (column, value) pairs, AND-ed; None: is null
    tail: str | None = None  # query / group-by tail
    value: Any = None
    action: tuple[str | None, str | None] = (None, None)  # then.field_name / field_value of the last rule
    bound_types: dict | None = None  # left-side types of the last DataFrame bound

    # -- binding ---------------------------------------------------------
    def fields(self) -> list[str]:
        """Left-side expressions the predicate needs typed."""
        return [t.condition.field_name for t in self.terms] + [g[0] for g in self.guards]

    def predicate(self, df: DataFrame, types: dict | None = None, lefts: dict | None = None) -> Column:
        """The plan's filter as one Column over ``df``'s columns.

        ``types`` (field expression → data type) may be resolved once for
        many plans; otherwise it is resolved here in one analysis pass.
        ``lefts`` caches the left-side Column per field across plans.
        """
        if self.kind == "query":
            cond = where_condition(self.tail, df)
            if cond is None:
                raise RuleError(Status.BAD_QUERY, f"rule {self.rule_id}: lookup tail is not a plain where clause")
            try:  # usable as a per-row value (tagging)? checked once, nothing runs
                df.select(F.expr(cond).alias("_rule"))
            except AnalysisException as exc:
                raise RuleError(
                    Status.BAD_QUERY, f"rule {self.rule_id}: lookup tail cannot be tested per row ({exc.getErrorClass()})",
                    self.rule_id,
                ) from exc
            return F.expr(cond)
        if self.kind != "predicate":
            raise RuleError(Status.NOT_APPLICABLE, f"rule {self.rule_id}: a {self.kind} rule has no predicate")
        if types is None or any(f not in types for f in self.fields()):
            types = field_types(df, self.fields())
        self.bound_types = types
        lefts = {} if lefts is None else lefts
        for f in self.fields():
            if f not in lefts:
                lefts[f] = F.expr(f)
        cols = [
            compile_condition(t.condition.field_name, parse_operator(t.condition.operator, t.rule_id),
                              t.condition.field_value, types[t.condition.field_name], t.rule_id,
                              lefts[t.condition.field_name]).column
            for t in self.terms
        ]
        pred = fold_terms(cols, [t.connector for t in self.terms])
        for name, value in self.guards:
            if value is None:
                pred = lefts[name].isNull() & pred
                continue
            guard = compile_condition(name, parse_operator("=", self.rule_id), value, types[name], self.rule_id,
                                      lefts[name])
            pred = guard.column & pred
        return pred

    def sql(self, types: dict | None = None) -> str:
        """SQL text of the plan (audit / display).

        With ``types`` (as resolved for a bound DataFrame) literals are
        rendered with the same typing as the Column, so ``df.filter(text)``
        selects the same rows; without, digits render as integers.
        """
        if self.kind in ("query", "group"):
            return self.tail or ""
        if self.kind == "value":
            return json.dumps(self.value) if not isinstance(self.value, str) else self.value
        if self.kind == "transform":
            return f"{self.action[1]} AS {self.action[0]}"
        types = types or {}
        texts = [
            compile_condition(t.condition.field_name, parse_operator(t.condition.operator, t.rule_id),
                              t.condition.field_value, types.get(t.condition.field_name), t.rule_id).sql
            for t in self.terms
        ]
        text = fold_terms(texts, [t.connector for t in self.terms])
        for name, value in self.guards:
            guard = f"({name}) IS NULL" if value is None else compile_condition(
                name, parse_operator("=", self.rule_id), value, types.get(name), self.rule_id).sql
            text = f"{guard} AND {text}"
        return text


_WHERE = re.compile(r"^\s*where\s+(.*\S)\s*$", re.IGNORECASE | re.DOTALL)
_GROUP = re.compile(r"^\s*group\s+by\s+(.*\S)\s*$", re.IGNORECASE | re.DOTALL)


def where_filter(tail: str | None, df: DataFrame) -> tuple[str, DataFrame] | None:
    """``" where a = 1 and …"`` → ``("a = 1 and …", df.filter(...))`` when the
    tail is a plain predicate on ``df``; ``None`` when more follows (``ORDER
    BY``, ``LIMIT`` …). ``df.filter(text)`` parses eagerly, nothing runs. By
    itself it would take a word after the predicate for a name, so the text must
    hold in parentheses too.
    """
    m = _WHERE.match(tail or "")
    if not m:
        return None
    try:
        df.filter(f"({m.group(1)}\n)")
        return m.group(1), df.filter(m.group(1))
    except ParseException:
        return None


def where_condition(tail: str | None, df: DataFrame) -> str | None:
    """The predicate text of a plain ``where`` tail (see :func:`where_filter`)."""
    found = where_filter(tail, df)
    return found[0] if found else None


def group_keys(tail: str | None) -> list[str]:
    """``" group by a, b"`` → ``["a", "b"]`` (top-level commas only)."""
    m = _GROUP.match(tail or "")
    if not m:
        raise RuleError(Status.BAD_QUERY, f"group lookup {tail!r} is not of the form 'group by <keys>'")
    keys, depth, cur = [], 0, []
    for ch in m.group(1):
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            keys.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    keys.append("".join(cur).strip())
    if not all(keys):
        raise RuleError(Status.BAD_QUERY, f"group lookup {tail!r} has an empty key")
    return keys


def _strip(x: str | None) -> str:
    return (x or "").strip()


def _lookup_object(rule: Rule) -> dict:
    text = rule.lookup_value
    if text is None:
        raise RuleError(Status.NO_LOOKUP_VALUE, f"rule {rule.id} has no lookup value", rule.id)
    try:
        obj = json.loads(text)
    except ValueError as exc:
        raise RuleError(Status.NOT_AN_OBJECT, f"rule {rule.id}: lookup value is not JSON", rule.id) from exc
    if not isinstance(obj, dict):
        raise RuleError(Status.NOT_AN_OBJECT, f"rule {rule.id}: lookup value is not a JSON object", rule.id)
    return obj


def _as_text(v: Any) -> str | None:
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return v
    return json.dumps(v)


def select_rule(catalog: RuleCatalog, process, process_key, rule_id, is_lookup, as_of: _dt.date) -> Rule:
    """First rule matching the trimmed 4-tuple that can be used."""
    p, k, i, lk = _strip(process), _strip(process_key), _strip(rule_id), _strip(is_lookup)
    candidates = [
        r for r in catalog.rules_with_id(i)
        if _strip(r.process) == p and _strip(r.process_key) == k and _strip(r.is_lookup) == lk
    ]
    if not candidates:
        raise RuleError(
            Status.NOT_CONFIGURED,
            f"no rule is configured for process={p!r}, process_key={k!r}, rule_id={i!r}, is_lookup={lk!r}",
            i or None,
        )
    return catalog.first_usable(i, as_of, allow_empty=(k == "transformation"), candidates=candidates)


def _builder_chain(catalog: RuleCatalog, start: Rule, as_of: _dt.date, entry: bool, guard: bool):
    """Walk ``goto`` links from ``start``; the flat term list of the chain."""
    terms: list[Term] = []
    guards: list[tuple[str, str | None]] = []
    visited: list[str] = []
    rule = start
    while True:
        if rule.id in visited:
            raise RuleError(Status.GOTO_CYCLE, f"goto chain {' -> '.join(visited + [rule.id])} is a cycle", start.id)
        visited.append(rule.id)
        key = rule.process_key
        if key == "conditional" and not entry:
            # a conditional reached by goto adds nothing but passes on
            if not rule.is_goto:
                raise RuleError(Status.CONDITIONAL_NO_GOTO, f"conditional rule {rule.id} has no goto", rule.id)
            if guard:
                guards += [(k, _as_text(v)) for k, v in _lookup_object(rule).items()]
        elif key != "query_builder":
            raise RuleError(
                Status.GOTO_TARGET_KIND if not entry else Status.INVALID_KEY,
                f"rule {rule.id} ({key}) cannot be part of a condition chain",
                rule.id,
            )
        else:
            conds = rule.conditions
            for n, c in enumerate(conds):
                if c.field_name is None or not c.field_name.strip():
                    raise RuleError(Status.BAD_FIELD, f"rule {rule.id}: a condition has no field name", rule.id)
                parse_operator(c.operator, rule.id)
                if c.field_value is None:
                    raise RuleError(Status.BAD_VALUE, f"rule {rule.id}: condition on {c.field_name!r} has no value", rule.id)
                conn = parse_connector(c.join, rule.id)
                if n < len(conds) - 1 and conn is None:
                    if entry:
                        raise RuleError(
                            Status.MISSING_CONNECTOR,
                            f"rule {rule.id}: condition {n + 1} has no AND/OR before the next one",
                            rule.id,
                        )
                    conn = "AND"
                terms.append(Term(rule.id, c, conn))
        if rule.is_goto:
            if terms and terms[-1].connector is None:
                terms[-1].connector = "AND"
            target_id = _strip(rule.then_value)
            try:
                rule = catalog.first_usable(target_id, as_of)
            except RuleError as exc:
                if exc.status is Status.GOTO_UNKNOWN:
                    exc.message = f"rule {visited[-1]} jumps to unknown rule {target_id!r}"
                    exc.args = (exc.message,)
                raise
            entry = False
            continue
        if not terms:
            raise RuleError(Status.NO_CONDITIONS, f"chain from rule {start.id} has no conditions", start.id)
        if terms[-1].connector is not None:
            raise RuleError(
                Status.TRAILING_CONNECTOR,
                f"rule {rule.id}: last condition ends with {terms[-1].connector} but nothing follows",
                rule.id,
            )
        return terms, guards, visited, (rule.then_field, rule.then_value)


def resolve(
    catalog: RuleCatalog,
    process: str,
    process_key: str,
    rule_id: str,
    is_lookup: str,
    as_of: _dt.date,
    value_key: str | None = None,
    guard: bool = False,
) -> RulePlan:
    """The §2.9 protocol as a plan or a ``RuleError``."""
    rule = select_rule(catalog, process, process_key, rule_id, is_lookup, as_of)
    key = rule.process_key

    if key in LOOKUP_KEYS:
        if not rule.lookup_flag:
            raise RuleError(Status.LOOKUP_FLAG, f"lookup rule {rule.id} is not flagged is_lookup=true", rule.id)
        if key == "conditional":
            if not rule.is_goto:
                raise RuleError(
                    Status.CONDITIONAL_NO_GOTO, f"conditional rule {rule.id} has no goto to a condition rule", rule.id
                )
            guards = [(k, _as_text(v)) for k, v in _lookup_object(rule).items()] if guard else []
            target = catalog.first_usable(_strip(rule.then_value), as_of) if rule.then_value else None
            if target is None:
                raise RuleError(Status.GOTO_UNKNOWN, f"conditional rule {rule.id} jumps nowhere", rule.id)
            terms, more, chain, action = _builder_chain(catalog, target, as_of, entry=False, guard=guard)
            return RulePlan("predicate", rule.id, [rule.id] + chain, terms, guards + more, action=action)
        text = rule.lookup_value
        if text is None:
            raise RuleError(Status.NO_LOOKUP_VALUE, f"rule {rule.id} has no lookup value", rule.id)
        if key == "query_lookup":
            tail = text.strip()
            if not tail:
                raise RuleError(Status.BAD_QUERY, f"rule {rule.id} has an empty lookup query", rule.id)
            return RulePlan("query", rule.id, [rule.id], tail=tail, action=(rule.then_field, rule.then_value))
        if key == "groupby_lookup":
            group_keys(text)  # validate now
            return RulePlan("group", rule.id, [rule.id], tail=text.strip())
        # value_lookup (L1 / L2); JSON types are kept
        try:
            obj = json.loads(text)
        except ValueError:
            obj = None
        vk = _strip(value_key)
        if vk:
            if not isinstance(obj, dict) or vk not in obj:
                raise RuleError(
                    Status.VALUE_KEY_MISSING, f"value key {vk!r} is not set in lookup rule {rule.id}", rule.id
                )
            return RulePlan("value", rule.id, [rule.id], tail=text, value=obj[vk])
        if not isinstance(obj, dict):
            raise RuleError(Status.NOT_AN_OBJECT, f"lookup rule {rule.id} does not hold a JSON object", rule.id)
        return RulePlan("value", rule.id, [rule.id], tail=text, value=list(obj.items()))

    if key == "query_builder":
        if rule.lookup_flag:
            raise RuleError(Status.LOOKUP_FLAG, f"builder rule {rule.id} is flagged as a lookup", rule.id)
        terms, guards, chain, action = _builder_chain(catalog, rule, as_of, entry=True, guard=guard)
        return RulePlan("predicate", rule.id, chain, terms, guards, action=action)

    if key == "transformation":
        if not _strip(rule.then_field) or not _strip(rule.then_value):
            raise RuleError(Status.BAD_FIELD, f"transformation rule {rule.id} needs then.field_name and field_value", rule.id)
        terms: list[Term] = []
        if rule.conditions:
            terms, _, _, _ = _builder_chain(catalog, _without_goto(rule), as_of, entry=True, guard=False)
        return RulePlan("transform", rule.id, [rule.id], terms, action=(_strip(rule.then_field), rule.then_value))

    raise RuleError(Status.INVALID_KEY, f"rule {rule.id} has unknown process key {key!r}", rule.id)


def _without_goto(rule: Rule) -> Rule:
    from dataclasses import replace

    return replace(rule, process_key="query_builder", then_field=None, then_value=None)


def transform_column(plan: RulePlan, df: DataFrame) -> tuple[str, Column]:
    """``then.field_value`` as an expression, limited to matching rows."""
    name, expr = plan.action
    value = F.expr(expr)
    if plan.terms:
        cond = RulePlan("predicate", plan.rule_id, terms=plan.terms).predicate(df)
        other = F.col(name) if name in df.columns else F.lit(None)
        value = F.when(cond, value).otherwise(other)
    return name, value
