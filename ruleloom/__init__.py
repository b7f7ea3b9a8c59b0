"""ruleloom: declarative JSON rules compiled to Spark Columns.

Rules filter, identify and tag the rows of DataFrames. A rule document is
loaded once into a :class:`RuleCatalog`; each call resolves a rule (and the
rules it jumps to) into a plan, binds it to a DataFrame as one Column and
returns a lazy result with a status.
"""

from .operators.actions import (
    rule_hit_counts,
    rule_index,
    rule_predicates,
    rule_statuses,
    tag,
    tag_all,
    transform,
    validate_rules,
)
from .operators.aggregate import exact_sum, group_lookup, order_by, time_span
from .operators.apply import (
    RuleAddress,
    apply_plan,
    apply_rule,
    apply_stages,
    catalog_for,
    evaluate,
    generate,
    query_frame,
    rule_plan,
)
from .operators.lookups import match_lookup, match_lookups, rule_values, value, values
from .plans.catalog import Condition, Rule, RuleCatalog, split_rules
from .plans.chain import RulePlan, resolve
from .plans.status import RuleError, RuleResult, Status

__all__ = [
    "RuleCatalog", "split_rules", "Rule", "Condition", "RulePlan", "RuleResult", "RuleError", "Status", "RuleAddress",
    "resolve", "evaluate", "generate", "catalog_for", "rule_plan", "apply_rule", "apply_plan", "apply_stages", "query_frame",
    "tag", "tag_all", "transform", "rule_hit_counts", "rule_index", "rule_predicates", "rule_statuses", "validate_rules",
    "value", "values", "rule_values", "match_lookup", "match_lookups",
    "group_lookup", "time_span", "order_by", "exact_sum",
]
