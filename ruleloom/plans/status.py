"""Outcome protocol: every call returns a status instead of failing silently."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum
from typing import Any


class Status(str, Enum):
    OK = "ok"
    NOT_CONFIGURED = "not_configured"
    OFF = "off"
    OUT_OF_WINDOW = "out_of_window"
    BAD_DATE = "bad_date"
    NO_CONDITIONS = "no_conditions"
    INVALID_KEY = "invalid_key"
    LOOKUP_FLAG = "lookup_flag_mismatch"
    NO_LOOKUP_VALUE = "no_lookup_value"
    VALUE_KEY_MISSING = "value_key_missing"
    NOT_AN_OBJECT = "lookup_not_object"
    CONDITIONAL_NO_GOTO = "conditional_without_goto"
    GOTO_UNKNOWN = "goto_unknown"
    GOTO_CYCLE = "goto_cycle"
    GOTO_TARGET_KIND = "goto_target_kind"
    MISSING_CONNECTOR = "missing_connector"
    TRAILING_CONNECTOR = "trailing_connector"
    BAD_CONNECTOR = "bad_connector"
    BAD_OPERATOR = "bad_operator"
    BAD_VALUE = "bad_value"
    BAD_FIELD = "bad_field"
    BAD_QUERY = "bad_query"
    NOT_APPLICABLE = "not_applicable"


# A request that cannot be served although the rule itself is fine reports
# ``params_ok=False, rule_ok=True`` (value key absent, lookup is not an object,
# conditional without a jump). ``NOT_CONFIGURED`` reports both False.
_PARAMS_FAIL = {Status.NOT_CONFIGURED, Status.VALUE_KEY_MISSING, Status.NOT_AN_OBJECT, Status.CONDITIONAL_NO_GOTO}
_RULE_OK = {Status.OK, Status.VALUE_KEY_MISSING, Status.NOT_AN_OBJECT, Status.CONDITIONAL_NO_GOTO}


class RuleError(Exception):
    """A rule cannot be used; carries the status reported to the caller."""

    def __init__(self, status: Status, message: str, rule_id: str | None = None):
        super().__init__(message)
        self.status = status
        self.message = message
        self.rule_id = rule_id


@dataclass
class RuleResult:
    status: Status
    message: str
    rule_id: str | None = None
    plan: Any = None  # plans.chain.RulePlan
    value: Any = None  # value lookups
    df: Any = None  # pyspark DataFrame when applied
    predicate: Any = None  # pyspark Column when bound to a DataFrame
    chain: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return self.status is Status.OK

    @property
    def params_ok(self) -> bool:
        return self.status not in _PARAMS_FAIL

    @property
    def rule_ok(self) -> bool:
        return self.status in _RULE_OK

    @property
    def text(self) -> str:
        """Predicate / query tail as SQL text ("" when there is none)."""
        if self.plan is None:
            return ""
        return self.plan.sql(self.plan.bound_types)

    def as_tuple(self):
        """``(params_ok, rule_ok, message, text_or_value, df)``."""
        payload = self.value if self.plan is not None and self.plan.kind == "value" else self.text
        return self.params_ok, self.rule_ok, self.message, payload, self.df

    def raise_for_status(self) -> "RuleResult":
        if not self.ok:
            raise RuleError(self.status, self.message, self.rule_id)
        return self
