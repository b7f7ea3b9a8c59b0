"""The rule catalog (R1–R9): rule documents as DataFrames plus a small index.

The document is parsed on the executors (``posexplode`` keeps rule and
condition order, attributes are trimmed, dates are parsed with
``try_to_date``). Only the rules a call needs are brought to the driver to
build Columns: the whole document when it is small (one job, cached), or
just the requested ids when it is not. Fact data never comes near this.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import read_rule_document, rule_document_from_text
from ..sources.schema import RULE_DATE_FORMAT
from .status import RuleError, Status

# The process keys a rule may carry and the lookup-style ones.
PROCESS_KEYS = ("query_lookup", "value_lookup", "query_builder", "conditional", "groupby_lookup", "transformation")
LOOKUP_KEYS = ("query_lookup", "value_lookup", "groupby_lookup", "conditional")
TRUE_TEXT = "true"


@dataclass(frozen=True)
class Condition:
    pos: int
    field_name: str | None
    operator: str | None
    field_value: str | None
    join: str | None
    lookup_value: str | None


@dataclass(frozen=True)
class Rule:
    pos: int
    source: str
    id: str
    name: str | None
    description: str | None
    is_valid: str | None
    valid_from: str | None
    valid_till: str | None
    valid_from_date: _dt.date | None
    valid_till_date: _dt.date | None
    process: str | None
    process_key: str | None
    is_lookup: str | None
    then_field: str | None
    then_value: str | None
    conditions: tuple[Condition, ...]

    @property
    def active(self) -> bool:
        return self.is_valid == TRUE_TEXT

    @property
    def lookup_flag(self) -> bool:
        return self.is_lookup == TRUE_TEXT

    @property
    def lookup_value(self) -> str | None:
        """The rule's lookup entry: the first ``when`` element (first wins)."""
        return self.conditions[0].lookup_value if self.conditions else None

    @property
    def is_goto(self) -> bool:
        return self.then_field == "goto"

    def check_usable(self, as_of: _dt.date) -> None:
        """R6 active flag, then R7 window (inclusive, day grain)."""
        if not self.active:
            raise RuleError(Status.OFF, f"rule {self.id} is switched off (is_valid={self.is_valid!r})", self.id)
        if self.valid_from_date is None or self.valid_till_date is None:
            raise RuleError(
                Status.BAD_DATE,
                f"rule {self.id} has an unreadable validity window "
                f"({self.valid_from!r} .. {self.valid_till!r}, expected dd/MM/yyyy)",
                self.id,
            )
        if not (self.valid_from_date <= as_of <= self.valid_till_date):
            raise RuleError(
                Status.OUT_OF_WINDOW,
                f"rule {self.id} is valid from {self.valid_from_date} to {self.valid_till_date}, "
                f"not on {as_of}; skipped",
                self.id,
            )


def rules_frame(documents: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per rule, document order kept as ``(source, rule_pos)``.

    ``when`` stays an array on its rule (so duplicate ids never mix their
    conditions); each element gets its position ``cond_pos``. With
    ``keep_empty`` a document without a ``rules`` array (malformed) still
    yields one row, with a null ``rule_pos``.
    """
    # texts held in memory have a place in their list, files a name
    source = F.lpad(F.col("doc_pos").cast("string"), 10, "0") if "doc_pos" in documents.columns else F.input_file_name()
    explode = F.posexplode_outer if keep_empty else F.posexplode
    exploded = documents.select(
        source.alias("source"), F.col("rules").isNull().alias("malformed"),
        explode("rules").alias("rule_pos", "r"),
    )
    return exploded.select(
        *(["malformed"] if keep_empty else []),
        "source",
        "rule_pos",
        F.trim("r.id").alias("id"),
        F.trim("r.name").alias("name"),
        F.trim("r.description").alias("description"),
        F.trim("r.is_valid").alias("is_valid"),
        F.col("r.valid_from").alias("valid_from"),
        F.col("r.valid_till").alias("valid_till"),
        F.try_to_date(F.trim("r.valid_from"), RULE_DATE_FORMAT).alias("valid_from_date"),
        F.try_to_date(F.trim("r.valid_till"), RULE_DATE_FORMAT).alias("valid_till_date"),
        F.trim("r.process").alias("process"),
        F.trim(F.coalesce("r.process_key", "r.key")).alias("process_key"),
        F.trim("r.is_lookup").alias("is_lookup"),
        F.trim("r.then.field_name").alias("field_name"),
        F.col("r.then.field_value").alias("field_value"),
        F.transform(
            F.coalesce(F.col("r.when"), F.array()),
            lambda c, i: F.struct(
                i.alias("cond_pos"),
                c["field_name"].alias("field_name"),
                c["operator"].alias("operator"),
                c["field_value"].alias("field_value"),
                c["join"].alias("join"),
                c["lookup_value"].alias("lookup_value"),
            ),
        ).alias("when"),
    )


def _to_rule(row) -> Rule:
    conds = tuple(
        Condition(c["cond_pos"], c["field_name"], c["operator"], c["field_value"], c["join"], c["lookup_value"])
        for c in (row["when"] or [])
    )
    return Rule(
        pos=row["rule_pos"],
        source=row["source"] or "",
        id=row["id"],
        name=row["name"],
        description=row["description"],
        is_valid=row["is_valid"],
        valid_from=row["valid_from"],
        valid_till=row["valid_till"],
        valid_from_date=row["valid_from_date"],
        valid_till_date=row["valid_till_date"],
        process=row["process"],
        process_key=row["process_key"],
        is_lookup=row["is_lookup"],
        then_field=row["field_name"],
        then_value=row["field_value"],
        conditions=conds,
    )


class RuleCatalog:
    """Rules loaded once per session; pass the catalog to every call."""

    def __init__(self, documents: DataFrame, path: str | None = None):
        self.spark: SparkSession = documents.sparkSession
        self.path = path
        self._use(documents)

    def _use(self, documents: DataFrame) -> None:
        self.documents = documents
        self.frame = rules_frame(documents)
        self._by_id: dict[str, list[Rule]] = {}
        self._loaded = False

    def refresh(self) -> "RuleCatalog":
        """Forget the index; a catalog loaded from a path reads it again
        (edited rules take effect on the next call)."""
        self._use(read_rule_document(self.spark, self.path) if self.path else self.documents)
        return self

    # -- construction ---------------------------------------------------
    @classmethod
    def load(cls, spark: SparkSession, path: str, **kw) -> "RuleCatalog":
        return cls(read_rule_document(spark, path), path=path, **kw)

    @classmethod
    def from_json(cls, spark: SparkSession, text: str | list[str], **kw) -> "RuleCatalog":
        return cls(rule_document_from_text(spark, text), **kw)

    # -- driver index: rule documents are configuration, all of it is held ---
    def _ensure_index(self) -> None:
        if self._loaded:
            return
        # one job: all rules and any malformed document
        head = rules_frame(self.documents, keep_empty=True).collect()
        if any(r["malformed"] for r in head):
            raise ValueError("a rule document is malformed or has no 'rules' array")
        by_id: dict[str, list[Rule]] = {}
        for row in sorted((r for r in head if r["rule_pos"] is not None), key=lambda r: (r["source"] or "", r["rule_pos"])):
            if row["id"] is not None:
                by_id.setdefault(row["id"], []).append(_to_rule(row))
        self._by_id = by_id
        self._loaded = True

    def rules_with_id(self, rule_id: str) -> list[Rule]:
        return self.rules_with_ids([rule_id]).get(rule_id, [])

    def rules_with_ids(self, rule_ids) -> dict[str, list[Rule]]:
        self._ensure_index()
        ids = [i.strip() for i in ((r if isinstance(r, str) else r[0]) for r in rule_ids if r is not None) if i is not None]
        return {i: self._by_id.get(i, []) for i in ids}

    def all_ids(self) -> list[str]:
        """Rule ids in document order, each once."""
        self._ensure_index()
        rules = sorted((r for rs in self._by_id.values() for r in rs), key=lambda r: (r.source, r.pos))
        return list(dict.fromkeys(r.id for r in rules))

    def first_usable(self, rule_id: str, as_of: _dt.date, allow_empty: bool = False, candidates=None) -> Rule:
        """First rule (document order) with this id that can be used.

        A switched-off, expired or badly dated match ends the search with
        its own status; a match without conditions lets a later duplicate
        take over (``allow_empty`` for rules that need none).
        """
        rules = self.rules_with_id(rule_id) if candidates is None else candidates
        if not rules:
            raise RuleError(Status.GOTO_UNKNOWN, f"no rule with id {rule_id!r}", rule_id)
        for rule in rules:
            rule.check_usable(as_of)
            if rule.conditions or allow_empty:
                return rule
        raise RuleError(Status.NO_CONDITIONS, f"rule {rule_id} has no conditions", rule_id)

    # -- DataFrame views (R2, R3, R9) -------------------------------------
    def headers(self) -> DataFrame:
        """R2: one row per rule with ``then.*`` flattened."""
        return self.frame.select(
            "source", "rule_pos", "id", "name", "description", "is_valid", "valid_from", "valid_till",
            "process", "process_key", "is_lookup", "field_name", "field_value",
            F.size("when").alias("n_conditions"),
        )

    def conditions(self) -> DataFrame:
        """One row per ``when`` element; rules without conditions have none."""
        return self.frame.select("source", "rule_pos", "id", F.explode("when").alias("c")).select(
            "source", "rule_pos", "id", "c.*"
        )

    def duplicates(self) -> DataFrame:
        """Rule ids defined more than once (the first definition wins)."""
        return self.frame.groupBy("id").agg(F.count(F.lit(1)).alias("n_definitions")).filter("n_definitions > 1")

    def status(self, as_of: _dt.date) -> DataFrame:
        """Per-rule status on ``as_of`` as a DataFrame (no driver work)."""
        day = F.lit(as_of).cast("date")
        key = F.col("process_key")
        st = (
            F.when(F.col("id").isNull() | (F.col("id") == ""), F.lit(Status.BAD_FIELD.value))
            .when(F.col("is_valid").isNull() | (F.col("is_valid") != TRUE_TEXT), F.lit(Status.OFF.value))
            .when(F.col("valid_from_date").isNull() | F.col("valid_till_date").isNull(), F.lit(Status.BAD_DATE.value))
            .when(~day.between(F.col("valid_from_date"), F.col("valid_till_date")), F.lit(Status.OUT_OF_WINDOW.value))
            .when(key.isNull() | ~key.isin(*PROCESS_KEYS), F.lit(Status.INVALID_KEY.value))
            .when((F.size("when") == 0) & (key != "transformation"), F.lit(Status.NO_CONDITIONS.value))
            .when(key.isin(*LOOKUP_KEYS) & (F.col("is_lookup") != TRUE_TEXT), F.lit(Status.LOOKUP_FLAG.value))
            .when((key == "query_builder") & (F.col("is_lookup") == TRUE_TEXT), F.lit(Status.LOOKUP_FLAG.value))
            .otherwise(F.lit(Status.OK.value))
        )
        msg = (
            F.when(st == Status.OK.value, F.concat(F.lit("rule "), F.col("id"), F.lit(" is active")))
            .when(st == Status.OFF.value, F.concat(F.lit("rule "), F.col("id"), F.lit(" is switched off")))
            .when(st == Status.BAD_DATE.value, F.concat(F.lit("rule "), F.col("id"), F.lit(" has an unreadable validity window")))
            .when(
                st == Status.OUT_OF_WINDOW.value,
                F.concat(
                    F.lit("rule "), F.col("id"), F.lit(" is valid from "), F.col("valid_from_date").cast("string"),
                    F.lit(" to "), F.col("valid_till_date").cast("string"),
                ),
            )
            .when(st == Status.INVALID_KEY.value, F.concat(F.lit("rule "), F.col("id"), F.lit(" has an unknown process key")))
            .when(st == Status.NO_CONDITIONS.value, F.concat(F.lit("rule "), F.col("id"), F.lit(" has no conditions")))
            .when(st == Status.LOOKUP_FLAG.value, F.concat(F.lit("rule "), F.col("id"), F.lit(" has a lookup flag that does not fit its key")))
            .otherwise(F.lit("rule without id"))
        )
        return self.frame.select("source", "rule_pos", "id", "process", "process_key", st.alias("status"), msg.alias("message"))

    def lookup_values(self) -> DataFrame:
        """The lookup entry (first ``when`` element) of every lookup rule."""
        return self.frame.filter(F.col("process_key").isin(*LOOKUP_KEYS)).select(
            "source", "rule_pos", "id", "process_key", F.get(F.col("when"), 0)["lookup_value"].alias("lookup_value")
        )


def split_rules(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """R1–R3 in one call: ``(headers, conditions)`` of rule documents."""
    cat = RuleCatalog(documents)
    return cat.headers(), cat.conditions()
