"""Value lookups (L1, L2) from rules, and rule lookups matched against data.

``value`` / ``values`` answer a single request from the (tiny) rule document.
``rule_values`` returns every lookup pair of every rule as a DataFrame built
on the executors. ``match_lookup`` applies a rule's lookup object to a JSON
column of the facts: rows whose object holds every pair of the rule.
"""

from __future__ import annotations

import json
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lookups import JSON_MAP, normal_json, number_key, number_key_of
from ..plans.catalog import RuleCatalog
from ..plans.status import RuleError, RuleResult, Status
from .apply import RuleAddress, evaluate, rule_plan


def value(catalog: RuleCatalog, rule_id: str, value_key: str, as_of=None, process: str | None = None) -> RuleResult:
    """L1: the value a lookup rule stores under ``value_key``."""
    if isinstance(rule_id, RuleAddress):
        rule_id, process = rule_id.rule_id, rule_id.process if process is None else process
    rules = catalog.rules_with_id(rule_id)
    proc = process if process is not None else (rules[0].process if rules else "")
    return evaluate(catalog, proc, "value_lookup", rule_id, "true", value_key=value_key, as_of=as_of)


def values(catalog: RuleCatalog, rule_id: str, as_of=None, process: str | None = None) -> RuleResult:
    """L2: all ``(key, value)`` pairs of a lookup rule."""
    return value(catalog, rule_id, None, as_of=as_of, process=process)


def rule_values(catalog: RuleCatalog) -> DataFrame:
    """L2 for the whole document: ``(rule_pos, rule_id, key, value)``.

    Lookups that are not JSON objects (SQL tails, arrays) yield no pairs.
    """
    lv = catalog.lookup_values().select(
        "rule_pos", F.col("id").alias("rule_id"), F.from_json("lookup_value", JSON_MAP).alias("m")
    )
    return lv.select("rule_pos", "rule_id", F.explode("m").alias("key", "value"))


def _typed_pairs(catalog: RuleCatalog, rule_id: str, as_of=None) -> list[tuple[str, object]]:
    """The rule's pairs; numbers as whole numbers or decimals, with all their digits."""
    res = values(catalog, rule_id, as_of=as_of)
    if not res.ok:
        raise RuleError(res.status, res.message, rule_id)
    return list(json.loads(res.plan.tail, parse_float=Decimal).items())


def _text(v) -> str | None:
    return v if v is None or isinstance(v, str) else str(v) if isinstance(v, Decimal) else json.dumps(v, ensure_ascii=False, default=_number)


def _number(v):
    return float(v)


def lookup_pairs(catalog: RuleCatalog, rule_id: str, as_of=None) -> list[tuple[str, str | None]]:
    """The rule's pairs with values as text: JSON text for anything but strings."""
    return [(k, _text(v)) for k, v in _typed_pairs(catalog, rule_id, as_of)]


_PLAIN_INTEGER = "^(0|-?[1-9][0-9]*)$"


def _holds(found: Column, key: str, wanted) -> Column:
    """Whether a ``map<string,string>`` of JSON values holds ``wanted`` under ``key``.

    Text compares as text (the text 9 also meets the number 9), numbers by
    their exact value, objects and lists by their normal form, null only with a null.
    """
    v = F.try_element_at(found, F.lit(key))
    if wanted is None:
        return F.map_contains_key(found, key) & v.isNull()
    if isinstance(wanted, bool) or isinstance(wanted, str):
        return v == F.lit(_text(wanted))
    if isinstance(wanted, (int, Decimal)):
        # Whole numbers in their usual spelling differ in value if they differ in text.
        odd = number_key(v) == F.lit(number_key_of(wanted))
        if wanted == int(wanted) and abs(wanted) < 10**30:
            return F.when(v == F.lit(str(int(wanted))), F.lit(True)).when(v.rlike(_PLAIN_INTEGER), F.lit(False)).otherwise(odd)
        return odd
    return normal_json(v) == F.to_json(F.parse_json(F.lit(_text(wanted))))


def _may_hold(json_text: Column, key: str, wanted) -> Column:
    """A test on the unparsed text that every row holding the pair passes.

    An object that spells anything with escapes passes; in others the key stands as it is, a
    text too, and a number's first significant digit at least.
    """
    tests = [json_text.contains(key)] if not any(c in key for c in '"\\/') and key.isprintable() else []
    if isinstance(wanted, str) and wanted.isprintable() and not any(c in wanted for c in '"\\/'):
        tests.append(json_text.contains(wanted))
    elif isinstance(wanted, bool):
        tests.append(json_text.contains(_text(wanted)))
    elif isinstance(wanted, (int, Decimal)):
        tests.append(json_text.contains(number_key_of(wanted).lstrip("-")[0]))
    plain = reduce(lambda a, b: a & b, tests) if tests else F.lit(True)
    return plain | json_text.contains("\\")


def match_lookup(df: DataFrame, catalog: RuleCatalog, rule_id: str, json_col: str, as_of=None,
                 extract: bool = True) -> DataFrame:
    """Rows whose JSON object column holds every pair of the lookup rule.

    Rows whose text cannot hold the pairs go before anything is parsed; the
    others' object is parsed once (``from_json`` to a map) and every pair
    tested on the map: no UDF, no shuffle. With ``extract`` each key is also
    returned as its own column, holding the rule's value as text.
    """
    pairs = _typed_pairs(catalog, rule_id, as_of=as_of)
    if not pairs:
        raise RuleError(Status.NO_LOOKUP_VALUE, f"lookup rule {rule_id} holds no pairs", rule_id)
    text = F.col(f"`{json_col}`")
    parsed = F.array(F.from_json(text, JSON_MAP))
    for k, v in pairs:
        df = df.filter(_may_hold(text, k, v))
    # inside ``exists`` the parsed map is one value, however many pairs test it
    out = df.filter(F.exists(parsed, lambda m: reduce(lambda a, b: a & b, [_holds(m, k, v) for k, v in pairs])))
    if not extract:
        return out
    keys = [k for k, _ in pairs]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    return out.select(*kept, *[F.lit(_text(v)).cast("string").alias(k) for k, v in pairs])


#: Copies of the rules that hot pairs of the data are dealt over.
SALTS = 8


def _pair_value(v) -> tuple[str, str]:
    """(kind, text) under which a rule's value meets the data's."""
    if v is None:
        return "null", ""
    if isinstance(v, (str, bool)):
        return "text", _text(v)
    if isinstance(v, (int, Decimal)):
        return "number", number_key_of(v)
    return "json", _text(v)


def _rule_pairs(catalog: RuleCatalog, rule_ids, as_of) -> tuple[DataFrame, DataFrame]:
    """(rule_pos, rule_id, n_pairs) and (rule_pos, key, kind, value) of lookup rules."""
    rules, pairs = [], []
    for pos, rid in enumerate(rule_ids):
        found = _typed_pairs(catalog, rid, as_of)
        rid = rid.rule_id if isinstance(rid, RuleAddress) else rid
        if not found:
            raise RuleError(Status.NO_LOOKUP_VALUE, f"lookup rule {rid} holds no pairs", rid)
        rules.append((pos, rid, len(found)))
        pairs += [(pos, k, *_pair_value(v)) for k, v in found]
    spark = catalog.spark
    table = spark.createDataFrame(pairs, "rule_pos int, key string, kind string, value string")
    same = F.when(F.col("kind") == "json", F.to_json(F.try_parse_json("value"))).otherwise(F.col("value"))
    return spark.createDataFrame(rules, "rule_pos int, rule_id string, n_pairs int"), table.withColumn("value", same)


def _object_pairs(objects: DataFrame) -> DataFrame:
    """(object, key, kind, value): all that a rule's pair could meet; of a repeated key the first value counts."""
    entries = objects.select("object", F.map_entries(F.from_json("json", JSON_MAP)).alias("e"))
    keys = F.transform("e", lambda x: x["key"])
    first = F.filter("e", lambda x, i: F.array_position(keys, x["key"]) == i + 1)
    each = entries.select("object", F.explode(first).alias("e")).select("object", F.col("e.key").alias("key"), F.col("e.value").alias("v"))
    kinds = F.array(
        F.struct(F.lit("null").alias("kind"), F.when(F.col("v").isNull(), F.lit("")).alias("value")),
        F.struct(F.lit("text").alias("kind"), F.col("v").alias("value")),
        F.struct(F.lit("number").alias("kind"), number_key(F.col("v")).alias("value")),
        F.struct(F.lit("json").alias("kind"), normal_json(F.col("v")).alias("value")),
    )
    return each.select("object", "key", F.explode(F.filter(kinds, lambda x: x["value"].isNotNull())).alias("p")).select("object", "key", "p.*")


def match_lookups(df: DataFrame, catalog: RuleCatalog, rule_ids, json_col: str, as_of=None) -> DataFrame:
    """L1/L2 over all rules at once: every row with every rule whose pairs its JSON object all holds.

    A relational division: equal objects are parsed once; each rule is met by the pair of
    it that the fewest objects hold, and what it meets counts its other pairs there. The pairs of
    the rules are a small table that Spark broadcasts if it is; otherwise pairs that many objects
    hold are dealt over ``SALTS`` copies of the rules. Returns the columns of ``df``, then ``rule_pos`` and
    ``rule_id`` (which replace columns of these names); a row that fits no rule is not returned, nor is one whose
    value is null or no object.
    """
    rules, wanted = _rule_pairs(catalog, rule_ids, as_of)
    pair, text = ["key", "kind", "value"], F.col(f"`{json_col}`")
    mark = "object"
    while mark in df.columns:
        mark += "_"
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("rule_pos", "rule_id")]
    facts = df.select(*kept, F.sha2(text.cast("string"), 256).alias(mark))
    objects = df.select(F.sha2(text.cast("string"), 256).alias("object"), text.cast("string").alias("json")).filter("json is not null").dropDuplicates(["object"])
    held = _object_pairs(objects).join(wanted.select(*pair).distinct(), pair, "left_semi")
    often = held.groupBy(*pair).agg(F.count(F.lit(1)).alias("often"))
    # Rules with a pair that no object holds fit nothing.
    rarest = wanted.join(often, pair, "left").groupBy("rule_pos").agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), *pair)).alias("p"))
    anchors = rarest.filter("p.often > 0").select("rule_pos", "p.key", "p.kind", "p.value", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = held.withColumn("salt", F.pmod(F.xxhash64("object"), F.lit(SALTS)).cast("int"))
    met = dealt.join(anchors, [*pair, "salt"]).select("object", "rule_pos")
    counted = met.join(wanted, "rule_pos").join(held, ["object", *pair]).groupBy("object", "rule_pos").agg(F.count(F.lit(1)).alias("n_met"))
    fits = counted.join(rules, "rule_pos").filter(F.col("n_met") == F.col("n_pairs")).select(F.col("object").alias(mark), "rule_pos", "rule_id")
    return facts.join(fits, mark).drop(mark)


def guard_pairs(catalog: RuleCatalog, rule_id: str, as_of=None) -> list[tuple[str, str]]:
    """The lookup pairs a conditional rule would guard its branch with."""
    plan = rule_plan(catalog, rule_id, as_of=as_of, guard=True)
    return list(plan.guards)
