"""Explicit schema of the rule document.

Declared instead of inferred: inference makes a rule attribute's type depend
on the whole document (all-numeric ``field_value`` would turn into bigint,
all-object ``lookup_value`` into a struct).
"""

from __future__ import annotations

from pyspark.sql import types as T

# One ``when`` element. A condition row uses the first four fields, a lookup
# row only ``lookup_value``. Declaring ``lookup_value`` as a string makes JSON
# objects, arrays and numbers all arrive as their JSON text.
CONDITION = T.StructType(
    [
        T.StructField("field_name", T.StringType()),
        T.StructField("operator", T.StringType()),
        T.StructField("field_value", T.StringType()),
        T.StructField("join", T.StringType()),
        T.StructField("lookup_value", T.StringType()),
    ]
)

ACTION = T.StructType(
    [
        T.StructField("field_name", T.StringType()),
        T.StructField("field_value", T.StringType()),
    ]
)

RULE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("is_valid", T.StringType()),
        T.StructField("valid_from", T.StringType()),
        T.StructField("valid_till", T.StringType()),
        T.StructField("process", T.StringType()),
        T.StructField("process_key", T.StringType()),
        # Older documents name the process key ``key``; both are read.
        T.StructField("key", T.StringType()),
        T.StructField("is_lookup", T.StringType()),
        T.StructField("when", T.ArrayType(CONDITION)),
        T.StructField("then", ACTION),
    ]
)

RULE_DOCUMENT = T.StructType([T.StructField("rules", T.ArrayType(RULE))])

# Fixed value: the date format of ``valid_from`` / ``valid_till`` in rule documents.
RULE_DATE_FORMAT = "dd/MM/yyyy"
