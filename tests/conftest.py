import datetime as dt
import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ruleloom.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
AS_OF = dt.date(2022, 3, 1)


@pytest.fixture(scope="session")
def spark():
    s = local_session(shuffle_partitions=8, app="ruleloom-tests")
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ruleloom-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sample(spark):
    """Parcels of three vans: gross weight is net, wrapping and pallet together."""
    rows = [
        (1, 51, "LETTERBOX", 2600, 1400, 0, True, "mill", "north"),
        (1, 52, "LETTERBOX", 4200, 6400, 0, True, "mill", "north"),
        (2, 527, "CRATE", 11000, 6100, 500, True, "mill", "east"),
        (1, 53, "LETTERBOX", 600, 9900, 0, True, "mill", "036"),
        (2, 54, "LETTERBOX", 12500, 900, 100, True, "quay", "east"),
        (1, 55, "LETTERBOX", 1700, 250, 0, True, "mill", "south"),
        (2, 56, "LETTERBOX", 8500, 2700, 1900, True, "mill", "north"),
        (3, 57, "LETTERBOX", 800, 2100, 0, True, "mill", "west"),
        (3, 58, "LETTERBOX", 950, 700, 0, False, "quay", "west"),
    ]
    made = [(v, p, k, n, w, n + w + b, i, d, z, f"K7{v}00") for v, p, k, n, w, b, i, d, z in rows]
    return spark.createDataFrame(
        made, "van int, parcel int, kind string, net_g int, wrap_g int, gross_g int, insured boolean, depot string, zone string, route string"
    ).cache()


@pytest.fixture(scope="session")
def orders_small(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def cond(field, op, value, join=""):
    return {"field_name": field, "operator": op, "field_value": value, "join": join}


def rule(rid, when, then=("", ""), key="query_builder", lookup="false", process="identification",
         valid="true", window=("10/12/2021", "10/12/2999")):
    return {"id": rid, "name": "T", "description": rid, "is_valid": valid, "valid_from": window[0],
            "valid_till": window[1], "process": process, "process_key": key, "is_lookup": lookup,
            "when": when, "then": {"field_name": then[0], "field_value": then[1]}}


def lookup(value):
    return {"lookup_value": value}


def catalog_of(spark, rules):
    from ruleloom import RuleCatalog

    return RuleCatalog.from_json(spark, json.dumps({"rules": rules}))
