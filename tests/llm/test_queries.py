"""The registered queries: every column that they promise, on whole small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from ruleloom.llm import packing, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def answers(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_decontamination_query(spark, rows):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = sorted(rows)
    want = brute.leaks([rows[i] for i in ids], items)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in answers(spark, "op1_decontamination")}
    assert got == {i: (n, hit, len(found), brute.items_digest(found), hit > 0) for i, (n, hit, found) in zip(ids, want, strict=True)}


def test_packing_query(spark, rows):
    tokenizer = Tokenizer.from_file(packing.public_vocabulary())
    own = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows.items()}
    got = answers(spark, "op2_best_fit_packing")
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        ids = own[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(array("I", ids).tobytes())
    assert set(pieces) == set(rows)
    for i, mine in pieces.items():
        mine.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert [r["start"] for r in mine] == [sum(r["length"] for r in mine[:k]) for k in range(len(mine))]
        assert sum(r["length"] for r in mine) == len(own[i])
        assert len(mine) == 1 or len(own[i]) > 1024 and all(r["length"] == 1024 for r in mine[1:])
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024


def test_secret_query_finds_every_assigned_token(spark):
    larger = SF.replace("0.001", "0.01")
    found = {(r["doc_id"], r["value_sha256"]) for r in queries.QUERIES["op3_secret_scan"](spark, larger).collect() if r["secret"]}
    texts = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()
    planted = {(i, hashlib.sha256(v.encode()).hexdigest()) for i, t in texts for v in re.findall(r'token = "([0-9a-f]{40})"', t or "")}
    assert planted and planted <= found


def test_sharding_query(spark, rows):
    got = answers(spark, "op4_rendezvous")
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    slots = {}
    for r in got:
        text = (rows[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 8, zlib.crc32(text), "key")
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize(("name", "folds", "held", "cut"), [("op6_toxicity", 3, 1, 0.7), ("op8_quality", 5, 0, 0.3)])
def test_classifier_queries(spark, rows, name, folds, held, cut):
    got = answers(spark, name)
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    for r in got:
        assert r["held_out"] == (crc(r["doc_id"]) % folds == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)


def test_jaccard_query(spark, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in answers(spark, "op9_ngram_jaccard")}
    assert got == brute.link_classes(rows.items())


def test_nearest_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], np.float64)
    got, right, all_ = {}, 0, 0
    for r in answers(spark, "op10_nearest"):
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert sorted(got) == sorted(ids[ids % 100 == 0].tolist())
    for q, mine in got.items():
        far = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        mine.sort()
        assert [m[0] for m in mine] == list(range(1, min(10, len(ids) - 1) + 1))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        np.testing.assert_allclose([m[1] for m in mine], [far[ids == m[2]][0] for m in mine], rtol=1e-12)
        best = sorted((f, i) for f, i in zip(far.tolist(), ids.tolist(), strict=True) if i != q)[:10]
        right += len({i for _, i in best} & {m[2] for m in mine})
        all_ += len(best)
    assert right >= 0.9 * all_
