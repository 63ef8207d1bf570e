"""All ten registered queries on the smallest tables: against their SQL, or else brute force."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from docframe.llm import packing
from docframe.llm.queries import ORACLE_SQL, QUERIES

from tests.llm.test_operators import brute_fingerprint, brute_likeness, brute_lm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def held(i, fold):
    return zlib.crc32(str(i).encode()) % 5 == fold


def test_ten_queries():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 11)) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == sorted(found.fetchall(), key=repr)


@pytest.mark.parametrize(("name", "cut"), [("op2_toxicity", 0.5), ("op10_quality", 0.3)])
def test_classifiers(spark, documents, name, cut):
    rows = QUERIES[name](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(r.held_out == held(r.doc_id, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in rows)
    assert {r.doc_id: r.score for r in QUERIES[name](spark, SF).collect()} == {r.doc_id: r.score for r in rows}


def test_fingerprints(spark, documents):
    order, rows = sorted(documents), {r.doc_id: r for r in QUERIES["op3_fingerprints"](spark, SF).collect()}
    assert sorted(rows) == order
    own = {i: brute_fingerprint(documents[i]) for i in order[:40] + order[-1:]}
    for a, b in [*zip(order[:39], order[1:40], strict=True), (order[-1], order[0])]:
        t, following, r = documents[a] or "", documents[b] or "", rows[a]
        edited = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(brute_likeness(own[a], brute_fingerprint(edited))) and r.near_next == pytest.approx(brute_likeness(own[a], own[b]))


def test_language_model(spark, documents):
    want = brute_lm(list(documents.items()))
    rows = QUERIES["op5_lm_score"](spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id, 1), n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_packing(spark, documents):
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in QUERIES["op7_packing"](spark, SF).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in documents.items():
        ids, at = np.array([*packing.encode(t or ""), 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        places = sorted((r.offset, r.length) for r in parts)
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and places[0][0] == 0
        sizes.append(sum(n for _, n in places))
    assert max(sizes) <= 2048 and sum(s < 2048 for s in sizes) <= 1
