"""Ranked search against a score of every document for every query."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from geoloom.llm import lexical_search as S


def _terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _expected(documents, queries, top):
    counts = [Counter(_terms(t)) for _, t in documents]
    n_docs, n_terms = sum(bool(c) for c in counts), sum(sum(c.values()) for c in counts)
    df = Counter(x for c in counts for x in c)
    out = []
    for item, text in queries:
        scored = []
        for (i, _), c in zip(documents, counts, strict=True):
            score = 0
            for x in set(_terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                score += w * (1000000000 * c[x] // (1000 * c[x] + 20 * (50 + 50 * sum(c.values()) * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return out


def _documents(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{k}" for k in range(60) for a in "aÉß" for b in ("x", "Y", "zzzzzzzzzz")]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    text = lambda m: " ".join(rng.choices(vocabulary, weights, k=m))
    rows = [(k, text(rng.choice([1, 3, 20, 80, 400]))) for k in range(n)]
    rows += [(1000 + k, rows[7][1]) for k in range(150)]  # a large group of copies
    rows += [(2000, None), (2001, ""), (2002, "... --"), (2003, text(9000)), (2004, "ax0 " * 5000), (3, rows[3][1]), (3, rows[3][1]), (4, "another text aY1")]
    rows += [(None, rows[8][1]), (None, rows[9][1]), (None, None)]
    rng.shuffle(rows)
    queries = [(k, text(rng.choice([1, 2, 12, 40]))) for k in range(25)] + [(100, None), (101, ""), (102, "unheard of"), (103, rows[5][1]), (1, "ax0 aY0"), (None, "ax0 AX0 Ay1")]
    return rows, queries


_ORDER = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0, r[3])


@pytest.mark.parametrize(("seed", "packet", "top"), [(1, 2048, 50), (2, 7, 5)])
def test_same_as_scoring_everything(spark, monkeypatch, seed, packet, top):
    monkeypatch.setattr(S, "PACKET_QUERIES", packet)
    rows, queries = _documents(seed)
    documents = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, query int, value string").repartition(5)
    found = S.search(documents, spark.createDataFrame(queries, "item_id long, text string"), top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=_ORDER) == sorted(_expected(rows, queries, top), key=_ORDER)


def test_bounds_hold_and_exclude():
    """No score is above its bound, and most documents are proven out."""
    rows, queries = _documents(3)
    packet = S.Packet([(i, sorted(set(_terms(t)))) for i, t in queries])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array([t for _, t in rows])], names=["_key", "_text"])
    blocks = [r for b in S._indexed(iter([batch]), packet.vocabulary, True) for r in b.to_pylist()]
    counts = blocks.pop()
    packet.weigh(counts["n_docs"], counts["n_terms"], counts["df"])
    bound = np.full((len(queries), len(rows)), -1)
    for row in blocks:
        keys, bounds = S._bounds(row, packet)
        bound[:, keys] = bounds
    exact = np.zeros_like(bound)
    for k, (_, text) in enumerate(queries):
        for _, _, i, score in _expected([(n, t) for n, (_, t) in enumerate(rows)], [(0, text)], len(rows)):
            exact[k, i] = score
    assert (bound[:, [bool(_terms(t)) for _, t in rows]] >= 0).all()
    assert (bound >= exact).all() or (exact[bound < exact] == 0).all()
    reached = np.sort(exact, axis=1)[:, -10]
    asked = reached > 0
    assert ((bound >= reached[:, None]) & asked[:, None]).sum() < 0.2 * asked.sum() * len(rows)


def test_empty_tables(spark):
    documents, queries = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id string, text string")
    assert S.search(documents, queries).collect() == []
    assert S.search(documents, spark.createDataFrame([("a", "b c")], "item_id string, text string")).collect() == []
    assert S.search(spark.createDataFrame([(1, "b c")], "doc_id long, text string"), queries).collect() == []
    one = S.search(spark.createDataFrame([(7, "b c"), (8, "d")], "doc_id long, text string"), spark.createDataFrame([("a", "B")], "item_id string, text string")).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in one] == [("a", 1, 7)]
