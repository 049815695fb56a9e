"""The registered queries that SQL cannot state, over the driver tables, against brute force or held-out labels."""

import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from geoloom.llm.queries import ORACLES, QUERIES
from tests.llm.test_llm_edges import _contaminated_by_brute_force, _distance
from tests.llm.test_shingle_dedup import _expected as _near_duplicates_by_brute_force

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def texts(spark, small):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def _ids(text, name, end):
    return [*Tokenizer.from_file(public_tokenizers.path(name)).encode(text, add_special_tokens=False).ids, end]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op3_shards(spark, small, texts):
    found = QUERIES["op3_sharding"](spark, small).toPandas()
    assert sorted(found.doc_id) == sorted(texts) and set(found.law) == {"bytes"} and found.grown_shard.isna().all()
    for r in found.itertuples():
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    for _, own in found.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    sizes = found.groupby("shard")["size"].sum()
    assert list(sizes.index) == list(range(8)) and sizes.max() - sizes.min() <= 2 * found["size"].max()


def _checked_pieces(found, want):
    """``found``: pieces with their ids' sums; ``want``: the ids of each document."""
    for doc_id, own in found.groupby("doc_id"):
        ids, own = want[doc_id], own.sort_values("start")
        assert own.start.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() == len(ids) and set(own.doc_tokens) == {len(ids)}
        assert own.ids_crc32.tolist() == [_crc(ids[a : a + n]) for a, n in zip(own.start, own.length, strict=True)]
    padding = 0
    for _, own in found.groupby("sequence_id"):
        own = own.sort_values("offset")
        size = int(own.length.sum())
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]] and size <= 1024
        padding += (1024 - size) if size & (size - 1) else 0
    assert padding <= 0.02 * found.length.sum()


def test_op5_packs_every_id_once(spark, small, texts):
    found = QUERIES["op5_packing"](spark, small).toPandas()
    assert set(found.doc_id) == set(texts)
    _checked_pieces(found, {i: _ids(t, "byte_bpe_50k.json", 0) for i, t in texts.items()})


def test_op8_prints_and_groups(spark, small, texts):
    def fingerprint(text):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: fingerprint(t) for i, t in texts.items()}
    group = {i: i for i in prints}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in sorted(prints):
        for j in sorted(prints):
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash_near_dedup"](spark, small).collect()}
    assert found == {i: (f"{prints[i]:016x}", root(i)) for i in prints}


def test_op10_reads_back_what_was_written(spark, small, texts):
    found = sorted(QUERIES["op10_token_files"](spark, small).collect(), key=lambda r: r.doc_id)
    start = 0
    for r in found:
        ids = _ids(texts[r.doc_id], "word_bpe_49k.json", 1)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), _crc(ids))
        start += len(ids)
    assert len(found) == len(texts)


def _held_out(spark, name, label, folds, fold, sf):
    """(score, predicted, label) of the labelled documents that were not learnt from."""
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, sf).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) and 0 <= r.score <= 1 for r in rows)
    return [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]


def test_op1_finds_toxic_documents_it_has_not_seen(spark):
    """With some 300 toxic texts to learn from; a toxic word that none of them has cannot be known (see the README)."""
    held = _held_out(spark, "op1_toxicity", "toxic", 3, 1, "/root/testdata/sf0.1")
    found, named, true = (sum(p * y for _, p, y in held), sum(p for _, p, _ in held), sum(y for _, _, y in held))
    assert true >= 100 and found >= 0.65 * true and found >= 0.8 * named
    toxic, other = (np.sort([s for s, _, y in held if y == k]) for k in (1, 0))
    below = np.searchsorted(other, toxic) + np.searchsorted(other, toxic, side="right")
    assert below.mean() / (2 * len(other)) > 0.9


def test_op9_ranks_documents_it_has_not_seen(spark):
    held = _held_out(spark, "op9_quality_neighbours", "quality", 5, 0, "/root/testdata/sf0.01")
    good, bad = [s for s, _, y in held if y == 1], [s for s, _, y in held if y == 0]
    auc = np.mean([[(a > b) + 0.5 * (a == b) for b in bad] for a in good])
    assert len(bad) >= 5 and auc > 0.8
    assert sum(p == y for _, p, y in held) >= 0.85 * len(held)


# --- the pipeline, a stage at a time, in plain Python


def _lines_left(documents):
    """Texts without the lines that an earlier one equals, or, from 24 characters on, is within two edits of."""
    places = {}
    for i in sorted(documents):
        for k, line in enumerate(documents[i].split("\n")):
            places.setdefault(line, (i, k))
    long = sorted((x for x in places if len(x) >= 24), key=len)
    limit = dict(places)
    bags = {x: np.bincount([ord(c) % 64 for c in x], minlength=64) for x in long}
    for a, x in enumerate(long):
        for y in long[a + 1 :]:
            if len(y) > len(x) + 2:
                break
            if np.abs(bags[x] - bags[y]).sum() <= 4 and _distance(x, y) <= 2:
                limit[x], limit[y] = min(limit[x], places[y]), min(limit[y], places[x])
    kept = {}
    for i, text in documents.items():
        own = [x for k, x in enumerate(text.split("\n")) if (i, k) <= limit[x] or not (len(x) >= 24 or WORD.search(x))]
        kept[i] = "\n".join(own)
    return kept


def test_pipeline(spark, small, texts):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from read_parquet('{small}/{name}.parquet')")
    verdicts = con.execute(ORACLES["op6_quality_rules"])
    names = [d[0] for d in verdicts.description]
    kept = {r[names.index("doc_id")] for r in verdicts.fetchall() if r[names.index("kept")]}
    left = _lines_left({i: t for i, t in texts.items() if i in kept})
    rows = sorted(left.items())
    stay = {i for _, i in _near_duplicates_by_brute_force(rows)}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = {r[0] for r in _contaminated_by_brute_force([x for x in rows if x[0] in stay], items, 10) if not r[2]}
    assert 0 < len(clean) < len(stay) < len(kept) < len(texts)
    found = corpus_pipeline.run(spark, small).toPandas()
    assert set(found.doc_id) == clean
    _checked_pieces(found, {i: _ids(left[i], "byte_bpe_50k.json", 0) for i in clean})
