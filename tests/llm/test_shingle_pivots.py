"""The near-dedup stage of the pipeline finds candidates by pivot distances of SimHash fingerprints."""

import corpus_pipeline
import numpy as np

from geoloom.llm import shingle_dedup
from geoloom.llm.simhash import Pivots


def _pair(k):
    """Two texts of 81 shingles that have 72 of 90 in common."""
    own = [f"{k}w{i}" for i in range(85)]
    return " ".join(own), " ".join([*own[:36], f"{k}u", *own[37:81], *(f"{k}y{i}" for i in range(4))])


def test_pair_that_no_band_holds(spark):
    """These two share none of the 24 min-hash bands, but pivot distances."""
    a, b = _pair(66265)
    other, far = _pair(1)[0], _pair(2)[0]
    df = spark.createDataFrame([(1, a), (2, b), (3, other), (4, far)], "doc_id long, text string")
    left = dict(corpus_pipeline.STAGES)["shingle near-dedup"](spark, df, "")
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4]


def test_pairs_within_the_sure_radius_share_a_key():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 2**64, 500, dtype=np.uint64)
    others = prints.copy()
    for k in range(len(others)):
        for bit in rng.choice(64, 4, replace=False):
            others[k] ^= np.uint64(1) << np.uint64(bit)
    keys = zip(shingle_dedup.PIVOTS.keys(prints), shingle_dedup.PIVOTS.keys(others), strict=True)
    assert np.any([a == b for a, b in keys], axis=0).all()
    assert len(Pivots((32, 32), 1).choices) == 2


def test_each_pair_comes_once_whatever_it_shares():
    """Pairs near by their fingerprints come under their first pivot key, the others under their first band."""
    n, bands = 40, shingle_dedup.BANDS
    sketch, sizes, nodes = np.zeros((n, bands * shingle_dedup.ROWS), dtype=np.uint8), np.full(n, 100), np.arange(n)
    prints = np.random.default_rng(6).integers(0, 2**64, n, dtype=np.uint64)
    prints[20:] = prints[:20] ^ np.uint64(0b101)  # each of the second half is near one of the first
    found = []
    for number in range(bands + len(shingle_dedup.PIVOTS.choices)):
        pairs = shingle_dedup._candidates(number << 40, nodes, sizes, sketch, None, prints)
        found.append([(int(x), int(y)) for a, b in pairs for x, y in zip(a, b, strict=True)])
    assert set(map(tuple, ((k, k + 20) for k in range(20)))) <= {p for pairs in found[bands:] for p in pairs}
    assert sorted(p for pairs in found for p in pairs) == [(i, j) for i in range(n) for j in range(i + 1, n)]
