"""Exact copies of short lines in the pipeline's line stage, against brute force."""

import random

import corpus_pipeline

from geoloom.llm import line_dedup


def test_copies_of_short_lines_go(spark):
    rng = random.Random(4)
    short = ["All rights reserved.", "Les.", "x", "a b", "é", "-", "12345678901234567890123"]
    long = [f"{k:03d} " * 3 + "".join(rng.choice("abcdefghijklmnop") for _ in range(30)) for k in range(30)]
    rows = [(d, "\n".join(rng.choice(short + long + ["", " ", "\t"]) for _ in range(rng.randrange(0, 9)))) for d in range(50)]
    rows += [(None, "Les."), (60, None), (61, "All rights reserved"), (62, "Les. "), (63, "Les.\nLes.")]
    seen, want = set(), []
    for i, t in rows:
        kept = []
        for x in (t or "").split("\n"):
            if i is None or not x.strip() or x not in seen:
                kept.append(x)
            if i is not None:
                seen.add(x)
        want.append((i, "\n".join(kept) if t is not None else None))
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, n_chars long").repartition(3)
    got = corpus_pipeline.lines(spark, df, "").collect()
    order = lambda r: (r[0] is None, r[0], r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got), key=order) == sorted(want, key=order)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got)
    by_default = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(df).collect()}
    assert by_default[63] == 0
