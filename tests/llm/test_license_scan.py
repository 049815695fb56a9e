"""The license scan against a plain reading of its rules."""

import random
import re

import pytest

from geoloom.llm import license_rules, license_scan

SCHEMA = "doc_id long, text string, labels string, _apart int"


def _plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    apart = "".join(f" {w} " for w in words)
    found = []
    for r in license_rules.RULES:
        for m in re.finditer(r.expression, apart):
            start, n = apart[: m.start()].count(" ") // 2, m[0].count(" ") // 2
            found.append((start, start + n, r))
    kept = [
        (a, b, r)
        for a, b, r in found
        if not any(
            c <= a and b <= d and s is not r and (s.priority < r.priority or s.priority == r.priority and (d - c > b - a or s.number < r.number))
            or (s is r and (c, d) != (a, b) and c <= a and b <= d)
            for c, d, s in found
        )
    ]
    base = [(a, r.label) for a, _, r in found if r.base]
    own = {label for _, label in base}
    best = min((r.priority for _, _, r in kept), default=None)
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min((a for a, _ in base), default=None),
        "last_word": max((a for a, _ in base), default=None),
        "base_labels": ",".join(sorted(own)),
        "labels": ",".join(sorted(own | {r.label for _, _, r in kept})),
        "score": license_rules.CONFIDENCE.get(best, 0.0),
        "detections": sorted((r.label, a, b, r.priority, r.number) for a, b, r in kept),
    }


PARTS = [
    "Licensed under the Apache License, Version 2.0.", "Apache License", "MIT License", "mit\nlicense", "Released under the MIT License.", "MIT LICENSEE",
    "GNU General Public License, version 3 or any later version", "general public license", "Lesser General Public License v2.1", "GPL-2.0+", "GPLv3",
    "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: WeirdOne", "CC BY-NC-SA 4.0", "CC0 1.0 Universal", "Creative Commons Attribution-ShareAlike 3.0 Unported",
    "creative commons attribution noncommercial", "All rights reserved.", "Alle Rechte vorbehalten", "Tous droits réservés", "Copyright (c) 2019 2020", "Unlicense",
    "Redistribution and use in source and binary forms, with or without modification, are permitted", "neither the name of", "ÉMIT license", "mit é license",
    "provided as is, without warranty of any kind", "public domain", "is in the public domain", "open font license 1.1", "3-Clause BSD License", "Kıt lİcense",
]


def _texts(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n ", "...", "nothing here at all", "Mit freundlichem Gruß, licence plate", "MIT License " * 2000, "accept the domain \x00 permission-granted x" * 50]
    texts += [" ".join(rng.choice([*PARTS, "word", "der", "42", "—"]) for _ in range(rng.randrange(1, 25))) for _ in range(120)]
    return texts + texts[10:14] + PARTS


@pytest.mark.parametrize("seed", [1])
def test_against_plain_reading(spark, seed):
    texts = _texts(seed)
    df = spark.createDataFrame([(k % 100 if k % 9 else None, t, "x", k) for k, t in enumerate(texts)], SCHEMA).repartition(4)
    got = {r.text: r for r in license_scan.scan(df).collect()}
    assert license_scan.scan(df).count() == len(texts)
    for t in texts:
        want, row = _plain(t), got[t].asDict()
        row["detections"] = sorted((d.label, d.start, d.end, d.priority, d.rule) for d in row["detections"])
        assert {k: row[k] for k in want} == want, t


def test_rules():
    assert len(license_rules.RULES) > 300 and len({r.number for r in license_rules.RULES}) == len(license_rules.RULES)
    assert all("," not in r.label and r.priority in license_rules.CONFIDENCE for r in license_rules.RULES)
    for r in license_rules.RULES:  # the keyword begins a word of whatever the expression matches: it is outside every optional part
        firm = re.sub(r"\(\?:[^()]*(?:\([^()]*\)[^()]*)*\)\?", "", r.expression)
        assert re.search(rf"(?:^|[ (|:]){r.keyword}", firm), r


def test_no_exchange_and_no_python(spark):
    df = license_scan.scan(spark.createDataFrame([(1, "MIT license", "", 1)], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert license_scan.scan(spark.createDataFrame([], SCHEMA)).collect() == []
