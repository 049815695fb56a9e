"""The filter audit against every order applied in plain Python."""

import random
import re
from itertools import permutations

import pytest

from geoloom.llm import filter_audit

SCHEMA = "doc_id long, text string, source string, _text string, part int, _n long"


def _fails(rows):
    out = []
    for i, text, _ in rows:
        t = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        first = min((j for j, u, _ in rows if j is not None and (u or "") == t), default=None)
        out.append(
            {
                "A": len(w) < 50,
                "B": 100 * len(set(w)) < 65 * len(w),
                "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                "D": bool(re.search("[#$%&*|]", t)),
                "E": i is not None and i > first,
            }
        )
    return out


def _expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails, out = _fails(rows), {}
    for part in {r[2] or "" for r in rows}:
        own = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        by_filter = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [k for k in left if fails[k][x]]
                removed_before = [k for k in own if k not in left and fails[k][x]]
                left = [k for k in left if not fails[k][x]]
                by_filter[x] += len(gone)
                only = sum(fails[k][x] and sum(fails[k].values()) == 1 for k in own)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(removed_before), only, sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)
                ]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(by_filter[order[step - 1]])
    return out


def _rows(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdEF") + rng.choice("xyzé") + str(rng.randrange(60))
    rows = [(k, " ".join(word() for _ in range(rng.randrange(1, 120))) + rng.choice(["", "", " #", " |"]), rng.choice(["a", "b", "", None])) for k in range(60)]
    rows += [(200 + k, rows[k % 7][1], "a") for k in range(40)]  # copies, one source
    rows += [(300 + k, rows[9][1], rng.choice("ab")) for k in range(30)]  # a large group
    rows += [(400, None, "a"), (401, "", "b"), (402, " \t\n ", "b"), (403, None, None), (404, "x " * 9000, "a"), (405, "ÄÖÜ ABC 𝒳", "c")]
    rows += [(5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]), (6, rows[8][1], "b"), (2, rows[8][1], "b")]
    rows += [(None, rows[3][1], "a"), (None, "no id", "a"), (None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_every_order(spark, seed):
    rows = _rows(seed)
    rng = random.Random(seed + 50)
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 420, 2)] + [(5, 0, 1), (5, 1, 0), (None, 1, 1)]
    documents = spark.createDataFrame([(*r, "#", 7, 9) for r in rows], SCHEMA).repartition(5)
    got = filter_audit.audit(documents, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in got} == _expected(rows, labels)


def test_empty_tables(spark):
    documents, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents, labels).collect() == []
    one = filter_audit.audit(spark.createDataFrame([(1, "a", None, "", 1, 1)], SCHEMA), labels)
    assert one.count() == 600 and one.filter("filter_order = 'ABCDE' and step = 1").first().removed == 1


def test_kept_of_all_orders_is_the_same(spark, small):
    df = filter_audit.audit(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet"))
    last = df.filter("step = 5").groupBy("part").agg({"kept": "min", "*": "count"}).collect()
    assert last and all(r["count(1)"] == 120 for r in last)
    assert not df.filter("kept < 0 or removed < 0 or redundant < 0").count()
