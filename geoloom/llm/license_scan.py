"""License scan: ordered signature rules over the words of a text.

The rules of ``license_rules`` are gated by their keywords: a text that has none is never searched, one that has some
is searched for their rules only. Rules overlap ("apache license" lies in "apache license version 2 0"), so a detection
is suppressed if it lies inside one of a better priority, or inside a longer or an earlier listed one of the same.
A suppressed detection need not be kept to suppress others: what it contains lies inside its own container too. So one
sweep over the detections by place settles all, with the farthest end seen so far for each priority.

Everything is a column expression over the row at hand: no exchange, no key, and no size of a text at which the work
is more than proportional to its words and detections.

Words are maximal runs of digits, letters a-z and characters beyond ASCII after A-Z are lower-cased; places count from 0.
The labels of the base rules stay although their detections are suppressed.

Defined results: a null text is empty; a text without words has no detections, null places, empty labels and score 0;
rows are judged each for themselves; empty tables give empty results. Columns of the result that a document column is
called alike replace that column.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import set_aside
from geoloom.llm.license_rules import BASE, CONFIDENCE, KEYWORDS, RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN_WORDS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_MARK = "\x01"
#: Detections that one inner step of the sweep collects; the outer one appends whole steps.
_STEP = 256

_RULE = "number int, priority int, label string, keyword string, expression string, base boolean"
#: Start, end and so on in the order of the sweep: what contains another comes before it.
_SWEPT = "struct<start:int,negative_end:int,priority:int,number:int,label:string,base:boolean>"
_FOUND = "struct<label:string,start:int,end:int,priority:int,rule:int>"
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")


def _rules() -> Column:
    return F.from_json(F.lit(json.dumps([r._asdict() for r in RULES])), f"array<struct<{', '.join(f'{n}:{t}' for n, t in (x.split() for x in _RULE.split(', ')))}>>")


def _words_in(piece: Column) -> Column:
    """Words of a piece in which each has a space of its own on either side."""
    return ((F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))) / 2).cast("int")


def _places(text: Column, rule: Column) -> Column:
    """Every place at which the rule matches, in the form of the sweep."""
    matched = F.regexp_extract_all(text, rule["expression"], F.lit(0))
    marked = F.split(F.regexp_replace(text, F.concat(F.lit("("), rule["expression"], F.lit(")")), F.lit(f"{_MARK}$1")), " ")
    starts = F.filter(F.transform(marked, lambda piece, k: F.when(piece == _MARK, (k / 2).cast("int"))), lambda k: k.isNotNull())

    def place(start: Column, match: Column) -> Column:
        end = start + _words_in(match)
        return F.struct(
            start.alias("start"), (-end).alias("negative_end"), rule["priority"].alias("priority"), rule["number"].alias("number"), rule["label"].alias("label"), rule["base"].alias("base")
        ).cast(_SWEPT)

    return F.when(F.regexp_like(text, rule["expression"]), F.zip_with(starts, matched, place)).otherwise(F.array().cast(f"array<{_SWEPT}>"))


def _swept(found: Column) -> Column:
    """The detections that nothing ranked above them contains; ``found`` in order."""
    levels = sorted(CONFIDENCE)
    farthest = f"array<{'int'}>"
    none = F.array(*(F.lit(0) for _ in levels)).cast(farthest)

    def one(state: Column, x: Column) -> Column:
        ends = F.transform(state["ends"], lambda e, k: F.when(k + 1 >= x["priority"], F.greatest(e, -x["negative_end"])).otherwise(e))
        inside = F.get(state["ends"], x["priority"] - 1) >= -x["negative_end"]
        found_ = F.struct(x["label"].alias("label"), x["start"].alias("start"), (-x["negative_end"]).alias("end"), x["priority"].alias("priority"), x["number"].alias("rule"))
        kept = F.when(inside, state["kept"]).otherwise(F.array_append(state["kept"], found_.cast(_FOUND)))
        return F.struct(ends.alias("ends"), kept.alias("kept")).cast(f"struct<ends:{farthest},kept:array<{_FOUND}>>")

    def step(state: Column, first: Column) -> Column:
        start = F.struct(state["ends"].alias("ends"), F.array().cast(f"array<{_FOUND}>").alias("kept")).cast(f"struct<ends:{farthest},kept:array<{_FOUND}>>")
        done = F.aggregate(F.slice(found, first, _STEP), start, one)
        return F.struct(done["ends"].alias("ends"), F.array_append(state["steps"], done["kept"]).alias("steps")).cast(f"struct<ends:{farthest},steps:array<array<{_FOUND}>>>")

    begin = F.struct(none.alias("ends"), F.array().cast(f"array<array<{_FOUND}>>").alias("steps")).cast(f"struct<ends:{farthest},steps:array<array<{_FOUND}>>>")
    firsts = F.sequence(F.lit(1), F.size(found), F.lit(_STEP))
    return F.when(F.size(found) == 0, F.array().cast(f"array<{_FOUND}>")).otherwise(F.aggregate(firsts, begin, step, lambda s: F.flatten(s["steps"])))


def scan(documents: DataFrame, text: str = "text") -> DataFrame:
    """Documents with their words, base places, labels, score and detections (label, words from start to before end)."""
    taken = {c.lower() for c in ADDED}
    documents, names_back = set_aside(documents, ["_spaced", "_apart", "_rules", "_keys", "_places", "_base"])
    own = [c for c in documents.columns if c.lower() not in taken]
    spaced = F.btrim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _BETWEEN_WORDS, " "), F.lit(" "))
    # Lower-casing all letters opens the gate for no fewer texts than lower-casing A-Z does.
    df = documents.select(*own, spaced.alias("_spaced"))
    low = F.concat(F.lit(" "), F.lower("_spaced"))
    gate = F.lit(False)
    for k in KEYWORDS:
        gate = gate | F.contains(low, F.lit(f" {k}"))
    n_words = F.when(F.col("_spaced") == "", 0).otherwise(F.length("_spaced") - F.length(F.replace(F.col("_spaced"), F.lit(" "), F.lit(""))) + 1)
    apart = F.concat(F.lit(" "), F.replace(F.translate("_spaced", _UPPER, _LOWER), F.lit(" "), F.lit("  ")), F.lit(" "))
    df = df.select(*own, n_words.cast("long").alias("n_words"), F.when(gate, apart).alias("_apart")).withColumn("_rules", _rules())
    present = F.filter(F.array(*(F.lit(k) for k in KEYWORDS)), lambda k: F.contains(F.col("_apart"), F.concat(F.lit(" "), k)))
    df = df.withColumn("_keys", F.when(F.col("_apart").isNotNull(), present))
    asked = F.filter("_rules", lambda r: F.array_contains(F.col("_keys"), r["keyword"]))
    places = F.array_sort(F.flatten(F.transform(asked, lambda r: _places(F.col("_apart"), r))))
    df = df.withColumn("_places", F.when(F.size("_keys") > 0, places).otherwise(F.array().cast(f"array<{_SWEPT}>")))
    df = df.withColumns({"detections": _swept(F.col("_places")), "_base": F.filter("_places", lambda p: p["base"])})
    base = F.array_distinct(F.transform("_base", lambda p: p["label"]))
    labels = F.array_union(base, F.transform("detections", lambda d: d["label"]))
    confidence = F.element_at(F.create_map(*(F.lit(x) for pair in CONFIDENCE.items() for x in pair)), F.array_min(F.transform("detections", lambda d: d["priority"])))
    found = df.select(
        *own,
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(F.transform("_base", lambda p: p["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_base", lambda p: p["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.coalesce(confidence, F.lit(0.0)).alias("score"),
        "detections",
    )
    return names_back(found)


assert {r.label for r in RULES if r.base} == set(BASE)
