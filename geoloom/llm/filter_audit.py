"""Audit of how document filters act on each other: what each removes in every order of application.

Each document gets one bit a filter it fails. The copy filter is an existential self-join: a document is marked if a
left-semi join on hash and exact text finds a smaller document id. Its marks are united with the other failures, the
bits of a row are merged, and the bit combinations are counted by part. All orders follow from those few counts: what
is left after a set of filters is the number of documents that fail none of them, whatever the order within the set.

Only texts whose hash occurs under two ids, told by a bitmap of bounded size that stops no such hash, take part in the
self-join; the other side holds each text once, with its smallest id, so that a group of copies of any size costs one
comparison a copy, and a large one can be split by the planner. Everything else travels as one narrow row a document.

Defined results: a null text is empty, a null part is the empty string; a document without an id is no copy and makes
none, and has no labels; rows of one id do not make each other copies; repeated rows count each; a label counts if any
row of the id has it; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.bitmaps import Bitmap
from geoloom.llm.common import written

_WHITE = " \t\n\x0b\f\r"

# The limits of the four filters that look at one document.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT, SYMBOLS = 50, 65, 5, "[#$%&*|]"


def single_document_filters(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails: few words, few distinct ones, many capitals, symbols."""
    bare = F.btrim(text, F.lit(_WHITE))
    words = F.split(bare, "[ \\t-\\r]+")
    n = F.when(bare == "", 0).otherwise(F.size(words))
    distinct = F.when(bare == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < MIN_WORDS,
        "B": distinct * 100 < n * MIN_DISTINCT_PERCENT,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * MAX_CAPITAL_PERCENT,
        "D": text.rlike(SYMBOLS),
    }


def _copies(texts: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows of ``texts`` (_id, _part, _hash, _text) of which a smaller id has the same text."""
    ids = facts.groupBy("_hash").agg(F.min("_id").alias("_least"), F.max("_id").alias("_most"))
    repeated = written(ids.filter("_least < _most").select("_hash"), "repeated-hashes")
    # Written, or else the planner would put the semi-join, with all texts, before the bitmap.
    maybe = written(Bitmap(repeated, "_hash", repeated.count()).maybe(texts, "_hash"), "maybe-copies")
    firsts = written(maybe.groupBy("_hash", "_text").agg(F.min("_id").alias("_first")), "first-copies").alias("b")
    same = (F.col("a._hash") == F.col("b._hash")) & (F.col("a._text") == F.col("b._text"))
    return maybe.alias("a").join(firsts, same & (F.col("b._first") < F.col("a._id")), "left_semi")


def failures(documents: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text", copy_filter: str = "E") -> tuple[DataFrame, str]:
    """(_id, _part, _mask, _n): documents by what they fail, bit k for the k-th of the returned letters."""
    texts = documents.select(
        F.col(doc_id).cast("long").alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"), F.coalesce(text, F.lit("")).alias("_text")
    ).withColumn("_hash", F.xxhash64("_text"))
    tests = single_document_filters(F.col("_text"))
    letters = "".join(sorted([*tests, copy_filter]))
    bit = {x: 1 << k for k, x in enumerate(letters)}
    bits = reduce(Column.__add__, [F.when(fails, bit[x]).otherwise(0) for x, fails in tests.items()])
    facts = written(texts.select("_id", "_part", "_hash", bits.alias("_bits")), "filter-facts")
    marks = _copies(texts, facts).select("_id", "_part", "_hash", F.lit(bit[copy_filter]).alias("_bits"), F.lit(0).alias("_one"))
    # One row a document or group of equal rows: its own failures, then the mark of the copy filter.
    rows = facts.withColumn("_one", F.lit(1)).unionByName(marks)
    merged = rows.groupBy("_id", "_part", "_hash").agg(F.bit_or("_bits").alias("_mask"), F.sum("_one").alias("_n"))
    return merged.select("_id", "_part", "_mask", "_n"), letters


def combinations(failing: DataFrame, labels: DataFrame) -> DataFrame:
    """(_part, _mask, _n, _good, _toxic): documents by part and combination of failures."""
    own = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id"))
    own = own.agg(*(F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0)).alias(f"_{c}") for c in ("quality", "toxic")))
    both = failing.join(own, "_id", "left")
    counted = lambda c: F.sum(F.when(F.col(c) == 1, F.col("_n")).otherwise(0))
    return both.groupBy("_part", "_mask").agg(F.sum("_n").alias("_n"), counted("_quality").alias("_good"), counted("_toxic").alias("_toxic"))


def _orders(letters: str) -> Column:
    return F.split(F.lit(",".join(map("".join, permutations(letters)))), ",")


def audit(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row a part, order of the filters and step: what the step's filter removes there and what that costs."""
    failing, letters = failures(documents, part)
    counts = combinations(failing, labels)
    sets = range(1 << len(letters))

    def left_after(c: str) -> Column:
        """For each set of filters, the documents that fail none of it."""
        return F.array(*(F.sum(F.when(F.col("_mask").bitwiseAND(s) == 0, F.col(c)).otherwise(0)) for s in sets))

    parts = counts.groupBy(F.col("_part").alias("part")).agg(*(left_after(c).alias(c) for c in ("_n", "_good", "_toxic")))
    left = lambda c, s: F.get(c, s)
    steps = parts.withColumn("filter_order", F.explode(_orders(letters))).withColumn("step", F.explode(F.array(*map(F.lit, range(1, len(letters) + 1)))))
    name, earlier = F.substring("filter_order", F.col("step"), F.lit(1)), F.substring("filter_order", F.lit(1), F.col("step") - 1)
    before = reduce(Column.__add__, [F.when(F.contains(earlier, F.lit(x)), 1 << k).otherwise(0) for k, x in enumerate(letters)])
    own = reduce(Column.__add__, [F.when(name == x, 1 << k).otherwise(0) for k, x in enumerate(letters)])
    steps = steps.withColumns({"_before": before, "_own": own})
    after, others = F.col("_before") + F.col("_own"), F.lit(len(sets) - 1) - F.col("_own")

    def lost(c: str) -> Column:
        return left(c, F.col("_before")) - left(c, after)

    def orders_with(s: int) -> int:
        """Orders in which exactly the set ``s`` comes before a given other filter."""
        k = s.bit_count()
        return factorial(k) * factorial(len(letters) - 1 - k)

    in_all_orders = reduce(
        Column.__add__,
        [F.when(F.col("_own").bitwiseAND(s) == 0, (left("_n", F.lit(s)) - left("_n", F.col("_own") + s)) * orders_with(s)).otherwise(0) for s in sets[:-1]],
    )
    failing_it = left("_n", F.lit(0)) - left("_n", F.col("_own"))
    return steps.select(
        "part",
        "filter_order",
        "step",
        left("_n", after).alias("kept"),
        lost("_n").alias("removed"),
        (failing_it - lost("_n")).alias("redundant"),
        (left("_n", others) - left("_n", F.lit(len(sets) - 1))).alias("unique_fails"),
        lost("_good").alias("good_lost"),
        lost("_toxic").alias("toxic_lost"),
        in_all_orders.alias("shapley"),
    )
