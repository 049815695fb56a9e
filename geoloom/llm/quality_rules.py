"""Quality rules with cutoffs of controlled risk, in built-in functions only.

Every document gets counts of its words, symbols, repeated lines and repeated windows. Two base rules are fixed. The
method's own rules are a ladder of levels, each with a cutoff a rule, from lenient to strict; the ladder is set
before any data are seen. For each stratum (a language by default) and level, the labelled good documents that pass
the base rules are a holdout: with n of them and k rejected, the level is certified if the exact binomial probability
of k or fewer among n, were the true rate of false rejection ``risk``, is at most ``error`` divided by the number of
levels times strata (Bonferroni). So with probability 1 - ``error`` no certified level of any stratum rejects more
than ``risk`` of good documents. Of the certified levels a stratum uses the one with the most bad documents rejected,
each good one that is rejected counted against ``PENALTY`` bad ones; of equals, the most lenient. A stratum
without a certified level rejects nothing beyond the base rules.

Defined results: null and empty texts have no words and fail; a null stratum is a stratum of its own; labels without
document or value are not used, of several labels of a document the worst counts; documents without an id and
repeated rows are judged each for themselves; without labels only the base rules apply; empty tables give empty
results; columns called like a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import written

# The base rules.
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_SPLIT = "[\\x20\\x09-\\x0D]+"

#: Share of good documents that a stratum may lose, probability that any stratum loses more, good per bad document.
RISK, ERROR, PENALTY = 0.05, 0.05, 10
#: Rule -> cutoffs of levels 1, 2, ...; a document above the cutoff is rejected.
LADDER: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02),
    "repeated_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeated_words": (0.28, 0.26, 0.24, 0.22, 0.20, 0.17, 0.14, 0.10),
    "chars_per_word": (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0),
}
LEVELS = len(LADDER["symbols_per_word"])
#: Strata with a cutoff are broadcast up to this number of rows, and joined by a shuffle beyond it.
BROADCAST_ROWS = 10_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, and only where the result is asked for."""
    return F.transform(F.array(value), use)[0]


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: each such window adds what the one before it has not covered."""

    def places(ordered: Column) -> Column:
        def twice(k: Column) -> Column:
            own = F.get(ordered, k)["h"]
            before, after = F.get(ordered, k - 1)["h"], F.get(ordered, k + 1)["h"]
            return own.eqNullSafe(before) | own.eqNullSafe(after)

        numbers = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), twice)
        return F.array_sort(F.transform(numbers, lambda k: F.get(ordered, k)["i"]))

    def add(state: Column, place: Column) -> Column:
        return F.struct((state["n"] + F.least(F.lit(WINDOW), place - state["last"])).alias("n"), place.alias("last"))

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(_let(ordered, places), start, add, lambda s: s["n"])


def with_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """Documents with the counts, all long."""
    kept = [c for c in documents.columns if c.lower() not in COUNTS]
    own = F.coalesce(F.col(text), F.lit(""))
    df = documents.select(*kept, own.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.withColumns(
        {
            "_hashes": F.transform(F.filter(F.split("_text", _SPLIT), lambda w: w != ""), lambda w: F.xxhash64(w)),
            "_lines": lines,
            "_chars": F.length(F.translate("_text", SPACES, "")),
            "_symbols": F.length("_text") - F.length(F.translate("_text", SYMBOLS, "")),
        }
    )
    n = F.size("_hashes")
    window = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)])
    )
    df = df.withColumn("_windows", F.when(n >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    distinct = F.size(F.array_distinct("_windows"))
    repeated = F.when(distinct == F.size("_windows"), F.lit(0)).otherwise(_covered(F.col("_windows")))
    counts = {
        "n_words": n,
        "word_chars": F.col("_chars"),
        "n_symbols": F.col("_symbols"),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated,
    }
    return df.select(*kept, *[c.cast("long").alias(k) for k, c in counts.items()])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def metrics() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / words,
        "chars_per_word": F.col("word_chars") / words,
    }


def first_level() -> Column:
    """The most lenient level that rejects the document; one more than there are, if none does."""
    level = F.lit(LEVELS + 1)
    for k in range(LEVELS, 0, -1):
        over = F.lit(False)
        for rule, value in metrics().items():
            over = over | (value > LADDER[rule][k - 1])
        level = F.when(over, k).otherwise(level)
    return level


def _log_factorial(n: Column) -> Column:
    """Stirling's series at n + 8, less the factors between."""
    x = (n + 8).cast("double")
    factors = (n + 1).cast("double")
    for k in range(2, 8):
        factors = factors * (n + k)
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5)) - 1 / (1680 * F.pow(x, 7))
    return (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series - F.log(factors)


def binomial_tail(n: Column, k: Column, p: float, most_terms: int = 100_000) -> Column:
    """P(X <= k) of X ~ Bin(n, p), exact for k < n p; 1 for larger k, where no test can succeed.

    Terms fall from k downwards. Beyond ``most_terms`` of them the last one is counted for each that is left, which
    can only raise the result.
    """
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    start = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] * (k - i + 1) * (1 - p) / ((n - k + i) * p)
        return F.struct((state["sum"] + term).alias("sum"), term.alias("term"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), F.least(k, F.lit(most_terms)))).otherwise(F.array().cast("array<bigint>"))
    rest = F.greatest(k - most_terms, F.lit(0))
    total = F.aggregate(steps, start, add, lambda s: s["sum"] + s["term"] * rest)
    return F.when(k < n * p, top * total).otherwise(F.lit(1.0))


def fit_levels(
    counted: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", label_id: str = "doc_id",
    label: str = "quality", risk: float = RISK, error: float = ERROR,
) -> DataFrame:
    """(_stratum, _level) of the strata with a certified level. ``counted``: documents with counts."""
    own = labels.select(F.col(label_id).alias("_id"), F.col(label).alias("_good")).dropna()
    own = own.groupBy("_id").agg(F.min("_good").alias("_good"))
    rated = counted.filter(~base_failed()).select(F.col(doc_id).alias("_doc"), F.col(stratum).alias("_stratum"), first_level().alias("_first"))
    held = rated.join(own, F.col("_doc") == F.col("_id")).groupBy("_stratum", "_first")
    held = held.agg(F.sum((F.col("_good") == 1).cast("long")).alias("good"), F.sum((F.col("_good") != 1).cast("long")).alias("bad"))
    # From here on there are at most LEVELS + 1 rows a stratum.
    levels = held.select("*", F.explode(F.sequence(F.lit(1), F.lit(LEVELS))).alias("_level"))
    hit = (F.col("_first") <= F.col("_level")).cast("long")
    tested = levels.groupBy("_stratum", "_level").agg(
        F.sum("good").alias("n"), F.sum(F.col("good") * hit).alias("k"), F.sum(F.col("bad") * hit).alias("bad")
    )
    strata = held.select("_stratum").distinct().count()
    allowed = error / max(1, strata * LEVELS)
    certified = tested.filter((F.col("n") > 0) & (binomial_tail(F.col("n"), F.col("k"), risk) <= allowed))
    gain = (F.col("bad") - PENALTY * F.col("k")).alias("gain")
    best = certified.select("_stratum", F.struct(gain, (-F.col("_level")).alias("less")).alias("_rank"))
    return best.groupBy("_stratum").agg((-F.max("_rank")["less"]).alias("_level"))


def judge(counted: DataFrame, levels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to documents with counts."""
    small = levels.count() <= BROADCAST_ROWS
    levels = F.broadcast(levels) if small else levels
    kept_columns = [c for c in counted.columns if c.lower() not in ("base_failed", "kept")]
    joined = counted.join(levels, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    failed = base_failed()
    kept = ~failed & ~F.coalesce(first_level() <= F.col("_level"), F.lit(False))
    return joined.select(*kept_columns, failed.alias("base_failed"), kept.alias("kept"))


def filter_documents(documents: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that are kept, with their columns unchanged."""
    names = {c: f"_own_{i}" for i, c in enumerate(documents.columns)}
    own = documents.withColumnsRenamed(names)
    counted = with_counts(own.select(names[doc_id], names[stratum], names[text]), names[text]).drop(names[text])
    counted = written(counted, "counts")
    levels = fit_levels(counted, labels, names[stratum], names[doc_id])
    # A row number that the filter reads keeps the optimizer from taking the verdict and its counts into the filter.
    rated = judge(with_counts(own, names[text]), levels, names[stratum]).withColumn("_row", F.monotonically_increasing_id())
    kept = rated.filter(F.col("kept") & (F.col("_row") >= 0))
    return kept.select(*[F.col(v).alias(k) for k, v in names.items()])

