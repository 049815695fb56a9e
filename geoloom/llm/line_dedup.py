"""Line de-duplication: a line that an earlier line equals, or is within ``THRESHOLD`` edits of, is removed.

Segment-partition edit join, in built-in functions only. A line is split into threshold + 1 segments; a line within
the threshold contains one of them unchanged, at a place that is off by no more than the edits before and after it
allow. So each line is indexed by (length, number of the segment, segment) and probes, for each length from its own
down to the threshold less, the substrings at the allowed places. Probes pass a bitmap of the index keys of bounded
size first; it lets keys through that are not in the index, never the reverse. Most lines share no key with another
one; of those that do, the texts and the numbers of common letters are looked up. Candidates whose numbers differ too
much never leave the join, those that share too few pieces are dropped. The others are verified between their common
ends by an edit distance whose band of rows is one machine word, column by column.

A line's place is (document id, number of the line). Lines are judged on the input, not on what is left. Lines of
fewer than ``MIN_CHARS`` code points have no near partners; their exact copies go from ``copies_from`` code points on,
if they hold a word: 1 takes every line that holds a word, the default none of the short ones.

The lines are split off and hashed once and written to the shared folder, from which every later step reads the
columns it needs. Texts are never shuffled whole: lines travel as hashes, only the lines of candidates and the documents that lose a
line are brought together. Copies of a line are merged before each shuffle.

Defined results: a null text stays null and has no lines; an line without a word is never removed as a short one; a document without
an id keeps all; rows of one id are one document, so that equal places never remove each other; empty tables give
empty results; columns called like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.bitmaps import Bitmap, WordBitmap
from geoloom.llm.common import set_aside, written

THRESHOLD = 2
MIN_CHARS = 24
#: What a line that holds a word matches.
WORD = r"[^\x20\x09-\x0D]"
#: Pieces of the last filter before the distance is computed; each edit can spoil one.
PIECES = 8
#: Characters whose numbers are compared before anything else; an edit changes two of the numbers by one at most.
COUNTED = " etaoinshrdlcumwfgypbvkjxqz.,012"

ADDED = ("n_lines", "n_removed", "kept_text")


def _segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """First code point (from 1) and size of segment ``i`` (from 1) of a line; later segments take the remainder."""
    base, rest = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    longer = F.greatest(F.lit(0), i - 1 - (parts - rest))
    return 1 + (i - 1) * base + longer, base + F.when(F.lit(i) > parts - rest, 1).otherwise(0)


def probes(threshold: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift) that a line must look up to find every shorter or equally long partner."""
    found = []
    for shorter in range(threshold + 1):
        for i in range(1, threshold + 2):
            after = threshold + 1 - i
            low = max(-(i - 1), shorter - after)
            high = min(i - 1, shorter + after)
            found += [(shorter, i, shift) for shift in range(low, high + 1)]
    return found


def keyed(lines: DataFrame, which: list[tuple[int, int, int]], threshold: int) -> DataFrame:
    """(_h, _key): the keys of the given (length difference, segment, shift) of each line (_h, _line, _chars)."""
    # The choices are rows before the keys are made: one short expression, whatever their number.
    choice = [F.struct(F.lit(d).alias("_shorter"), F.lit(i).alias("_i"), F.lit(shift).alias("_shift")) for d, i, shift in which]
    rows = lines.select("_h", "_line", "_chars", F.inline(F.array(*choice)))
    parts, length = threshold + 1, F.col("_chars") - F.col("_shorter")
    base, rest = F.expr(f"cast((_chars - _shorter) div {parts} as int)"), length % parts
    start = 1 + (F.col("_i") - 1) * base + F.greatest(F.lit(0), F.col("_i") - 1 - (parts - rest)) + F.col("_shift")
    size = base + F.when(F.col("_i") > parts - rest, 1).otherwise(0)
    fits = (length >= MIN_CHARS) & (start >= 1) & (start + size - 1 <= F.col("_chars"))
    key = F.when(fits, F.xxhash64(length, F.col("_i"), F.substring("_line", start, size)))
    return rows.select("_h", key.alias("_key")).filter("_key is not null")


def _counts(line: Column) -> Column:
    """How often each of ``COUNTED`` occurs, modulo 4 and in Gray code, packed into one number: a count that changes
    by one changes one bit."""
    packed = F.lit(0).cast("long")
    for i, c in enumerate(COUNTED):
        n = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))).bitwiseAND(3)
        packed = packed.bitwiseOR(F.shiftleft(n.bitwiseXOR(F.shiftright(n, 1)).cast("long"), 2 * i))
    return packed


def _alike(a: str, b: str, threshold: int) -> str:
    """Condition on two packed numbers that any two lines within the threshold meet."""
    return f"bit_count({a} ^ {b}) <= {2 * threshold}"


def judged_lines(documents: DataFrame, doc_id: str, text: str, copies_from: int = MIN_CHARS) -> DataFrame:
    """Every line that is judged: _doc, _text_hash, _pos, _line, _chars, _place, and its hashes _h1 and _h2."""
    rows = documents.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("_doc"), F.xxhash64(text).alias("_text_hash"), F.posexplode(F.split(text, "\n")).alias("_pos", "_line")
    )
    chars = F.col("_chars")
    judged = chars >= MIN_CHARS
    if copies_from < MIN_CHARS:
        judged = judged | ((chars >= copies_from) & F.col("_line").rlike(WORD))
    rows = rows.withColumn("_chars", F.length("_line")).filter(judged)
    place = F.col("_doc").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("_pos").cast("decimal(10,0)")
    return rows.withColumn("_place", place.cast("decimal(38,0)")).select("*", *_hashes())


def _hashes() -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(7), "_line").alias("_h2")]


def within(a: Column, b: Column, threshold: int) -> Column:
    """Whether two arrays of characters are within ``threshold`` edits: banded, bit-parallel edit distance.

    Rows j - threshold .. j + threshold of column j are the bits of one word that slides down with the columns. A
    set bit of ``vp`` (``vn``) says that the distance grows (falls) by one from the row above. Bits of rows above
    the first act as rows that match nothing. ``score`` is the distance in the band's last row, from the column where
    that row would leave the table on, the distance in the table's last row.
    """
    width = 2 * threshold + 1
    mask = (1 << width) - 1
    rows, columns = F.size(a), F.size(b)

    def column(state: Column, j: Column) -> Column:
        letter = F.get(b, j - 1)
        match = F.lit(0)
        for r in range(width):
            row = j - threshold + r - 1
            match = match.bitwiseOR(F.when(F.get(a, row).eqNullSafe(letter) & (row >= 0), 1 << r).otherwise(0))
        step = F.struct(match.cast("long").alias("x"), state["vp"].alias("vp"), state["vn"].alias("vn"), state["score"].alias("score"))

        def advance(s: Column) -> Column:
            carry = (s["x"].bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])
            diagonal = carry.bitwiseOR(s["x"]).bitwiseOR(s["vn"]).bitwiseAND(mask)
            return F.struct(diagonal.alias("d"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["score"].alias("score"))

        def finish(s: Column) -> Column:
            up = s["vn"].bitwiseOR(F.bitwise_not(s["d"].bitwiseOR(s["vp"]))).bitwiseAND(mask)
            down = s["d"].bitwiseAND(s["vp"])
            shifted = F.shiftright(s["d"], 1)
            vp = down.bitwiseOR(F.bitwise_not(shifted.bitwiseOR(up))).bitwiseAND(mask)
            # While the band's last row is in the table it moves down the diagonal; then the table's last row is
            # one bit higher in the band with each column.
            along = F.when(s["d"].bitwiseAND(1 << (width - 1)) == 0, 1).otherwise(0)
            last = F.pow(F.lit(2.0), (rows - j + threshold).cast("double")).cast("long")
            across = F.when(up.bitwiseAND(last) != 0, 1).otherwise(0) - F.when(down.bitwiseAND(last) != 0, 1).otherwise(0)
            score = s["score"] + F.when(j + threshold <= rows, along).otherwise(across)
            return F.struct(vp.alias("vp"), shifted.bitwiseAND(up).alias("vn"), score.cast("int").alias("score"))

        moved = F.transform(F.transform(F.array(step), advance), finish)[0]
        # The score falls by at most one a column behind the diagonal part.
        return F.when(state["score"] > 3 * threshold, state).otherwise(moved)

    ones = ((1 << (threshold + 1)) - 1) << threshold
    start = F.struct(F.lit(ones & mask).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(threshold).alias("score"))
    steps = F.when(columns > 0, F.sequence(F.lit(1), columns)).otherwise(F.array().cast("array<int>"))
    banded = F.aggregate(steps, start, column, lambda s: s["score"] <= threshold)
    short = F.least(rows, columns) <= threshold
    return F.when(F.abs(rows - columns) > threshold, False).when(short, F.levenshtein(F.array_join(a, ""), F.array_join(b, "")) <= threshold).otherwise(banded)


def _common(a: str, b: str, most: Column, place) -> Column:
    """Largest number up to ``most`` of code points that are equal from one end; ``place(column, done, n)`` is the
    first of the next ``n`` of a line, from 1. Found by halving steps; beyond 65,535 the rest is left unfound."""

    def step(done: Column, n: Column) -> Column:
        same = F.substring(F.col(a), place(a, done, n), n) == F.substring(F.col(b), place(b, done, n), n)
        return done + F.when((done + n <= most) & same, n).otherwise(0)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(15, -1, -1)]), F.lit(0), step)


def without_common_ends(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Adds ``_ma`` and ``_mb``, what lies between the common beginning and the common end: they are as far apart."""
    shorter = F.least(F.length(a), F.length(b))
    begun = pairs.withColumn("_begin", _common(a, b, shorter, lambda c, done, n: done + 1))
    ended = begun.withColumn("_end", _common(a, b, shorter - F.col("_begin"), lambda c, done, n: F.length(c) - done - n + 1))
    middle = {f"_m{x}": F.substring(F.col(c), F.col("_begin") + 1, F.length(c) - F.col("_begin") - F.col("_end")) for x, c in (("a", a), ("b", b))}
    return ended.withColumns(middle).drop("_begin", "_end")


def characters(column: str) -> Column:
    return F.when(F.col(column) == "", F.array().cast("array<string>")).otherwise(F.split(column, ""))


def _share_pieces(a: str, b: str, threshold: int) -> Column:
    """Whether all but ``threshold`` of the pieces of ``a`` occur in ``b``."""
    length, hits = F.length(a), F.lit(0)
    for i in range(1, PIECES + 1):
        start, size = _segment(length, i, PIECES)
        hits = hits + F.when(F.instr(F.col(b), F.substring(F.col(a), start, size)) > 0, 1).otherwise(0)
    return hits >= PIECES - threshold


def close_lines(lines: DataFrame, n_lines: int, threshold: int) -> DataFrame:
    """(_h1, _h2, _near): for every line with a partner within the threshold, the partners' first place."""
    lines = lines.filter(F.col("_chars") >= MIN_CHARS).withColumnRenamed("_h1", "_h")
    plans = probes(threshold)
    at_home = [p for p in plans if p[0] == 0 and p[2] == 0]

    index = written(keyed(lines, at_home, threshold).distinct(), "segments")
    known = WordBitmap(index, "_key", (threshold + 1) * n_lines)
    probe = written(known.maybe(keyed(lines, [p for p in plans if p not in at_home], threshold), "_key").distinct(), "probes")
    # Few lines share a key with another one; only these are looked at, with their text and their counts.
    entries = index.withColumn("_home", F.lit(True)).unionAll(probe.withColumn("_home", F.lit(False)))
    shared = entries.groupBy("_key").agg(F.min("_h").alias("_low"), F.max("_h").alias("_high"), F.bool_or("_home").alias("_any"))
    shared = written(shared.filter("_low < _high and _any").select("_key"), "shared-keys")
    entries = written(entries.join(shared, "_key", "left_semi"), "shared-segments")
    needed = entries.select("_h").distinct()
    some = Bitmap(needed, "_h", needed.count()).maybe(lines.select("_h", "_line", "_place"), "_h")
    texts = some.groupBy("_h", "_line").agg(F.min("_place").alias("_first"))
    texts = written(texts.withColumn("_n", _counts(F.col("_line"))), "shared-lines")
    counted = entries.join(texts.select("_h", "_n").distinct(), "_h")
    home, away = counted.filter("_home"), counted.filter("not _home")
    alike = _alike("x._n", "y._n", threshold)
    same = home.alias("x").join(home.alias("y"), "_key").filter(f"x._h < y._h and {alike}").selectExpr("x._h as _a", "y._h as _b")
    found = away.alias("x").join(home.alias("y"), "_key").filter(f"x._h <> y._h and {alike}").selectExpr("least(x._h, y._h) as _a", "greatest(x._h, y._h) as _b")
    pairs = written(same.unionAll(found).distinct(), "line-pairs")
    texts = texts.drop("_n")
    left = texts.withColumnsRenamed({"_h": "_a", "_line": "_la", "_first": "_fa"})
    right = texts.withColumnsRenamed({"_h": "_b", "_line": "_lb", "_first": "_fb"})
    both = pairs.join(left, "_a").join(right, "_b").filter(_share_pieces("_la", "_lb", threshold))
    # A row number that the filter reads keeps the optimizer from finding the common ends once more inside it.
    trimmed = without_common_ends(both, "_la", "_lb").withColumn("_row", F.monotonically_increasing_id())
    trimmed = trimmed.filter(_share_pieces("_ma", "_mb", threshold) & (F.col("_row") >= 0))
    close = within(F.col("_ca"), F.col("_cb"), threshold)
    links = trimmed.withColumns({"_ca": characters("_ma"), "_cb": characters("_mb")}).filter(close & (F.col("_row") >= 0))
    ends = F.array(F.struct(F.col("_la").alias("l"), F.col("_fb").alias("f")), F.struct(F.col("_lb").alias("l"), F.col("_fa").alias("f")))
    ends = links.select(F.explode(ends).alias("e")).select(F.col("e.l").alias("_line"), F.col("e.f").alias("_near"))
    return ends.select(*_hashes(), "_near").groupBy("_h1", "_h2").agg(F.min("_near").alias("_near"))


def removed_lines(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, copies_from: int = MIN_CHARS
) -> DataFrame:
    """_doc, _text_hash and _gone, the sorted numbers of the lines that go, of every document that loses one."""
    lines = written(judged_lines(documents, doc_id, text, copies_from), "lines")
    firsts = lines.groupBy("_h1", "_h2").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    firsts = written(firsts, "first-lines")
    near = written(close_lines(lines, firsts.count(), threshold), "near-lines")
    # Lines that occur once and have no partner stay without a look.
    copies = firsts.filter("_n > 1").select("_h1", "_h2", F.col("_first").alias("_limit"))
    limits = copies.unionAll(near.select("_h1", "_h2", F.col("_near").alias("_limit")))
    limits = limits.groupBy("_h1", "_h2").agg(F.min("_limit").alias("_limit"))
    found = lines.select("_doc", "_text_hash", "_pos", "_place", "_h1", "_h2").join(limits, ["_h1", "_h2"]).filter("_place > _limit")
    return found.groupBy("_doc", "_text_hash").agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))


def dedup_lines(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, copies_from: int = MIN_CHARS
) -> DataFrame:
    """Documents with ``n_lines`` (all lines), ``n_removed`` and ``kept_text``."""
    own = [c for c in documents.columns if c.lower() not in ADDED]
    gone = written(removed_lines(documents, doc_id, text, threshold, copies_from), "gone-lines")
    rows = documents.select(*own, F.col(text).alias("_text"), F.col(doc_id).cast("long").alias("_id"), F.xxhash64(text).alias("_hash"))
    rows = rows.withColumn("_mark", F.xxhash64("_id", "_hash"))
    # Most documents lose nothing; they are told apart without a shuffle.
    marks = Bitmap(gone.select(F.xxhash64("_doc", "_text_hash").alias("_mark")), "_mark", gone.count())
    tested = marks.marked(rows, "_mark", "_hit")
    none = F.array().cast("array<int>")
    stay = tested.filter(~F.col("_hit")).withColumn("_gone", none)
    lose = tested.filter("_hit").join(gone, (F.col("_id") == F.col("_doc")) & (F.col("_hash") == F.col("_text_hash")), "left")
    lose = lose.withColumn("_gone", F.coalesce("_gone", none))
    columns = [*own, "_text", "_gone"]
    split = stay.select(*columns).unionAll(lose.select(*columns)).withColumn("_lines", F.split("_text", "\n"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone")), lambda i: F.get("_lines", i))
    return split.select(
        *own,
        F.when(F.col("_text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.size("_gone").cast("long").alias("n_removed"),
        F.when(F.size("_gone") > 0, F.array_join(kept, "\n")).otherwise(F.col("_text")).alias("kept_text"),
    )


def remove_lines(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, copies_from: int = MIN_CHARS
) -> DataFrame:
    """Documents with the kept lines as their text; the other columns are unchanged."""
    aside, back = set_aside(documents, ADDED)
    done = dedup_lines(aside, doc_id, text, threshold, copies_from)
    return back(done.withColumn(text, F.col("kept_text")).select(*aside.columns))
