"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geoloom.llm import arrowtext as at
from geoloom.llm import (
    decontaminate,
    line_dedup,
    packing,
    quality_neighbours,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    token_files,
    toxicity,
)
from geoloom.llm.components import roots
from geoloom.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rng, n):
    return [rng.choice("abcdeé") + rng.choice("xyzß") + str(rng.randrange(40)) for _ in range(n)]


def _rows(seed=3):
    """Documents with every special case."""
    rng = random.Random(seed)
    rows = [(k, " ".join(_words(rng, rng.randrange(30, 160)))) for k in range(40)]
    long = " ".join(_words(rng, 9000))
    passage = " ".join(_words(rng, 64))
    rows += [(100, None), (101, ""), (102, " \n\t \n"), (103, "one"), (104, "two words"), (105, long), (106, long + " more")]
    rows += [(110 + k, rows[k][1]) for k in range(8)]  # exact copies
    rows += [(130 + k, f"{rows[k + 8][1]} x{k} {passage} end {k}") for k in range(12)]  # one passage in many
    rows += [(5, rows[5][1]), (5, rows[5][1]), (6, "another text of the same id " + passage)]  # repeated rows, repeated id
    rows += [(None, rows[3][1]), (None, None), (None, passage)]
    rows += [(160, "line of some length number one\nline of some length number one\nshort\nline of some length numbe one"), (161, "line of some length number One\nquite another line of text here\nshort")]
    rows += [(170, "The The " * 400), (171, "<|endoftext|> it's  　 spaced out K K")]
    return [(i, t, None if n % 9 == 0 else ("en", "de")[n % 2], f"s{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def labels(spark, rows):
    own = [(r[0], int(n % 4 != 0), int(n % 5 == 0)) for n, r in enumerate(rows) if n % 3] + [(None, 1, 1), (7, None, None), (10_000, 1, 0)]
    return spark.createDataFrame(own, "doc_id long, quality int, toxic int")


def _key(row):
    return tuple((v is not None, v if not isinstance(v, list) else str(v)) for v in row)


# --- words and hashes


def test_words_and_hashes_do_not_span_texts():
    import pyarrow as pa

    data, places = at.buffers(pa.array(["ab cd", None, "", "é f", " g"]))
    starts, ends, first = at.word_places(data, places, at.WHITE_SPACE)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == ["ab", "cd", "é", "f", "g"]
    assert first.tolist() == [0, 2, 2, 2, 4, 5]
    h = at.byte_hashes(data, starts, ends)
    assert len(set(h.tolist())) == 5
    runs = at.run_hashes(np.array([1, 2, 3, 1, 2, 3, 4], dtype=np.uint64), 3)
    assert runs[0] == runs[3] and len(set(runs.tolist())) == 4 and len(at.run_hashes(h, 6)) == 0


def test_pieces_cover_all_texts():
    places = np.array([0, 5, 5, 400, 410, 411])
    assert list(at.pieces(places, 10)) == [(0, 2), (2, 3), (3, 4), (4, 5)] or sum(b - a for a, b in at.pieces(places, 10)) == 5


# --- 2 substring de-duplication


def _removed_by_brute_force(rows, window):
    first = {}
    split = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window", [50, 7])
def test_substring_dedup(documents, rows, window):
    found = substring_dedup.remove_repeated_windows(documents, window=window)
    assert found.columns == [*documents.columns, "n_words", "n_removed", "kept_text"]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect()), key=_key)
    assert got == sorted(_removed_by_brute_force(rows, window), key=_key)


def test_substring_dedup_with_full_sketch(documents, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MAX_CELLS", 64)
    monkeypatch.setattr(substring_dedup, "MIN_CELLS", 64)
    got = substring_dedup.remove_repeated_windows(documents, window=9).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=_key) == sorted(_removed_by_brute_force(rows, 9), key=_key)


# --- 3 sharding


def test_sharding(documents, rows):
    found = sharding.shard_documents(documents.withColumn("Shard", F.lit("x")), shards=5, tolerance=0.01).toPandas()
    assert len(found) == len(rows) and list(found.columns) == [*documents.columns, "size", "shard", "slot"]
    assert (found["size"] == [len((t or "").encode()) + 1 for t in found.text]).all()
    for _, own in found.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    sizes = found.groupby("shard")["size"].sum()
    assert set(sizes.index) <= set(range(5)) and sizes.max() - sizes.min() <= 2 * found["size"].max()


def test_sharding_cuts_a_hot_group(spark):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    found = sharding.shard_documents(hot, shards=8).toPandas()
    sizes = found.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() <= 1.02 * sizes.mean()


# --- 4 decontamination


def _contaminated_by_brute_force(rows, items, window):
    def words(text):
        return re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().translate(bytes(at.LOWER.tolist())))

    grams = {}
    for i, t in items:
        w = words(t)
        m = min(len(w), window)
        for k in range(len(w) - m + 1 if w else 0):
            grams.setdefault(tuple(w[k : k + m]), set()).add(i)
    out = []
    for r in rows:
        w, hit, ids = words(r[1]), set(), set()
        for m in {len(g) for g in grams}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in grams:
                    hit.update(range(k, k + m))
                    ids |= grams[tuple(w[k : k + m])]
        out.append((r[0], len(w), len(hit), sorted(str(i) for i in ids if i is not None)))
    return out


@pytest.mark.parametrize("shard_words", [1 << 20, 300])
def test_decontamination(spark, documents, rows, shard_words):
    texts = [r[1] for r in rows if r[1]]
    items = [(1, " ".join(texts[2].split()[5:40])), (2, "Two, WORDS!"), (3, None), (4, ""), (5, "nothing of the kind in here at all or so")]
    items += [(1, " ".join(texts[9].split()[:12])), (None, " ".join(texts[11].split()[3:30])), (12, "the the the the the the the the the the the the")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(documents, benchmark, shard_words=shard_words)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=_key)
    assert got == sorted(_contaminated_by_brute_force(rows, items, 10), key=_key)
    match = max((m for r in found.collect() if r.doc_id == 2 for m in r.matches), key=lambda m: m.length)
    assert (match.item_id, match.item_start, match.doc_start, match.length) == ("1", 0, 5, 35)
    clean = decontaminate.remove_contaminated(documents.withColumn("n_hit", F.lit("own")), benchmark, shard_words=shard_words)
    assert clean.columns == [*documents.columns, "n_hit"] and {r.n_hit for r in clean.collect()} == {"own"}
    assert clean.count() == sum(not x[2] for x in got)
    rounds = decontaminate.find_contamination(documents, benchmark, packet_bytes=1, round_bytes=2)
    plain = lambda df: sorted((_key((r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), sorted(map(str, r.matches)))) for r in df.collect()))
    assert plain(rounds) == plain(found)
    several = decontaminate.find_contamination(documents, benchmark, packet_bytes=1)
    assert sorted((_key((r.doc_id, r.n_hit)) for r in several.collect())) == sorted(_key((x[0], x[2])) for x in got)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(5)
    first = np.array([0, 40, 40, 41, 300])
    words = rng.integers(1, 4, 300).astype(np.uint64)
    array = decontaminate.SuffixArray(words, first, 64)
    plain = array._plain(64)

    def suffix(p):
        return array.words[p : min(array.ends[p], p + 64)].tolist()

    for order in (array.order, plain):
        assert sorted(order.tolist()) == list(range(300))
        keys = [suffix(p) for p in order]
        assert keys == sorted(keys)


# --- 5 packing and 10 token files


def _ids(text, path, end):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end]


def test_packing(documents, rows):
    found = packing.pack_documents(documents, BYTE_BPE, end_id=0, group_tokens=5000).toPandas()
    whole = {}
    for n, own in found.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]]
        size = own.length.sum()
        assert size <= 1024 and (own.sequence_length == size).all()
        whole[n] = size
    padding = sum(1024 - n for n in whole.values() if n & (n - 1))
    assert padding == 0
    for r in found.itertuples():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    want = sorted((len(_ids(r[1], BYTE_BPE, 0)) for r in rows), reverse=True)
    assert found.length.sum() == sum(want)
    one = found[found.doc_id == 105].sort_values("start")
    assert [t for ids in one.ids for t in ids] == _ids(next(r[1] for r in rows if r[0] == 105), BYTE_BPE, 0)


def test_packing_prefers_the_lowest_cost():
    pieces = packing.pack(np.array([600, 500, 400, 300, 200, 48]), capacity=1024)
    sequence = {p[0]: p[3] for p in pieces if p[1] == 0}
    assert sequence[0] != sequence[1] and sequence[2] == sequence[1] and sequence[3] == sequence[0]
    assert sum(p[2] for p in pieces) == 2048 and packing.powers(700) == [512, 128, 32, 16, 8, 4]


def test_token_files(spark, documents, rows):
    folder = scratch_path(spark, "files")
    token_files.write_token_files(documents, folder, WORD_BPE, end_id=1)
    found = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    start = 0
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n_tokens) == (start, len(ids))
        start += len(ids)
    ids = [r.doc_id for r in found]
    assert ids == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    want = sorted(((r[0], _ids(r[1], WORD_BPE, 1)) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found), key=lambda x: (x[0] is not None, x[0] or 0, x[1])) == want
    some = token_files.read_token_files(spark, folder, [105, 5, 99_999]).collect()
    assert sorted(r.doc_id for r in some) == [5, 5, 5, 105]


def test_a_damaged_frame_is_noticed(tmp_path):
    path = str(tmp_path / "one.ids.zst")
    writer = token_files.Writer(path, 2)
    for k in range(4):
        writer.add(k, np.arange(70_000) % 50_000)
    writer.close()
    reader = token_files.Reader(path, 2)
    assert len(reader.entries) == 2 and reader.ids(2)[5] == 5  # two documents a frame
    reader.entries[0, 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        reader.ids(1)
    assert reader.ids(3)[69_999] == 19_999


# --- 6 quality rules


def test_counts(documents, rows):
    for r in quality_rules.with_counts(documents).collect():
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        again = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)} if len(windows) < 1500 else None
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert again is None or r.n_repeat_words == len(again)


def test_binomial_tail(spark):
    import math
    from fractions import Fraction

    cases = [(1, 0), (20, 0), (200, 3), (500, 24), (5000, 200), (7, 7)]
    df = spark.createDataFrame(cases, "n long, k long")
    for r in df.withColumn("p", quality_rules.binomial_tail(F.col("n"), F.col("k"), 0.05)).collect():
        want = float(sum(math.comb(r.n, j) * 19 ** (r.n - j) * Fraction(1, 20**r.n) for j in range(r.k + 1))) if r.k < r.n * 0.05 else 1.0
        assert r.p == pytest.approx(want, rel=1e-9)


def test_levels_need_enough_good_documents(spark):
    n = 400
    rows = [(k, ("x" * 5 + " ") * 3 + " ".join(f"w{k}v{j}" for j in range(30)) + ("".join(f" #{j}$$$" for j in range(20)) if k % 5 == 0 else ""), "en" if k % 2 else None) for k in range(n)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 5 != 0)) for k in range(n)], "doc_id long, quality int")
    counted = quality_rules.with_counts(documents)
    levels = quality_rules.fit_levels(counted, labels).collect()
    assert {r["_stratum"] for r in levels} == {None, "en"}
    kept = quality_rules.judge(counted, quality_rules.fit_levels(counted, labels))
    assert {r.doc_id for r in kept.filter("kept").collect()} == {k for k in range(n) if k % 5}
    few = labels.filter("doc_id < 100")
    assert quality_rules.fit_levels(counted, few).count() == 0
    assert quality_rules.judge(counted, quality_rules.fit_levels(counted, few)).filter("kept").count() == n
    filtered = quality_rules.filter_documents(documents.withColumn("kept", F.lit("own")), labels)
    assert filtered.columns == ["doc_id", "text", "lang", "kept"] and filtered.count() == n - n // 5


# --- 7 line de-duplication


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_banded_distance(spark, threshold):
    rng = random.Random(threshold)
    pairs = []
    for _ in range(800):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(0, 14)))
        b = list(a)
        for _ in range(rng.randrange(0, threshold + 3)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randrange(2)] = rng.choice(["", "a", "c"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")

    whole = line_dedup.within(line_dedup.characters("a"), line_dedup.characters("b"), threshold)
    inner = line_dedup.within(line_dedup.characters("_ma"), line_dedup.characters("_mb"), threshold)
    for r in line_dedup.without_common_ends(df, "a", "b").withColumns({"w": whole, "m": inner}).collect():
        assert r.w == r.m == (_distance(r.a, r.b) <= threshold), r
        assert _distance(r["_ma"], r["_mb"]) == _distance(r.a, r.b)


def test_line_dedup(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefg ") for _ in range(rng.randrange(24, 60))) for _ in range(14)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(0, 5)):
            x = list(rng.choice(base))
            for _ in range(rng.randrange(0, 4)):
                k = rng.randrange(len(x))
                x[k : k + rng.randrange(2)] = rng.choice(["", "z", "é", "zz"])
            lines.append("".join(x))
        rows.append((d, "\n".join([*lines, "short"])))
    rows += [(None, base[0]), (70, None), (71, ""), (3, rows[3][1]), (90, base[1] * 300), (91, base[1] * 300 + "z")]
    places = [(i, k, x) for i, t in rows if i is not None for k, x in enumerate((t or "").split("\n")) if len(x) >= line_dedup.MIN_CHARS and t is not None]
    want = []
    for i, t in rows:
        lines = t.split("\n") if t is not None else []
        kept = []
        for k, x in enumerate(lines):
            near = i is not None and len(x) >= line_dedup.MIN_CHARS and any(
                (d, p) < (i, k) and abs(len(y) - len(x)) <= 2 and (x == y or len(x) < 500 and _distance(x, y) <= 2 or len(x) > 500 and x + "z" == y or y + "z" == x)
                for d, p, y in places
            )
            if not near:
                kept.append(x)
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept) if t is not None else None))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("own")).repartition(3)
    got = line_dedup.dedup_lines(df).select("doc_id", "n_lines", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=_key) == sorted(want, key=_key)
    assert sum(x[2] for x in want) > 40
    after = line_dedup.remove_lines(df)
    assert after.columns == df.columns and {r.n_lines for r in after.collect()} == {"own"}


# --- 8 near-duplicates


def test_close_pairs_and_components(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    prints = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << np.uint64(rng.integers(64))) ^ (np.uint64(1) << np.uint64(rng.integers(64))) for _ in range(4)]]))
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= 2}
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array(np.arange(len(prints)))], names=["p", "d"])
    keyed = [tuple(c.to_numpy() for c in b.columns) for b in simhash._keyed(iter([batch]))]
    key, own, doc = (np.concatenate(x) for x in zip(*keyed, strict=True))
    a, b = simhash.close_pairs(key, own.view(np.uint64))
    assert {(min(x, y), max(x, y)) for x, y in zip(doc[a].tolist(), doc[b].tolist(), strict=True)} == want
    chain = spark.createDataFrame([(k, k + 1) for k in range(0, 90)] + [(200, 205), (205, 203), (7, 7)], "a long, b long")
    found = dict(map(tuple, roots(chain).collect()))
    assert found == {k: 0 for k in range(1, 91)} | {203: 200, 205: 200}


def test_near_duplicates(documents, rows):
    import xxhash

    prints = {}
    for r in rows:
        w = (r[1] or "").encode().translate(bytes(at.LOWER.tolist())).split()
        shingles = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
        prints.setdefault(r[0], []).append(sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles)))
    found = simhash.near_duplicates(documents).collect()
    assert len(found) == len(rows)
    for r in found:
        assert int(r.fingerprint, 16) in prints[r.doc_id] and (r.component_id is None) == (r.doc_id is None)
    by_id = {r.doc_id: r.component_id for r in found}
    assert by_id[110] == 0 and by_id[101] == by_id[102] == 100 and by_id[106] in (105, 106)
    left = simhash.drop_near_duplicates(documents)
    ids = [r.doc_id for r in left.collect()]
    assert left.columns == documents.columns and 110 not in ids and 0 in ids and ids.count(None) == 3 and 101 not in ids


# --- 1 and 9 classifiers


@pytest.mark.parametrize("module", [toxicity, quality_neighbours])
def test_scores_of_odd_tables(spark, documents, labels, module, monkeypatch):
    if module is toxicity:
        monkeypatch.setattr(toxicity, "STEPS", 8)
    model = module.fit(documents, labels, F.lit(True))
    found = module.score_documents(documents.withColumn("Score", F.lit("own")), model).collect()
    assert len(found) == documents.count() and all(0 <= r.score <= 1 for r in found)
    again = module.score_documents(documents.filter("doc_id = 5"), model).collect()
    assert len({r.score for r in again}) == 1 and len(again) == 3
    nothing = module.fit(documents, labels.filter("false"), F.lit(True))
    assert len({r.score for r in module.score_documents(documents, nothing).collect()}) == 1


def test_gradients_of_the_network():
    import pyarrow as pa

    net = toxicity.Network(np.random.default_rng(0))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = toxicity.words_of(pa.array(["the red clown runs away", "a b c d e", "xxx"]))
    y, which = np.array([1.0, 0, 1]), np.arange(3)

    def loss():
        p = toxicity._sigmoid(net.forward(words, which, net.inputs(words)).astype(float))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grad = net.gradients(words, which, y)
    for name, place in [("wf", (1, 2)), ("ub", (3, 30)), ("attend", (0, 1)), ("out", (5,)), ("bias", (0,)), ("char", (words.gram_row[0], 3)), ("word", (words.word_row[1], 2))]:
        own = net.p[name][place]
        net.p[name][place] = own + 1e-3
        up = loss()
        net.p[name][place] = own - 1e-3
        down = loss()
        net.p[name][place] = own
        assert grad[name][place] == pytest.approx((up - down) / 2e-3, rel=2e-2, abs=1e-6)


def test_windows_overlap_and_reach_the_last_word():
    import pyarrow as pa

    words = toxicity.words_of(pa.array(["", "a", " ".join(f"w{k}" for k in range(100)), None]))
    assert np.bincount(words.text).tolist() == [1, 1, 6, 1]
    assert words.length.tolist() == [0, 1, 32, 32, 32, 32, 32, 20, 0]


# --- empty tables


def test_empty_tables(spark, documents, labels):
    none = documents.filter("false").select("doc_id", "text", "lang")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.remove_repeated_windows(none).count() == 0
    assert sharding.shard_documents(none).count() == 0
    assert decontaminate.find_contamination(none, benchmark).count() == 0
    assert decontaminate.remove_contaminated(documents, benchmark).count() == documents.count()
    assert packing.pack_documents(none, BYTE_BPE).count() == 0
    assert quality_rules.filter_documents(none, labels).count() == 0
    assert quality_rules.filter_documents(documents, labels.filter("false")).count() > 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    folder = scratch_path(spark, "empty")
    token_files.write_token_files(none, folder, WORD_BPE, end_id=1)
    assert token_files.read_token_files(spark, folder).count() == 0
    for module in (toxicity, quality_neighbours):
        assert module.score_documents(none, module.fit(none, labels, F.lit(True))).count() == 0


