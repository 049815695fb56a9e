"""Queries opN over whole tables, and the SQL each must equal where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import decontaminate, filter_audit, lexical_search, license_rules, license_scan, line_dedup, packing, quality_neighbours, quality_rules
from geoloom.llm import sharding, simhash, substring_dedup, token_files, toxicity
from geoloom.llm.common import written
from geoloom.llm.labelled import in_fold
from geoloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op4_benchmark_decontamination",
    f"""
with d as (select doc_id, {_ALNUM_WORDS} as w from documents),
b as (select cast(item_id as varchar) as item, {_ALNUM_WORDS} as w from benchmark),
bw as (select item, len(w) as n, w, least(len(w), 10) as m, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
       from b where len(w) > 0),
grams as (select distinct item, m, array_to_string(list_slice(w, i, i + m - 1), ' ') as gram from bw),
sizes as (select distinct m from grams),
dw as (select doc_id, m, w, unnest(range(1, len(w) - m + 2)) as i from d, sizes where len(w) >= m),
hits as (select doc_id, item, dw.i, dw.m from dw
         join grams on grams.m = dw.m and grams.gram = array_to_string(list_slice(dw.w, dw.i, dw.i + dw.m - 1), ' ')),
words as (select doc_id, count(distinct p) as n_hit
          from (select doc_id, unnest(range(i, i + m)) as p from (select distinct doc_id, i, m from hits)) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
          from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
""",
)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf).select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    return decontaminate.digest(decontaminate.find_contamination(documents, benchmark))


@query("op5_packing")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(_documents(spark, sf), vocabulary, end_id=0, with_ids=False)


@query("op10_token_files")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "op10")
    token_files.write_token_files(_documents(spark, sf), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    found = token_files.read_token_files(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query(
    "op2_substring_dedup",
    """
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50),
g as (select doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) as h from s),
late as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by h) as first_id from g) where doc_id > first_id),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from late),
gp as (select doc_id, list(p) as ps from gone group by doc_id),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d where len(w) > 0),
kept as (select words.doc_id, string_agg(word, ' ' order by words.p) as t
         from words left join gone on gone.doc_id = words.doc_id and gone.p = words.p where gone.p is null group by words.doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(len(ps), 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join gp using (doc_id) left join kept using (doc_id)
""",
)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf).select("doc_id", "text")
    found = substring_dedup.remove_repeated_windows(documents)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf).select("doc_id", "text")).drop("text")


@query("op3_sharding")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    # The sum of the text is taken where the text is read: what the result does not hold is not exchanged.
    documents = _documents(spark, sf).select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return sharding.shard_documents(documents).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_RULES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
}
_FIRST_LEVEL = " ".join(
    f"when {' or '.join(f'{_RULES[r]} > {cuts[k]}' for r, cuts in quality_rules.LADDER.items())} then {k + 1}"
    for k in range(quality_rules.LEVELS)
)


@query(
    "op6_quality_rules",
    f"""
with w as (select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
           from documents),
s as (select doc_id, unnest(range(1, len(w) - 6)) as i, w from w where len(w) >= 8),
g as (select doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') as h from s),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, h) as n from g) where n > 1),
rep as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from twice) group by doc_id),
c as (select w.doc_id, lang, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
             cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(len(ls) as bigint) as n_lines, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
             cast(coalesce(rep.n, 0) as bigint) as n_repeat_words
      from w left join rep using (doc_id)),
b as (select *, n_words < {quality_rules.MIN_WORDS}
                or 100 * n_repeat_words > {quality_rules.MAX_REPEATED_PERCENT} * n_words as base_failed from c),
f as (select *, case {_FIRST_LEVEL} else {quality_rules.LEVELS + 1} end as lvl from b),
lab as (select doc_id, min(quality) as q from labels where quality is not null group by doc_id),
held as (select lang, lvl, q from f join lab using (doc_id) where not base_failed),
tested as (select lang, l, count(*) filter (where q = 1) as n, count(*) filter (where q = 1 and lvl <= l) as k,
                  count(*) filter (where q <> 1 and lvl <= l) as bad
           from held, (select unnest(range(1, {quality_rules.LEVELS + 1})) as l) group by lang, l),
p as (select *, case when k < n * {quality_rules.RISK} then list_sum(list_transform(range(0, k + 1), lambda j:
                     exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln({quality_rules.RISK})
                         + (n - j) * ln(1 - {quality_rules.RISK})))) else 1.0 end as tail from tested where n > 0),
best as (select lang, first(l order by bad - {quality_rules.PENALTY} * k desc, l) as chosen from p
         where tail <= {quality_rules.ERROR} / ((select count(*) from (select distinct lang from held)) * {quality_rules.LEVELS})
         group by lang)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not coalesce(lvl <= chosen, false) as kept
from f left join best on f.lang is not distinct from best.lang
""",
)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    counted = written(quality_rules.with_counts(_documents(spark, sf).select("doc_id", "lang", "text")).drop("text"), "counts")
    levels = quality_rules.fit_levels(counted, spark.read.parquet(f"{sf}/labels.parquet"))
    return quality_rules.judge(counted, levels).drop("lang", "n_lines")


def _verdicts(scored: DataFrame, folds: int, fold: int, least: float) -> DataFrame:
    predicted = F.when(F.col("score") >= least, 1).otherwise(0)
    return scored.select("doc_id", in_fold("doc_id", folds, fold).alias("held_out"), "score", predicted.alias("predicted"))


@query("op1_toxicity")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf).select("doc_id", "text")
    model = toxicity.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"), ~in_fold("_id", 3, 1))
    return _verdicts(toxicity.score_documents(documents, model), 3, 1, 0.7)


@query("op9_quality_neighbours")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf).select("doc_id", "text")
    model = quality_neighbours.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"), ~in_fold("_id", 5, 0))
    return _verdicts(quality_neighbours.score_documents(documents, model), 5, 0, 0.3)


# The SQL engine's edit distance counts bytes: letters outside ASCII become one byte each first.
_ACCENTED = "ÄÇÈÉÊÍÑÓÖÜßáâäçèéêíîñóöúü"
_ONE_BYTE = "".join(chr(k) for k in [*range(1, 9), *range(11, 28)])
_COUNTED = "aeinorsthl"


@query(
    "op7_line_dedup",
    f"""
with l as (select doc_id, text, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as pos
           from documents where text is not null),
j as (select *, doc_id * 4294967296 + pos as place from l
      where doc_id is not null and (length(line) >= {line_dedup.MIN_CHARS} or regexp_matches(line, '[^\\x20\\x09-\\x0D]'))),
u as (select line, min(place) as first_place, length(line) as n,
             translate(line, '{_ACCENTED}', '{_ONE_BYTE}') as bytes,
             {', '.join(f"length(replace(line, '{c}', '')) as n_{c}" for c in _COUNTED)}
      from j group by line),
v as (select * from u where n >= {line_dedup.MIN_CHARS}),
x as (select *, unnest(range(n - {line_dedup.THRESHOLD}, n + {line_dedup.THRESHOLD + 1})) as m from v),
near as (select x.line, min(v.first_place) as near_place from x join v on x.m = v.n and x.line <> v.line
             {' '.join(f"and abs((x.n - x.n_{c}) - (v.n - v.n_{c})) <= {line_dedup.THRESHOLD}" for c in _COUNTED)}
             and levenshtein(x.bytes, v.bytes) <= {line_dedup.THRESHOLD}
         group by x.line),
gone as (select j.doc_id, j.pos from j join u using (line) left join near using (line)
         where j.place > least(u.first_place, coalesce(near_place, u.first_place))),
kept as (select l.doc_id, string_agg(line, chr(10) order by l.pos) as t from l left join gone
         on l.doc_id = gone.doc_id and l.pos = gone.pos where gone.pos is null group by l.doc_id),
n as (select doc_id, count(*) as n_removed from gone group by doc_id)
select d.doc_id, cast(coalesce(len(string_split(d.text, chr(10))), 0) as bigint) as n_lines,
       cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from documents d left join n using (doc_id) left join kept using (doc_id)
""",
)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    found = line_dedup.dedup_lines(_documents(spark, sf).select("doc_id", "text"), copies_from=1)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


_FAILS = "select 'A' as x, 1 as bit union all select 'B', 2 union all select 'C', 4 union all select 'D', 8 union all select 'E', 16"


@query(
    "op13_filter_audit",
    f"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
m as (select doc_id, part,
             case when len(w) < 50 then 1 else 0 end + case when 100 * len(list_distinct(w)) < 65 * len(w) then 2 else 0 end
             + case when 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) then 4 else 0 end
             + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
             + case when doc_id > min(doc_id) over (partition by text) then 16 else 0 end as mask from d),
lab as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
        from labels where doc_id is not null group by doc_id),
f as ({_FAILS}),
orders as (select a.x || b.x || c.x || d.x || e.x as filter_order,
                  [0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, a.bit + b.bit + c.bit + d.bit] as befores
           from f a join f b on a.x <> b.x join f c on c.x not in (a.x, b.x) join f d on d.x not in (a.x, b.x, c.x)
           join f e on e.x not in (a.x, b.x, c.x, d.x)),
steps as (select filter_order, step, befores[step] as before, f.bit as own
          from orders, (select unnest(range(1, 6)) as step) join f on f.x = substring(filter_order, step, 1)),
cells as (select part, filter_order, step, own,
                 count(*) filter (where mask & (before | own) = 0) as kept,
                 count(*) filter (where mask & own > 0 and mask & before = 0) as removed,
                 count(*) filter (where mask & own > 0 and mask & before > 0) as redundant,
                 count(*) filter (where mask = own) as unique_fails,
                 count(*) filter (where mask & own > 0 and mask & before = 0 and good = 1) as good_lost,
                 count(*) filter (where mask & own > 0 and mask & before = 0 and toxic = 1) as toxic_lost
          from m left join lab using (doc_id), steps group by part, filter_order, step, own)
select part, filter_order, cast(step as int) as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) as shapley
from cells
""",
)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(_documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_RULE_ROWS = ", ".join(f"({r.number}, {r.priority}, {_quoted(r.label)}, {_quoted(r.keyword)}, {_quoted(r.expression)}, {r.base})" for r in license_rules.RULES)
_NOT_IN_WORDS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


@query(
    "op12_license_scan",
    f"""
with rules(rule, priority, label, keyword, expression, base) as (values {_RULE_ROWS}),
d as materialized (select row_number() over () as k, doc_id,
             trim(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_NOT_IN_WORDS}', ' ', 'g')) as s from documents),
a as (select *, ' ' || replace(s, ' ', '  ') || ' ' as apart from d),
m as (select k, rules.*, regexp_extract_all(apart, expression) as ms,
             list_filter(list_transform(string_split(regexp_replace(apart, '(' || expression || ')', chr(1) || '\\1', 'g'), ' '),
                                        lambda x, i: case when x = chr(1) then (i - 1) // 2 end), lambda x: x is not null) as ps
      from a join rules on contains(apart, ' ' || keyword) and regexp_matches(apart, expression)),
f as (select k, rule, priority, label, base, unnest(ps) as first_w, unnest(list_transform(ms, lambda x: len(x) - len(replace(x, ' ', '')))) // 2 as n from m),
kept as (select * from f where not exists (
           select 1 from f g where g.k = f.k and g.first_w <= f.first_w and g.first_w + g.n >= f.first_w + f.n and g.priority <= f.priority
           and (g.priority < f.priority or g.n > f.n or g.rule < f.rule))),
b as (select k, count(*) as n_base, min(first_w) as first_word, max(first_w) as last_word, list(distinct label) as own from f where base group by k),
l as (select k, list(distinct label) as own, min(priority) as best from kept group by k)
select doc_id, cast(case when s = '' then 0 else len(string_split(s, ' ')) end as bigint) as n_words, coalesce(n_base, 0) as n_base,
       first_word, last_word, coalesce(array_to_string(list_sort(b.own), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(b.own, l.own))), ','), '') as labels,
       cast(case best {' '.join(f'when {p} then {c}' for p, c in license_rules.CONFIDENCE.items())} else 0 end as double) as score
from a left join b using (k) left join l using (k)
""",
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(_documents(spark, sf).select("doc_id", "text")).drop("text", "detections")


@query(
    "op11_lexical_search",
    f"""
with d as materialized (select row_number() over () as k, doc_id, {_ALNUM_WORDS} as w from documents),
s as (select count(*) filter (where len(w) > 0) as nd, cast(sum(len(w)) as bigint) as lt from d),
b as materialized (select row_number() over () as q, item_id, list_distinct({_ALNUM_WORDS}) as w from benchmark),
bt as (select q, item_id, unnest(w) as term from b),
terms as (select distinct term from bt),
tf as (select k, doc_id, n, term, count(*) as tf from (select k, doc_id, len(w) as n, unnest(w) as term from d) semi join terms using (term)
       group by all),
wt as (select term, cast(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) as bigint) as w from tf, s group by term),
sc as (select q, item_id, k, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nd) // lt))))) as bigint) as score
       from bt join tf using (term) join wt using (term), s group by all),
r as (select *, row_number() over (partition by q order by score desc, doc_id) as rank from sc where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from r where rank <= {lexical_search.TOP}
""",
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_search.search(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
