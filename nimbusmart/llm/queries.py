"""The queries of the training-data operators, one ``opN_<name>`` each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusmart.llm import bpe, decontaminate, htmltext, lexical, licenses, linededup, neardup, packing, quality, secrets, substrings, topk, variants
from nimbusmart.llm.registry import ORACLES, QUERIES, register
from nimbusmart.llm.tables import table

__all__ = ["QUERIES", "ORACLES"]

# Vocabulary files of the installed public tokenizers.
WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _quality_sql() -> str:
    verdict = " and ".join(
        f"coalesce({r.numerator} / nullif({r.denominator}, 0), 0) between {r.lowest} and {min(r.highest, 1e300)!r}"
        for r in quality.RULES
    )
    return f"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as f
  from documents
), g as (
  select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select rid, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)
), again as (
  select rid, i from (select rid, i, count(*) over (partition by rid, g) as n from g) where n > 1
), covered as (
  select rid, count(distinct i + j) as n from again, (values (0), (1), (2)) as o(j) group by rid
), c as (
  select d.doc_id, len(w) as n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
         len(f) - len(list_distinct(f)) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words,
         length(t) - length(replace(t, '!', '')) as n_exclamations,
         len(list_filter(w, lambda x: x in ({_sql_list(quality.STOP_FORMS)}))) as n_stop_words, len(f) as n_lines,
         len(list_filter(f, lambda x: suffix(x, '...') or suffix(x, '…'))) as n_ellipsis_lines,
         len(list_filter(f, lambda x: prefix(x, '- ') or prefix(x, '* ') or prefix(x, '• '))) as n_bullet_lines
  from d left join covered using (rid)
), v as (
  select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words as base_failed
  from c
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
       cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, base_failed, not base_failed and ({verdict}) as kept
from v
"""


@register("op2_quality_rules", _quality_sql())
def op2_quality_rules(spark, sf_dir) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.drop("text")


@register("op4_bpe")
def op4_bpe(spark, sf_dir) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


@register("op5_secret_scan")
def op5_secret_scan(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.PATTERN)
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(secrets.span_list(F.col("spans"), secrets.KINDS[:3]), 256).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"),
    )


_LINES_SQL = """
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
l as (
  select rid, doc_id, i, s[i] as line, translate(trim(s[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select rid, doc_id, s, unnest(range(1, len(s) + 1)) as i from (select *, string_split(t, chr(10)) as s from d))
), k as (
  select key, max(doc_id) as last from l where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), m as (
  select l.*, k.last is not null and l.doc_id <> k.last as gone from l left join k using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from m group by rid, doc_id
"""


@register("op7_line_dedup", _LINES_SQL)
def op7_line_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.with_kept_text(linededup.keep_bitmaps(docs))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return out.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


_SUBSTRINGS_SQL = """
with d as (
  select row_number() over (order by doc_id) as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
), g as (
  select rid, i, hash(array_to_string(w[i:i + 19], ' ')) as h, md5(array_to_string(w[i:i + 19], ' ')) as m
  from (select rid, w, unnest(range(1, len(w) - 18)) as i from d where len(w) >= 20)
), again as (
  select rid, i from (select rid, i, row_number() over (partition by h, m order by rid, i) as n from g) where n > 1
), gone as (
  select distinct rid, i + j as i from again, (select unnest(range(0, 20)) as j)
), a as (
  select d.rid, d.doc_id, d.w, u.i, gone.i is not null as gone
  from d left join (select rid, unnest(range(1, len(w) + 1)) as i from d) as u using (rid)
       left join gone on gone.rid = u.rid and gone.i = u.i
)
select doc_id, count(i) as n_words, count(*) filter (gone) as n_removed,
       sha256(coalesce(string_agg(w[i], ' ' order by i) filter (not gone and i is not null), '')) as kept_sha256
from a group by rid, doc_id
"""


@register("op10_substring_dedup", _SUBSTRINGS_SQL)
def op10_substring_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substrings.drop_repeats(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# Candidates share one of their rarest shingles: of n, so many that two sets of the
# similarity can't do without; all are then confirmed on the whole sets.
_NEAR_SQL = """
with recursive d as (
  select row_number() over (order by doc_id, text) as rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select rid, doc_id, case when len(w) < 2 then w
    else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
  from d
), x as (
  select rid, len(s) as n, unnest(s) as g from s where doc_id is not null
), f as (
  select g, count(*) as df from x group by g
), p as (
  select rid, n, g from x join f using (g)
  qualify row_number() over (partition by rid order by df, g) <= n - (80 * n + 99) // 100 + 1
), c as (
  select distinct a.rid as u, b.rid as v from p a join p b on a.g = b.g and a.rid < b.rid
  where 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), l as (
  select u, v, len(list_intersect(a.s, b.s)) as common, len(a.s) + len(b.s) as total
  from c join s a on a.rid = u join s b on b.rid = v
), e as (
  select u, v from l where 100 * common >= 80 * (total - common)
  union all select v, u from l where 100 * common >= 80 * (total - common)
), reach as (
  select rid, rid as other from s union select r.rid, e.v from reach r join e on e.u = r.other
), o as (
  select r.rid, min(s.doc_id) as component_id from reach r join s on s.rid = r.other group by r.rid
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, o.component_id, coalesce(s.doc_id = o.component_id, true) as kept
from s join o using (rid)
"""


@register("op9_near_dedup", _NEAR_SQL)
def op9_near_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, shingle_words=2)


_TOPK_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(cast(x as double) * 1024) as bigint)) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
  from v q, v c where q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""


@register("op3_pivot_topk", _TOPK_SQL)
def op3_pivot_topk(spark, sf_dir) -> DataFrame:
    vectors = topk.vector_table(table(spark, sf_dir, "embeddings"))
    return topk.exact_topk(vectors.where("id % 100 = 0"), vectors, topk.K)


@register("op6_packing")
def op6_packing(spark, sf_dir) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op8_html_extraction")
def op8_html_extraction(spark, sf_dir) -> DataFrame:
    out = htmltext.extract(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def _licenses_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in licenses.TEMPLATES)
    spread = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"
    return f"""
with t as (
  select license, list_distinct({spread}) as s
  from (select license, regexp_extract_all(lower(text), '[a-z0-9]+') as w from (values {rows}) as v(license, text))
), tt as (
  select license, len(s) as n, cast(pow(2, ceil(log2(len(s))) + 1) as bigint) // 2 as half, unnest(s) as x from t
), d as (
  select doc_id, w, unnest(range(1, len(w) - 3)) as i
  from (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') as w from documents) where len(w) >= 5
), h as (
  select doc_id, license, n, half, i - 1 as p, x from d join tt on x = array_to_string(w[i:i + 4], ' ')
), f as (
  select doc_id, license, n, (p // half - back) * half as start, count(distinct x) as n_found
  from h, (values (0), (1)) as b(back) where p // half >= back group by all having count(distinct x) * 100 >= n * {licenses.PERCENT}
)
select doc_id, license, max(n_found) as n_found, n as n_shingles, arg_max(start, n_found * 10000000 - start) as first_word
from f group by doc_id, license, n
"""


@register("op1_license_scan", _licenses_sql())
def op1_license_scan(spark, sf_dir) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LEAKS_SQL = f"""
with d as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
), b as (
  select cast(item_id as varchar) as item, w, least(len(w), {decontaminate.WINDOW}) as k
  from (select item_id, regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
        from benchmark where item_id is not null and text is not null)
  where len(w) > 0
), g as (
  select distinct item, k, array_to_string(w[i:i + k - 1], ' ') as g from (select *, unnest(range(1, len(w) - k + 2)) as i from b)
), o as (
  select rid, i, ks.k, array_to_string(w[i:i + ks.k - 1], ' ') as g
  from (select distinct k from g) as ks, (select rid, w, unnest(range(1, len(w) + 1)) as i from d) as p where i + ks.k - 1 <= len(w)
), hit as (
  select o.rid, o.i, o.k, g.item from o join g on o.k = g.k and o.g = g.g
), n as (
  select rid, count(distinct place) as n from (select rid, unnest(range(i, i + k)) as place from hit) group by rid
), its as (
  select rid, count(*) as n, string_agg(item, ',' order by item) as items from (select distinct rid, item from hit) group by rid
)
select doc_id, len(w) as n_words, coalesce(n.n, 0) as n_hit, coalesce(its.n, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n.n, 0) > 0 as contaminated
from d left join n using (rid) left join its using (rid)
"""


@register("op12_decontamination", _LEAKS_SQL)
def op12_decontamination(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit(F.col("hits.spans"))
    return found.select(
        "doc.doc_id",
        "hits.n_words",
        hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_LEXICAL_SQL = f"""
with d as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
  from documents where text is not null
), s as (
  select count(*) as n_docs, cast(sum(len(w)) as bigint) as n_words from d where len(w) > 0
), p as (
  select rid, doc_id, t, count(*) as tf, n from (select rid, doc_id, len(w) as n, unnest(w) as t from d) group by rid, doc_id, t, n
), q as (
  select row_number() over () as qid, item_id, list_distinct(
         regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as w
  from benchmark where text is not null
), t as (
  select t, cast(floor(1000 * ln((2 * cast(n_docs as double) + 2) / (2 * count(*) + 1))) as bigint) as w from p, s group by t, n_docs
), r as (
  select qid, item_id, doc_id, cast(sum(t.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words)))) as bigint) as score
  from (select qid, item_id, unnest(w) as t from q) as x join p using (t) join t using (t), s group by qid, item_id, rid, doc_id
), k as (
  select *, row_number() over (partition by qid order by score desc, doc_id) as rank from r where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from k where rank <= {lexical.K}
"""


@register("op13_lexical_search", _LEXICAL_SQL)
def op13_lexical_search(spark, sf_dir) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"))


_VARIANTS_SQL = f"""
with recursive crc as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
         lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as steps
), r as (
  select doc_id, {LOWER.format("x")} as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) as x from documents) group by all
), h as (
  select run, n, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as hx from r where length(run) >= {variants.MIN_LETTERS}
), c as (
  select run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(hx) // 2), lambda i: cast('0x' || substr(hx, 2 * i + 1, 2) as bigint))),
         lambda a, b: xor(a // 256, steps[xor(a % 256, b) + 1])), 4294967295) as h from h, crc
), w as (
  select word, cast(sum(n) as bigint) as n
  from (select n, case when h % {variants.EVERY} = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from c)
  where length(word) >= {variants.MIN_LETTERS} group by word having sum(n) >= {variants.MIN_COUNT}
), v as (
  select word, i, length(word) as m, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, unnest(range(1, length(word) + 1)) as i from w)
), l as (
  select a.word, b.word as near from v a join v b on a.rest = b.rest and a.i = b.i and a.m = b.m where a.word <> b.word
  union select v.word, w.word from v join w on v.rest = w.word
  union select w.word, v.word from v join w on v.rest = w.word
), b as (
  select l.word, near, w.n, count(*) over (partition by l.word) as n_near,
         row_number() over (partition by l.word order by w.n desc, near) as place
  from l join w on w.word = l.near
), f as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when b.n >= 2 * w.n then near end as form,
         case when b.n >= 2 * w.n then b.n end as form_n
  from w left join (select * from b where place = 1) b using (word)
), t as (
  select word, word as root, form as ahead from f
  union all select t.word, t.ahead, f.form from t join f on f.word = t.ahead
)
select f.word, f.form, t.root, f.n, f.n_near, f.form_n from f join t on t.word = f.word and t.ahead is null
"""


@register("op11_spelling_variants", _VARIANTS_SQL)
def op11_spelling_variants(spark, sf_dir) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))
