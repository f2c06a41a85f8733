"""The registered queries of the operators, and SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import chat, decontaminate, divergence, extraction, fingerprint, lengths, licenses, minhash, mix, quality, shards, substrings, whitening
from tidelog.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def _tree_sql(text: str) -> str:
    """A fingerprint in SQL."""
    space = r" \t\n\v\f\r"
    piece = rf"(?:[^{space}]*[^{space}.!?][{space}]+){{0,7}}[^{space}]+"
    marked = (
        f"list_transform(string_split({text}, chr(10)), lambda p: {{'h': substr(sha256(p), 1, 32), 'x': "
        f"list_aggregate(list_transform(regexp_extract_all(p, '{piece}'), lambda w: '.' || substr(sha256(w), 1, 8)), 'string_agg', '')}})"
    )
    joined = (
        f"list_aggregate(list_transform({marked}, lambda s: 'P' || s.h || coalesce(s.x, '') || "
        "case when s.h[1] in ('0', '1') then '|' else '' end), 'string_agg', '')"
    )
    return (
        rf"list_aggregate(list_transform(string_split(regexp_replace({joined}, '\|$', ''), '|'), lambda s: 'S' || "
        r"substr(sha256(regexp_replace(s, '\.[0-9a-f]+', '', 'g')), 1, 32) || s), 'string_agg', '')"
    )


def _likeness_sql(a: str, b: str) -> str:
    x, y = (rf"list_distinct(regexp_extract_all({f}, '\.([0-9a-f]{{8}})', 1))" for f in (a, b))
    return (
        f"case when {a} = {b} then 1.0::double when len({x}) + len({y}) = 0 then 0.0::double "
        f"else 2.0::double * len(list_intersect({x}, {y})) / greatest(len({x}) + len({y}), 1) end"
    )


ORACLE_SQL["op1_fingerprints"] = f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
follow as (select doc_id, text, length(text) as n,
    coalesce(lead(text) over (order by doc_id desc), first_value(text) over (order by doc_id desc)) as next_text from docs),
edits as (select *, substr(text, 1, n - n // 2) || substr(next_text, 1, n // 2) as edited from follow),
trees as (select *, {_tree_sql("text")} as t1, {_tree_sql("edited")} as t2, {_tree_sql("next_text")} as t3 from edits),
prints as (select doc_id, n, edited, {", ".join(
    f"sha256(list_aggregate(regexp_extract_all({t}, 'S([0-9a-f]{{32}})', 1), 'string_agg', '')) || {t} as f{t[1]}" for t in ("t1", "t2", "t3")
)} from trees)
select doc_id, n::bigint as n_chars, sha256(edited) as edited_sha256, f1 as fingerprint, f2 as edited_fingerprint,
  {_likeness_sql("f1", "f2")} as near_edited, {_likeness_sql("f1", "f3")} as near_next from prints
"""


@_query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = minhash.NearDuplicates(shingle=2, percent=80)
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), how)


@_query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents")).drop("row_key")


@_query
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_slots(table(spark, sf_dir, "documents"), n_shards=40)


ORACLE_SQL["op5_shards"] = f"""
with recursive crc_table as (
  select list(c order by i) as t from (select i, list_reduce(range(8),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c from range(256) r(i))),
docs as (select row_number() over () as n, doc_id, coalesce(text, '') as text from documents),
bytes as (select n, doc_id, octet_length(encode(text)) + 16 as size,
    list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::bigint) as b from docs),
sized as (select n, doc_id, size::bigint as size, xor(list_reduce(b,
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)::bigint as text_crc32,
    ('0x' || substr(md5(doc_id::varchar), 1, 4))::int % 512 as block from bytes, crc_table),
hops as (
  select n, -1::bigint as b, 0::bigint as j, ((((doc_id::hugeint + {shards.WORD}) % {shards.WORD}) * {shards.MULTIPLIER} + 1) % {shards.WORD})::hugeint as k from docs
  union all
  select n, j, floor((j + 1) * (2147483648::double / ((k // 8589934592)::double + 1)))::bigint, ((k * {shards.MULTIPLIER} + 1) % {shards.WORD})::hugeint
  from hops where j < 41),
placed as (select n, (max(b) filter (b < 40))::int as shard, (max(b) filter (b < 41))::int as grown_shard from hops group by n)
select doc_id, size, text_crc32, 'key' as law, shard,
  (row_number() over (partition by shard order by block, doc_id, size, text_crc32) - 1)::bigint as slot, grown_shard
from sized join placed using (n)
"""


@_query
def op6_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_histogram(table(spark, sf_dir, "documents"), by="source")


@_query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


ORACLE_SQL["op7_decontamination"] = r"""
with docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as x
    from items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as r(i) where len(w) > 0),
sizes as (select distinct n from windows),
grams as (select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as x
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, sizes where len(w) >= n)),
found as (select g.doc_id, g.i, g.n, item_id from grams g join windows v on g.n = v.n and g.x = v.x),
hit as (select doc_id, count(distinct p) as n_hit from (select distinct doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
owners as (select doc_id, count(*) as n_items, string_agg(k, ',' order by k) as ids
    from (select distinct doc_id, item_id::varchar as k from found) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs d left join hit using (doc_id) left join owners using (doc_id)
"""


@_query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(turns.unionByName(own)))


ORACLE_SQL["op8_chat"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length('<turn>') + length('</turn>') + 2 + length(role) + length(text) + len(regexp_extract_all(text, '\\|<turn>|</turn>|###'))
    + len(regexp_extract_all(role, '\\|<turn>|</turn>|###|\n')))::bigint as formatted_chars
from turns group by conv_id
"""


ORACLE_SQL["op2_minhash"] = r"""
with recursive docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) = 1 then w
    else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s from docs),
one as (select doc_id, len(s) as n, case when len(s) > 0 then min(doc_id) over (partition by list_sort(s)) else doc_id end as class_id, s from sets),
sh as (select doc_id, n, unnest(s) as x from one where class_id = doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as c
    from sh a join sh b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs where 100 * c >= 80 * (na + nb - c)),
edges as (select a, b from links union all select b, a from links),
reach as (select a as id, b as other from edges union select r.id, e.b from reach r join edges e on r.other = e.a),
groups as (select id, min(other) as least from reach group by id)
select doc_id, n::bigint as n_shingles, class_id, least(class_id, coalesce(g.least, class_id)) as component_id,
  doc_id = least(class_id, coalesce(g.least, class_id)) as kept
from one left join groups g on g.id = class_id
"""


@_query
def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"), substrings.Repeats(window=50)).drop("spans")


ORACLE_SQL["op9_substrings"] = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (select doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) as x
    from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from docs where len(w) >= 50)),
first as (select x, min(doc_id) as least from windows group by x),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from windows join first using (x) where doc_id > least),
kept as (select d.doc_id, p, d.w[p] as word from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from docs) d
    left join gone g using (doc_id, p) where g.doc_id is null),
joined as (select doc_id, string_agg(word, ' ' order by p) as t, count(*) as n from kept group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from docs left join joined using (doc_id)
"""


@_query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@_query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_divergence"] = r"""
with docs as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
words as (select id, lang, source, unnest(w) as term from docs),
terms as (select lang, term, count(*) as lang_n from words group by lang, term having count(distinct id) >= 30),
counts as (select lang, source, term, count(*) as n from words group by lang, source, term),
found as (select distinct lang, source from docs),
cells as (select f.lang, f.source, t.term, coalesce(n, 0) as n, lang_n from found f join terms t using (lang)
    left join counts c on c.lang = f.lang and c.source = f.source and c.term = t.term),
shares as (select lang, source, term, n,
    (1 + (1000000000::hugeint * (n + 5)) // (sum(n) over g + 5 * count(*) over g))::bigint as p,
    (1 + (1000000000::hugeint * (lang_n + 5)) // (sum(lang_n) over g + 5 * count(*) over g))::bigint as q
    from cells window g as (partition by lang, source)),
apart as (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value
    from shares x join shares y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by 1, 2, 3),
both_parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from found a join found b on a.lang = b.lang and a.source <> b.source
    left join apart s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all select lang, source, 'term', term, p - q from shares where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from both_parts)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@_query
def op12_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_text(table(spark, sf_dir, "pages"))


# all pages of the tables mark their article
ORACLE_SQL["op12_extraction"] = r"""
with articles as (select page_id, url, regexp_extract(html, '(?s)<article>(.*)</article>', 1) as a from pages),
raw as (select page_id, url, regexp_split_to_array(a, '<[^<>]*>') as parts from articles),
decoded as (select page_id, url, list_transform(parts, lambda p: trim(regexp_replace(regexp_replace(
    replace(p, '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) as parts from raw),
texts as (select page_id, url, coalesce(list_aggregate(list_filter(parts, lambda p: p <> ''), 'string_agg', chr(10)), '') as text from decoded)
select page_id, url, text, length(text)::bigint as n_chars from texts
"""
