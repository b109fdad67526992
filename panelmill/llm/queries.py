"""The registered queries of this folder, each next to the SQL that checks it where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelmill.llm.common import table
from panelmill.llm.decontaminate import find_items
from panelmill.llm.exact_dedup import exact_groups
from panelmill.llm.hash_ring import assign_shards
from panelmill.llm.html_tree import extract_pages
from panelmill.llm.merkle_manifest import verify_documents
from panelmill.llm.minhash_join import near_groups
from panelmill.llm.phrase_trees import collocations
from panelmill.llm.pii_feistel import pseudonymise
from panelmill.llm.prefix_bpe import encode_documents
from panelmill.llm.quality_trees import score_quality
from panelmill.llm.suffix_dedup import strip_repeats
from panelmill.llm.url_automaton import filter_urls
from panelmill.llm.warc_index import archive_pages, read_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A key for tests only; a caller passes one from a secret store.
PII_KEY = "key of the registered query"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_warc", r"""
with p as (
  select page_id, encode(coalesce(html, '')) as payload, sha1(encode(coalesce(html, ''))) as hex from pages),
g as (select payload, min(page_id) as first from p group by payload)
select p.page_id, cast(octet_length(p.payload) as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((cast('0x' || substr(p.hex, cast(1 + 5 * (i // 4) as bigint), 5) as bigint) >> cast(15 - 5 * (i % 4) as integer)) & 31), 1)), '') as payload_digest,
  case when p.page_id = g.first then 'response' else 'revisit' end as record_type,
  case when p.page_id <> g.first then g.first end as refers_to
from p join g using (payload)""")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = archive_pages(table(spark, sf_dir, "pages"))
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


@query("op4_near_dedup", r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as a
  from documents),
s as (
  select doc_id, unnest(case when len(a) = 0 then [] when len(a) < 5 then [array_to_string(a, ' ')]
    else list_distinct(list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i + 4], ' '))) end) as shingle
  from w),
n as (select doc_id, count(*) as size from s group by doc_id),
links as (
  select x.doc_id as a, y.doc_id as b from s x join s y on x.shingle = y.shingle and x.doc_id <> y.doc_id
  join n nx on nx.doc_id = x.doc_id join n ny on ny.doc_id = y.doc_id
  group by x.doc_id, y.doc_id, nx.size, ny.size having 100 * count(*) >= 75 * (nx.size + ny.size - count(*))),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select w.doc_id, coalesce(n.size, 0) as n_shingles, least(w.doc_id, coalesce(m.low, w.doc_id)) as component_id,
  w.doc_id <= coalesce(m.low, w.doc_id) as kept
from w left join n using (doc_id) left join (select a as doc_id, min(b) as low from reach group by a) m using (doc_id)""")
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_url_filter", r"""
with u as (
  select page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
r(verdict, rh, rp) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best as (
  select u.*, (select r.rh || r.rp from r where (u.host = r.rh or ends_with(u.host, '.' || r.rh)) and starts_with(u.path, r.rp)
               order by length(r.rh || r.rp) desc limit 1) as rule
  from u)
select best.page_id, host, path, rule, coalesce(r.verdict, 'allow') as verdict from best left join r on best.rule = r.rh || r.rp""")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strip_repeats(table(spark, sf_dir, "documents"), keep_text=True)


@query("op9_exact_dedup", r"""
with t as (
  select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
k as (
  select *, first_value(doc_id) over (partition by norm order by n desc, doc_id) as keep_id, count(*) over (partition by norm) as group_size from t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from k""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("hash")


@query("op10_html")
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


@query("op11_phrases", r"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as a from p),
f as materialized (
  select lang, k, phrase, count(*) as f from (
    select lang, k, unnest(list_transform(range(1, len(a) - k + 2), lambda i: array_to_string(a[i:i + k - 1], ' '))) as phrase from w, range(1, 5) t(k))
  group by all),
totals as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as materialized (select lang, k, phrase, f as a, string_split(phrase, ' ') as s from f where k > 1 and f >= 30),
cuts as (
  select c.lang, c.phrase, c.k, c.a, cut, l.f as l, r.f as r, (2000000::hugeint * c.a // (l.f + r.f))::bigint as score
  from (select *, unnest(range(1, k)) as cut from c) c
  join f l on l.lang = c.lang and l.phrase = array_to_string(s[1:cut], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(s[cut + 1:], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (
  select lang, array_to_string(s[i:i + m - 1], ' ') as phrase, max(a) as most
  from (select *, unnest(range(1, k - m + 2)) as i from (select *, unnest(range(2, k)) as m from c)) group by all)
select best.lang, row_number() over (partition by best.lang order by score desc, a desc, best.phrase) as rank, best.phrase, a, l, r, n, score
from best join totals on totals.lang = best.lang left join inside on inside.lang = best.lang and inside.phrase = best.phrase
where not coalesce(100::hugeint * most >= 80 * a, false) qualify rank <= 2000""")
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def _climb_sql(prefix: str, levels: int) -> str:
    """Levels 1 to ``levels`` of the nodes (tree, i, h) and of the ways (id, tree, i, f, proof) up from each leaf, a CTE each."""
    out = []
    for k in range(levels):
        nodes, ways = f"{prefix}{k}", f"{prefix}way{k}"
        out.append(f"""c{nodes} as materialized (select *, count(*) over (partition by tree) as n from {nodes})""")
        out.append(f"""{prefix}{k + 1} as materialized (
  select tree, i // 2 as i, case when any_value(n) = 1 then any_value(h) else sha256(string_agg(h, '' order by i)) end as h from c{nodes} group by tree, i // 2)""")
        out.append(f"""{prefix}way{k + 1} as materialized (
  select w.id, w.tree, w.i // 2 as i, w.proof || coalesce(s.h, '') as proof,
    case when o.n = 1 then w.f when w.i % 2 = 0 then sha256(w.f || coalesce(s.h, '')) else sha256(s.h || w.f) end as f
  from {ways} w join c{nodes} o on o.tree = w.tree and o.i = w.i left join c{nodes} s on s.tree = w.tree and s.i = xor(w.i, 1))""")
    return ",\n".join(out)


def _merkle_sql(levels: int = 24, over: int = 8) -> str:
    """Trees of at most 2 ** levels leaves, at most 2 ** over of them."""
    f = "coalesce(cast(octet_length(encode(cast({0} as varchar))) as varchar) || ':' || cast({0} as varchar), '-')".format
    leaf = "sha256({})".format
    own = " || ".join(map(f, ("doc_id", "source", "lang", "n_chars", "text")))
    more = " || ".join(map(f, ("doc_id", "source", "lang", "(n_chars::hugeint + 1)", "text")))
    return f"""
with d as materialized (
  select row_number() over () as id, doc_id, coalesce('=' || lang, '') as tree, {leaf(own)} as leaf, {leaf(more)} as more, n_chars,
    xor(list_reduce([4294967295::bigint] || list_transform(range(1, length(doc_id::varchar) + 1), lambda j: ord(substr(doc_id::varchar, j::bigint, 1))::bigint),
      lambda v, b: list_reduce([xor(v, b)] || range(8), lambda a, j: xor(a >> 1, (a & 1) * 3988292384::bigint))), 4294967295::bigint) as crc
  from documents),
g as materialized (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i from d),
x0 as materialized (select tree, i, leaf as h from g),
xway0 as materialized (select id, tree, i, '' as proof, case when crc % 7 = 0 and n_chars is not null then more else leaf end as f from g),
{_climb_sql('x', levels)},
t0 as materialized (select 'all' as tree, row_number() over (order by tree) - 1 as i, h, tree as of from x{levels}),
tway0 as materialized (select w.id, 'all' as tree, t0.i, w.proof, w.f from xway{levels} w join t0 on t0.of = w.tree),
{_climb_sql('t', over)}
select doc_id, leaf, x{levels}.h as subroot, t{over}.h as root, sha256(w.proof) as proof_sha256, w.f as folded_root, w.f = t{over}.h as verified
from g join tway{over} w using (id) join x{levels} on x{levels}.tree = g.tree cross join t{over}"""


@query("op12_merkle", _merkle_sql())
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_documents(table(spark, sf_dir, "documents"))


@query("op13_shards")
def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))
