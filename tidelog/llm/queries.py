"""One query per operator over its whole table, and SQL counterparts where SQL has them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    chunk_dedup,
    class_lm,
    decontaminate,
    language,
    line_dedup,
    mixing,
    near_dup,
    ranking,
    search,
    sharding,
    spelling,
    toxicity,
    url_filter,
)
from tidelog.llm.common import remainder, table

RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.delete_repeated_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", "n_deleted")


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(5) == 0
    filters = language.learn(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_items(docs, items)


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(7) == 2
    scored = class_lm.score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.withColumn("held_out", held_out)


def op7_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.passages(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(5) == 0
    machine = toxicity.learn(toxicity.labelled(docs, labels.where(~held_out)))
    scored = toxicity.score(docs.select("doc_id", "text"), machine)
    score = F.col("toxicity")
    return scored.select(
        "doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return dealt.withColumn("grown_shard", F.lit(None).cast("int"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    name: query for name, query in list(globals().items()) if name.startswith("op") and name[2].isdigit()
}


# SQL counterparts

BLANK = r"[\x20\x09-\x0D]"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES_SQL = rf"""
with raw as (select doc_id, string_split(text, chr(10)) as parts from documents),
lines as (select doc_id, parts, unnest(range(1, len(parts) + 1)) as i from raw),
trimmed as (
  select doc_id, i, parts[i] as line,
    regexp_replace(parts[i], '^{BLANK}+|{BLANK}+$', '', 'g') as body
  from lines),
numbered as (
  select doc_id, i, body, row_number() over (partition by doc_id order by i) as p,
    count(*) over (partition by doc_id) as total, len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) as k
  from trimmed where body <> ''),
windows as (
  select doc_id, p, 1 as size, total, k as words, body as run from numbered
  union all
  select doc_id, p, 2, total, k + lead(k) over w, body || chr(10) || lead(body) over w
  from numbered window w as (partition by doc_id order by p)
  union all
  select doc_id, p, 3, total, 0, body || chr(10) || lead(body, 1) over w || chr(10) || lead(body, 2) over w
  from numbered window w as (partition by doc_id order by p)),
ranked as (
  select doc_id, p, size, row_number() over (partition by run order by doc_id, p) as r
  from windows where run is not null and (size = 3 or words >= 8 or size = total)),
gone as (
  select distinct doc_id, p + d as p from ranked, (select unnest([0, 1, 2]) as d) where r > 1 and d < size),
marked as (
  select t.doc_id, t.i, t.line, case when n.p is not null then g.p is not null end as deleted
  from trimmed t left join numbered n using (doc_id, i)
  left join gone g on g.doc_id = n.doc_id and g.p = n.p),
followed as (
  select *, coalesce(last_value(deleted ignore nulls) over (partition by doc_id order by i), false) as cut
  from marked),
kept as (
  select doc_id, string_agg(line, chr(10) order by i) filter (where not cut) as text,
    count_if(coalesce(deleted, false))::bigint as n_deleted
  from followed group by doc_id)
select d.doc_id, case when d.text is not null then coalesce(k.text, '') end as text,
  coalesce(k.n_deleted, 0)::bigint as n_deleted
from documents d left join kept k using (doc_id)
"""

NEAR_SQL = rf"""
with recursive words as (
  select doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case
    when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
    when len(w) >= 1 then [array_to_string(w, ' ')] else [] end as s
  from words),
sized as (select doc_id, len(s)::bigint as n_shingles from sets),
postings as (select doc_id, unnest(s) as g from sets),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from postings a join postings b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select c.a, c.b from common c join sized x on x.doc_id = c.a join sized y on y.doc_id = c.b
  where 100 * c.n >= 85 * (x.n_shingles + y.n_shingles - c.n)),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a as doc_id, min(b) as m from reach group by 1)
select doc_id, n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id,
  doc_id <= coalesce(m, doc_id) as kept
from sized left join least using (doc_id)
"""

MIX_SQL = r"""
with sized as (
  select doc_id, source, substr(md5(doc_id::varchar), 1, 12) as place,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, 3 * source_size as most,
    ([5, 2, 1])[1 + (row_number() over (order by encode(source) nulls last) - 1) % 3]::bigint as weight
  from sources),
levels as (
  select *, sum(source_size) over () - coalesce(sum(most) over (o rows between unbounded preceding and 1 preceding), 0) as rest_size,
    sum(weight) over (o rows between current row and unbounded following) as shared_by
  from weighed window o as (order by most / weight, encode(source) nulls last)),
level as (
  select max(shared_by) as shared_by, max_by(rest_size, shared_by) as rest_size
  from levels where rest_size * weight <= most * shared_by),
targets as (
  select l.source, l.source_size, case when l.shared_by > v.shared_by then l.most::double
    else (l.weight * v.rest_size)::double / v.shared_by::double end as target
  from levels l, level v),
plan as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::int as passes,
    target - case when source_size > 0 then floor(target / source_size) else 0 end * source_size as rest
  from targets),
places as (
  select source, place, sum(size) as words, sum(sum(size)) over (partition by source order by place) as upto
  from sized group by source, place),
chosen as (
  select s.*, p.source_size, p.target, p.passes + case when p.rest > 0 and p.passes < 3
    and (x.upto < p.rest or x.upto - x.words < p.rest and x.upto - x.words + x.words / 2 <= p.rest) then 1 else 0 end as copies
  from sized s join plan p on s.source is not distinct from p.source
  join places x on x.source is not distinct from s.source and x.place = s.place)
select doc_id, size, source_size, target, (size * copies)::bigint as taken, source, copies::int as copies from chosen
"""

SEARCH_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(embedding) = len(list_filter(embedding, lambda x: x is not null and isfinite(x)))),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

RANK_SQL = rf"""
with words as (
  select doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents where text is not null),
counted as (select doc_id, w, len(w)::bigint as n from words where len(w) > 0),
totals as (select count(*)::bigint as docs, sum(n)::bigint as terms from counted),
tfs as (
  select doc_id, term, any_value(n) as n, count(*)::bigint as tf
  from (select doc_id, n, unnest(w) as term from counted) group by all),
asked as (
  select item_id, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark where text is not null),
weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
  from tfs, totals group by term),
scored as (
  select item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::bigint as score
  from asked join tfs using (term) join weights using (term), totals group by item_id, doc_id),
ranked as (
  select item_id, doc_id, score,
    row_number() over (partition by item_id order by score desc, doc_id)::int as rank
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

#: crc32 by its usual table, which a rule builds, over the bytes of ``s``.
_CRC_STEP = "case when {0} & 1 = 1 then xor({0} >> 1, 3988292384) else {0} >> 1 end"
SPELLING_SQL = rf"""
with recursive steps(i, v, k) as (
  select range, range::bigint, 0 from range(256)
  union all select i, {_CRC_STEP.format('v')}, k + 1 from steps where k < 8),
crcs as (select list(v order by i) as t from steps where k = 8),
runs as (
  select doc_id, unnest(regexp_extract_all({LOWER}, '[A-Za-zÀ-ÿ]+')) as run
  from documents where text is not null),
distinct_runs as (
  select run, coalesce(doc_id::varchar, '') || ':' || run as s, count(*) as n from runs group by all),
coded as (
  select run, n, len(run) as l, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(s))),
      lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) as h
  from distinct_runs, crcs),
cut as (
  select n, case when h % 97 = 0 then substr(run, 1, h % l) || substr(run, h % l + 2) else run end as word
  from coded),
vocab as (
  select word, sum(n)::bigint as n from cut where len(word) >= 5 group by word having sum(n) >= 3),
shorter as (
  select word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) as rest
  from (select word, n, unnest(range(1, len(word) + 1)) as p from vocab)),
pairs as (
  select a.word, b.word as near, b.n as near_n from shorter a join shorter b on a.p = b.p and a.rest = b.rest and a.word <> b.word
  union select a.word, b.word, b.n from shorter a join vocab b on a.rest = b.word
  union select b.word, a.word, a.n from shorter a join vocab b on a.rest = b.word),
best as (
  select word, count(*)::bigint as n_near, (array_agg(near order by near_n desc, encode(near)))[1] as near, max(near_n) as near_n
  from pairs group by word),
formed as (
  select v.word, v.n, coalesce(b.n_near, 0)::bigint as n_near,
    case when b.near_n >= 2 * v.n then b.near end as form, case when b.near_n >= 2 * v.n then b.near_n end as form_n
  from vocab v left join best b using (word)),
walk(word, root) as (
  select word, word from formed
  union all select w.word, f.form from walk w join formed f on f.word = w.root where f.form is not null),
ends as (select w.word, w.root from walk w join formed f on f.word = w.root where f.form is null)
select f.word, f.form, e.root, f.n, f.n_near, f.form_n from formed f join ends e using (word)
"""

ORACLES = {
    "op1_line_dedup": LINES_SQL,
    "op2_near_dup": NEAR_SQL,
    "op4_mixing": MIX_SQL,
    "op9_top_k": SEARCH_SQL,
    "op12_ranked_search": RANK_SQL,
    "op13_spelling": SPELLING_SQL,
}
