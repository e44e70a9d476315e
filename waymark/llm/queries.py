"""Registered queries of the text operators: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from waymark.llm import (
    bpe_lexicon,
    credentials,
    disclosure,
    four_russians,
    hidden_markov,
    host_suffixes,
    line_rules,
    periodic_runs,
    seed_align,
    signature_tree,
    suffix_buckets,
    toxic_cnn,
    url_trees,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.find_spans(_table(spark, sf_dir, "documents"))
    return disclosure.digests(found)


def op2_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_tree.components(_table(spark, sf_dir, "documents"), size=4, percent=85)


def op3_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_lexicon.digests(bpe_lexicon.encode(_table(spark, sf_dir, "documents")))


def op4_toxic_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxic_cnn.classify(documents, labels)


def op5_seed_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return seed_align.find_passages(documents, benchmark)


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.apply_rules(_table(spark, sf_dir, "documents")).drop("cleaned")


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score(_table(spark, sf_dir, "documents"))


def op8_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.find_secrets(_table(spark, sf_dir, "documents"))
    return credentials.digests(found)


def op9_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(_table(spark, sf_dir, "pages"))


def op10_host_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_suffixes.main_text(_table(spark, sf_dir, "pages"))


def op11_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return four_russians.mine(_table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return periodic_runs.digests(
        periodic_runs.find_runs(documents, periodic_runs.planted_order)
    )


def op13_suffix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_buckets.digests(
        suffix_buckets.without_repeats(_table(spark, sf_dir, "documents"))
    )


def queries() -> dict[str, Query]:
    found = [
        op1_disclosure,
        op2_signature_tree,
        op3_bpe_lexicon,
        op4_toxic_cnn,
        op5_seed_align,
        op6_line_rules,
        op7_hidden_markov,
        op8_credentials,
        op9_url_trees,
        op10_host_suffixes,
        op11_four_russians,
        op12_periodic_runs,
        op13_suffix_buckets,
    ]
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}


# Components of documents by 4-word shingles, from all pairs that share one.
_COMPONENTS = r"""
with recursive texts as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') as words
  from documents),
sets as (
  select doc_id, case when len(words) = 0 then [] else list_sort(list_distinct(list_transform(
    range(1, greatest(len(words) - 3, 1) + 1),
    lambda i: array_to_string(words[i:i + 3], ' ')))) end as shingles
  from texts),
nodes as (
  select row_number() over () as node, shingles, len(shingles) as n, min(doc_id) as smallest
  from sets where len(shingles) > 0 group by shingles),
tokens as (select node, n, unnest(shingles) as token from nodes),
links as (
  select a.node as node, b.node as other from tokens a join tokens b
  on a.token = b.token and a.node <> b.node
  where 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n
  group by a.node, b.node, a.n, b.n
  having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach as (
  select node, node as other from nodes
  union select r.node, l.other from reach r join links l on r.other = l.node),
labels as (
  select r.node, min(o.smallest) as component_id
  from reach r join nodes o on r.other = o.node group by r.node)
select s.doc_id, len(s.shingles) as n_shingles,
  case when len(s.shingles) = 0 then s.doc_id else l.component_id end as component_id
from sets s left join nodes n on s.shingles = n.shingles left join labels l on l.node = n.node
"""

# Positives and negatives of every anchor, from all scores.
_HARD_NEGATIVES = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as parts
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, o.vec_id, a.label = o.label as same,
    list_dot_product(a.parts, o.parts)::bigint as score
  from rows a join rows o on a.vec_id % 50 = 0 and a.vec_id <> o.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
ranked as (
  select p.*, vec_id as negative_id, score as negative_score, row_number() over (
    partition by p.anchor_id, positive_id order by score desc, vec_id) as rank
  from positives p join scores s on p.anchor_id = s.anchor_id and not same
    and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from ranked where rank <= 3
"""

# Runs from all pairs of equal words at a distance of at most half the text.
# The checksum (crc32) goes through the digits of the id bit by bit.
_PERIODIC_RUNS = r"""
with texts as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') as words,
    xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
      string_split(doc_id::varchar, ''),
      lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, e: case when e >= 0 then xor(c, e) else xor(c >> 1, 3988292384 * (c & 1)) end
    )) as h
  from documents),
shapes as (
  select doc_id, words, len(words) as n, h % 10 = 0 and len(words) > 0 as moved, h // 10 as g,
    case when len(words) > 0 then (h // 10) % len(words) end as a from texts),
places as (
  select doc_id, n, words, i, case when moved and i >= a
    then a + (i - a) % (1 + (n - a) // (3 + g % 8)) else i end as origin
  from (select *, unnest(range(n)) as i from shapes)),
tokens as (select doc_id, n, i, words[origin + 1] as word from places),
equal as (
  select a.doc_id, b.i - a.i as q, a.i as i
  from tokens a join tokens b on a.doc_id = b.doc_id and a.word = b.word and a.i < b.i
  where 2 * (b.i - a.i) <= a.n),
islands as (
  select doc_id, q, min(i) as start, count(*) + q as length
  from (select *, i - row_number() over (partition by doc_id, q order by i) as island from equal)
  group by doc_id, q, island having count(*) + q >= greatest(12, 2 * q)),
runs as (select doc_id, start, length, min(q) as period from islands group by doc_id, start, length),
listed as (
  select doc_id, count(*) as n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines,
    min({'l': -length, 's': start, 'p': period}) as best
  from runs group by doc_id),
dropped as (
  select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
kept as (
  select doc_id, string_agg(word, ' ' order by i) as text
  from tokens anti join dropped using (doc_id, i) group by doc_id)
select t.doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, -best.l as length,
  best.p as period, 1000 * -best.l // best.p as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from texts t left join listed using (doc_id) left join kept k using (doc_id)
"""

# Every string of 100 bytes, as hexadecimal text, and where it comes first.
_REPEATED_BYTES = """
with texts as (
  select row_number() over () as row, doc_id, hex(encode(coalesce(text, ''))) as hex from documents),
strings as (
  select row, doc_id, start, substring(hex, 2 * start + 1, 200) as string
  from (select row, doc_id, hex, unnest(range(len(hex) // 2 - 99)) as start from texts)),
hits as (
  select row, start from (
    select row, start, doc_id, first_value({'d': doc_id, 's': start}) over (
      partition by md5(string) order by doc_id, start) as head from strings)
  where head.d <> doc_id or head.s <> start),
marked as (
  select row, start, start > 100 + lag(start, 1, -1000) over (partition by row order by start) as opens
  from hits),
runs as (
  select row, min(start) as low, max(start) + 100 as high
  from (select row, start, sum(opens::int) over (partition by row order by start) as run from marked)
  group by row, run),
pieces as (
  select t.row, coalesce(r.low, len(hex) // 2) as low,
    coalesce(lag(r.high) over w, 0) as begin, r.low is null as rest
  from texts t join (select * from runs union all select row, null, null from texts) r using (row)
  window w as (partition by t.row order by r.low nulls last)),
kept as (
  select p.row, string_agg(substring(hex, 2 * begin + 1, 2 * (low - begin)), '' order by low, begin) as hex
  from pieces p join texts t using (row) group by p.row),
counts as (select row, count(*) as spans, sum(high - low) as bytes from runs group by row)
select doc_id, len(t.hex) // 2 as n_bytes, coalesce(bytes, 0)::bigint as n_removed,
  coalesce(spans, 0) as n_spans, sha256(unhex(k.hex)) as kept_sha256
from texts t join kept k using (row) left join counts using (row)
"""


def oracle_sql() -> dict[str, str]:
    """Statements for DuckDB; the other queries train, align or merge, and are
    tested against brute force, the library or held-out rows."""
    return {
        "op2_signature_tree": _COMPONENTS,
        "op11_four_russians": _HARD_NEGATIVES,
        "op12_periodic_runs": _PERIODIC_RUNS,
        "op13_suffix_buckets": _REPEATED_BYTES,
    }
