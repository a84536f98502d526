"""The registered queries of the text operators, with their SQL where SQL can say it."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabmill.llm import (compression, credentials, langid, leaks, mixing, periodic, quotes, repeats, setjoin, shards,
                         tokenfile, turntrie, unigram)
from tabmill.llm.common import table
from tabmill.session import cut

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query()
def op1_language_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identified(table(spark, sf, "documents"))


@query()
def op2_compression_bands(spark: SparkSession, sf: str) -> DataFrame:
    return compression.rules(table(spark, sf, "documents"))


@query()
def op3_universe_partition(spark: SparkSession, sf: str) -> DataFrame:
    return setjoin.linked(table(spark, sf, "documents"))


@query()
def op4_quotation_links(spark: SparkSession, sf: str) -> DataFrame:
    return quotes.conversations(table(spark, sf, "conversations"))


@query()
def op5_grammar_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return credentials.scan(table(spark, sf, "documents"))


def unigram_vocabulary(name: str = "piece_bpe_32k.model") -> unigram.Vocabulary:
    """Pieces and scores of a public vocabulary."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    return tuple((pieces.id_to_piece(i), pieces.get_score(i)) for i in range(pieces.get_piece_size()))


@query()
def op6_viterbi_counts(spark: SparkSession, sf: str) -> DataFrame:
    return unigram.token_counts(table(spark, sf, "documents"), unigram_vocabulary())


@query()
def op7_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


OP8_SQL = """
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents),
i as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from benchmark),
p as (
  select distinct item, least(len(ws), 10) as k, array_to_string(ws[s:s + least(len(ws), 10) - 1], ' ') as gram
  from i, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as r(s) where len(ws) > 0),
d as (
  select doc_id, k, s, array_to_string(ws[s:s + k - 1], ' ') as gram
  from w, (select distinct k from p), unnest(range(1, len(ws) + 1)) as r(s) where s + k - 1 <= len(ws)),
m as (select doc_id, item, s, d.k from d join p on d.k = p.k and d.gram = p.gram),
h as (select doc_id, count(distinct q) as n_hit from m, unnest(range(s, s + k)) as r(q) group by doc_id),
t as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
      from (select distinct doc_id, item from m) group by doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, n_hit is not null as contaminated
from w left join h using (doc_id) left join t using (doc_id)
"""


@query(OP8_SQL)
def op8_positional_index(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("n_near")


@query()
def op8_near_hits(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of ``op8_positional_index``, and ``n_near``: items met only with a word put in, left out or moved."""
    return leaks.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), slop=leaks.SLOP, missing=leaks.MISSING)


def tokenizer_spec(name: str = "word_bpe_49k.json") -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@query()
def op9_huffman_file(spark: SparkSession, sf: str) -> DataFrame:
    return tokenfile.encoded_documents(table(spark, sf, "documents"), tokenizer_spec())


@query()
def op10_jump_shards(spark: SparkSession, sf: str) -> DataFrame:
    return shards.place(table(spark, sf, "documents"), 24)


def replayed(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with which op13 is asked: those of one document in ten repeat from some word on, as its id says."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or n == 0 or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query()
def op13_minimizer_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.runs(table(spark, sf, "documents"), replayed)
    top = F.reduce("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def rebuilt(seqs: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """Sequences as op12 asks for them: the first turns, fewer than ``most``, come from the first conversation of the block."""
    width = turntrie.WIDTH
    heads = seqs.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.substring("key", 1, width * most).alias("head"), F.slice("words", 1, most).alias("head_words"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = seqs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % block).join(heads, "base", "left")
    return own.select(
        "conv_id", F.concat(F.coalesce(F.col("head").substr(F.lit(1), F.col("h") * width), F.lit(b"")),
                            F.col("key").substr(F.col("h") * width + 1, F.octet_length("key"))).alias("key"),
        F.concat(F.coalesce(F.expr("slice(head_words, 1, h)"), F.expr("slice(words, 1, 0)")),
                 F.expr("slice(words, h + 1, size(words))")).alias("words"))


OP12_SQL = """
with t as (
  select conv_id, coalesce(role, '') as r, coalesce(text, '') as x, row_number() over (
    partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p
  from conversations where conv_id is not null),
c as (
  select distinct conv_id, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(conv_id::varchar, ''),
    lambda ch: [ascii(ch) + 256, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, b: case when b >= 0 then xor(a, b - 256)
    when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295) % 4 as h from t),
b as (
  select c.conv_id, t.p, t.r, t.x from c join t on t.conv_id = c.conv_id - c.conv_id % 20 and t.p <= c.h
  union all select c.conv_id, t.p, t.r, t.x from c join t on t.conv_id = c.conv_id and t.p > c.h),
s as (
  select conv_id, row_number() over w as d, string_agg(sha256(length(r) || ':' || r || x), '') over w as k,
    len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) as words
  from b window w as (partition by conv_id order by p rows unbounded preceding)
  union all select conv_id, 0, '', 0 from c),
e as (select k, string_agg(conv_id::varchar, ',' order by conv_id) as ids
      from (select conv_id, max_by(k, d) as k from s group by conv_id) group by k),
n as (select k, d, min(conv_id) as conv_id, count(*) as n, min(words) as words from s group by k, d),
m as (select n.*, n.k[1:64 * (d - 1)] as up, not exists (select 1 from n as o where o.d = n.d + 1 and o.k[1:64 * n.d] = n.k) as leaf from n),
u as (select k[1:64 * j] as k, sum(leaf::int) as n_leaves, sum((n - 1) * words) as saved
      from m, unnest(range(0, d + 1)) as r(j) group by 1),
g as (select up, count(*) as kids from m where d > 0 group by up)
select m.conv_id, m.d as depth, p.conv_id as parent_conv_id, m.n as n_convs, coalesce(kids, 0) as n_children,
  n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from m left join n as p on m.d > 0 and p.k = m.up left join g on g.up = m.k join u on u.k = m.k left join e on e.k = m.k
"""


@query(OP12_SQL)
def op12_radix_trie(spark: SparkSession, sf: str) -> DataFrame:
    seqs = cut(turntrie.sequences(table(spark, sf, "conversations")))
    return turntrie.nodes(rebuilt(seqs))


@query()
def op11_run_index(spark: SparkSession, sf: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf, "documents"))
    removed = F.reduce("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
