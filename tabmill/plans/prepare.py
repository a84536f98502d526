"""Queries: cleaning, sampling, splitting and feature building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabmill.functions import hashing
from tabmill.functions.text import PUNCTUATION, plain
from tabmill.functions.order import running_totals
from tabmill.operators import clean, features as feat, split
from tabmill.plans.registry import (query, sql_bucket, sql_cents, sql_digest, sql_in_fraction,
                                    sql_int, table)

# The columns that tell lineitem rows apart; (order, line number) is not a key.
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
# Rare class: a discounted bulk sale.
RARE = "l_quantity * l_discount > 4.0"

_quoted_punctuation = PUNCTUATION.replace("'", "''")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").withColumn("label", F.expr(RARE).cast("int"))


SQL_LINES = f"lines as (select *, cast({RARE} as integer) as label from lineitem)"


# -- cleaning -------------------------------------------------------------------------------

@query("""
select count(*) filter (where l_returnflag = 'R') as matches,
       count(*) filter (where l_returnflag <> 'R') as others from lineitem""")
def equality_filter(spark, sf):
    hit, rest = clean.two_classes(table(spark, sf, "lineitem"), "l_returnflag", "R")
    tag = lambda df, n: df.agg(F.count("*").alias("n")).withColumn("side", F.lit(n))
    both = tag(hit, "matches").unionByName(tag(rest, "others"))
    return both.agg(F.sum(F.when(F.col("side") == "matches", F.col("n"))).alias("matches"),
                    F.sum(F.when(F.col("side") == "others", F.col("n"))).alias("others"))


@query("select c_custkey, cast(c_custkey as varchar) as key_text, c_name, c_mktsegment from customer")
def typed_columns(spark, sf):
    df = table(spark, sf, "customer")
    text = clean.columns_of(df, clean.TEXT)
    keyed = df.withColumn("key_text", F.col("c_custkey"))
    return clean.as_text(keyed, ["key_text"]).select("c_custkey", "key_text", *text)


@query("""
select p_partkey, p_name, p_brand, p_type,
       case when p_type = 'SMALL' then 1.0::double else 0.0::double end as label from part""")
def trim_and_label(spark, sf):
    padded = table(spark, sf, "part").select(
        "p_partkey", *[F.concat(F.lit("  "), c, F.lit(" ")).alias(c) for c in ("p_name", "p_brand", "p_type")])
    return clean.trim_text(clean.binary_label(padded, "p_type", "SMALL"))


@query("""
select n_nationkey, n_name,
       case n_regionkey when 0 then 'Africa' when 1 then 'America' when 2 then 'Asia' end as region
from nation""")
def map_codes(spark, sf):
    named = clean.name_codes(table(spark, sf, "nation"), "n_regionkey",
                             {0: "Africa", 1: "America", 2: "Asia"}, "region")
    return named.select("n_nationkey", "n_name", "region")


@query(f"""
select doc_id, md5(translate(lower(text), '{_quoted_punctuation}', '')) as text_md5,
       cast(length(translate(lower(text), '{_quoted_punctuation}', '')) as bigint) as n_chars
from documents""")
def clean_text(spark, sf):
    text = plain("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text).alias("text_md5"), F.length(text).cast("long").alias("n_chars"))


@query("select event_id, event_type, value from events order by event_id limit 10")
def first_rows(spark, sf):
    return clean.first_rows(table(spark, sf, "events").select("event_id", "event_type", "value"),
                            "event_id", 10)


# -- sampling and splitting -----------------------------------------------------------------

@query(f"""
select o_orderkey, o_totalprice from orders where {sql_in_fraction(0.05, 'o_orderkey', seed='2')}""")
def seeded_sample(spark, sf):
    return split.sample(table(spark, sf, "orders"), 0.05, ["o_orderkey"], fast=False).select("o_orderkey", "o_totalprice")


@query(f"""
with {SQL_LINES},
kept as (select * from lines
         where label = 1 or {sql_in_fraction(0.1, *LINE_KEY, seed='2')}),
codes as (select l_returnflag, dense_rank() over (order by l_returnflag) - 1 as flag_code
          from (select distinct l_returnflag from kept))
select {', '.join(LINE_KEY)}, l_quantity, l_discount, flag_code, label
from kept join codes using (l_returnflag)""")
def fraud_prep(spark, sf):
    kept = split.undersample(lines(spark, sf), "label", 1, 0.1, LINE_KEY, fast=False)
    kept = kept.select(*LINE_KEY, "l_quantity", "l_discount", "l_returnflag", "label")
    return (feat.label_encode(kept, ["l_returnflag"])
            .withColumnRenamed("l_returnflag_code", "flag_code").drop("l_returnflag"))


PART_TEXT = ["p_name", "p_brand", "p_type", "p_size"]


@query(f"""
select split, count(*) as n, cast(sum(p_size) as bigint) as sizes from (
  select *, case {sql_bucket(10, *PART_TEXT)} when 9 then 'TEST' when 8 then 'VALIDATE' else 'TRAIN' end as split
  from part) group by split""")
def split_counts(spark, sf):
    marked = split.content_split(table(spark, sf, "part"), PART_TEXT, fast=False)
    return marked.groupBy("split").agg(F.count("*").alias("n"), F.sum("p_size").alias("sizes"))


@query(f"""
select p_partkey, case {sql_bucket(10, *PART_TEXT)} when 8 then 'EVAL' else 'TRAIN' end as split
from part where {sql_bucket(10, *PART_TEXT)} <> 9""")
def relabel_split(spark, sf):
    marked = split.content_split(table(spark, sf, "part"), PART_TEXT, fast=False).select("p_partkey", "split")
    return clean.relabel(marked, "split", {"VALIDATE": "EVAL", "TRAIN": "TRAIN"})


@query("""
with s as (select o_orderkey, rank() over (order by o_orderdate) - 1 as start, count(*) over () as n from orders)
select o_orderkey, case when start < floor(n * 0.8 + 1e-9) then 'train'
                        when start < floor(n * 0.9 + 1e-9) then 'validate' else 'test' end as split
from s""")
def split_chrono(spark, sf):
    return split.chronological(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "split")


def _ranked(extra: str, body: str, by: str = "") -> str:
    part = f"partition by {by} " if by else ""
    whole = f"partition by {by}" if by else ""
    return f"""
with r as (select *, row_number() over ({part}order by {sql_digest('o_orderkey', seed='2')}) as pos,
                  count(*) over ({whole}) as n from orders)
select o_orderkey, {extra}{body} as split from r"""


@query(_ranked("", "case when pos <= floor(n * 0.8 + 1e-9) then 'train' else 'test' end"))
def split_head_tail(spark, sf):
    return split.head_tail(table(spark, sf, "orders"), ["o_orderkey"]).select("o_orderkey", "split")


@query(_ranked("", "case when pos <= 6400 then 'train' when pos <= 8000 then 'validate' else 'test' end"))
def split_take_skip(spark, sf):
    return split.take_skip(table(spark, sf, "orders"), ["o_orderkey"], 10000).select("o_orderkey", "split")


@query(_ranked("", "case when pos <= 1000 then 'validate' else 'train' end"))
def holdout_fixed(spark, sf):
    return split.holdout(table(spark, sf, "orders"), ["o_orderkey"]).select("o_orderkey", "split")


@query(_ranked("o_orderpriority, ", """case when pos <= floor(n * 0.8 + 1e-9) then 'train'
         when pos <= floor(n * 0.9 + 1e-9) then 'validate' else 'test' end""", by="o_orderpriority"))
def split_stratified(spark, sf):
    return split.stratified(table(spark, sf, "orders"), "o_orderpriority", ["o_orderkey"]).select(
        "o_orderkey", "o_orderpriority", "split")


_spot = sql_int(sql_digest("o_orderkey", seed="2"))


@query(f"""
select o_orderkey, case when {_spot} < {round(0.8 * 2**32)} then 'train'
                        when {_spot} < {round(0.9 * 2**32)} then 'validate' else 'test' end as split
from orders""")
def split_fraction(spark, sf):
    return split.fractions(table(spark, sf, "orders"), ["o_orderkey"], fast=False).select("o_orderkey", "split")


@query(f"""
select o_orderkey, 'train' as part from orders where {sql_in_fraction(0.8, 'o_orderkey', seed='0')}
union all
select o_orderkey, 'test' from orders where not {sql_in_fraction(0.8, 'o_orderkey', seed='0')}""")
def train_complement(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    train = split.sample(orders, 0.8, ["o_orderkey"], seed="0", fast=False).withColumn("part", F.lit("train"))
    return train.unionByName(
        split.complement(orders, 0.8, ["o_orderkey"], seed="0", fast=False).withColumn("part", F.lit("test")))


@query(f"select o_orderkey, cast({sql_bucket(3, 'o_orderkey', seed='2')} as integer) as fold from orders")
def fold_numbers(spark, sf):
    return split.folds(table(spark, sf, "orders"), 3, ["o_orderkey"], fast=False).select("o_orderkey", "fold")


@query(f"""
select event_type, count(*) as n from events where {sql_in_fraction(0.8, 'event_id')} group by event_type""")
def request_sample(spark, sf):
    kept = table(spark, sf, "events").where(hashing.in_fraction(0.8, "event_id"))
    return kept.groupBy("event_type").agg(F.count("*").alias("n"))


@query(f"""
select pos, o_orderkey from (
  select o_orderkey, row_number() over (order by {sql_digest('o_orderkey', seed='2')}) as pos from orders)
where pos <= 20""")
def shuffled_head(spark, sf):
    head = split.shuffled(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"]).limit(20)
    spot = hashing.digest("o_orderkey", seed="2")
    # the twenty rows of the report, numbered
    return head.select(F.row_number().over(Window.orderBy(spot)).cast("long").alias("pos"), "o_orderkey")


@query(f"select o_orderkey, row_number() over (order by {sql_digest('o_orderkey', seed='2')}) as pos from orders")
def shuffled_order(spark, sf):
    """The whole seeded order, numbered in parallel."""
    orders = table(spark, sf, "orders").select("o_orderkey", hashing.digest("o_orderkey", seed="2").alias("spot"))
    return running_totals(orders, ["spot"], {"pos": F.lit(1)}).select("o_orderkey", F.col("pos").cast("long").alias("pos"))


# -- features -------------------------------------------------------------------------------

@query("""
select c_custkey, dense_rank() over (order by c_mktsegment) - 1 as segment_code from customer""")
def label_encode(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return feat.label_encode(df, ["c_mktsegment"]).select(
        "c_custkey", F.col("c_mktsegment_code").alias("segment_code"))


@query("""
select 'c_mktsegment' as "column", v as value, row_number() over (order by v) - 1 as code
from (select distinct c_mktsegment as v from customer)
union all
select 'c_name', v, row_number() over (order by v) - 1 from (select distinct c_name as v from customer)""")
def label_codes(spark, sf):
    return feat.label_codes(table(spark, sf, "customer"), ["c_mktsegment", "c_name"])


PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("select p_partkey, " + ", ".join(
    f"""cast(p_type = '{t}' as integer) as "{t}" """ for t in PART_TYPES) + " from part")
def one_hot(spark, sf):
    return feat.one_hot(table(spark, sf, "part").select("p_partkey", "p_type"), ["p_type"],
                        values={"p_type": PART_TYPES})


@query(f"""
with t as (select *, {sql_in_fraction(0.5, 'c_custkey', seed='2')} as train from customer),
v as (select c_nationkey, 1 + row_number() over (order by count(*) desc, cast(c_nationkey as varchar)) as slot
      from t where train group by c_nationkey)
select c_custkey, coalesce(slot, 1) as slot from t left join v using (c_nationkey)""")
def vocabulary_slots(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    train = split.sample(df, 0.5, ["c_custkey"], fast=False)
    vocab = feat.vocabulary(train, ["nation"])
    return feat.vocabulary_encode(df, "nation", vocab, "slot").select("c_custkey", "slot")


@query(f"""
with t as (select *, {sql_in_fraction(0.5, 'c_custkey', seed='2')} as train from customer),
v as (select c_nationkey, 1 + row_number() over (order by count(*) desc, cast(c_nationkey as varchar)) as slot
      from t where train group by c_nationkey),
z as (select max(slot) + 1 as size from v)
select c_custkey, repeat('0', coalesce(slot, 1)) || '1' || repeat('0', size - coalesce(slot, 1) - 1) as bits
from t cross join z left join v using (c_nationkey)""")
def vocabulary_vector(spark, sf):
    """Binary encoding: as many 0/1 entries as values, and two more for masked and unseen ones."""
    df = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    vocab = feat.vocabulary(split.sample(df, 0.5, ["c_custkey"], fast=False), ["nation"])
    size = vocab.agg(F.max("size")).first()[0]
    slots = feat.vocabulary_encode(df, "nation", vocab, "slot")
    bits = feat.slot_vector(F.array(F.col("slot").cast("int")), size)
    return slots.select("c_custkey", F.array_join(bits.cast("array<string>"), "").alias("bits"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("select c_custkey, " + ", ".join(f"cast(c_mktsegment = '{v}' as integer) as \"{v}\"" for v in SEGMENTS) + " from customer")
def one_hot_found(spark, sf):
    """A column per value, the values found in the data."""
    return feat.one_hot(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


_train_orders = sql_in_fraction(0.8, "o_orderkey", seed="2")


@query(f"""
with s as (select avg(o_totalprice) as m, stddev_pop(o_totalprice) as d from orders where {_train_orders})
select o_orderkey, round(greatest(-1.5, least(1.5, (o_totalprice - m) / d)), 6) + 0.0 as z from orders, s""")
def standardize_clip(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    train = split.sample(orders, 0.8, ["o_orderkey"], fast=False)
    scaled = feat.standardize(orders, ["o_totalprice"], train)
    return scaled.select("o_orderkey", F.round(clean.clip("o_totalprice", -1.5, 1.5), 6).alias("z"))


@query("""
with s as (select avg(p_size) as ms, stddev_samp(p_size) as ds, avg(p_retailprice) as mp, stddev_samp(p_retailprice) as dp,
                  avg(cast(p_type = 'SMALL' as integer)) as mt, stddev_samp(cast(p_type = 'SMALL' as integer)) as dt from part)
select p_partkey, round((p_size - ms) / ds, 6) + 0.0 as size_z, round((p_retailprice - mp) / dp, 6) + 0.0 as price_z,
       round((cast(p_type = 'SMALL' as integer) - mt) / dt, 6) + 0.0 as small_z from part, s""")
def standardize_sample(spark, sf):
    hot = feat.one_hot(table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type"),
                       ["p_type"], values={"p_type": ["SMALL"]})
    scaled = feat.standardize(hot, ["p_size", "p_retailprice", "SMALL"], deviation="sample")
    return scaled.select("p_partkey", F.round("p_size", 6).alias("size_z"),
                         F.round("p_retailprice", 6).alias("price_z"), F.round("SMALL", 6).alias("small_z"))


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("with s as (select " + ", ".join(
    f"avg({c}) as m_{c}, stddev_pop({c}) as d_{c}" for c in NUMBERS) + " from lineitem) select l_returnflag, count(*) as n, " + ", ".join(
    f"round(sum(case when ({c} - m_{c}) / d_{c} > 1 then 1 else 0 end) * 1.0 / count(*), 6) as high_{c}" for c in NUMBERS)
    + " from lineitem, s group by l_returnflag")
def normalize_all(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", *NUMBERS)
    z = feat.standardize(df, NUMBERS)
    return z.groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        *[F.round(F.count_if(F.col(c) > 1) / F.count("*"), 6).alias(f"high_{c}") for c in NUMBERS])


@query("""
select doc_id, w as term, count(*) as n
from (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) as w from documents)
group by doc_id, w""")
def term_counts(spark, sf):
    return feat.term_counts(table(spark, sf, "documents"), "doc_id", "text")


SQL_TFIDF = """
c as (select doc_id, w as term, count(*) as n
      from (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) as w from documents)
      group by doc_id, w),
i as (select term, ln((1 + (select count(*) from documents)) / (1 + count(*))) + 1 as idf from c group by term),
w as (select doc_id, term, n * idf as w from c join i using (term)),
t as (select doc_id, term, w / sqrt(sum(w * w) over (partition by doc_id)) as weight from w)"""


@query(f"with {SQL_TFIDF} select doc_id, term, round(weight, 6) as weight from t")
def tfidf(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counts = feat.term_counts(docs, "doc_id", "text")
    idf = feat.inverse_frequency(docs, "text")
    return feat.tfidf(counts, idf, "doc_id").withColumn("weight", F.round("weight", 6))


@query("""
with w as (select quality, count(*) as n, round(1.0 / count(*), 9) as weight from labels group by quality)
select doc_id, quality, weight, case quality when 0 then 1.0::double when 1 then 100.0::double end as given
from labels join w using (quality)""")
def class_weights(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    # one row per class
    own = F.broadcast(feat.class_weights(labels, "quality"))
    rows = labels.join(own, "quality").withColumn("weight", F.round("weight", 9)).drop("n")
    return feat.with_weights(rows, "quality", {0: 1.0, 1: 100.0}, "given")


def daily_prices(spark, sf):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return table(spark, sf, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(
        F.sum(cents).alias("rate_est"), F.max(cents).alias("rate_high"), F.min(cents).alias("rate_low"))


SERIES = ["rate_est", "rate_high", "rate_low"]
_cents = sql_cents("l_extendedprice")


@query(f"""
with d as (select l_suppkey, cast(l_shipdate as date) as day, cast(sum({_cents}) as bigint) as rate_est,
                  max({_cents}) as rate_high, min({_cents}) as rate_low from lineitem group by 1, 2)
select l_suppkey, strftime(day, '%Y-%m-%d') as day, """ + ", ".join(
    f"lag({c}, {k}) over w as {c}_lag{k}" for c in SERIES for k in range(1, 15)) + """
from d window w as (partition by l_suppkey order by day)""")
def lags(spark, sf):
    lagged = feat.lags(daily_prices(spark, sf), "l_suppkey", "day", SERIES, 14)
    return lagged.drop(*SERIES).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("""
select o_orderkey, cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as integer) as date_epoch,
       cast(day(o_orderdate) as integer) as day, cast(dayofweek(o_orderdate) + 1 as integer) as day_of_week,
       cast(dayofyear(o_orderdate) as integer) as day_of_year, cast(month(o_orderdate) as integer) as month,
       cast(quarter(o_orderdate) as integer) as quarter from orders""")
def calendar(spark, sf):
    return feat.calendar(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop(
        "o_orderdate")


MI_EDGES = {"l_quantity": [10.0, 20.0, 30.0, 40.0], "l_discount": [0.025, 0.045, 0.065, 0.085],
            "l_tax": [0.02, 0.04, 0.06], "l_extendedprice": [20000.0, 40000.0, 60000.0, 80000.0]}


def _sql_bin(col: str, edges: list[float]) -> str:
    return "(" + " + ".join(f"cast({col} >= {e} as integer)" for e in edges) + ")"


def _sql_information(stack: str, top: int) -> str:
    """Adjusted mutual information of ``s``, rows (feature, bin, label), with log-factorials in place of ratios."""
    return f"""
{stack},
cell as (select feature, bin, label, count(*) as n from s group by all),
g as (select *, sum(n) over (partition by feature, bin) as nx, sum(n) over (partition by feature, label) as ny,
             sum(n) over (partition by feature) as t from cell),
m as (select feature, sum(n / t * ln(n * t / (nx * ny))) as mi,
             sum(-(n / t) * ln(nx / t)) as hx, sum(-(n / t) * ln(ny / t)) as hy from g group by feature),
x as (select feature, bin, sum(n)::bigint as a from cell group by all),
y as (select feature, label, sum(n)::bigint as b from cell group by all),
w as (select feature, sum(a)::bigint as t from x group by all),
k as (select feature, a, b, t, unnest(range(greatest(1, a + b - t), least(a, b) + 1)) as k from x join y using (feature) join w using (feature)),
e as (select feature, sum(k / t * ln(t * k / (a * b)) * exp(
        lgamma(a + 1) + lgamma(b + 1) + lgamma(t - a + 1) + lgamma(t - b + 1) - lgamma(t + 1) - lgamma(k + 1)
        - lgamma(a - k + 1) - lgamma(b - k + 1) - lgamma(t - a - b + k + 1))) as chance from k group by feature)
select feature, round(mi, 9) as mi, round((mi - chance) / ((hx + hy) / 2 - chance), 6) as ami
from m join e using (feature) order by (mi - chance) / ((hx + hy) / 2 - chance) desc limit {top}"""


_stack = " union all ".join(
    f"select '{c}' as feature, {_sql_bin(c, e)} as bin, label from lines" for c, e in MI_EDGES.items())


@query(_sql_information(f"with {SQL_LINES}, s as ({_stack})", 10))
def mi_top10(spark, sf):
    top = feat.mutual_information(lines(spark, sf), "label", MI_EDGES, 10)
    return top.select("feature", F.round("mi", 9).alias("mi"), F.round("ami", 6).alias("ami"))


# Features of a line by name: an expression of Spark and one of the other engine.
MI_FEATURES = {c: (c, c) for c in ("l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_linenumber", "l_orderkey",
                                   "l_partkey", "l_suppkey")}
MI_FEATURES |= {"ship_day": ("day(l_shipdate)", "day(l_shipdate)"), "ship_month": ("month(l_shipdate)", "month(l_shipdate)"),
                "ship_weekday": ("dayofweek(l_shipdate)", "dayofweek(l_shipdate) + 1"), "ship_year": ("year(l_shipdate)", "year(l_shipdate)")}

_found_stack = f"""with {SQL_LINES},
v as ({" union all ".join(f"select '{c}' as feature, cast({e} as double) as v, label from lines" for c, (_, e) in MI_FEATURES.items())}),
r as (select feature, v, row_number() over (partition by feature order by v) - 1 as place, count(*) over (partition by feature) as n
      from v where v is not null),
h as (select feature, list(distinct v) as edges from r where exists (select 1 from range(1, 10) as i(i) where place = n * i // 10) group by feature),
s as (select feature, case when v is null then -1 else len(list_filter(edges, lambda x: x <= v)) end as bin, label from v join h using (feature))"""


@query(_sql_information(_found_stack, 10))
def ami_found_edges(spark, sf):
    """The ten best of twelve features, cut into ten bins at exact quantiles."""
    df = lines(spark, sf).select("label", *[F.expr(e).cast("double").alias(c) for c, (e, _) in MI_FEATURES.items()])
    top = feat.mutual_information(df, "label", feat.exact_edges(df, list(MI_FEATURES)), 10)
    return top.select("feature", F.round("mi", 9).alias("mi"), F.round("ami", 6).alias("ami"))
