"""Queries: files written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tabmill.operators import score, split
from tabmill.plans.prepare import PART_TEXT
from tabmill.plans.registry import query, sql_bucket, sql_cents, table
from tabmill.session import fresh_path
from tabmill.sources import files, instances, messages


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


@query("select * replace (strftime(o_orderdate, '%Y-%m-%d') as o_orderdate) from orders")
def csv_round_trip(spark, sf):
    path = fresh_path(spark, "csv")
    orders = table(spark, sf, "orders")
    orders.write.option("header", True).csv(path)
    back = spark.read.schema(orders.schema).option("header", True).csv(path)
    return back.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(f"""
select p_type, count(*) as n, cast(sum({sql_cents('p_retailprice')}) as bigint) as cents, cast(sum(p_size) as bigint) as sizes
from part group by p_type""")
def decimal_load(spark, sf):
    """CSV into a table of declared decimals, replacing what is there."""
    root = fresh_path(spark, "decimals")
    table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_retailprice").write.option("header", True).csv(
        root + "/csv")
    name = "part_" + root.rsplit("-", 1)[1]
    for _ in range(2):  # the second load replaces the first
        files.load_csv_table(spark, root + "/csv", _schema(
            "p_partkey bigint, p_type string, p_size decimal(38,9), p_retailprice decimal(38,9)"), name, root + "/table")
    return spark.read.table(name).groupBy("p_type").agg(
        F.count("*").alias("n"), F.sum(F.col("p_retailprice") * 100).cast("long").alias("cents"),
        F.sum("p_size").cast("long").alias("sizes"))


@query("""
select p_partkey, case when p_size % 7 = 0 then null else p_size end as size, cast(p_partkey * 2 as double) as double_key
from part""")
def spaced_text(spark, sf):
    """Fields padded by runs of spaces, ``?`` for null, a comment after a tab."""
    path = fresh_path(spark, "spaced")
    size = F.when(F.col("p_size") % 7 == 0, "?").otherwise(F.col("p_size").cast("string"))
    line = F.concat(F.lit(" "), F.lpad(F.col("p_partkey").cast("string"), 12, " "), F.lit("   "), size, F.lit(" "),
                    (F.col("p_partkey") * 2).cast("string"), F.lit(".\t"), F.col("p_name"))
    table(spark, sf, "part").select(line.alias("value")).write.text(path)
    return files.read_spaced(spark, path, _schema("p_partkey bigint, size int, double_key double"))


@query("""
select doc_id, md5(trim(regexp_replace(text, '[\\t\\r\\n]+', ' ', 'g'), ' ')) as text_md5, lang from documents""")
def tsv_documents(spark, sf):
    path = fresh_path(spark, "tsv")
    one_line = F.trim(F.regexp_replace("text", r"[\t\r\n]+", " "))
    table(spark, sf, "documents").select("doc_id", one_line.alias("text"), "lang").write.option("sep", "\t").option(
        "quote", "").option("escape", "").option("emptyValue", "").csv(path)
    back = files.read_tsv(spark, path, _schema("doc_id bigint, text string, lang string"), quote="")
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "lang")


@query("""
select l_linestatus, count(*) as n, sum(cast(l_quantity as bigint))::bigint as quantity from lineitem
where l_quantity > 25 group by l_linestatus""")
def column_scan(spark, sf):
    """Two columns and a filter of a wide table: both reach the scan."""
    df = table(spark, sf, "lineitem").where("l_quantity > 25").select("l_linestatus", F.col("l_quantity").cast("long").alias("q"))
    return df.groupBy("l_linestatus").agg(F.count("*").alias("n"), F.sum("q").alias("quantity"))


@query("""
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, user_id, event_type, value,
  case when value > 10 then null else props end as props from events""")
def jsonl_round_trip(spark, sf):
    """JSON lines with nulls written out."""
    path = fresh_path(spark, "jsonl")
    props = F.when(F.col("value") > 10, F.lit(None)).otherwise(F.col("props"))
    events = table(spark, sf, "events").withColumn("props", props)
    form = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    events.write.option("ignoreNullFields", False).options(timestampFormat=form, timestampNTZFormat=form).json(path)
    back = spark.read.schema(events.schema).options(timestampFormat=form, timestampNTZFormat=form).json(path)
    return back.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("select doc_id, quality from labels")
def label_file(spark, sf):
    path = fresh_path(spark, "labels")
    files.write_labels(table(spark, sf, "labels"), ["doc_id"], "quality", path)
    return spark.read.schema("doc_id bigint, quality int").option("header", True).csv(path)


@query(f"select p_partkey, p_name from part where {sql_bucket(10, *PART_TEXT)} = 9")
def split_folders(spark, sf):
    """One folder per part; reading TEST opens only its folder."""
    path = fresh_path(spark, "split")
    split.write_splits(split.content_split(table(spark, sf, "part"), PART_TEXT, fast=False), path)
    test = split.given_split(spark.read.parquet(path), "split", ["TRAIN", "VALIDATE", "TEST"])["TEST"]
    return test.select("p_partkey", "p_name")


@query("select * from customer")
def saved_dataset(spark, sf):
    path = fresh_path(spark, "prepared")
    table(spark, sf, "customer").write.parquet(path)
    return spark.read.parquet(path)


@query("select s_nationkey, count(*) as n from supplier group by s_nationkey")
def table_scan(spark, sf):
    """A catalog table, written once under a new name."""
    path = fresh_path(spark, "catalog")
    name = "supplier_" + path.rsplit("-", 1)[1]
    table(spark, sf, "supplier").write.mode("errorifexists").option("path", path).saveAsTable(name)
    return spark.read.table(name).groupBy("s_nationkey").agg(F.count("*").alias("n"))


# -- instances ------------------------------------------------------------------------------------
# Every order becomes a line in one of 14 shapes, chosen by its key.

FIELDS = ["order", "customer", "cents"]
POSITIONS = ["order", "cents", "customer"]


def instance_lines(spark, sf):
    o, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    p = F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    c1 = (F.col("o_custkey") + 1).cast("string")

    def text(template: str):
        """Template with <o>, <c>, <d> (customer + 1) and <p> filled in."""
        out, values = F.lit(template), {"<o>": o, "<c>": c, "<d>": c1, "<p>": p}
        for mark, value in values.items():
            out = F.replace(out, F.lit(mark), value)
        return out

    shapes = [
        '{"order": <o>, "customer": <c>, "cents": <p>}',
        "{'order': <o>, 'customer': <c>, 'cents': <p>}",
        '{"order": "<o>", "customer": "<c>", "cents": "<p>"}',
        '{"dense_input": [<o>, <p>, <c>]}',
        '{"instances": [<o>, <p>, <c>]}',
        '[[<o>, <p>, <c>], [<o>, <p>, <d>]]',
        '{"order": [<o>, <o>], "customer": [<c>, <d>], "cents": [<p>, <p>]}',
        '[{"order": <o>, "customer": <c>, "cents": <p>},',
        ' {"order": <o>, "customer": <c>, "cents": <p>}]',
        '[{"order": <o>, "customer": <c>, "cents": <p>}, {"order": <o>, "customer": <d>, "cents": <p>}]',
        '"error": "Matrix size-incompatible: <o>"',
        '{"dense_input": [<o>, <p>]}',
        '{"order": <o>, "customer": "unknown", "cents": <p>}',
        '   ',
    ]
    chain = None
    for i, shape in enumerate(shapes):
        hit = F.col("o_orderkey") % len(shapes) == i
        chain = F.when(hit, text(shape)) if chain is None else chain.when(hit, text(shape))
    return table(spark, sf, "orders").select("o_orderkey", chain.alias("value"))


@query(f"""
with o as (select o_orderkey, o_custkey, {sql_cents('o_totalprice')} as cents, o_orderkey % 14 as shape from orders)
select o_orderkey, cast(o_orderkey as double) as "order", cast(o_custkey as double) as customer, cast(cents as double) as cents
from o where shape < 10
union all select o_orderkey, o_orderkey, o_custkey + 1, cents from o where shape in (5, 6, 9)""")
def instances_parsed(spark, sf):
    return instances.parse_instances(instance_lines(spark, sf), FIELDS, POSITIONS, keep=["o_orderkey"])[0]


@query("""
select o_orderkey, case o_orderkey % 14 when 10 then 'not an instance' when 11 then 'wrong length' else 'not a number' end as reason
from orders where o_orderkey % 14 in (10, 11, 12)""")
def instances_dead_letter(spark, sf):
    bad = instances.parse_instances(instance_lines(spark, sf), FIELDS, POSITIONS, keep=["o_orderkey"])[1]
    return bad.drop("value")


@query("""
select c_custkey, case when c_nationkey % 5 = 0 then 'balance' else '' end as faults from customer""")
def coerced_instances(spark, sf):
    """Numbers sent as text; what is no number is named."""
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 5 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.col("c_nationkey").cast("string").alias("nation"))
    good, bad = score.coerce_numbers(rows, ["balance", "nation"])
    return good.select("c_custkey", F.lit("").alias("faults")).unionByName(
        bad.select("c_custkey", F.concat_ws(",", "faults").alias("faults")))


@query("""
select event_id, case when event_id % 7 = 0 then null else cast(json_extract_string(props, '$.k') as integer) end as k,
       event_id % 7 <> 0 as valid from events""")
def messages_decoded(spark, sf):
    payload = F.when(F.col("event_id") % 7 == 0, F.lit("%%%")).otherwise(F.base64(F.encode("props", "UTF-8")))
    sent = table(spark, sf, "events").select("event_id", payload.alias("data"))
    return messages.decode_messages(sent, _schema("k int"))
