"""Quotation linking of messages, as DataFrame and SQL functions only.

Replies quote with ``>`` at the start of lines, a sign more for each level. Runs of lines of one level are passages; the
hash of a normalised quoted passage leads to the message of the conversation that first said it. A message answers
the one its outermost quotes come from, and conversations are put in the order of their replies, without the quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabmill.functions.order import running_totals
from tabmill.session import cut

MARK = r"^(?:[ \t]*>)+"  # quote signs at the start of a line


def normal(text: Column) -> Column:
    """Lower case, white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARK, 0), "[^>]", ""))


def passages(messages: DataFrame) -> DataFrame:
    """Runs of lines of one quote level: ``id, conv_id, turn, run, depth, body, parts``, ``parts`` the hashes of its lines.

    Blank lines belong to the run around them. Only messages that quote are taken apart; the others are one run.
    """
    quoting = F.col("body").rlike("(?m)" + MARK)
    whole = messages.where(~quoting).select("id", "conv_id", "turn", F.lit(0).alias("run"), F.lit(0).alias("depth"), "body")
    lines = messages.where(quoting).select("id", "conv_id", "turn", F.posexplode(F.split("body", "\n")).alias("at", "line")) \
        .withColumn("depth", level(F.col("line"))) \
        .withColumn("line", F.regexp_replace("line", MARK + "[ ]?", ""))
    in_message = Window.partitionBy("id").orderBy("at")
    starts = lines.withColumn("fresh", F.coalesce((F.col("depth") != F.lag("depth").over(in_message)).cast("int"), F.lit(1)))
    runs = starts.withColumn("run", F.sum("fresh").over(in_message.rowsBetween(Window.unboundedPreceding, 0)).cast("int")) \
        .groupBy("id", "conv_id", "turn", "run", "depth") \
        .agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("own")) \
        .select("id", "conv_id", "turn", "run", "depth", F.array_join(F.col("own.line"), "\n").alias("body"))
    return whole.unionByName(runs)


def hashes(body: Column) -> Column:
    """Hash of a normalised passage, and of each of its lines: ``array<struct<hash, whole>>``."""
    def entry(text: Column, whole: bool) -> Column:
        return F.struct(F.md5(text.cast("binary")).alias("hash"), F.lit(whole).alias("whole"))

    lines = F.transform(F.split(body, "\n"), normal)
    own = F.array_distinct(F.filter(lines, lambda x: (x != "") & (x != normal(body))))
    return F.when(normal(body) != "", F.array_append(F.transform(own, lambda x: entry(x, False)), entry(normal(body), True)))


def link(messages: DataFrame) -> DataFrame:
    """Parent of each message by what it quotes: adds ``parent_id, n_quoted, n_linked`` and ``own``, its text without quotes."""
    runs = cut(passages(messages))
    said = runs.where("depth = 0").select("conv_id", "turn", "id", F.explode(hashes(F.col("body"))).alias("e"))
    joined_own = runs.where("depth = 0").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("run", "body"))).alias("r")) \
        .select("id", F.trim(F.array_join(F.filter(F.col("r.body"), lambda x: F.trim(x) != ""), "\n")).alias("own"))
    # a row per thing said in a conversation: a line that all messages hold is still one row
    first = said.groupBy("conv_id", "e.hash").agg(F.min(F.struct("turn", "id")).alias("source"))
    quoted = runs.where("depth > 0").select("conv_id", "turn", "id", "run", "depth", F.explode(hashes(F.col("body"))).alias("e")) \
        .select("conv_id", "turn", "id", "run", "depth", "e.hash", "e.whole")
    met = quoted.join(first, [quoted["conv_id"].eqNullSafe(first["conv_id"]), quoted["hash"] == first["hash"]]) \
        .where(F.col("source.turn") < F.col("turn")) \
        .select(quoted["id"], "run", "depth", "whole", F.col("source.turn").alias("from_turn"), F.col("source.id").alias("from_id"))
    # the outermost level first, then whole passages before single lines, then the latest message
    best = met.groupBy("id").agg(
        F.max(F.struct((-F.col("depth")).alias("d"), "whole", "from_turn", "from_id"))["from_id"].alias("parent_id"),
        F.size(F.collect_set("run")).alias("n_linked"))
    counts = runs.where("depth > 0").groupBy("id").agg(F.count("*").alias("n_quoted"))
    return messages.join(joined_own, "id", "left").join(best, "id", "left").join(counts, "id", "left").select(
        "id", "conv_id", "turn", "role", F.coalesce("own", F.lit("")).alias("own"), "parent_id",
        F.coalesce("n_quoted", F.lit(0)).cast("int").alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).cast("int").alias("n_linked"))


def rooted(linked: DataFrame) -> DataFrame:
    """First message and depth of every thread: ``id, root, depth``, by doubling the steps towards the root."""
    now = cut(linked.select("id", F.coalesce("parent_id", "id").alias("root"), F.col("parent_id").isNotNull().cast("int").alias("depth")))
    while True:
        up = now.select(F.col("id").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        nxt = cut(now.join(up, "root").select("id", F.col("next").alias("root"), (F.col("depth") + F.col("more")).alias("depth")))
        if nxt.agg(F.sum("depth")).first() == now.agg(F.sum("depth")).first():
            return nxt
        now = nxt


def conversations(table: DataFrame) -> DataFrame:
    """Messages in reply order, without quotes: ``conv_id, turn, role, position, depth, parent_turn, n_quoted, n_linked, own``.

    ``position`` counts from 0 within a conversation: threads by the turn they begin with, and in a thread by depth, then turn, so
    that an answer follows what it answers. A quote of nothing said before is kept out of the text and links nothing. A null text is
    empty. Messages without ``conv_id`` form one conversation; a message without a turn comes first. Of rows
    with one turn each has a place of its own, and quotes link the first of them. An empty table gives no rows; other columns are not
    read. A conversation of most rows is counted by many tasks: the order is a range sort.
    """
    messages = cut(table.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"),
        F.monotonically_increasing_id().alias("id")))
    linked = cut(link(messages))
    places = rooted(linked)
    turns = linked.select(F.col("id").alias("of"), F.col("turn").alias("of_turn"))
    named = linked.join(places, "id").join(turns, F.col("root") == F.col("of")).drop("of") \
        .withColumnRenamed("of_turn", "root_turn") \
        .join(turns, F.col("parent_id") == F.col("of"), "left").withColumnRenamed("of_turn", "parent_turn")
    order = ["conv_id", "root_turn", "root", "depth", "turn", "role", "id"]
    counted = running_totals(named.select(*order, "parent_turn", "n_quoted", "n_linked", "own"), order, {"place": F.lit(1)})
    counted = cut(counted)
    begin = counted.groupBy(F.col("conv_id").alias("of")).agg(F.min("place").alias("begin"))
    return counted.join(begin, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "turn", "role", (F.col("place") - F.col("begin")).cast("long").alias("position"), "depth", "parent_turn",
        "n_quoted", "n_linked", "own")
