"""Queries: metrics, gates, scoring and the flagship flow."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tabmill.operators import clean, evaluate, features as feat, score, split
from tabmill.operators.train import regression_line
from tabmill.plans.prepare import LINE_KEY, SQL_LINES, lines
from tabmill.plans.registry import query, sql_bucket, sql_cents, sql_in_fraction, table
from tabmill.sources.files import read_predictions
from tabmill.session import fresh_path

# -- the flagship flow ------------------------------------------------------------------------

_content = [*LINE_KEY, sql_cents("l_extendedprice")]
_content_cols = [*LINE_KEY, "l_extendedprice"]


@query(f"""
with {SQL_LINES},
kept as (select *, case {sql_bucket(10, *_content)} when 9 then 'TEST' when 8 then 'VALIDATE' else 'TRAIN' end as split
         from lines where label = 1 or {sql_in_fraction(0.1, *LINE_KEY, seed='2')}),
s as (select avg(l_quantity) as mq, stddev_pop(l_quantity) as dq, avg(l_discount) as md, stddev_pop(l_discount) as dd
      from kept where split = 'TRAIN'),
p as (select split, label, case when greatest(-5, least(5, (l_quantity - mq) / dq))
                                   + greatest(-5, least(5, (l_discount - md) / dd)) > 1.5 then 1 else 0 end as predicted
      from kept, s),
g as (select split, truth, predicted from (values ('TRAIN'), ('VALIDATE'), ('TEST')) a(split),
      (values (0), (1)) b(truth), (values (0), (1)) c(predicted))
select g.split, g.truth, g.predicted, count(p.label) as n
from g left join p on g.split = p.split and g.truth = p.label and g.predicted = p.predicted
group by g.split, g.truth, g.predicted""")
def fraud_flow(spark, sf):
    """Under-sample, split by content, scale on TRAIN, clip, score by a rule, count per part."""
    kept = split.undersample(lines(spark, sf), "label", 1, 0.1, LINE_KEY, fast=False)
    marked = split.content_split(kept, _content_cols, fast=False).select("split", "label", "l_quantity", "l_discount")
    z = feat.standardize(marked, ["l_quantity", "l_discount"], marked.where("split = 'TRAIN'"))
    rule = clean.clip("l_quantity") + clean.clip("l_discount") > 1.5
    said = z.select("split", "label", rule.cast("int").alias("predicted"))
    return evaluate.confusion(said, "label", "predicted", [0, 1], "split", ["TRAIN", "VALIDATE", "TEST"]).drop(
        "row", "col")


# -- classification ---------------------------------------------------------------------------

# Rule prediction on labelled documents: long texts are good ones; score in whole steps.
_judged_sql = """
j as (select doc_id, quality, case when n_chars > 500 then 1 else 0 end as predicted,
             (n_chars % 1000) / 1000.0 as p from labels join documents using (doc_id))"""


def judged(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return table(spark, sf, "labels").select("doc_id", "quality").join(docs, "doc_id").select(
        "doc_id", "quality", (F.col("n_chars") > 500).cast("int").alias("predicted"),
        ((F.col("n_chars") % 1000) / 1000.0).alias("p"))


@query(f"with {_judged_sql} select round(avg(cast(quality = predicted as integer)), 9) as accuracy from j")
def accuracy(spark, sf):
    return judged(spark, sf).agg(F.round(evaluate.accuracy("quality", "predicted"), 9).alias("accuracy"))


@query(f"""
with {_judged_sql}, a(v, i) as (values (1, 0), (0, 1))
select cast(t.i as integer) as "row", cast(p.i as integer) as col, t.v as truth, p.v as predicted, count(j.doc_id) as n
from a t cross join a p left join j on j.quality = t.v and j.predicted = p.v group by all""")
def confusion(spark, sf):
    return evaluate.confusion(judged(spark, sf), "quality", "predicted", [1, 0])


@query("""
with j as (select l_returnflag as t, case when l_quantity < 17 then 'A' when l_quantity < 34 then 'N' else 'X' end as p from lineitem),
s as (select t as c, count(*) as support, sum(cast(t = p as integer)) as hit from j group by t),
d as (select p as c, count(*) as said from j group by p)
select round(sum(case when said > 0 then hit / said else 0 end * support) / sum(support), 5) as "precision",
       round(sum(hit) / sum(support), 5) as recall from s left join d using (c)""")
def weighted_pr(spark, sf):
    q = F.col("l_quantity")
    said = F.when(q < 17, "A").when(q < 34, "N").otherwise("X")
    df = table(spark, sf, "lineitem").select("l_returnflag", said.alias("said"))
    return evaluate.weighted_precision_recall(df, "l_returnflag", "said")


SQL_AUCPR = """
g as (select score, sum(label) as pos, sum(1 - label) as neg from scored group by score),
r as (select *, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as total
      from g window w as (order by score desc rows unbounded preceding)),
c as (select pos / total as step, tp / (tp + fp) as prec,
             case when tp + fp - pos - neg > 0 then (tp - pos) / (tp - pos + fp - neg) else tp / (tp + fp) end as before from r)"""


@query(f"""
with {SQL_LINES}, scored as (select label, cast(l_quantity as double) as score from lines), {SQL_AUCPR}
select round(sum(step * (prec + before) / 2), 9) as area_under_pr from c""")
def aucpr(spark, sf):
    df = lines(spark, sf).select("label", "l_quantity")
    return evaluate.area_under_pr(df, "label", "l_quantity").select(
        F.round("area_under_pr", 9).alias("area_under_pr"))


@query(f"""
with {SQL_LINES}, scored as (select label, {sql_cents('l_extendedprice')} as score from lines), {SQL_AUCPR}
select round(sum(step * (prec + before) / 2), 9) as area_under_pr from c""")
def aucpr_many_scores(spark, sf):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    df = lines(spark, sf).select("label", cents.alias("score"))
    return evaluate.area_under_pr(df, "label", "score").select(F.round("area_under_pr", 9).alias("area_under_pr"))


@query(f"""
with {_judged_sql}
select round(avg(cast((p > 0.5) = (quality = 1) as integer)), 9) as binary_accuracy,
       count(*) filter (where p > 0.5 and quality = 0) as false_positives,
       count(*) filter (where not p > 0.5 and quality = 1) as false_negatives from j""")
def fp_fn(spark, sf):
    return judged(spark, sf).agg(*evaluate.threshold_counts("quality", "p")).withColumn(
        "binary_accuracy", F.round("binary_accuracy", 9))


@query(f"""
with {_judged_sql}, c as (select quality as y, greatest(1e-7, least(1 - 1e-7, p)) as q from j)
select round(-avg(y * ln(q) + (1 - y) * ln(1 - q)), 9) as log_loss,
       round(-avg(ln(case y when 1 then q else greatest(1e-7, least(1 - 1e-7, 1 - q)) end)), 9) as class_loss from c""")
def logloss(spark, sf):
    df = judged(spark, sf).withColumn("both", F.array(1 - F.col("p"), F.col("p")))
    return df.agg(F.round(evaluate.cross_entropy("quality", "p"), 9).alias("log_loss"),
                  F.round(evaluate.categorical_cross_entropy("quality", "both"), 9).alias("class_loss"))


# -- regression and gates ----------------------------------------------------------------------

_pred_sql = """
m as (select o_orderpriority, sum(cast(round(o_totalprice * 100) as bigint)) / count(*) / 100 as prediction
      from orders group by 1),
y as (select o_orderkey, o_totalprice as label, prediction from orders join m using (o_orderpriority))"""


def group_means(spark, sf):
    """Each order's price predicted by the mean of its priority."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    means = orders.groupBy("o_orderpriority").agg((F.sum(cents) / F.count("*") / 100).alias("prediction"))
    return orders.join(means, "o_orderpriority").select(
        "o_orderkey", F.col("o_totalprice").alias("label"), "prediction")


_metric_sql = """
select round(sqrt(avg((label - prediction) ** 2)), 4) as {rmse}, round(avg(abs(label - prediction)), 4) as {mae},
       round(sqrt(avg((ln(1 + label) - ln(1 + prediction)) ** 2)), 7) as {rmsle},
       round(avg(abs((label - prediction) / nullif(label, 0))) * 100, 5) as {mape},
       round(1 - avg((label - prediction) ** 2) / var_pop(label), 7) as {r2},
       round(avg((label - prediction) ** 2) / 1e6, 4) as {mse} from y"""
# The names of the metrics.
_names = {"rmse": "rootMeanSquaredError", "mae": "meanAbsoluteError", "rmsle": "rootMeanSquaredLogError",
          "mape": "meanAbsolutePercentageError", "r2": "rSquared", "mse": "loss"}


@query(f"with {_pred_sql} {_metric_sql.format(**_names)}")
def regression_metrics(spark, sf):
    out = evaluate.regression_metrics(group_means(spark, sf), "label", "prediction", names=_names)
    digits = {"rmse": 4, "mae": 4, "rmsle": 7, "mape": 5, "r2": 7}
    return out.select(*[F.round(_names[m], d).alias(_names[m]) for m, d in digits.items()],
                      F.round(F.col("loss") / 1e6, 4).alias("loss"))


_long_sql = "long as (select 'rmse' as metric, sqrt(avg((label - prediction) ** 2)) as value from y union all " \
            "select 'mae', avg(abs(label - prediction)) from y union all " \
            "select 'r2', 1 - avg((label - prediction) ** 2) / var_pop(label) from y)"


def _long_metrics(df):
    wide = evaluate.regression_metrics(df, "label", "prediction", names={"rmse": "rmse", "mae": "mae", "r2": "r2"})
    return wide.unpivot([], ["rmse", "mae", "r2"], "metric", "value")


@query(f"""
with {_pred_sql}, {_long_sql}
select 'loose' as limits, case when max(value) filter (where metric = 'rmse') < 1e9
       and max(value) filter (where metric = 'mae') < 1e9 then 'true' else 'false' end as decision from long
union all
select 'tight', case when max(value) filter (where metric = 'rmse') < 1e9
       and max(value) filter (where metric = 'r2') > 0.5 then 'true' else 'false' end from long
union all
select 'missing', 'false'""")
def gate(spark, sf):
    long = _long_metrics(group_means(spark, sf))
    sets = {"loose": {"rmse": ("max", 1e9), "mae": ("max", 1e9)},
            "tight": {"rmse": ("max", 1e9), "r2": ("min", 0.5)},
            "missing": {"rmse": ("max", 1e9), "auRoc": ("min", 0.95)}}
    out = None
    for name, limits in sets.items():
        one = evaluate.gate(long, limits).select(F.lit(name).alias("limits"), "decision")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""
with {_pred_sql}, c as (select avg(o_totalprice) as m from orders)
select case when g <= k then 'grouped' else 'constant' end as model, round(least(g, k), 4) as rmse
from (select (select sqrt(avg((label - prediction) ** 2)) from y) as g,
             (select sqrt(avg((o_totalprice - m) ** 2)) from orders, c) as k)""")
def best_model(spark, sf):
    grouped = group_means(spark, sf)
    constant = grouped.withColumn("prediction", grouped.agg(F.avg("label")).scalar())
    value = lambda df, name: df.agg(evaluate.rmse("label", "prediction").alias("value")).select(
        F.lit(name).alias("model"), "value")
    both = value(grouped, "grouped").unionByName(value(constant, "constant"))
    return evaluate.best_model(both, ["grouped", "constant"]).select("model", F.round("value", 4).alias("rmse"))


@query(f"""
select o_orderkey, case when o_orderstatus <> 'O' then o_totalprice end as label, cast(o_custkey * 100 as double) as prediction,
  case when o_orderstatus <> 'O' then 'paired' else 'unlabelled' end as status from orders""")
def predictions_joined(spark, sf):
    """Prediction lines of both forms are written, read back by pattern and joined on the key; open orders have no label yet."""
    orders = table(spark, sf, "orders")
    value = (F.col("o_custkey") * 100).cast("string")
    body = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit('{"value": '), value, F.lit("}"))).otherwise(
        F.concat(F.lit("["), value, F.lit(", 0]")))
    line = F.concat(F.lit('{"instance": {"o_orderkey": '), F.col("o_orderkey").cast("string"),
                    F.lit('}, "prediction": '), body, F.lit("}"))
    path = fresh_path(spark, "predictions")
    orders.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType())])
    read = read_predictions(spark, path, schema, "part-*")
    truth = orders.where("o_orderstatus <> 'O'").select("o_orderkey", F.col("o_totalprice").alias("label"))
    return evaluate.pair_with_truth(read, truth, ["o_orderkey"]).select("o_orderkey", "label", "prediction", "status")


# -- summaries -----------------------------------------------------------------------------------

_sum_cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" union all ".join(f"""
select '{c}' as feature, count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, min({c}) as min,
       round(quantile_cont({c}, 0.25), 6) as p25, round(quantile_cont({c}, 0.5), 6) as p50,
       round(quantile_cont({c}, 0.75), 6) as p75, max({c}) as max from lineitem""" for c in _sum_cols))
def summary_stats(spark, sf):
    out = evaluate.summary(table(spark, sf, "lineitem").select(*_sum_cols), _sum_cols)
    rounded = {c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")}
    return out.withColumns(rounded)


@query("select count(*) as n_records, 11 as n_columns from lineitem")
def table_shape(spark, sf):
    return evaluate.shape(table(spark, sf, "lineitem"))


# -- scoring ---------------------------------------------------------------------------------------

WEIGHTS = {"l_quantity": 0.05, "l_discount": 20.0, "l_tax": -1.5}


@query(f"""
select {', '.join(LINE_KEY)}, round(-2.0 + l_quantity * 0.05 + l_discount * 20.0 + l_tax * -1.5, 6) + 0.0 as score
from lineitem""")
def linear_score(spark, sf):
    df = table(spark, sf, "lineitem").select(*LINE_KEY, *WEIGHTS)
    return df.select(*LINE_KEY, F.round(score.linear_score(WEIGHTS, -2.0), 6).alias("score"))


@query(f"""
with r as (select event_id, value, case when {sql_bucket(100, 'event_id')} < 20 then 'new' else 'current' end as side from events)
select event_id, side, case when side = 'new' then value * 2.0 else value end as score from r""")
def route_traffic(spark, sf):
    routed = table(spark, sf, "events").select("event_id", "value", score.route(["event_id"], fast=False).alias("side"))
    return score.score_routed(routed, "side", F.col("value") * 2.0, F.col("value")).select(
        "event_id", "side", "score")


@query("""
with l as (select l_returnflag, l_quantity, l_extendedprice from lineitem)
select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) + 0.0 as slope,
       round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept from l group by l_returnflag""")
def regr_line(spark, sf):
    out = regression_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return out.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"))
