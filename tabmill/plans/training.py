"""Queries: training, search and scoring with stored models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabmill.functions import hashing
from tabmill.operators import boosting, evaluate, features as feat, linear, network, perceptron, score, split, train, tuning
from tabmill.plans.prepare import LINE_KEY, RARE
from tabmill.plans.registry import query, sql_bucket, sql_in_fraction, table
from tabmill.session import fresh_path

COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
PRODUCT = "l_quantity * l_discount"
# Fixed bounds that cut the product in three parts of about equal size.
CLASSES = f"case when {PRODUCT} < 0.66 then 0.0D when {PRODUCT} < 1.5 then 1.0D else 2.0D end"


def labelled(spark, sf, label: str):
    df = table(spark, sf, "lineitem").select(*LINE_KEY, "l_returnflag", *COLS)
    return df.withColumn("label", F.expr(label).cast("double"))


def binary(spark, sf):
    return labelled(spark, sf, f"cast({RARE} as double)")


def halves(df):
    marked = split.fractions(df, LINE_KEY, (0.8, 0.2), ("train", "test"), fast=False)
    return marked.where("split = 'train'").drop("split"), marked.where("split = 'test'").drop("split")


@query()
def gbt_scores(spark, sf):
    """Boosted trees on the rare class, weighted 1 : 20, with class scores on the hold-out."""
    fit, rest = halves(feat.with_weights(binary(spark, sf), "label", {0.0: 1.0, 1.0: 20.0}))
    model = train.binned(COLS, train.boosted_trees(depth=4, rounds=10, weight="weight")).fit(fit)
    scored = model.transform(rest)
    return scored.select(*LINE_KEY, "label", "prediction", vector_to_array("probability").alias("scores"))


@query()
def gbt_early_stop(spark, sf):
    """A validation share inside the fit ends boosting early; importances of the result."""
    marked = binary(spark, sf).withColumn("held_out", hashing.in_fraction(0.2, *LINE_KEY))
    model = train.binned(COLS, train.boosted_trees(depth=4, rounds=10, validation="held_out")).fit(marked)
    return evaluate.feature_importance(model.stages[-1], COLS, spark)


@query()
def multiclass_scores(spark, sf):
    fit, rest = halves(labelled(spark, sf, CLASSES))
    model = train.binned(COLS, train.boosted_classes(depth=4, rounds=5)).fit(fit)
    return model.transform(rest).select(*LINE_KEY, "label", "prediction")


@query()
def mlp_scores(spark, sf):
    """Feed-forward 16-8-4 on scaled columns."""
    fit, rest = halves(binary(spark, sf))
    model = perceptron.Perceptron(COLS, train.perceptron(len(COLS), (16, 8, 4), 2, 60)).fit(fit)
    return model.transform(rest).select(*LINE_KEY, "label", "prediction")


@query()
def mlp_three_classes(spark, sf):
    fit, rest = halves(labelled(spark, sf, CLASSES))
    model = perceptron.Perceptron(COLS, train.perceptron(len(COLS), (8, 8), 3, 60)).fit(fit)
    return model.transform(rest).select(*LINE_KEY, "label", "prediction")


@query()
def weighted_logistic_scores(spark, sf):
    fit, rest = halves(feat.with_weights(binary(spark, sf), "label", {0.0: 1.0, 1.0: 100.0}))
    with train.held(fit) as fit:
        model = train.scaled(COLS, train.weighted_logistic("weight", 30)).fit(fit)
    return model.transform(rest).select(*LINE_KEY, "label", "prediction")


@query()
def regressor_scores(spark, sf):
    fit, rest = halves(labelled(spark, sf, PRODUCT))
    model = train.binned(COLS, train.tree_regressor(depth=4, rounds=10)).fit(fit)
    return model.transform(rest).select(*LINE_KEY, "label", "prediction")


@query()
def lasso_trials(spark, sf):
    """Linear model with an L1 penalty, five iterations, four trials judged by squared error."""
    fit, rest = halves(labelled(spark, sf, PRODUCT))
    settings = train.draw({"penalty": ("log", 0.001, 1.0)}, 3) + [{"penalty": 1.0}]
    log, _ = train.search(fit, rest, settings, lambda s: train.scaled(COLS, train.lasso(s["penalty"])),
                          RegressionEvaluator(metricName="mse"))
    return log


@query()
def search(spark, sf):
    """Random trials over a log, an integer and a choice parameter, judged by accuracy."""
    fit, rest = halves(labelled(spark, sf, CLASSES))
    settings = train.draw({"rate": ("log", 0.01, 0.5), "depth": ("int", 2, 4), "bins": ("choice", [16, 32])}, 16)
    cells = train.Cells()

    def build(s):
        return train.BinnedForest(COLS, RandomForestClassifier(
            maxDepth=s["depth"], maxBins=s["bins"], subsamplingRate=min(1.0, 2 * s["rate"]), numTrees=5, seed=2), cells)

    return train.search(fit, rest, settings, build, MulticlassClassificationEvaluator(metricName="accuracy"))[0]


# Doubled widths at one number of rounds: what the width of the hidden layer buys. The experiment's own settings are those of network_grid.
GRID = [{"num_units": 2 ** i, "epochs": 20} for i in range(1, 5)]


@query()
def grid_runs(spark, sf):
    """A fixed grid, each setting a run with its parameters and final metric."""
    fit, rest = halves(labelled(spark, sf, CLASSES))
    with perceptron.Blocks() as blocks:
        return train.search(fit.select(*COLS, "label"), rest.select(*COLS, "label"), GRID, lambda s: perceptron.Perceptron(
            COLS, train.perceptron(len(COLS), (s["num_units"],), 3, s["epochs"]), blocks),
            MulticlassClassificationEvaluator(metricName="accuracy"))[0]


@query()
def automatic_choice(spark, sf):
    fit, rest = halves(binary(spark, sf))
    judge = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0)
    return train.choose(fit, rest, train.classifier_candidates(COLS), judge)[0]


@query()
def automatic_regression(spark, sf):
    fit, rest = halves(labelled(spark, sf, PRODUCT))
    return train.choose(fit, rest, train.regressor_candidates(COLS), RegressionEvaluator(metricName="rmse"))[0]


@query()
def oof_scores(spark, sf):
    """Three folds by row hash, every row scored once by a model that has not seen it."""
    return train.out_of_fold(binary(spark, sf).select(*LINE_KEY, *COLS, "label"), LINE_KEY,
                             train.plain(COLS, DecisionTreeClassifier(maxDepth=5, seed=2)))


@query()
def stored_scores(spark, sf):
    """Pipeline from a column spec, stored, loaded and used to score the hold-out into files."""
    fit, rest = halves(binary(spark, sf))
    spec = feat.feature_pipeline(fit, numeric=COLS[:2], auto=["l_tax", "l_returnflag"], label="label")
    with train.held(fit) as fit:
        model = Pipeline(stages=[spec, LogisticRegression(maxIter=20)]).fit(fit)
    root = fresh_path(spark, "models")
    model.save(f"{root}/model")
    folder = score.write_predictions(score.score_with(f"{root}/model", rest, LINE_KEY), root, "lines")
    schema = ", ".join(f"{c} long" for c in LINE_KEY) + ", prediction double, scores array<double>"
    return spark.read.schema(schema).json(folder)


# -- fits whose answer is known ----------------------------------------------------------------

STEP = "case when l_quantity > 25 then 1.0 else 0.0 end"
_key = ", ".join(LINE_KEY)
_step = f"select {_key}, cast({STEP} as double) as prediction from lineitem"


def _values(rows: list[tuple]) -> str:
    text = lambda v: f"{v!r}::double" if isinstance(v, float) else repr(v)
    return ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)


def stepped(spark, sf):
    """A label that one cut of one column decides: 50 quantities are fewer than the 64 bins of a tree."""
    return labelled(spark, sf, STEP)


def rest_of(df, seed="9"):
    """Four fifths to fit, the others, by row hash."""
    return split.sample(df, 0.8, LINE_KEY, seed=seed, fast=False), split.complement(df, 0.8, LINE_KEY, seed=seed, fast=False)


_unseen = f"not {sql_in_fraction(0.8, *LINE_KEY, seed='9')}"


@query(f"{_step} where {_unseen}")
def gbt_step(spark, sf):
    """Boosted trees find the cut: every unseen row gets its label."""
    fit, rest = rest_of(stepped(spark, sf))
    gbt = train.boosted_trees(depth=3, rounds=5).setMaxBins(64)
    model = train.binned(COLS, gbt).fit(fit)
    return model.transform(rest).select(*LINE_KEY, "prediction")


@query("select * from (values " + _values([(c, float(c == "l_quantity")) for c in COLS]) + ") as t(feature, importance)")
def gbt_step_importance(spark, sf):
    """With a validation share in the fit; the column of the cut has all the importance."""
    marked = stepped(spark, sf).withColumn("held_out", hashing.in_fraction(0.2, *LINE_KEY))
    gbt = train.boosted_trees(depth=1, rounds=5, validation="held_out").setMaxBins(64)
    model = train.binned(COLS, gbt).fit(marked)
    found = evaluate.feature_importance(model.stages[-1], COLS, spark)
    return found.select("feature", F.round("importance", 6).alias("importance"))


@query(f"select {_key}, cast(l_linenumber - 1 as double) as prediction from lineitem where {_unseen}")
def seven_classes(spark, sf):
    """Seven classes, one boosted model against the rest for each."""
    lines = table(spark, sf, "lineitem").select(
        *LINE_KEY, (F.col("l_linenumber") - 1).cast("double").alias("label"),
        F.col("l_linenumber").cast("double").alias("place"), "l_tax")
    fit, rest = rest_of(lines)
    model = train.binned(["place", "l_tax"], train.boosted_classes(depth=3, rounds=3)).fit(fit)
    return model.transform(rest).select(*LINE_KEY, "prediction")


@query(f"{_step} where {_unseen}")
def tree_regressor_step(spark, sf):
    fit, rest = rest_of(stepped(spark, sf))
    model = train.binned(COLS, train.tree_regressor(depth=3, rounds=5).setMaxBins(64)).fit(fit)
    return model.transform(rest).select(*LINE_KEY, F.round("prediction", 6).alias("prediction"))


@query(f"{_step}")
def oof_step(spark, sf):
    """Out of fold: every row gets its label from a model that has not seen it."""
    tree = DecisionTreeClassifier(maxDepth=3, maxBins=64, seed=2)
    scored = train.out_of_fold(stepped(spark, sf).select(*LINE_KEY, *COLS, "label"), LINE_KEY, train.plain(COLS, tree))
    return scored.select(*LINE_KEY, "prediction")


@query(f"{_step} where {_unseen}")
def stored_step(spark, sf):
    """Column spec, tree, stored, loaded, and scores written to and read from files."""
    fit, rest = rest_of(stepped(spark, sf))
    spec = feat.feature_pipeline(fit, numeric=COLS[:2], auto=["l_tax", "l_returnflag"], label="label")
    with train.held(fit) as fit:
        model = Pipeline(stages=[spec, DecisionTreeClassifier(maxDepth=3, maxBins=64, seed=2)]).fit(fit)
    root = fresh_path(spark, "models")
    model.save(f"{root}/model")
    folder = score.write_predictions(score.score_with(f"{root}/model", rest, LINE_KEY), root, "lines")
    schema = ", ".join(f"{c} long" for c in LINE_KEY) + ", prediction double"
    return spark.read.schema(schema).json(folder)


@query("select * from (values " + _values([("l_quantity", 2.0), ("l_discount", -3.0), ("l_tax", 5.0), ("", 7.0)])
       + ") as t(feature, weight)")
def linear_weights(spark, sf):
    """Least squares finds the weights that made the target; the empty name is the intercept."""
    df = labelled(spark, sf, "2 * l_quantity - 3 * l_discount + 5 * l_tax + 7")
    names = ["l_quantity", "l_discount", "l_tax"]
    with train.held(df) as df:
        model = train.plain(names, LinearRegression(regParam=0.0, solver="normal")).fit(df).stages[-1]
    rows = [*zip(names, map(float, model.coefficients)), ("", model.intercept)]
    return spark.createDataFrame(rows, "feature string, weight double").withColumn("weight", F.round("weight", 6))


@query(f"""select {_key}, round(2 * l_quantity, 4) as by_quantity, round(-3 * l_discount, 4) + 0.0::double as by_discount,
  round(5 * l_tax, 4) as by_tax from lineitem where {_unseen}""")
def linear_contributions(spark, sf):
    """What each feature of an unseen row adds to its prediction: weight times value."""
    df = labelled(spark, sf, "2 * l_quantity - 3 * l_discount + 5 * l_tax + 7")
    names = ["l_quantity", "l_discount", "l_tax"]
    fit, rest = rest_of(df)
    with train.held(fit) as fit:
        model = train.plain(names, LinearRegression(regParam=0.0, solver="normal")).fit(fit).stages[-1]
    shares = evaluate.contributions(rest, model, names)
    return shares.select(*LINE_KEY, *[(F.round(F.col(f"by_{n}"), 4) + F.lit(0.0)).alias(f"by_{n[2:]}") for n in names])


TRIALS = train.draw({"rate": ("log", 0.01, 0.5), "depth": ("int", 1, 4), "bins": ("choice", [64, 128])}, 16, seed=5)


@query("select run, kind, key, value from (values " + _values(
    [(f"trial-{i}", "param", k, float(v)) for i, t in enumerate(TRIALS) for k, v in t.items()]
    + [(f"trial-{i}", "metric", "accuracy", 1.0) for i in range(len(TRIALS))]) + ") as t(run, kind, key, value)")
def search_step(spark, sf):
    """Sixteen trials, four at a time, of settings that all can learn the step."""
    fit, rest = (df.select("l_quantity", "label") for df in rest_of(stepped(spark, sf)))
    cells = train.Cells()

    def build(s):
        return train.binned(["l_quantity"], GBTClassifier(
            stepSize=s["rate"], maxDepth=s["depth"], maxBins=s["bins"], maxIter=1, seed=2), cells)

    log, _ = train.search(fit, rest, TRIALS, build, MulticlassClassificationEvaluator(metricName="accuracy"))
    return log.select("run", "kind", "key", "value")


# A line fitted with a squared penalty strays the more the larger the penalty, so the order of the trials, which is all that
# the search goes by, is known without a fit; the metric of each has a closed form.
RIDGE = {"penalty": ("log", 0.01, 100.0), "iterations": ("int", 10, 100), "solver": ("choice", ["auto", "normal"]),
         "tree_depth": ("discrete", [2, 3, 4])}
RIDGE_TRIALS = tuning.batches(RIDGE, lambda settings: [s["penalty"] for s in settings], 16, 4, larger=False)


def _ridge_sql() -> str:
    settings, penalties = [], []
    for i, (setting, _, batch) in enumerate(RIDGE_TRIALS):
        for key, value in {"batch": batch, **setting}.items():
            number, text = ("null", f"'{value}'") if isinstance(value, str) else (f"{float(value)!r}", "null")
            settings.append(f"('trial-{i}', 'param', '{key}', cast({number} as double), cast({text} as varchar))")
        penalties.append(f"('trial-{i}', cast({setting['penalty']!r} as double))")
    return f"""
with fit as (select avg(l_quantity) as x, 3 * stddev_pop(l_quantity) as sd from lineitem where {sql_in_fraction(0.8, *LINE_KEY, seed='9')}),
rest as (select l_quantity as q from lineitem where {_unseen}),
metrics as (select run, avg(power((3 - 3 / (1 + penalty / sd)) * (q - x), 2)) as mse
  from (values {', '.join(penalties)}) as t(run, penalty), fit, rest group by run)
select run, kind, key, round(value, 6) as value, text from (values {', '.join(settings)}) as t(run, kind, key, value, text)
union all select run, 'metric', 'mse', round(mse, 6), null from metrics"""


@query(_ridge_sql())
def tuned_ridge(spark, sf):
    """Sixteen trials in batches of four, the later ones drawn by what the earlier ones gave."""
    fit, rest = rest_of(table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity", (3 * F.col("l_quantity") + 1).alias("label")))

    def build(s):
        return train.plain(["l_quantity"], LinearRegression(
            regParam=s["penalty"], elasticNetParam=0.0, solver=s["solver"], maxIter=s["iterations"], aggregationDepth=s["tree_depth"]))

    log, _ = tuning.tune(fit, rest, RIDGE, build, RegressionEvaluator(metricName="mse"))
    return log.select("run", "kind", "key", F.round("value", 6).alias("value"), "text")


@query(f"select {_key}, cast(case when l_linestatus = 'O' then 1.0 else 0.0 end as double) as prediction from lineitem where {_unseen}")
def mlp_two_inputs(spark, sf):
    """The feed-forward classifier learns a function of a 0/1 input."""
    lines = table(spark, sf, "lineitem").select(
        *LINE_KEY, (F.col("l_linestatus") == "O").cast("double").alias("label"),
        *[(F.col("l_linestatus") == v).cast("double").alias(f"is_{v}") for v in "OF"])
    fit, rest = rest_of(lines)
    model = perceptron.Perceptron(["is_O", "is_F"], train.perceptron(2, (16, 8, 4), 2, 60), merged=True).fit(fit)
    return model.transform(rest).select(*LINE_KEY, "prediction")


@query(f"select {_key}, cast(case l_returnflag when 'A' then 0.0 when 'N' then 1.0 else 2.0 end as double) as prediction "
       f"from lineitem where {_unseen}")
def mlp_three_flags(spark, sf):
    """Three classes, hidden 8-8, from 0/1 inputs."""
    lines = table(spark, sf, "lineitem").select(
        *LINE_KEY, F.expr("case l_returnflag when 'A' then 0.0D when 'N' then 1.0D else 2.0D end").alias("label"),
        *[(F.col("l_returnflag") == v).cast("double").alias(f"is_{v}") for v in "ANR"])
    fit, rest = rest_of(lines)
    model = perceptron.Perceptron(["is_A", "is_N", "is_R"], train.perceptron(3, (8, 8), 3, 60), merged=True).fit(fit)
    return model.transform(rest).select(*LINE_KEY, "prediction")


# -- text classes ---------------------------------------------------------------------------------

_part = "cast('0x' || substr(md5(concat_ws('#', '8', cast(doc_id as varchar))), 1, 8) as bigint) < 3435973837"


@query(f"""
with d as (select doc_id, text, lang, {_part} as fit from documents),
c as (select doc_id, w as term, count(*) as n
      from (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) as w from d) group by doc_id, w),
i as (select term, ln((1 + (select count(*) from d where fit)) / (1 + count(*))) + 1 as idf
      from c join d using (doc_id) where fit group by term),
w as (select doc_id, term, n * idf as w from c join i using (term)),
t as (select doc_id, term, w / sqrt(sum(w * w) over (partition by doc_id)) as weight from w),
cls as (select lang, count(*) as n from d where fit group by lang),
s as (select term, lang, sum(weight) as s from t join d using (doc_id) where fit group by term, lang),
tot as (select lang, sum(s) as total from s group by lang),
v as (select count(*) as v from i),
th as (select i.term, cls.lang, ln((coalesce(s.s, 0) + 1) / (total + v)) as logp
       from i cross join cls cross join v join tot using (lang) left join s on s.term = i.term and s.lang = cls.lang),
sc as (select doc_id, th.lang, sum(weight * logp) as score from t join th using (term) group by doc_id, th.lang),
b as (select d.doc_id, cls.lang, coalesce(score, 0) + ln(cls.n / (select sum(n) from cls)) as score
      from d cross join cls left join sc on sc.doc_id = d.doc_id and sc.lang = cls.lang where not d.fit)
select doc_id, arg_max(lang, score) as prediction from b group by doc_id""")
def nb_scores(spark, sf):
    """Naive Bayes on TF-IDF, fitted on 80 % of the documents, the rest scored."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    fit = split.sample(docs, 0.8, ["doc_id"], seed="8", fast=False)
    rest = split.complement(docs, 0.8, ["doc_id"], seed="8", fast=False)
    return train.score_text_classes(train.fit_text_classes(fit, "doc_id", "text", "lang"), rest, "doc_id", "text")


# -- boosting by histograms --------------------------------------------------------------------

# Seven zones of quantity, discount and tax; no column holds the label.
ZONE = ("case when l_quantity <= 12 then 0 when l_quantity <= 25 then (case when l_discount < 0.045 then 1 else 2 end) "
        "when l_quantity <= 38 then (case when l_tax < 0.035 then 3 else 4 end) when l_discount < 0.065 then 5 else 6 end")


@query(f"select {_key}, cast({ZONE} as double) as prediction from lineitem where {_unseen}")
def boosted_seven(spark, sf):
    """Softmax boosting, seven trees a round, 20 rounds: every unseen row gets its zone."""
    fit, rest = rest_of(labelled(spark, sf, ZONE))
    model = boosting.fit(fit, "label", ["l_quantity", "l_discount", "l_tax"], "softmax", 7, depth=3, rounds=20, bins=64, merged=True)
    return boosting.predictions(rest, model).select(*LINE_KEY, "prediction")


# A target of two cuts, quantity before discount
FLOORS = "case when l_quantity > 25 then (case when l_discount > 0.045 then 9.0 else 7.0 end) else (case when l_discount > 0.045 then 2.0 else 1.0 end) end"


@query(f"""
with t as (select *, cast({FLOORS} as double) as y, l_quantity > 25 as a, l_discount > 0.045 as b from lineitem),
root as (select avg(y) as base from t),
node as (select a, avg(y) as v from t group by a),
leaf as (select a, b, avg(y) as w from t group by a, b)
select {_key}, round(v - base, 6) as by_l_quantity, round(w - v, 6) as by_l_discount, round(base, 6) as base, round(w, 6) as margin
from t join node using (a) join leaf using (a, b), root""")
def tree_contributions(spark, sf):
    """What each column adds to a tree's value on a row's way: differences of the means of the nodes."""
    df = labelled(spark, sf, FLOORS)
    model = boosting.fit(df, "label", ["l_quantity", "l_discount"], "squared", depth=2, rate=1.0, rounds=1, penalty=0.0, bins=64, merged=True)
    told = boosting.margins(boosting.contributions(df, model), model)
    return told.select(*LINE_KEY, *[F.round(c, 6).alias(c) for c in ("by_l_quantity", "by_l_discount", "base")],
                       F.round(F.col("margins")[0], 6).alias("margin"))


# -- L1 on a split column ------------------------------------------------------------------------

PENALTIES = [0.01, 0.05, 0.2, 1.0]


def _sql_lasso() -> str:
    """Coordinate descent in SQL: a recursion over sweeps, with the matrix of cross products of the scaled columns."""
    n = range(4)
    inner = "it"
    for j in n:
        others = " - ".join(f"c{min(i, j)}{max(i, j)} * {'n' if i < j else 'w'}{i}" for i in n if i != j)
        inner = (f"(select *, sign(r{j} - {others}) * greatest(abs(r{j} - {others}) - penalty, 0) as n{j} from "
                 + (f"it cross join g where i < 400)" if j == 0 else inner + ")"))
    x = [f"(({c} - a{j}) / s{j})" for j, c in enumerate(COLS)]
    return f"""
with recursive t as (
  select *, {PRODUCT} as y, case {sql_bucket(10, *LINE_KEY)} when 9 then 'TEST' when 8 then 'VALIDATE' else 'TRAIN' end as part from lineitem),
m as (select {', '.join(f'avg({c}) as a{j}, stddev_pop({c}) as s{j}' for j, c in enumerate(COLS))}, avg(y) as ay from t where part = 'TRAIN'),
g as (select {', '.join(f'avg({x[i]} * {x[j]}) as c{i}{j}' for i in n for j in n if i < j)}, {', '.join(f'avg({x[j]} * (y - ay)) as r{j}' for j in n)}
      from t, m where part = 'TRAIN'),
it as (
  select 0 as i, penalty, {', '.join(f'0.0::double as w{j}' for j in n)} from (values {', '.join(f'({p}::double)' for p in PENALTIES)}) as p(penalty)
  union all select i + 1, penalty, {', '.join(f'n{j}' for j in n)} from {inner}),
f as (select penalty, {', '.join(f'w{j} / s{j} as b{j}' for j in n)}, ay - {' - '.join(f'w{j} / s{j} * a{j}' for j in n)} as b from it, m where i = 400),
e as (select penalty, avg(power(y - b - {' - '.join(f'b{j} * {c}' for j, c in enumerate(COLS))}, 2)) as mse from t, f where part = 'VALIDATE' group by penalty),
r as (select *, 'trial-' || (row_number() over (order by penalty) - 1) as run from f join e using (penalty))
select run, 'param' as kind, 'penalty' as key, penalty as value from r union all select run, 'metric', 'mse', round(mse, 6) from r
union all select run, 'weight', '', round(b, 6) from r
{' '.join(f"union all select run, 'weight', '{c}', round(b{j}, 8) + 0.0 from r" for j, c in enumerate(COLS))}"""


@query(_sql_lasso())
def l1_on_split_column(spark, sf):
    """Four penalties on the parts of a content hash, solved on sums and judged by squared error."""
    marked = split.content_split(labelled(spark, sf, PRODUCT), LINE_KEY, fast=False)
    log, _ = linear.lasso_trials(marked, COLS, "label", PENALTIES, "split")
    digits = F.when((F.col("kind") == "weight") & (F.col("key") != ""), F.round("value", 8)).otherwise(F.round("value", 6))
    return log.withColumn("value", digits)


# -- networks by mini-batches ----------------------------------------------------------------------

# The five settings of the experiment. Dropout follows the first of two hidden layers.
NETWORKS = [{"num_units": 16, "dropout_rate": 0.1, "epochs": 3}, {"num_units": 16, "dropout_rate": 0.1, "epochs": 10},
            {"num_units": 16, "dropout_rate": 0.2, "epochs": 10}, {"num_units": 32, "dropout_rate": 0.1, "epochs": 10},
            {"num_units": 32, "dropout_rate": 0.2, "epochs": 10}]
LINE_TARGET = "3.0 * l_quantity - 200.0 * l_discount + 100.0 * l_tax"
BOUND = 0.2  # of the target's variance: what a network of any setting stays below after its last epoch


@query("select * from (values " + ", ".join(
    f"('run-{i}', {s['num_units']}::bigint, {s['epochs']}::bigint, true)" for i, s in enumerate(NETWORKS))
    + ") as t(run, num_units, epochs, within)")
def network_grid(spark, sf):
    """Five regressions with dropout on a linear target: a metric for every epoch, and the last squared error within its bound."""
    fit, rest = halves(labelled(spark, sf, LINE_TARGET))
    settings = [{"hidden": [s["num_units"]] * 2, "dropout": [s["dropout_rate"]], "epochs": s["epochs"]} for s in NETWORKS]
    log = network.grid(fit, rest, "label", COLS, LINE_KEY, settings)
    last = F.max(F.when(F.col("step").isNull() & (F.col("key") == "mse"), F.col("value")))
    per_run = log.groupBy("run").agg(F.max(F.when(F.col("key") == "hidden.0", F.col("value"))).cast("long").alias("num_units"),
                                     F.count(F.when(F.col("step").isNotNull() & (F.col("key") == "mse"), 1)).alias("epochs"), last.alias("mse"))
    variance = rest.agg(F.var_pop("label")).first()[0]
    return per_run.select("run", "num_units", "epochs", (F.col("mse") < BOUND * variance).alias("within"))
