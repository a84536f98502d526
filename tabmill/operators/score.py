"""Batch scoring, traffic splits and instance checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tabmill.functions import hashing


def linear_score(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Intercept plus weighted sum of columns."""
    total = F.lit(float(intercept))
    for name, weight in weights.items():
        total = total + F.col(name) * F.lit(float(weight))
    return total


def score_with(path: str, instances: DataFrame, keep: Sequence[str], classes: bool = True) -> DataFrame:
    """Score with a stored pipeline: key columns, prediction and class scores as an array."""
    scored = PipelineModel.load(path).transform(instances)
    cols = [*keep, "prediction"]
    if classes and "probability" in scored.columns:
        return scored.select(*cols, vector_to_array("probability").alias("scores"))
    return scored.select(*cols)


def prediction_path(root: str, model: str, at: datetime | None = None) -> str:
    """One folder per job: prediction-<model>-<time>."""
    at = at or datetime.now(timezone.utc)
    stamp = at.strftime("%Y-%m-%dT%H-%M-%S-") + f"{at.microsecond // 1000:03d}Z"
    return f"{root}/prediction-{model}-{stamp}"


def write_predictions(scored: DataFrame, root: str, model: str, at: datetime | None = None) -> str:
    """JSON lines in a new folder; an existing folder is an error."""
    path = prediction_path(root, model, at)
    scored.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
    return path


def route(key: Sequence[str], new_share: int = 20, has_current: bool = True, seed: str = "",
          fast: bool = True) -> Column:
    """"new" for ``new_share`` % of the request keys, else "current"; all new without a current."""
    if not has_current:
        return F.lit("new")
    number = hashing.fast_bucket if fast else hashing.bucket
    return F.when(number(100, *key, seed=seed) < new_share, "new").otherwise("current")


def score_routed(df: DataFrame, side: str, new: Column, current: Column, out: str = "score") -> DataFrame:
    """Each request is scored by the model it was routed to, in one pass."""
    return df.withColumn(out, F.when(F.col(side) == "new", new).otherwise(current))


def coerce_numbers(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Instances with every column a number, and the rest with the columns at fault."""
    cast = {c: F.col(c).try_cast("double") for c in cols}
    faults = F.array_compact(F.array(*[F.when(e.isNull(), F.lit(c)) for c, e in cast.items()]))
    checked = df.withColumn("faults", faults)
    good = checked.where(F.size("faults") == 0).drop("faults").withColumns(cast)
    return good, checked.where(F.size("faults") > 0)
