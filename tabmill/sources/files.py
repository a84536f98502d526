"""Files that need more than one reader call; plain CSV, JSON and Parquet use Spark's readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def load_csv_table(spark: SparkSession, path: str, schema: T.StructType, table: str,
                   folder: str | None = None) -> None:
    """CSV with a header into a table of declared types (decimals included), replacing it."""
    writer = spark.read.schema(schema).option("header", True).csv(path).write.mode("overwrite")
    if folder:
        writer = writer.option("path", folder)
    writer.saveAsTable(table)


def spaced_fields(lines: DataFrame, schema: T.StructType, null: str = "?") -> DataFrame:
    """Fields split on runs of spaces; text after a tab is a comment; ``?`` is null."""
    fields = F.split(F.trim(F.substring_index("value", "\t", 1)), " +")
    cols = [F.nullif(F.get(fields, F.lit(i)), F.lit(null)).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema.fields)]
    return lines.where(F.trim("value") != "").select(*cols)


def read_spaced(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spaced_fields(spark.read.text(path), schema)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, quote: str = '"') -> DataFrame:
    """No header, names from the schema; an empty ``quote`` takes quotes as they are."""
    return spark.read.schema(schema).option("sep", "\t").option("quote", quote).csv(path)


def parse_predictions(lines: DataFrame, instance: T.StructType) -> DataFrame:
    """Prediction lines ``{"instance": {...}, "prediction": ...}``.

    The prediction is an object with ``value`` or a list whose first entry counts.
    """
    outer = T.StructType([T.StructField("instance", instance), T.StructField("prediction", T.StringType())])
    row = lines.select(F.from_json("value", outer).alias("r")).select("r.*")
    of_object = F.from_json("prediction", T.StructType([T.StructField("value", T.DoubleType())]))["value"]
    of_list = F.get(F.from_json("prediction", T.ArrayType(T.DoubleType())), F.lit(0))
    chosen: Column = F.when(F.trim("prediction").startswith("["), of_list).otherwise(of_object)
    return row.select("instance.*", chosen.alias("prediction"))


# Fixed value: how prediction files are named.
PREDICTION_FILES = "prediction.results*"


def read_predictions(spark: SparkSession, folder: str, instance: T.StructType,
                     pattern: str = PREDICTION_FILES) -> DataFrame:
    return parse_predictions(spark.read.option("pathGlobFilter", pattern).text(folder), instance)


def write_labels(df: DataFrame, key: Sequence[str], label: str, path: str) -> None:
    """The label with its row key: without the key nothing can be paired later."""
    df.select(*key, label).write.mode("errorifexists").option("header", True).csv(path)
