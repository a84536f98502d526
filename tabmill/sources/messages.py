"""Trigger messages: base64 of UTF-8 JSON. The same call works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def decode_messages(df: DataFrame, schema: T.StructType, data: str = "data") -> DataFrame:
    """Payload fields next to the other columns; ``valid`` is false if the payload is broken."""
    payload = F.try_to_binary(F.col(data), F.lit("base64"))
    parsed = F.from_json(F.try_validate_utf8(payload.cast("string")), schema)
    rest = [c for c in df.columns if c != data]
    return (df.withColumn("_p", parsed)
            .select(*rest, *[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields],
                    F.coalesce(F.col(f"_p.{schema.fields[0].name}").isNotNull(), F.lit(False)).alias("valid")))
