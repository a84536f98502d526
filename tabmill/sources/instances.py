"""JSON-lines instances in all the shapes users send.

One object per line; single quotes; numbers as strings; ``dense_input`` or ``instances`` arrays
by position; arrays of arrays; objects of parallel arrays; an array of objects in one line or
over several. Whatever does not give a full row of numbers goes to the dead letters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

POSITIONAL = ("dense_input", "instances")  # fixed values: names of arrays by position

# an object with array punctuation of a list around it
LIST_ITEM = r"^\[?\s*(\{.*\})\s*,?\s*\]?\s*,?$"


def parse_instances(lines: DataFrame, names: Sequence[str], positions: Sequence[str] | None = None,
                    keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Instances ``(keep..., names...)`` as doubles, and dead letters ``(keep..., value, reason)``.

    ``positions`` is the column order of the array shapes. ``lines`` has a ``value`` column and
    is read once; each line is parsed by the schema its first characters call for.
    """
    routed = route(lines, names, positions or names, keep)
    good = routed.where("reason is null").select(
        *keep, *[F.col("row")[i].alias(n) for i, n in enumerate(names)])
    bad = routed.where("reason is not null").select(*keep, "value", "reason")
    return good, bad


def route(lines: DataFrame, names: Sequence[str], positions: Sequence[str],
          keep: Sequence[str] = ()) -> DataFrame:
    """Every line (blank ones aside) as rows of numbers or with a reason why not."""
    names, positions, keep = list(names), list(positions), list(keep)
    line = F.trim("value")
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *POSITIONAL]])
    objects = F.from_json(
        F.concat(F.lit("["), F.regexp_extract(line, LIST_ITEM, 1), F.lit("]")), T.ArrayType(text))
    arrays = F.from_json(line, T.ArrayType(T.ArrayType(T.StringType())))
    is_rows = line.startswith("[[")
    found = F.when(is_rows, F.transform(arrays, lambda a: _placed(a, names, positions))).otherwise(
        F.flatten(F.transform(objects, lambda o: _rows_of(o, names, positions))))
    parsed = lines.where(line != "").select(*keep, "value", F.explode_outer(found).alias("row"))
    missing = F.exists("row", lambda x: x.isNull())
    reason = (F.when(F.col("row").isNull(), "not an instance")
              .when(F.size("row") != len(names), "wrong length")
              .when(missing, "not a number"))
    return parsed.withColumn("reason", reason)


def _number(c: Column) -> Column:
    return c.try_cast("double")


def _placed(values: Column, names: list[str], positions: list[str]) -> Column:
    """An array by position, in the order of ``names``; a wrong length comes back as one that is always wrong."""
    numbers = F.transform(values, _number)
    ordered = F.array(*[F.get(numbers, F.lit(positions.index(n))) for n in names])
    wrong = F.array_repeat(F.lit(None).cast("double"), len(names) + 1)
    return F.when(F.size(values) == len(positions), ordered).otherwise(wrong)


def _rows_of(o: Column, names: list[str], positions: list[str]) -> Column:
    """The rows of one object: one by position, one by name, or several from parallel arrays."""
    as_list = lambda c: F.from_json(c, T.ArrayType(T.StringType()))
    dense = F.coalesce(*[o[p] for p in POSITIONAL])
    parallel = F.arrays_zip(*[as_list(o[n]).alias(n) for n in names])
    several = F.transform(parallel, lambda z: F.array(*[_number(z[n]) for n in names]))
    single = F.array(F.array(*[_number(o[n]) for n in names]))
    return (F.when(dense.isNotNull(), F.array(_placed(as_list(dense), names, positions)))
            .when(o[names[0]].startswith("["), several)
            .otherwise(single))
