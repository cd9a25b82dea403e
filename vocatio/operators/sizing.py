"""Sizes of dimensions, taken once when they are loaded, and the join that relies on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64  # over which rows with a blank key are spread

_SALT, _RIGHT_SALT = "__salt", "__right_salt"


def _value_bytes(name: str, data_type: T.DataType) -> str:
    column = "`" + name.replace("`", "``") + "`"
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        size = f"octet_length({column})"
    elif isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.NumericType):
        size = f"size({column}) * 8"
    elif isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        size = f"octet_length(to_json({column}))"
    else:
        size = "8"
    return f"coalesce(bigint({size}), 0) + 8"


def measure(df: DataFrame, *more: Column) -> tuple:
    """Row count, approximate bytes in memory and more aggregates, in one job."""
    per_row = " + ".join(_value_bytes(field.name, field.dataType) for field in df.schema.fields)
    total = F.expr(f"coalesce(sum({per_row}), 0)")
    return tuple(df.agg(F.count(F.lit(1)), total, *more).first())


def dimension(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """A dimension as it is loaded, marked for broadcast if it was measured to be small.

    The mark goes with everything derived from it by row, so that joins need no job of their own.
    """
    return F.broadcast(df) if measure(df)[1] <= max_bytes else df


def is_marked(df: DataFrame) -> bool:
    """Whether a frame is marked for broadcast, by ``dimension`` or by hand; nothing runs."""
    plan = df._jdf.queryExecution().analyzed().toString().splitlines()
    nodes = [line.lstrip("+- ") for line in plan]
    top = next((node for node in nodes if not node.startswith(("Project ", "SubqueryAlias ", "Filter "))), "")
    return top.startswith("ResolvedHint") and "broadcast" in top


def left_join(left: DataFrame, right: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Left equi-join on ``left.on[0] = right.on[1]``; nothing runs while it is planned.

    A right side that ``dimension`` has marked is broadcast. Otherwise sizes at run time decide:
    adaptive execution broadcasts what turns out to be small and splits the partitions of hot
    keys. Rows with a null or blank key, which hardly find a partner, are spread by a salt; a
    right row with a blank key is there for every salt. The right side's join key is kept, as in SQL.
    """
    left_key, right_key = on
    def blank(name: str) -> Column:
        return F.coalesce(F.trim(F.col(f"`{name}`").cast("string")), F.lit("")) == ""

    hashable = [F.col(f"`{f.name}`") for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.when(blank(left_key), F.pmod(F.xxhash64(*hashable), F.lit(SALTS))).otherwise(0)
    salts = F.when(blank(right_key), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = left.withColumn(_SALT, spread.cast("int"))
    matching = right.withColumn(_RIGHT_SALT, F.explode(salts))
    condition = (F.col(f"l.`{left_key}`") == F.col(f"r.`{right_key}`")) & (F.col(_SALT) == F.col(_RIGHT_SALT))
    return salted.alias("l").join(matching.alias("r"), condition, "left").drop(_SALT, _RIGHT_SALT)
