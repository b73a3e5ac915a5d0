"""Rule fan-out: tag each fact with every named rule it satisfies, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fan_out_rules(df: DataFrame, rules: dict[str, Column], out: str = "conversion_desc") -> DataFrame:
    """One output row per (fact, matching rule), named in column ``out``.

    Replaces one scan per rule (and a union) by a single scan with an explode of
    the matching names; a fact can meet several rules.
    """
    names = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    return df.withColumn(out, F.explode(F.filter(names, lambda x: x.isNotNull())))


def set_where(df: DataFrame, col: str, value, cond: Column) -> DataFrame:
    """``UPDATE t SET col = value WHERE cond`` as a projection."""
    cur = F.col(col) if col in df.columns else F.lit(None)
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(cond, v).otherwise(cur))
