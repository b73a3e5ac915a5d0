"""Aggregates: ordered, optionally length-capped list concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.operators.keys import join_keys


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def ordered_list(ts: str, value: str, max_len: int | None = None) -> Column:
    """Aggregate: values joined by ',' in (ts, value) order, NULLs skipped, NULL when
    no value; cut to ``max_len`` characters when given."""
    arr = F.array_sort(F.collect_list(F.struct(F.col(ts), F.col(value))))
    s = F.array_join(F.transform(arr, lambda x: x[value]), ",")
    if max_len is not None:
        s = F.substring(s, 1, max_len)
    return F.when(F.count(F.col(value)) > 0, s)


#: Salts a group's values are spread over before their heads meet in one task.
HEAD_SALTS = 32


def list_head(df: DataFrame, group: Sequence[str], ts: str, value: str, max_len: int) -> DataFrame:
    """The rows of ``df`` whose value can reach the first ``max_len`` characters of its
    group's ordered list. NULL values never do, and do not count.

    A value starts after the characters (and commas) of the values before it; one that
    starts right after the last character kept still puts its comma there. That is
    judged twice: first within a salt of the group, where fewer values come before, so
    nothing is lost; then among what is left, at most HEAD_SALTS times ``max_len``
    characters a group, however many rows the group has and whatever the session's settings.
    """
    size = F.char_length(F.col(value).cast("string")) + 1
    out = df.where(F.col(value).isNotNull()).withColumn("_salt", F.pmod(F.xxhash64(ts, value), F.lit(HEAD_SALTS)))
    for keys in ([*group, "_salt"], list(group)):
        before = Window.partitionBy(*keys).orderBy(F.col(ts), F.col(value)).rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("_at", F.coalesce(F.sum(size).over(before), F.lit(0))).where(F.col("_at") <= max_len).drop("_at")
    return out.drop("_salt")


#: Values of a group that one task puts in order; a larger group is put together from fragments of as many.
FRAGMENT_VALUES = 1 << 16


def whole_lists(df: DataFrame, group: Sequence[str], ts: str, value: str, out: str = "canonical") -> DataFrame:
    """``group`` -> its values joined by ',' in (ts, value) order, NULLs skipped, whatever their number.

    Two levels: equal values are counted first; all are dealt to tasks by range, so that a task
    holds a stretch of a group, whose fragments of at most FRAGMENT_VALUES different values become
    strings; these few strings meet in one task and are joined in order. No task ever holds a
    large group's values as rows; only its one result string is as long as it has to be.
    """
    group = list(group)
    rows = df.where(F.col(value).isNotNull()).groupBy(*group, F.col(ts).alias("_t"), F.col(value).cast("string").alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
    rows = rows.repartitionByRange(*[F.col(g) for g in group], "_t", "_v").withColumn("_stretch", F.spark_partition_id())
    place = Window.partitionBy(*group, "_stretch").orderBy("_t", "_v")
    rows = rows.withColumn("_fragment", F.floor((F.row_number().over(place) - 1) / FRAGMENT_VALUES))
    ordered = F.array_sort(F.collect_list(F.struct("_t", "_v", "_k")))
    text = F.array_join(F.transform(ordered, lambda x: F.array_join(F.array_repeat(x["_v"], x["_k"].cast("int")), ",")), ",")
    fragments = rows.groupBy(*group, "_stretch", "_fragment").agg(text.alias("_text"), F.min(F.struct("_t", "_v")).alias("_first"))
    parts = F.array_sort(F.collect_list(F.struct("_first", "_text")))
    return fragments.groupBy(*group).agg(F.array_join(F.transform(parts, lambda x: x["_text"]), ",").alias(out))


def group_ordered_list(df: DataFrame, group: Sequence[str] | str, ts: str, value: str,
                       max_len: int | None = None, out: str = "canonical",
                       extra: Sequence[Column] = ()) -> DataFrame:
    """``group`` -> ordered list of ``value`` (see :func:`ordered_list`) plus ``extra``
    aggregates over all rows of the group.

    With ``max_len`` only the values that can appear in the result are collected (see
    :func:`list_head`). Groups compare NULL-safely, and a group without any value has
    a NULL list.
    """
    group = _cols(group)
    if max_len is None:
        # one small aggregation says whether any group is too large for a task to put in order at once
        most = df.where(F.col(value).isNotNull()).groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if (most or 0) <= FRAGMENT_VALUES:
            return df.groupBy(*group).agg(ordered_list(ts, value).alias(out), *extra)
        every = df.groupBy(*group).agg(*extra) if extra else df.select(*group).distinct()
        joined = join_keys(every, whole_lists(df, group, ts, value, out), group, "left")
        return joined.select(*group, out, *[c for c in joined.columns if c not in group and c != out])
    lists = list_head(df, group, ts, value, max_len).groupBy(*group).agg(ordered_list(ts, value, max_len).alias(out))
    every = df.groupBy(*group).agg(*extra) if extra else df.select(*group).distinct()
    return join_keys(every, lists, group, "left")
