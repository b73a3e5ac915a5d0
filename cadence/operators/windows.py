"""Window-like operators: first event per entity, trailing thresholds as seen each
Monday, trailing snapshots, and the first-time flag over a snapshot.

Skew: every operator pre-aggregates per (group, day bucket) before the hop
explode, so a key holding a third of all rows contributes at most a few hundred
rows per reporting Monday to the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.timefn import Span, between_ts, shift_back
from cadence.operators.hop import (AS_OF, Mondays, day_bucket_cols, first_monday_at_or_after, hop_explode,
                                  last_monday_counting, relevant_rows)
from cadence.operators.aggregates import list_head
from cadence.operators.joins import broadcast_bounded
from cadence.operators.keys import join_keys, semi_join_keys


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# ---------------------------------------------------------------- first event

def first_event_marks(facts: DataFrame, entity: str, ts: str, is_event: Column, lo=None, hi=None) -> DataFrame:
    """(entity, ``_first_ts``): time of each entity's first event over all history,
    for entities with an event inside ``[lo, hi]`` (all entities without bounds).
    One partial+final aggregation per entity: skew-safe, one pass over the facts."""
    events = facts.where(is_event)
    if lo is None or hi is None:
        return events.groupBy(entity).agg(F.min(ts).alias("_first_ts"))
    # one aggregation gives both the first time and whether the window touched the entity
    touched = F.max(between_ts(ts, lo, hi).cast("int")).alias("_touched")
    return (events.groupBy(entity).agg(F.min(ts).alias("_first_ts"), touched)
            .where(F.col("_touched") == 1).drop("_touched"))


def apply_marks(facts: DataFrame, marks: DataFrame, entity: str, ts: str, flag: str, value: int = 0) -> DataFrame:
    """Set ``flag = value`` on facts at (entity, first time); others keep their flag."""
    m = marks.select(F.col(entity).alias("_fe_entity"), F.col("_first_ts"))
    cur = F.col(flag) if flag in facts.columns else F.lit(None).cast("int")
    joined = facts.join(m, (F.col(entity) == F.col("_fe_entity")) & (F.col(ts) == F.col("_first_ts")), "left")
    return (joined.withColumn(flag, F.when(F.col("_first_ts").isNotNull(), F.lit(value)).otherwise(cur))
            .drop("_fe_entity", "_first_ts"))


def first_event_flag(facts: DataFrame, entity: str, ts: str, is_event: Column,
                     lo=None, hi=None, flag: str = "comment_num", value: int = 0) -> DataFrame:
    """Set ``flag = value`` on every fact of an entity at the time of its first event.

    The first event is the earliest time over all history among rows where
    ``is_event``; only entities with such an event inside ``[lo, hi]`` are
    (re)flagged. Every fact at that (entity, time) gets the flag, whatever its kind.
    Other rows keep their current ``flag`` (NULL when the column is new).

    Plan: one partial+final aggregation per entity (skew-safe) and an equi join back
    on (entity, time), which spreads a hot entity's facts over their times.
    """
    return apply_marks(facts, first_event_marks(facts, entity, ts, is_event, lo, hi), entity, ts, flag, value)


# ------------------------------------------------------------ trailing window

def trailing_window(df: DataFrame, ts: str, lo, hi, span: Span) -> DataFrame:
    """Rows with ``lo - span <= ts <= hi`` (a trailing span before the window, no hop)."""
    from cadence.functions.timefn import to_ntz
    return df.where(F.col(ts).between(shift_back(to_ntz(lo), span), to_ntz(hi)))


# ------------------------------------------------------------ ordered concat

def _join_sorted(arr: Column, sort_field: str, value_field: str, max_len: int | None) -> Column:
    s = F.array_join(F.transform(F.array_sort(arr), lambda x: x[value_field]), ",")
    return F.substring(s, 1, max_len) if max_len is not None else s


# --------------------------------------------------------- threshold rollup

def threshold_rollup(facts: DataFrame, group: Sequence[str] | str, ts: str, mondays: Mondays,
                     span: Span, thresholds: Sequence[int], canon: str | None = None,
                     concat: str = "list", max_len: int | None = None,
                     distinct_of: str | None = None, method: str = "auto") -> DataFrame:
    """Groups that reach ``n >= threshold`` facts in ``[D - span, D]``, for each Monday D.

    Output: ``group``, ``as_of`` (the Monday), ``cnt``, ``utc_datetime`` (latest fact
    time in the window), ``canonical`` (see ``concat``) and ``threshold`` (one row
    per threshold met; thresholds nest, so 30 facts meet both 10 and 25).

    ``concat``:
      * ``"list"``: canonicals ordered by (time, value), comma joined, cut to
        ``max_len`` characters when given (NULLs skipped; NULL when none),
      * ``"repeat"``: ``canon`` is part of ``group``, so the list is that value
        repeated ``cnt`` times (no list is collected at all),
      * ``None``: no canonical column.
    ``distinct_of``: count distinct values of this column instead of rows.
    ``method``: ``"runs"`` (difference array over runs of Mondays; counts and
    repeat lists only), ``"explode"`` (one row per bucket and Monday), or
    ``"auto"`` (runs when they apply).
    """
    group = _cols(group)
    th = sorted({int(t) for t in thresholds})
    if mondays.empty or not th:
        raise ValueError("need at least one Monday and one threshold")
    runs_apply = concat in ("repeat", None) and distinct_of is None and not (span.months and span.days)
    if method == "runs" and not runs_apply:
        raise ValueError("the runs method takes counts or repeat lists, and a span in months or in days")
    if runs_apply and method in ("auto", "runs"):
        return _threshold_by_runs(facts, group, ts, mondays, span, th, canon if concat == "repeat" else None)
    base = facts.where(relevant_rows(F.col(ts), mondays, span))
    bcols = day_bucket_cols(ts)
    bkeys = group + ["_bucket_day", "_bucket_midnight"]
    base = base.select(*[F.col(c) for c in group], F.col(ts),
                       *([F.col(canon)] if canon and canon not in group else []),
                       *([F.col(distinct_of)] if distinct_of and distinct_of not in group and distinct_of != canon else []),
                       *bcols)

    if distinct_of:
        # one row per (group, value, bucket); after the hop one row per (group, Monday, value)
        bk = bkeys + [distinct_of]
        buckets = base.where(F.col(distinct_of).isNotNull()).groupBy(*bk).agg(F.max(ts).alias("_max"), F.min(ts).alias("_min"))
        if method == "auto" and not (span.months and span.days):
            # only buckets of groups that reach the least threshold somewhere are exploded, to such Mondays only
            reached = _reached_by_distinct(buckets, group, distinct_of, mondays, span, th[0])
            buckets = semi_join_keys(buckets, reached.select(*group).distinct(), group)
            hop = semi_join_keys(hop_explode(buckets, "_max", mondays, span), reached, group + [AS_OF])
        else:
            hop = hop_explode(buckets, "_max", mondays, span)
        per_value = hop.groupBy(*group, AS_OF, distinct_of).agg(F.min("_min").alias("_first"),
                                                                F.max("_max").alias("_last"))
        agg = [F.count(F.lit(1)).alias("cnt"), F.max("_last").alias("utc_datetime")]
        if concat == "list":
            agg.append(_join_sorted(F.collect_list(F.struct(F.col("_first"), F.col(distinct_of))),
                                    "_first", distinct_of, max_len).alias("canonical"))
        out = per_value.groupBy(*group, AS_OF).agg(*agg)
    else:
        bagg = [F.count(F.lit(1)).alias("_n"), F.max(ts).alias("_max"), F.min(ts).alias("_min")]
        if concat == "list":
            listed = _join_sorted(F.collect_list(F.struct(F.col(ts), F.col(canon))), ts, canon, max_len).alias("_s")
            bagg.append(F.count(canon).alias("_nn"))
            if max_len is None:
                buckets = base.groupBy(*bkeys).agg(*bagg, listed)
            else:
                # counts over all rows; the list only over the values that can reach its first characters
                heads = list_head(base, bkeys, ts, canon, max_len).groupBy(*bkeys).agg(listed)
                buckets = join_keys(base.groupBy(*bkeys).agg(*bagg), heads, bkeys, "left")
            buckets = buckets.withColumn("_s", F.when(F.col("_nn") > 0, F.col("_s")))
        else:
            buckets = base.groupBy(*bkeys).agg(*bagg)
        lists_by_runs = concat == "list" and method == "auto" and not (span.months and span.days)
        if lists_by_runs:
            # the run counts say which Mondays qualify; a Monday's list is a slice of its group's texts,
            # so neither buckets nor texts are copied to the Mondays they count for
            counts = _counts_by_runs(buckets.select(*group, "_n", F.col("_max").alias("_rep")), group, mondays,
                                     span, th[0])
            out = _listed_by_slices(counts, buckets, group, mondays, span, max_len)
        else:
            hop = hop_explode(buckets, "_max", mondays, span)
            agg = [F.sum("_n").alias("cnt"), F.max("_max").alias("utc_datetime")]
            if concat == "list":
                agg += [F.sum("_nn").alias("_nn"),
                        _join_sorted(F.collect_list(F.struct(F.col("_min"), F.col("_s"))), "_min", "_s", max_len)
                        .alias("canonical")]
            out = hop.groupBy(*group, AS_OF).agg(*agg)
        if concat == "list" and not lists_by_runs:
            out = out.withColumn("canonical", F.when(F.col("_nn") > 0, F.col("canonical"))).drop("_nn")
        elif concat == "repeat":
            out = out.withColumn("canonical", F.array_join(F.array_repeat(F.col(canon), F.col("cnt").cast("int")), ","))
    out = out.withColumn("cnt", F.col("cnt").cast("long"))
    if len(th) == 1:
        return out.where(F.col("cnt") >= th[0]).withColumn("threshold", F.lit(th[0]))
    met = F.filter(F.array(*[F.lit(t) for t in th]), lambda t: t <= F.col("cnt"))
    return out.where(F.col("cnt") >= th[0]).withColumn("threshold", F.explode(met))


def _day_buckets(facts: DataFrame, group: list[str], ts: str, mondays: Mondays, span: Span) -> DataFrame:
    base = facts.where(relevant_rows(F.col(ts), mondays, span))
    return (base.select(*group, F.col(ts), *day_bucket_cols(ts))
            .groupBy(*group, "_bucket_day", "_bucket_midnight")
            .agg(F.count(F.lit(1)).alias("_n"), F.max(ts).alias("_rep")))


def _counts_by_runs(buckets: DataFrame, group: list[str], mondays: Mondays, span: Span,
                    min_count: int) -> DataFrame:
    """(group, ``as_of``, ``cnt``, ``utc_datetime``) for the Mondays where the group
    has at least ``min_count`` facts in ``[D - span, D]``, from a difference array
    over runs of Mondays.

    ``buckets``: one row per (group, day bucket) with the fact count ``_n`` and the
    latest time ``_rep``. Each day bucket adds its fact count to every Monday of its run; per group the
    +n (run start) / -n (after run end) changes are summed in date order, giving a
    count that is constant between change points. The latest fact time in the
    window is that of the latest bucket started (runs end in time order). Only
    constant segments reaching ``min_count`` are exploded into Mondays, so the rows
    emitted are result rows. Per group the window holds at most four change points
    per day, however many facts the group has.
    """
    lo, hi = F.lit(mondays.first), F.lit(mondays.last)
    runs = (buckets.select(*group, "_n", "_rep",
                           F.greatest(first_monday_at_or_after(F.col("_rep")), lo).alias("_from"),
                           F.least(last_monday_counting(F.col("_rep"), span), hi).alias("_to"))
            .where(F.col("_from") <= F.col("_to")))
    changes = runs.select(*group, F.explode(F.array(
        F.struct(F.col("_from").alias("d"), F.col("_n").alias("delta"), F.col("_rep").alias("rep")),
        F.struct(F.date_add("_to", 7).alias("d"), (-F.col("_n")).alias("delta"),
                 F.lit(None).cast("timestamp_ntz").alias("rep")))).alias("_c"))
    points = (changes.groupBy(*group, F.col("_c.d").alias("_d"))
              .agg(F.sum("_c.delta").alias("_delta"), F.max("_c.rep").alias("_rep")))
    w = Window.partitionBy(*group).orderBy("_d")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    seg = points.select(*group, "_d", F.sum("_delta").over(upto).alias("cnt"),
                        F.max("_rep").over(upto).alias("utc_datetime"),
                        F.lead("_d").over(w).alias("_next"))
    seg = seg.where((F.col("cnt") >= min_count) & F.col("_next").isNotNull())
    out = seg.select(*group, F.col("cnt").cast("long").alias("cnt"), "utc_datetime",
                     F.explode(F.sequence("_d", F.date_sub("_next", 7), F.expr("INTERVAL 7 DAYS"))).alias(AS_OF))
    if mondays.df is not None:
        out = out.join(broadcast_bounded(mondays.df, known_rows=mondays.max_rows), AS_OF, "left_semi")
    return out


def _listed_by_slices(counts: DataFrame, buckets: DataFrame, group: list[str], mondays: Mondays, span: Span,
                      max_len: int | None) -> DataFrame:
    """``counts`` (group, Monday) with ``canonical``, the ordered list of the texts ``_s`` of the
    buckets that count for the Monday.

    Every group becomes one row, its buckets' texts in time order; those that count for a
    Monday lie side by side in it, from the first bucket not before ``D - span`` to the last
    not after ``D``. A list can begin only where a week's buckets cease to count. So of the
    buckets that cease on one Monday only those are kept that begin within the first
    ``max_len`` characters: a group's row holds at most that much text a week, however many facts it has.
    """
    kept = buckets.where(F.col("_s").isNotNull()).select(*group, "_min", "_max", "_s")
    if max_len is not None:
        kept = kept.withColumn("_to", F.least(last_monday_counting(F.col("_max"), span), F.lit(mondays.last)))
        before = Window.partitionBy(*group, "_to").orderBy("_min").rowsBetween(Window.unboundedPreceding, -1)
        kept = kept.withColumn("_at", F.coalesce(F.sum(F.char_length("_s") + 1).over(before), F.lit(0))).where(F.col("_at") <= max_len)
    texts = kept.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_min", "_max", "_s"))).alias("_texts"))
    out = join_keys(counts, texts, group, "left")
    until = F.col(AS_OF).cast("timestamp_ntz")
    since = shift_back(until, span)
    own = F.transform(F.filter("_texts", lambda x: x["_max"].between(since, until)), lambda x: x["_s"])
    listed = F.array_join(own, ",") if max_len is None else F.substring(F.array_join(own, ","), 1, max_len)
    return out.withColumn("canonical", F.when(F.size(own) > 0, listed)).drop("_texts")


def _threshold_by_runs(facts: DataFrame, group: list[str], ts: str, mondays: Mondays, span: Span,
                       th: list[int], repeat_of: str | None) -> DataFrame:
    """Count thresholds (optionally with a repeat list) from :func:`_counts_by_runs`."""
    out = _counts_by_runs(_day_buckets(facts, group, ts, mondays, span), group, mondays, span, th[0])
    out = out.withColumn("cnt", F.col("cnt").cast("long"))
    if repeat_of is not None:
        out = out.withColumn("canonical", F.array_join(F.array_repeat(F.col(repeat_of), F.col("cnt").cast("int")), ","))
    if len(th) == 1:
        return out.withColumn("threshold", F.lit(th[0]))
    met = F.filter(F.array(*[F.lit(t) for t in th]), lambda t: t <= F.col("cnt"))
    return out.withColumn("threshold", F.explode(met))


# ---------------------------------------------------------- trailing snapshot

def trailing_distinct(facts: DataFrame, keys: Sequence[str] | str, ts: str, mondays: Mondays,
                      span: Span) -> DataFrame:
    """Distinct ``keys`` seen in ``[D - span, D]``, for each Monday D (column ``as_of``).

    Every fact counts for a contiguous run of Mondays, from the first Monday at or
    after it to the last Monday whose window still reaches back to it. Facts are
    reduced to one row per (keys, day bucket), each bucket's run of Mondays is
    computed exactly, overlapping runs of the same keys are merged (a window over
    the keys' buckets, ordered by run start), and only the merged runs are
    exploded. The explode therefore emits exactly the output rows, with no
    duplicates to remove, whatever the number of facts per key; a key holding a
    third of all rows still has at most two buckets per day.
    """
    keys = _cols(keys)
    if span.months and span.days:
        return _trailing_distinct_by_explode(facts, keys, ts, mondays, span)
    base = facts.where(relevant_rows(F.col(ts), mondays, span))
    buckets = (base.select(*keys, F.col(ts), *day_bucket_cols(ts))
               .groupBy(*keys, "_bucket_day", "_bucket_midnight").agg(F.max(ts).alias("_rep")))
    islands = _islands(buckets, keys, mondays, span)
    out = islands.select(*keys, F.explode(F.sequence("_from", "_to", F.expr("INTERVAL 7 DAYS"))).alias(AS_OF))
    if mondays.df is not None:
        listed = broadcast_bounded(mondays.df, known_rows=mondays.max_rows)
        out = out.join(listed, AS_OF, "left_semi")
    return out


def _islands(buckets: DataFrame, keys: list[str], mondays: Mondays, span: Span) -> DataFrame:
    """Runs of Mondays (``_from``, ``_to``) in which ``keys`` are seen, overlapping ones merged,
    from one row per (keys, day bucket) with a time ``_rep`` of the bucket."""
    lo, hi = F.lit(mondays.first), F.lit(mondays.last)
    runs = (buckets
            .select(*keys, F.greatest(first_monday_at_or_after(F.col("_rep")), lo).alias("_from"),
                    F.least(last_monday_counting(F.col("_rep"), span), hi).alias("_to"))
            .where(F.col("_from") <= F.col("_to")))
    w = Window.partitionBy(*keys).orderBy("_from", "_to")
    reach = F.max("_to").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reach.isNull() | (F.col("_from") > reach), 1).otherwise(0)
    runs = runs.withColumn("_island", F.sum(starts).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "_island").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))


def _reached_by_distinct(buckets: DataFrame, group: list[str], value: str, mondays: Mondays, span: Span,
                         min_count: int) -> DataFrame:
    """(group, ``as_of``) where at least ``min_count`` distinct values count: +1 where a run of
    Mondays of (group, value) begins and -1 after its end, summed in date order; only the
    segments that reach the count are exploded."""
    islands = _islands(buckets.select(*group, value, F.col("_max").alias("_rep")), [*group, value], mondays, span)
    changes = islands.select(*group, F.explode(F.array(
        F.struct(F.col("_from").alias("d"), F.lit(1).alias("delta")),
        F.struct(F.date_add("_to", 7).alias("d"), F.lit(-1).alias("delta")))).alias("_c"))
    points = changes.groupBy(*group, F.col("_c.d").alias("_d")).agg(F.sum("_c.delta").alias("_delta"))
    w = Window.partitionBy(*group).orderBy("_d")
    seg = points.select(*group, "_d", F.sum("_delta").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_cnt"),
                        F.lead("_d").over(w).alias("_next")).where((F.col("_cnt") >= min_count) & F.col("_next").isNotNull())
    return seg.select(*group, F.explode(F.sequence("_d", F.date_sub("_next", 7), F.expr("INTERVAL 7 DAYS"))).alias(AS_OF))


def _trailing_distinct_by_explode(facts: DataFrame, keys: list[str], ts: str, mondays: Mondays,
                                  span: Span) -> DataFrame:
    base = facts.where(relevant_rows(F.col(ts), mondays, span))
    buckets = (base.select(*keys, F.col(ts), *day_bucket_cols(ts))
               .groupBy(*keys, "_bucket_day", "_bucket_midnight").agg(F.max(ts).alias("_max")))
    hop = hop_explode(buckets, "_max", mondays, span)
    return hop.select(*keys, AS_OF).distinct()


# ------------------------------------------------------------ first-time flag

def _range_interval(span: Span) -> str:
    if span.months and span.days:
        raise ValueError("first_time_flag takes a span in months or in days, not both")
    return f"INTERVAL '{span.months}' MONTH" if span.months else f"INTERVAL '{span.days}' DAY"


def first_time_flag(snapshot: DataFrame, entity: str, date_col: str, span: Span,
                    flag: str = "is_new") -> DataFrame:
    """``flag = 1`` on rows whose entity has exactly one snapshot row in
    ``[date - span, date]`` (that row itself), else 0.

    Two rows on the same first date (e.g. two teams) make neither new. The frame
    is a RANGE frame on the date, partitioned by entity: a partition holds one
    entity's snapshot rows, bounded by the number of reporting dates, not by facts.
    """
    n = F.expr(f"count(1) OVER (PARTITION BY `{entity}` ORDER BY `{date_col}` "
               f"RANGE BETWEEN {_range_interval(span)} PRECEDING AND CURRENT ROW)")
    return snapshot.withColumn(flag, F.when(n == 1, 1).otherwise(0))
