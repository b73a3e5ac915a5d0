"""Bug-tracker topic: extract activity, comments, attachments and accounts for a
window; keep the status / product / component dims; conform into ``bug_facts``;
flag first comments; derive the bug conversions and the triage thresholds.

Source tables (names as in the tracker's database): attachments, profiles, bugs,
products, components, bugs_activity, fielddefs, longdescs, bug_status.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.text import concat_strict, literal_contains
from cadence.functions.timefn import QUARTER, Span, date_key, offset_column
from cadence.operators.conform import DimJoin, conform
from cadence.operators.hop import Mondays, calendar_mondays
from cadence.operators.joins import broadcast_bounded, dealt
from cadence.operators.keys import join_keys, semi_join_keys
from cadence.operators.windows import first_event_flag, threshold_rollup
from cadence.plans import names as N
from cadence.plans.common import (CONTRIBUTOR_FACTS, insert_raw, key_range, load_keys, raw_in_window, store_conversions,
                                  stored_between, update_calendar, update_contributors, utc_of_raw)
from cadence.plans.conversions import FACT_KEY, Team, attach_keys, convert, key_by_threshold
from cadence.session import materialised
from cadence.sources.readers import Sources, any_in_window, copy_columns, windowed
from cadence.sources.sinks import Warehouse

RAW = "bug_facts_raw"
ATTACHMENT = "bug_attachment"
FACTS = "bug_facts"
FIRST_COMMENT = "bug_first_comment"
RAW_KEY = ["contributor_email", "local_datetime", "fields", "bug_id", "added_values", "removed_values",
           "attachment_id", "status", "product", "component"]
FACTS_KEY = ["utc_datetime", "fields", "canonical", "added_values", "removed_values", "attachment_key", "bug_id",
             "contributor_key", "product_key", "component_key", "status_key", "utc_date_key"]


# ---------------------------------------------------------------- extracts

def _bug_context(src: Sources) -> DataFrame:
    """bug -> status, product name, component name (inner joins, as the tracker's
    every bug has a product and component)."""
    bugs = src["bugs"].select("bug_id", "product_id", "component_id", "bug_status")
    prod = src["products"].select(F.col("id").alias("_pid"), F.col("name").alias("product"))
    comp = src["components"].select(F.col("id").alias("_cid"), F.col("name").alias("component"))
    return dealt(bugs.join(prod, F.col("product_id") == F.col("_pid"))
                 .join(comp, F.col("component_id") == F.col("_cid"))
                 .select("bug_id", F.col("bug_status").alias("status"), "product", "component"))


def _login(src: Sources, on: str) -> DataFrame:
    return dealt(src["profiles"].select(F.col("userid").alias(on), F.col("login_name")))


def extract_attachments(src: Sources, lo, hi, tz: str | None = None, offset=None) -> DataFrame:
    """Attachments modified OR created in the window, with submitter, product, component."""
    a = src["attachments"].where(any_in_window([("modification_time", lo, hi), ("creation_ts", lo, hi)]))
    j = (a.join(_login(src, "submitter_id"), "submitter_id")
         .join(_bug_context(src), "bug_id"))
    return j.select(F.col("attach_id").alias("attachment_key"), F.col("login_name").alias("email"), "ispatch",
                    "product", "component", F.col("modification_time").alias("local_datetime"),
                    offset_column("modification_time", tz, offset).alias("tz_offset"))


def extract_activity(src: Sources, lo, hi, tz: str | None = None, offset=None) -> DataFrame:
    """Field changes in the window (who, when, which field, added / removed values)."""
    act = windowed(src["bugs_activity"], "bug_when", lo, hi)
    fd = src["fielddefs"].select(F.col("id").alias("fieldid"), F.col("name").alias("fields"))
    j = (act.join(_bug_context(src), "bug_id")
         .join(_login(src, "who"), "who")
         .join(fd, "fieldid"))
    return j.select(F.col("login_name").alias("contributor_email"), F.col("bug_when").alias("local_datetime"),
                    offset_column("bug_when", tz, offset).alias("tz_offset"), "fields", "bug_id",
                    F.col("added").alias("added_values"), F.col("removed").alias("removed_values"),
                    F.col("attach_id").alias("attachment_id"), "status", "product", "component")


def extract_comments(src: Sources, lo, hi, tz: str | None = None, offset=None) -> DataFrame:
    """Comments in the window, tagged with the field name ``comment``."""
    c = windowed(src["longdescs"], "bug_when", lo, hi)
    j = c.join(_bug_context(src), "bug_id").join(_login(src, "who"), "who")
    return j.select(F.col("login_name").alias("contributor_email"), F.col("bug_when").alias("local_datetime"),
                    offset_column("bug_when", tz, offset).alias("tz_offset"), F.lit(N.FIELD_COMMENT).alias("fields"),
                    "bug_id", "status", "product", "component")


def extract_accounts(src: Sources, lo, hi, names: N.Names = N.Names(), tz: str | None = None,
                     offset=None) -> DataFrame:
    """Accounts created in the window (bug 0, empty status / product / component)."""
    p = windowed(src["profiles"], "creation_ts", lo, hi)
    return p.select(F.col("login_name").alias("contributor_email"), F.col("creation_ts").alias("local_datetime"),
                    offset_column("creation_ts", tz, offset).alias("tz_offset"),
                    F.lit(names.bug_account_action).alias("fields"), F.lit(0).cast("long").alias("bug_id"),
                    F.lit("").alias("status"), F.lit("").alias("product"), F.lit("").alias("component"))


def raw_facts(src: Sources, lo, hi, names: N.Names = N.Names(), tz: str | None = None, offset=None) -> DataFrame:
    """Activity, comments and accounts of the window as one raw table."""
    cols = ["contributor_email", "local_datetime", "tz_offset", "fields", "bug_id", "added_values",
            "removed_values", "attachment_id", "status", "product", "component"]
    parts = [extract_activity(src, lo, hi, tz, offset), extract_comments(src, lo, hi, tz, offset),
             extract_accounts(src, lo, hi, names, tz, offset)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*cols)


def status_dim(src: Sources) -> DataFrame:
    return copy_columns(src["bug_status"], {"id": "status_key", "value": "status_name"})


def product_dim(src: Sources) -> DataFrame:
    return copy_columns(src["products"], {"id": "product_key", "name": "product_name"})


def component_dim(src: Sources) -> DataFrame:
    return copy_columns(src["components"], {"id": "component_key", "name": "component_name", "product_id": "product_key"})


# ---------------------------------------------------------------- conform

def conform_facts(raw: DataFrame, contributor: DataFrame, cal: DataFrame, status: DataFrame, product: DataFrame,
                  component: DataFrame, names: N.Names = N.Names(), component_by_product: bool = False) -> DataFrame:
    """``bug_facts`` rows. Status, product and component are matched by name; only a
    missing component becomes the unknown member 0 (status / product stay NULL).

    A component name used under two products matches both (fan-out), unless
    ``component_by_product`` adds the product to the component match.
    """
    if component_by_product:
        comp = component.join(product.select("product_key", F.col("product_name").alias("_pn")), "product_key")
        comp_join = DimJoin(comp, {"component": "component_name", "product": "_pn"},
                            {"component_key": "component_key"}, default={"component_key": 0})
    else:
        comp_join = DimJoin(component, {"component": "component_name"}, {"component_key": "component_key"},
                            default={"component_key": 0})
    out = conform(raw, utc_of_raw(), [
        DimJoin(contributor, {"contributor_email": "email"}, {"contributor_key": "contributor_key"}, how="inner", grows=True),
        DimJoin(status, {"status": "status_name"}, {"status_key": "status_key"}),
        DimJoin(product, {"product": "product_name"}, {"product_key": "product_key"}),
        comp_join,
    ], calendar=cal)
    return out.select("utc_datetime", "fields", concat_strict(names.bug_url, F.col("bug_id")).alias("canonical"),
                      "added_values", "removed_values", F.col("attachment_id").alias("attachment_key"), "bug_id",
                      "contributor_key", "product_key", "component_key", "status_key", "utc_date_key",
                      F.lit(None).cast("int").alias("comment_num"))


def first_comments(wh: Warehouse, batch: DataFrame) -> DataFrame:
    """First comment times of the bugs in ``batch`` (conformed facts): ``_old`` as stored before it
    (NULL if none is), ``_first`` with the batch's own comments.

    ``FIRST_COMMENT`` holds the first time of each bug as seen so far (the least of its rows), so
    the history is not read again. What is compared is the batch, not a range of UTC times: a load
    takes a window of local times, whose UTC times may lie outside it.
    """
    stored = wh.read(FIRST_COMMENT)
    if stored is None:  # facts that were stored without it
        facts = wh.read(FACTS)
        comments = (batch.limit(0) if facts is None else facts).where(F.col("fields") == N.FIELD_COMMENT)
        stored = comments.select("bug_id", F.col("utc_datetime").alias("first_ts"))
    stored = stored.groupBy("bug_id").agg(F.min("first_ts").alias("_old"))
    seen = batch.groupBy("bug_id").agg(F.min(F.when(F.col("fields") == N.FIELD_COMMENT, F.col("utc_datetime"))).alias("_seen"))
    return join_keys(seen, dealt(stored), ["bug_id"], "left").select("bug_id", "_old", F.least("_seen", "_old").alias("_first"))


def with_first_comments(facts: DataFrame, marks: DataFrame) -> DataFrame:
    """``facts`` with ``comment_num = 0`` at the first comment of the bugs that ``marks`` knows, and nowhere else of them."""
    rows = join_keys(facts, dealt(marks.select("bug_id", "_first")), ["bug_id"], "left")
    right = F.when(F.col("_first").isNull(), F.col("comment_num")).when(F.col("utc_datetime") == F.col("_first"), F.lit(0))
    return rows.withColumn("comment_num", right).select(*facts.columns)


def moved_marks(marks: DataFrame) -> DataFrame:
    """The marks that are new or have moved to an older comment."""
    return marks.where(F.col("_first").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_first")))


def restate_facts(wh: Warehouse, moved: DataFrame) -> None:
    """Set and clear ``comment_num`` on stored facts where a mark moved. Only the dates of old and
    new marks are read, and only those on which a flag changes are rewritten."""
    dates = moved.select(F.explode(F.array("_old", "_first")).alias("t")).where(F.col("t").isNotNull()) \
        .select(date_key(F.to_date("t")).alias("utc_date_key"))
    bounds = dates.agg(F.min("utc_date_key"), F.max("utc_date_key")).first()
    if bounds[0] is None:
        return
    days = bounds[1] - bounds[0] + 1  # no fewer than the dates between the two keys
    facts = semi_join_keys(wh.table(FACTS, between=tuple(bounds)), broadcast_bounded(dates.distinct(), known_rows=days), ["utc_date_key"])
    marks = moved.select("bug_id", "_first")
    rows = join_keys(facts, dealt(marks), ["bug_id"], "left")
    right = F.when(F.col("_first").isNull(), F.col("comment_num")).when(F.col("utc_datetime") == F.col("_first"), F.lit(0))
    changed = rows.where(~right.eqNullSafe(F.col("comment_num"))).select("utc_date_key").distinct()
    with materialised(changed) as changed:
        if not changed.isEmpty():
            touched = semi_join_keys(facts, broadcast_bounded(changed, known_rows=days), ["utc_date_key"])
            wh.overwrite_partitions(FACTS, with_first_comments(touched, marks), ["utc_date_key"])


def withdrawn(moved: DataFrame, conversion_dim: DataFrame, names: N.Names = N.Names()) -> DataFrame:
    """Keys of the conversions stored for first comments that are no longer the first ones."""
    gone = moved.where(F.col("_old").isNotNull()).select(
        concat_strict(names.bug_url, F.col("bug_id")).alias("canonical"), F.col("_old").alias("utc_datetime"),
        date_key(F.to_date("_old")).alias("utc_date_key"),
        F.explode(F.array(F.lit(names.file_featured_bug), F.lit(N.FILING_A_BUG))).alias("conversion_desc"))
    return gone.join(conversion_dim.select("conversion_desc", "conversion_key"), "conversion_desc").drop("conversion_desc")


def number_comments(facts: DataFrame, lo, hi) -> DataFrame:
    """``comment_num = 0`` on every fact at the time of a bug's first comment, for
    bugs commented on in ``[lo, hi]`` (UTC)."""
    return first_event_flag(facts, "bug_id", "utc_datetime", F.col("fields") == N.FIELD_COMMENT, lo, hi,
                            flag="comment_num", value=0)


# ---------------------------------------------------------------- conversions

def conversion_names(names: N.Names = N.Names()) -> list[str]:
    """The single-action bug conversions, in rule order."""
    return [names.file_featured_bug, names.bug_account_action, N.FILING_A_BUG, N.SUBMITTING_PATCH,
            N.PATCH_APPROVED, N.CHANGE_PRODUCT, N.CHANGE_COMPONENT, N.CHANGE_STATUS, N.COMMENT_ONE]


def conversion_rules(names: N.Names = N.Names()) -> dict:
    fields, first = F.col("fields"), F.col("comment_num") == 0
    patch = F.col("ispatch") == 1
    return {
        names.file_featured_bug: first & (F.col("product_name") == names.featured_product),
        names.bug_account_action: fields == names.bug_account_action,
        N.FILING_A_BUG: first,
        N.SUBMITTING_PATCH: patch,
        # the flag value is matched literally: "review-" or "review?" do not count
        N.PATCH_APPROVED: (fields == N.FIELD_FLAGS) & literal_contains("added_values", N.REVIEW_GRANTED) & patch,
        N.CHANGE_PRODUCT: literal_contains(fields, "product"),
        N.CHANGE_COMPONENT: literal_contains(fields, "component"),
        N.CHANGE_STATUS: literal_contains(fields, "bug_status"),
        N.COMMENT_ONE: fields == N.FIELD_COMMENT,
    }


def conversions(facts: DataFrame, product: DataFrame, attachment: DataFrame, conversion_dim: DataFrame,
                source_dim: DataFrame, team_dim: DataFrame, lo=None, hi=None, names: N.Names = N.Names()) -> DataFrame:
    """All single-action bug conversions of ``facts`` (in ``[lo, hi]`` UTC, if given) in one pass.

    Patch conversions take the team named like the bug's product (0 when none);
    the others store team 0.
    """
    f = facts if lo is None else windowed(facts, "utc_datetime", lo, hi)
    f = f.join(product.select("product_key", "product_name"), "product_key", "left")
    # attachment_key is the attachment table's key, so this join does not fan out; most facts have
    # none and stay out of it, as they would all be dealt to one task
    has = F.col("attachment_key").isNotNull()
    patches = dealt(attachment.select("attachment_key", "ispatch"))
    f = f.where(has).join(patches, "attachment_key", "left").unionByName(
        f.where(~has).withColumn("ispatch", F.lit(None).cast(patches.schema["ispatch"].dataType)))
    rows = convert(f, conversion_rules(names))
    patch_rules = F.col("conversion_desc").isin(N.SUBMITTING_PATCH, N.PATCH_APPROVED)
    rows = rows.withColumn("_team_name", F.when(patch_rules, F.col("product_name")))
    return attach_keys(rows, conversion_dim, source_dim, names.bugs_source, Team(by_column="_team_name", default=0),
                       team_dim)


def triage_thresholds(contributor_facts: DataFrame, conversion_dim: DataFrame, mondays: Mondays,
                      thresholds: Sequence[int] = (10, 25, 50, 100), names: N.Names = N.Names(),
                      span: Span = QUARTER, distinct_bugs: bool = False) -> DataFrame:
    """Rows for "Help triage N bugs per quarter", as seen each Monday.

    As written, a group is (contributor, single-action conversion, bug), i.e. N
    actions of one kind on one bug; ``distinct_bugs`` counts what the name says, N
    distinct bugs of a contributor by any of the actions.
    """
    single = conversion_dim.where(F.col("conversion_desc").isin(*N.TRIAGE_SINGLE)).select("conversion_key")
    f = contributor_facts.join(single, "conversion_key", "left_semi") \
        .withColumnRenamed("conversion_key", "single_key")
    # source and team are the same for all rows of a contributor's bug conversions
    if distinct_bugs:
        r = threshold_rollup(f, ["contributor_key"], "utc_datetime", mondays, span, thresholds, canon="canonical",
                             concat="list", distinct_of="canonical")
        r = r.join(f.groupBy("contributor_key").agg(F.max("source_key").alias("source_key"), F.max("team_key").alias("team_key")), "contributor_key")
    else:
        r = threshold_rollup(f, ["contributor_key", "single_key", "source_key", "team_key", "canonical"], "utc_datetime", mondays, span,
                             thresholds, canon="canonical", concat="repeat")
    r = key_by_threshold(r, conversion_dim, thresholds, names.triage)
    return r.select("canonical", "utc_datetime", F.lit(1).alias("cnt"),
                    date_key(F.to_date("utc_datetime")).alias("utc_date_key"),
                    "contributor_key", "conversion_key", "source_key", "team_key")


# ---------------------------------------------------------------- job

def load_batch(wh: Warehouse, facts: DataFrame, conversion_dim: DataFrame, source_dim: DataFrame, team_dim: DataFrame,
               lo, hi, names: N.Names = N.Names()) -> None:
    """Store the facts of one load and the conversions that follow from it.

    Conversions are those of the batch, whatever its UTC times, and of stored facts at a first
    comment that the batch moved or made known. Where an older comment arrives, the "filing"
    conversions of the former first comment are withdrawn and those of the older one stored,
    by one write: in whichever order windows are loaded, the same conversions are stored.
    The marks are stored last, so that a job lost on the way finds them as they were and does all of it again.
    """
    with materialised(facts) as batch, materialised(first_comments(wh, batch)) as marks:
        flagged = with_first_comments(batch, marks)
        wh.insert_new(FACTS, flagged, FACTS_KEY, partition_by=["utc_date_key"], within=load_keys(lo, hi))
        with materialised(moved_marks(marks)) as moved:
            restate_facts(wh, moved)
            first = moved.select("bug_id", F.col("_first").alias("utc_datetime"))
            bounds = first.agg(F.min("utc_datetime"), F.max("utc_datetime")).first()
            if bounds[0] is not None:
                flagged = flagged.unionByName(semi_join_keys(stored_between(wh, FACTS, *bounds), dealt(first), ["bug_id", "utc_datetime"]))
            rows = conversions(flagged, wh.table("bug_product"), wh.table(ATTACHMENT), conversion_dim, source_dim, team_dim, names=names)
            wh.exchange(CONTRIBUTOR_FACTS, rows, withdrawn(moved, conversion_dim, names), FACT_KEY,
                        ["conversion_key", "canonical", "utc_datetime"], ["utc_date_key"], within=load_keys(lo, hi))
            wh.insert_new(FIRST_COMMENT, moved.select("bug_id", F.col("_first").alias("first_ts")), ["bug_id", "first_ts"])


def run(wh: Warehouse, src: Sources, lo, hi, conversion_dim: DataFrame, source_dim: DataFrame, team_dim: DataFrame,
        names: N.Names = N.Names(), tz: str | None = None, offset=None,
        triage_thresholds_list: Sequence[int] = (10, 25, 50, 100)) -> None:
    """The bug topic for window ``[lo, hi]``; every step is idempotent."""
    # a member keeps the name under which it was first copied
    wh.insert_new("bug_product", product_dim(src), ["product_key"])
    wh.insert_new("bug_component", component_dim(src), ["component_key"])
    wh.insert_new("bug_status", status_dim(src), ["status_key"])
    wh.insert_new(ATTACHMENT, extract_attachments(src, lo, hi, tz, offset).withColumn("key_range", F.expr("attachment_key div 100000")),
                  ["attachment_key"], partition_by=["key_range"])
    raw = insert_raw(wh, RAW, raw_facts(src, lo, hi, names, tz, offset), RAW_KEY, lo, hi)
    cal = update_calendar(wh, raw)
    contributor = update_contributors(wh, [
        raw.select(F.col("contributor_email").alias("email")),
        raw_in_window(wh.table(ATTACHMENT), lo, hi).select("email")])
    facts = conform_facts(raw, contributor, cal, wh.table("bug_status"), wh.table("bug_product"),
                          wh.table("bug_component"), names)
    load_batch(wh, facts, conversion_dim, source_dim, team_dim, lo, hi, names)
    mondays = calendar_mondays(wh.table("utc_date_only"), lo, hi)
    if not mondays.empty:
        cf = stored_between(wh, CONTRIBUTOR_FACTS, mondays.first, mondays.last, QUARTER)
        store_conversions(wh, triage_thresholds(cf, conversion_dim, mondays, triage_thresholds_list, names),
                          within=key_range(mondays.first, mondays.last, QUARTER))


__all__ = ["extract_attachments", "extract_activity", "extract_comments", "extract_accounts", "raw_facts",
           "conform_facts", "number_comments", "load_batch", "conversions", "triage_thresholds", "run"]
