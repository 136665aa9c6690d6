"""Field observations: intake rules, listing, status changes and roll-ups.

``as_of`` is always an argument, so that results can be reproduced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnibus import params
from omnibus.functions import clock
from omnibus.functions.measures import code_title
from omnibus.operators.asof import last_before
from omnibus.operators.dedupe import keep_first, keep_last
from omnibus.operators.skew import rekeyed
from omnibus.operators.spacing import keep_spaced

SPACING_KEYS = ["qr_code_id", "anonymous_identifier"]


def _outside(text: Column, longest: int) -> Column:
    """Missing, empty or too long."""
    return text.isNull() | ~F.length(text).between(1, longest)


def invalid_submission() -> Column:
    known = lambda c, values: F.coalesce(F.col(c).isin(*values), F.lit(False))
    beyond = lambda c, bound: F.coalesce(~F.col(c).between(-bound, bound), F.lit(False))
    return (
        _outside(F.col("qr_token"), 50)
        | ~known("problem_type", params.PROBLEM_TYPES)
        | ~known("severity", params.SEVERITIES)
        | (F.coalesce(F.length("description"), F.lit(0)) > 1000)
        | F.col("observed_at").isNull()
        | F.col("created_at").isNull()
        | beyond("latitude", 90.0)
        | beyond("longitude", 180.0)
        | _outside(F.col("anonymous_identifier"), 100)
    )


def screen(submissions: DataFrame, qr_codes: DataFrame) -> DataFrame:
    """Verdicts that need no look at other submissions; NULL where one is needed.

    Adds qr_code_id and the route and bus of the code.
    """
    codes = qr_codes.select(
        "qr_token", F.col("id").alias("qr_code_id"), "bus_number", "route_id", "is_active"
    )
    verdict = (
        F.when(invalid_submission(), "invalid")
        .when(F.col("qr_code_id").isNull(), "unknown_token")
        .when(~F.col("is_active"), "inactive_token")
    )
    return submissions.join(codes, "qr_token", "left").withColumn("verdict", verdict).drop("is_active")


def classify(
    submissions: DataFrame,
    qr_codes: DataFrame,
    window_minutes: int = params.DUPLICATE_WINDOW_MINUTES,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Every submission with one verdict.

    ``recent`` holds the accepted rows (keys, accepted_at) of earlier batches near
    this one.  Those verdicts stand, so a row within the window on either side
    of one is a duplicate; rows farther off don't depend on it.
    """
    screened = screen(submissions, qr_codes)
    window = F.make_dt_interval(mins=F.lit(window_minutes))
    if recent is not None:
        # A key has one accepted row per window at most, so few rows meet a submission.
        near = rekeyed(recent, *SPACING_KEYS)
        beside = [screened[k] == near[k] for k in SPACING_KEYS] + [
            screened["created_at"].between(near["accepted_at"] - window, near["accepted_at"] + window)
        ]
        held = screened.join(near, beside, "left_semi").withColumn("verdict", F.coalesce("verdict", F.lit("duplicate")))
        screened = screened.join(near, beside, "left_anti").unionByName(held)
    kept = keep_spaced(
        screened.where(F.col("verdict").isNull()), SPACING_KEYS, "created_at", "id", window_minutes * 60
    )
    # Ids may repeat, so a verdict goes back to its key and instant as well.
    own = [*SPACING_KEYS, "created_at", "id"]
    passed = kept.select(*own, F.lit("accepted").alias("_passed"))
    return screened.join(passed, own, "left").withColumn(
        "verdict", F.coalesce("verdict", "_passed", F.lit("duplicate"))
    ).drop("_passed")


def accept(classified: DataFrame) -> DataFrame:
    """Accepted submissions as observations, with the code's route and bus copied in."""
    return classified.where("verdict = 'accepted'").select(
        "id", "qr_code_id", "bus_number", "route_id", "problem_type", "severity", "description",
        "observed_at", "latitude", "longitude", "anonymous_identifier",
        F.lit("NEW").alias("status"), "created_at",
    )


def quarantine(classified: DataFrame) -> DataFrame:
    return classified.where("verdict <> 'accepted'")


def assignment_as_of(submissions: DataFrame, history: DataFrame) -> DataFrame:
    """Route and bus of the code at submission time.

    ``history`` has (qr_token, valid_from, bus_number, route_id); an assignment
    counts from its own instant on, and of two at one instant the larger counts.
    Each (token, instant) is looked up once; the submissions are joined to the
    answers, and that join can split a hot token.
    """
    assigned = F.struct("bus_number", "route_id")
    changes = history.select(
        "qr_token", F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"), assigned.alias("_assigned")
    )
    changes = keep_last(changes, ["qr_token", "_at", "_kind"], ["_assigned"])
    asks = submissions.select(
        "qr_token", F.col("created_at").alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(changes.schema["_assigned"].dataType).alias("_assigned"),
    ).distinct()
    both = changes.unionByName(asks)
    found = last_before(both, "qr_token", "_at", F.col("_assigned"), "_then", tie=["_kind"])
    answers = found.where("_kind = 1").select("qr_token", F.col("_at").alias("created_at"), "_then")
    return submissions.select("id", "qr_token", "created_at").join(
        answers, ["qr_token", "created_at"], "left"
    ).select(
        F.col("id").cast("bigint").alias("id"), "qr_token", "created_at",
        F.col("_then.bus_number").alias("bus_number"), F.col("_then.route_id").alias("route_id"),
    )


def listing(
    observations: DataFrame,
    as_of: dt.datetime,
    *,
    problem_type: str | None = None,
    severity: str | None = None,
    status: str | None = None,
    route_id: str | None = None,
    bus_number: str | None = None,
    days: int | None = None,
    skip: int = 0,
    limit: int = 200,
) -> DataFrame:
    """One page of observations, newest first; at most 1000 rows."""
    if limit > 1000:
        raise ValueError("a page holds at most 1000 rows")
    wanted = {
        "problem_type": problem_type, "severity": severity, "status": status,
        "route_id": route_id, "bus_number": bus_number,
    }
    df = observations
    for column, value in wanted.items():
        if value:
            df = df.where(F.col(column) == value)
    if days:
        df = _since(df, as_of, days)
    return df.orderBy(F.desc("created_at"), F.desc("id")).offset(skip).limit(limit)


def recent(observations: DataFrame, as_of: dt.datetime) -> DataFrame:
    return listing(observations, as_of, limit=10)


def _since(df: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    return df.where(F.col("created_at") >= clock.days_before(as_of, days))


def change_status(observations: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply (id, status, changed_at) rows; the last valid change per id wins.

    Ids that do not exist change nothing.
    """
    valid = changes.where(F.col("status").isin(*params.STATUSES)).select("id", "status", "changed_at")
    last = keep_last(valid, ["id"], ["changed_at"]).select("id", F.col("status").alias("_new"))
    return observations.join(last, "id", "left").withColumn(
        "status", F.coalesce("_new", "status")
    ).select(*observations.columns)


def by_route(
    observations: DataFrame, as_of: dt.datetime, days: int = 30, limit: int | None = None
) -> DataFrame:
    """Counts by route, problem and severity; with ``limit`` the largest ones, in order."""
    keys = ["route_id", "problem_type", "severity"]
    counts = (
        _since(observations, as_of, days)
        .where(F.col("route_id").isNotNull())
        .groupBy(*keys)
        .agg(F.count("id").alias("count"))
    )
    return counts if limit is None else counts.orderBy(F.desc("count"), *keys).limit(limit)


def by_type(observations: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return (
        _since(observations, as_of, days)
        .groupBy("problem_type", "severity")
        .agg(F.count("id").alias("count"))
    )


def summary(observations: DataFrame) -> DataFrame:
    """All-time totals in one scan."""
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    return observations.agg(
        F.count("*").alias("total_observations"),
        is_("status", "NEW").alias("new_observations"),
        is_("status", "REVIEWED").alias("reviewed_observations"),
        is_("status", "RESOLVED").alias("resolved_observations"),
        is_("severity", "HIGH").alias("high_priority"),
        is_("severity", "CRITICAL").alias("critical_priority"),
    )


def top_problem_types(observations: DataFrame, limit: int = 5) -> DataFrame:
    return (
        observations.groupBy("problem_type")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "problem_type")
        .limit(limit)
    )


def route_rollup(
    observations: DataFrame, as_of: dt.datetime, days: int = 30, top: int = 10
) -> DataFrame:
    """The ``top`` routes by total count over all their combinations."""
    counts = by_route(observations, as_of, days)
    return (
        counts.groupBy("route_id")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "route_id")
        .limit(top)
    )


def type_rollup(observations: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return by_type(observations, as_of, days).groupBy("problem_type").agg(F.sum("count").alias("count"))


def severity_distribution(observations: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """One row, one zero-filled column per severity from LOW to CRITICAL."""
    counted = by_type(observations, as_of, days)
    return counted.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("count"))), F.lit(0)).alias(s)
            for s in params.SEVERITIES
        ]
    )


def register_codes(registry: DataFrame, incoming: DataFrame) -> DataFrame:
    """Codes to add: valid, not yet registered, one per token, active by default."""
    within = lambda c, n: F.coalesce(F.length(c), F.lit(0)) <= n
    valid = incoming.where(
        ~_outside(F.col("qr_token"), 50)
        & within("bus_number", 50) & within("route_id", 50) & within("location", 100)
    )
    first = keep_first(valid, ["qr_token"], ["created_at", "id"])
    return first.join(registry.select("qr_token"), "qr_token", "left_anti").withColumn(
        "is_active", F.coalesce("is_active", F.lit(True))
    ).select(*incoming.columns)


def newest_codes(registry: DataFrame) -> DataFrame:
    return registry.orderBy(F.desc("created_at"), F.desc("id"))


def pick_list(observations: DataFrame, column: str) -> DataFrame:
    """(code, label) of each code in use, with a title-case label."""
    codes = observations.where(F.col(column).isNotNull()).select(F.col(column).alias("code")).distinct()
    return codes.withColumn("label", code_title(F.col("code")))


def display(observations: DataFrame) -> DataFrame:
    """Screen text: local time and labels without underscores."""
    return observations.withColumn("observed_local", clock.local_display(F.col("observed_at"))).withColumn(
        "problem_label", F.replace("problem_type", F.lit("_"), F.lit(" "))
    )
