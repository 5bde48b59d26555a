"""Board health from a poll log (W3), host failure streaks (W4), boards
by host (W8) and the run summaries that read them (A1-A3, A10, A13).

Poll log columns used: ``company_slug, ats_source, finished_at, seq, status``
(+ ``profile`` when the condemning rule depends on it, + ``host``). Status is
one of ok | dead404 | pfail | error (see ``functions.misc.outcome``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V
from .streaks import streak_since_reset

BOARD = ["company_slug", "ats_source"]


def board_health(
    polls: DataFrame,
    companies: DataFrame | None = None,
    order: Sequence[str] = ("finished_at", "seq"),
    bucket: Column | None = None,
    condemns: Column | None = None,
    retire_after: int = V.RETIRE_AFTER,
) -> DataFrame:
    """Fold each board's polls in order into its new companies state.

    ok resets the failure count and stamps ``last_polled_at``; a condemning
    pfail adds one and retires at ``retire_after``; dead404 retires at once;
    error and non-condemning pfail change nothing. Retirement is final: later
    polls of a retired board are ignored. Retiring writes only
    ``still_active`` (the count keeps its last written value).

    Returns one row per board seen in ``polls``: company_slug, ats_source,
    fail_count, still_active, last_polled_at, retired_at, polls_used, and
    ``retired_run`` when polls carry a ``run_id``.

    The streak is computed once. What a board shows before its first retirement
    is summed up per (board, bucket), with a window over the same partitions;
    only those summaries, one row per bucket, are brought together per board.
    """
    order = list(order)
    cond = condemns if condemns is not None else F.lit(True)
    p = polls.withColumn("_b", bucket if bucket is not None else F.date_trunc("hour", F.col(order[0])))
    p = p.withColumn("_cp", (F.col("status") == "pfail") & cond).withColumn("_ok", F.col("status") == "ok")
    if companies is not None:
        init = companies.select(*BOARD, F.col("fail_count").alias("_f0"), F.col("still_active").alias("_a0"), F.col("last_polled_at").alias("_p0"))
        # Boards already retired are not polled (F5); their rows are ignored.
        p = p.join(init, BOARD, "left").where(~F.coalesce(F.col("_a0") == F.lit(False), F.lit(False)))
    else:
        p = p.withColumn("_f0", F.lit(None).cast("int")).withColumn("_a0", F.lit(None).cast("boolean")).withColumn("_p0", F.lit(None).cast("timestamp"))
    s = streak_since_reset(p, BOARD, order, F.col("_b"), F.col("_cp"), F.col("_ok"))
    s = s.withColumn("_n", F.col("streak") + F.when(F.col("resets") == 0, F.coalesce(F.col("_f0"), F.lit(0))).otherwise(F.lit(0)))
    at = F.struct(*[F.col(c) for c in order])
    retire = (F.col("status") == "dead404") | (F.col("_cp") & (F.col("_n") >= retire_after))
    s = s.withColumn("_ret", F.min(F.when(retire, at)).over(Window.partitionBy(*BOARD, "_b")))
    before = F.col("_ret").isNull() | (at < F.col("_ret"))
    at_ret = at == F.col("_ret")
    run = F.col("run_id").cast("string") if "run_id" in polls.columns else F.lit(None).cast("string")
    by_bucket = s.groupBy(*BOARD, "_b").agg(
        F.max(F.when(before & (F.col("_ok") | F.col("_cp")), F.struct(at.alias("o"), F.col("_n").alias("n")))).alias("_lastw"),
        F.max(F.when(before & F.col("_ok"), F.col("finished_at"))).alias("_stamp"),
        F.first("_f0", ignorenulls=True).alias("_f0"),
        F.first("_a0", ignorenulls=True).alias("_a0"),
        F.first("_p0", ignorenulls=True).alias("_p0"),
        F.max(F.when(at_ret, F.struct(F.col("finished_at").alias("at"), run.alias("run")))).alias("_retired"),
        F.count(F.when(before | at_ret, 1)).alias("_used"),
    )
    first_bucket = F.min(F.when(F.col("_retired").isNotNull(), F.col("_b"))).over(Window.partitionBy(*BOARD))
    by_bucket = by_bucket.withColumn("_first", first_bucket).where(F.col("_first").isNull() | (F.col("_b") <= F.col("_first")))
    out = by_bucket.groupBy(*BOARD).agg(
        F.max("_lastw").alias("_lastw"), F.max("_stamp").alias("_stamp"), F.first("_f0", ignorenulls=True).alias("_f0"),
        F.first("_a0", ignorenulls=True).alias("_a0"), F.first("_p0", ignorenulls=True).alias("_p0"),
        F.max("_retired").alias("_retired"), F.sum("_used").alias("polls_used"))
    return out.select(
        *BOARD,
        F.coalesce(F.col("_lastw.n"), F.col("_f0")).cast("int").alias("fail_count"),
        F.when(F.col("_retired").isNotNull(), F.lit(False)).otherwise(F.col("_a0")).alias("still_active"),
        F.coalesce(F.col("_stamp"), F.col("_p0")).alias("last_polled_at"),
        F.col("_retired.at").alias("retired_at"),
        "polls_used",
        *([F.col("_retired.run").alias("retired_run")] if "run_id" in polls.columns else []),
    )


HOUR_SUMMARY = (
    "company_slug string, ats_source string, hour timestamp, heads array<struct<finished_at:timestamp,seq:bigint>>, head_n int, "
    "dead struct<at:struct<finished_at:timestamp,seq:bigint>,n:int>, has_ok boolean, last_n int, stamp timestamp, retired_at timestamp"
)


def hour_summaries(polls: DataFrame, condemns: Column | None = None, retire_after: int = V.RETIRE_AFTER) -> DataFrame:
    """What an hour of polls does to a board, whatever its state before: one
    row per (board, hour) that :func:`fold_hours` combines in order. Before the
    first ok (the head) the result depends on the count brought along, so the
    first ``retire_after`` condemning polls and the first dead404 are kept; after
    it, it does not. A late poll changes the summary of its hour only."""
    cond = condemns if condemns is not None else F.lit(True)
    at = F.struct("finished_at", F.col("seq").cast("bigint").alias("seq"))
    fail, ok, dead = (F.col("status") == "pfail") & cond, F.col("status") == "ok", F.col("status") == "dead404"
    hour = [*BOARD, "hour"]
    so_far = Window.partitionBy(*hour).orderBy("finished_at", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = polls.withColumn("hour", F.date_trunc("hour", F.col("finished_at"))).withColumn("_at", at)
    p = p.withColumn("_c", F.count_if(fail).over(so_far)).withColumn("_r", F.count_if(ok).over(so_far))
    p = p.withColumn("_n", F.col("_c") - F.coalesce(F.max(F.when(ok, F.col("_c"))).over(so_far), F.lit(0)))
    head = F.col("_r") == 0
    p = p.withColumn("_ret", F.min(F.when(~head & (dead | (fail & (F.col("_n") >= retire_after))), F.col("_at"))).over(Window.partitionBy(*hour)))
    before = F.col("_ret").isNull() | (F.col("_at") < F.col("_ret"))
    return p.groupBy(*hour).agg(
        F.array_sort(F.collect_list(F.when(head & fail & (F.col("_c") <= retire_after), F.col("_at")))).alias("heads"),
        F.count_if(head & fail).cast("int").alias("head_n"),
        F.min(F.when(head & dead, F.struct(F.col("_at").alias("at"), F.col("_c").cast("int").alias("n")))).alias("dead"),
        F.max(ok).alias("has_ok"),
        F.max(F.when(~head & before & (ok | fail), F.struct("_at", F.col("_n").alias("n"))))["n"].cast("int").alias("last_n"),
        F.max(F.when(before & ok, F.col("finished_at"))).alias("stamp"),
        F.min("_ret")["finished_at"].alias("retired_at"))


def fold_hours(hours: DataFrame, base: DataFrame | None = None, retire_after: int = V.RETIRE_AFTER) -> DataFrame:
    """The boards' states from their hour summaries, in the order of the
    hours, starting from ``base`` (the companies rows before any of them). Equal
    to :func:`board_health` over all polls, whatever the order they came in."""
    columns = [c for c in hours.columns if c not in BOARD]
    per_board = hours.groupBy(*BOARD).agg(F.array_sort(F.collect_list(F.struct(*columns)), lambda a, b: F.when(a["hour"] < b["hour"], -1).when(a["hour"] > b["hour"], 1).otherwise(0)).alias("_h"))
    if base is not None:
        per_board = per_board.join(base.select(*BOARD, F.col("fail_count").alias("_f0"), F.col("still_active").alias("_a0"), F.col("last_polled_at").alias("_p0")), BOARD, "left")
    else:
        per_board = per_board.select("*", F.lit(None).cast("int").alias("_f0"), F.lit(None).cast("boolean").alias("_a0"), F.lit(None).cast("timestamp").alias("_p0"))

    def state(n: Column, stamp: Column, retired: Column) -> Column:
        return F.struct(n.cast("int").alias("n"), stamp.alias("stamp"), retired.alias("retired"))

    def step(s: Column, x: Column) -> Column:
        k = F.greatest(F.lit(1), F.lit(retire_after) - F.coalesce(s["n"], F.lit(0)))
        condemned, dead = F.get(x["heads"], k - 1), x["dead"]["at"]
        first = F.least(condemned, dead)
        added = F.when(first.isNull(), x["head_n"]).when(first == condemned, k - 1).otherwise(x["dead"]["n"])
        n = F.when(added > 0, F.coalesce(s["n"], F.lit(0)) + added).otherwise(s["n"])
        return (F.when(s["retired"].isNotNull(), s)
                .when(first.isNotNull(), state(n, s["stamp"], first["finished_at"]))
                .when(x["has_ok"], state(x["last_n"], x["stamp"], x["retired_at"]))
                .otherwise(state(n, s["stamp"], s["retired"])))

    gone = F.coalesce(~F.col("_a0"), F.lit(False))  # retired before: not polled (F5)
    start = state(F.col("_f0"), F.col("_p0"), F.lit(None).cast("timestamp"))
    out = per_board.withColumn("_s", F.when(gone, start).otherwise(F.aggregate("_h", start, step)))
    return out.select(*BOARD, F.col("_s.n").alias("fail_count"), F.when(F.col("_s.retired").isNotNull(), F.lit(False)).otherwise(F.col("_a0")).alias("still_active"),
                      F.col("_s.stamp").alias("last_polled_at"), F.col("_s.retired").alias("retired_at"))


def listing_sketches(rows: DataFrame, lg_k: int = 12) -> DataFrame:
    """A2 by sketch: per run an HLL sketch of its distinct listings, a few
    kilobytes whatever their number. Kept beside the summary, sketches of any
    runs are united (:func:`united`) without reading a row again."""
    return rows.groupBy("run_id").agg(F.hll_sketch_agg("canonical_url", F.lit(lg_k)).alias("sketch"))


def united(sketches: DataFrame, *keys: str) -> DataFrame:
    """Distinct listings over the runs of each group, estimated."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("listings"))


def retired_in(state: DataFrame) -> DataFrame:
    """The boards that a fold retired, with the run that did it."""
    return state.where(F.col("retired_at").isNotNull()).select(F.col("retired_run").alias("run_id"), *BOARD)


def host_trips(
    polls: DataFrame,
    trip_after: int,
    order: Sequence[str] = ("finished_at", "seq"),
    bucket: Column | None = None,
) -> DataFrame:
    """Per shared host, in completion order, a run of ``trip_after``
    consecutive error/pfail polls trips the host; ok and dead404 reset the run.

    Returns one row per host: host, polls, tripped, tripped_at (the first trip).
    One streak pass and one partial aggregate.
    """
    order = list(order)
    # few, hot keys (a shared host sees every board of its feed): minute
    # buckets keep the rows per (host, bucket) small
    bucket = bucket if bucket is not None else F.date_trunc("minute", F.col(order[0]))
    fail = F.col("status").isin("error", "pfail")
    s = streak_since_reset(polls.where(F.col("host").isNotNull()), ["host"], order, bucket, fail, ~fail)
    trip = F.min(F.when(fail & (F.col("streak") >= trip_after), F.struct(*[F.col(c) for c in order])))
    out = s.groupBy("host").agg(F.count(F.lit(1)).alias("polls"), trip.alias("_trip"))
    return out.select("host", "polls", F.col("_trip").isNotNull().alias("tripped"), F.col("_trip").getField(order[0]).alias("tripped_at"))


def host_state(polls: DataFrame, state: DataFrame, trip_after: int, order: Sequence[str] = ("finished_at", "seq"), bucket: Column | None = None) -> DataFrame:
    """One batch of polls folded into the hosts' state (``host, streak,
    tripped_at``): the streak at the end of the batch and the first trip. The
    first streak of the batch continues the stored one; a hot host is spread
    over its buckets as in :func:`host_trips`."""
    order = list(order)
    bucket = bucket if bucket is not None else F.date_trunc("minute", F.col(order[0]))
    fail = F.col("status").isin("error", "pfail")
    s = streak_since_reset(polls.where(F.col("host").isNotNull()), ["host"], order, bucket, fail, ~fail)
    s = s.join(state.select("host", F.col("streak").alias("_s0"), F.col("tripped_at").alias("_t0")), "host", "left")
    n = F.col("streak") + F.when(F.col("resets") == 0, F.coalesce("_s0", F.lit(0))).otherwise(F.lit(0))
    at = F.struct(*[F.col(c) for c in order])
    out = s.withColumn("_n", n).groupBy("host").agg(
        F.max(F.struct(at.alias("o"), F.col("_n").alias("n"))).alias("_last"), F.first("_t0", ignorenulls=True).alias("_t0"),
        F.min(F.when(fail & (F.col("_n") >= trip_after), F.col(order[0]))).alias("_trip"))
    return out.select("host", F.col("_last.n").cast("long").alias("streak"), F.coalesce("_t0", "_trip").alias("tripped_at"))


def tripped_summary(trips: DataFrame) -> DataFrame:
    """Hosts tripped, by the day of their first trip."""
    return trips.where("tripped").groupBy(F.to_date("tripped_at").alias("tripped_on")).agg(F.count(F.lit(1)).alias("hosts_tripped"))


def run_summary(polls: DataFrame, rows: DataFrame | None = None, retired: DataFrame | None = None) -> DataFrame:
    """A1-A3: per run: jobs seen over ok polls, distinct listings, boards with
    a match, boards retired (by a 404 or condemned), persistent-fail and errors.

    ``rows`` are the matched listing rows of the run (canonical_url, run_id,
    company_slug, ats_source); ``retired`` holds (run_id, company_slug,
    ats_source) of the boards retired in that run; each counts once.
    """
    base = polls.groupBy("run_id").agg(
        F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("seen"))), F.lit(0)).alias("jobs_seen"),
        F.count_if(F.col("status") == "pfail").alias("persistent_fail"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(F.col("status") == "dead404").alias("dead404"),
        F.count_if((F.col("status") == "ok") & (F.col("matched") > 0)).alias("boards_matched"),
    )
    if rows is not None:
        lst = rows.groupBy("run_id").agg(F.count_distinct("canonical_url").alias("listings"))
        base = base.join(lst, "run_id", "left").withColumn("listings", F.coalesce("listings", F.lit(0)))
    if retired is not None:
        boards = retired.select("run_id", *BOARD).distinct().groupBy("run_id").agg(F.count(F.lit(1)).alias("retired"))
        base = base.join(boards, "run_id", "left").withColumn("retired", F.coalesce("retired", F.lit(0)))
    return base


def pollable(companies: DataFrame, feeds: Sequence[str] = V.POLLABLE) -> DataFrame:
    """drop retired boards (still_active = false; NULL is active) and
    boards of feeds that have no conformer."""
    return companies.where(~F.coalesce(F.col("still_active") == F.lit(False), F.lit(False)) & F.col("ats_source").isin(*feeds))


def with_host(companies: DataFrame, registry: DataFrame) -> DataFrame:
    """Attach ``host`` (the shared API host of path feeds) and ``host_class``."""
    r = registry.select("ats_source", "slug_in", "api_host")
    j = companies.join(r, "ats_source", "left")
    return j.withColumn("host_class", F.when(F.col("slug_in") == "path", F.lit("shared")).otherwise(F.lit("unique"))).withColumn(
        "host", F.when(F.col("slug_in") == "path", F.col("api_host"))
    ).drop("slug_in", "api_host")


def host_load(boards: DataFrame) -> DataFrame:
    """W8 as a report: boards and feeds of each shared host (those of feeds with
    a host a board under NULL). Partial aggregates: a host of very many boards
    is one row a task."""
    return boards.groupBy("host").agg(F.count(F.lit(1)).alias("boards"), F.count_distinct("ats_source").alias("feeds"))


def queue_profile(companies: DataFrame, registry: DataFrame, feeds: Sequence[str] = V.POLLABLE) -> DataFrame:
    """A10: boards total, pollable, per shared host and unique-host counts,
    as rows of (host_class, host, boards) plus two total rows."""
    pol = with_host(pollable(companies, feeds), registry)
    per = pol.groupBy("host_class", "host").agg(F.count(F.lit(1)).alias("boards"))
    per = per.withColumn("host", F.when(F.col("host_class") == "unique", F.lit(None).cast("string")).otherwise(F.col("host")))
    per = per.groupBy("host_class", "host").agg(F.sum("boards").alias("boards"))
    totals = companies.agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if(~F.coalesce(F.col("still_active") == F.lit(False), F.lit(False)) & F.col("ats_source").isin(*feeds)).alias("pollable"),
    )
    tot = totals.select(F.explode(F.array(
        F.struct(F.lit("total").alias("host_class"), F.lit(None).cast("string").alias("host"), F.col("all").alias("boards")),
        F.struct(F.lit("pollable").alias("host_class"), F.lit(None).cast("string").alias("host"), F.col("pollable").alias("boards")),
    )).alias("t")).select("t.*")
    return per.unionByName(tot)
