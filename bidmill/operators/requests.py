"""Request queue, data side.

The queue is a table with committed versions (``sources/versions.py``), and a
claim commits a new one. The reference claims one request per run behind an
``in_process`` guard; here the claim takes the N smallest ``new`` ids (N=1 is
the reference) and the batch job prices all claimed requests in one plan, keyed
by dom_rec_id. ``claim`` depends on the whole queue: of two dequeuers that read
the same version one commits, the other starts again from the newer version
and sees the first one's requests in process. A claim holds for a lease; after
it the request counts as new again, and its first owner can't finish it any
more. Every step is a single pass or an equi-join on the queue key; the claimed
set joins back as a broadcast only when its size is within the broadcast bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidmill.functions.timefn import queue_stamp, ts_col
from bidmill.joins import broadcast_if_small
from bidmill.session import written
from bidmill.sources.versions import Manifest, VersionedTable

# Fixed values that must equal the reference's: the columns of a request record.
QUEUE_TEXT_COLUMNS = ("dom_rec_id", "bid_list_name", "bid_list_id", "strategy_name", "line_id",
                      "target_cpm", "uniques", "min_bid", "max_bid", "strategy_id", "status",
                      "process_name", "date_new", "date_in_process", "date_processed",
                      "date_error")

# the owner e-mail the queue path writes into every input row (a parameter)
DEFAULT_OWNER_EMAIL = "owner@example.com"


def claim_next(queue: DataFrame) -> DataFrame:
    """Q1 (A3 + J9): one row, the smallest ``new`` id, NULL when nothing is new
    or when any request is ``in_process``. One aggregation pass, no join."""
    agg = queue.agg(
        F.min(F.when(F.col("status") == "new", F.col("dom_rec_id"))).alias("m"),
        F.max((F.col("status") == "in_process").cast("int")).alias("busy"))
    return agg.select(F.when(F.coalesce(F.col("busy"), F.lit(0)) == 0, F.col("m"))
                      .alias("dom_rec_id"))


def claim_batch(queue: DataFrame, n: int | None = None, exclusive: bool = True) -> DataFrame:
    """Q1 generalised: the n smallest ``new`` ids (all without n), none if any
    request is ``in_process`` (unless not ``exclusive``). The guard is one row
    from one pass over the status column; the claimed ids are a distributed
    top-n."""
    if n is not None and n <= 0:
        raise ValueError("a claim takes at least one request")
    new = queue.where(F.col("status") == "new")
    if exclusive:
        new = new.where(queue.agg((F.coalesce(F.max((F.col("status") == "in_process").cast("int")),
                                              F.lit(0)) == 0).alias("idle")).scalar())
    new = new.select("dom_rec_id")
    return new if n is None else new.orderBy("dom_rec_id").limit(n)


def _expired(run_ts, lease_seconds: int | None) -> Column:
    """In process for the lease or longer."""
    if lease_seconds is None:
        return F.lit(False)
    since = F.unix_timestamp(ts_col(run_ts)) - F.unix_timestamp(
        F.col("date_in_process").cast("timestamp"))
    return (F.col("status") == "in_process") & F.coalesce(since >= lease_seconds, F.lit(False))


def released(queue: DataFrame, run_ts, lease_seconds: int | None) -> DataFrame:
    """The queue with requests whose lease is over back to ``new``."""
    over = _expired(run_ts, lease_seconds)
    return queue.withColumns({
        "process_name": F.when(~over, F.col("process_name")),
        "date_in_process": F.when(~over, F.col("date_in_process")),
        "status": F.when(over, F.lit("new")).otherwise(F.col("status"))})


def claim(queue: VersionedTable, token: str, run_ts, n: int | None = 1,
          lease_seconds: int | None = None, exclusive: bool = True) -> tuple[DataFrame, Manifest]:
    """Q1 + Q2 on the committed queue (key dom_rec_id): the claimed ids and the
    version that holds the claim. No other claim gets the same ids."""
    def attempt(m: Manifest) -> tuple[DataFrame, Manifest]:
        rows = queue.read(m.version)
        ids = written(claim_batch(released(rows, run_ts, lease_seconds), n, exclusive), "claimed")
        over = rows.where(_expired(run_ts, lease_seconds)).select("dom_rec_id")
        made = queue.edit(lambda df: claim_state(released(df, run_ts, lease_seconds), ids, token,
                                                 run_ts),
                          "claim", keys=ids.unionByName(over), base=m, serial=True)
        return ids, made
    return queue.attempts(attempt)


def finish(queue: VersionedTable, outcomes: DataFrame, run_ts, token: str | None = None) -> Manifest:
    """K16 / Q6 on the committed queue: status, result id and date of requests,
    with a token only of those that its claim still holds."""
    def change(df: DataFrame) -> DataFrame:
        done = outcomes
        if token is not None:
            mine = df.where((F.col("status") == "in_process") & (F.col("process_name") == token))
            done = outcomes.join(mine.select("dom_rec_id"), "dom_rec_id", "left_semi")
        return apply_outcomes(df, done, run_ts)
    return queue.edit(change, "finish", keys=outcomes.select("dom_rec_id"))


def claim_state(queue: DataFrame, claimed: DataFrame, token: str, run_ts) -> DataFrame:
    """The queue after the claim: process name, in_process, date."""
    c = claimed.where(F.col("dom_rec_id").isNotNull()).select(
        "dom_rec_id", F.lit(True).alias("_claimed"))
    q = queue.join(broadcast_if_small(c), "dom_rec_id", "left")
    hit = F.coalesce(F.col("_claimed"), F.lit(False))
    return q.select(
        *[F.when(hit, F.lit(token)).otherwise(F.col(x)).alias(x) if x == "process_name"
          else F.when(hit, F.lit("in_process")).otherwise(F.col(x)).alias(x) if x == "status"
          else F.when(hit, ts_col(run_ts)).otherwise(F.col(x).cast("timestamp")).alias(x)
          if x == "date_in_process" else F.col(x)
          for x in queue.columns])


def as_text(queue: DataFrame) -> DataFrame:
    """Q3: the request record as text, every NULL becomes "-1"."""
    return queue.select(*[F.coalesce(F.col(c).cast("string"), F.lit("-1")).alias(c)
                          for c in QUEUE_TEXT_COLUMNS])


def request_inputs(requests: DataFrame, email: str = DEFAULT_OWNER_EMAIL,
                   extra: tuple[str, ...] = ()) -> DataFrame:
    """Q4: strategy input rows of requests (ten columns plus dom_rec_id).

    The text rules of the reference apply: a NULL becomes -1 (so a missing
    target is -1.0 and a missing audience is "no cap"); algorithm -1 and
    dimension 1 are constants. ``extra`` request columns ride along (so
    later steps need no join back to the requests).
    """
    def num(c: str, t: str) -> Column:
        return F.coalesce(F.col(c).cast(t), F.lit(-1).cast(t))
    return requests.select(
        "dom_rec_id",
        num("strategy_id", "bigint").alias("strategy_id"),
        num("bid_list_id", "bigint").alias("bid_list_id"),
        num("line_id", "bigint").alias("line_id"),
        num("uniques", "bigint").alias("unique_count"),
        F.lit(email).alias("email"),
        num("min_bid", "double").alias("min_bid"),
        num("max_bid", "double").alias("max_bid"),
        F.lit(-1).alias("algorithm_id"),
        F.lit(1).alias("dimension_id"),
        num("target_cpm", "double").alias("target_ecpm"),
        *extra)


def strategy_inputs_from_raw(raw: DataFrame, uniques: DataFrame, logins: DataFrame) -> DataFrame:
    """J6 (+P5): audience size optional (left join, -1), login required (inner)."""
    u = uniques.select(F.col("id").alias("uniques_id"), "number_of_unique_users")
    lg = logins.select(F.col("id").alias("user_id"), "email")
    return (raw.join(u, "uniques_id", "left").join(lg, "user_id")
               .select("strategy_id", "bid_list_id", "line_id",
                       F.coalesce(F.col("number_of_unique_users"), F.lit(-1)).cast("bigint")
                       .alias("unique_count"),
                       "email", "min_bid", "max_bid",
                       F.coalesce(F.col("algorithm_id"), F.lit(-1)).cast("bigint").alias("algorithm_id"),
                       F.lit(1).alias("dimension_id"),
                       F.col("target_cpm").alias("target_ecpm")))


def pending_inputs(raw: DataFrame) -> DataFrame:
    """Inputs not modelled yet."""
    return raw.where(F.col("modeled") == 0)


def enqueue_rows(domain_raw: DataFrame, run_ts) -> DataFrame:
    """Q5 (P3, P5, P6, F15): queue rows for domain inputs not modelled yet."""
    stamp = queue_stamp(run_ts)
    return pending_inputs(domain_raw).select(
        "strategy_id", F.coalesce(F.col("algorithm_id"), F.lit(-1)).cast("bigint").alias("algo_id"),
        F.lit("domain").alias("dimension_type"), F.lit("new").alias("event_type"),
        stamp.alias("create_ts"), stamp.alias("update_ts"), F.lit("pending").alias("status"))


def enqueue_all_dimensions(domain_raw: DataFrame, recency_raw: DataFrame, run_ts) -> DataFrame:
    """U4: domain rows UNION (distinct) recency rows; recency keeps a NULL algorithm."""
    stamp = queue_stamp(run_ts)
    rec = pending_inputs(recency_raw).select(
        "strategy_id", F.col("algorithm_id").cast("bigint").alias("algo_id"),
        F.lit("recency").alias("dimension_type"), F.lit("new").alias("event_type"),
        stamp.alias("create_ts"), stamp.alias("update_ts"), F.lit("pending").alias("status"))
    return enqueue_rows(domain_raw, run_ts).unionByName(rec).distinct()


def apply_outcomes(queue: DataFrame, outcomes: DataFrame, run_ts) -> DataFrame:
    """Set status and result id from (dom_rec_id, status, dom_rec_result_id).

    A processed request gets its result id and date_processed, a failed one
    a NULL result id and date_error (the reference never set the dates).
    """
    o = outcomes.select("dom_rec_id", F.col("status").alias("_st"),
                        F.col("dom_rec_result_id").alias("_rid"), F.lit(True).alias("_hit"))
    j = queue.join(o, "dom_rec_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    t = ts_col(run_ts)
    cols = []
    for x in queue.columns:
        if x == "status":
            cols.append(F.when(hit, F.col("_st")).otherwise(F.col(x)).alias(x))
        elif x == "dom_rec_result_id":
            cols.append(F.when(hit, F.when(F.col("_st") == "processed", F.col("_rid")))
                        .otherwise(F.col(x)).alias(x))
        elif x == "date_processed":
            cols.append(F.when(hit & (F.col("_st") == "processed"), t)
                        .otherwise(F.col(x).cast("timestamp")).alias(x))
        elif x == "date_error":
            cols.append(F.when(hit & (F.col("_st") == "error"), t)
                        .otherwise(F.col(x).cast("timestamp")).alias(x))
        else:
            cols.append(F.col(x))
    return j.select(*cols)


def mark_modeled(raw: DataFrame, processed_pairs: DataFrame) -> DataFrame:
    """modeled = 1 for (strategy_id, bid_list_id) pairs that were processed
    (the table's key; ``VersionedTable.edit`` commits the result)."""
    p = processed_pairs.select("strategy_id", "bid_list_id").distinct() \
        .withColumn("_done", F.lit(True))
    j = raw.join(p, ["strategy_id", "bid_list_id"], "left")
    return j.select(*[F.when(F.col("_done"), F.lit(1)).otherwise(F.col(c)).alias(c)
                      if c == "modeled" else F.col(c) for c in raw.columns])
