"""Request-queue queries (claim, state, inputs, enqueue, status)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidmill.functions.timefn import DEFAULT_RUN_TS, claim_token
from bidmill.operators import requests as R
from bidmill.operators import payloads as PL
from bidmill.plans.core import cand_sql
from bidmill.plans.payloads_q import stored_results
from bidmill.plans.registry import query
from bidmill.session import written
from bidmill.sources import fixtures as X
from bidmill.sources import sinks
from bidmill.sources.fixtures import with_views

TOKEN = claim_token(DEFAULT_RUN_TS)
LEASE_SECONDS = 6 * 3600   # a claim of a dequeue run
QUEUE_VIEWS = ("dom_rec_queue", "strategy_inputs", "request_queue")

CLAIM_SQL = """
select case when count(*) filter (status = 'in_process') = 0
            then min(dom_rec_id) filter (status = 'new') end as dom_rec_id
from request_queue"""


def _ts_text(df, *cols):
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


@query("claim_next", with_views(CLAIM_SQL, *QUEUE_VIEWS))
def q_claim_next(spark, sf_dir):
    return R.claim_next(X.queue_table(spark, sf_dir, edited=False).read())


@query("claim_state", with_views(f"""
select q.dom_rec_id,
       case when q.dom_rec_id = c.dom_rec_id then 'in_process' else q.status end as status,
       case when q.dom_rec_id = c.dom_rec_id then '{TOKEN}' else q.process_name end as process_name,
       case when q.dom_rec_id = c.dom_rec_id then '2024-05-17 09:41:26'
            else cast(q.date_in_process as varchar) end as date_in_process
from request_queue q cross join ({CLAIM_SQL}) c""", *QUEUE_VIEWS))
def q_claim_state(spark, sf_dir):
    """Q2: the committed queue after one claim."""
    queue = X.queue_table(spark, sf_dir)
    _, made = R.claim(queue, TOKEN, DEFAULT_RUN_TS)
    return _ts_text(queue.read(made.version).select("dom_rec_id", "status", "process_name",
                                                    "date_in_process"), "date_in_process")


@query("claim_batch", with_views("""
select dom_rec_id from request_queue where status = 'new'
and not exists (select 1 from request_queue where status = 'in_process')
order by dom_rec_id limit 25""", *QUEUE_VIEWS))
def q_claim_batch(spark, sf_dir):
    """The 25 oldest new requests: the claim size is the feature here."""
    return R.claim(X.queue_table(spark, sf_dir), TOKEN, DEFAULT_RUN_TS, n=25)[0]


CLAIMED_TEXT_SQL = f"""
select cast(q.dom_rec_id as varchar) as dom_rec_id, q.bid_list_name,
       cast(q.bid_list_id as varchar) as bid_list_id, q.strategy_name,
       coalesce(cast(q.line_id as varchar), '-1') as line_id,
       coalesce(cast(q.target_cpm as varchar), '-1') as target_cpm,
       coalesce(cast(q.uniques as varchar), '-1') as uniques,
       coalesce(cast(q.min_bid as varchar), '-1') as min_bid,
       coalesce(cast(q.max_bid as varchar), '-1') as max_bid,
       cast(q.strategy_id as varchar) as strategy_id, 'in_process' as status,
       '{TOKEN}' as process_name, cast(q.date_new as varchar) as date_new,
       '2024-05-17 09:41:26' as date_in_process, '-1' as date_processed, '-1' as date_error
from request_queue q join ({CLAIM_SQL}) c on q.dom_rec_id = c.dom_rec_id"""


@query("claimed_request", with_views(CLAIMED_TEXT_SQL, *QUEUE_VIEWS))
def q_claimed_request(spark, sf_dir):
    """Q3: the claimed record, found in the committed queue by its owner."""
    queue = X.queue_table(spark, sf_dir)
    _, made = R.claim(queue, TOKEN, DEFAULT_RUN_TS)
    return R.as_text(queue.read(made.version).where(
        (F.col("status") == "in_process") & (F.col("process_name") == TOKEN)))


REQUEST_INPUTS_SQL = """
select dom_rec_id, strategy_id, bid_list_id, coalesce(line_id, -1) as line_id,
       coalesce(uniques, -1) as unique_count, 'owner@example.com' as email,
       coalesce(min_bid, -1) as min_bid, coalesce(max_bid, -1) as max_bid,
       -1 as algorithm_id, 1 as dimension_id, coalesce(target_cpm, -1.0) as target_ecpm
from request_queue where status = 'new'"""


@query("request_inputs", with_views(REQUEST_INPUTS_SQL, *QUEUE_VIEWS))
def q_request_inputs(spark, sf_dir):
    queue = X.request_queue(spark, sf_dir)
    return R.request_inputs(queue.where(F.col("status") == "new"))


@query("inline_rows", with_views("""
select dom_rec_id, 'strategy' as kind, strategy_id as id from request_queue where status = 'new'
union all
select dom_rec_id, 'bid_list' as kind, bid_list_id as id from request_queue where status = 'new'""",
                                 *QUEUE_VIEWS))
def q_inline_rows(spark, sf_dir):
    """A stack() row generator, fed by the requests instead of literals."""
    queue = X.request_queue(spark, sf_dir).where(F.col("status") == "new")
    return queue.selectExpr(
        "dom_rec_id", "stack(2, 'strategy', strategy_id, 'bid_list', bid_list_id) as (kind, id)")


@query("scan_queue", with_views("""
select dom_rec_id, strategy_id, bid_list_id, status from request_queue
where status in ('new', 'in_process')""", *QUEUE_VIEWS))
def q_scan_queue(spark, sf_dir):
    """Relational scan of the queue; the filter reaches the parquet reader."""
    path = sinks.write_table(X.request_queue(spark, sf_dir), spark, "request_queue")
    q = sinks.read_relational(spark, path=path)
    return q.where(F.col("status").isin("new", "in_process")).select(
        "dom_rec_id", "strategy_id", "bid_list_id", "status")


RAW_VIEWS = ("domain_inputs_raw", "uniques_selection", "logins", "recency_inputs")


@query("strategy_inputs", with_views("""
select strategy_id, bid_list_id, line_id,
       cast(ifnull((select any_value(number_of_unique_users) from uniques_selection
                    where id = uniques_id), -1) as bigint) as unique_count, email,
       min_bid, max_bid, cast(ifnull(algorithm_id, -1) as bigint) as algorithm_id,
       1 as dimension_id, target_cpm as target_ecpm
from domain_inputs_raw, logins where logins.id = user_id""", *RAW_VIEWS))
def q_strategy_inputs(spark, sf_dir):
    return R.strategy_inputs_from_raw(X.domain_inputs_raw(spark, sf_dir),
                                      X.uniques_selection(spark, sf_dir), X.logins(spark, sf_dir))


@query("pending_inputs", with_views(
    "select strategy_id, bid_list_id from domain_inputs_raw where modeled = 0", *RAW_VIEWS))
def q_pending_inputs(spark, sf_dir):
    return R.pending_inputs(X.domain_inputs_raw(spark, sf_dir)).select("strategy_id", "bid_list_id")


@query("null_defaults", with_views("""
select strategy_id, coalesce(algorithm_id, -1) as algo_id, coalesce(target_cpm, 1) as target_ecpm,
       coalesce(cast(uniques_id as varchar), '-1') as uniques_text
from domain_inputs_raw""", *RAW_VIEWS))
def q_null_defaults(spark, sf_dir):
    raw = X.domain_inputs_raw(spark, sf_dir)
    return raw.select("strategy_id",
                      F.coalesce(F.col("algorithm_id"), F.lit(-1)).alias("algo_id"),
                      F.coalesce(F.col("target_cpm"), F.lit(1.0)).alias("target_ecpm"),
                      F.coalesce(F.col("uniques_id").cast("string"), F.lit("-1")).alias("uniques_text"))


STAMPED_SQL = """'{kind}' as dimension_type, 'new' as event_type, '2024051709412600' as create_ts,
       '2024051709412600' as update_ts, 'pending' as status"""

ENQUEUE_SQL = f"""
select strategy_id, case when algorithm_id is null then -1 else cast(algorithm_id as bigint) end
         as algo_id, {STAMPED_SQL.format(kind='domain')}
from domain_inputs_raw where not modeled"""


def _enqueue(spark, sf_dir):
    rows = R.enqueue_rows(X.domain_inputs_raw(spark, sf_dir), DEFAULT_RUN_TS)
    return rows, sinks.append_with_ids(rows, spark, "pb_queue", id_col="request_id")


@query("enqueue_requests", with_views(ENQUEUE_SQL, *RAW_VIEWS))
def q_enqueue(spark, sf_dir):
    """Q5 + K11: select, append to the queue table, read it back."""
    _, written = _enqueue(spark, sf_dir)
    return written.drop("request_id")


@query("enqueue_counts", with_views(f"""
select count(*) as n_selected, count(*) as n_inserted, count(*) as n_distinct_ids
from ({ENQUEUE_SQL}) e""", *RAW_VIEWS))
def q_enqueue_counts(spark, sf_dir):
    """Rows selected (observed during the append), rows the queue table
    gained, and distinct ids among them."""
    _, written = _enqueue(spark, sf_dir)
    return written.agg(F.lit(written.observed_rows).cast("bigint").alias("n_selected"),
                       F.count(F.lit(1)).alias("n_inserted"),
                       F.countDistinct("request_id").alias("n_distinct_ids"))


@query("enqueue_all_dimensions", with_views(f"""
select distinct * from (
  from ({ENQUEUE_SQL}) d
  union all by name
  select strategy_id, cast(algorithm_id as bigint) as algo_id,
         {STAMPED_SQL.format(kind='recency')}
  from recency_inputs where not modeled) e""", *RAW_VIEWS))
def q_enqueue_all(spark, sf_dir):
    return R.enqueue_all_dimensions(X.domain_inputs_raw(spark, sf_dir),
                                    X.recency_inputs(spark, sf_dir), DEFAULT_RUN_TS)


OUTCOME_SQL = """
select q.dom_rec_id,
       case when exists (select 1 from candidates c where c.strategy_id = q.strategy_id)
            then 'processed' else 'error' end as status
from request_queue q where q.status = 'new'"""


def _outcomes(spark, sf_dir, requests):
    """Q6: a request is processed when its run stored a result."""
    ids = PL.result_ids(stored_results(spark, sf_dir, requests))
    o = requests.select("dom_rec_id", "strategy_id", "bid_list_id").join(ids, "dom_rec_id", "left")
    return o.withColumn("status", F.when(F.col("dom_rec_result_id").isNotNull(), "processed")
                        .otherwise("error"))


@query("request_status", cand_sql("""
select q.dom_rec_id, coalesce(o.status, q.status) as status,
       coalesce(o.status = 'processed', false) as has_result,
       case when o.status = 'processed' then '2024-05-17 09:41:26' end as date_processed,
       case when o.status = 'error' then '2024-05-17 09:41:26' end as date_error
from request_queue q left join outcomes o on q.dom_rec_id = o.dom_rec_id""",
    "dom_rec_queue", "request_queue", ("outcomes", OUTCOME_SQL)))
def q_request_status(spark, sf_dir):
    """The statuses are committed to the queue and read back."""
    queue = X.queue_table(spark, sf_dir)
    outcomes = written(_outcomes(spark, sf_dir, queue.read().where(F.col("status") == "new")),
                       "outcomes")
    made = R.finish(queue, outcomes, DEFAULT_RUN_TS)
    return _ts_text(queue.read(made.version).select(
        "dom_rec_id", "status", F.col("dom_rec_result_id").isNotNull().alias("has_result"),
        "date_processed", "date_error"),
                    "date_processed", "date_error")


@query("dequeue_run", cand_sql(f"""
select q.dom_rec_id, coalesce(o.status, q.status) as status,
       coalesce(o.status = 'processed', false) as has_result,
       case when o.dom_rec_id is not null then '{TOKEN}' end as process_name,
       case when o.dom_rec_id is not null then '2024-05-17 09:41:26' end as date_in_process,
       case when o.status = 'processed' then '2024-05-17 09:41:26' end as date_processed,
       case when o.status = 'error' then '2024-05-17 09:41:26' end as date_error
from request_queue q left join outcomes o on q.dom_rec_id = o.dom_rec_id""",
    "dom_rec_queue", "request_queue", ("outcomes", OUTCOME_SQL)))
def q_dequeue_run(spark, sf_dir):
    """The job from claim to status: claim all new requests, price them, store
    their results, and commit status and result id of those still claimed."""
    queue = X.queue_table(spark, sf_dir)
    _, made = R.claim(queue, TOKEN, DEFAULT_RUN_TS, n=None, lease_seconds=LEASE_SECONDS)
    mine = queue.read(made.version).where(F.col("process_name") == TOKEN)
    outcomes = written(_outcomes(spark, sf_dir, mine), "outcomes")
    made = R.finish(queue, outcomes, DEFAULT_RUN_TS, TOKEN)
    return _ts_text(queue.read(made.version).select(
        "dom_rec_id", "status", F.col("dom_rec_result_id").isNotNull().alias("has_result"),
        "process_name", "date_in_process", "date_processed", "date_error"),
        "date_in_process", "date_processed", "date_error")


@query("mark_modeled", cand_sql("""
select d.strategy_id, d.bid_list_id,
       case when exists (select 1 from outcomes o join request_queue q on o.dom_rec_id = q.dom_rec_id
                         where o.status = 'processed' and q.strategy_id = d.strategy_id
                           and q.bid_list_id = d.bid_list_id) then 1 else d.modeled end as modeled
from domain_inputs_raw d""", "dom_rec_queue", "request_queue", "domain_inputs_raw",
    ("outcomes", OUTCOME_SQL)))
def q_mark_modeled(spark, sf_dir):
    """The flags are committed to the inputs table and read back."""
    queue = X.request_queue(spark, sf_dir)
    outcomes = _outcomes(spark, sf_dir, queue.where(F.col("status") == "new"))
    done = written(outcomes.where(F.col("status") == "processed")
                   .select("strategy_id", "bid_list_id").distinct(), "modelled")
    table = X.versioned(spark, sf_dir, "domain_inputs_raw", X.domain_inputs_raw,
                        ["strategy_id", "bid_list_id"])
    made = table.edit(lambda df: R.mark_modeled(df, done), "mark modelled", keys=done)
    return table.read(made.version).select("strategy_id", "bid_list_id", "modeled")
