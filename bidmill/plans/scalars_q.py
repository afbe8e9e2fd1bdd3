"""Scalar function queries: time stamp text and hashes over request rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidmill.functions import timefn as TF
from bidmill.functions.text import compute_hash
from bidmill.plans.registry import query
from bidmill.sources import fixtures as X
from bidmill.sources.fixtures import with_views

HUNDREDTHS = "round(epoch_us(date_new) / 10000.0)::bigint"


@query("time_stamps", with_views(f"""
select dom_rec_id,
       strftime(date_new, '%Y%m%d') as up_to_date,
       strftime(date_new, '%Y%m%d%H%M%S') as up_to_second,
       strftime(make_timestamp(({HUNDREDTHS} // 100) * 1000000), '%Y%m%d%H%M%S')
         || lpad(cast({HUNDREDTHS} % 100 as varchar), 2, '0') as up_to_hundredth,
       strftime(make_timestamp(({HUNDREDTHS} // 100) * 1000000), '%Y%m%d%H%M%S')
         || lpad(cast({HUNDREDTHS} % 100 as varchar), 2, '0') || '_' as prefix,
       strftime(date_new, '%Y%m%d%H%M%S') || '00' as queue_stamp
from event_requests""", "event_requests"))
def q_time_stamps(spark, sf_dir):
    """F11-F15 on every request's arrival time."""
    r = X.event_requests(spark, sf_dir)
    t = F.col("date_new")
    return r.select("dom_rec_id", TF.up_to_date(t).alias("up_to_date"),
                    TF.up_to_second(t).alias("up_to_second"),
                    TF.up_to_hundredth(t).alias("up_to_hundredth"),
                    TF.prefix(t).alias("prefix"), TF.queue_stamp(t).alias("queue_stamp"))


@query("hash_values", with_views("""
select dom_rec_id, md5(bid_list_name) as md5, sha1(bid_list_name) as sha1 from request_queue""",
                                 "dom_rec_queue", "strategy_inputs", "request_queue"))
def q_hash_values(spark, sf_dir):
    """F16: md5 and sha1 hex of text."""
    q = X.request_queue(spark, sf_dir)
    return q.select("dom_rec_id", compute_hash("md5", F.col("bid_list_name")).alias("md5"),
                    compute_hash("sha1", F.col("bid_list_name")).alias("sha1"))
