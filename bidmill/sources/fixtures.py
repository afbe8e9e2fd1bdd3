"""Domain tables derived from the driver's parquet tables (FIXTURES.md s.2).

Each builder returns a lazy DataFrame that reads only the columns it needs.
``FIXTURE_SQL`` holds the same definitions as SQL text for the DuckDB oracle;
the two must stay equal (every query's oracle is built on it).
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.operators.running import running_sum
from bidmill.session import ensure_checkpoint_dir, scratch_path, shuffles_released
from bidmill.sources.tables import TABLES, parquet_at, table, version
from bidmill.sources.versions import VersionedTable


def _code_version() -> str:
    """Hash of the package's source: a stored table built by other code is
    not reused."""
    global _CODE
    if _CODE is None:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        h = hashlib.sha1()
        for dirpath, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(dirpath, f), "rb") as fh:
                        h.update(fh.read())
        _CODE = h.hexdigest()[:12]
    return _CODE


_CODE: str | None = None


def _stamp(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> str:
    text = "|".join([_code_version(), sf_dir.rstrip("/"), version(spark, sf_dir, names)])
    return hashlib.sha1(text.encode()).hexdigest()[:16]


def stored(spark: SparkSession, sf_dir: str, name: str, inputs: tuple[str, ...], build) -> DataFrame:
    """A derived table written once for each input version under the shared
    checkpoint folder and read back by every later query, as the reference
    keeps it as a table. Lineage stops at the stored files."""
    return parquet_at(spark, stored_path(
        spark, sf_dir, name, lambda path: build(spark, sf_dir).write.parquet(path), inputs))


def stored_path(spark: SparkSession, sf_dir: str, name: str, write,
                inputs: tuple[str, ...] = TABLES) -> str:
    """Folder of a table that ``write(path)`` makes once for each input version.

    Each writer works in a folder of its own and publishes it by a rename, so
    a reader sees a whole table or none, and of two jobs that build the same
    version the second keeps the first one's."""
    base = f"{ensure_checkpoint_dir(spark)}/bidmill-fixtures/{name}-{_stamp(spark, sf_dir, inputs)}"
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    place = path_of(base)
    fs = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(place):
        draft = f"{base}-{uuid.uuid4().hex}"
        with shuffles_released(spark):
            write(draft)
        if fs.exists(place) or not fs.rename(path_of(draft), place):
            fs.delete(path_of(draft), True)
    return base


def versioned(spark: SparkSession, sf_dir: str, name: str, build, keys: list[str],
              inputs: tuple[str, ...] = TABLES, edited: bool = True) -> VersionedTable:
    """A table of the job's own state with committed versions. Its first rows
    are stored once for each input version; a call that edits gets a clone of
    its own, so edits of one run aren't seen by another."""
    base = VersionedTable(spark, stored_path(
        spark, sf_dir, f"versioned-{name}",
        lambda path: VersionedTable.create(build(spark, sf_dir), path, keys), inputs))
    return base.clone(scratch_path(spark, name)) if edited else base


def queue_table(spark: SparkSession, sf_dir: str, edited: bool = True) -> VersionedTable:
    return versioned(spark, sf_dir, "request_queue", request_queue, ["dom_rec_id"],
                     ("orders", "customer"), edited)


def strategies_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """The strategy snapshots as versions: 1 the previous one, 2 the current."""
    def write(path: str) -> None:
        VersionedTable.create(strategies_previous(spark, sf_dir), path, ["strategy_id"]) \
            .replace(strategies_current(spark, sf_dir))
    return VersionedTable(spark, stored_path(spark, sf_dir, "versioned-strategies", write,
                                             ("supplier",)))


def line_recommender_cumsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line_id, domain_name, percentage_recommendations, cumulative_users
    (built once per input version; see ``stored``)."""
    return stored(spark, sf_dir, "line_recommender_cumsum", ("lineitem",), _build_cumsum)


def _build_cumsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    users = (li.groupBy(F.col("l_suppkey").alias("line_id"), "l_partkey")
               .agg(F.sum("l_quantity").alias("users")))
    cum = running_sum(users, "line_id", [F.col("users").desc(), F.col("l_partkey").asc()],
                      "users", "cumulative_users")
    # share of the line: a per-line total joined back (one row per line)
    totals = users.groupBy("line_id").agg(F.sum("users").alias("line_users"))
    # totals come from the big aggregate, so no count here: AQE broadcasts
    # them at run time when small and splits a hot line_id otherwise
    return (cum.join(totals, "line_id")
               .select("line_id",
                       F.concat(F.lit("site"), F.col("l_partkey").cast("string"),
                                F.lit(".example")).alias("domain_name"),
                       (F.col("users") / F.col("line_users")).alias("percentage_recommendations"),
                       "cumulative_users"))


def linez(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("line_id"))
            .where(F.col("line_id") % 10 != 9))


def site_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey")
    name = F.concat(F.lit("site"), F.col("p_partkey").cast("string"), F.lit(".example"))
    main = part.where(F.col("p_partkey") % 20 != 0).select(
        F.col("p_partkey").alias("site_domain_id"), name.alias("name"))
    dup = part.where(F.col("p_partkey") % 50 == 1).select(
        (F.col("p_partkey") + 1000000).alias("site_domain_id"), name.alias("name"))
    return main.unionByName(dup)


def strategy_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("strategy_id"),
        (k * 10).alias("bid_list_id"),
        (k % 100).alias("line_id"),
        F.when(k % 7 == 0, F.lit(-1)).when(k % 11 == 0, F.lit(0))
         .otherwise((k % 10) * 40 + 50).cast("bigint").alias("unique_count"),
        F.lit(0.1).alias("min_bid"),
        F.lit(5.0).alias("max_bid"),
        F.lit(-1).alias("algorithm_id"),
        F.lit(1).alias("dimension_id"),
        F.when(k % 17 == 0, F.lit(-1.0))
         .otherwise((k % 500) / F.lit(100.0) + F.lit(0.1)).alias("target_ecpm"))


def dom_rec_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("dom_rec_id"),
        F.col("o_custkey").alias("strategy_id"),
        (F.col("o_custkey") * 10).alias("bid_list_id"),
        F.when(F.col("o_orderstatus") == "O", "new")
         .when(F.col("o_orderstatus") == "F", "processed")
         .otherwise("error").alias("status"),
        F.col("o_orderdate").alias("date_new"))


def strategies_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return s.where(F.col("s_suppkey") % 10 != 1).select(
        F.col("s_suppkey").alias("strategy_id"),
        (F.col("s_acctbal") / 100).cast(T.DecimalType(10, 4)).alias("baseline_bid"),
        (F.col("s_acctbal") / 50).cast(T.DecimalType(10, 4)).alias("max_bid"))


def strategies_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    k = F.col("s_suppkey")
    return s.where(k % 10 != 0).select(
        k.alias("strategy_id"),
        F.when(k % 7 == 0, F.col("s_acctbal") / 100 + 1)
         .otherwise(F.col("s_acctbal") / 100).cast(T.DecimalType(10, 4)).alias("baseline_bid"),
        F.when(k % 13 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("s_acctbal") / 50).cast(T.DecimalType(10, 4)).alias("max_bid"))


def strategy_algo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "supplier")
            .select(F.col("s_suppkey").alias("strategy_id"),
                    (F.col("s_nationkey") % 5).alias("algo_id"))
            .distinct())


def uniques_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audience sizes; even customer ids only, so a left join has misses."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.where(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").alias("id"),
        ((F.col("c_custkey") % 10) * 40 + 50).alias("number_of_unique_users"))


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return n.select(F.col("n_nationkey").cast("bigint").alias("id"),
                    F.concat(F.lower(F.col("n_name")), F.lit("@example.com")).alias("email"))


def domain_inputs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relational twin of the strategy inputs, before defaults and joins."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal").select(
        k.alias("strategy_id"),
        (k * 10).alias("bid_list_id"),
        (k % 100).alias("line_id"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(k).cast("bigint").alias("uniques_id"),
        F.col("c_nationkey").cast("bigint").alias("user_id"),
        F.lit(0.1).alias("min_bid"),
        F.lit(5.0).alias("max_bid"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(k % 4).cast("bigint").alias("algorithm_id"),
        F.when(k % 17 == 0, F.lit(None).cast("double"))
         .otherwise((k % 500) / F.lit(100.0) + F.lit(0.1)).alias("target_cpm"),
        (k % 4 == 0).cast("int").alias("modeled"))


def recency_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.where(F.col("c_custkey") % 3 == 0).select(
        F.col("c_custkey").alias("strategy_id"),
        F.when(F.col("c_custkey") % 9 == 0, F.lit(None))
         .otherwise(F.col("c_custkey") % 4).cast("bigint").alias("algorithm_id"),
        (F.col("c_custkey") % 2).cast("int").alias("modeled"))


def strategy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored strategy documents; no bid_baseline key when id % 3 = 0."""
    k = F.col("c_custkey")
    baseline = F.when(k % 3 == 0, "").otherwise('"bid_baseline":1.0,')
    doc = F.concat(F.lit('{"id":'), k.cast("string"), F.lit(',"name":null,"rtb_bidding":{'), baseline,
                   F.lit('"cap":null,"x":"k"},"tags":[1,{"a":[true]}]}'))
    return table(spark, sf_dir, "customer").select(k.alias("strategy_id"), doc.alias("doc"))


def request_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full request queue: dom_rec_queue with the columns a request
    carries (line, target, audience, bids) taken from its strategy's inputs;
    a -1 target or audience in the inputs is NULL here (the queue's way)."""
    from bidmill.joins import broadcast_if_small
    q = dom_rec_queue(spark, sf_dir)
    i = strategy_inputs(spark, sf_dir).select(
        "strategy_id", "line_id",
        F.when(F.col("target_ecpm") != -1, F.col("target_ecpm")).alias("target_cpm"),
        F.when(F.col("unique_count") != -1, F.col("unique_count")).alias("uniques"),
        "min_bid", "max_bid")
    j = q.join(broadcast_if_small(i), "strategy_id", "left")
    return j.select(
        "dom_rec_id",
        F.concat(F.lit("bid list "), F.col("bid_list_id").cast("string")).alias("bid_list_name"),
        "bid_list_id",
        F.concat(F.lit("strategy "), F.col("strategy_id").cast("string")).alias("strategy_name"),
        "line_id", "target_cpm", "uniques", "min_bid", "max_bid", "strategy_id", "status",
        F.lit(None).cast("string").alias("process_name"),
        F.col("date_new").cast("timestamp").alias("date_new"),
        F.lit(None).cast("timestamp").alias("date_in_process"),
        F.lit(None).cast("timestamp").alias("date_processed"),
        F.lit(None).cast("timestamp").alias("date_error"),
        F.lit(None).cast("bigint").alias("dom_rec_result_id"))


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests arriving as events (the stream input of T1): one request per
    event, for the strategy of the event's user."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return e.select(F.col("event_id").alias("dom_rec_id"),
                    F.col("user_id").alias("strategy_id"),
                    (F.col("user_id") * 10).alias("bid_list_id"),
                    F.lit("new").alias("status"),
                    F.col("ts").cast("timestamp").alias("date_new"))


def strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strategy master: line and bidding engine of every strategy."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("strategy_id"), (k % 100).alias("line_id"), (k % 3).alias("bidding_engine_id"))


# ---------------------------------------------------------------------------
# The same tables as SQL text, for the DuckDB oracle (views over the raw tables)

FIXTURE_SQL = {
    "line_recommender_cumsum": """
select line_id, 'site' || l_partkey || '.example' as domain_name,
       users / sum(users) over (partition by line_id) as percentage_recommendations,
       sum(users) over (partition by line_id order by users desc, l_partkey
                        rows between unbounded preceding and current row) as cumulative_users
from (select l_suppkey as line_id, l_partkey, sum(l_quantity) as users
      from lineitem group by l_suppkey, l_partkey) u""",
    "linez": "select s_suppkey as line_id from supplier where s_suppkey % 10 <> 9",
    "site_domains": """
select p_partkey as site_domain_id, 'site' || p_partkey || '.example' as name
from part where p_partkey % 20 <> 0
union all
select p_partkey + 1000000 as site_domain_id, 'site' || p_partkey || '.example' as name
from part where p_partkey % 50 = 1""",
    "strategy_inputs": """
select c_custkey as strategy_id, c_custkey * 10 as bid_list_id, c_custkey % 100 as line_id,
       case when c_custkey % 7 = 0 then -1 when c_custkey % 11 = 0 then 0
            else (c_custkey % 10) * 40 + 50 end as unique_count,
       0.1e0 as min_bid, 5.0e0 as max_bid, -1 as algorithm_id, 1 as dimension_id,
       case when c_custkey % 17 = 0 then -1.0e0
            else (c_custkey % 500) / 100e0 + 0.1e0 end as target_ecpm
from customer""",
    "dom_rec_queue": """
select o_orderkey as dom_rec_id, o_custkey as strategy_id, o_custkey * 10 as bid_list_id,
       case o_orderstatus when 'O' then 'new' when 'F' then 'processed' else 'error' end as status,
       o_orderdate as date_new
from orders""",
    "strategies_current": """
select s_suppkey as strategy_id, cast(s_acctbal / 100 as decimal(10,4)) as baseline_bid,
       cast(s_acctbal / 50 as decimal(10,4)) as max_bid
from supplier where s_suppkey % 10 <> 1""",
    "strategies_previous": """
select s_suppkey as strategy_id,
       cast(case when s_suppkey % 7 = 0 then s_acctbal / 100 + 1 else s_acctbal / 100 end
            as decimal(10,4)) as baseline_bid,
       cast(case when s_suppkey % 13 = 0 then null else s_acctbal / 50 end
            as decimal(10,4)) as max_bid
from supplier where s_suppkey % 10 <> 0""",
    "strategy_algo": "select distinct s_suppkey as strategy_id, s_nationkey % 5 as algo_id from supplier",
    "uniques_selection": """
select c_custkey as id, (c_custkey % 10) * 40 + 50 as number_of_unique_users
from customer where c_custkey % 2 = 0""",
    "logins": "select cast(n_nationkey as bigint) as id, lower(n_name) || '@example.com' as email from nation",
    "domain_inputs_raw": """
select c_custkey as strategy_id, c_custkey * 10 as bid_list_id, c_custkey % 100 as line_id,
       cast(case when c_custkey % 5 = 0 then null else c_custkey end as bigint) as uniques_id,
       cast(c_nationkey as bigint) as user_id, 0.1e0 as min_bid, 5.0e0 as max_bid,
       cast(case when c_custkey % 3 = 0 then null else c_custkey % 4 end as bigint) as algorithm_id,
       case when c_custkey % 17 = 0 then null else (c_custkey % 500) / 100e0 + 0.1e0 end as target_cpm,
       cast(c_custkey % 4 = 0 as integer) as modeled
from customer""",
    "recency_inputs": """
select c_custkey as strategy_id,
       cast(case when c_custkey % 9 = 0 then null else c_custkey % 4 end as bigint) as algorithm_id,
       cast(c_custkey % 2 as integer) as modeled
from customer where c_custkey % 3 = 0""",
    "strategy_documents": """
select c_custkey as strategy_id,
       '{"id":' || c_custkey || ',"name":null,"rtb_bidding":{' ||
       case when c_custkey % 3 = 0 then '' else '"bid_baseline":1.0,' end ||
       '"cap":null,"x":"k"},"tags":[1,{"a":[true]}]}' as doc
from customer""",
    "request_queue": """
select q.dom_rec_id, 'bid list ' || q.bid_list_id as bid_list_name, q.bid_list_id,
       'strategy ' || q.strategy_id as strategy_name, i.line_id,
       case when i.target_ecpm <> -1 then i.target_ecpm end as target_cpm,
       case when i.unique_count <> -1 then i.unique_count end as uniques,
       i.min_bid, i.max_bid, q.strategy_id, q.status, cast(null as varchar) as process_name,
       q.date_new, cast(null as timestamp) as date_in_process,
       cast(null as timestamp) as date_processed, cast(null as timestamp) as date_error,
       cast(null as bigint) as dom_rec_result_id
from dom_rec_queue q left join strategy_inputs i on q.strategy_id = i.strategy_id""",
    "event_requests": """
select event_id as dom_rec_id, user_id as strategy_id, user_id * 10 as bid_list_id,
       'new' as status, ts as date_new from events""",
    "strategies": """
select c_custkey as strategy_id, c_custkey % 100 as line_id, c_custkey % 3 as bidding_engine_id
from customer""",
}


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with CTEs for the fixture views (and other named CTEs).

    ``views`` items are fixture names or ``(name, sql)`` pairs, in dependency
    order.
    """
    parts, seen = [], set()
    for v in views:
        if isinstance(v, tuple):
            name, sql = v
        else:
            name, sql = v, FIXTURE_SQL[v]
        if name in seen:
            continue
        seen.add(name)
        parts.append(f"{name} as ({sql.strip()})")
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body
