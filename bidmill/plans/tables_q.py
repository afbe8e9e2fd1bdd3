"""Sink, scan and table-maintenance queries: each writes through the real
writer or catalog and returns what reading it back gives."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.functions import text as TX
from bidmill.functions.timefn import DEFAULT_RUN_TS, up_to_date, up_to_hundredth
from bidmill.operators import candidates as C
from bidmill.operators import retention as RT
from bidmill.plans import dequeue as DQ
from bidmill.plans.core import cand_sql, candidates_df
from bidmill.plans.payloads_q import PRICED_SQL, priced_dims
from bidmill.plans.registry import query
from bidmill.schemas import OUTPUT_LOG, ddl
from bidmill.session import scratch_path, shuffles_released, written
from bidmill.sources import fixtures as X
from bidmill.sources import sinks
from bidmill.sources.fixtures import with_views

# Fixed values that must equal the reference's: column and field names.
PRED_DDL = ("strategy_id bigint, dimension_value_structs struct<dimension_type_id:int,"
            "dimension_value:struct<first:string,last:string,unit:string>>, "
            "probability_score double, algo_id int")

SCORES_SCHEMA = T.StructType([
    T.StructField("strategy_id", T.LongType()), T.StructField("algo_id", T.IntegerType()),
    T.StructField("dimension_structs", T.StringType()),
    T.StructField("probability_score", T.DoubleType()), T.StructField("target_ecpm", T.DoubleType()),
    T.StructField("dt", T.IntegerType()), T.StructField("timestamp", T.LongType())])


def _name(base: str) -> str:
    return f"bidmill_{base}_{uuid.uuid4().hex[:8]}"


def r6(c):
    return F.round(c, 6) + F.lit(0.0)


def pay_sql(body, *extra):
    return cand_sql(body, ("priced", PRICED_SQL), *extra)


# --- score file (K6, S1) ----------------------------------------------------------

def scores_df(spark, sf_dir):
    """The score file rows: priced input with dims as JSON text, run date and stamp."""
    p = priced_dims(spark, sf_dir)
    return p.select(
        "strategy_id", F.col("algo_id").cast("int").alias("algo_id"),
        F.to_json("dims").alias("dimension_structs"), "probability_score", "target_ecpm",
        up_to_date(DEFAULT_RUN_TS).cast("int").alias("dt"),
        up_to_hundredth(DEFAULT_RUN_TS).cast("bigint").alias("timestamp"))


SCORES_SQL = """
select c.strategy_id, c.algo_id,
       '[{"dimension_type_id":1,"dimension_value":"' || c.site_domain_id || '"}]' as dimension_structs,
       round(c.probability_score, 6) as probability_score, i.target_ecpm,
       20240517 as dt, 2024051709412600 as timestamp
from candidates c join strategy_inputs i on c.strategy_id = i.strategy_id"""


def _export_scores(spark, sf_dir):
    path = scratch_path(spark, "scores")
    sinks.write_delimited(scores_df(spark, sf_dir), path, compression="gzip")
    return path


@query("export_scores", cand_sql(SCORES_SQL))
def q_export_scores(spark, sf_dir):
    """K6: \\001-delimited score file, read back as text columns."""
    path = _export_scores(spark, sf_dir)
    t = spark.read.option("sep", "\u0001").schema(SCORES_SCHEMA).csv(path)
    return t.withColumn("probability_score", F.round("probability_score", 6))


@query("scan_scores", cand_sql(f"""
select strategy_id, algo_id, dimension_structs, probability_score, target_ecpm, dt, timestamp
from ({SCORES_SQL}) s"""))
def q_scan_scores(spark, sf_dir):
    """Fixed names and types over the delimited file."""
    path = _export_scores(spark, sf_dir)
    t = spark.read.schema(SCORES_SCHEMA).option("sep", "\u0001").option("header", "false").csv(path)
    return t.withColumn("probability_score", F.round("probability_score", 6))


# --- JSON price log (K8, K9, S4, S10) --------------------------------------------------

@query("price_log", pay_sql("""
select p.strategy_id, cast(site_domain_id as varchar) as dimension_value,
       round(probability_score, 6) as probability_score, target_ecpm,
       round(multiplier, 6) + 0.0 as multiplier, baseline, 20240517 as dt,
       2024051709412600 as timestamp
from priced p join candidates c using (strategy_id, site_domain_id)
join strategy_inputs i on p.strategy_id = i.strategy_id"""))
def q_price_log(spark, sf_dir):
    """K8: one JSON object per priced row (10 decimals), read back."""
    p = priced_dims(spark, sf_dir)
    rows = p.select("strategy_id", F.col("dims").alias("dimension_structs"), "probability_score",
                    "target_ecpm", "multiplier", "baseline",
                    up_to_date(DEFAULT_RUN_TS).cast("int").alias("dt"),
                    up_to_hundredth(DEFAULT_RUN_TS).cast("bigint").alias("timestamp"))
    path = scratch_path(spark, "price_log")
    sinks.write_json_log(rows, path, mode="overwrite", compression="gzip")
    back = spark.read.schema(rows.schema).json(path)
    return back.select("strategy_id", F.col("dimension_structs")[0]["dimension_value"]
                       .alias("dimension_value"), r6("probability_score").alias("probability_score"),
                       "target_ecpm", r6("multiplier").alias("multiplier"), "baseline", "dt",
                       "timestamp")


EVENT_LOG_SQL = """
select r.dom_rec_id, p.strategy_id, cast(p.site_domain_id as varchar) as dimension_value,
       1 as algo_id, cast(strftime(r.date_new, '%Y%m%d') as integer) as dt,
       round(p.multiplier, 6) + 0.0 as multiplier, p.baseline,
       round(c.probability_score, 6) as probability_score, i.target_ecpm, i.min_bid, i.max_bid,
       cast(strftime(make_timestamp(1000000 * (cast(round(epoch_us(r.date_new) / 10000e0) as bigint)
                                                // 100)), '%Y%m%d%H%M%S') as bigint) * 100
         + cast(round(epoch_us(r.date_new) / 10000e0) as bigint) % 100 as timestamp
from event_requests r join priced p on r.strategy_id = p.strategy_id
join candidates c on p.strategy_id = c.strategy_id and p.site_domain_id = c.site_domain_id
join strategy_inputs i on p.strategy_id = i.strategy_id"""


PARTITIONS = ["algo_id", "dt"]


KINDS = ("log", "input", "output")
NO_DAY = -1  # a missing dt inside an array of days


def _publish(spark, sf_dir, base, kinds=KINDS):
    """K9: the dequeue job over the event requests. The log, the score rows
    (input) and the price lines (output) are published below ``base``, each
    partitioned by (algo_id, dt)."""
    log = DQ.log_rows(DQ.price_requests(spark, sf_dir, X.event_requests(spark, sf_dir),
                                        "target_ecpm_seed_dampen", None, "legacy", False))
    key = F.col("dimension_structs")[0]["dimension_value"]
    part = F.col("algo_id")
    # the requests' rows are many times the units', so what the requests share
    # is made once for each candidate, and their rows are text only. A file
    # holds a candidate's rows side by side: they compress best so
    if "log" in kinds:
        head = T.StructType([OUTPUT_LOG[c] for c in ("dom_rec_id", "strategy_id", "timestamp")])
        own = ("min_bid", "max_bid", "target_ecpm", "baseline", "dimension_structs",
               "probability_score", "multiplier")
        rows = DQ.by_candidate(log, {"heads": sinks.json_head(head)}, {
            "_strategy": F.col("strategy_id"), "_key": key, **{c: F.col(c) for c in own},
            "algo_id": part})
        sinks.write_json_log(rows.sortWithinPartitions("_strategy", "_key").drop("_strategy", "_key"),
                             f"{base}/log", partition_by=PARTITIONS, mode="overwrite",
                             compression="gzip", days="days")
    if "input" in kinds:
        sep = "\u0001"
        own = F.concat_ws(sep, "strategy_id", "algo_id", F.to_json("dimension_structs"),
                          "probability_score", "target_ecpm")
        stamps = F.concat_ws(sep, "dt", "timestamp")
        rows = DQ.by_candidate(
            log, {"stamps": F.when(stamps == "", stamps).otherwise(F.concat(F.lit(sep), stamps))},
            {"_strategy": F.col("strategy_id"), "_key": key, "own": own, "algo_id": part})
        rows = rows.sortWithinPartitions("_strategy", "_key") \
            .select("own", "algo_id", F.explode("days").alias("day")).select("*", "day.*")
        again = F.concat(F.lit("\n"), "own")
        sinks.write_lines(rows, F.concat("own", sinks.joined("stamps", again)), f"{base}/input",
                          PARTITIONS, compression="gzip")
    if "output" in kinds:
        # the distinct entries with their days are shuffled, not one for each day
        rows = DQ.by_candidate(log, {}, {"key": key, **{c: F.col(c) for c in (
            "strategy_id", "multiplier", "baseline")}})
        days = F.transform("days.dt", lambda d: F.coalesce(d, F.lit(NO_DAY)))
        entries = rows.groupBy("key", "strategy_id", "multiplier", "baseline").agg(
            F.array_distinct(F.flatten(F.collect_list(days))).alias("days"))
        entry = F.struct("strategy_id", "multiplier", TX.value_string(
            "strategy_id", "multiplier", "baseline").alias("vs"), "days")
        # a key's entries are gathered and sorted once for all of its lines
        keys = entries.select("key", entry.alias("e")).repartition("key") \
            .groupBy("key").agg(F.sort_array(F.collect_list("e")).alias("es"))
        lines = keys.select("key", "es", F.explode(F.array_distinct(F.flatten("es.days"))).alias("day"))
        lines = lines.select(
            "key", F.nullif("day", F.lit(NO_DAY)).alias("dt"), F.lit(DQ.PUBLISHED_ALGO).alias("algo_id"),
            F.filter("es", lambda e: F.array_contains(e["days"], F.col("day"))).alias("own"))
        sinks.write_lines(lines, F.concat_ws("\t", "key", F.array_join("own.vs", ",")),
                          f"{base}/output", PARTITIONS, compression="gzip", alike=False)


def _published(spark, sf_dir, *kinds):
    """The published files of these kinds. Readers (scans, catalog and
    retention queries) share one copy per input version, which no query
    changes; who reads the log alone doesn't have the others stored."""
    return X.stored_path(spark, sf_dir, "-".join(("published", *kinds)),
                         lambda p: _publish(spark, sf_dir, p, kinds))


def _read_log(spark, base):
    return spark.read.schema(OUTPUT_LOG).json(f"{base}/log")


@query("publish_log", pay_sql(EVENT_LOG_SQL, "event_requests"))
def q_publish_log(spark, sf_dir):
    """K9: the published log, every column read back."""
    base = scratch_path(spark, "published")
    with shuffles_released(spark):
        _publish(spark, sf_dir, base)
    return _read_log(spark, base).select(
        "dom_rec_id", "strategy_id",
        F.col("dimension_structs")[0]["dimension_value"].alias("dimension_value"),
        "algo_id", "dt", r6("multiplier").alias("multiplier"), "baseline",
        r6("probability_score").alias("probability_score"), "target_ecpm", "min_bid", "max_bid",
        "timestamp")


@query("publish_files", pay_sql(f"""
select 'input' as kind, algo_id, dt, count(*) as n_lines, cast(count(*) as bigint) as n_entries
from ({EVENT_LOG_SQL}) l group by algo_id, dt
union all
select 'output', algo_id, dt, count(*), cast(sum(n) as bigint) from (
  select algo_id, dt, dimension_value, count(distinct (strategy_id, multiplier)) as n
  from ({EVENT_LOG_SQL}) l group by algo_id, dt, dimension_value) k group by algo_id, dt""",
                                "event_requests"))
def q_publish_files(spark, sf_dir):
    """K9: lines and entries of the published score and price files."""
    base = _published(spark, sf_dir, "input", "output")
    entries = {"input": F.lit(1), "output": F.size(F.split(F.split("value", "\t")[1], ","))}
    out = None
    for kind, n in entries.items():
        part = spark.read.schema("value string, algo_id int, dt int").text(f"{base}/{kind}") \
            .groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n_lines"), F.sum(n).alias("n_entries")) \
            .select(F.lit(kind).alias("kind"), *PARTITIONS, "n_lines", "n_entries")
        out = part if out is None else out.unionByName(part)
    return out


@query("scan_output_log", pay_sql(f"""
select algo_id, dt, count(*) as n_rows, count(distinct dom_rec_id) as n_requests
from ({EVENT_LOG_SQL}) l group by algo_id, dt""", "event_requests"))
def q_scan_output_log(spark, sf_dir):
    """The partitioned JSON table scanned with partition discovery."""
    back = _read_log(spark, _published(spark, sf_dir, "log"))
    return back.groupBy("algo_id", "dt").agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.countDistinct("dom_rec_id").alias("n_requests"))


@query("preview_log", pay_sql(f"""
select dom_rec_id, strategy_id, dimension_value, dt, multiplier from ({EVENT_LOG_SQL}) l
order by dt, dom_rec_id, dimension_value limit 5""", "event_requests"))
def q_preview_log(spark, sf_dir):
    """S10 + L1: a five-row preview (the limit is the feature), in a fixed order."""
    back = _read_log(spark, _published(spark, sf_dir, "log")).select(
        "dom_rec_id", "strategy_id",
        F.col("dimension_structs")[0]["dimension_value"].alias("dimension_value"), "dt", "multiplier")
    # the five are rounded, not every row of the log
    return back.orderBy("dt", "dom_rec_id", "dimension_value").limit(5) \
        .withColumn("multiplier", r6("multiplier"))


# --- catalog: repair, list, expire, drop, rename (K18-K25) ----------------------------

PARTS_SQL = f"""
select distinct 'algo_id=' || algo_id || '/dt=' || dt as partition, dt
from ({EVENT_LOG_SQL}) l"""

CUTOFF_SQL = """(select cast(strftime(max(date_new)::date - interval 10 day, '%Y%m%d') as integer)
                 from event_requests)"""


@contextmanager
def _log_table(spark, sf_dir):
    """An external table over the published log, gone when the query is built:
    what a query returns is read from the files or was listed before."""
    name = _name("output_log")
    RT.create_partitioned_table(spark, name, ddl(OUTPUT_LOG), PARTITIONS,
                                f"{_published(spark, sf_dir, 'log')}/log")
    try:
        RT.repair_table(spark, name)
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _cutoff(spark, sf_dir, n=10, units="d"):
    req = X.event_requests(spark, sf_dir)
    return req.agg(RT.retention_cutoff(F.max("date_new"), n, units).alias("c")).scalar()


@query("repair_table", pay_sql(f"select partition from ({PARTS_SQL}) p", "event_requests"))
def q_repair_table(spark, sf_dir):
    """K18 + K24: external table over the published folders, partitions recovered."""
    with _log_table(spark, sf_dir) as name:
        return spark.sql(f"SHOW PARTITIONS {name}")


@query("list_partitions", pay_sql(f"select partition from ({PARTS_SQL}) p", "event_requests"))
def q_list_partitions(spark, sf_dir):
    """K19."""
    with _log_table(spark, sf_dir) as name:
        return RT.list_partitions(spark, name)


@query("retention_cutoff", with_views("""
select 10 as n, 'd' as units,
       strftime(max(date_new)::date - interval 10 day, '%Y%m%d') as cutoff from event_requests
union all
select 1, 'm', strftime(max(date_new)::date - interval 31 day, '%Y%m%d') from event_requests""",
                                      "event_requests"))
def q_retention_cutoff(spark, sf_dir):
    """Cutoffs from the latest request date, for 10 days and 1 month."""
    req = X.event_requests(spark, sf_dir)
    d = req.agg(F.max("date_new").alias("m"))
    return d.select(F.lit(10).alias("n"), F.lit("d").alias("units"),
                    RT.retention_cutoff(F.col("m"), 10, "d").alias("cutoff")).unionByName(
        d.select(F.lit(1).alias("n"), F.lit("m").alias("units"),
                 RT.retention_cutoff(F.col("m"), 1, "m").alias("cutoff")))


@query("expired_partitions", pay_sql(
    f"select partition from ({PARTS_SQL}) p where dt < {CUTOFF_SQL}", "event_requests"))
def q_expired_partitions(spark, sf_dir):
    """Partitions older than the 10-day cutoff."""
    with _log_table(spark, sf_dir) as name:
        parts = RT.list_partitions(spark, name)
    return RT.expired_partitions(parts, _cutoff(spark, sf_dir))


@query("drop_statements", pay_sql(f"""
select t.table_name, p.partition,
       'alter table ' || t.table_name || ' drop if exists partition(' ||
       replace(p.partition, '/', ',') || ');' as statement
from ({PARTS_SQL}) p, (select 'output_log' as table_name union all select 'output_log_test') t
where p.dt < {CUTOFF_SQL}""", "event_requests"))
def q_drop_statements(spark, sf_dir):
    """Statements for every table in the list."""
    with _log_table(spark, sf_dir) as name:
        parts = RT.list_partitions(spark, name)
    expired = RT.expired_partitions(parts, _cutoff(spark, sf_dir))
    return RT.drop_statements(expired, ["output_log", "output_log_test"])


@query("apply_retention", pay_sql(
    f"select partition from ({PARTS_SQL}) p where dt >= {CUTOFF_SQL}", "event_requests"))
def q_apply_retention(spark, sf_dir):
    """Drop the expired partitions; what remains is listed."""
    with _log_table(spark, sf_dir) as name:
        expired = RT.expired_partitions(RT.list_partitions(spark, name), _cutoff(spark, sf_dir))
        RT.apply_retention(spark, name, expired)
        return spark.sql(f"SHOW PARTITIONS {name}")


@query("rename_table", pay_sql(f"""
select algo_id, dt, count(*) as n_rows from ({EVENT_LOG_SQL}) l group by algo_id, dt""",
                               "event_requests"))
def q_rename_table(spark, sf_dir):
    """The table under its new name."""
    new = _name("renamed_output_log")
    with _log_table(spark, sf_dir) as old:
        RT.rename_table(spark, old, new)
        counts = written(spark.table(new).groupBy("algo_id", "dt").agg(
            F.count(F.lit(1)).alias("n_rows")), "renamed")
        spark.sql(f"DROP TABLE {new}")
    return counts


# --- predictions table (K1-K5, S5, S9, O1) -------------------------------------------

def _pred_rows(cands):
    return cands.select("strategy_id", C.dimension_struct_from(F.col("site_domain_id"))
                        .alias("dimension_value_structs"), "probability_score",
                        F.col("algo_id").cast("int").alias("algo_id"))


def _flat_preds(df):
    return df.select("strategy_id", F.col("dimension_value_structs.dimension_value.first")
                     .alias("first"), r6("probability_score").alias("probability_score"), "algo_id")


FLAT_CANDS_SQL = """select strategy_id, cast(site_domain_id as varchar) as first,
       round(probability_score, 6) + 0.0 as probability_score, algo_id"""


def _predictions_table(spark, sf_dir):
    """A previous run left partitions -1 and 7; this run rewrites only -1."""
    path = scratch_path(spark, "predictions")
    cands = candidates_df(spark, sf_dir)
    previous = _pred_rows(cands.where(F.col("site_domain_id") % 2 == 0)) \
        .withColumn("algo_id", F.lit(-1)).unionByName(
            _pred_rows(cands).withColumn("algo_id", F.lit(7)))
    sinks.overwrite_partitions(previous, path, ["algo_id"], clear_stale=True)
    sinks.overwrite_partitions(_pred_rows(cands), path, ["algo_id"], sort_by=["strategy_id"])
    return path


@query("write_predictions", cand_sql(f"""
{FLAT_CANDS_SQL} from candidates
union all
{FLAT_CANDS_SQL.replace('algo_id', '7 as algo_id')} from candidates"""))
def q_write_predictions(spark, sf_dir):
    """K1 + O1: dynamic partition overwrite; partition 7 of the earlier run stays."""
    return _flat_preds(spark.read.parquet(_predictions_table(spark, sf_dir)))


@query("scan_predictions", cand_sql(f"{FLAT_CANDS_SQL} from candidates"))
def q_scan_predictions(spark, sf_dir):
    """Partitioned predictions read with a partition filter (pruned)."""
    t = spark.read.parquet(_predictions_table(spark, sf_dir))
    return _flat_preds(t.where(F.col("algo_id") == -1))


@contextmanager
def _pred_catalog(spark, sf_dir):
    """The predictions table in the catalog while a query edits it, with the
    folder its rows are read from afterwards."""
    path = _predictions_table(spark, sf_dir)
    name = _name("dimension_predictions")
    RT.create_partitioned_table(spark, name, PRED_DDL, ["algo_id"], path, fmt="parquet")
    try:
        RT.repair_table(spark, name)
        yield name, path
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _drop_partition(spark, name, path, algo_id):
    """A dropped partition of an external table keeps its files; the table's
    rows are then read without them."""
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (algo_id={algo_id})")
    return spark.read.parquet(path).where(F.col("algo_id") != algo_id)


UNRESOLVED_SQL = """
select s.strategy_id, p.domain_name as first, round(p.percentage_recommendations, 6) + 0.0
       as probability_score
from strategies s join linez l on s.line_id = l.line_id
join line_recommender_cumsum p on l.line_id = p.line_id
where s.bidding_engine_id = 2
  and s.strategy_id in (select strategy_id from request_queue where status = 'new')"""
UNRESOLVED_VIEWS = ("strategies", "linez", "line_recommender_cumsum", "dom_rec_queue",
                    "strategy_inputs", "request_queue")


def _unresolved(spark, sf_dir):
    """J3 + P9: engine-2 strategies among the requested ones (IN by semi join)."""
    wanted = X.request_queue(spark, sf_dir).where(F.col("status") == "new").select("strategy_id")
    s = X.strategies(spark, sf_dir).join(wanted, "strategy_id", "left_semi")
    return C.unresolved_candidates(s, X.linez(spark, sf_dir), X.line_recommender_cumsum(spark, sf_dir),
                                   engine_id=2, strategy_ids=None)


@query("engine_strategies", with_views("""
select strategy_id, line_id from strategies where bidding_engine_id = 2
and strategy_id in (select strategy_id from request_queue where status = 'new')""",
                                       *UNRESOLVED_VIEWS))
def q_engine_strategies(spark, sf_dir):
    """Equality on the engine plus an IN list (here the requested strategies)."""
    wanted = X.request_queue(spark, sf_dir).where(F.col("status") == "new").select("strategy_id")
    s = X.strategies(spark, sf_dir).where(F.col("bidding_engine_id") == 2)
    return s.join(wanted, "strategy_id", "left_semi").select("strategy_id", "line_id")


@query("unresolved_candidates", with_views(UNRESOLVED_SQL, *UNRESOLVED_VIEWS))
def q_unresolved(spark, sf_dir):
    u = _unresolved(spark, sf_dir)
    return u.select("strategy_id", F.col("dimension_value_structs.dimension_value.first").alias("first"),
                    r6("probability_score").alias("probability_score"))


@query("write_static_partition", cand_sql(f"""
{FLAT_CANDS_SQL} from candidates
union all
select strategy_id, first, probability_score, 1 from ({UNRESOLVED_SQL}) u""", *UNRESOLVED_VIEWS[:1],
                                          *UNRESOLVED_VIEWS[3:]))
def q_write_static_partition(spark, sf_dir):
    """K3: INSERT OVERWRITE ... PARTITION (algo_id=1) over the predictions table."""
    with _pred_catalog(spark, sf_dir) as (name, path):
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (algo_id=1) SELECT strategy_id, "
                  "dimension_value_structs, probability_score FROM {rows}",
                  rows=_unresolved(spark, sf_dir))
        return _flat_preds(_drop_partition(spark, name, path, 7))


@query("append_partition", cand_sql(f"""
select algo_id, count(*) as n_rows, count(distinct strategy_id) as n_strategies from (
  {FLAT_CANDS_SQL} from candidates
  union all
  select strategy_id, cast(site_domain_id as varchar), round(probability_score, 6), 1 from candidates
  union all
  select 990001, cast(site_domain_id as varchar), round(probability_score, 6), 1 from candidates) x
group by algo_id"""))
def q_append_partition(spark, sf_dir):
    """K4: INSERT INTO a static partition, also with a constant strategy id."""
    with _pred_catalog(spark, sf_dir) as (name, path):
        now = spark.table(name).where(F.col("algo_id") == -1)
        for who in ("strategy_id", "990001 AS strategy_id"):
            spark.sql(f"INSERT INTO TABLE {name} PARTITION (algo_id=1) "
                      f"SELECT {who}, dimension_value_structs, probability_score FROM {{rows}}",
                      rows=now)
        return _drop_partition(spark, name, path, 7).groupBy("algo_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.countDistinct("strategy_id").alias("n_strategies"))


@query("clear_partition", cand_sql(f"{FLAT_CANDS_SQL} from candidates"))
def q_clear_partition(spark, sf_dir):
    """K5 + P10: INSERT OVERWRITE of one static partition with WHERE 1 = 2 empties it."""
    with _pred_catalog(spark, sf_dir) as (name, path):
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (algo_id=7) SELECT strategy_id, "
                  "dimension_value_structs, probability_score FROM {rows} WHERE 1 = 2",
                  rows=_pred_rows(candidates_df(spark, sf_dir)))
        return _flat_preds(spark.read.parquet(path))


@query("load_partition", cand_sql(f"""
select strategy_id, algo_id, count(*) as n from (
  {FLAT_CANDS_SQL} from candidates
  union all
  select strategy_id, null, null, 1 from ({SCORES_SQL}) s) x group by strategy_id, algo_id"""))
def q_load_partition(spark, sf_dir):
    """A delimited file loaded into partition algo_id=1 (read, then append)."""
    scores = spark.read.schema(SCORES_SCHEMA).option("sep", "\u0001").csv(_export_scores(spark, sf_dir))
    dims = F.from_json("dimension_structs", "array<struct<dimension_type_id:int,dimension_value:string>>")
    rows = scores.select("strategy_id", F.struct(
        dims[0]["dimension_type_id"].alias("dimension_type_id"),
        F.struct(dims[0]["dimension_value"].alias("first"), F.lit("").alias("last"),
                 F.lit("").alias("unit")).alias("dimension_value")).alias("dimension_value_structs"),
        "probability_score", F.lit(1).alias("algo_id"))
    with _pred_catalog(spark, sf_dir) as (name, path):
        rows.write.insertInto(name)
        return _drop_partition(spark, name, path, 7).groupBy("strategy_id", "algo_id").agg(
            F.count(F.lit(1)).alias("n"))


INPUTS_TABLE_SQL = """
select dom_rec_id, strategy_id, bid_list_id, coalesce(line_id, -1) as line_id,
       coalesce(uniques, -1) as unique_count, 'owner@example.com' as email,
       coalesce(min_bid, -1) as min_bid, coalesce(max_bid, -1) as max_bid,
       -1 as algorithm_id, 1 as dimension_id, coalesce(target_cpm, -1.0) as target_ecpm
from request_queue where status = 'new'"""


@query("write_strategy_inputs", with_views(INPUTS_TABLE_SQL, "dom_rec_queue", "strategy_inputs",
                                           "request_queue"))
def q_write_strategy_inputs(spark, sf_dir):
    """K2: the inputs table replaced as a whole (twice: the second write wins)."""
    from bidmill.operators import requests as R
    queue = X.request_queue(spark, sf_dir)
    inputs = R.request_inputs(queue.where(F.col("status") == "new"))
    path = scratch_path(spark, "strategy_inputs")
    sinks.write_table(inputs.where(F.col("strategy_id") % 2 == 0), spark, "x", path=path)
    sinks.write_table(inputs, spark, "x", path=path, mode="overwrite")
    return spark.read.parquet(path)


# --- snapshot edits (K14, K15) ------------------------------------------------------

def _bids(df):
    return df.select("strategy_id", F.col("baseline_bid").cast("double").alias("baseline_bid"),
                     F.col("max_bid").cast("double").alias("max_bid"))


@query("update_bids", with_views("""
select strategy_id,
       cast(case when strategy_id % 11 = 0 then cast(max_bid * 0.95 as decimal(10,4))
                 when strategy_id % 7 = 0 then cast(baseline_bid * 1.05 as decimal(10,4))
                 else baseline_bid end as double) as baseline_bid,
       cast(max_bid as double) as max_bid
from strategies_current""", "strategies_current"))
def q_update_bids(spark, sf_dir):
    """UPDATE .. SET baseline = baseline * 1.05 WHERE .., then = max_bid * 0.95
    WHERE .., each committed as a version of the snapshot table."""
    table = X.versioned(spark, sf_dir, "strategies_current", X.strategies_current, ["strategy_id"])
    table.update("baseline_bid", F.col("baseline_bid") * F.lit(Decimal("1.05")),
                 F.col("strategy_id") % 7 == 0)
    made = table.update("baseline_bid", F.col("max_bid") * F.lit(Decimal("0.95")),
                        F.col("strategy_id") % 11 == 0)
    return _bids(table.read(made.version))


@query("delete_strategy", with_views("""
select strategy_id, cast(baseline_bid as double) as baseline_bid, cast(max_bid as double) as max_bid
from strategies_previous where not coalesce(max_bid > baseline_bid * 3, false)""",
                                     "strategies_previous"))
def q_delete_strategy(spark, sf_dir):
    """DELETE WHERE cond keeps rows where cond is false or unknown; the
    buckets that hold hits are rewritten and committed."""
    table = X.versioned(spark, sf_dir, "strategies_previous", X.strategies_previous,
                        ["strategy_id"])
    made = table.delete(F.col("max_bid") > F.col("baseline_bid") * 3)
    return _bids(table.read(made.version))
