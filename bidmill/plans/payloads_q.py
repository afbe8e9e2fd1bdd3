"""Price file, merge and payload queries.

Non-domain dimensions: the fixtures only hold site domains, so the other
dimension types get values derived from each priced row's site domain id
(see FIXTURES.md, section 4). The path is the same for all of them: price
entries -> (file or in-plan) merge -> payloads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidmill.functions import text as TX
from bidmill.operators import payloads as PL
from bidmill.operators import pricefile as PF
from bidmill.plans.core import cand_sql, price_dampen_df
from bidmill.plans.registry import query
from bidmill.plans import dequeue as DQ
from bidmill.session import scratch_path
from bidmill.sources import fixtures as X
from bidmill.sources import sinks

BASE = PL.DEFAULT_BASE_URL

# dimension name -> value derived from the site domain id (Spark, DuckDB)
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def dim_value(dimension: str, sdid: Column) -> Column:
    if dimension == "site_domain_id2":
        return sdid.cast("string")
    if dimension == "city_id":
        return (sdid % 1000).cast("string")
    if dimension == "mobile_app_id":
        return (sdid % 700).cast("string")
    if dimension == "recency":
        return F.concat_ws(":", (sdid % 30).cast("string"), (sdid % 30 + 7).cast("string"),
                           F.lit("days"))
    if dimension == "time_of_day":
        days = F.array(*[F.lit(d) for d in DAYS])
        return F.concat_ws(":", (sdid % 24).cast("string"), (sdid % 24 + 1).cast("string"),
                           F.get(days, (sdid % 7).cast("int")))
    if dimension == "os_id":
        return (sdid % 10).cast("string")
    raise ValueError(dimension)


def dim_value_sql(dimension: str, c: str = "site_domain_id") -> str:
    return {
        "site_domain_id2": f"cast({c} as varchar)",
        "city_id": f"cast({c} % 1000 as varchar)",
        "mobile_app_id": f"cast({c} % 700 as varchar)",
        "recency": f"({c} % 30) || ':' || ({c} % 30 + 7) || ':days'",
        "time_of_day": (f"({c} % 24) || ':' || ({c} % 24 + 1) || ':' || "
                        f"['monday','tuesday','wednesday','thursday','friday','saturday','sunday']"
                        f"[{c} % 7 + 1]"),
        "os_id": f"cast({c} % 10 as varchar)",
    }[dimension]


# --- Spark side ----------------------------------------------------------------

def priced_dims(spark, sf_dir, dimension: str = "site_domain_id2", priced=None) -> DataFrame:
    """Priced rows with their dimension list (one dimension column); pass
    ``priced`` when one query needs several dimensions of the same run."""
    p = priced if priced is not None else price_dampen_df(spark, sf_dir)
    return p.select("strategy_id", "site_domain_id", "probability_score", "target_ecpm",
                    "algo_id", "multiplier", "baseline",
                    F.array(F.struct(F.lit(1).alias("dimension_type_id"),
                                     dim_value(dimension, F.col("site_domain_id"))
                                     .alias("dimension_value"))).alias("dims"))


def merged_in_plan(spark, sf_dir, dimension: str, priced=None) -> DataFrame:
    """In-plan merge (no text round trip): entries after P12; within one
    strategy and value the file order puts the larger multiplier last."""
    # P12's dedup cannot change a max, so entries go straight to the merge;
    # dealt by the value as well, a hot strategy's rows are many tasks' work
    p = priced_dims(spark, sf_dir, dimension, priced).select(
        "strategy_id", TX.make_key("dims").alias("value"), "multiplier")
    return p.repartition("strategy_id", "value").groupBy("strategy_id", "value").agg(F.max("multiplier").alias("multiplier")) \
        .select("strategy_id", F.lit(dimension).alias("dimension"), "value", "multiplier")


def payloads_df(spark, sf_dir, dimension: str, priced=None) -> DataFrame:
    bid_lists = X.strategy_inputs(spark, sf_dir).select("strategy_id", "bid_list_id")
    return PL.payloads(merged_in_plan(spark, sf_dir, dimension, priced), bid_lists, base_url=BASE,
                       spread=True)


# --- SQL side --------------------------------------------------------------------

PRICED_SQL = """
select strategy_id, site_domain_id,
       (case when hi = lo then (0.3e0 + target_ecpm) / 2
             else 0.3e0 + (target_ecpm - 0.3e0) * (probability_score - lo) / (hi - lo) end)
       / 0.3e0 as multiplier, 0.3e0 as baseline
from (select c.strategy_id, c.site_domain_id, c.probability_score, i.target_ecpm,
             min(probability_score) over (partition by c.strategy_id) as lo,
             max(probability_score) over (partition by c.strategy_id) as hi
      from candidates c join strategy_inputs i on c.strategy_id = i.strategy_id) z"""


def entries_sql(dimension: str) -> str:
    return f"""select distinct {dim_value_sql(dimension)} as key, strategy_id, multiplier,
       baseline from priced"""


def num_text_sql(x: str) -> str:
    """A file number as the comparison shows it: rounded to 10 decimals, since
    the engines' doubles may differ in the last place."""
    return f"rtrim(rtrim(printf('%.10f', {x}), '0'), '.')"


def shown_line(line: Column) -> Column:
    """A price line with its numbers shown like ``num_text_sql`` does."""
    def number(x):
        return F.call_function("format_number", x.cast("double"), F.lit("0.##########"))

    def entry(e):
        p = F.split(e, ":")
        return F.concat_ws(":", p[0], number(p[1]), number(p[2]))
    parts = F.split(line, "\t")
    return F.concat_ws("\t", parts[0], F.array_join(F.transform(F.split(parts[1], ","), entry), ","))


def adj_sql(dimension: str, value: str = "value", m: str = "multiplier") -> str:
    mt = f"printf('%.2f', {m})"
    if dimension == "site_domain_id2":
        return f"""'{{"site_domain":{{"id":"' || {value} || '"}},"multiplier":"' || {mt} || '"}}'"""
    if dimension in ("city_id", "mobile_app_id"):
        return f"""'{{"{dimension}":"' || {value} || '","multiplier":"' || {mt} || '"}}'"""
    names = {"recency": ("recency_from", "recency_to", "time_unit"),
             "time_of_day": ("hour_from", "hour_to", "day_of_week")}.get(dimension)
    if names is None:
        return "null"
    a, b, c = names
    sp = f"string_split({value}, ':')"
    return (f"""'{{"{a}":"' || {sp}[1] || '","{b}":"' || {sp}[2] || '","{c}":"' || {sp}[3]"""
            f""" || '","multiplier":"' || {mt} || '"}}'""")


SEGMENTS_SQL = {k: v for k, v in PL.URL_SEGMENTS.items()}


def url_sql(dimension: str, bid: str = "i.bid_list_id") -> str:
    seg = SEGMENTS_SQL.get(dimension)
    if seg is None:
        return "cast(null as varchar)"
    return f"'{BASE}/bid_pricing/{seg}/' || {bid}"


def payload_sql(dimension: str) -> str:
    """(strategy_id, dimension, bid_list_id, url, body) for one dimension."""
    body = ("""'{"price_adjustments":null}'""" if adj_sql(dimension) == "null" else
            f"""'{{"price_adjustments":[' || string_agg({adj_sql(dimension)}, ',' order by value)"""
            """ || ']}'""")
    return f"""
select m.strategy_id, '{dimension}' as dimension, i.bid_list_id,
       {url_sql(dimension)} as url, {body} as body
from (select strategy_id, key as value, max(multiplier) as multiplier
      from ({entries_sql(dimension)}) e group by strategy_id, key) m
left join strategy_inputs i on m.strategy_id = i.strategy_id
group by m.strategy_id, i.bid_list_id"""


def pay_sql(body: str, *extra) -> str:
    return cand_sql(body, ("priced", PRICED_SQL), *extra)


# --- queries -------------------------------------------------------------------------

@query("parse_dims", pay_sql("""
select strategy_id, site_domain_id, 1 as dimension_type_id,
       cast(site_domain_id as bigint) as dimension_value from priced"""))
def q_parse_dims(spark, sf_dir):
    """F1: the score file's dims text parsed back to array<struct<int, long>>."""
    p = priced_dims(spark, sf_dir)
    txt = p.select("strategy_id", "site_domain_id", F.to_json("dims").alias("dims_text"))
    parsed = txt.select("strategy_id", "site_domain_id",
                        F.explode(TX.parse_dims(F.col("dims_text"))).alias("d"))
    return parsed.select("strategy_id", "site_domain_id", "d.dimension_type_id", "d.dimension_value")


@query("dim_keys", pay_sql("select strategy_id, cast(site_domain_id as varchar) as key from priced"))
def q_dim_keys(spark, sf_dir):
    """TAB-joined dimension values (one dimension here)."""
    return priced_dims(spark, sf_dir).select("strategy_id", TX.make_key("dims").alias("key"))


@query("dedup_prices", pay_sql(f"select key, strategy_id, round(multiplier, 6) + 0.0 as multiplier "
                               f"from ({entries_sql('city_id')}) e"))
def q_dedup_prices(spark, sf_dir):
    """P12 on the city dimension, where several sites share a value."""
    e = PF.price_entries(priced_dims(spark, sf_dir, "city_id"))
    return e.select("key", "strategy_id", (F.round("multiplier", 6) + F.lit(0.0)).alias("multiplier"))


PRICE_LINES_SQL = f"""
select key,
       key || chr(9) || string_agg(cast(strategy_id as varchar) || ':' || {num_text_sql('multiplier')}
                                   || ':' || {num_text_sql('baseline')}, ','
                                   order by strategy_id, multiplier) as line
from ({entries_sql('site_domain_id2')}) e group by key"""


def price_lines_df(spark, sf_dir, dimension="site_domain_id2", priced=None):
    return PF.price_lines(PF.price_entries(priced_dims(spark, sf_dir, dimension, priced)))


@query("price_lines", pay_sql(PRICE_LINES_SQL))
def q_price_lines(spark, sf_dir):
    """A6 + F3: one line per key."""
    return price_lines_df(spark, sf_dir).withColumn("line", shown_line(F.col("line")))


def _export(spark, sf_dir, dimension="site_domain_id2", priced=None):
    base = scratch_path(spark, f"price_file_{dimension}")
    PF.export_price_file(price_lines_df(spark, sf_dir, dimension, priced), base + "/data")
    PF.write_header(spark, PF.header_for([dimension]), base + "/header")
    return base + "/data", base + "/header"


@query("export_price_file", pay_sql(f"select line from ({PRICE_LINES_SQL}) l"))
def q_export_price_file(spark, sf_dir):
    """K7 + O2: key-ordered text export, read back as lines."""
    data, _ = _export(spark, sf_dir)
    return spark.read.text(data).select(shown_line(F.col("value")).alias("line"))


@query("scan_price_file", pay_sql(f"select line as text from ({PRICE_LINES_SQL}) l"))
def q_scan_price_file(spark, sf_dir):
    """Lines with their file order kept (order columns are not compared)."""
    data, _ = _export(spark, sf_dir)
    return PF.read_lines(spark, data).select(shown_line(F.col("text")).alias("text"))


@query("parse_header", pay_sql(" union all ".join(f"""
select '{d}' as file_dimension, idx, case idx when 0 then '{d}'
         else 'strategy_id:bid_price_multiplier' end as name,
       case idx when 0 then 'Long' else 'Array' end as type, n_lines
from (select count(distinct key) as n_lines from ({entries_sql(d)}) e{i}) n{i},
     (select unnest([0, 1]) as idx) c{i}""" for i, d in enumerate(("site_domain_id2", "city_id")))))
def q_parse_header(spark, sf_dir):
    """S3: the headers that two exports write, read and parsed into (index,
    name, type), with the lines of the file that fill the column."""
    priced, out = price_dampen_df(spark, sf_dir), None
    for dimension in ("site_domain_id2", "city_id"):
        data, header = _export(spark, sf_dir, dimension, priced)
        filled = spark.read.text(data).select(F.posexplode(F.split("value", "\t")).alias("idx", "v")) \
            .where("v <> ''").groupBy("idx").agg(F.count(F.lit(1)).alias("n_lines"))
        own = PF.parse_header(PF.read_lines(spark, header)).join(filled, "idx", "left").select(
            F.lit(dimension).alias("file_dimension"), "idx", "name", "type",
            F.coalesce("n_lines", F.lit(0)).alias("n_lines"))
        out = own if out is None else out.unionByName(own)
    return out


def _parsed(spark, sf_dir, dimension="site_domain_id2"):
    data, header = _export(spark, sf_dir, dimension)
    return PF.read_price_file(spark, data, header)


@query("parse_price_lines", pay_sql(f"""
select cast(strategy_id as varchar) as strategy_id, 'site_domain_id2' as dimension, key as value,
       round(cast({num_text_sql('multiplier')} as double), 6) + 0.0 as multiplier, baseline
from ({entries_sql('site_domain_id2')}) e"""))
def q_parse_price_lines(spark, sf_dir):
    """exported file parsed back into (strategy, dimension, value, multiplier)."""
    p = _parsed(spark, sf_dir)
    return p.select("strategy_id", "dimension", "value",
                    (F.round("multiplier", 6) + F.lit(0.0)).alias("multiplier"), "baseline")


@query("merged_multipliers", pay_sql(f"""
select cast(strategy_id as varchar) as strategy_id, 'city_id' as dimension, key as value,
       round(cast({num_text_sql('max(multiplier)')} as double), 6) + 0.0 as multiplier
from ({entries_sql('city_id')}) e group by strategy_id, key"""))
def q_merged_multipliers(spark, sf_dir):
    """A7 through the file, on the city dimension (several entries per value)."""
    m = PF.merged_multipliers(_parsed(spark, sf_dir, "city_id"))
    return m.select("strategy_id", "dimension", "value",
                    (F.round("multiplier", 6) + F.lit(0.0)).alias("multiplier"))


@query("merged_baselines", pay_sql(
    "select distinct cast(strategy_id as varchar) as strategy_id, baseline from priced"))
def q_merged_baselines(spark, sf_dir):
    """A8 through the file."""
    return PF.merged_baselines(_parsed(spark, sf_dir))


def _adj_query(dimension: str):
    def run(spark, sf_dir):
        p = payloads_df(spark, sf_dir, dimension)
        return p.select("strategy_id", "url", "body")
    run.__doc__ = f"F5 + F6 + F10: payloads of the {dimension} bid lists."
    return run


for _name, _dim in (("adj_site_domain", "site_domain_id2"), ("adj_city", "city_id"),
                    ("adj_mobile_app", "mobile_app_id"), ("adj_recency", "recency"),
                    ("adj_time_of_day", "time_of_day")):
    query(_name, pay_sql(f"select strategy_id, url, body from ({payload_sql(_dim)}) p"))(
        _adj_query(_dim))


@query("payload_urls", pay_sql(" union all ".join(
    f"select strategy_id, dimension, url, body is not null and body <> '{{\"price_adjustments\":null}}'"
    f" as known from ({payload_sql(d)}) p{i}"
    for i, d in enumerate(("site_domain_id2", "recency", "os_id")))))
def q_payload_urls(spark, sf_dir):
    """F6 + J11 (+ unknown dimension: NULL url and a null adjustment list)."""
    out = None
    priced = price_dampen_df(spark, sf_dir)
    for d in ("site_domain_id2", "recency", "os_id"):
        p = payloads_df(spark, sf_dir, d, priced).select(
            "strategy_id", "dimension", "url",
            (F.col("body") != F.lit('{"price_adjustments":null}')).alias("known"))
        out = p if out is None else out.unionByName(p)
    return out


@query("money_text", pay_sql("""
select strategy_id, site_domain_id, printf('%.2f', multiplier) as multiplier_text from priced"""))
def q_money_text(spark, sf_dir):
    """two-decimal multiplier text."""
    p = price_dampen_df(spark, sf_dir)
    return p.select("strategy_id", "site_domain_id", TX.money_text("multiplier").alias("multiplier_text"))


REQ_VIEWS = ("dom_rec_queue", "request_queue")


@query("requested_payloads", pay_sql(f"""
select q.dom_rec_id, p.strategy_id, p.url, p.body
from request_queue q join ({payload_sql('site_domain_id2')}) p on q.strategy_id = p.strategy_id
where q.status = 'new'""", *REQ_VIEWS))
def q_requested_payloads(spark, sf_dir):
    """P11 + F10: payloads of the claimed (new) requests only."""
    req = X.request_queue(spark, sf_dir).where(F.col("status") == "new").select("dom_rec_id", "strategy_id")
    p = payloads_df(spark, sf_dir, "site_domain_id2")
    return req.join(p, "strategy_id").select("dom_rec_id", "strategy_id", "url", "body")


@query("payload_map", pay_sql(f"""
select url, arg_max(body, strategy_id) as body
from ({payload_sql('city_id')}) p where url is not null group by url"""))
def q_payload_map(spark, sf_dir):
    """Url -> body, last wins per url."""
    return PL.payload_map(payloads_df(spark, sf_dir, "city_id"))


def baselines_in_plan(spark, sf_dir, dimension="site_domain_id2", priced=None):
    """A8 without the text round trip: the first line naming a strategy is its
    smallest key, and inside that line its last entry is the largest
    multiplier (lines list entries by strategy, then multiplier)."""
    e = PF.price_entries(priced_dims(spark, sf_dir, dimension, priced))
    return e.groupBy("strategy_id").agg(F.min_by("baseline", F.struct(
        "key", (-F.col("multiplier")).alias("neg_multiplier"))).alias("baseline"))


def baseline_docs_df(spark, sf_dir, priced=None):
    base = baselines_in_plan(spark, sf_dir, priced=priced)
    return PL.baseline_documents(base, X.strategy_documents(spark, sf_dir), base_url=BASE)


BASELINE_SQL = f"""
select b.strategy_id, '{BASE}/strategies/' || b.strategy_id as url,
       case when d.doc like '%"bid_baseline"%'
            then replace(d.doc, '"bid_baseline":1.0',
                         '"bid_baseline":' || cast(cast(printf('%.2f', b.baseline) as double) as varchar))
            else d.doc end as body
from (select distinct strategy_id, baseline from priced) b
join strategy_documents d on b.strategy_id = d.strategy_id"""


@query("baseline_patch", pay_sql(BASELINE_SQL, "strategy_documents"))
def q_baseline_patch(spark, sf_dir):
    """J12 + F8 + F9: stored documents with the new two-decimal baseline."""
    return baseline_docs_df(spark, sf_dir)


@query("baseline_list", pay_sql(
    f"select strategy_id, to_json([[url, body]]) as baseline_bid_data from ({BASELINE_SQL}) b",
    "strategy_documents"))
def q_baseline_list(spark, sf_dir):
    """A10: [[url, body]] per strategy."""
    return PL.baseline_list(baseline_docs_df(spark, sf_dir))


def stored_results(spark, sf_dir, requests, table: str = "dom_rec_results") -> DataFrame:
    """The dequeue job from requests to stored results (K10): price the
    requests, build payloads and documents, append one row for each request
    under a generated id, and read the table back."""
    path = scratch_path(spark, table)
    rows = DQ.request_result_rows(spark, sf_dir, requests, base_url=BASE)
    return sinks.append_with_ids(rows, spark, table, id_col="dom_rec_result_id", path=path)


REQUEST_RESULTS_SQL = f"""
select q.dom_rec_id, to_json(map([p.url], [p.body])) as list_data,
       b.baseline_bid_data, true as has_id
from request_queue q join ({payload_sql('site_domain_id2')}) p on q.strategy_id = p.strategy_id
left join (select strategy_id, to_json([[url, body]]) as baseline_bid_data
           from ({BASELINE_SQL}) d) b on q.strategy_id = b.strategy_id
where q.status = 'new' and p.url is not null"""


@query("request_results", pay_sql(REQUEST_RESULTS_SQL, *REQ_VIEWS, "strategy_documents"))
def q_request_results(spark, sf_dir):
    """Stored result rows of the new requests, with the id read back."""
    requests = X.request_queue(spark, sf_dir).where(F.col("status") == "new")
    last = PL.last_results(stored_results(spark, sf_dir, requests))
    return last.select("dom_rec_id", "list_data", "baseline_bid_data",
                       F.col("dom_rec_result_id").isNotNull().alias("has_id"))
