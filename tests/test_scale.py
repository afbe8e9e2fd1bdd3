"""Work and disk that must grow no faster than the input."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from bidmill.operators import pricefile as PF
from bidmill.sources import rejects as RJ


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _above_the_entries(plan: str) -> str:
    """The plan down to the generator that makes a row of each list entry."""
    return plan[:plan.index("Generate posexplode(")]


def test_a_line_is_cut_once_not_for_each_entry(spark, tmp_path):
    header, data = str(tmp_path / "h"), str(tmp_path / "d")
    PF.write_header(spark, PF.header_for(["d"]), header)
    spark.createDataFrame([("k\t5:1.2:0.3,6:2.2:0.3",), ("bad",)], "value string").write.text(data)
    parsed = PF.read_price_file(spark, data, header)
    checked = RJ.checked_price_lines(spark, header, data)
    for df in (parsed, checked):
        plan = _plan(df)
        assert not re.search(r"split\(text#\d+, \t", _above_the_entries(plan))
        assert re.search(r"split\(text#\d+, \t", plan)
    good = parsed.where(F.col("strategy_id").isNotNull()).collect()
    assert sorted((r.strategy_id, r.value, r.multiplier, r.baseline) for r in good) == [
        ("5", "k", 1.2, 0.3), ("6", "k", 2.2, 0.3)]
    assert sorted((r.reason or "", r.strategy_id, r.value) for r in checked.collect()) == [
        ("", "5", "k"), ("", "6", "k"), ("2 columns expected", "bad", None)]


def test_candidates_are_not_shuffled_row_by_row(spark, monkeypatch):
    """Units of one row: as many tasks as their candidates ask for, and no
    exchange above the join that makes them."""
    from bidmill.operators import candidates as C
    monkeypatch.setattr(C, "ROWS_PER_TASK", 10)
    inputs = spark.range(20).selectExpr("id as strategy_id", "7L as line_id",
                                        "if(id = 3, null, -1L) as unique_count", "-1 as algorithm_id")
    lines = spark.createDataFrame([(7,)], "line_id long")
    preds = spark.range(5).selectExpr("7L as line_id", "'d' || id as domain_name",
                                      "0.1D as percentage_recommendations",
                                      "cast(id as double) as cumulative_users")
    sites = spark.range(5).selectExpr("id as site_domain_id", "'d' || id as name")
    out = C.candidates(inputs, lines, preds, sites)
    plan = _plan(out)
    join = plan.index("HashJoin")
    assert "Exchange" not in plan[:join] and "Aggregate" not in plan[:join]
    assert "REPARTITION_BY_NUM" in plan and out.rdd.getNumPartitions() == 10
    assert out.count() == 19 * 5 + 1 == out.distinct().count()
    # rows that share a key, and rows without one, as before
    more = inputs.unionByName(inputs.where("strategy_id = 3").withColumn("unique_count", F.lit(1)))
    more = more.unionByName(inputs.where("strategy_id = 5").withColumn("strategy_id", F.lit(None)))
    got = C.candidates(more, lines, preds, sites)
    assert got.where("strategy_id = 3").count() == 2 and got.where("strategy_id is null").count() == 5
    assert got.count() == 19 * 5 + 2 + 5 == got.distinct().count()


def test_requests_of_equal_inputs_are_priced_once(spark, monkeypatch):
    """Repeated, hot and null requests: rows as if each was priced by itself."""
    from bidmill.plans import dequeue as DQ
    from bidmill.sources import fixtures as X
    small = "/root/testdata/sf0.001"
    monkeypatch.setattr(DQ, "ROWS_PER_TASK", 100)
    ids = [(i, 2 + i % 3) for i in range(60)] + [(100, 2), (100, 2), (101, None), (None, 3)]
    requests = spark.createDataFrame(ids, "dom_rec_id long, strategy_id long").selectExpr(
        "*", "strategy_id * 10 as bid_list_id", "'new' as status",
        "timestamp'2024-01-01 00:00:00' as date_new")
    t, asked = DQ.static_tables(spark, small), []
    price = DQ.price_inputs

    def spy(inputs, *rest):
        asked.append(inputs.count())
        return price(inputs, *rest)
    monkeypatch.setattr(DQ, "price_inputs", spy)
    cols = ["dom_rec_id", "strategy_id", "site_domain_id", "multiplier", "date_new"]
    got = sorted(map(tuple, DQ.price_requests(spark, small, requests).select(*cols).collect()))
    assert max(asked) <= 4
    plain = price(DQ.R.request_inputs(DQ.request_details(requests, t["strategy_inputs"]),
                                      extra=("date_new",)), t, "target_ecpm_seed_dampen", "legacy",
                  ("date_new",))
    assert got == sorted(map(tuple, plain.select(*cols).collect())) and len(got) > 60
    keys = ["dom_rec_id", "strategy_id", "url", "body"]
    bodies = sorted(map(tuple, DQ.batch_payloads(requests, t).select(*keys).collect()))
    assert bodies == sorted(map(tuple, DQ.request_payloads(plain, requests).select(*keys).collect()))
    assert X.event_requests(spark, small).columns == requests.columns


def test_published_files_are_compressed(spark, tmp_path):
    from bidmill.plans import tables_q as TQ
    TQ._publish(spark, "/root/testdata/sf0.001", str(tmp_path / "p"))
    for kind in ("log", "input", "output"):
        files = list((tmp_path / "p" / kind).rglob("part-*"))
        assert files and all(f.name.endswith(".gz") for f in files)


def _published_lines(base):
    import gzip
    return [(f, gzip.open(f, "rt").read().splitlines()) for f in sorted(base.rglob("part-*"))]


def test_log_readers_store_the_log_alone_with_equal_rows_side_by_side(spark, tmp_path, monkeypatch):
    """What list_partitions, expired_partitions, repair_table and preview_log
    read: all rows of the log, those of a candidate next to each other."""
    import json
    import os
    from bidmill.plans import tables_q as TQ
    from bidmill.sources import fixtures as X
    base, asked = tmp_path / "p", []
    monkeypatch.setattr(X, "stored_path", lambda spark, sf_dir, name, write, *a: asked.append(
        (name, write)) or str(base))
    assert TQ._published(spark, "/root/testdata/sf0.001", "log") == str(base)
    monkeypatch.undo()
    asked[0][1](str(base))
    assert os.listdir(base) == ["log"]
    n = 0
    for _, lines in _published_lines(base):
        rows = [json.loads(x) for x in lines]
        n += len(rows)
        at = [(r["strategy_id"], r["dimension_structs"][0]["dimension_value"], r["dom_rec_id"])
              for r in rows]
        assert len({x[:2] for x in at}) == 1 + sum(a[:2] != b[:2] for a, b in zip(at, at[1:]))
        assert at == sorted(at)
    priced = TQ.DQ.price_requests(spark, "/root/testdata/sf0.001",
                                  X.event_requests(spark, "/root/testdata/sf0.001"))
    assert n == priced.count() > 0


def test_price_lines_shuffle_an_entry_once_for_all_days(spark, tmp_path, monkeypatch):
    """Lines by day and value, also of requests without a time; the days of an
    entry travel together."""
    from bidmill.plans import tables_q as TQ
    rows = [(s, d, k, float(s)) for s in (1, 2) for d in (20240101, 20240102, None, 20240101)
            for k in ("a", "b")] + [(3, 20240102, "b", 0.5)]
    made = spark.createDataFrame(rows, "strategy_id long, dt int, k string, multiplier double")
    made = made.selectExpr(
        "strategy_id", "array(struct(1L as dimension_type_id, k as dimension_value)) as "
        "dimension_structs", "0.5D as probability_score", "0.1D as min_bid", "5D as max_bid",
        "1D as target_ecpm", "1L as timestamp", "multiplier", "0.3D as baseline",
        "7L as dom_rec_id", "1 as algo_id", "dt")
    monkeypatch.setattr(TQ.X, "event_requests", lambda *a: None)
    monkeypatch.setattr(TQ.DQ, "price_requests", lambda *a: None)
    monkeypatch.setattr(TQ.DQ, "log_rows", lambda priced: made)
    TQ._publish(spark, "/nowhere", str(tmp_path / "p"))
    got = {(f.parent.name, x.split("\t")[0]): len(x.split("\t")[1].split(","))
           for f, lines in _published_lines(tmp_path / "p" / "output") for x in lines}
    none = "dt=__HIVE_DEFAULT_PARTITION__"
    assert got == {("dt=20240101", "a"): 2, ("dt=20240101", "b"): 2, ("dt=20240102", "a"): 2,
                   ("dt=20240102", "b"): 3, (none, "a"): 2, (none, "b"): 2}
    for kind, n in (("log", 17), ("input", 17)):
        assert sum(len(x) for _, x in _published_lines(tmp_path / "p" / kind)) == n


def test_writes_release_their_shuffle_files(spark):
    from bidmill.session import shuffles_released, written
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with shuffles_released(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before
    assert written(spark.range(100).groupBy((F.col("id") % 3).alias("k")).count(), "t").count() == 3


def test_published_rows_are_made_once_for_a_candidate_and_day(spark, tmp_path, monkeypatch):
    """Repeated, hot and undated requests: every line as if each row was
    written by itself, from fewer rows than lines."""
    import json
    from bidmill.plans import tables_q as TQ
    from bidmill.sources import sinks
    small, DQ = "/root/testdata/sf0.001", TQ.DQ
    monkeypatch.setattr(DQ, "ROWS_PER_TASK", 4000)
    monkeypatch.setattr(DQ, "REQUESTS_PER_SHARE", 12)
    ids = [(i, (2, 3, 7)[i % 3], None if i % 7 == 0 else f"2024-01-0{1 + i % 2} 10:00:00.129") for i in range(60)]
    ids += [(100, 2, "2024-01-02 00:00:00")] * 2 + [(101, None, None), (None, 3, None)]
    requests = spark.createDataFrame(ids, "dom_rec_id long, strategy_id long, d string").selectExpr(
        "dom_rec_id", "strategy_id", "strategy_id * 10 as bid_list_id", "'new' as status",
        "cast(d as timestamp) as date_new")
    monkeypatch.setattr(TQ.X, "event_requests", lambda *a: requests)
    handed, write = [], sinks.write_lines

    def spy(df, *rest, **options):
        handed.append(df.count())
        write(df, *rest, **options)
    monkeypatch.setattr(sinks, "write_lines", spy)
    TQ._publish(spark, small, str(tmp_path / "p"))
    flat = DQ.log_rows(DQ.price_requests(spark, small, requests)).cache()
    none = "dt=__HIVE_DEFAULT_PARTITION__"

    def lines(kind):
        return sorted((f.parent.name, x) for f, own in _published_lines(tmp_path / "p" / kind)
                      for x in own)
    columns = ["dom_rec_id", "strategy_id", "timestamp", "min_bid", "max_bid", "target_ecpm",
               "baseline", "dimension_structs", "probability_score", "multiplier"]
    sinks.write_json_log(flat.select(*columns, "algo_id", "dt"), str(tmp_path / "plain"),
                         partition_by=["algo_id", "dt"])
    plain = sorted((f.parent.name, x) for f in (tmp_path / "plain").rglob("part-*")
                   for x in f.read_text().splitlines())
    assert lines("log") == plain and len(plain) == flat.count() > 2 * handed[0]
    assert any(d == none and "timestamp" not in json.loads(x) for d, x in plain)
    scores = flat.select("dt", F.concat_ws("\u0001", "strategy_id", "algo_id", F.to_json(
        "dimension_structs"), "probability_score", "target_ecpm", "dt", "timestamp").alias("v"))
    assert lines("input") == sorted((none if r.dt is None else f"dt={r.dt}", r.v)
                                    for r in scores.collect())
    entries = {(none if r.dt is None else f"dt={r.dt}", r.dimension_structs[0].dimension_value,
                f"{r.strategy_id}:{r.multiplier}:{r.baseline}") for r in flat.collect()}
    got = [(d, x.split("\t")[0], e) for d, x in lines("output") for e in x.split("\t")[1].split(",")]
    assert sorted(got) == sorted(entries) and len(got) > 20


def test_json_and_score_files_are_compressed(spark, tmp_path, monkeypatch):
    """price_log, and the score file that scan_scores_checked reads."""
    from bidmill.plans import tables_q as TQ
    small = "/root/testdata/sf0.001"
    monkeypatch.setattr(TQ, "scratch_path", lambda spark, name: str(tmp_path / name))
    rows = TQ.q_price_log(spark, small)
    assert TQ._export_scores(spark, small) == str(tmp_path / "scores")
    for name in ("price_log", "scores"):
        files = list((tmp_path / name).rglob("part-*"))
        assert files and all(f.name.endswith(".gz") for f in files)
    scores = spark.read.schema(TQ.SCORES_SCHEMA).option("sep", "\u0001").csv(str(tmp_path / "scores"))
    assert rows.count() == scores.where("strategy_id is not null").count() > 0


def test_the_lines_of_good_rows_are_not_stored_again(spark, tmp_path, monkeypatch):
    """scan_scores_checked, and the other checked scans: a good row's columns
    and a reject's line and place are stored, each once."""
    data = str(tmp_path / "d")
    spark.createDataFrame([("5,7",), ("6,x",), ("8,",)], "value string").coalesce(1).write.text(data)
    lines = RJ._lines(spark, data)
    v = F.split("text", ",")
    checked = lines.select(*[c for c in RJ.REJECT_COLUMNS if c not in ("pos", "reason")],
                           F.lit(0).alias("pos"), F.when(v[1] == "x", "no number").alias("reason"),
                           v[0].cast("int").alias("k"), v[1].try_cast("int").alias("n"))
    monkeypatch.setattr(RJ, "scratch_path", lambda spark, name: str(tmp_path / name))
    good, rejects = RJ.split(checked)
    stored = spark.read.parquet(str(tmp_path / "checked"))
    assert stored.where("not bad").select(*RJ.REJECT_COLUMNS).distinct().collect() == [
        (None,) * len(RJ.REJECT_COLUMNS)]
    assert sorted(map(tuple, good.collect())) == [(5, 7), (8, None)] and good.columns == ["k", "n"]
    (bad,) = rejects.collect()
    assert (bad.text, bad.reason, bad.pos, bad.block) == ("6,x", "no number", 0, 0)
    assert bad.file and bad.seq is not None


def test_results_are_stored_small_and_read_without_a_shuffle(spark, tmp_path):
    """request_results, dequeue_run: the last result of each request, also of
    those with several or without an id."""
    from bidmill.operators import payloads as PL
    from bidmill.sources import sinks
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, None)],
                                 "dom_rec_id long, list_data string")
    stored = sinks.append_with_ids(rows, spark, "r", "dom_rec_result_id", str(tmp_path / "r"))
    assert all(f.name.endswith(".zstd.parquet") for f in (tmp_path / "r").rglob("part-*"))
    last = PL.last_results(stored)
    plan = _plan(last)
    assert re.search(r"BroadcastHashJoin \[dom_rec_id#\d+L\], \[dom_rec_id#\d+L\], LeftOuter", plan)
    keys = ["dom_rec_id", "dom_rec_result_id", "list_data"]
    before = stored.join(PL.result_ids(stored), keys[:2]).select(*keys)
    assert sorted(map(str, last.select(*keys).collect())) == sorted(map(str, before.collect()))
    assert last.count() == 3


def test_bodies_are_stored_before_they_are_shuffled(spark, monkeypatch):
    from bidmill.plans import dequeue as DQ
    from bidmill.sources import fixtures as X
    names, write = [], DQ.written
    monkeypatch.setattr(DQ, "written", lambda df, name: names.append(name) or write(df, name))
    requests = X.request_queue(spark, "/root/testdata/sf0.001").where("status = 'new'")
    rows = DQ.request_result_rows(spark, "/root/testdata/sf0.001", requests)
    assert names[-1] == "bodies" and rows.count() > 0


def test_size_of_a_compressed_file_is_not_taken_for_its_rows(spark, tmp_path):
    from bidmill.joins import is_small, planned_bytes, row_width
    spark.range(200_000).selectExpr("id", "'site' || id || '.example' as name").coalesce(1) \
        .write.parquet(str(tmp_path / "t"), compression="zstd")
    df = spark.read.parquet(str(tmp_path / "t"))
    bound = planned_bytes(df) * 8 + 1
    assert 200_000 * row_width(df.schema) > bound and not is_small(df, bound)
    assert is_small(df, 200_000 * row_width(df.schema))


def test_a_batch_of_many_units_is_priced_without_large_broadcasts(spark, monkeypatch):
    """stream_requests: the same payloads when the units are above the bound."""
    from bidmill.plans import dequeue as DQ
    from bidmill.operators import pricing as P
    small, asked = "/root/testdata/sf0.001", []
    requests = spark.range(40).selectExpr("id as dom_rec_id", "2 + id % 5 as strategy_id",
                                          "id * 10 as bid_list_id", "'new' as status")
    t = DQ.static_tables(spark, small)
    want = sorted(map(tuple, DQ.batch_payloads(requests, t).collect()))
    monkeypatch.setattr(DQ, "BATCH_BROADCAST", 1)
    price = P.PRICING["target_ecpm_seed_dampen"]
    monkeypatch.setitem(P.PRICING, "target_ecpm_seed_dampen",
                        lambda *a, **k: asked.append(k["small_groups"]) or price(*a, **k))
    assert sorted(map(tuple, DQ.batch_payloads(requests, t).collect())) == want and want
    assert asked == [False]
