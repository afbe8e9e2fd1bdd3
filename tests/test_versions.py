"""Committed table versions, atomic claims and snapshot differences."""

import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bidmill.operators import changefeed as CF
from bidmill.operators import requests as R
from bidmill.session import scratch_path
from bidmill.sources.versions import Conflict, VersionedTable, _Files

SNAP = "strategy_id long, baseline_bid decimal(10,4), max_bid decimal(10,4)"
T0, T1, T2 = "2024-05-17 09:00:00", "2024-05-17 09:30:00", "2024-05-17 11:00:00"


def _table(spark, n=200, buckets=8):
    rows = spark.range(n).select(
        F.col("id").alias("strategy_id"), F.lit(Decimal("1.0001")).cast("decimal(10,4)")
        .alias("baseline_bid"), F.when(F.col("id") % 2 == 0, Decimal("2.5"))
        .cast("decimal(10,4)").alias("max_bid"))
    return VersionedTable.create(rows, scratch_path(spark, "t"), ["strategy_id"], buckets)


def _values(df):
    return {r.strategy_id: (r.baseline_bid, r.max_bid) for r in df.collect()}


def test_edits_persist_and_readers_keep_theirs(spark):
    table = _table(spark)
    first = table.read()
    made = table.update("baseline_bid", F.col("baseline_bid") * Decimal("1.05"),
                        F.col("strategy_id") == 7)
    assert len(made.touched) == 1                         # one bucket was rewritten
    assert _values(VersionedTable(spark, table.path).read())[7][0] == Decimal("1.0501")
    table.delete(F.col("max_bid") > 2)                    # unknown rows stay
    assert {k % 2 for k in _values(table.read())} == {1}
    table.insert(spark.createDataFrame([(900, Decimal("3"), None)], SNAP))
    assert table.read().count() == 101
    # the first reader's plan still reads version 1
    assert _values(first) == _values(table.read(1)) and first.count() == 200
    assert [h[:2] for h in table.history()] == [(1, "create"), (2, "update"), (3, "delete"),
                                               (4, "insert")]
    assert table.history()[-1][3] == 101


def test_buckets_without_hits_keep_their_files(spark):
    table = _table(spark)
    before = table.manifest()
    after = table.update("max_bid", F.lit(9), F.col("strategy_id") == 3)
    same = [b for b in before.parts if before.parts[b].folders == after.parts[b].folders]
    assert len(same) == len(before.parts) - 1
    assert table.delete(F.col("strategy_id") == -1).version == after.version   # nothing to commit


def test_two_writers_one_wins_one_retries(spark):
    table = _table(spark)
    base = table.manifest()
    table.update("max_bid", F.lit(5), F.col("strategy_id") == 3)
    with pytest.raises(Conflict):                         # read version 1, same bucket
        table.edit(lambda df: df.withColumn("max_bid", F.lit(6).cast("decimal(10,4)")), "late",
                   where=F.col("strategy_id") == 3, base=base)
    # another bucket: the change moves onto the newer version
    other = _of_other_bucket(table, 3)
    made = table.edit(lambda df: df.withColumn("max_bid", F.lit(6).cast("decimal(10,4)")), "other",
                      where=F.col("strategy_id") == other, base=base)
    assert made.version == 3
    assert (_values(table.read())[3][1], _values(table.read())[other][1]) == (5, 6)
    with pytest.raises(Conflict):                         # serial: anything counts
        table.edit(lambda df: df, "serial", where=F.col("strategy_id") == 50, base=base, serial=True)
    # an insert never conflicts
    one = spark.createDataFrame([(901, None, None)], SNAP)
    table._commit(base, "insert", added=table._write(one, base), read=set())
    assert table.read().count() == 201


def _of_other_bucket(table, key):
    m = table.manifest()
    rows = table._rows(m).select("strategy_id", "_bucket").collect()
    own = {r.strategy_id: r._bucket for r in rows}
    return min(k for k in own if own[k] != own[key])


def test_concurrent_updates_all_count(spark):
    table = _table(spark, n=40, buckets=2)
    one = lambda: table.update("max_bid", F.coalesce("max_bid", F.lit(0)) + 1, F.lit(True))
    threads = [threading.Thread(target=one) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert _values(table.read())[1][1] == 3 and table.manifest().version == 4


def test_only_one_writer_publishes_a_version(spark):
    path = scratch_path(spark, "publish")
    files, won = _Files(spark, path), []
    threads = [threading.Thread(target=lambda k=k: won.append(
        files.publish(f"text {k}", f"{path}/versions/1.json"))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 7 + [True]
    assert files.read(f"{path}/versions/1.json").startswith("text ")
    assert [n for n in files.names(f"{path}/versions") if "draft" in n] == []


def test_unique_inserts_and_ids(spark):
    table = _table(spark, n=10)
    rows = spark.createDataFrame([(3, None, None), (77, None, None), (77, None, None)], SNAP)
    assert table.insert(rows, unique=True).version == 2
    assert sorted(_values(table.read())) == [*range(10), 77]
    assert table.insert(rows, unique=True).version == 3 and table.read().count() == 11
    log = VersionedTable.create(spark.createDataFrame([], "id long, v string"),
                                scratch_path(spark, "log"), ["id"])
    for _ in range(2):
        log.insert_with_ids(spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
                            .repartition(2), "id")
    ids = [r.id for r in log.read().collect()]
    first = [r.id for r in log.read(2).collect()]
    assert len(set(ids)) == 6 and min(set(ids) - set(first)) > max(first)


def test_expire_frees_what_only_old_versions_held(spark):
    table = _table(spark)
    clone = table.clone(scratch_path(spark, "clone"))
    clone.update("max_bid", F.lit(1), F.lit(True))
    assert clone.expire(1) == []                          # the origin's folders stay
    assert table.read().where("max_bid = 1").count() == 0
    table.update("max_bid", F.lit(1), F.col("strategy_id") == 3)
    gone = table.expire(1)
    assert len(gone) == 1 and table.versions() == [2] and table.read().count() == 200
    with pytest.raises(ValueError):
        table.expire(0)


def test_empty_tables(spark):
    table = VersionedTable.create(spark.createDataFrame([], SNAP), scratch_path(spark, "e"),
                                  ["strategy_id"])
    assert table.read().count() == 0 and table.read().schema["max_bid"].dataType.scale == 4
    assert table.update("max_bid", F.lit(1), F.lit(True)).version == 1
    table.insert(spark.createDataFrame([(1, None, None)], SNAP))
    assert table.delete(F.lit(True)).version == 3 and table.read().count() == 0
    with pytest.raises(Conflict):
        VersionedTable.create(spark.createDataFrame([], SNAP), table.path, ["strategy_id"])


def test_changes_read_only_buckets_that_differ(spark):
    table = _table(spark, n=400, buckets=16)
    rows = table.read()
    edited = rows.where("strategy_id <> 5").withColumn("baseline_bid", F.when(
        F.col("strategy_id") == 8, F.lit(7)).otherwise(F.col("baseline_bid")))
    added = spark.createDataFrame([(1000, Decimal("1"), None)], SNAP)
    table.replace(edited.unionByName(added).repartition(3))
    feed = table.changes(1, 2)
    which = table.changed_buckets(1, 2)
    assert 1 <= len(which) <= 3
    read = {f.rsplit("/b=", 1)[1].split("/")[0] for f in feed.inputFiles()}
    assert read == {str(b) for b in which}                # the others aren't scanned
    assert sorted((r.strategy_id, r.change) for r in feed.collect()) == [
        (5, "deleted"), (8, "changed"), (1000, "new")]
    algos = spark.createDataFrame([(5, 1), (8, 2), (1000, 3), (9, 4)], "strategy_id long, algo_id int")
    assert sorted(r.algo_id for r in CF.algos_to_run(feed, algos).collect()) == [2, 3]
    assert [r.strategy_id for r in table.changed_keys(1, 2).orderBy("strategy_id").collect()] == [
        5, 8, 1000]
    # unchanged buckets share their folders, and an equal snapshot changes nothing
    assert table.changed_buckets(2, table.replace(table.read()).version) == []


# --- claims ----------------------------------------------------------------------------

QUEUE = ("dom_rec_id long, status string, process_name string, date_in_process timestamp, "
         "date_processed timestamp, date_error timestamp, dom_rec_result_id long")


def _queue(spark, rows):
    full = [(i, s, None, None, None, None, None) for i, s in rows]
    return VersionedTable.create(spark.createDataFrame(full, QUEUE), scratch_path(spark, "queue"),
                                 ["dom_rec_id"], 4)


def _ids(df):
    return sorted(r.dom_rec_id for r in df.collect())


def test_concurrent_claims_are_disjoint(spark):
    queue = _queue(spark, [(i, "new") for i in range(12)])
    got = {}

    def claim(name):
        got[name] = _ids(R.claim(queue, name, T0, n=5, exclusive=False)[0])
    threads = [threading.Thread(target=claim, args=(f"p{k}",)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got["p0"] + got["p1"]) == list(range(10))
    owners = {r.dom_rec_id: r.process_name for r in queue.read().collect()}
    assert all(owners[i] == name for name, ids in got.items() for i in ids)


def test_the_guard_lets_one_dequeuer_in(spark):
    queue = _queue(spark, [(1, "new"), (2, "new"), (3, "processed")])
    assert _ids(R.claim(queue, "a", T0)[0]) == [1]
    ids, made = R.claim(queue, "b", T1)
    assert _ids(ids) == [] and made.version == 2          # nothing committed
    done = spark.createDataFrame([(1, "processed", 11)],
                                 "dom_rec_id long, status string, dom_rec_result_id long")
    R.finish(queue, done, T1, "a")
    assert _ids(R.claim(queue, "b", T1)[0]) == [2]


def test_an_expired_lease_returns_to_new(spark):
    queue = _queue(spark, [(1, "new"), (2, "new")])
    assert _ids(R.claim(queue, "a", T0, n=2, lease_seconds=3600)[0]) == [1, 2]
    assert _ids(R.claim(queue, "b", T1, lease_seconds=3600)[0]) == []      # still held
    assert _ids(R.claim(queue, "b", T2, lease_seconds=3600)[0]) == [1]     # over: 1 again
    rows = {r.dom_rec_id: (r.status, r.process_name) for r in queue.read().collect()}
    assert rows == {1: ("in_process", "b"), 2: ("new", None)}
    # the first owner comes back late: its outcomes don't count any more
    done = spark.createDataFrame([(1, "processed", 11), (2, "error", None)],
                                 "dom_rec_id long, status string, dom_rec_result_id long")
    R.finish(queue, done, T2, "a")
    assert {r.dom_rec_id: r.status for r in queue.read().collect()} == {1: "in_process", 2: "new"}
    R.finish(queue, done, T2, "b")
    assert {r.dom_rec_id: r.status for r in queue.read().collect()} == {1: "processed", 2: "new"}
