"""Queries that write tables don't disturb each other's lazy results."""

import pytest

import __spark_entry__ as E
from bidmill import session

SMALL = "/root/testdata/sf0.001"
WRITERS = ("write_predictions", "scan_predictions", "append_partition", "clear_partition",
           "load_partition", "write_static_partition", "export_scores", "scan_scores",
           "enqueue_requests", "enqueue_counts", "scan_queue", "export_price_file", "price_log")


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_results_stand_after_all_others_are_built(spark):
    qs = E.queries()
    alone = {n: _rows(qs[n](spark, SMALL)) for n in WRITERS}
    built = {n: qs[n](spark, SMALL) for n in WRITERS}
    for n, df in built.items():
        assert _rows(df) == alone[n], n


def test_no_tables_or_views_stay_in_the_catalog(spark):
    E.queries()["append_partition"](spark, SMALL).count()
    E.queries()["rename_table"](spark, SMALL).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bidmill")]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = Context()
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
