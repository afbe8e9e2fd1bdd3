"""Candidate selection: cap rules, dictionary misses, one-pass = textbook form."""

import pytest

from bidmill.operators import candidates as C
from bidmill.sources import fixtures as X
from tests.conftest import SF_SMALL


def _tables(spark, cap, first_in_dictionary=True):
    inputs = spark.createDataFrame([(1, 7, cap, -1)],
                                   "strategy_id long, line_id long, unique_count long, algorithm_id int")
    lines = spark.createDataFrame([(7,)], "line_id long")
    preds = spark.createDataFrame(
        [(7, "a.example", 0.5, 40.0), (7, "b.example", 0.3, 90.0), (7, "c.example", 0.2, 130.0)],
        "line_id long, domain_name string, percentage_recommendations double, cumulative_users double")
    names = ["b.example", "c.example"] + (["a.example"] if first_in_dictionary else [])
    sites = spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)],
                                  "site_domain_id long, name string")
    return inputs, lines, preds, sites


def _plain(spark, inputs, lines, preds, sites):
    """Candidates by looking at each strategy's domains one by one."""
    known = {r.line_id for r in lines.collect()}
    named, shown = {}, {}
    for r in sites.collect():
        named.setdefault(r["name"], []).append(r.site_domain_id)
    for r in preds.collect():
        if r.line_id in known:
            shown.setdefault(r.line_id, []).extend(
                (r.cumulative_users, i, r.percentage_recommendations)
                for i in named.get(r.domain_name, ()))
    out, units = set(), {}
    for r in inputs.collect():
        units.setdefault(r.strategy_id, []).append(r)
    for s, own in units.items():
        first = min(((x[:2] for r in own for x in shown.get(r.line_id, ()))), default=None)
        for r in own:
            for users, i, score in shown.get(r.line_id, ()):
                fits = r.unique_count is not None and (r.unique_count == -1 or users <= r.unique_count)
                if fits or (users, i) == first:
                    out.add((s, i, score, r.algorithm_id))
    return spark.createDataFrame(sorted(out), "strategy_id long, site_domain_id long, "
                                              "probability_score double, algo_id int")


def _picked(spark, cap, first_in_dictionary=True):
    t = _tables(spark, cap, first_in_dictionary)
    ids = {r.site_domain_id: r.probability_score for r in C.candidates(*t).collect()}
    return sorted(ids.values(), reverse=True)


@pytest.mark.parametrize("cap,expected", [
    (100, [0.5, 0.3]), (10, [0.5]), (-1, [0.5, 0.3, 0.2]), (None, [0.5])])
def test_caps(spark, cap, expected):
    assert _picked(spark, cap) == expected


def test_first_domain_missing_from_dictionary(spark):
    # the 40-user domain is not in the dictionary: it vanishes before ranking
    assert _picked(spark, 10, first_in_dictionary=False) == [0.3]


def test_one_pass_equals_window_form(spark):
    args = (X.strategy_inputs(spark, SF_SMALL), X.linez(spark, SF_SMALL),
            X.line_recommender_cumsum(spark, SF_SMALL), X.site_domains(spark, SF_SMALL))
    a = C.candidates(*args)
    b = _plain(spark, *args)
    assert a.count() == 564
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_keys_keep_requests_apart(spark):
    inputs, lines, preds, sites = _tables(spark, 10)
    two = inputs.selectExpr("1 as dom_rec_id", "*").unionByName(
        inputs.selectExpr("2 as dom_rec_id", "strategy_id", "line_id", "-1 as unique_count",
                          "algorithm_id"))
    out = C.candidates(two, lines, preds, sites, keys=("dom_rec_id", "strategy_id"))
    counts = {r.dom_rec_id: r["count"] for r in out.groupBy("dom_rec_id").count().collect()}
    assert counts == {1: 1, 2: 3}


def test_hot_line_equals_window_form(spark):
    """One line holds most strategies and domains (the skew case), with
    duplicate dictionary names, NULL/-1/0 caps and a second line."""
    strategies = [(s, 1 if s % 10 else 2, [None, -1, 0, 5, 40, 120][s % 6], -1) for s in range(1, 61)]
    inputs = spark.createDataFrame(strategies, "strategy_id long, line_id long, unique_count long, "
                                               "algorithm_id int")
    lines = spark.createDataFrame([(1,), (2,), (2,)], "line_id long")          # duplicate line row
    preds = []
    for line, n in ((1, 200), (2, 12)):
        cum = 0.0
        for d in range(n):
            users = float((d * 7) % 13 + 1)
            cum += users
            preds.append((line, f"d{line}-{d}.example", users / 1000.0, cum))
    preds = spark.createDataFrame(preds, "line_id long, domain_name string, "
                                         "percentage_recommendations double, cumulative_users double")
    names = [(i, f"d1-{i}.example") for i in range(1, 200)] + [(5000 + i, f"d2-{i}.example")
                                                               for i in range(12)]
    names += [(9000 + i, f"d1-{i}.example") for i in range(0, 200, 50)]      # duplicate names
    sites = spark.createDataFrame(names, "site_domain_id long, name string")
    a = C.candidates(inputs, lines, preds, sites)
    b = _plain(spark, inputs, lines, preds, sites)
    assert a.count() > 1000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_claim_of_any_size(spark):
    from bidmill.operators import requests as R
    q = spark.createDataFrame([(i, "new") for i in range(5)], "dom_rec_id long, status string")
    assert R.claim_batch(q, 10_000_000).count() == 5 and R.claim_batch(q).count() == 5
    with pytest.raises(ValueError):
        R.claim_batch(q, 0)


def test_size_check_follows_the_table(spark, tmp_path):
    from bidmill.joins import is_small
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    assert is_small(spark.read.parquet(path), max_bytes=100_000)
    spark.range(100_000).write.mode("overwrite").parquet(path)
    assert not is_small(spark.read.parquet(path), max_bytes=100_000)
