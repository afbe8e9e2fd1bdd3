"""Vector search, URL templates and the pipeline."""

import random

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bidmill.llm import (line_dedup, minhash_dedup, quality_cnn, sentencepiece_viterbi, topk_search,
                         url_templates)

SMALL = "/root/testdata/sf0.001"


def _top(df, **options):
    out = topk_search.top_k(df, F.col("vec_id") % 50 == 0, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out)


def test_search_equals_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert _top(df, bucket_rows=64) == brute.top_products(rows)


def test_search_with_ties_gaps_and_lengths(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 7) for _ in range(6)]) for i in range(300)]
    rows += [(i, [1.5, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(300, 360)]     # equal vectors
    rows += [(400, None), (401, []), (402, [1.0, None, 2.0, 0.0, 0.0, 0.0]),
             (403, [float("nan")] * 6), (450, [float("inf")] * 6), (500, [0.0] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "vec_id long, embedding array<double>, norm string")
    assert _top(df, bucket_rows=32) == brute.top_products(rows)
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert _top(few) == brute.top_products(rows[:3])
    assert _top(spark.createDataFrame([], "vec_id long, embedding array<double>")) == []


@pytest.mark.parametrize("size", [1, 2 ** 14, 2 ** 29, 2 ** 33])
def test_products_are_exact(size):
    rng = np.random.default_rng(1)
    q, x = (rng.integers(-size, size, endpoint=True, size=(5, 8)) for _ in range(2))
    want = [[sum(int(a) * int(b) for a, b in zip(u, v)) for v in x] for u in q]
    got = topk_search.products(q, x).tolist()
    assert got == [[max(-2 ** 63, min(2 ** 63 - 1, s)) for s in row] for row in want] or \
        all(abs(g - min(2 ** 63 - 1, max(-2 ** 63, w))) == 0 for a, b in zip(got, want)
            for g, w in zip(a, b))


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM/en/x?y#z", "http://www.example.com/en/1",
        "https://example.com", "https://sub.www.example.com/en/", "ftp://x.net/es/a?b", "http://x.net/es",
        "http://notexample.com/en/", "http://a://b.net/fr/", "http://h.org/" + "s/" * 50 + "end",
        "http://x.net:8080/fr/1", "http://É.net/fr/2"]


def test_url_rules_equal_brute_force(spark):
    rows = [(i, u, 1) for i, u in enumerate(URLS + URLS)]
    out = url_templates.judge(spark.createDataFrame(rows, "page_id long, url string, host int"))
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = brute.url_parts(rows[r.page_id][1])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_templates.judge(empty).count() == 0


def test_templates_separate_blocked_branches(spark):
    """One host: /es/ and /fr/ are blocked by rule, their branches stay apart
    from the unlabelled ones, and ids become wildcards."""
    rows = [f"http://shop.net/{lang}/{i}" for lang in ("es", "fr", "en", "de") for i in range(200)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    by = {}
    for r in url_templates.judge(df).collect():
        by.setdefault(r.path.split("/")[1], set()).add((r.template, r.verdict))
    assert by["es"] == {("/es/*", "block")} and by["fr"] == {("/fr/*", "block")}
    assert {v for _, v in by["en"] | by["de"]} == {"allow"}
    assert all(t.endswith("/*") for t, _ in by["en"])


def _judged(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {(r.host, r.path): (r.template, r.verdict, r.purity)
            for r in url_templates.judge(df).collect()}


def test_few_blocked_urls_do_not_block_the_clean_ones(spark):
    """Blocked branches of 3 or 4 URLs, or of 1% of a hot host, and hosts too
    small for the test to tell the branches apart."""
    pages = {"few.net": {"es": 4, "en": 96}, "three.net": {"es": 3, "en": 30},
             "tiny.net": {"es": 3, "en": 3}, "half.net": {"es": 5, "de": 5},
             "hot.net": {"es": 30, "fr": 30, **{f"s{k}": 30 for k in range(98)}}}
    urls = [f"http://{host}/{part}/{i}" for host, parts in pages.items()
            for part, n in parts.items() for i in range(n)]
    got = _judged(spark, urls)
    assert got == brute.url_templates(urls)
    for (host, path), (template, verdict, _) in got.items():
        part = path.split("/")[1]
        assert verdict == ("block" if part in ("es", "fr") else "allow")
        if host in ("few.net", "three.net", "hot.net"):
            assert template.startswith(f"/{part}/") == (part in ("es", "fr"))


def test_templates_equal_a_plain_tree(spark):
    urls = [r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    got = _judged(spark, urls + URLS[:12])
    assert got == brute.url_templates(urls + URLS[:12])
    assert {v for (h, p), (_, v, _) in got.items()
            if brute.url_parts(f"http://{h}{p}")[2] is None} == {"allow"}


def test_branches_that_differ_in_a_deep_segment(spark):
    """The rule is on the sixth segment, the seventh is an id."""
    urls = [f"http://deep.net/a/b/c/d/{k % 3}/{part}/{k}/end" for k in range(30)
            for part in ("bad", "good")]
    urls += [f"http://clean.net/a/b/c/d/{k}/e/f" for k in range(9)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [("deep.net", f"/a/b/c/d/{k}/bad/", "block") for k in range(3)]
    by = {}
    for r in url_templates.judge(df, rules=rules).collect():
        by.setdefault((r.host, "bad" in r.path), set()).add((r.template, r.verdict))
    assert by == {("deep.net", True): {("/*/*/*/*/*/bad/*", "block")},
                  ("deep.net", False): {("/*/*/*/*/*/good/*", "allow")},
                  ("clean.net", False): {("/*/*/*/*/*", "allow")}}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "near_dedup", "source_mixing",
                     "sentencepiece"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        out = stage(spark, docs, SMALL).cache()
        assert out.count() > 0
        if k < 4:
            assert out.columns == columns
            after = {r.doc_id: r.text for r in out.select("doc_id", "text").collect()}
            assert after.keys() <= before.keys()
        if name == "near_dedup":
            groups = brute.near_duplicates(before.items())
            assert after.keys() == {i for i, g in groups.items() if g[2]}
        if name == "line_dedup":
            assert all(len(after[i]) <= len(before[i]) for i in after)
        if name == "sentencepiece":
            assert {r.doc_id for r in out.collect()} == before.keys()
            assert all(r.n_tokens == len(r.ids) for r in out.collect())
        docs = out


def test_pipeline_on_odd_rows(spark, tmp_path):
    """NULL and repeated ids, NULL and empty texts, equal rows, clashing names."""
    def text(k):
        return "\n".join(" ".join(f"t{k}line{i}w{j}" for j in range(9)) for i in range(6))

    common = "a passage in step\nof two lines"
    rows = [(1, text(1)), (2, text(1).replace("\n", " ")), (3, text(3) + "\n" + common), (3, text(4)),
            (None, text(5)), (None, text(6)), (None, text(6)), (7, common + "\n" + text(7)),
            (8, None), (9, ""), (10, common), (11, "few words"), (12, "few words")]
    docs = spark.createDataFrame(
        [(i, x, "en", "s" if k % 2 else None, len(x or ""), k, f"r{k}", 0, 1.5)
         for k, (i, x) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long, _id long, row string, "
        "rank int, score double")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    now, texts = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        now = stage(spark, now, str(tmp_path)).cache()
        assert now.columns == docs.columns
        texts[name] = sorted(((r.doc_id or 0), r.text or "") for r in now.collect())
    assert texts["quality_classifier"] == sorted((i or 0, x or "") for i, x in rows)
    # rows without an id come first: the later ones of a line run lose it
    assert (7, text(7)) in texts["line_dedup"] and (3, text(3) + "\n" + common) in texts["line_dedup"]
    assert [x for x in texts["line_dedup"] if x[0] == 10] == []
    assert texts["near_dedup"] == sorted([
        (1, text(1)), (3, text(3) + "\n" + common), (3, text(4)), (0, text(5)), (0, text(6)),
        (7, text(7)), (8, ""), (9, ""), (11, "few words")])
    left = {(i or None) for i, _ in texts["near_dedup"]}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and {r.doc_id for r in out} <= left
    assert all(r.n_tokens == len(r.ids) for r in out)


def test_quality_stage_without_labels_against_a_document(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"clean text {i}") for i in range(6)],
                                 "doc_id long, text string")

    def kept(name, rows):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
        return corpus_pipeline.keep_quality(spark, docs, str(tmp_path / name)).count()

    assert kept("empty", []) == 6
    assert kept("unlabelled", [(i, None, 0) for i in range(6)]) == 6
    assert kept("good", [(i, 1, 0) for i in range(6)]) == 6
    assert kept("bad", [(i, 0, 0) for i in range(6)]) == 0


def test_line_stage_cuts_each_text_once(spark, tmp_path):
    """Its filter on what is left does not run the cut again."""
    docs = spark.createDataFrame([(i, "a line\nand one more\n" + "x" * i) for i in range(4)],
                                 "doc_id long, text string")
    left = corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path))
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    # equal but for the later copies: of those a short last line is left, and of none nothing
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [
        (0, "a line\nand one more\n"), (1, "x"), (2, "xx"), (3, "xxx")]


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def own_batches(spark):
    before = spark.conf.get(_BATCH_BYTES, None)
    spark.conf.unset(_BATCH_BYTES)
    yield spark
    spark.conf.unset(_BATCH_BYTES)
    if before is not None:
        spark.conf.set(_BATCH_BYTES, before)


def test_texts_go_to_python_a_few_mb_at_a_time(own_batches, monkeypatch):
    def sizes(model):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), pa.array([float(b.nbytes)] * b.num_rows, pa.float64())],
                    names=["row", "score"])
        return run

    monkeypatch.setattr(quality_cnn, "_scores", sizes)
    docs = own_batches.range(3000).repartition(1).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("text"), 1000).alias("text"))
    largest, n = quality_cnn.score(docs, {}).agg(F.max("score"), F.count("*")).first()
    assert n == 3000 and largest < 6e6


@pytest.mark.parametrize("operator", [
    lambda d: quality_cnn.score(d, {"constant": 0.5}), line_dedup.remove_repeated_lines,
    minhash_dedup.near_duplicates,
    lambda d: sentencepiece_viterbi.encode(d, sentencepiece_viterbi.load())])
def test_batches_are_bounded_unless_the_session_says_how_much(own_batches, operator):
    docs = own_batches.createDataFrame([(1, "a few words")], "doc_id long, text string")
    operator(docs)
    assert own_batches.conf.get(_BATCH_BYTES) == "4m"
    own_batches.conf.set(_BATCH_BYTES, "9m")
    operator(docs)
    assert own_batches.conf.get(_BATCH_BYTES) == "9m"
