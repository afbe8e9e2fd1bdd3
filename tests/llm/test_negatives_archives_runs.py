"""Hard negatives, web archives and periodic runs against plain versions."""

import gzip
import hashlib
import os
import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from bidmill.llm import hard_negatives, periodic_runs, queries, warc
from bidmill.llm.store import stored

SMALL = "/root/testdata/sf0.001"


# --- hard negatives ----------------------------------------------------------------

def _mined(df, **options):
    out = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **options).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score,
                   r.negative_score) for r in out)


@pytest.mark.parametrize("shape", [(37, 64, 51), (100, 70, 33), (1, 5, 9), (0, 4, 3), (65, 0, 65)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(7)
    a, b = rng.integers(-10 ** 6, 10 ** 6, (m, k)), rng.integers(-10 ** 6, 10 ** 6, (k, n))
    assert (hard_negatives.strassen(a, b) == a @ b).all()


def test_products_beyond_64_bits_are_cut():
    a = np.array([[2 ** 62, 2 ** 62], [1, -1], [-2 ** 62, -2 ** 62]])
    most = 2 ** 63 - 1
    assert hard_negatives.scores(a, a).tolist() == [
        [most, 0, -most], [0, 2, 0], [-most, 0, most]]


def test_negatives_equal_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    expected = brute.hard_negatives(rows)
    assert expected and _mined(df) == expected
    # many blocks, shares and tiles: the heaps merge to the same
    assert _mined(df, anchor_rows=2, tile_rows=7) == expected


def test_negatives_on_odd_rows(spark):
    rng = random.Random(11)
    rows = [(i, [rng.gauss(1, 1) for _ in range(5 + i % 3)], rng.choice([0, 0, 0, 1, 2]))
            for i in range(400)]
    rows += [(i, [1.0, 1.0, 1.0], 1) for i in range(400, 520)]           # equal vectors: ties
    rows += [(550, [0.0] * 5, 2), (600, [], 2), (650, [1.0, 1.0, 1.0], None), (700, None, 1),
             (750, [1.0, None], 1), (800, [float("nan")], 1), (850, [float("inf")], 0),
             (None, [1.0] * 5, 0), (900, [3.0] * 5, 77), (950, [-1.0] * 5, 0)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, embedding array<double>, label long, row int, grp string")
    expected = brute.hard_negatives(rows)
    assert _mined(df) == expected
    assert _mined(df, anchor_rows=3, tile_rows=16) == expected
    assert _mined(df.limit(0)) == []


def test_rows_that_repeat_an_id_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.9, 0.0], 2), (1, [0.9, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    # each row with id 0 is an anchor, the other one its positive
    assert _mined(df) == sorted([(0, 0, r, 1, 256 * 256, 256 * 230) for r in (1, 2)] * 2)


# --- web archives ------------------------------------------------------------------

TRICKY = "start WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "WWARC/1.WARC/1." * 9 + "\r\n\r\n end"
PAGES = [
    (5, "http://a.example/x", TRICKY), (3, "http://a.example/WARC/1.0/y", TRICKY),
    (9, None, TRICKY), (None, "http://a.example/z", TRICKY),
    (10, "no scheme", "short"), (11, "http://a.example\r\nX: y", "short"),
    (12, "https://b.example/é?q=1#f", "é😀" * 5000), (13, "https://b.example", None),
    (14, "https://b.example/?", ""), (15, "https://b.example/", "z" * 99),
    (16, "https://b.example/", "z" * 99), (17, "https://b.example/", "z" * 100),
    (18, "https://b.example/", "z" * 100), (20, "u", "twin " * 30), (20, "u", "twin " * 30),
    (21, "u", "twin " * 30), (None, "u", "no id " * 30), (None, "u", "no id " * 30)]


def _pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, 7, "x") for r in rows],
                                 "page_id long, url string, html string, size int, digest string")


def test_captures_come_back(spark):
    folder = warc.write(_pages(spark).repartition(3), captures_per_file=4)
    records = stored(warc.read(spark, folder), "test-records")
    assert records.count() == 3 * len(PAGES)
    assert records.select("record_id").distinct().count() == 3 * len(PAGES)
    out = warc.resolved(warc.captures(records)).collect()
    got = sorted(((r.capture.metadata.page_id, r.capture.response.type, r.payload_bytes,
                   r.payload_digest, r.refers_to) for r in out), key=repr)
    assert got == sorted(brute.captures(PAGES), key=repr)
    assert all(r.n_request == 1 and r.n_metadata == 1 for r in out)
    held = {r.capture.metadata.page_id: r.capture for r in out if r.capture.metadata.page_id}
    assert bytes(held[12].response.payload).decode() == "é😀" * 5000
    assert held[9].response.target_uri is None and held[9].request.target_uri is None
    assert held[3].response.target_uri == "http://a.example/WARC/1.0/y"
    assert held[11].response.target_uri == "http://a.example%0D%0AX: y"
    assert held[12].request.http_header.split("\r\n")[:2] == [
        "GET /é?q=1 HTTP/1.1", "Host: b.example"]
    assert warc.unmatched(records).count() == 0


def test_empty_pages(spark):
    records = warc.read(spark, warc.write(_pages(spark, PAGES[:1]).limit(0)))
    assert records.count() == 0 and warc.resolved(warc.captures(records)).count() == 0


def test_bad_archives_are_errors(spark, tmp_path):
    good = (b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <a>\r\n"
            b"content-length: 3\r\n\r\nk: \r\n\r\n")
    answer = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <b>\r\n"
              b"WARC-Payload-Digest: sha256:" + b"0" * 64
              + b"\r\nContent-Length: 7\r\n\r\nh\r\n\r\nab\r\n\r\n")
    cases = {"short": good[:-1], "junk": b"junk" + good, "long": good + b"WARC/1.1\r\n\r\n",
             "digest": good + answer}
    for name, data in cases.items():
        os.makedirs(tmp_path / name)
        (tmp_path / name / "a.warc.gz").write_bytes(gzip.compress(data))
        with pytest.raises(Exception):
            warc.read(spark, f"file://{tmp_path}/{name}").collect()
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "a.warc").write_bytes(good)
    with pytest.raises(ValueError, match="compressed"):
        warc.read(spark, f"file://{plain}")


def _one(kind, own, beside=(), block=b""):
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{own}>\r\n"
            + "".join(f"WARC-Concurrent-To: <{b}>\r\n" for b in beside)
            + f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_links_of_either_side(spark, tmp_path):
    """Archives of others: a member for each record, links on the response,
    several requests, records without a partner."""
    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    data = [_one("warcinfo", "i"), _one("response", "r1", ["q1", "m1"], http), _one("request", "q1"),
            _one("metadata", "m1", [], b"pageId: 4\r\nk: v"), _one("response", "r2", [], http),
            _one("request", "q3", ["r2"]), _one("request", "q2", ["r2"]), _one("request", "q9", ["x"]),
            _one("metadata", "m9")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, data)))
    records = warc.read(spark, f"file://{tmp_path}")
    out = {r.capture.response.record_id: r for r in warc.captures(records).collect()}
    assert out["<r1>"].capture.request.record_id == "<q1>"
    assert out["<r1>"].capture.metadata.page_id == 4
    assert out["<r1>"].capture.metadata.fields == {"pageId": "4", "k": "v"}
    assert (out["<r2>"].capture.request.record_id, out["<r2>"].n_request) == ("<q2>", 2)
    assert out["<r2>"].capture.metadata is None and len(out) == 2
    assert sorted(r.record_id for r in warc.unmatched(records).collect()) == ["<m9>", "<q9>"]


# --- periodic runs -----------------------------------------------------------------

def _planted(rng, n):
    words = [str(rng.randrange(rng.choice([1, 2, 3, 5, 50]))).encode() for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 30:
            a = rng.randrange(n)
            p, b = 1 + rng.randrange((n - a) // 3 + 1), rng.randrange(a, n + 1)
            words[a:b] = [words[a + (i - a) % p] for i in range(a, b)]
    return words


def test_runs_equal_brute_force():
    rng, seen = random.Random(5), 0
    for _ in range(400):
        words = _planted(rng, rng.randrange(140))
        limits = rng.choice([(24, 3), (24, 3), (6, 2), (9, 3), (12, 4)])
        expected = brute.runs(words, *limits)
        assert periodic_runs.runs_of(words, *limits) == expected, (words, limits)
        seen += len(expected)
    assert seen > 100


def test_long_texts_take_linear_time():
    rng = random.Random(2)
    for period in (1, 7, 33_000):
        base = [b"only here"] + [b"w%d" % rng.randrange(500) for _ in range(period - 1)]
        words = [base[i % period] for i in range(100_000)]
        assert periodic_runs.runs_of(words) == [(0, 100_000, period)]


def test_collapsed_texts(spark):
    line = "a b c d e f g h "
    rows = [(1, "start " + line * 3 + "end", "x"), (2, None, "x"), (3, "", "x"), (4, " \t\n", "x"),
            (None, "b " * 30, "x"), (1, "start " + line * 3 + "end", "x"), (6, line * 2, "x"),
            (7, "w" * 200_000 + " " + "é " * 24, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted(((r.row.doc_id, r.row.runs, r.n_words, [tuple(x) for x in r.runs], r.text)
                  for r in periodic_runs.collapse_runs(df).collect()), key=repr)
    short = line.strip()
    assert got == sorted([
        (1, "x", 26, [(1, 24, 8)], "start " + short + " end"), (2, "x", 0, [], ""),
        (3, "x", 0, [], ""), (4, "x", 0, [], ""), (None, "x", 30, [(0, 30, 1)], "b"),
        (1, "x", 26, [(1, 24, 8)], "start " + short + " end"), (6, "x", 16, [], (line * 2).strip()),
        (7, "x", 25, [(1, 24, 1)], "w" * 200_000 + " é")], key=repr)
    assert periodic_runs.collapse_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(df, exponent=1)


def test_run_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = queries.op13_periodic_runs(spark, SMALL).collect()
    got = {r.doc_id: tuple(r[1:]) for r in out}
    expected = {r.doc_id: brute.run_digest(r.doc_id, r.text) for r in docs.collect()}
    assert got == expected and sum(v[0] > 0 for v in expected.values()) > 5


def test_repeating_texts(spark):
    rows = [(i, t) for i, t in enumerate(["w " * 5, "a b c d", "", None, " \n"] * 20)] + [(None, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = defaultdict(list)
    for r in queries.repeating(df).collect():
        got[r.doc_id].append((r.text or "").split())
    for i, t in rows:
        assert got[i] == [[w.decode() for w in brute.repeating(i, t)]], i
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)


def test_digests_are_of_utf8(spark):
    df = spark.createDataFrame([(1, "é  ü")], "doc_id long, text string")
    out = periodic_runs.collapse_runs(df).select(F.sha2("text", 256).alias("h")).first()
    assert out.h == hashlib.sha256("é ü".encode()).hexdigest()
