"""Document operators against plain versions, and their edge cases."""

import duckdb
import brute
import pytest
from pyspark.sql import functions as F

from bidmill.llm import (imatch, labelled, line_dedup, minhash_dedup, mixing, passage_dedup,
                         queries, quality_cnn, sentencepiece_viterbi, toxicity_nbsvm)

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _h int"

P1 = " ".join(f"alpha{i}" for i in range(40))
P2 = " ".join(f"beta{i}" for i in range(40))
EDGE = [
    (1, P1 + "\n" + P2, "en", "a", 1, "x", 1),
    (2, P1.upper(), "en", "a", 1, "x", 1),                       # the same words in capitals
    (3, "start " + P1 + " end", "en", None, 1, "x", 1),         # shifted copy
    (4, "", "en", "b", 0, "x", 1),
    (5, None, None, "b", None, None, None),
    (6, "one two", "en", "b", 7, "x", 1),
    (7, "one two", "en", "b", 7, "x", 1),
    (8, " \t\n ", "en", "c", 4, "x", 1),
    (9, P2 + "\n\n" + P1 + "\n" + P2, "en", "c", 1, "x", 1),
    (10, "é▁ü 😀 " + P2, "de", "c", 1, "x", 1),
    (11, "long " + "w0 w1 w2 w3 w4 w5 w6 " * 4000, "en", "c", 1, "x", 1),
    (12, P1 + "\n" + P2, "en", "d", 1, "x", 1),                  # exact copy of 1
    (13, P1 + "\n" + P2.replace("beta3 ", "gamma "), "en", "d", 1, "x", 1),
]


def _small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def _edge(spark, extra=()):
    return spark.createDataFrame(EDGE + list(extra), SCHEMA)


def _texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def _empty(spark):
    return spark.createDataFrame([], SCHEMA)


ODD = [(None, "odd " + P1, None, None, None, None, None), (6, "one two three", "en", "b", 1, "x", 1)]


@pytest.mark.parametrize("data", ["small", "edge"])
def test_passages_equal_brute_force(spark, data):
    docs = _small(spark) if data == "small" else _edge(spark)
    out = passage_dedup.remove_repeated_passages(docs).withColumn(
        "sha", F.sha2("kept_text", 256)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.sha) for r in out} == \
        brute.repeated_passages(_texts(docs))


def test_cover_has_every_difference():
    for period in range(1, 14):
        cover = passage_dedup.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("data", ["small", "edge"])
def test_near_duplicates_equal_brute_force(spark, data):
    docs = _small(spark) if data == "small" else _edge(spark)
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash_dedup.near_duplicates(docs).collect()}
    assert out == brute.near_duplicates(_texts(docs))


def test_near_duplicates_of_a_chained_group(spark):
    """Copies that drift: neighbours are linked, the ends share little."""
    words = [f"w{i}" for i in range(200)]
    rows, now = [], list(words)
    for i in range(40):
        rows.append((i, " ".join(now)))
        now = now[:]
        now[(i * 37) % 200] = f"new{i}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash_dedup.near_duplicates(docs).collect()}
    assert out == brute.near_duplicates(rows)


def test_rows_that_share_an_id_are_judged_by_their_text(spark):
    def text(k, n=40):
        return " ".join(f"t{k}w{i}" for i in range(n))

    rows = [(1, text(1), "a"), (2, text(1), "b"), (2, text(2), "c"), (2, text(2), "d"),
            (None, text(3), "e"), (None, text(3), "f"), (None, text(4), "g"), (5, text(4), "h"),
            (7, text(1)[:-4], "i"), (8, None, "j"), (8, "", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    out = minhash_dedup.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    # the copies of document 1 go, and those of a row without an id
    assert sorted((r.doc_id, r.component_id) for r in out if not r.kept) == [
        (2, 1), (5, None), (7, 1)]
    left = minhash_dedup.first_rows(docs)
    assert left.columns == docs.columns
    kept = left.collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted(
        [(1, text(1)), (2, text(2)), (0, text(3)), (0, text(4)), (8, "")])
    assert minhash_dedup.first_rows(docs.repartition(5)).exceptAll(left).isEmpty()
    assert minhash_dedup.first_rows(docs.where("doc_id < 0")).count() == 0


def test_learned_texts_are_bounded_in_rows_and_bytes(spark):
    docs = spark.range(4000).select(
        F.when(F.col("id") < 3990, F.col("id") % 4).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"),
                                      (F.col("id") % 2).cast("int").alias("quality"))
    rows, counts, drawn = labelled.sample(docs, labels, "quality", 4, 2, 1500)
    got = rows.collect()
    assert len({r._id for r in got}) == len(got) == sum(drawn.values()) <= 14
    assert all(counts[k] > drawn[k] for k in drawn)
    rows, _, drawn = labelled.sample(docs, labels, "quality", 4, 2, 1500, max_bytes=16 * 9)
    assert 0 < rows.agg(F.sum(F.octet_length("_text"))).first()[0] <= 2 * 16 * 9
    assert labelled.sample(docs, labels, "quality", 4, 2, 1500, max_bytes=16)[0].isEmpty()


def _hot(n):
    """Texts of one start, so unlike ones meet in a bucket: n pairs that are
    linked, the first with a third, and single ones."""
    import random
    rng = random.Random(5)
    start = " ".join(f"s{i}" for i in range(30))
    rows = []
    for k in range(n):
        words = [f"p{k}x{i}" for i in range(90)]
        rows.append(start + " " + " ".join(words))
        rows.append(start + " " + " ".join(words[:-4] + [f"q{k}"]))
        if k % 3 == 0:
            rows.append(start + " " + " ".join(f"r{k}y{i}" for i in range(60)))
    rows += [start + " " + " ".join([*words[:70 - k], f"t{k}", *words[71 - k:]]) for k in range(9)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("meet", ["one band", "all bands"])
def test_near_duplicates_of_a_large_mixed_bucket(spark, monkeypatch, meet):
    """A bucket above LARGE_BUCKET that leaders and splits leave mixed."""
    monkeypatch.setattr(minhash_dedup, "LARGE_BUCKET", 8)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    options = {}
    if meet == "one band":
        # every class meets every other one, in a single bucket
        monkeypatch.setattr(minhash_dedup._Search, "band_keys", lambda self: self.classes.select(
            "_id", F.lit(0).alias("band"), F.lit(7).cast("long").alias("key")))
        options = {"bands": 1, "rows": 16}
    rows = _hot(12)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash_dedup.near_duplicates(docs, **options).collect()}
    want = brute.near_duplicates(rows)
    assert len({g[1] for g in want.values()}) == 16 and out == want


def test_posterior_bound_is_the_smallest_that_is_plausible():
    import math
    need = minhash_dedup.least_matches(32, 16, 0.75, 1e-3)

    def tail(n, m):
        return sum(math.comb(n + 1, k) * 0.75 ** k * 0.25 ** (n + 1 - k) for k in range(m + 1))
    for n, m in zip((16, 32), need):
        assert tail(n, m) >= 1e-3 > (tail(n, m - 1) if m else 0)


def _lines(spark, docs, tmp_path):
    path = str(tmp_path / "documents.parquet")
    docs.select("doc_id", "text").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{path}/*.parquet')")
    want = con.execute(queries.ORACLES["op4_line_dedup"]).fetchall()
    got = queries.op4_line_dedup(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_lines_equal_sql(spark, tmp_path):
    _lines(spark, _edge(spark), tmp_path)


def test_line_runs_of_any_length(spark):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\ny"), (3, "a\nb\nz"), (4, "c\nd\ne\nq")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = {r.row.doc_id: r.cut.text for r in
           line_dedup.remove_repeated_lines(docs, min_lines=3).collect()}
    assert cut == {1: "a\nb\nc\nd\ne", 2: "x\ny", 3: "a\nb\nz", 4: "q"}


def test_runs_name_their_length_and_first_copy(spark):
    def lines(a, b):
        return [f"line {i}" for i in range(a, b)]

    rows = [(1, ["top", *lines(0, 3), "x", *lines(10, 15), "y", *lines(20, 37)]),
            (2, [*lines(0, 3), "p", "q", *lines(10, 15)]),
            (3, ["r", *lines(20, 37), "s", "line 1"]),
            # repeated in two overlapping halves only
            (4, list("ABCD")), (5, list("XCDEF")), (6, list("ABCDEF")),
            (7, ["z"] * 9), (8, lines(10, 15))]
    docs = spark.createDataFrame([(i, "\n".join(x)) for i, x in rows], "doc_id long, text string")
    runs = sorted((r._id, r.start, r.length, r.first_id, r.first_line)
                  for r in line_dedup.repeated_runs(docs).collect())
    assert [r for r in runs if r[0] != 7] == [
        (2, 0, 3, 1, 1), (2, 5, 5, 1, 5), (3, 1, 17, 1, 11),
        (5, 1, 2, 4, 2), (6, 0, 4, 4, 0), (6, 2, 4, 5, 1), (8, 0, 5, 1, 5)]
    # a line over and over: the rest repeats the start, eight lines from the second on
    assert (7, 1, 8, 7, 0) in runs or {x for _, a, n, *_ in (r for r in runs if r[0] == 7)
                                       for x in range(a, a + n)} == set(range(1, 9))
    cut = {r.row.doc_id: r.cut for r in line_dedup.remove_repeated_lines(docs).collect()}
    assert {i: c.text for i, c in cut.items()} == {
        1: "\n".join(rows[0][1]), 2: "p\nq", 3: "r\ns\nline 1", 4: "A\nB\nC\nD", 5: "X\nE\nF",
        6: "", 7: "z", 8: ""}
    assert cut[7].removed == 8 and cut[6].runs == 1


def test_fingerprints(spark):
    docs = _small(spark)
    texts = dict(_texts(docs))
    want = brute.edited(texts.items())
    by_text = {}
    better = 0
    for r in imatch.compared(docs).collect():
        assert (r.n_chars, r.edited_sha256) == want[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        better += r.near_edited > r.near_next
    assert better > 0.8 * len(texts)


def test_fingerprints_of_edge_cases(spark):
    docs = _edge(spark, ODD)
    out = imatch.compared(docs).collect()
    assert len(out) == len(EDGE) + len(ODD)
    alone = imatch.compared(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string"))
    assert alone.first().edited_sha256 == brute.edited([(1, "abcdefgh")])[1][1]


def test_mix_reaches_its_targets(spark):
    docs = _small(spark)
    rows = docs.select("doc_id", "text", "source").collect()
    size, source_size, taken = {}, {}, {}
    for r in rows:
        size[r.doc_id] = len(brute.words(r.text))
        source_size[r.source] = source_size.get(r.source, 0) + size[r.doc_id]
    target = brute.mix_targets(source_size)
    first = {r.doc_id: r for r in mixing.mix(docs).collect()}
    for r in rows:
        x = first[r.doc_id]
        assert x["size"] == size[r.doc_id] and x.source_size == source_size[r.source]
        assert x.target == pytest.approx(target[r.source]) and 0 <= x.taken <= 2 * x["size"]
        taken[r.source] = taken.get(r.source, 0) + x.taken
    for s, t in target.items():
        # the counts are drawn: within five standard deviations of a Poisson count
        assert abs(taken[s] - t) <= (2 + 5 * (t / mixing.BLOCK_WORDS) ** 0.5) * mixing.BLOCK_WORDS
    again = {r.doc_id: r for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == first


def test_mix_takes_what_its_draws_say(spark):
    """Words taken, by a plain version of draws, permutations and joins; with
    other draws (another seed, or a constant share) the result is another."""
    docs = _small(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = {}
    for seed in (0, 9):
        got[seed] = {r.doc_id: r.taken for r in mixing.mix(docs, seed=seed, block_words=32).collect()}
        assert got[seed] == brute.mix(rows, seed=seed, block=32)
    even = brute.mix(rows, block=32, draw=lambda turn, k, weight: k % weight)
    source = {i: s for i, _, s in rows}

    def by_source(taken):
        out = {}
        for i, n in taken.items():
            out[source[i]] = out.get(source[i], 0) + n
        return out
    assert len({tuple(sorted(by_source(x).items())) for x in (got[0], got[9], even)}) == 3


def test_shard_counts_spread_like_a_multinomial(spark):
    """One round of draws: counts of a shard have the multinomial's mean and
    variance, and the shards' counts add up to the slots."""
    lack = spark.createDataFrame([("a", 600, 0), ("b", 300, 600), (None, 100, 900)],
                                 "source string, lack long, _first long")
    slots, size = 100_000, 250
    rows = mixing._drawn(lack, slots, 1000, 0, size, 1, 0).collect()
    for s, p in (("a", 0.6), ("b", 0.3), (None, 0.1)):
        n = [r["count"] for r in rows if r.source == s]
        mean = sum(n) / len(n)
        variance = sum((x - mean) ** 2 for x in n) / (len(n) - 1)
        assert mean == pytest.approx(size * p, rel=0.03)
        assert variance == pytest.approx(size * p * (1 - p), rel=0.3)
    assert sum(r["count"] for r in rows) == slots


def test_permutation_is_exact(spark):
    for n in (1, 2, 7, 100):
        out = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("p"))
        assert sorted(r.p for r in out.collect()) == list(range(n))


def test_mixed_documents_hold_the_words_taken(spark):
    docs = _edge(spark)
    plan = {r.doc_id: r.taken for r in mixing.mix(docs, block_words=16).collect()}
    out = mixing.mixed_documents(docs, block_words=16)
    assert out.columns == docs.columns
    got = {r.doc_id: len(brute.words(r.text)) for r in out.collect()}
    assert got == {i: n for i, n in plan.items() if n}


def test_pieces_round_trip(spark):
    docs = _edge(spark, ODD)
    vocab = sentencepiece_viterbi.load()
    out = sentencepiece_viterbi.round_trip(docs, vocab).collect()
    assert len(out) == len(EDGE) + len(ODD)
    assert all(r.decoded == (r.row.text or "") for r in out)
    ids = sentencepiece_viterbi.encode(docs, vocab).select("row.*", "ids")
    back = sentencepiece_viterbi.decode(ids.withColumnRenamed("text", "before"), vocab).collect()
    assert all(r.text == (r.row.before or "") for r in back)


def test_viterbi_equals_dynamic_programming():
    import random
    pieces = {p: (i, s) for i, (p, s) in enumerate([
        ("a", -3.0), ("b", -3.0), ("ab", -4.0), ("ba", -5.5), ("aba", -6.0), (" ", -1.0),
        (" a", -2.5), ("bb", -5.0), ("é", -2.0), ("aé", -4.5)])}
    vocab = sentencepiece_viterbi.vocabulary(pieces, [p.encode() for p in pieces] +
                                             [bytes([b]) for b in range(256)],
                                             [len(pieces) + b for b in range(256)])
    encoder, rng = sentencepiece_viterbi.Encoder(vocab), random.Random(5)
    texts = ["".join(rng.choice("ab éü") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    for text in texts:
        best = [0.0] + [float("-inf")] * len(text)
        for j in range(1, len(text) + 1):
            for i in range(max(0, j - 3), j):
                if text[i:j] in pieces:
                    best[j] = max(best[j], best[i] + pieces[text[i:j]][1])
            if text[j - 1] not in pieces:
                best[j] = max(best[j], best[j - 1] + vocab["unknown"])
        assert encoder.search([text.encode()])[1][0] == pytest.approx(best[-1])
    joined = encoder.encode(texts)
    decoder = sentencepiece_viterbi.Decoder(vocab)
    assert [decoder.decode(x) for x in joined] == texts


@pytest.mark.parametrize("module,label", [(quality_cnn, "quality"), (toxicity_nbsvm, "toxic")])
def test_classifier_edge_cases(spark, module, label):
    docs = _edge(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    constant = module.score(docs, module.train(docs, none)).collect()
    assert len(constant) == len(EDGE) + len(ODD) and len({r.score for r in constant}) == 1
    labels = spark.createDataFrame([(r[0], r[0] % 2, r[0] % 2) for r in EDGE] + [(None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    scored = module.score(docs, module.train(docs, labels)).collect()
    assert all(0 <= r.score <= 1 for r in scored) and len(scored) == len(EDGE) + len(ODD)
    assert module.score(_empty(spark), module.train(_empty(spark), none)).count() == 0


@pytest.mark.parametrize("name,label,least", [("op2_quality_cnn", "quality", 0.9),
                                              ("op8_toxicity_nbsvm", "toxic", 0.9)])
def test_held_out_ranking(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r.score, truth[r.doc_id]) for r in queries.QUERIES[name](spark, sf).collect()
            if r.held_out and r.doc_id in truth]
    good, bad = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc >= least


def test_odd_ids_and_empty_tables(spark):
    docs, empty = _edge(spark, ODD), _empty(spark)
    n = len(EDGE) + len(ODD)
    assert passage_dedup.remove_repeated_passages(docs).count() == n
    near = minhash_dedup.near_duplicates(docs).collect()
    assert len(near) == n and len({r.component_id for r in near if r.doc_id == 6}) == 1
    assert line_dedup.remove_repeated_lines(docs).count() == n
    assert mixing.mix(docs).count() == n
    assert mixing.mixed_documents(docs).columns == docs.columns
    for fn in (passage_dedup.remove_repeated_passages, minhash_dedup.near_duplicates,
               line_dedup.remove_repeated_lines, mixing.mix, mixing.mixed_documents,
               imatch.compared):
        assert fn(empty).count() == 0


def test_power_tables_are_no_larger_than_the_blocks_ask_for(monkeypatch):
    from bidmill.llm import textscan as ts
    monkeypatch.setattr(ts, "_POWERS", {})
    power, inverse = ts._powers(ts._BASE_BYTES, 1 << 18)
    assert len(power) == 1 << 18 and (power[5:9] * inverse[5:9] == 1).all()
    assert len(ts._POWERS[ts._BASE_BYTES][0]) < 1 << 19
