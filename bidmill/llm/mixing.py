"""Mixing sources to target weights, with DataFrame functions only.

1. A source's documents, in a pseudorandom order, form one stream of words that
   is cut into blocks of ``block_words``; the last block may be shorter. A
   document's place is a running total over range partitions, so a source with
   a third of all rows is spread over many tasks.
2. Targets: sources share ``percent`` of all words by weight; a target stops at
   ``repeats`` times its source's size and the excess goes to the others by
   weight. A source's quota is its target in blocks of its mean length.
3. Each output shard draws its source counts from a multinomial distribution
   (one hashed draw for each slot), and a source gets the slots that it draws.
   The shards are drawn in ``DRAWS`` rounds. The first takes most of the slots
   with the quotas as weights, the next most of the rest, with what the sources
   still lack as weights, the last all of the rest. So a source ends within a
   few standard deviations of the last round's draw of its target, unless an
   earlier round gave it more. Only draws that would take a block more than
   ``repeats`` times are handed out again.
4. A source's n-th slot takes block p(n mod blocks) of its stream, where p is a
   pseudorandom permutation of the block indexes (swap-or-not, exact for any
   length) with a key for each source and pass over its blocks.
5. Documents meet their blocks in a join by (source, block index).

Nothing is drawn at random at run time: the same rows and seed give the same mix.

Defined cases: a very long text is as many blocks as its words fill, and only
its pieces meet in one task; NULL or wordless texts have size 0 and are never taken; a NULL
source is a source of its own, last in the order; NULL and repeated doc_ids and
repeated rows are rows of their own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidmill.llm.store import SPACES, WORD, discard, running_total, stored, text_of

BLOCK_WORDS = 128
SHARD_SLOTS = 1024
WEIGHTS = (5, 2, 1)
PERCENT = 150
REPEATS = 2
ROUNDS = 8
CELLS = 4096
DRAWS, SHARE = 3, (7, 8)      # rounds, and the part of the rest that a round draws
MAX_BROADCAST_ROWS = 100_000


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a stored per-source table if it is within the bound."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def source_targets(sizes: DataFrame, weights=WEIGHTS, percent: int = PERCENT,
                   repeats: int = REPEATS) -> DataFrame:
    """(source, source_size) -> also weight, target. One row for each source.

    With targets min(cap, rate * weight) that add up to the wanted total, the
    capped sources come first in the order of cap / weight. Capping the first k
    of them gives a rate from running sums over that order; it grows while the
    next source is above its cap and falls afterwards, so the largest is right.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1))
    ranked = sizes.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * float(repeats))
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    rate = ((F.sum("source_size").over(whole) * percent / 100
             - F.coalesce(F.sum("cap").over(ahead), F.lit(0.0))) / F.sum("weight").over(rest))
    rated = ranked.withColumn("rate", rate)
    return (rated.withColumn("rate", F.max("rate").over(whole))
            .withColumn("target", F.least("cap", F.col("rate") * F.col("weight")))
            .select("source", "source_size", "weight",
                    F.coalesce("target", F.lit(0.0)).alias("target")))


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """Swap-or-not permutation of 0 .. n-1: each round swaps x with its mirror
    image round a keyed point, or not, by a keyed bit that both share."""
    def step(at, r):
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), n) - at, n)
        coin = F.xxhash64(*key, r, F.greatest(at, mirror), F.lit(1)).bitwiseAND(F.lit(1))
        return F.when(coin == 1, mirror).otherwise(at)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), step)


def _placed(docs: DataFrame, id_col: str, source_col: str, text_col: str,
            seed: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their first word's index in their source's stream."""
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.xxhash64(text_of(text_col)).alias("_h"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"))
    base = base.withColumn("_mix", F.xxhash64(F.lit(seed), "doc_id", "_h"))
    summed, ranged = running_total(base, ["source", "_mix", "doc_id", "_h"], "size", "_at", "mix")
    summed = stored(summed, "mix-placed")
    discard(ranged)
    sources = stored(source_targets(summed.groupBy("source").agg(
        F.sum("size").alias("source_size"))), "mix-targets")
    begin = summed.groupBy("source").agg(F.min("_at").alias("_base"))
    begin = stored(sources.join(begin, sources["source"].eqNullSafe(begin["source"]))
                   .select(sources["source"], "source_size", "target", "_base"), "mix-sources")
    discard(sources)
    return summed, begin


def _quotas(sources: DataFrame, block_words: int) -> DataFrame:
    blocks = F.ceil(F.col("source_size") / block_words)
    quota = F.least(F.round(F.col("target") * blocks / F.col("source_size")).cast("long"),
                    blocks * REPEATS)
    return (sources.where("source_size > 0").withColumn("blocks", blocks)
            .withColumn("quota", quota).where("quota > 0").select("source", "blocks", "quota"))


def _drawn(lack: DataFrame, slots: int, weight: int, first_shard: int, shard_slots: int,
           seed: int, turn: int) -> DataFrame:
    """(source, shard, count) of ``slots`` draws with the weights ``lack``."""
    width = max(1, -(-weight // CELLS))
    cells = lack.select("source", "lack", "_first", F.explode(F.sequence(
        F.floor(F.col("_first") / width),
        F.floor((F.col("_first") + F.col("lack") - 1) / width))).alias("cell"))
    draws = lack.sparkSession.range(slots).select(
        (F.lit(first_shard) + F.floor(F.col("id") / shard_slots)).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("slot"), F.lit(turn), "id"), F.lit(weight))
        .alias("draw"))
    return (draws.withColumn("cell", F.floor(F.col("draw") / width)).join(_small(cells), "cell")
            .where("draw >= _first and draw < _first + lack")
            .groupBy("source", "shard").agg(F.count("*").alias("count")))


def shard_counts(quotas: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(shard, source, first, count): slots first .. first+count-1 of a source
    in a shard, first counted over all of the source's slots."""
    most = F.col("blocks") * REPEATS
    state = quotas.withColumn("taken", F.lit(0).cast("long"))
    slots = rest = quotas.agg(F.sum("quota")).first()[0] or 0
    rounds, shards = [], 0
    for turn in range(DRAWS):
        lack = stored(state.withColumn("lack", F.col("quota") - F.col("taken")).where("lack > 0")
                      .withColumn("_first", F.coalesce(F.sum("lack").over(
                          Window.orderBy(F.col("source").asc_nulls_last())
                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "mix-lack")
        weight = lack.agg(F.sum("lack")).first()[0] or 0
        n = rest if turn == DRAWS - 1 else rest * SHARE[0] // SHARE[1]
        if not weight or not n:
            continue
        rounds.append(stored(_drawn(lack, n, weight, shards, shard_slots, seed, turn), "mix-draws"))
        shards += -(-n // shard_slots)
        got = rounds[-1].groupBy("source").agg(F.sum("count").alias("_got")) \
            .withColumnRenamed("source", "_source")
        state = stored(state.join(got, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "blocks", "quota",
            F.least(F.col("taken") + F.coalesce("_got", F.lit(0)), most).alias("taken")),
            "mix-state")
        rest = slots - state.agg(F.sum("taken")).first()[0]
        discard(lack)
    if not rounds:
        return quotas.select(F.lit(0).alias("shard"), "source", F.lit(0).alias("first"),
                             F.lit(0).alias("count")).where("count > 0")
    every = rounds[0]
    for more in rounds[1:]:
        every = every.unionByName(more)
    total, ranged = running_total(every, ["source", "shard"], "count", "_at", "mix-draws")
    total = stored(total, "mix-counts")
    discard(ranged, *rounds)
    base = total.groupBy("source").agg(F.min("_at").alias("_base"))
    side = _small(stored(quotas.join(base, quotas["source"].eqNullSafe(base["source"]))
                         .select(quotas["source"], "blocks", "_base"), "mix-drawn"))
    return (total.join(side, total["source"].eqNullSafe(side["source"]))
            .select(total["source"], "shard", (F.col("_at") - F.col("_base")).alias("first"),
                    "count", "blocks")
            .withColumn("count", F.least("count", most - F.col("first")))
            .where("count > 0").drop("blocks"))


def mixed_blocks(sources: DataFrame, block_words: int = BLOCK_WORDS,
                 shard_slots: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """(shard, source, block): one row for each slot of the mix."""
    quotas = stored(_quotas(sources, block_words), "mix-quotas")
    side = _small(quotas)
    # a row makes up to shard_slots slots: the number of tasks is given, since
    # few bytes would go to few tasks
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(shard_counts(quotas, shard_slots, seed), "mix-shards") \
        .repartition(tasks, "source", "shard")
    slots = (counts.join(side, counts["source"].eqNullSafe(side["source"]))
             .select(counts["source"], "shard", "blocks", F.explode(F.sequence(
                 F.col("first"), F.col("first") + F.col("count") - 1)).alias("n")))
    turn = F.floor(F.col("n") / F.col("blocks"))
    name = F.coalesce("source", F.lit("\x00null"))
    return slots.select("shard", "source", permuted(
        F.pmod("n", "blocks"), F.col("blocks"), F.lit(seed), name, turn).alias("block"))


def _pieces(docs: DataFrame, id_col: str, source_col: str, text_col: str, block_words: int,
            shard_slots: int, seed: int) -> DataFrame:
    """A row for each part of a document in a block: its first word ``lo``, its
    ``words`` and how often the mix takes the block."""
    placed, sources = _placed(docs, id_col, source_col, text_col, seed)
    taken = stored(mixed_blocks(sources, block_words, shard_slots, seed)
                   .groupBy("source", "block").agg(F.count("*").alias("times"))
                   .withColumnRenamed("source", "_source"), "mix-blocks")
    side = _small(sources.withColumnRenamed("source", "_s"))
    rows = (placed.join(side, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("_at", F.col("_at") - F.col("_base")))
    last = F.floor((F.col("_at") + F.col("size") - 1) / block_words)
    spans = rows.select("doc_id", "_h", "source", "size", "source_size", "target", "_at",
                        F.explode(F.when(F.col("size") > 0, F.sequence(
                            F.floor(F.col("_at") / block_words), last))
                            .otherwise(F.array(F.lit(-1).cast("long")))).alias("block"))
    lo = F.greatest(F.col("block") * block_words, F.col("_at"))
    hi = F.least((F.col("block") + 1) * block_words, F.col("_at") + F.col("size"))
    joined = spans.join(taken.withColumnRenamed("block", "_block"),
                        spans["source"].eqNullSafe(F.col("_source"))
                        & (F.col("block") == F.col("_block")), "left")
    return joined.select(
        "doc_id", "_h", "source", "size", "source_size", "target", "_at",
        (lo - F.col("_at")).alias("lo"), F.greatest(hi - lo, F.lit(0)).alias("words"),
        F.coalesce("times", F.lit(0)).alias("times"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
        seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row for each input row."""
    parts = _pieces(docs, id_col, source_col, text_col, block_words, shard_slots, seed)
    # rows of size 0 share a place, so they are told apart by being counted
    some = (parts.where("size > 0").groupBy("source", "_at", "doc_id", "size", "source_size",
                                            "target")
            .agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    none = parts.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    return some.select(*cols).unionByName(none.select(*cols))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text", block_words: int = BLOCK_WORDS,
                    shard_slots: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """The columns of ``docs`` for every document of which the mix takes a word,
    with the text the mix takes: a pass that takes all words keeps the text as
    it is, another joins the taken words by spaces; a second pass follows on a
    new line. Repeated rows (equal id, text and source) give one row for all."""
    parts = _pieces(docs, id_col, source_col, text_col, block_words, shard_slots, seed)
    lists = (parts.where("times > 0").groupBy("doc_id", "_h", "source").agg(
        F.max("size").alias("_size"),
        F.array_sort(F.collect_list(F.struct("_at", "lo", "words", "times"))).alias("_parts")))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_of(text_col)).alias("_hash"),
        F.col(source_col).cast("string").alias("_source"),
        text_of(text_col).alias("_text")).dropDuplicates(["_id", "_hash", "_source"])
    both = keyed.join(lists, F.col("_id").eqNullSafe(F.col("doc_id"))
                      & (F.col("_hash") == F.col("_h"))
                      & F.col("_source").eqNullSafe(F.col("source"))).select(
        "_row", "_text", "_size", "_parts",
        F.filter(F.split("_text", SPACES), lambda w: w != "").alias("_words"))

    def turn(k: int) -> Column:
        own = F.filter("_parts", lambda p: p["times"] >= k)
        n = F.aggregate(own, F.lit(0).cast("long"), lambda s, p: s + p["words"])
        some = F.array_join(F.flatten(F.transform(own, lambda p: F.slice(
            F.col("_words"), (p["lo"] + 1).cast("int"), p["words"].cast("int")))), " ")
        return F.when(n == F.col("_size"), F.col("_text")).when(n > 0, some)

    out = both.withColumn("_new", F.concat_ws("\n", *[turn(k + 1) for k in range(REPEATS)]))
    replaced = {text_col: F.col("_new")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.length("_new").cast(docs.schema["n_chars"].dataType)
    return out.select(*[replaced.get(c, F.col("_row").getField(c)).alias(c)
                        for c in docs.columns])
