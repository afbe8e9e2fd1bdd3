"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidmill.llm.store import discard, stored, text_of

# bytes of text learned from for each label
MAX_BYTES = 32 << 20


def held_out(modulus: int, remainder: int, id_col: str = "doc_id"):
    """True for the documents whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")),
                             F.lit(modulus)) == remainder, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, modulus: int, remainder: int,
           per_class: int, max_bytes: int = MAX_BYTES
           ) -> tuple[DataFrame, dict[int, int], dict[int, int]]:
    """(_id, _text, label) to learn from, the numbers of labels that may be
    learned from, and those of the texts drawn. A label counts once for each
    doc_id.

    For each label these are at most ``per_class`` ids, those with the smallest
    hash, and of an id that repeats the one text with the smallest hash. Texts
    of more than a 16th of ``max_bytes`` are not learned from, and the ids of a
    label end where their texts together reach ``max_bytes``."""
    known = stored(labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()
                                & ~held_out(modulus, remainder))
                   .groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label")), "labels")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * per_class ids
    rows = docs.select(F.col("doc_id").alias("_id"), text_of().alias("_text")).join(
        F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), "_id")
    sized = rows.where(F.octet_length("_text") <= max_bytes // 16).groupBy("_id", "label").agg(
        F.min(F.struct(F.xxhash64("_text").alias("_h"),
                       F.octet_length("_text").alias("_size"))).alias("one"))
    so_far = F.sum("one._size").over(Window.partitionBy("label").orderBy(F.xxhash64("_id"), "_id"))
    within = stored(sized.withColumn("_sum", so_far).where(F.col("_sum") <= max_bytes)
                    .select("_id", "label", F.col("one._h").alias("_h")), "learned")
    discard(known)
    drawn = {r["label"]: r["count"] for r in within.groupBy("label").count().collect()}
    texts = docs.select(F.col("doc_id").alias("_id"), text_of().alias("_text")).withColumn(
        "_h", F.xxhash64("_text"))
    one = (texts.join(F.broadcast(within), ["_id", "_h"])
           .groupBy("_id", "_h", "label").agg(F.min("_text").alias("_text")))
    return one.select("_id", "_text", "label"), counts, drawn
