"""Toxicity: a linear classifier on character n-grams whose features are scaled
by naive Bayes log-count ratios.

A text's features are the distinct n-grams of 3 to 6 characters of its
lower-cased text, hashed to ``2**BITS`` slots. On a bounded, documented sample
(at most ``PER_CLASS`` labelled documents of each label, whole texts, one task)
each slot gets the log ratio r of its smoothed document frequencies among toxic
and other documents. Slots whose ratio is small or that occur in few documents
carry nothing and are left out; a logistic model is fitted on the others with
r as the feature value (full-batch gradient with momentum, L2). Both labels
weigh the same in the fit, so rare toxic texts count as much as the others.
Scoring reads whole texts; only slots with a weight are made distinct.

Defined cases: a NULL or empty text has no n-grams and gets the model's base
score; without labels of both kinds every score is the share of label 1 (0.0
without any); rows that repeat a doc_id are scored by their own text; other
columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.llm import labelled
from bidmill.llm.store import text_of

PER_CLASS = 1500
MODULUS, HELD = 3, 1
THRESHOLD = 0.7
SHORTEST, LONGEST, BITS = 3, 6, 20
MIN_DOCS, MIN_RATIO = 5, 0.7
STEPS, RATE, PENALTY = 300, 0.5, 1e-3
BLOCK_CHARS = 1 << 17
_MULT = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393, 3550635117],
                 dtype=np.uint32)


def _slots(texts: list[str]):
    """For each n-gram length: the slots of all positions of the texts laid
    behind each other, with zeros between; and each text's first position."""
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    first = np.concatenate(([0], np.cumsum(sizes + LONGEST)))
    glue = "\0" * LONGEST
    chars = np.frombuffer((glue.join(texts) + glue).lower().encode("utf-32-le"), dtype=np.uint32)
    if len(chars) != first[-1]:   # lower case of some characters is longer
        texts = [t.lower() for t in texts]
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        first = np.concatenate(([0], np.cumsum(sizes + LONGEST)))
        chars = np.frombuffer((glue.join(texts) + glue).encode("utf-32-le"), dtype=np.uint32)
    grams, mixed = [], np.zeros(len(chars), dtype=np.uint32)
    for n in range(1, LONGEST + 1):
        mixed = mixed[:len(chars) - n + 1] + (chars[n - 1:] + np.uint32(n)) * _MULT[n - 1]
        if n >= SHORTEST:
            h = mixed ^ (mixed >> np.uint32(15))
            h = h * np.uint32(739982445)
            grams.append((h ^ (h >> np.uint32(12))) & np.uint32((1 << BITS) - 1))
    return grams, first, sizes


def _distinct(texts: list[str], used: np.ndarray | None = None):
    """(text, slot) pairs without repeats; ``used`` keeps marked slots only."""
    grams, first, sizes = _slots(texts)
    pairs = []
    for n, slots in enumerate(grams, SHORTEST):
        at = np.flatnonzero(used[slots]) if used is not None else np.arange(len(slots))
        doc = np.searchsorted(first, at, side="right") - 1
        whole = at - first[doc] + n <= sizes[doc]
        pairs.append((doc[whole].astype(np.uint64) << np.uint64(BITS)) | slots[at[whole]])
    pairs = np.unique(np.concatenate(pairs))
    return (pairs >> np.uint64(BITS)).astype(np.int64), \
        (pairs & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _chunks(texts: list[str]):
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_CHARS:
            yield lo, texts[lo:i + 1]
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, texts[lo:]


def fit(texts: list[str], target: np.ndarray) -> dict:
    docs, slots = [], []
    for lo, part in _chunks(texts):
        d, s = _distinct(part)
        docs.append((d + lo).astype(np.int32))
        slots.append(s.astype(np.int32))
    docs, slots = np.concatenate(docs), np.concatenate(slots)
    width = 1 << BITS
    in_toxic = np.bincount(slots[target[docs] == 1], minlength=width)
    in_other = np.bincount(slots[target[docs] == 0], minlength=width)
    n1, n0 = max(1, int(target.sum())), max(1, int((1 - target).sum()))
    ratio = np.log((in_toxic + 1) / (n1 + 2)) - np.log((in_other + 1) / (n0 + 2))
    used = (in_toxic + in_other >= MIN_DOCS) & (np.abs(ratio) >= MIN_RATIO)
    names = np.flatnonzero(used)
    place = np.zeros(width, dtype=np.int64)
    place[names] = np.arange(len(names))
    keep = used[slots]
    docs, cols = docs[keep], place[slots[keep]]
    value = ratio[names][cols]
    weight, bias = np.zeros(len(names)), 0.0
    speed, bias_speed = np.zeros(len(names)), 0.0
    # step size by the largest curvature that a document's row can have
    size = np.sqrt(np.bincount(docs, weights=value ** 2, minlength=len(texts))).max(initial=1.0)
    rate = RATE * 4 / (size ** 2 + 1) * len(texts) ** 0.5
    share = np.where(target == 1, 0.5 / n1, 0.5 / n0)
    for _ in range(STEPS):
        z = np.bincount(docs, weights=weight[cols] * value, minlength=len(texts)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - target) * share
        grad = np.bincount(cols, weights=error[docs] * value, minlength=len(names))
        speed = 0.9 * speed - rate * (grad + PENALTY * weight)
        bias_speed = 0.9 * bias_speed - rate * error.sum()
        weight, bias = weight + speed, bias + bias_speed
    return {"slots": names.astype(np.int32), "weights": weight * ratio[names],
            "bias": np.array([bias])}


def _fit_rows(batches):
    rows = pd.concat(list(batches), ignore_index=True)
    if not len(rows) or rows["label"].nunique() < 2:
        return
    rows = rows.sort_values(["_id", "_text"], ignore_index=True)
    store = io.BytesIO()
    np.savez(store, **fit(list(rows["_text"]), rows["label"].to_numpy()))
    yield pd.DataFrame({"model": [store.getvalue()]})


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic",
          modulus: int = MODULUS, remainder: int = HELD, per_class: int = PER_CLASS) -> dict:
    """The slots in use and their weights (at most 2**BITS), or a constant."""
    rows, counts, _ = labelled.sample(docs, labels, label_col, modulus, remainder, per_class)
    total = sum(counts.values())
    fitted = rows.repartition(1).mapInPandas(_fit_rows, "model binary").collect() \
        if len(counts) == 2 else []
    if not fitted:
        return {"constant": counts.get(1, 0) / total if total else 0.0}
    return dict(np.load(io.BytesIO(bytes(fitted[0]["model"]))))


def text_scores(texts: list[str], model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    weights = np.zeros(1 << BITS)
    weights[model["slots"]] = model["weights"]
    used = weights != 0
    out = [np.empty(0)]
    for _, part in _chunks(texts):
        docs, slots = _distinct(part, used)
        out.append(np.bincount(docs, weights=weights[slots], minlength=len(part)))
    z = np.concatenate(out) + model["bias"][0]
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _scores(model: dict):
    def run(batches):
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(text_scores(texts, model), pa.float64())],
                names=[*batch.schema.names[:-1], "score"])
    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """All rows of ``docs`` as struct ``row``, and ``score``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       text_of().alias("_text"))
    return rows.mapInArrow(_scores(model), rows.select("row").schema.add("score", "double"))
