"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; filters of 12 bytes slide over the whole text in steps of
4. Each filter's largest response is taken over overlapping chunks of two
blocks of 256 bytes; the chunks' mean and maximum for each filter are combined
by a logistic layer into one probability. Embedding, filters and output layer
are learned together by backpropagation (Adam) on a bounded, documented sample:
at most ``PER_CLASS`` labelled documents of each label, whole texts, in one
task. The sample is balanced, so the output is shifted back to the labels' own
proportions. Scoring reads each text once, in segments of bounded size.

Defined cases: a NULL or empty text is scored like any other (its chunk holds
no bytes); without labels of both kinds every score is the share of label 1
(0.5 without any); rows that repeat a doc_id are scored by their own text;
other columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.llm import labelled
from bidmill.llm import textscan as ts
from bidmill.llm.store import text_of
from bidmill.session import bound_batches

PER_CLASS = 1000
MODULUS, HELD = 4, 2
THRESHOLD = 0.7
EMBED, FILTERS, STEP, PARTS = 4, 32, 4, 3
BLOCK = 256
LOOK = STEP * (PARTS - 1)
SEGMENT = 1 << 18
EPOCHS, GROUP, RATE = 14, 24, 0.01
_PER_BLOCK = BLOCK // STEP


def _laid_out(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts padded with zeros to whole blocks; each text's first block."""
    sizes = np.diff(off)
    n_blocks = -(-(sizes + LOOK) // BLOCK)
    first = np.concatenate(([0], np.cumsum(n_blocks)))
    flat = np.zeros(int(first[-1]) * BLOCK + LOOK, dtype=np.uint8)
    flat[ts.ranges(first[:-1] * BLOCK, sizes)] = buf
    return flat, first


def _responses(flat: np.ndarray, model: dict) -> np.ndarray:
    """Filter responses of every window of ``flat`` (windows, filters)."""
    groups = model["embed"][flat].reshape(-1, STEP * EMBED)
    parts = groups @ model["filters"]
    n, k = len(groups) - PARTS + 1, model["bias"].shape[0]
    out = parts[:n, :k] + model["bias"]
    for p in range(1, PARTS):
        out += parts[p:n + p, p * k:(p + 1) * k]
    return out


def _block_maxima(flat: np.ndarray, first: np.ndarray, model: dict, where: bool = False):
    """Largest response in each block, and with ``where`` its window."""
    total = len(flat) - LOOK
    ends = first[1:] * BLOCK // STEP   # windows before a text's end look into the next text
    best, at = [], []
    for s in range(0, total, SEGMENT):
        e = min(s + SEGMENT, total)
        out = _responses(flat[s:e + LOOK], model)
        own = ends[(ends > s // STEP) & (ends <= e // STEP)] - s // STEP
        for p in range(1, PARTS):
            out[own - p] = -1e9
        out = out.reshape(-1, _PER_BLOCK, out.shape[1])
        if where:
            pick = out.argmax(axis=1)
            at.append(pick + (s // STEP + np.arange(len(out)) * _PER_BLOCK)[:, None])
            best.append(np.take_along_axis(out, pick[:, None, :], axis=1)[:, 0])
        else:
            best.append(out.max(axis=1))
    best = np.concatenate(best)
    return (best, np.concatenate(at)) if where else best


def _pooled(best: np.ndarray, first: np.ndarray):
    """Chunk features and each text's mean and maximum over its chunks. Chunk j
    is blocks j and j + 1 of its text (the last one alone)."""
    follows = np.ones(len(best), dtype=bool)
    follows[first[1:] - 1] = False
    nxt = np.where(follows[:, None], np.roll(best, -1, axis=0), -np.inf)
    second = nxt > best
    chunk = np.maximum(np.where(second, nxt, best), 0)
    n = np.diff(first)[:, None].astype(np.float32)
    mean = np.add.reduceat(chunk, first[:-1], axis=0) / n
    top = np.maximum.reduceat(chunk, first[:-1], axis=0)
    return chunk, second, mean, top


def _logits(buf, off, model) -> np.ndarray:
    flat, first = _laid_out(buf, off)
    _, _, mean, top = _pooled(_block_maxima(flat, first, model), first)
    return np.hstack([mean, top]) @ model["out"] + model["shift"][0]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _gradients(buf, off, target, model):
    flat, first = _laid_out(buf, off)
    best, at = _block_maxima(flat, first, model, where=True)
    chunk, second, mean, top = _pooled(best, first)
    both = np.hstack([mean, top])
    error = ((_sigmoid(both @ model["out"] + model["shift"][0]) - target)
             / len(target)).astype(np.float32)
    k = best.shape[1]
    doc = np.repeat(np.arange(len(target)), np.diff(first))
    # through the mean, and through the first chunk that holds the maximum
    g = error[doc][:, None] * model["out"][:k] / np.diff(first)[doc][:, None]
    hit = (chunk == top[doc]) & (chunk > 0)
    seen = np.cumsum(hit, axis=0)
    before = np.vstack([np.zeros((1, k), seen.dtype), seen])[first[:-1]][doc]
    g = g + np.where(hit & (seen - before == 1), error[doc][:, None] * model["out"][k:], 0)
    g = np.where(chunk > 0, g, 0).astype(np.float32)
    block = np.where(second, np.arange(len(best))[:, None] + 1, np.arange(len(best))[:, None])
    window = np.take_along_axis(np.vstack([at, at[-1:]]), block, axis=0)
    live = np.nonzero(g)
    gv, start, which = g[live], window[live], live[1]
    bytes_ = flat[start[:, None] * STEP + np.arange(STEP * PARTS)]
    x = model["embed"][bytes_].reshape(len(gv), PARTS, STEP * EMBED)
    d_filters = np.zeros_like(model["filters"])
    d_embed = np.zeros_like(model["embed"])
    for f in range(k):
        own = which == f
        if not own.any():
            continue
        gf = gv[own]
        d_filters[:, f::k] += np.einsum("n,npi->ip", gf, x[own])
        dx = gf[:, None] * model["filters"][:, f::k].T.reshape(1, -1)
        dx, by = dx.reshape(-1, EMBED), bytes_[own].ravel()
        for d in range(EMBED):
            d_embed[:, d] += np.bincount(by, weights=dx[:, d], minlength=256)
    return {"embed": d_embed, "filters": d_filters,
            "bias": np.bincount(which, weights=gv, minlength=k).astype(np.float32),
            "out": both.T @ error + 1e-4 * model["out"],
            "shift": np.array([error.sum()], dtype=np.float32)}


def fit(texts: list[bytes], target: np.ndarray, seed: int = 1) -> dict:
    """Train on whole texts; deterministic for given rows and order."""
    rng = np.random.Generator(np.random.PCG64(seed))

    def start(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    model = {"embed": start(256, EMBED, scale=0.5),
             "filters": start(STEP * EMBED, PARTS * FILTERS, scale=0.3),
             "bias": np.zeros(FILTERS, np.float32), "out": start(2 * FILTERS, scale=0.1),
             "shift": np.zeros(1, np.float32)}
    m = {k: np.zeros_like(v) for k, v in model.items()}
    v = {k: np.zeros_like(x) for k, x in model.items()}
    target = target.astype(np.float32)
    steps = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        rate = RATE * (1 - 0.9 * epoch / EPOCHS)
        for lo in range(0, len(order), GROUP):
            own = order[lo:lo + GROUP]
            off = np.concatenate(([0], np.cumsum([len(texts[i]) for i in own])))
            buf = np.frombuffer(b"".join(texts[i] for i in own), dtype=np.uint8)
            steps += 1
            for name, g in _gradients(buf, off, target[own], model).items():
                m[name] += 0.1 * (g - m[name])
                v[name] += 0.01 * (g * g - v[name])
                model[name] -= (rate * (m[name] / (1 - 0.9 ** steps))
                                / (np.sqrt(v[name] / (1 - 0.99 ** steps)) + 1e-6)
                                ).astype(np.float32)
    return model


def _fit_rows(batches):
    rows = pd.concat(list(batches), ignore_index=True)
    if not len(rows) or rows["label"].nunique() < 2:
        return
    rows = rows.sort_values(["_id", "_text"], ignore_index=True)
    model = fit([t.encode() for t in rows["_text"]], rows["label"].to_numpy())
    store = io.BytesIO()
    np.savez(store, **model)
    yield pd.DataFrame({"model": [store.getvalue()]})


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
          modulus: int = MODULUS, remainder: int = HELD, per_class: int = PER_CLASS) -> dict:
    """A model of a few KB: weights, or only a constant without both labels."""
    bound_batches(docs.sparkSession)
    rows, counts, drawn = labelled.sample(docs, labels, label_col, modulus, remainder, per_class)
    total = sum(counts.values())
    fitted = rows.repartition(1).mapInPandas(_fit_rows, "model binary").collect() \
        if len(counts) == 2 else []
    if not fitted:
        return {"constant": counts.get(1, 0) / total if total else 0.5}
    model = dict(np.load(io.BytesIO(bytes(fitted[0]["model"]))))
    model["shift"] = (model["shift"] + np.log(counts[1] / counts[0])
                      - np.log(drawn[1] / drawn[0])).astype(np.float32)
    return model


def _scores(model: dict):
    def run(batches):
        for batch in batches:
            parts = [np.empty(0)]
            for _, buf, off in ts.blocks(batch.column("_text"), SEGMENT):
                parts.append(np.full(len(off) - 1, model["constant"]) if "constant" in model
                             else _sigmoid(_logits(buf, off, model).astype(np.float64)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate(parts), pa.float64())],
                names=[*batch.schema.names[:-1], "score"])
    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """All rows of ``docs`` as struct ``row``, and ``score``."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       text_of().alias("_text"))
    schema = rows.select("row").schema.add("score", "double")
    return rows.mapInArrow(_scores(model), schema)
