"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the
pieces drives a single-pass Viterbi search.

The automaton works on UTF-8 bytes with a complete transition table. It reports,
for each end position, every piece that ends there, longest first along its
output links. Each such piece relaxes the best score of its end from the best
score of its start; back pointers give the ids. A character that is no piece by
itself may also be spelled with byte pieces, at a score below every piece's.
Ties go to the longer last piece.

The vocabulary is read once on the driver, from a path that is a parameter, and
shipped with the tasks; its size is fixed by the file. Where two neighbouring
bytes stand side by side in no piece, every path has a boundary, so a text
falls into independent segments there (about words). The distinct segments of a
block of texts that a task hasn't met lately run through the automaton side by
side, one byte of each at a time (numpy); a bounded number of solved segments
is kept.

A space stands in front of every non-empty text, as in the vocabulary's own
rules, and is removed by decoding. The word-boundary mark itself (U+2581), when
a text holds it, is spelled with bytes, so decoding gives back every text
exactly.

Defined cases: a NULL text is encoded like an empty one, as no ids; a text of
any length is one search (segments bound its memory); other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.llm.store import text_of
from bidmill.session import bound_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_COST = 10.0
KEPT_SEGMENTS = 400_000
SIDE_BY_SIDE = 1 << 18      # bytes of segments searched at once
BLOCK_CHARS = 1 << 19


def load(path: str = MODEL) -> dict:
    """Pieces (text with spaces), scores, and each id's bytes."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, spelled, byte_ids = {}, [], {}
    for i in range(sp.get_piece_size()):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            spelled.append(bytes([int(name[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            spelled.append(b"")
        else:
            text = name.replace(MARK, " ")
            pieces[text] = (i, sp.get_score(i))
            spelled.append(text.encode())
    return vocabulary(pieces, spelled, [byte_ids[b] for b in range(256)])


def vocabulary(pieces: dict[str, tuple[int, float]], spelled: list[bytes],
               byte_ids: list[int]) -> dict:
    lowest = min((s for _, s in pieces.values()), default=0.0)
    return {"pieces": pieces, "spelled": spelled, "bytes": byte_ids,
            "unknown": lowest - UNKNOWN_COST}


class Automaton:
    """Aho-Corasick tables over byte strings: ``go`` (state, byte) -> state;
    ``out`` state -> nearest state that ends a piece, itself included, else 0;
    ``link`` state -> the next shorter such state; and each state's piece."""

    def __init__(self, pieces: list[tuple[bytes, int, float]]):
        child: list[dict[int, int]] = [{}]
        ends = {}
        for text, i, score in pieces:
            at = 0
            for byte in text:
                nxt = child[at].get(byte)
                if nxt is None:
                    nxt = child[at][byte] = len(child)
                    child.append({})
                at = nxt
            ends[at] = (i, len(text), score)
        n = len(child)
        self.go = np.zeros((n, 256), dtype=np.int32)
        self.out, self.link = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.piece, self.length = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.score = np.zeros(n)
        for state, (i, length, score) in ends.items():
            self.piece[state], self.length[state], self.score[state] = i, length, score
        fall, level = np.zeros(n, dtype=np.int32), [0]
        while level:
            below = []
            for state in level:
                # what the longest proper suffix knows, then the state's own children
                shorter = fall[state]
                if state:
                    self.go[state] = self.go[shorter]
                    self.link[state] = self.out[shorter]
                    self.out[state] = state if state in ends else self.out[shorter]
                for byte, nxt in child[state].items():
                    fall[nxt] = self.go[state, byte] if state else 0
                    below.append(nxt)
                for byte, nxt in child[state].items():
                    self.go[state, byte] = nxt
            level = below


class Encoder:
    """The automaton and its search, built once for each task."""

    def __init__(self, vocab: dict):
        self.auto = Automaton([(t.encode(), i, s) for t, (i, s) in vocab["pieces"].items()])
        self.spell = np.array(vocab["bytes"], dtype=np.int32)
        self.unknown = vocab["unknown"]
        # bytes that stand side by side in a piece or within a character
        self.joined = np.zeros((256, 256), dtype=bool)
        for text in vocab["pieces"]:
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            self.joined[raw[:-1], raw[1:]] = True
        self.joined[:, 0x80:0xC0] = True
        self.known: dict[bytes, bytes] = {}

    def search(self, parts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """For byte strings, longest first: best ids (as 32-bit ints) and scores."""
        auto = self.auto
        size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        n, longest = len(parts), int(size[0])
        text = np.zeros((n, longest), dtype=np.uint8)
        text[np.arange(longest) < size[:, None]] = np.frombuffer(b"".join(parts), np.uint8)
        # bytes of the character that ends at a byte, or 0 within one
        inner = (text & 0xC0) == 0x80
        ends_char = np.ones_like(inner)
        ends_char[:, :-1] = ~inner[:, 1:]
        begun = np.where(inner, 0, np.arange(longest))
        width = np.where(ends_char, np.arange(1, longest + 1)
                         - np.maximum.accumulate(begun, axis=1), 0)
        best = np.full((n, longest + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, longest + 1), dtype=np.int32)   # bytes to go back
        which = np.full((n, longest + 1), -1, dtype=np.int32)
        state = np.zeros(n, dtype=np.int32)
        live = np.searchsorted(-size, -np.arange(longest), side="left")
        for j in range(longest):
            m = live[j]
            state = auto.go[state[:m], text[:m, j]]
            covered = np.zeros(m, dtype=bool)
            end, chars = best[:m, j + 1], width[:m, j]
            rows = np.flatnonzero(auto.out[state])
            node = auto.out[state[rows]]
            while len(rows):
                length = auto.length[node]
                score = best[rows, j + 1 - length] + auto.score[node]
                covered[rows[length == chars[rows]]] = True
                better = score > end[rows]
                hit = rows[better]
                end[hit] = score[better]
                back[hit, j + 1], which[hit, j + 1] = length[better], auto.piece[node[better]]
                node = auto.link[node]
                rows, node = rows[node > 0], node[node > 0]
            # a character that is no piece may be spelled with bytes
            rows = np.flatnonzero(~covered & (chars > 0))
            if len(rows):
                score = best[rows, j + 1 - chars[rows]] + self.unknown
                better = score > end[rows]
                hit = rows[better]
                end[hit] = score[better]
                back[hit, j + 1], which[hit, j + 1] = chars[hit], -1
        # follow the back pointers of all strings together; a step of a spelled
        # character gives one id for each byte
        ids = np.full((n, longest), -1, dtype=np.int32)
        at, rows = size.copy(), np.arange(n)
        while len(rows):
            here = at[rows]
            step, piece = back[rows, here], which[rows, here]
            ids[rows, here - step] = piece
            spelled = np.flatnonzero(piece < 0)
            for k in range(int(step[spelled].max(initial=0))):
                own = spelled[step[spelled] > k]
                place = here[own] - step[own] + k
                ids[rows[own], place] = self.spell[text[rows[own], place]]
            at[rows] = here - step
            rows = rows[at[rows] > 0]
        used = ids >= 0
        flat, cuts = ids[used].tobytes(), np.concatenate(([0], np.cumsum(used.sum(axis=1)))) * 4
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], \
            best[np.arange(n), size]

    def solve(self, parts) -> dict[bytes, bytes]:
        parts = sorted(parts, key=lambda p: (-len(p), p))
        out, lo = {}, 0
        while lo < len(parts):
            hi = lo + max(1, SIDE_BY_SIDE // len(parts[lo]))
            out.update(zip(parts[lo:hi], self.search(parts[lo:hi])[0]))
            lo = hi
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.known) > KEPT_SEGMENTS:
            self.known.clear()
        marked = [b" " + t.encode() if t else b"" for t in texts]
        raw = b"".join(marked)
        buf = np.frombuffer(raw, dtype=np.uint8)
        off = np.concatenate(([0], np.cumsum([len(t) for t in marked]))).astype(np.int64)
        begin = np.zeros(len(buf) + 1, dtype=bool)
        begin[1:-1] = ~self.joined[buf[:-1], buf[1:]]
        begin[off] = True
        cuts = np.flatnonzero(begin)
        first, cuts = np.searchsorted(cuts, off).tolist(), cuts.tolist()
        parts = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        known = self.known
        new = set(parts).difference(known)
        if new:
            known.update(self.solve(new))
        ids = [known[p] for p in parts]
        return [np.frombuffer(b"".join(ids[a:b]), dtype=np.int32)
                for a, b in zip(first, first[1:])]


class Decoder:
    def __init__(self, vocab: dict):
        spelled = vocab["spelled"]
        self.text = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.size = np.fromiter(map(len, spelled), dtype=np.int64, count=len(spelled))
        self.first = np.concatenate(([0], np.cumsum(self.size)[:-1]))

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, without the space in front."""
        size = self.size[ids]
        shift = np.repeat(self.first[ids] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        raw = self.text[np.arange(len(shift)) + shift].tobytes() if len(ids) else b""
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _row_struct(docs: DataFrame, name: str = "row"):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name)


def _runs(texts: list[str]):
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_CHARS:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _encoding(vocab: dict, check: bool):
    def run(batches):
        encoder, decoder = Encoder(vocab), Decoder(vocab)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for lo, hi in _runs(texts):
                found = encoder.encode(texts[lo:hi])
                row = batch.column("row").slice(lo, hi - lo)
                counts = np.fromiter(map(len, found), dtype=np.int32, count=len(found))
                off = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                if check:
                    import hashlib
                    digest = [hashlib.sha256(x.tobytes()).hexdigest() for x in found]
                    yield pa.RecordBatch.from_arrays(
                        [row, pa.array(counts), pa.array(digest, pa.string()),
                         pa.array([decoder.decode(x) for x in found], pa.string())],
                        names=["row", "n_tokens", "ids_sha256", "decoded"])
                else:
                    flat = np.concatenate(found) if found else np.empty(0, np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(off), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([row, ids], names=["row", "ids"])
    return run


def encode(docs: DataFrame, vocab: dict, text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` as struct ``row``, and ``ids`` array<int>."""
    bound_batches(docs.sparkSession)
    rows = docs.select(_row_struct(docs), text_of(text_col).alias("_text"))
    return rows.mapInArrow(_encoding(vocab, False), rows.select("row").schema.add(
        "ids", T.ArrayType(T.IntegerType())))


def round_trip(docs: DataFrame, vocab: dict, text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` as struct ``row``, and n_tokens, ids_sha256 (of the
    little-endian 32-bit ids) and ``decoded``, without carrying the ids."""
    bound_batches(docs.sparkSession)
    rows = docs.select(_row_struct(docs), text_of(text_col).alias("_text"))
    return rows.mapInArrow(_encoding(vocab, True), rows.select("row").schema.add(
        "n_tokens", "integer").add("ids_sha256", "string").add("decoded", "string"))


def decode(rows: DataFrame, vocab: dict, ids_col: str = "ids") -> DataFrame:
    """All rows as struct ``row``, and ``text`` (NULL ids: NULL)."""
    def run(batches):
        decoder = Decoder(vocab)
        for batch in batches:
            out = [decoder.decode(x.values.to_numpy()) if x.is_valid else None
                   for x in batch.column("_ids")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())],
                                             names=["row", "text"])
    picked = rows.select(_row_struct(rows), F.col(f"`{ids_col}`").cast("array<int>").alias("_ids"))
    return picked.mapInArrow(run, picked.select("row").schema.add("text", "string"))
