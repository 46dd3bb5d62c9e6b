"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie, with byte fallback.

The pieces come from a public model file. If that file holds merge ranks instead of log probabilities,
the log score of a piece is the Zipf law's at its rank: -ln(rank + 1) - ln(H), H the harmonic sum.
A character that no piece covers costs the smallest score less 10 and is written as its UTF-8 bytes.

Text is marked like the model does: one marker in front, every space a marker. No piece has a marker
after another character, so the best path is found run by run: each run of markers with the characters
up to the next marker is segmented on its own, once per distinct run. Ties go to the longer last piece.
Decoding joins pieces and bytes, turns markers into spaces and drops the one in front.

Null texts encode to null, empty ones to no ids. The marker character itself decodes to a space, the
format's own loss; invalid byte sequences decode to U+FFFD. Other columns pass through.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0
# Distinct runs remembered by a worker, and the run length from which the scalar path is used.
REMEMBERED = 200_000
LONG_RUN = 96


@dataclass(frozen=True)
class Vocabulary:
    """The trie's two arrays, the piece that ends at a state (-1: none), and the pieces themselves."""

    base: np.ndarray
    check: np.ndarray
    ends: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    surface: tuple[bytes, ...]
    unknown: float
    newline_alone: bool
    by_run: bool


def log_scores(stored: list[float]) -> list[float]:
    """Stored scores, unless they are merge ranks: then the Zipf law's log probability at each rank."""
    if not all(s <= 0 and s == int(s) for s in stored):
        return stored
    norm = math.log(sum(1 / (r + 1) for r in range(len(stored))))
    return [-math.log(1 - s) - norm for s in stored]


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`base`, `check` and `ends` over the keys' bytes: the child of state s by byte c is base[s] + c."""
    children: list[dict[int, int]] = [{}]
    value = [-1]
    for key, number in keys.items():
        node = 0
        for c in key:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                value.append(-1)
            node = children[node][c]
        value[node] = number
    size = 2 * len(children) + 512
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    ends = np.full(size, -1, np.int32)
    used = bytearray(size)
    used[0] = 1
    check[0] = 0
    queue, low = [(0, 0)], 1
    while queue:
        node, state = queue.pop()
        ends[state] = value[node]
        codes = sorted(children[node])
        if not codes:
            base[state] = 0
            continue
        b = max(1, low - codes[0])
        while any(used[b + c] for c in codes):
            b += 1
            if b + 256 >= len(used):
                grow = len(used)
                used.extend(bytes(grow))
                base = np.concatenate([base, np.zeros(grow, np.int32)])
                check = np.concatenate([check, np.full(grow, -1, np.int32)])
                ends = np.concatenate([ends, np.full(grow, -1, np.int32)])
        base[state] = b
        low = max(low, b + codes[0])  # search on from here: a few slots stay free, none is searched twice
        for c in codes:
            used[b + c] = 1
            check[b + c] = state
            queue.append((children[node][c], b + c))
    return base, check, ends


def load(path: str = MODEL_FILE) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    byte_ids = np.full(256, -1, np.int32)
    surface = [b""] * n
    normal = []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            surface[i] = bytes([int(piece[1:-1], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            normal.append(i)
            surface[i] = piece.encode()
    if (byte_ids < 0).any():
        raise ValueError(f"{path} has no byte pieces")
    pieces = {i: model.id_to_piece(i) for i in normal}
    scores = np.zeros(n)
    scores[normal] = log_scores([model.get_score(i) for i in normal])
    base, check, ends = double_array({surface[i]: i for i in normal})
    return Vocabulary(
        base, check, ends, scores, byte_ids, tuple(surface), float(scores[normal].min()) - UNKNOWN_PENALTY,
        newline_alone=not any("\n" in p for p in pieces.values()),
        by_run=not any(re.search(f"[^{MARKER}]{MARKER}", p) for p in pieces.values()),
    )


def runs(text: str, v: Vocabulary) -> list[str]:
    """The independent stretches of the marked text, in order."""
    if not text:
        return []
    marked = MARKER + text.replace(" ", MARKER)
    if not v.by_run:
        return [marked]
    if v.newline_alone:
        return re.findall(f"\n|{MARKER}*[^{MARKER}\n]+|{MARKER}+", marked)
    return re.findall(f"{MARKER}*[^{MARKER}]+|{MARKER}+", marked)


def _char_width(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


def segment(raw: bytes, v: Vocabulary) -> list[int]:
    """One run, byte by byte: for runs too long to be stacked with others."""
    base, check, ends, scores = v.base, v.check, v.ends, v.scores
    n = len(raw)
    best = [-math.inf] * (n + 1)
    start, piece = [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    for i in range(n):
        here = best[i]
        if here == -math.inf:
            continue
        width = _char_width(raw[i])
        state, single = 0, False
        for j in range(i, n):
            following = base[state] + raw[j]
            if following >= len(check) or check[following] != state or not base[state]:
                break
            state = following
            p = ends[state]
            if p >= 0:
                single |= j + 1 - i == width
                total = here + scores[p]
                if total > best[j + 1]:
                    best[j + 1], start[j + 1], piece[j + 1] = total, i, p
        if not single and i + width <= n and here + v.unknown > best[i + width]:
            best[i + width], start[i + width], piece[i + width] = here + v.unknown, i, -1
    return _path(raw, start, piece, v)


def _path(raw: bytes, start: list[int], piece: list[int], v: Vocabulary) -> list[int]:
    out: list[int] = []
    at = len(raw)
    while at:
        if piece[at] >= 0:
            out.append(int(piece[at]))
        else:
            out += [int(v.byte_ids[b]) for b in reversed(raw[start[at] : at])]
        at = start[at]
    return out[::-1]


def segment_many(raws: list[bytes], v: Vocabulary) -> list[bytes]:
    """Many runs of one length in lockstep, each result packed as 32-bit integers."""
    length, count = len(raws[0]), len(raws)
    text = np.frombuffer(b"".join(raws), dtype=np.uint8).reshape(count, length)
    width = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
    boundary = (text & 0xC0) != 0x80
    best = np.full((length + 1, count), -np.inf)
    start = np.zeros((length + 1, count), np.int32)
    piece = np.full((length + 1, count), -1, np.int32)
    best[0] = 0
    top = len(v.check) - 1
    for i in range(length):
        rows = np.flatnonzero(boundary[:, i] & (best[i] > -np.inf))
        single = np.zeros(count, bool)
        state = np.zeros(len(rows), np.int32)
        live = rows
        for j in range(i, length):
            if not len(live):
                break
            from_base = v.base[state]
            following = np.minimum(from_base + text[live, j], top)
            ok = (from_base > 0) & (v.check[following] == state)
            live, state = live[ok], following[ok]
            p = v.ends[state]
            hit = p >= 0
            at, p = live[hit], p[hit]
            single[at] |= width[at, i] == j + 1 - i
            total = best[i, at] + v.scores[p]
            better = total > best[j + 1, at]
            at = at[better]
            best[j + 1, at], start[j + 1, at], piece[j + 1, at] = total[better], i, p[better]
        lost = rows[~single[rows]]
        for w in range(1, 5):
            at = lost[width[lost, i] == w]
            if len(at) and i + w <= length:
                total = best[i, at] + v.unknown
                at, total = at[total > best[i + w, at]], total[total > best[i + w, at]]
                best[i + w, at], start[i + w, at], piece[i + w, at] = total, i, -1
    # Walk all paths back together, filling each row from the right.
    row = np.arange(count)
    at = np.full(count, length)
    back = np.full((count, length), -1, np.int32)
    filled = np.zeros(count, np.int64)
    fallback = np.zeros(count, bool)
    for k in range(length):
        p = piece[at, row]
        fallback |= (p < 0) & (at > 0)
        back[:, length - 1 - k] = p
        filled += at > 0
        at = start[at, row]
        if not at.any():
            break
    flat, width_bytes = back.tobytes(), 4 * length
    found = [flat[(r + 1) * width_bytes - 4 * n : (r + 1) * width_bytes] for r, n in enumerate(filled.tolist())]
    for r in np.flatnonzero(fallback).tolist():
        found[r] = _packed(_path(raws[r], start[:, r].tolist(), piece[:, r].tolist(), v))
    return found


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype=np.int32).tobytes()


class Encoder:
    """Encodes texts, remembering the ids of runs it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    def _learn(self, new: set[str]) -> None:
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for run in new:
            raw = run.encode("utf-8", "replace")
            by_length.setdefault(len(raw), []).append((run, raw))
        for length, members in by_length.items():
            if length > LONG_RUN:
                found = [_packed(segment(raw, self.vocabulary)) for _, raw in members]
            else:
                found = segment_many([raw for _, raw in members], self.vocabulary)
            for (run, _), ids in zip(members, found, strict=True):
                self.known[run] = ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [runs(t, self.vocabulary) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self._learn({r for parts in split for r in parts} - self.known.keys())
        return [np.frombuffer(b"".join([self.known[r] for r in parts]), dtype=np.int32) for parts in split]

    def decode(self, ids: np.ndarray) -> str:
        surface = self.vocabulary.surface
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace").replace(MARKER, " ")
        return text[1:] if text[:1] == " " else text


_BATCH = 1_024


def _codec(documents: DataFrame, path: str) -> DataFrame:
    """The rows with `ids`, `n_pieces`, `n_bytes`, `decoded_sha256` and `round_trip` after their other columns."""
    # Bounded by the vocabulary of the file; plain fields, as broadcasts are pickled by reference.
    spread = documents.sparkSession.sparkContext.broadcast(tuple(vars(load(path)).values()))
    names = documents.columns

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*spread.value))
        is_byte = np.zeros(len(encoder.vocabulary.surface), bool)
        is_byte[encoder.vocabulary.byte_ids] = True
        for big in batches:
            for begin in range(0, big.num_rows, _BATCH):
                part = big.slice(begin, _BATCH)
                given = part.column(names.index("text")).to_pylist()
                texts = [t or "" for t in given]
                ids = encoder.encode(texts)
                back = [encoder.decode(i) for i in ids]
                sizes = np.array([len(i) for i in ids], dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.concatenate(ids)), mask=pa.array([t is None for t in given])
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns, lists, pa.array(sizes), pa.array([int(is_byte[i].sum()) for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(b.encode("utf-8", "replace")).hexdigest() for b in back]),
                        pa.array([b == t for b, t in zip(back, texts, strict=True)]),
                    ],
                    [*names, "ids", "n_pieces", "n_bytes", "decoded_sha256", "round_trip"],
                )

    schema = T.StructType(list(documents.schema.fields))
    schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("n_pieces", "long").add("n_bytes", "long")
    return documents.mapInArrow(coded, schema.add("decoded_sha256", "string").add("round_trip", "boolean"))


def encoded(documents: DataFrame, path: str = MODEL_FILE) -> DataFrame:
    """Every document's ids with what decoding them gives."""
    return _codec(documents.select("doc_id", "text"), path).drop("text")


def encode_documents(documents: DataFrame, path: str = MODEL_FILE) -> DataFrame:
    """The documents' own columns with `ids`, `n_pieces` and `round_trip` after them, replacing any of that name."""
    added = ["ids", "n_pieces", "n_bytes", "decoded_sha256", "round_trip"]
    own = documents.select(*[c for c in documents.columns if c not in added])
    return _codec(own, path).drop("n_bytes", "decoded_sha256")


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    return Encoder(vocabulary).decode(np.asarray(ids, dtype=np.int32))
