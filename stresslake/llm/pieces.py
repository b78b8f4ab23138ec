"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

A model file gives pieces with log scores. Encoding turns blanks into the marker
``▁`` (with one in front), then finds the segmentation with the highest sum of
scores; a character that no piece covers costs the lowest score less ten and leaves
as byte pieces. Decoding joins the pieces, puts bytes together to UTF-8 and turns
markers back into blanks.

No piece of a usable model holds a marker after another character, so the best
segmentation of a text is that of its words one after the other. Words are looked up
in a bounded cache; only new ones are searched.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stresslake.llm.common import read

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_COST = 10.0
# Piece types of the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Words held per task; two generations, so frequent words survive a change.
CACHE_WORDS = 200_000
# Longer words are searched each time rather than held.
CACHE_LENGTH = 64


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message: number and raw value."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


def read_model(data: bytes) -> list[tuple[str, float, int]]:
    """Pieces of a model file in order of their ids: text, score and type."""
    out = []
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0
            out.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
    return out


def double_array(keys: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value arrays of a trie; a key's value is its place in ``keys``.

    Keys are lists of codes from 1. Child of node n by code c: t = base[n] + c, valid
    if check[t] == n. The arrays are long enough for every code at every node.
    """
    children: list[dict[int, int]] = [{}]
    values = [-1]
    for number, key in enumerate(keys):
        node = 0
        for code in key:
            node = children[node].setdefault(code, len(children))
            if node == len(children):
                children.append({})
                values.append(-1)
        values[node] = number
    widest = max((max(key) for key in keys if key), default=0) + 1
    size = 2 * len(children) + 2 * widest
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = bytearray(size)
    place = {0: 0}
    taken[0] = 1
    value[0] = values[0]
    search_from = 1
    stack = [0]
    while stack:
        node = stack.pop()
        here = place[node]
        if not children[node]:
            continue
        codes = sorted(children[node])
        # First place for the smallest code from which all others are free too. Once
        # the part searched is nearly full, later searches begin behind it.
        slot = began = max(search_from, codes[0] + 1)
        full = 0
        while True:
            if slot + 2 * widest > len(taken):
                more = len(taken)
                taken.extend(bytes(more))
                base = np.concatenate([base, np.zeros(more, np.int32)])
                check = np.concatenate([check, np.full(more, -1, np.int32)])
                value = np.concatenate([value, np.full(more, -1, np.int32)])
            if taken[slot]:
                full += 1
            elif not any(taken[slot - codes[0] + c] for c in codes):
                break
            slot += 1
        at = slot - codes[0]
        if slot - began > 64 and full >= 0.95 * (slot - began):
            search_from = slot
        base[here] = at
        for code, child in children[node].items():
            slot = at + code
            taken[slot] = 1
            check[slot], value[slot], place[child] = here, values[child], slot
        stack.extend(children[node].values())
    return base, check, value


@dataclass
class PieceModel:
    """Everything a task needs; its size is bounded by the vocabulary."""

    pieces: list[tuple[str, float, int]]
    codes: dict[str, int]
    base: list[int]
    check: list[int]
    # Per slot of the trie: the piece's id, or -1, and its score.
    ids: list[int]
    scores: list[float]
    unknown_score: float
    unknown_id: int
    byte_ids: list[int]
    breaks: str
    # Characters of the longest piece.
    longest: int

    @classmethod
    def load(cls, data: bytes) -> PieceModel:
        pieces = read_model(data)
        plain = [i for i, (_, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)]
        words = [pieces[i][0] for i in plain]
        if any(MARKER in w.lstrip(MARKER) for w in words):
            raise ValueError("a piece holds a marker after another character")
        # Frequent characters first, which keeps the trie dense.
        tally = Counter("".join(words))
        codes = {c: i for i, (c, _) in enumerate(tally.most_common(), 1)}
        base, check, value = double_array([[codes[c] for c in w] for w in words])
        slots = value.tolist()
        ids = [plain[v] if v >= 0 else -1 for v in slots]
        scores = [pieces[i][1] if i >= 0 else 0.0 for i in ids]
        by_byte = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
        # No piece holds a line break, so it always stands alone: texts may be cut there.
        alone = "" if any("\n" in w for w in words) else "\n"
        return cls(
            pieces, codes, base.tolist(), check.tolist(), ids, scores,
            min((pieces[i][1] for i in plain), default=0.0) - UNKNOWN_COST, unknown,
            [by_byte[b] for b in range(256)] if len(by_byte) == 256 else [], alone,
            max(map(len, words), default=1),
        )

    def best_path(self, word: str) -> list[int]:
        """Ids of the best segmentation of one stretch of normalised text.

        Of equal sums the path whose last piece begins first wins.
        """
        known = self.codes.get
        codes = [known(c, 0) for c in word]
        base, check, ids, scores = self.base, self.check, self.ids, self.scores
        n, longest = len(codes), self.longest
        best = [-1e300] * (n + 1)
        best[0] = 0.0
        came, piece_at = [0] * (n + 1), [-1] * (n + 1)
        for start in range(n):
            so_far = best[start]
            node, end, single = 0, start, False
            # No piece is longer; a stretch of any length is searched in linear time.
            for at in range(start, min(n, start + longest)):
                code = codes[at]
                slot = base[node] + code
                # Code 0 is no character of any piece, and base[node] is no child.
                if check[slot] != node or not code:
                    break
                node = slot
                end += 1
                piece = ids[slot]
                if piece >= 0:
                    score = so_far + scores[slot]
                    if score > best[end]:
                        best[end], came[end], piece_at[end] = score, start, piece
                    if end == start + 1:
                        single = True
            if not single:
                score = so_far + self.unknown_score
                if score > best[start + 1]:
                    best[start + 1], came[start + 1], piece_at[start + 1] = score, start, -1
        out: list[int] = []
        at = n
        while at:
            piece, start = piece_at[at], came[at]
            if piece >= 0:
                out.append(piece)
            elif self.byte_ids:
                raw = word[start:at].encode("utf-8", "surrogatepass")
                out.extend(self.byte_ids[b] for b in reversed(raw))
            else:
                out.append(self.unknown_id)
            at = start
        return out[::-1]

    def stretches(self, text: str) -> list[str]:
        """Normalised text in stretches that no piece crosses: markers, then the rest."""
        whole = MARKER + text.replace(" ", MARKER)
        line = f"|{self.breaks}+" if self.breaks else ""
        other = f"[^{MARKER}{self.breaks}]"
        return re.findall(rf"{MARKER}*{other}+|{MARKER}+{line}", whole)


class Encoder:
    """Encoding and decoding with a cache of words; one per task."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.texts = [
            bytes([int(p[1:-1], 16)]) if kind == BYTE
            else b"" if kind == CONTROL
            else " ⁇ ".encode() if kind == UNKNOWN
            else p.replace(MARKER, " ").encode()
            for p, _, kind in model.pieces
        ]

    def _search(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = array("i", self.model.best_path(word)).tobytes()
        if len(word) <= CACHE_LENGTH:
            if len(self.young) >= CACHE_WORDS:
                self.old, self.young = self.young, {}
            self.young[word] = found
        return found

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the whole text; NULL and empty texts have none."""
        if not text:
            return np.empty(0, "<i4")
        young = self.young.get
        parts = [young(w) or self._search(w) for w in self.model.stretches(text)]
        return np.frombuffer(b"".join(parts), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        texts = self.texts
        data = b"".join([texts[i] for i in ids.tolist()])
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _run_in_tasks(docs: DataFrame, row, schema: str, model_path: str, column: str) -> DataFrame:
    """Adds what ``row(encoder, value)`` gives, as columns, to each row of ``docs``."""
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    keep = [f.name for f in docs.schema]
    added = docs.sparkSession.createDataFrame([], schema).schema
    out = docs.schema.__class__(docs.schema.fields + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(PieceModel.load(model.value))
        for batch in batches:
            rows = [row(encoder, v.as_py()) for v in batch.column(column)]
            values = list(zip(*rows, strict=True)) if rows else [()] * len(added)
            arrays = [
                pa.array(v, to_arrow[f.dataType.simpleString()])
                for v, f in zip(values, added, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in keep] + arrays, names=keep + added.names
            )

    to_arrow = {
        "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
    }
    return docs.mapInArrow(run, out)


def encode(docs: DataFrame, model_path: str = MODEL_PATH, text: str = "text", name: str = "piece_ids") -> DataFrame:
    """``docs`` with the piece ids of each whole text as an array.

    NULL and empty texts get an empty array. A column of the same name is replaced;
    the other columns, repeated rows included, stay.
    """
    return _run_in_tasks(
        docs.drop(name), lambda encoder, value: (encoder.encode(value),), f"{name} array<int>", model_path, text
    )


def decode(rows: DataFrame, model_path: str = MODEL_PATH, ids: str = "piece_ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of an array of piece ids; NULL gives the empty text."""
    return _run_in_tasks(
        rows.drop(name),
        lambda encoder, value: (encoder.decode(np.array(value or [], "<i4")),),
        f"{name} string", model_path, ids,
    )


def _digest(encoder: Encoder, text: str | None) -> tuple[int, int, str, str, bool]:
    ids = encoder.encode(text)
    back = encoder.decode(ids)
    low, high = min(encoder.model.byte_ids, default=0), max(encoder.model.byte_ids, default=-1)
    return (
        len(ids), int(((ids >= low) & (ids <= high)).sum()), hashlib.sha256(ids.tobytes()).hexdigest(),
        hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == (text or ""),
    )


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: pieces, byte pieces, digests of ids (little-endian int32) and of the
    decoded text, and whether decoding gives the text back."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    columns = "n_pieces bigint, n_bytes bigint, ids_sha256 string, decoded_sha256 string, lossless boolean"
    return _run_in_tasks(docs, _digest, columns, MODEL_PATH, "text").drop("text")
