"""Language ID by prediction by partial matching (PPM) over bytes.

Each language has a tree of variable-order byte contexts. A context gives a seen byte
its share of the counts; escape method C reserves d / (n + d) of the probability (d
different bytes among n) for the rest, which the next shorter context divides among
the bytes not seen, so every distribution sums to one. Statistics are frozen after
training: the code length of each byte in each context is a table, and a text's exact
code length under a language is a sum of table entries. The shortest wins.

The trees of all languages share their contexts, so one walk finds the entry of all
languages. Training is bounded by ``MAX_DOCUMENTS`` texts per language and
``MAX_CONTEXTS`` contexts; scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stresslake.llm.common import held_out, materialize, read

ORDER = 4
MAX_DOCUMENTS = 300
# Of a longer text an excerpt of this length is learnt from, at a place drawn by hash.
MAX_TRAINING_CHARS = 50_000
# Of all languages together; many languages share it equally.
MAX_SAMPLE_CHARS = 400_000_000
MAX_CONTEXTS = 12_000
# Occurrences, over all languages, that a context of two or more bytes needs.
MIN_COUNT = 8
UNDETERMINED = "und"
_SLICE = 1 << 18


@dataclass(frozen=True)
class PPMModel:
    """Frozen code lengths. Node 0 stands for no context, nodes 1.. are contexts."""

    languages: list[str]
    classes: np.ndarray  # byte -> symbol; 0 is any byte that training did not show
    first: np.ndarray  # symbol -> context of one symbol
    child: np.ndarray  # context, earlier symbol -> longer context or 0
    bits: np.ndarray  # context * symbols + symbol -> code length per language

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits that each language needs for the whole text."""
        symbols = self.classes[np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)]
        start = len(self.first) - 1
        padded = np.concatenate([np.full(ORDER, start, symbols.dtype), symbols])
        total = np.zeros(len(self.languages))
        for at in range(0, len(symbols), _SLICE):
            part = padded[at:at + _SLICE + ORDER]
            n = len(part) - ORDER
            node = self.first[part[ORDER - 1:ORDER - 1 + n]]
            deepest = node
            for back in range(2, ORDER + 1):
                node = self.child[node, part[ORDER - back:ORDER - back + n]]
                deepest = np.where(node > 0, node, deepest)
            total += self.bits[deepest * start + part[ORDER:]].sum(0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its posterior probability under equal priors.

        NULL and texts without a letter are undetermined, with score 0. Of equal
        lengths the first language by name wins.
        """
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        bits = self.code_lengths(text)
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(np.clip(bits[best] - bits, -1000, 0)).sum())


def _contexts(texts: list[np.ndarray], order: int, base: int) -> np.ndarray:
    """Number of context of ``order`` symbols at each position, nearest symbol last."""
    out = []
    for s in texts:
        number = np.zeros(len(s) - ORDER, np.int64)
        for back in range(order, 0, -1):
            number = number * base + s[ORDER - back:len(s) - back]
        out.append(number)
    return np.concatenate(out)


def _mix(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """PPM with escape C and exclusion: distributions from counts and the shorter context's."""
    n, seen = counts.sum(1, keepdims=True), counts > 0
    different = seen.sum(1, keepdims=True)
    left = np.where(seen, 0, shorter).sum(1, keepdims=True)
    escape = np.where(left > 0, different, 0)
    own = counts / np.maximum(n + escape, 1)
    rest = np.where(n > 0, escape / np.maximum(n + escape, 1), 1.0)
    return np.where(seen, own, rest * shorter / np.where(left > 0, left, 1))


def fit(samples: dict[str, list[str]], max_contexts: int = MAX_CONTEXTS) -> PPMModel:
    """Trees of the given languages; keys with no text are left out."""
    samples = {k: v for k, v in sorted(samples.items()) if any(v)}
    raw = {
        k: [np.frombuffer(t.lower().encode("utf-8", "surrogatepass"), np.uint8) for t in v if t]
        for k, v in samples.items()
    }
    classes = np.zeros(256, np.int16)
    shown = np.unique(np.concatenate([x for v in raw.values() for x in v])) if raw else np.empty(0, np.uint8)
    classes[shown] = np.arange(1, len(shown) + 1)
    symbols = len(shown) + 1
    start, base = symbols, symbols + 1
    padded = {
        k: [np.concatenate([np.full(ORDER, start, np.int64), classes[x]]) for x in v] for k, v in raw.items()
    }
    follow = {k: np.concatenate([s[ORDER:] for s in v]) for k, v in padded.items()}

    # Bytes never shown share symbol 0, each with the same code length.
    hidden = 256 - len(shown)
    blind = np.full(symbols, 1 / 256)
    blind[0] = hidden / 256
    order0 = {
        k: _mix(np.bincount(f, minlength=symbols)[None, :].astype(float), blind[None, :])
        for k, f in follow.items()
    }
    # Contexts of one symbol are all kept; longer ones if frequent.
    spelled = [np.arange(base, dtype=np.int64)]
    room = max(0, max_contexts - base)
    for order in range(2, ORDER + 1):
        seen = [np.unique(_contexts(v, order, base), return_counts=True) for v in padded.values()]
        if not seen or not room:
            spelled.append(np.empty(0, np.int64))
            continue
        every, back = np.unique(np.concatenate([c for c, _ in seen]), return_inverse=True)
        total = np.bincount(back, np.concatenate([n for _, n in seen]))
        # A longer context needs its shorter one.
        known = np.isin(every % base ** (order - 1), spelled[-1])
        chosen = np.flatnonzero((total >= MIN_COUNT) & known)
        chosen = chosen[np.argsort(-total[chosen], kind="stable")[:room]]
        spelled.append(np.sort(every[chosen]))
        room -= len(chosen)

    offsets = np.cumsum([1] + [len(s) for s in spelled])
    nodes = int(offsets[-1])
    child = np.zeros((nodes, base), np.int32)
    bits = np.zeros((nodes, symbols, len(samples)), np.float32)
    per_symbol = np.ones(symbols)
    per_symbol[0] = max(hidden, 1)
    for lang, (name, texts) in enumerate(padded.items()):
        shorter = np.repeat(order0[name], base, 0)
        for order, numbers in enumerate(spelled, 1):
            if not len(numbers):
                break
            at = _contexts(texts, order, base)
            place = np.searchsorted(numbers, at)
            hit = numbers[np.minimum(place, len(numbers) - 1)] == at
            table = np.bincount(
                place[hit] * symbols + follow[name][hit], minlength=len(numbers) * symbols
            ).reshape(-1, symbols).astype(float)
            if order > 1:
                up = np.searchsorted(spelled[order - 2], numbers % base ** (order - 1))
                shorter = probability[up]  # noqa: F821  (of the round before)
                child[offsets[order - 2] + up, numbers // base ** (order - 1)] = (
                    offsets[order - 1] + np.arange(len(numbers))
                )
            probability = _mix(table, shorter)
            bits[offsets[order - 1]:offsets[order], :, lang] = -np.log2(np.maximum(probability / per_symbol, 1e-30))
    return PPMModel(
        list(samples), classes, offsets[0] + np.arange(base, dtype=np.int32), child,
        bits.reshape(nodes * symbols, len(samples)),
    )


def train(
    docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_chars: int = MAX_TRAINING_CHARS,
    max_sample: int = MAX_SAMPLE_CHARS,
) -> PPMModel:
    """Fit on texts with a language that are not held out, equally many per language.

    The sample follows a hash of the id: ``max_documents`` texts of a language, whatever
    their length, and of a text over ``max_chars`` characters an excerpt of so many from
    a place that the hash draws. ``max_sample`` bounds the characters of all languages
    together: beyond it excerpts are shorter for all alike. Rows without a language or
    text teach nothing; without any the model has no language. A first cut by the
    language's size keeps the ranking small, however many texts a language has.
    """
    known = docs.where(
        F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id"))
    ).select("lang", "text", F.xxhash64("doc_id", F.xxhash64("text")).alias("h"))
    # Written, so that Spark knows how small it is and does not move the texts to join it.
    sizes = materialize(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    # Twice the share wanted, so that chance leaves enough.
    share = F.least(F.lit(1.0), F.lit(2.0 * max_documents + 100) / F.col("n"))
    drawn = known.join(sizes, "lang").where(F.pmod("h", F.lit(1_000_003)) < share * 1_000_003)
    chars = max(1, min(max_chars, max_sample // max(1, max_documents * sizes.count())))
    over = F.greatest(F.length("text") - chars, F.lit(0))
    at = F.pmod(F.xxhash64("h"), over + 1).cast("int") + 1
    drawn = drawn.select("lang", "h", F.substring("text", at, F.lit(chars)).alias("text"))
    order = W.partitionBy("lang").orderBy("h", "text")
    rows = (
        drawn.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_documents)
        .select("lang", "text").collect()
    )
    samples: dict[str, list[str]] = {}
    for r in rows:
        samples.setdefault(r["lang"], []).append(r["text"])
    return fit(samples)


def predict_columns(model: PPMModel, text: Column) -> Column:
    """A struct of ``lang_pred`` and ``score`` for each whole text."""

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for text in texts:
            name, score = model.predict(text.as_py())
            names.append(name)
            scores.append(score)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
        )

    return predict(text)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang"))
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        predict_columns(model, F.col("text")).alias("p"),
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")
