"""Toxicity by multiple-instance learning: a document is as toxic as its sentences make it.

Only documents carry labels. A sentence has probability sigmoid(bias + sum of its distinct
words' weights), a word's weight being the sum over its whole form and its prefixes; a
document combines its sentences by noisy-or, 1 - prod(1 - p). The weights are fitted to
the document labels through that formula, so the fit itself finds the offending sentences.

Even a clean sentence adds a little, and thousands of them would add up to a toxic text. So
a score is the noisy-or of the worst run of consecutive sentences, each less the leak: what
a sentence of a clean document adds, learnt with the weights. It never falls below the worst
sentence's probability.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from driftline.llm.common import extend, held_out
from driftline.shared import staged

#: Most labelled documents that the fit reads, spread evenly over all by a hash of their id.
TRAIN_DOCS = 6000
THRESHOLD = 0.3
_PREFIXES = (4, 5, 6)
_SLOTS = 1 << 18
_ROUNDS = 150
_RATE = 0.08
# Strength of the pull towards zero weights, against all documents together.
_PRIOR = 0.3
_MIN_DOCS = 3
# Deviations between clean documents by which the leak lies above their mean.
_LEAK_DEVIATIONS = 2
# Words whose sums a task keeps at once.
_CACHE = 50_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


def _features(word: str) -> list[int]:
    """Slots of a lower-case word: its whole form, and each of its proper prefixes of set lengths."""
    forms = ["=" + word] + [word[:n] for n in _PREFIXES if n < len(word)]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % _SLOTS for f in forms]


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    leak: float = 0.0

    def scorer(self):
        """A function from a text to (score, [(start, end, probability) of every sentence])."""
        weights, bias, leak, known = self.weights, self.bias, self.leak, {}

        def score(text: str | None):
            spans, logits = [], []
            for found in _SENTENCE.finditer(text or ""):
                total = bias
                for word in set(_WORD.findall(found[0].lower())):
                    if word not in known:
                        if len(known) >= _CACHE:
                            known.clear()
                        known[word] = float(weights[_features(word)].sum())
                    total += known[word]
                spans.append(found.span())
                logits.append(total)
            if not spans:
                spans, logits = [(0, 0)], [bias]
            z = np.clip(np.array(logits), -30, 30)
            heavy = np.logaddexp(0, z)
            chances = 1 / (1 + np.exp(-z))
            upto = np.concatenate([[0], np.cumsum(heavy - leak)])
            worst = max(heavy.max(), (upto - np.minimum.accumulate(upto)).max())
            return float(-np.expm1(-worst)), [(a, b, float(p)) for (a, b), p in zip(spans, chances, strict=True)]

        return score


def labelled(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """(text, toxic) of at most ``limit`` labelled documents, whole texts.

    They are those with the smallest hashes of their id, so the choice is the same however
    the table is cut. Of several labels of one document the largest counts.
    """
    ids = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = staged(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit), "labelled")
    # At most ``limit`` rows of two numbers: small enough to send to every task.
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "toxic")


def train(sample: DataFrame) -> ToxicityModel:
    """Fits the model to a bounded table ``(text, toxic)``; tasks send each text's distinct words and where its sentences have them."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text, toxic in zip(rows["text"], rows["toxic"], strict=True):
                sentences = [sorted(set(_WORD.findall(s.lower()))) for s in _SENTENCE.findall(text or "")]
                words = sorted({w for s in sentences for w in s})
                place = {w: i for i, w in enumerate(words)}
                sizes = np.array([len(s) for s in sentences] or [0], np.int32)
                at = np.array([place[w] for s in sentences for w in s], np.int32)
                out.append((int(toxic), " ".join(words), sizes.tobytes(), at.tobytes()))
            yield pd.DataFrame(out, columns=["toxic", "words", "sizes", "places"])

    # Written once, then a sixteenth at a time reaches the driver, where words become numbers at once.
    rows = staged(sample.mapInPandas(digest, "toxic int, words string, sizes binary, places binary"), "digests").coalesce(16)
    numbers: dict[str, int] = {}
    found = []
    for r in rows.toLocalIterator():
        own = np.array([numbers.setdefault(w, len(numbers)) for w in r["words"].split()], np.int32)
        mark = hashlib.sha256(r["words"].encode("utf-8", "surrogatepass") + bytes(r["places"])).digest()
        sizes, places = (np.frombuffer(bytes(r[c]), np.int32) for c in ("sizes", "places"))
        found.append((mark, r["toxic"] > 0, own, sizes, places))
    if not found:
        return ToxicityModel(np.zeros(_SLOTS), -30.0)
    found.sort(key=lambda f: f[:2])
    return _fit(np.array([f[1] for f in found], float), list(numbers), *([f[n] for f in found] for n in (2, 3, 4)))


def _fit(toxic: np.ndarray, words: list[str], own: list, sizes: list, places: list) -> ToxicityModel:
    """Adam on the mean noisy-or log loss with a Gaussian prior; all documents in every step.

    ``own[i]`` numbers the distinct words of document i; ``places[i]`` points into them,
    sentence after sentence, ``sizes[i]`` giving how many each sentence has.
    """
    forms = [_features(w) for w in words]
    pair_word = np.repeat(np.arange(len(forms), dtype=np.int32), [len(f) for f in forms])
    pair_slot = np.fromiter((f for fs in forms for f in fs), np.int32)
    first = np.searchsorted(pair_word, np.arange(len(forms) + 1))
    # A form seen in very few documents says nothing about others.
    seen = np.zeros(_SLOTS, np.int64)
    for doc in own:
        if len(doc):
            slots = np.concatenate([pair_slot[first[w] : first[w + 1]] for w in doc])
            seen[np.unique(slots)] += 1
    keep = seen[pair_slot] >= _MIN_DOCS
    pair_word, pair_slot = pair_word[keep], pair_slot[keep]
    doc_of = np.repeat(np.arange(len(sizes), dtype=np.int32), [len(s) for s in sizes])
    sentence_of = np.repeat(np.arange(len(doc_of), dtype=np.int32), np.concatenate(sizes))
    word_of = np.concatenate([doc[at] for doc, at in zip(own, places, strict=True)])
    weights, bias = np.zeros(_SLOTS), -4.0
    means, squares = np.zeros(_SLOTS + 1), np.zeros(_SLOTS + 1)
    for step in range(1, _ROUNDS + 1):
        by_word = np.bincount(pair_word, weights[pair_slot], len(forms))
        z = np.clip(bias + np.bincount(sentence_of, by_word[word_of], len(doc_of)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        clean = np.bincount(doc_of, -np.logaddexp(0, z), len(toxic))
        chance = np.clip(-np.expm1(clean), 1e-9, 1)
        # d loss / d z of a sentence: p for clean documents, p * (1 - 1 / chance) for toxic ones.
        slope = p * (1 - toxic / chance)[doc_of] / len(toxic)
        by_word = np.bincount(word_of, slope[sentence_of], len(forms))
        gradient = np.append(np.bincount(pair_slot, by_word[pair_word], _SLOTS) + _PRIOR / len(toxic) * weights, slope.sum())
        means = 0.9 * means + 0.1 * gradient
        squares = 0.99 * squares + 0.01 * gradient**2
        move = _RATE * (means / (1 - 0.9**step)) / (np.sqrt(squares / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return ToxicityModel(weights, float(bias), _leak(weights, bias, toxic, forms, own, sizes, places))


def _leak(weights: np.ndarray, bias: float, toxic: np.ndarray, forms: list, own: list, sizes: list, places: list) -> float:
    """What a sentence of a clean document adds to -log(1 - score): mean and some deviations between documents."""
    by_word = np.array([weights[f].sum() for f in forms])
    counts, rates = [], []
    for n in np.flatnonzero((toxic == 0) & [len(s) > 0 for s in sizes]):
        sentence_of = np.repeat(np.arange(len(sizes[n])), sizes[n])
        z = bias + np.bincount(sentence_of, by_word[own[n][places[n]]], len(sizes[n]))
        counts.append(len(z))
        rates.append(np.logaddexp(0, np.clip(z, -30, 30)).mean())
    if not counts:
        return 0.0
    mean = np.average(rates, weights=counts)
    return float(mean + _LEAK_DEVIATIONS * np.sqrt(np.average((rates - mean) ** 2, weights=counts)))


def score_documents(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, predicted, n_sentences and offending.

    offending lists (start, end, score), in characters, of the sentences that reach
    ``threshold`` alone, and of the worst one where only all together do. Whole texts are
    read; a null text counts as empty, and a text without sentences has the model's score
    of an empty sentence. Columns of those four names are replaced; all others stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.leak))
    extra = "score double, predicted int, n_sentences int, offending array<struct<start:int,end:int,score:double>>"

    def make():
        score = ToxicityModel(*sent.value).scorer()
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

        def run(texts: pa.Array) -> list[pa.Array]:
            found = [score(t) for t in texts.to_pylist()]
            offending = [
                [x for x in spans if x[2] >= threshold] or ([max(spans, key=lambda x: x[2])] if s >= threshold else [])
                for s, spans in found
            ]
            return [
                pa.array([s for s, _ in found], pa.float64()),
                pa.array([int(s >= threshold) for s, _ in found], pa.int32()),
                pa.array([len(spans) for _, spans in found], pa.int32()),
                pa.array([[dict(zip(("start", "end", "score"), x, strict=True)) for x in row] for row in offending], kind),
            ]

        return run

    return extend(docs, "text", make, extra, rows=1000)


def fit_held_in(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> ToxicityModel:
    """The model learnt from the labels of all folds of four but number 2."""
    return train(labelled(docs, labels.where(~held_out(F.col("doc_id"), 4, 2)), limit))
