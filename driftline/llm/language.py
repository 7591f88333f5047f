"""Language identification with blended-spectrum string kernels.

Two texts are compared by the character n-grams (n = 1 to 3) that both hold, each counted
once: k(x, y) = |grams(x) & grams(y)| / sqrt(|grams(x)| |grams(y)|). Nystroem landmarks
stand for the training texts, and one-versus-rest kernel ridge regression on the landmark
kernel gives a score for each language. N-grams are hashed to a fixed number of slots.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from driftline.llm.common import extend
from driftline.shared import staged

#: Most training documents of one language, and most landmarks of all languages together.
TRAIN_PER_LANGUAGE = 400
LANDMARKS = 300
UNKNOWN = "und"
_SLOT_BITS = 18
_RIDGE = 1e-2
_RUN = re.compile(r"[\W\d_]+")
# Odd multipliers that spread code points of a gram over the slots.
_SPREAD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_CHARS = 1 << 20


def grams(text: str) -> np.ndarray:
    """Sorted slots of the n-grams of a text; letters lower-cased, all else one space."""
    codes = np.frombuffer(f" {_RUN.sub(' ', text.lower())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(1 << _SLOT_BITS, dtype=bool)
    for at in range(0, len(codes), _CHARS):
        part = codes[at : at + _CHARS + 2].astype(np.uint64)
        one = part * np.uint64(_SPREAD[0])
        two = one[:-1] ^ (part[1:] * np.uint64(_SPREAD[1]) << np.uint64(1))
        three = two[:-1] ^ (part[2:] * np.uint64(_SPREAD[2]) << np.uint64(2))
        for length, mixed in ((1, one), (2, two), (3, three)):
            mixed = (mixed + np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)
            seen[(mixed >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class LanguageModel:
    """Languages in name order, and the weight of every slot for each of them."""

    languages: list[str]
    weights: np.ndarray

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        """Regression outputs of texts (rows) for all languages (columns), as one product."""
        sizes = np.array([len(g) for g in found])
        starts = np.cumsum(sizes) - sizes
        summed = np.add.reduceat(self.weights[np.concatenate(found)], starts, axis=0)
        return summed / np.sqrt(sizes)[:, None]


def training_rows(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> DataFrame:
    """(lang, text): of each language the ``per_language`` documents with the smallest id hash."""
    ids = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    few = ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language)
    few = staged(few.select("doc_id", "lang"), "training").distinct()
    # ``per_language`` ids for each language: a size that does not grow with the table.
    return docs.select("doc_id", "text", "lang").join(F.broadcast(few), ["doc_id", "lang"]).select("lang", "text")


def train(sample: DataFrame, landmarks: int = LANDMARKS) -> LanguageModel | None:
    """Fits the model to a bounded table ``(lang, text)``; tasks send n-gram slots only."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows["slots"] = [grams(t).tobytes() for t in rows.pop("text")]
            yield rows

    rows = sample.mapInPandas(digest, "lang string, slots binary").collect()
    rows = sorted({(r["lang"], bytes(r["slots"])) for r in rows})
    if not rows:
        return None
    names = [lang for lang, _ in rows]
    found = [np.frombuffer(slots, np.int32) for _, slots in rows]
    languages = sorted(set(names))
    share = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(np.array(names) == c)[:share] for c in languages])

    # Only n-grams of some landmark add to a kernel value.
    slots = np.unique(np.concatenate([found[at] for at in chosen]))
    place = np.full(1 << _SLOT_BITS, -1, dtype=np.int64)
    place[slots] = np.arange(len(slots))
    dense = np.zeros((len(chosen), len(slots)))
    for i, at in enumerate(chosen):
        dense[i, place[found[at]]] = 1 / np.sqrt(len(found[at]))

    def to_landmarks(grams: np.ndarray) -> np.ndarray:
        at = place[grams]
        return dense[:, at[at >= 0]].sum(axis=1) / np.sqrt(len(grams))

    kernel = np.stack([to_landmarks(g) for g in found])

    # Nystroem features: kernel to the landmarks, whitened by their own kernel.
    values, vectors = np.linalg.eigh(kernel[chosen] + 1e-8 * np.eye(len(chosen)))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-8))
    features = kernel @ whiten
    counts = {c: names.count(c) for c in languages}
    each = np.array([len(names) / (len(languages) * counts[c]) for c in names])
    target = np.where(np.array(names)[:, None] == np.array(languages), 1.0, -1.0)
    weighted = features * each[:, None]
    ridge = weighted.T @ features + _RIDGE * len(names) * np.eye(features.shape[1])
    fitted = whiten @ np.linalg.solve(ridge, weighted.T @ target)
    # The regression is linear in the kernel, so the landmarks fold into one weight per slot.
    weights = np.zeros((1 << _SLOT_BITS, len(languages)))
    weights[slots] = dense.T @ fitted
    return LanguageModel(languages, weights)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs(doc_id, text)``, from whole texts.

    score maps the winning regression output from -1..1 to 0..1. Of equal outputs the first
    language by name wins. A text that is null or has no letter is ``und`` with score 0, as
    is every text when there was nothing to learn from. Repeated rows stay repeated.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights) if model else None)

    def make():
        model = LanguageModel(*sent.value) if sent.value else None

        def run(texts: pa.Array) -> list[pa.Array]:
            # Texts that cannot be judged come as null.
            texts = texts.to_pylist()
            names, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            at = np.array([i for i, t in enumerate(texts) if t is not None], dtype=np.int64)
            if model and len(at):
                outputs = model.scores([grams(texts[i]) for i in at])
                names[at] = np.array(model.languages, dtype=object)[outputs.argmax(axis=1)]
                score[at] = np.clip((outputs.max(axis=1) + 1) / 2, 0, 1)
            return [pa.array(names, pa.string()), pa.array(score)]

        return run

    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    named = docs.select("doc_id", lettered.alias("text"))
    return extend(named, "text", make, "lang_pred string, score double", drop=("text",))
