"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Texts are cut where no piece can stand across the cut: before each word mark. Distinct
words of one length form a matrix and advance together, one position at a time. Hashes of
all substrings probe the sorted keys of the pieces; each position keeps a back-pointer to
the piece that ends there on the best path.

The path's value depends on the model. A unigram model adds up piece scores. A BPE model
has exactly one path on which every two neighbours, merged alone, come out as themselves;
that path is its encoding, so a step is worth 0 when the pair is stable and minus infinity
when not. Stability of a pair is found once, by merging it, and kept in a table.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from driftline.llm.common import extend

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_FILTER_BITS = 22
_MEMO_BITS = 20
_CELLS = 400_000
# Encoded words that a worker may keep from one call to the next, tasks included.
_KEEP_WORDS = 400_000
_UNKNOWN_COST = 10.0
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# The same words where blanks stand for marks.
_SPACED_WORD = re.compile(_WORD.pattern.replace(MARK, " "))

# Kinds of piece in a model file: fixed values of its format.
_NORMAL, _UNK, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


def read_model(spark: SparkSession, path: str = MODEL) -> dict:
    """Pieces, scores, kinds and settings of a model file on any file system Spark reads.

    The file is some hundred kilobytes whatever the corpus; it is read once by the driver.
    """
    name = spark._jvm.org.apache.hadoop.fs.Path(path if "://" in path else f"file://{path}")
    stream = name.getFileSystem(spark._jsc.hadoopConfiguration()).open(name)
    try:
        raw = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()
    return parse_model(raw)


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the members of one protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield tag >> 3, raw[at : at + size]
        at += size


def parse_model(raw: bytes) -> dict:
    """The parts of a model that encoding needs; raises for settings it does not cover."""
    pieces, scores, kinds, trainer, normal = [], [], [], {}, {}
    for number, value in _fields(raw):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece.get(1, b"").decode("utf-8"))
            scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
            kinds.append(piece.get(3, _NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normal = dict(_fields(value))
    kind = trainer.get(3, _UNIGRAM)
    if kind not in (_UNIGRAM, _BPE):
        raise ValueError("only unigram and BPE models are covered")
    if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1):
        raise ValueError("models that rewrite characters or trim blanks are not covered")
    return {
        "kind": kind,
        "pieces": pieces,
        "scores": scores,
        "kinds": kinds,
        "prefix": bool(normal.get(3, 1)),
        "bytes": bool(trainer.get(35, 0)),
    }


class _Numbers(dict):
    """Words numbered as they first come; ``new`` lists those that are not encoded yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class PieceCoder:
    """Encodes and decodes with one model; keeps what it learns about words and pairs."""

    def __init__(self, model: dict):
        self.kind, self.pieces, self.prefix = model["kind"], model["pieces"], model["prefix"]
        kinds = np.array(model["kinds"])
        self.unk = int(np.flatnonzero(kinds == _UNK)[0]) if (kinds == _UNK).any() else 0
        self.byte_ids = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if kinds[i] == _BYTE}
        self.use_bytes = model["bytes"] and len(self.byte_ids) == 256
        self.usable = {p: i for i, p in enumerate(self.pieces) if kinds[i] in (_NORMAL, _USER) and p}
        self.scores = np.array(model["scores"], dtype=float)
        normal = self.scores[kinds == _NORMAL]
        self.unknown_score = (normal.min() if len(normal) else 0.0) - _UNKNOWN_COST
        # Order of merges: larger scores first; pieces of one score share a place.
        _, place = np.unique(-self.scores, return_inverse=True)
        self.place = place.tolist()
        self.longest = max(map(len, self.usable), default=1)
        self.lengths = np.array([len(p) for p in self.pieces] + [1], dtype=np.int64)
        # A mark inside a piece, or a piece of unknown characters, rules out the cuts.
        self.cuts = not any(MARK in p.lstrip(MARK) for p in self.usable)
        known = self.usable
        if self.kind == _BPE:
            known = {p: i for p, i in self.usable.items() if self._merge(p) == [i]}
        self.regular = self.kind == _UNIGRAM or all(c in self.usable for p in known for c in p)
        keys = np.array([self._key(p) for p in known], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(list(known.values()), dtype=np.int64)[order]
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self._slot(self.keys, _FILTER_BITS)] = True
        self.memo_keys = np.full(1 << _MEMO_BITS, -1, dtype=np.int64)
        self.memo = np.zeros(1 << _MEMO_BITS, dtype=bool)
        self.forget()
        text = [" ⁇ " if i == self.unk else "" if kinds[i] == _CONTROL else p for i, p in enumerate(self.pieces)]
        for byte, i in self.byte_ids.items():
            text[i] = chr(byte) if byte < 128 else chr(0xDC00 + byte)
        self.text = [t.replace(MARK, " ") for t in text]

    def forget(self) -> None:
        """Empties the store of encoded words."""
        self.words = _Numbers()
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - bits)).astype(np.int64)

    @staticmethod
    def _key(piece: str) -> int:
        key = 0
        for char in piece:
            key = (key * int(_BASE) + ord(char) + 1) & 0xFFFFFFFFFFFFFFFF
        return key

    def _merge(self, text: str) -> list[int]:
        """Plain BPE of a short text: best pair first, of equals the leftmost. -1 is an unknown character."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                piece = self.usable.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.place[piece] < best[0]):
                    best = (self.place[piece], i)
            if best is None:
                return [self.usable.get(p, -1) for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def _stable(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether BPE of each two pieces set side by side gives those two again."""
        keys = left * len(self.pieces) + right
        slots = self._slot(keys, _MEMO_BITS)
        new = np.flatnonzero(self.memo_keys[slots] != keys)
        good = self.memo[slots]
        if len(new):
            fresh, back = np.unique(keys[new], return_inverse=True)
            found = np.empty(len(fresh), dtype=bool)
            for n, key in enumerate(fresh.tolist()):
                a, b = divmod(key, len(self.pieces))
                found[n] = self._merge(self.pieces[a] + self.pieces[b]) == [a, b]
            at = self._slot(fresh, _MEMO_BITS)
            self.memo_keys[at], self.memo[at] = fresh, found
            good[new] = found[back]
        return good

    def _advance(self, words: list[str]) -> list[np.ndarray]:
        """Viterbi over words of one length; per word its piece ids, -1 for unknown characters."""
        size, count, none = len(words[0]), len(words), len(self.pieces)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.reshape(count, size).astype(np.uint64) + np.uint64(1)
        ending = []  # by piece length: rows, starts and ids of all pieces found, by end
        hashes = codes
        for length in range(1, min(self.longest, size) + 1):
            if length > 1:
                hashes = hashes[:, :-1] * _BASE + codes[:, length - 1 :]
            maybe = self.filter[self._slot(hashes, _FILTER_BITS)]
            starts, rows = np.nonzero(maybe.T)
            probes = hashes[rows, starts]
            at = np.minimum(np.searchsorted(self.keys, probes), len(self.keys) - 1)
            real = self.keys[at] == probes
            starts, rows, ids = starts[real], rows[real], self.ids[at[real]]
            ending.append((np.searchsorted(starts, np.arange(size + 2)), rows, ids))
        back = np.full((count, size + 1), none, dtype=np.int64)
        value = np.full((count, size + 1), -np.inf)
        value[:, 0] = 0
        for end in range(1, size + 1):
            value[:, end] = value[:, end - 1] + self.unknown_score if self.kind == _UNIGRAM else -1.0
            for length in range(1, min(end, len(ending)) + 1):
                first, rows, ids = ending[length - 1]
                begin = end - length
                part = slice(first[begin], first[begin + 1])
                rows, ids = rows[part], ids[part]
                if not len(rows):
                    continue
                if self.kind == _UNIGRAM:
                    worth = value[rows, begin] + self.scores[ids]
                else:
                    before = back[rows, begin]
                    inside = (before != none) & (begin > 0)
                    stable = ~inside
                    stable[inside] = self._stable(before[inside], ids[inside])
                    worth = np.where(stable, 0.0, -np.inf)
                better = worth > value[rows, end]
                rows, ids = rows[better], ids[better]
                back[rows, end], value[rows, end] = ids, worth[better]
        at, rows, out = np.full(count, size), np.arange(count), []
        order = []
        while len(rows):
            ids = back[rows, at[rows]]
            out.append(np.where(ids == none, -1, ids))
            order.append(rows)
            at[rows] -= self.lengths[ids]
            rows = rows[at[rows] > 0]
        ids, owners = np.concatenate(out)[::-1], np.concatenate(order)[::-1]
        by_word = np.argsort(owners, kind="stable")
        return np.split(ids[by_word], np.cumsum(np.bincount(owners, minlength=count))[:-1])

    def _learn(self) -> None:
        """Encodes the new words and appends their ids to the store, in the order of their numbers."""
        words = [w.replace(" ", MARK) for w in self.words.new]
        found: list[np.ndarray] = [self.flat] * len(words)
        by_size: dict[int, list[int]] = {}
        for n, word in enumerate(words):
            if self.kind == _BPE and (not self.regular or word.startswith(MARK * 2)):
                found[n] = self._known(word, np.array(self._merge(word)))
            else:
                by_size.setdefault(len(word), []).append(n)
        for size, same in by_size.items():
            step = max(1, _CELLS // size)
            for at in range(0, len(same), step):
                part = same[at : at + step]
                for n, ids in zip(part, self._advance([words[n] for n in part]), strict=True):
                    found[n] = self._known(words[n], ids)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(ids) for ids in found])])
        self.flat = np.concatenate([self.flat, *found])
        self.words.new = []

    def _known(self, word: str, ids: np.ndarray) -> np.ndarray:
        if (ids < 0).any():
            ids = self._without_unknown(word, ids.tolist())
        return np.asarray(ids, dtype=np.int32)

    def _without_unknown(self, word: str, ids: list[int]) -> list[int]:
        out, at = [], 0
        for i in ids:
            if i >= 0:
                out.append(i)
                at += len(self.pieces[i])
                continue
            if self.use_bytes:
                out.extend(self.byte_ids[b] for b in word[at].encode("utf-8", "surrogatepass"))
            elif self.kind == _BPE or not out or out[-1] != self.unk:
                out.append(self.unk)
            at += 1
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Piece ids of each text; none for an empty text."""
        number, numbered = self.words.__getitem__, []
        for text in texts:
            # Blanks stand for marks until a word is encoded: most words then take a byte a character.
            spaced = ((" " if self.prefix and text else "") + text).replace(MARK, " ")
            words = _SPACED_WORD.findall(spaced) if self.cuts else [spaced] if spaced else []
            # Only numbers are kept of a text, its words once for all texts.
            numbered.append(np.fromiter(map(number, words), dtype=np.int32, count=len(words)))
        if self.words.new:
            self._learn()
        out = []
        for at in numbered:
            begins, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
            upto = np.cumsum(sizes)
            total = int(upto[-1]) if len(at) else 0
            out.append(self.flat[np.repeat(begins - upto + sizes, sizes) + np.arange(total)])
        if len(self.words) > _KEEP_WORDS:
            self.forget()
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids; bytes that are no valid UTF-8 become replacement characters."""
        text = "".join(map(self.text.__getitem__, ids.tolist()))
        text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _coder(model: dict) -> PieceCoder:
    """The coder of this Python worker, kept from task to task while the model is the same."""
    home = sys.modules.setdefault("_driftline_pieces", types.ModuleType("_driftline_pieces"))
    mark = (model["kind"], len(model["pieces"]), hash(tuple(model["pieces"])))
    if getattr(home, "mark", None) != mark:
        home.coder, home.mark = PieceCoder(model), mark
    return home.coder


_TEXTS = 2000


def encode_documents(
    docs: DataFrame, path: str = MODEL, with_decoded: bool = False, keep: list[str] | None = None
) -> DataFrame:
    """(doc_id, ids), then with ``with_decoded`` (decoded), then ``keep``, for every row of ``docs``.

    Whole texts are encoded; a null or empty text has no ids and decodes to the empty text.
    Blanks, line ends and repeated rows stay as they are. The word mark itself, U+2581,
    decodes to a blank, as the model defines. Columns not named in ``keep`` are not read.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_model(spark, path))

    def make():
        coder = _coder(sent.value)

        def run(texts: pa.Array) -> list[pa.Array]:
            ids = coder.encode([t or "" for t in texts.to_pylist()])
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            out = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))]
            if with_decoded:
                out.append(pa.array([coder.decode(i) for i in ids], pa.string()))
            return out

        return run

    added = "ids array<int>" + (", decoded string" if with_decoded else "")
    return extend(docs.select("doc_id", *(keep or []), "text"), "text", make, added, ("text",), _TEXTS)


def decode_ids(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows ``(doc_id, ids)``; null ids give the empty text."""
    spark = encoded.sparkSession
    sent = spark.sparkContext.broadcast(read_model(spark, path))

    def make():
        coder = _coder(sent.value)
        return lambda rows: [
            pa.array([coder.decode(np.array(ids or [], dtype=np.int64)) for ids in rows.to_pylist()], pa.string())
        ]

    return extend(encoded.select("doc_id", "ids"), "ids", make, "text string", ("ids",))
