"""Removal of repeated 100-byte strings with a logarithmic family of sampled suffix arrays.

A string of 100 bytes is found through its anchor: of the 32-byte runs inside it the one
with the smallest hash, the leftmost of equals. Equal strings have equal anchors, so sorted
arrays of anchored suffixes find every repeat although only about one position in 35 is
kept. New batches become sorted arrays of their own, are scanned against the existing
levels for long matches, and levels of equal size are merged, so there are only
logarithmically many.

Two passes do this inside key ranges that Spark deals out. The first finds anchors that
stand more than once in different texts, by 64-bit hashes alone. The second reads the
strings around those anchors in document order and marks each string that an earlier one
equals. Copies of a whole text are settled by its SHA-256 and take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from driftline.llm.common import parts_for
from driftline.shared import keyed_join, staged

LENGTH = 100
_GRAM = 32
_BYTES_PER_RANGE = 32 << 20
_CHUNK = 3 << 20
# The table of powers grows by so many places at once.
_POWERS = 1 << 20
# A text beyond this is cut into overlapping pieces; anchor places fit the low 24 bits.
_PIECE = 8 << 20
_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.Generator(np.random.PCG64(42)).integers(0, 1 << 64, 256, dtype=np.uint64)
_EMPTY = hashlib.sha256(b"").hexdigest()


def _order(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Places of the pairs by key, then owner, then place; owners are compared only where keys are equal."""
    order = np.argsort(keys)
    same = np.concatenate([[False], keys[order[1:]] == keys[order[:-1]], [False]])
    tied = np.flatnonzero(same[1:] | same[:-1])
    among = order[tied]
    order[tied] = among[np.lexsort((among, owners[among], keys[among]))]
    return order


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where, in sorted columns, a row differs from the one before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


class Levels:
    """Sorted runs whose sizes fall geometrically; a run that is not smaller merges into the one before."""

    def __init__(self):
        self.runs: list[np.ndarray] = []

    def add(self, run: np.ndarray) -> None:
        self.runs.append(run)
        while len(self.runs) > 1 and len(self.runs[-1]) * 2 > len(self.runs[-2]):
            last = self.runs.pop()
            self.runs[-1] = self.merged([self.runs[-1], last])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Which sorted ``keys`` any level has."""
        found = np.zeros(len(keys), dtype=bool)
        for run in self.runs:
            at = np.minimum(np.searchsorted(run, keys), len(run) - 1)
            found |= run[at] == keys
        return found

    def all(self) -> np.ndarray:
        return self.merged(self.runs) if self.runs else np.zeros(0)

    @staticmethod
    def merged(runs: list[np.ndarray]) -> np.ndarray:
        return np.unique(np.concatenate(runs))


class PairLevels(Levels):
    """Levels of (key, text) pairs, by key and then text."""

    @staticmethod
    def merged(runs: list[np.ndarray]) -> np.ndarray:
        # Sorted columns of plain numbers; numpy compares pairs one by one.
        pairs = np.concatenate(runs)
        order = _order(pairs["key"], pairs["text"])
        keys, texts = pairs["key"][order], pairs["text"][order]
        return _pairs(keys, texts)[_starts(keys, texts)]


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Hashes of all runs of a length in joined bytes, from sums over a growing table of powers."""

    def __init__(self):
        self.up, self.down = _powers(_BASE, 0), _powers(_INVERSE, 0)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data):
            size = -(-len(data) // _POWERS) * _POWERS
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_TABLE.take(data) * self.up[: len(data)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        return self._mix((sums[starts + length] - sums[starts]) * self.down[starts])

    def everywhere(self, sums: np.ndarray, length: int) -> np.ndarray:
        """``at`` of all starts."""
        each = sums[length:] - sums[:-length]
        each *= self.down[: len(each)]
        return self._mix(each)

    @staticmethod
    def _mix(mixed: np.ndarray) -> np.ndarray:
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(29))


def _anchors(hasher: Hasher, texts: list[bytes]):
    """(sums, owner, anchor hash, first, last) of the anchors in joined texts.

    first and last are the starts, in the joined bytes, of the strings that an anchor stands for.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sums = hasher.sums(data)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return sums, none, none.astype(np.uint64), none, none
    hashes = hasher.everywhere(sums, _GRAM)
    least = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    span = LENGTH - _GRAM + 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if span > reach:
        least = np.minimum(least[: -(span - reach)], least[span - reach :])
    step = np.zeros(len(data) + 1, dtype=np.int8)
    long = sizes >= LENGTH
    step[begins[long]] += 1
    step[begins[long] + sizes[long] - LENGTH + 1] -= 1
    starts = np.flatnonzero(np.cumsum(step[: len(least)], dtype=np.int8))
    places = (least[starts] & _PLACE).astype(np.int64)
    if not len(places):
        return sums, none, none.astype(np.uint64), none, none
    new = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    return sums, np.searchsorted(begins, first, "right") - 1, hashes[places[new]], first, last


def _chunks(texts: Iterator[tuple]) -> Iterator[tuple[list, list, list]]:
    """(rows, offsets, pieces): pieces of a few megabytes together, long texts in overlapping cuts."""
    rows, offsets, pieces, size = [], [], [], 0
    for row, text in texts:
        for at in range(0, max(len(text) - LENGTH + 1, 1), _PIECE):
            piece = text[at : at + _PIECE + LENGTH - 1]
            if size and size + len(piece) > max(_CHUNK, len(pieces[0])):
                yield rows, offsets, pieces
                rows, offsets, pieces, size = [], [], [], 0
            rows.append(row)
            offsets.append(at)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield rows, offsets, pieces


def _in_earlier_pieces(
    before: Levels, offsets: list[int], pieces: list[bytes], owner: np.ndarray, keys: np.ndarray
) -> np.ndarray:
    """Which anchors an earlier piece of the same cut text has; ``before`` carries them over its pieces."""
    found = np.zeros(len(keys), dtype=bool)
    for n, (at, piece) in enumerate(zip(offsets, pieces, strict=True)):
        if not at:
            before.runs.clear()
        if at or len(piece) > _PIECE:
            part = slice(*np.searchsorted(owner, [n, n + 1]))
            found[part] = before.holds(keys[part])
            if part.stop > part.start:
                before.add(np.unique(keys[part]))
    return found


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


_PAIR = np.dtype([("key", "<u8"), ("text", "<i8")])


def _pairs(keys: np.ndarray, texts: np.ndarray) -> np.ndarray:
    out = np.empty(len(keys), dtype=_PAIR)
    out["key"], out["text"] = keys, texts
    return out


def repeated_anchors(docs: DataFrame, parts: int) -> DataFrame:
    """(text_hash, anchors): of each text the anchors that another text, or another place in it, has too."""

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for rows in batches:
            texts = ((h, _utf8(t)) for h, t in zip(rows["text_hash"], rows["text"], strict=True))
            before = Levels()
            for hashes, offsets, pieces in _chunks(texts):
                _, owner, keys, _, _ = _anchors(hasher, pieces)
                texts_at = np.array(hashes, dtype=np.int64)[owner]
                recurring = _in_earlier_pieces(before, offsets, pieces, owner, keys)
                order = _order(keys, texts_at)
                keys, texts_at, recurring = keys[order], texts_at[order], recurring[order]
                new = _starts(keys, texts_at)
                again = np.diff(np.append(new, len(keys))) > 1
                again |= np.logical_or.reduceat(recurring, new) if len(new) else again
                keys, texts_at = keys[new], texts_at[new]
                # Few bits: numpy then sorts by counting.
                bucket = ((keys >> np.uint64(20)) % np.uint64(parts)).astype(np.min_scalar_type(parts))
                order = np.argsort(bucket, kind="stable")
                keys, texts_at, again, bucket = keys[order], texts_at[order], again[order], bucket[order]
                cuts = _starts(bucket)
                # The texts of a run are numbered, so that each hash travels once.
                out = []
                for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(keys)).tolist(), strict=False):
                    texts_of, at = np.unique(texts_at[a:b], return_inverse=True)
                    places = (at * 2 + again[a:b]).astype(np.int32)
                    out.append((int(bucket[a]), keys[a:b].tobytes(), places.tobytes(), texts_of.tobytes()))
                yield pd.DataFrame(out, columns=["bucket", "keys", "places", "texts"])

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        levels, doubled = PairLevels(), []
        for rows in batches:
            for keys, places, texts in zip(rows["keys"], rows["places"], rows["texts"], strict=True):
                place = np.frombuffer(places, np.int32)
                # Runs come sorted by key and text.
                run = _pairs(np.frombuffer(keys, np.uint64), np.frombuffer(texts, np.int64)[place >> 1])
                doubled.append(run["key"][(place & 1) == 1])
                levels.add(run)
        pairs = levels.all()
        if not len(pairs):
            return
        keys, texts = pairs["key"], pairs["text"]
        alike = np.concatenate([[False], keys[1:] == keys[:-1], [False]])
        hot = alike[1:] | alike[:-1] | np.isin(keys, np.concatenate(doubled))
        keys, texts = keys[hot], texts[hot]
        # By text; of one text the keys stay in order.
        order = np.argsort(texts, kind="stable")
        texts, raw = texts[order], keys[order].tobytes()
        new = _starts(texts)
        ends = np.append(new[1:], len(texts)) * 8
        anchors = [raw[a:b] for a, b in zip((new * 8).tolist(), ends.tolist(), strict=False)]
        yield pd.DataFrame({"text_hash": texts[new], "anchors": anchors})

    dealt = docs.select("text_hash", "text").mapInPandas(
        sample, "bucket long, keys binary, places binary, texts binary"
    )
    return dealt.repartitionById(parts, F.col("bucket").cast("int")).mapInPandas(meet, "text_hash long, anchors binary")


def _squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts as compressed bytes: they cross the network twice."""
    squeezer = zstandard.ZstdCompressor(level=3)
    for rows in batches:
        rows["squeezed"] = [squeezer.compress(_utf8(t)) for t in rows.pop("text")]
        yield rows


_STRINGS = "anchor long, place long, text_hash long, start long, bytes binary, local binary"


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes around each repeated anchor; repeats inside a text are settled here."""
    hasher, squeezed = Hasher(), zstandard.ZstdDecompressor()
    for rows in batches:
        texts = (
            ((d, h, np.unique(np.concatenate([np.frombuffer(a, np.uint64) for a in found]))), squeezed.decompress(t))
            for d, h, t, found in zip(rows["place"], rows["text_hash"], rows["squeezed"], rows["anchors"], strict=True)
        )
        for owners, offsets, pieces in _chunks(texts):
            sums, owner, keys, first, last = _anchors(hasher, pieces)
            bounds = np.searchsorted(owner, np.arange(len(pieces) + 1))
            hot = np.zeros(len(keys), dtype=bool)
            for n, (_, _, wanted) in enumerate(owners):
                part = slice(bounds[n], bounds[n + 1])
                at = np.minimum(np.searchsorted(wanted, keys[part]), len(wanted) - 1)
                hot[part] = wanted[at] == keys[part]
            owner, keys, first, last = owner[hot], keys[hot], first[hot], last[hot]
            counts = last - first + 1
            upto = np.cumsum(counts)
            starts = np.repeat(first - upto + counts, counts) + np.arange(upto[-1] if len(upto) else 0)
            hashes, whose = hasher.at(sums, starts, LENGTH), np.repeat(owner, counts)
            order = _order(hashes, whose)
            later = (hashes[order][1:] == hashes[order][:-1]) & (whose[order][1:] == whose[order][:-1])
            again = np.zeros(len(starts), dtype=bool)
            again[order[1:][later]] = True
            fresh = np.bincount(np.repeat(np.arange(len(counts)), counts)[~again], minlength=len(counts)) > 0
            begins = np.cumsum([0] + [len(p) for p in pieces])
            data = b"".join(pieces)
            out = []
            for n, key, a, b in zip(owner[fresh].tolist(), keys[fresh].view(np.int64).tolist(), first[fresh].tolist(), last[fresh].tolist(), strict=True):
                out.append((key, owners[n][0], owners[n][1], offsets[n] + a - int(begins[n]), data[a : b + LENGTH], None))
            repeats = np.flatnonzero(again)
            cuts = _starts(whose[repeats])
            for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(repeats)).tolist(), strict=False):
                n = int(whose[repeats[a]])
                spans = _runs(starts[repeats[a:b]] - begins[n] + offsets[n])
                out.append((owners[n][1], owners[n][0], owners[n][1], 0, None, spans.tobytes()))
            yield pd.DataFrame(out, columns=["anchor", "place", "text_hash", "start", "bytes", "local"])


def _runs(starts: np.ndarray) -> np.ndarray:
    """(begin, end) of the bytes that strings at sorted ``starts`` cover, neighbours joined."""
    new = np.flatnonzero(np.concatenate([[True], np.diff(starts) > 1])) if len(starts) else starts
    ends = starts[np.append(new[1:], len(starts)) - 1] + LENGTH if len(starts) else starts
    return np.stack([starts[new], ends], axis=1).astype(np.int64) if len(starts) else np.zeros((0, 2), np.int64)


def _earlier(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(text_hash, spans) of the strings that an earlier one equals; rows come in document order."""
    hasher, levels = Hasher(), Levels()
    for rows in batches:
        settled = rows["bytes"].isna()
        if settled.any():
            yield rows.loc[settled, ["text_hash", "local"]].rename(columns={"local": "spans"})
        rows = rows[~settled]
        if not len(rows):
            continue
        pieces = list(rows["bytes"])
        sizes = np.array([len(p) for p in pieces])
        counts = sizes - LENGTH + 1
        upto = np.cumsum(counts)
        of = np.repeat(np.arange(len(pieces)), counts)
        inside = np.arange(upto[-1]) - np.repeat(upto - counts, counts)
        sums = hasher.sums(np.frombuffer(b"".join(pieces), np.uint8))
        hashes = hasher.at(sums, np.repeat(np.cumsum(sizes) - sizes, counts) + inside, LENGTH)
        order = np.argsort(hashes)
        new = _starts(hashes[order])
        run, first = hashes[order[new]], np.minimum.reduceat(order, new)
        known = levels.holds(run)
        # Only the first of equals that no level has is no repeat.
        repeat = np.ones(len(hashes), dtype=bool)
        repeat[first[~known]] = False
        levels.add(run[~known]) if (~known).any() else None
        begins = rows["start"].to_numpy(np.int64)
        # Runs end with their string's row; strings of one row follow each other.
        at = np.flatnonzero(repeat)
        if not len(at):
            continue
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(of[at]) > 0)) + 1
        head, tail = at[np.concatenate([[0], cut])], at[np.append(cut, len(at)) - 1]
        spans = np.stack([begins[of[head]] + inside[head], begins[of[tail]] + inside[tail] + LENGTH], axis=1)
        yield pd.DataFrame(
            {"text_hash": rows["text_hash"].to_numpy()[of[head]], "spans": [s.tobytes() for s in spans]}
        )


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    squeezed = zstandard.ZstdDecompressor()
    for rows in batches:
        out = []
        for place, text_hash, text, packed in zip(rows["place"], rows["text_hash"], rows["squeezed"], rows["spans"], strict=True):
            data, kept, at, removed, count = squeezed.decompress(text), [], 0, 0, 0
            spans = np.concatenate([np.frombuffer(s, np.int64).reshape(-1, 2) for s in packed])
            spans = spans[np.argsort(spans[:, 0], kind="stable")]
            reach = np.maximum.accumulate(spans[:, 1])
            new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
            ends = reach[np.append(new[1:], len(reach)) - 1]
            for a, b in zip(spans[new, 0].tolist(), ends.tolist(), strict=True):
                kept.append(data[at:a])
                at, removed, count = b, removed + b - a, count + 1
            kept.append(data[at:])
            rest = b"".join(kept)
            out.append((place, text_hash, removed, count, hashlib.sha256(rest).hexdigest(), rest))
        yield pd.DataFrame(out, columns=["place", "text_hash", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs(doc_id, text)``.

    Texts are UTF-8 bytes, null counts as empty. A byte goes when a 100-byte string over it
    also starts earlier: in a row with a smaller doc_id, or earlier in the same text. Null
    ids come after all others; of two texts under one id the one with the smaller hash
    comes first; rows that agree in id and text are one document and have one result each.
    Strings are judged on the input, and never reach across documents. ``with_kept`` adds
    ``kept``, the remaining bytes. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    # The place of a document: its id, or the last of all places without one. Never null.
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    named = docs.select("doc_id", place.alias("place"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    size, sha = F.octet_length("text").cast("long"), F.sha2("text", 256)
    base = staged(named.select("doc_id", "place", "text_hash", size.alias("n_bytes"), sha.alias("sha")), "texts")
    total = base.agg(F.sum("n_bytes")).first()[0] or 0
    parts = parts_for(spark, total, _BYTES_PER_RANGE)
    first = base.groupBy("sha").agg(F.min("place").alias("first"), F.min("text_hash").alias("text_hash"))
    first = staged(first, "first")

    anchors = staged(repeated_anchors(named, parts), "anchors")
    found = anchors.groupBy("text_hash").agg(F.collect_list("anchors").alias("anchors"))
    wanted = found.join(first.select(F.col("first").alias("place"), "text_hash"), "text_hash")
    small = named.select("place", "text_hash", "text").mapInPandas(
        _squeeze, "place long, text_hash long, squeezed binary"
    )
    texts = small.join(wanted, ["text_hash", "place"]).dropDuplicates(["text_hash", "place"])
    texts = staged(texts.select("place", "text_hash", "squeezed", "anchors"), "candidates")

    strings = texts.mapInPandas(_strings, _STRINGS).repartition(parts, "anchor")
    strings = strings.sortWithinPartitions("place", "text_hash", "start")
    spans = staged(strings.mapInPandas(_earlier, "text_hash long, spans binary"), "spans")
    spans = spans.groupBy("text_hash").agg(F.collect_list("spans").alias("spans"))
    shape = "place long, text_hash long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    cut = texts.select("place", "text_hash", "squeezed").join(spans, "text_hash").mapInPandas(_remove, shape)
    cut = staged(cut if with_kept else cut.drop("kept"), "cut")

    marked = keyed_join(base, first.drop("text_hash"), ["sha"], "inner")
    joined = marked.join(cut, ["text_hash", "place"], "left")
    copy = (F.col("place") != F.col("first")) & (F.col("n_bytes") >= LENGTH)

    def column(name: str, of_copy: Column, of_whole: Column) -> Column:
        return F.when(copy, of_copy).otherwise(F.coalesce(F.col(name), of_whole)).alias(name)

    columns = [
        "doc_id",
        "n_bytes",
        column("n_removed", F.col("n_bytes"), F.lit(0).cast("long")),
        column("n_spans", F.lit(1).cast("long"), F.lit(0).cast("long")),
        column("kept_sha256", F.lit(_EMPTY), F.col("sha")),
    ]
    if with_kept:
        whole = named.select("place", "text_hash", F.encode("text", "UTF-8").alias("whole")).distinct()
        joined = joined.join(whole, ["text_hash", "place"])
        columns.append(column("kept", F.lit(b""), F.col("whole")))
    return joined.select(*columns)
