"""Benchmark decontamination: SimHash windows of item size, multi-index Hamming blocks, exact check.

Only shingles that items of a window's own size hold count in a fingerprint, so foreign
words turn no bits, however long they are. A shingle weighs as much as it has letters and
pulls each bit by the root of that: the cosine of an item and a window that holds a share s
of its weight, and nothing else of the benchmark, is the root of s. At s = 0.8 about 9.4 of
64 bits differ; the radius of 23 lies 4.8 standard deviations above. Eight blocks of 8 bits
find every pair within the radius, since one block differs in two bits at most.
Candidates are verified by exact weighted shingle similarity.
Column expressions only. The texts are read once; all that follows works on the shingles
that the benchmark holds too. Indexes over the items are broadcast while they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftline.llm.common import ascii_lower, packed, words_of
from driftline.shared import keyed_join, staged

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
RADIUS = 23
_BITS = 64
_BLOCK_BITS = 8
# Words of a text that meet the windows over them in one group.
_REACH = 64


def _hashes(words: Column, size: Column) -> Column:
    """Hash of every run of ``size`` words, in order."""
    runs = F.size(words) - size + 1
    return F.when(
        runs > 0, F.transform(F.sequence(F.lit(1), runs), lambda i: F.xxhash64(F.slice(words, i, size)))
    ).otherwise(F.array().cast("array<bigint>"))


def _weighted(words: Column, size: Column) -> Column:
    """Distinct shingles as (h, w); a shingle weighs as much as it has letters."""
    runs = F.size(words) - size + 1
    each = F.transform(
        F.sequence(F.lit(1), runs),
        lambda i: F.struct(
            F.xxhash64(F.slice(words, i, size)).alias("h"),
            F.length(F.array_join(F.slice(words, i, size), "")).cast("long").alias("w"),
        ),
    )
    return F.when(runs > 0, F.array_distinct(each)).otherwise(F.array().cast("array<struct<h:bigint,w:bigint>>"))


# Per bit, the pulls of shingles that have it stand against those that lack it; whole numbers
# add up alike in any order.
_SIMHASH = f"""
aggregate(sequence(0, {_BITS - 1}), 0L, (f, b) -> f | shiftleft(if(aggregate(shingles, 0L, (s, x) -> s + if(
  (shiftrightunsigned(x.h, b) & 1L) = 1L, 1L, -1L) * cast(round(sqrt(x.w) * 1024) AS bigint)) > 0L, 1L, 0L), b))
"""


def _total(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda s, x: s + x["w"])


def benchmark_items(benchmark: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(item, item_id, n_words, size, words, shingles, weight, fp), written and read back.

    Items with fewer words than a shingle are one shingle; items without words are left out.
    """
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    items = items.select("item_id", words_of(ascii_lower(F.col("text"))).alias("words")).where("size(words) > 0")
    items = items.withColumn("n_words", F.size("words")).withColumn("size", F.least("n_words", F.lit(shingle_words)))
    items = items.withColumn("shingles", _weighted(F.col("words"), F.col("size")))
    items = items.withColumn("weight", _total(F.col("shingles"))).withColumn("fp", F.expr(_SIMHASH))
    items = items.withColumn("item", F.xxhash64("item_id", "words")).dropDuplicates(["item"])
    return staged(items, "items")


def _blocks(fp: Column) -> Column:
    """The blocks of a fingerprint as (block, value)."""
    numbers = F.sequence(F.lit(0), F.lit(_BITS // _BLOCK_BITS - 1))
    last = F.lit((1 << _BLOCK_BITS) - 1).cast("long")
    return F.transform(
        numbers,
        lambda b: F.struct(
            b.alias("block"),
            F.call_function("shiftrightunsigned", fp, b * _BLOCK_BITS).bitwiseAND(last).alias("value"),
        ),
    )


def _block_radius(radius: int) -> int:
    """Bits in which the nearest block of two fingerprints within ``radius`` can differ."""
    return radius // (_BITS // _BLOCK_BITS)


def fingerprint_index(items: DataFrame, radius: int) -> DataFrame:
    """(n_words, block, value, entries): each item under every value its blocks may have in a match."""
    turns = [m for m in range(1 << _BLOCK_BITS) if m.bit_count() <= _block_radius(radius)]
    each = items.select("item", "fp", "n_words", F.explode(_blocks(F.col("fp"))).alias("b"))
    each = each.select("item", "fp", "n_words", "b.block", "b.value", F.explode(F.array(*map(F.lit, turns))).alias("turn"))
    each = each.withColumn("value", F.col("value").bitwiseXOR(F.col("turn").cast("long")))
    entry = F.struct("item", F.col("fp").alias("item_fp")).alias("entry")
    grouped = each.select("n_words", "block", "value", entry).groupBy("n_words", "block", "value")
    return staged(grouped.agg(F.collect_list("entry").alias("entries")), "blocks")


def near_items(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """``windows`` beside (item, differing_bits) of all items of their size within ``radius``, each once."""
    probe = windows.withColumn("b", F.explode(_blocks(F.col("fp")))).select("*", "b.block", "b.value").drop("b")
    met = keyed_join(probe, fingerprint_index(items, radius), ["n_words", "block", "value"], "inner")
    met = met.withColumn("entry", F.explode("entries")).select("*", "entry.item", "entry.item_fp")
    differing = F.col("fp").bitwiseXOR(F.col("item_fp"))
    met = met.withColumn("differing_bits", F.bit_count(differing)).where(F.col("differing_bits") <= radius)
    # A pair may meet in several blocks; the first of them speaks for it.
    close = F.transform(_blocks(differing), lambda b: F.bit_count(b["value"]) <= _block_radius(radius))
    met = met.where(F.array_position(close, F.lit(True)) == F.col("block") + 1)
    return met.drop("block", "value", "entry", "entries", "item_fp")


def _row_key(docs: DataFrame) -> Column:
    return F.concat_ws(":", F.coalesce(docs["doc_id"].cast("string"), F.lit("~")), F.xxhash64(docs["text"]))


def laid_windows(
    docs: DataFrame, items: DataFrame, shingle_words: int, min_similarity: float
) -> DataFrame:
    """(row_key, doc_id, n_words, begin, shingles, fp): windows that may be similar to an item of their size.

    A window begins where one of its shingles lines up with an item, and must hold shingles
    of items of its size that together weigh enough for the lightest of these.
    """
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    lightest = items.groupBy("n_words").agg(F.min("weight").alias("lightest"))
    places = items.join(lightest, "n_words").select(
        "n_words", "lightest", "shingles", F.posexplode(_hashes(F.col("words"), F.col("size"))).alias("q", "h")
    )
    own = F.get(F.filter("shingles", lambda x: x["h"] == F.col("h")), F.lit(0))["w"]
    places = places.select("h", F.struct("n_words", "lightest", "q", own.alias("w")).alias("place"))
    postings = staged(places.groupBy("h").agg(F.collect_set("place").alias("places")), "postings")

    words = words_of(ascii_lower(F.coalesce("text", F.lit(""))))
    named = docs.select(_row_key(docs).alias("row_key"), "doc_id", words.alias("words"))
    hashed = [_hashes(F.col("words"), F.lit(size)) for size in sizes] or [F.array().cast("array<bigint>")]
    hashes = F.flatten(F.array(*[F.transform(h, lambda x, p: F.struct(p.alias("p"), x.alias("h"))) for h in hashed]))
    ran = named.select("row_key", "doc_id", F.size("words").alias("n"), F.explode(hashes).alias("run"))
    ran = ran.select("row_key", "doc_id", "n", "run.p", "run.h")
    hits = keyed_join(ran, postings, ["h"], "inner").withColumn("place", F.explode("places"))
    # A window begins where the hit lines up with its item, and stays inside the document.
    begin = F.greatest(F.lit(0), F.least(F.col("p") - F.col("place.q"), F.col("n") - F.col("place.n_words")))
    rows = hits.groupBy("row_key", "place.n_words", "place.lightest").agg(
        F.first("doc_id").alias("doc_id"),
        F.collect_set(F.struct("h", "place.w")).alias("held"),
        F.collect_set(F.struct("p", "h", "place.w")).alias("hits"),
        F.collect_set(begin).alias("begins"),
    )
    enough = min_similarity * F.col("lightest")
    rows = staged(rows.where(_total(F.col("held")) >= enough).drop("held"), "laid")

    held = rows.select("row_key", "n_words", F.explode("hits").alias("hit")).withColumn(
        "reach", F.floor(F.col("hit.p") / _REACH)
    )
    begun = rows.select("row_key", "doc_id", "n_words", "lightest", F.explode("begins").alias("begin"))
    over = F.sequence(F.floor(F.col("begin") / _REACH), F.floor((F.col("begin") + F.col("n_words") - 1) / _REACH))
    met = begun.withColumn("reach", F.explode(over)).join(held, ["row_key", "n_words", "reach"])
    last = F.col("begin") + F.col("n_words") - F.least("n_words", F.lit(shingle_words))
    met = met.where(F.col("hit.p").between(F.col("begin"), last))
    windows = met.groupBy("row_key", "n_words", "begin", "lightest").agg(
        F.first("doc_id").alias("doc_id"), F.collect_set(F.struct("hit.h", "hit.w")).alias("shingles")
    )
    windows = windows.where(_total(F.col("shingles")) >= enough).drop("lightest")
    return staged(windows.withColumn("fp", F.expr(_SIMHASH)), "windows")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    min_similarity: float = MIN_SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """(row_key, doc_id, item_id, start_word, differing_bits, similarity) of every leaked item.

    differing_bits is the distance of the fingerprints of item and window, at most ``radius``.
    similarity is the share of the item's shingle weight that the best window of the
    document holds; among equal windows the first counts. Whole texts are read. A null
    text has no words and leaks nothing. Rows that agree in id and text give one result
    per item, as do repeated items; an empty table on either side gives no rows. Documents
    with a null id are reported under it. Other columns are not read.
    """
    items = benchmark_items(benchmark, shingle_words)
    windows = laid_windows(docs, items, shingle_words, min_similarity)
    known = items.select("item", "item_id", F.col("shingles").alias("wanted"), "weight")
    pairs = keyed_join(near_items(windows, items, radius), staged(known, "known"), ["item"], "inner")
    there = F.transform("shingles", lambda x: x["h"])
    shared = _total(F.filter("wanted", lambda x: F.array_contains(there, x["h"])))
    pairs = pairs.withColumn("similarity", shared / F.col("weight")).where(F.col("similarity") >= min_similarity)
    best = F.max_by(F.struct("doc_id", "begin", "differing_bits", "similarity"), F.struct("similarity", -F.col("begin")))
    return (
        pairs.groupBy("row_key", "item", "item_id")
        .agg(best.alias("best"))
        .select(
            "row_key",
            "best.doc_id",
            "item_id",
            F.col("best.begin").cast("long").alias("start_word"),
            F.col("best.differing_bits").cast("long").alias("differing_bits"),
            "best.similarity",
        )
    )


def remove_leaking(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no item of the benchmark stands."""
    leaking = staged(find_leaks(docs, benchmark, **options).select("row_key").distinct(), "leaking")
    rows = packed(docs, row_key=_row_key(docs))
    return keyed_join(rows, leaking, ["row_key"], "left_anti").select("row.*")
