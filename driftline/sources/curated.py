"""Curated tables: bucketed parquet versions behind a pointer that moves last.

A version holds only the buckets it rewrote. The pointer row lists, for every
bucket, the version to read it from, so a small delta rewrites only the buckets
its keys fall into, readers never see a half-written state, and a failed run
leaves the previous pointer in force.

Buckets grow by linear hashing: when they exceed their size on average, the next ones in
turn are split by one more bit of the key hash, and no other bucket moves. Where rows
carry a fingerprint, the pointer keeps a digest of each bucket that does not depend on the
order of its rows, so a snapshot is compared bucket by bucket without reading the table.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from driftline.shared import claim_text, empty_for, file_exists, replace_text, scan_bytes, stored_bytes

BUCKET = "_bucket"
# Input bytes per shuffled partition; landed lines are compressed about tenfold.
_PARTITION_BYTES = 16 * 1024 * 1024
# A pointer file is filled as soon as it is claimed; one still empty by then has lost its writer.
_ABANDONED_SECONDS = 600
_POINTER_DDL = (
    "version bigint, run_id string, hash_tag string, keys array<string>, schema string, "
    "row_count bigint, bucket_versions array<bigint>, bucket_folders array<string>, bucket_rows array<bigint>, "
    "bucket_bytes array<bigint>, bucket_digests array<string>, "
    "graves array<string>, grave_marks array<bigint>"
)
#: Bytes of a bucket on average beyond which buckets are split, and the share of them that one write splits at most.
BUCKET_BYTES = 256 * 1024 * 1024
_SPLIT_SHARE = 4
_NO_ROWS = "0:0:0:0:0"
_LOW = 0xFFFFFFFF


@dataclass(frozen=True)
class Pointer:
    version: int
    run_id: str
    hash_tag: str
    keys: tuple[str, ...]
    schema: str
    row_count: int
    bucket_versions: tuple[int, ...]
    bucket_folders: tuple[str, ...]
    bucket_rows: tuple[int, ...]
    bucket_bytes: tuple[int, ...] = ()
    bucket_digests: tuple[str, ...] = ()
    #: Folders that tell the positions of deleted keys, and the newest position's major part in each.
    graves: tuple[str, ...] = ()
    grave_marks: tuple[int, ...] = ()


def _round(buckets: int) -> int:
    """The smallest power of two that is not under ``buckets``."""
    return 1 << (buckets - 1).bit_length()


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Bucket of a key among any number of them: hash bits of the round, one less where that bucket is not split off yet."""
    hashed, most = F.hash(*[F.col(f"`{k}`") for k in keys]), _round(buckets)
    wide = F.pmod(hashed, F.lit(most))
    if most == buckets:
        return wide
    return F.when(wide < buckets, wide).otherwise(F.pmod(hashed, F.lit(most // 2)))


def split_source(bucket: int) -> int:
    """The bucket that this one was split off."""
    return bucket - (1 << (bucket.bit_length() - 1))


def grown_buckets(pointer: Pointer) -> int:
    """How many buckets the next write should leave, from the sizes of those there are."""
    now = len(pointer.bucket_versions)
    wanted = math.ceil(sum(pointer.bucket_bytes or ()) / BUCKET_BYTES)
    return max(now, min(wanted, now + math.ceil(now / _SPLIT_SHARE)))


def with_splits(rewritten: set[int], before: int, after: int) -> tuple[list[int], list[int]]:
    """Buckets to write under the layout ``after``, and those of ``before`` that hold their rows."""
    fresh = set(range(before, after))
    written = rewritten | fresh | {split_source(b) for b in fresh}
    return sorted(written), sorted({b if b < before else split_source(b) for b in written})


def digest_sums(keys: list[str], fingerprint: str) -> list[Column]:
    """Aggregates of an order-free digest: sums of the halves of two 64-bit hashes of key and fingerprint."""
    out = []
    for seed in (1, 2):
        mixed = F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys], F.col(fingerprint))
        out += [F.sum(mixed.bitwiseAND(F.lit(_LOW))), F.sum(F.shiftrightunsigned(mixed, 32))]
    return out


def bucket_digests(df: DataFrame, keys: list[str], fingerprint: str, buckets: int) -> list[str]:
    """Digest of every bucket of a frame with a fingerprint column; at most ``buckets`` small rows reach the driver."""
    sums = [c.alias(f"d{i}") for i, c in enumerate(digest_sums(keys, fingerprint))]
    rows = df.groupBy(bucket_of(keys, buckets).alias("b")).agg(F.count("*").alias("n"), *sums).collect()
    return _digests({r["b"]: r for r in rows}, buckets)


def _digests(rows: dict, buckets: int) -> list[str]:
    return [":".join(str(rows[b][c]) for c in ("n", "d0", "d1", "d2", "d3")) if b in rows else _NO_ROWS for b in range(buckets)]


def aligned(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Shuffles by key into a multiple of the bucket count, rounded up to a power of two.

    Spark places a row by the same hash that names its bucket, so every task then
    holds rows of one bucket only, and a join on the keys keeps it that way.
    """
    buckets = _round(buckets)
    size = scan_bytes(df)
    # The planner's mark for a frame of unknown size is the largest number there is.
    unknown = size >= 1 << 62
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = shuffle if unknown else math.ceil(size / _PARTITION_BYTES)
    return df.repartition(buckets * max(1, math.ceil(wanted / buckets)), *keys)


def read_pointer(spark: SparkSession, root: str) -> Pointer | None:
    """The pointer in force, or None before the first write.

    A small file names a version at or just below the newest; from there the next ones
    are tried, so the pointers ever written need not be listed.
    """
    hint = f"{root}/pointer/_newest"
    told = spark.read.text(hint).first() if file_exists(spark, hint) else None
    newest = int(told[0]) if told and told[0].isdigit() else 0
    while file_exists(spark, f"{root}/pointer/v{newest + 1}.json"):
        newest += 1
    while newest:
        row = spark.read.schema(_POINTER_DDL).json(f"{root}/pointer/v{newest}.json").first()
        if row is not None and row["version"] is not None:
            told_of = {k: tuple(v) if isinstance(v, list) else v for k, v in row.asDict().items() if v is not None}
            return Pointer(**told_of)
        # Its writer stopped between claiming the version and filling the file.
        newest -= 1
    return None


def read_curated(
    spark: SparkSession, root: str, pointer: Pointer | None = None, buckets: list[int] | None = None
) -> DataFrame | None:
    """The curated state the pointer names, or only the given buckets of it."""
    pointer = pointer or read_pointer(spark, root)
    if pointer is None:
        return None
    wanted = range(len(pointer.bucket_versions)) if buckets is None else sorted(buckets)
    paths = [
        f"{root}/data/{pointer.bucket_folders[b]}/{BUCKET}={b}"
        for b in wanted
        if pointer.bucket_rows[b] > 0
    ]
    if not paths:
        return spark.createDataFrame([], pointer.schema)
    return spark.read.schema(pointer.schema).parquet(*paths)


def touched_buckets(delta: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """Buckets a delta falls into; at most ``buckets`` small rows reach the driver."""
    rows = delta.select(bucket_of(keys, buckets).alias("b")).distinct().collect()
    return sorted(r["b"] for r in rows)


def _free_version(spark: SparkSession, root: str, version: int) -> int:
    """``version``, or the next one where a writer claimed it long ago and never filled it."""
    while (age := empty_for(spark, f"{root}/pointer/v{version}.json")) is not None and age > _ABANDONED_SECONDS:
        version += 1
    return version


def write_curated(
    df: DataFrame,
    root: str,
    keys: list[str],
    run_id: str,
    buckets: int = 16,
    hash_tag: str = "",
    previous: Pointer | None = None,
    only: list[int] | None = None,
    expected_rows: int | None = None,
    in_place: bool = False,
    grown: int | None = None,
    fingerprint: str | None = None,
    graves: dict[str, int] | None = None,
) -> Pointer:
    """Write a version and move the pointer to it.

    ``grown`` is the number of buckets under which ``only`` was planned, where some are
    split. ``fingerprint`` names the column that bucket digests are made from. ``graves``
    maps the folders of deleted keys to their marks; left out, those before stay.

    With ``only`` the frame holds the new content of just those buckets and all
    others stay where ``previous`` points. ``expected_rows`` is checked against
    the files written before the pointer moves. ``in_place`` tells that each task
    already holds rows of few buckets, so that nothing is shuffled for the write.
    """
    spark = df.sparkSession
    if previous is not None:
        buckets = grown or len(previous.bucket_versions)
    elif only is not None:
        raise ValueError("a first version must hold every bucket")
    version = _free_version(spark, root, previous.version + 1 if previous else 1)
    # Every writer has a folder of its own; only the claimed pointer makes one current.
    folder = f"version={version}-{uuid.uuid4().hex}"
    target = f"{root}/data/{folder}"
    schema = _ddl(df)
    placed = df if in_place else aligned(df, keys, buckets)
    bucketed = placed.withColumn(BUCKET, bucket_of(keys, buckets))
    bucketed.write.partitionBy(BUCKET).parquet(target)

    written = spark.read.schema(f"{schema}, {BUCKET} int").parquet(target)
    sums = [c.alias(f"d{i}") for i, c in enumerate(digest_sums(keys, fingerprint))] if fingerprint else []
    found = {r[BUCKET]: r for r in written.groupBy(BUCKET).agg(F.count("*").alias("n"), *sums).collect()}
    counted = {b: r["n"] for b, r in found.items()}
    total = sum(counted.values())
    if expected_rows is not None and total != expected_rows:
        raise ValueError(f"version {version} holds {total} rows, expected {expected_rows}")

    rewritten = set(range(buckets)) if only is None else set(only)
    stray = set(counted) - rewritten
    if stray:
        raise ValueError(f"rows fell outside the buckets to rewrite: {sorted(stray)}")
    # Bytes are shared out by rows: one listing for a version, not one for each bucket.
    a_row = (stored_bytes(spark, target) or 0) / max(total, 1)
    digests = _digests(found, buckets) if fingerprint else [""] * buckets
    fresh = {
        "versions": [version] * buckets,
        "folders": [folder] * buckets,
        "rows": [counted.get(b, 0) for b in range(buckets)],
        "bytes": [round(counted.get(b, 0) * a_row) for b in range(buckets)],
        "digests": digests,
    }
    kept = {n: getattr(previous, f"bucket_{n}") or (("" if n == "digests" else 0),) * buckets for n in fresh} if previous else fresh
    lists = {n: tuple(fresh[n][b] if b in rewritten else kept[n][b] for b in range(buckets)) for n in fresh}
    if graves is None:
        graves = dict(zip(previous.graves, previous.grave_marks, strict=True)) if previous else {}
    pointer = Pointer(
        version, run_id, hash_tag, tuple(keys), schema, sum(lists["rows"]),
        *(lists[n] for n in ("versions", "folders", "rows", "bytes", "digests")), tuple(graves), tuple(graves.values()),
    )
    # A second writer of the same version fails here, and its files are never read.
    claim_text(spark, f"{root}/pointer/v{version}.json", json.dumps(asdict(pointer)))
    replace_text(spark, f"{root}/pointer/_newest", str(version))
    return pointer


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
