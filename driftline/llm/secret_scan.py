"""Secret scan with corpus-wide ownership counts.

Patterns find candidate spans. Each candidate's value is hashed, and over the whole corpus
the distinct repositories and owners of every hash are counted: a value that several owners
publish is a widely copied example, one that stays with few owners looks live. All of it is
column expressions; only spans and counts are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftline.llm.common import packed
from driftline.shared import keyed_join, staged

#: A value that at least so many owners publish is an example.
EXAMPLE_OWNERS = 3
REDACTED = "<secret>"

_NAMES = "password|passwd|secret|token|api_?key"
_EITHER = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _NAMES)
_ASSIGN = rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

# Base kinds in their fixed order: pattern, group that holds the value, smallest value
# length, and a quick sign that a text has any. Runs shorter than their smallest length are
# not matched at all, which drops the same runs as matching them and measuring them does.
BASE_KINDS = {
    "assign": (_ASSIGN, 2, 6, _ASSIGN),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20, r"AKIA[A-Z0-9]{16}"),
    "hex": (r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
}
# The method's own kind: a long run with digits and letters of both cases, kept when live.
_RUN = "[A-Za-z0-9+/_=-]"
_MIXED = rf"{_RUN}{{20,}}"
_MIXED_PARTS = (r"[0-9]", r"[a-z]", r"[A-Z]")
_MIXED_SIGN = f"(?<!{_RUN})" + "".join(f"(?={_RUN}*{part})" for part in _MIXED_PARTS) + f"{_RUN}{{20}}"
KINDS = [*BASE_KINDS, "mixed"]

_SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Spans of all matches in order: what lies between matches gives their places."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # Side by side, so that neither is made anew for every match; the last gap has no hit.
    steps = F.zip_with(hits, gaps, lambda h, g: F.struct(F.length(g).alias("gap"), h.alias("hit")))
    steps = F.filter(steps, lambda step: step["hit"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def add(seen: Column, step: Column) -> Column:
        begin = seen["at"] + step["gap"]
        stop = begin + F.length(step["hit"])
        value = F.regexp_extract(step["hit"], pattern, group) if group else step["hit"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), value.alias("value"))
        return F.struct(stop.alias("at"), F.concat(seen["out"], F.array(span)).alias("out"))

    found = F.aggregate(steps, start, add, lambda seen: seen["out"])
    return F.filter(found, lambda s: F.length(s["value"]) >= least)


def _found(text: Column, kind: int, pattern: str, group: int, least: int, sign: str) -> Column:
    nothing = F.array().cast(_SPAN)
    return F.when(text.rlike(sign), _spans(text, kind, pattern, group, least)).otherwise(nothing)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, owner, repo, base, mixed): the candidate spans of every row.

    ``base`` and ``mixed`` are sorted arrays of (start, kind, stop, value), in code points,
    stop exclusive; ``mixed`` spans touch no base span.
    """
    text = F.coalesce("text", F.lit(""))
    base = F.concat(*[_found(text, k, *rule) for k, rule in enumerate(BASE_KINDS.values())])
    runs = _found(text, len(BASE_KINDS), _MIXED, 0, 20, _MIXED_SIGN)
    marked = docs.select("doc_id", "text", "owner", "repo", F.array_sort(base).alias("base"), runs.alias("runs"))

    def own(span: Column) -> Column:
        telling = F.lit(True)
        for part in _MIXED_PARTS:
            telling = telling & span["value"].rlike(part)
        return telling & ~F.exists("base", lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))

    mixed = F.filter("runs", own)
    return marked.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "owner", "repo", "base", mixed.alias("mixed")
    )


def find_secrets(
    docs: DataFrame, owner: str = "source", repo: str = "doc_id", example_owners: int = EXAMPLE_OWNERS
) -> DataFrame:
    """(doc_id, text_hash, base, spans) for every row of ``docs(doc_id, text, owner, repo)``.

    ``owner`` and ``repo`` name the columns that say who published a row and where. ``base``
    has the spans of the base kinds, ``spans`` all that stay, each with ``owners`` and
    ``repos``, the corpus-wide distinct counts of its value, and ``live``. Base spans stay
    whether live or example; a ``mixed`` span stays when live. Null texts count as empty,
    null owners and repositories as none. Repeated rows stay and count their owner once.
    Other columns are not read.
    """
    named = docs.select(
        "doc_id", "text", F.col(owner).alias("owner"), F.col(repo).alias("repo")
    )
    scanned = staged(scan(named), "secrets")
    each = scanned.where("size(base) + size(mixed) > 0").select(
        "doc_id", "text_hash", "owner", "repo", F.explode(F.concat("base", "mixed")).alias("span")
    )
    each = each.withColumn("value", F.md5(F.col("span.value").cast("binary")))
    counts = each.groupBy("value").agg(
        F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos")
    )
    # A value seen once needs no row: only counts that differ from it travel back.
    shared = staged(counts.where("owners > 1 OR repos > 1"), "ownership")
    judged = keyed_join(each, shared, ["value"], "left").select(
        "doc_id",
        "text_hash",
        F.struct(
            "span.start",
            "span.kind",
            "span.stop",
            "span.value",
            F.coalesce("owners", F.col("owner").isNotNull().cast("long")).alias("owners"),
            F.coalesce("repos", F.col("repo").isNotNull().cast("long")).alias("repos"),
        ).alias("span"),
    )
    live = F.col("span.owners") < example_owners
    judged = judged.withColumn("span", F.col("span").withField("live", live))
    judged = judged.where((F.col("span.kind") < len(BASE_KINDS)) | F.col("span.live"))
    # Rows that agree in id and text have the same spans: a set holds them once.
    spans = judged.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    empty = F.array().cast(dict(spans.dtypes)["spans"])
    return scanned.join(spans, same, "left").select(
        "doc_id", "text_hash", "base", F.coalesce("spans", empty).alias("spans")
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:stop`` of each span, by start and then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ","
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the value of every live span replaced where it stands; examples and all else stay.

    Live values that overlap are replaced together.
    ``n_chars``, where there is such a column, follows the new text.
    """
    found = find_secrets(docs, **options)
    live = F.filter("spans", lambda s: s["live"])
    # A value ends where its span does.
    values = F.transform(live, lambda s: F.struct((s["stop"] - F.length(s["value"])).alias("a"), s["stop"].alias("b")))
    bad = found.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.array_sort(values).alias("_values")
    ).where("size(_values) > 0").distinct()
    rows = packed(docs, id=F.col("doc_id"), hash=F.xxhash64("text"))
    same = rows["id"].eqNullSafe(bad["_id"]) & (rows["hash"] == bad["_hash"])
    text = F.col("row.text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def cut(seen: Column, value: Column) -> Column:
        before = F.substr(text, seen["at"] + 1, value["a"] - seen["at"])
        out = F.when(value["a"] < seen["at"], seen["out"]).otherwise(
            F.concat(seen["out"], F.array(before, F.lit(REDACTED)))
        )
        return F.struct(F.greatest(seen["at"], value["b"]).alias("at"), out.alias("out"))

    def close(seen: Column) -> Column:
        return F.concat(F.array_join(seen["out"], ""), F.substr(text, seen["at"] + 1))

    clean = F.aggregate("_values", start, cut, close)
    row = F.col("row").withField("text", clean)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(clean).cast(dict(docs.dtypes)["n_chars"]))
    out = rows.join(bad, same, "left")
    return out.select(F.when(F.col("_values").isNull(), F.col("row")).otherwise(row).alias("row")).select("row.*")
