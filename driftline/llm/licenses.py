"""License scan with a positional index of rare template words.

The inverse document frequency of every template word is taken over the whole corpus. A
template's key phrase must stand in full, so every word of it stands at its place in a
match. Each file looks up the two that are rarest in it: of high IDF and seldom in the
file itself. Their postings in the template shift the places found to where the template
would begin, and only beginnings on which both agree are left. There the key phrase is
verified, and the words of file and template are compared place by place.
Everything is column expressions over one row per file; no file is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from driftline.llm.common import WORD, ascii_lower, words_of

_HIT = "array<struct<label:string,start:int,cover:double,base:boolean>>"


@dataclass(frozen=True)
class Template:
    """Words of a license text, the phrase in them that must stand, and the share that must agree."""

    label: str
    text: str
    key: str
    least: float = 0.6
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key.split()
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


# The base phrases and their labels.
BASE_TEMPLATES = [
    Template("mit", "mit license", "mit license", 1.0, True),
    Template("apache", "apache license", "apache license", 1.0, True),
    Template("gpl", "general public license", "general public license", 1.0, True),
]

# Public license notices, as they are commonly worded.
NOTICES = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("apache", "licensed under the apache license version 2 0", "apache license"),
    Template("gpl", "licensed under the gnu general public license version 3", "general public license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "free software you can redistribute it"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("bsd", "released under the bsd license", "bsd license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
]


def word_frequencies(docs: DataFrame, templates: list[Template]) -> tuple[int, dict[str, int]]:
    """How many files there are, and in how many each template word stands.

    The counts go to the driver: one for each word of the templates, whatever the corpus.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    held = F.array_intersect(words_of(ascii_lower(F.col("text"))), F.array(*map(F.lit, vocabulary)))
    seen = docs.where("text IS NOT NULL").select(F.explode(held).alias("word"))
    counts = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return docs.count(), {w: counts.get(w, 0) for w in vocabulary}


def rarest_word(template: Template, idf: dict[str, float]) -> str:
    """The word of the key phrase that fewest files hold; a file without it has no match."""
    return max(template.key.split(), key=lambda w: idf[w])


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """(doc_id, n_words, hits) for every row of ``docs(doc_id, text)``, from whole texts.

    ``hits`` lists (label, start, cover, base): the place of a template's first word,
    counted in words, and the share of its words that agree. A template may begin before
    or end after the text as long as its key phrase stands in it. A null text counts as
    empty. Repeated rows stay repeated, ties stay all, other columns are not read.
    """
    templates = BASE_TEMPLATES + NOTICES if templates is None else templates
    files, counts = word_frequencies(docs, templates)
    idf = {w: math.log((1 + files) / (1 + n)) for w, n in counts.items()}
    text = F.coalesce("text", F.lit(""))
    signs = sorted({rarest_word(t, idf) for t in templates})
    sign = f"(?i)(?<!{WORD[:-1]})(?:{'|'.join(signs)})(?!{WORD[:-1]})"
    plain = docs.select("doc_id", text.alias("text"))
    counted = plain.select(
        "doc_id",
        F.size(words_of(F.col("text"))).alias("n_words"),
        F.when(F.col("text").rlike(sign), words_of(ascii_lower(F.col("text")))).alias("words"),
    )
    # Index of a file: (place, word) of its key words, however often they stand.
    keys = sorted({w for t in templates for w in t.key.split()})
    placed = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    indexed = counted.withColumn("index", F.filter(placed, lambda p: p["word"].isin(keys)))
    begins = {f"begins_{n}": _begins(t, idf) for n, t in enumerate(templates)}
    found = indexed.withColumns(begins)
    hits = F.flatten(F.array(*[_matches(t, F.col(name)) for t, name in zip(templates, begins)]))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce(F.when(F.size("index") > 0, hits), F.array().cast(_HIT)).alias("hits"),
    )


def _begins(template: Template, idf: dict[str, float]) -> Column:
    """Where the template may begin, by the two words of its key phrase that are rarest in the file."""

    def postings(n: int, word: str) -> Column:
        at = F.filter("index", lambda p: p["word"] == word)
        begins = F.transform(at, lambda p: p["at"] - (template.key_at + n))
        rarity = F.lit(idf[word]) - F.log(F.size(begins) + 1.0)
        return F.struct((-rarity).alias("common"), F.lit(n).alias("n"), begins.alias("begins"))

    looked_up = [postings(n, word) for n, word in enumerate(template.key.split())]
    rarest = F.slice(F.array_sort(F.array(*looked_up)), 1, 2)
    agreed = F.aggregate(
        F.slice(rarest, 2, 1), F.get(rarest, F.lit(0))["begins"], lambda left, x: F.array_intersect(left, x["begins"])
    )
    return F.when(F.size("index") > 0, agreed)


def _matches(template: Template, begins: Column) -> Column:
    """The template's verified matches in the row, one for each place where it begins."""
    key, wanted = template.key.split(), F.array(*map(F.lit, template.words))

    def cover(start: Column) -> Column:
        agree = F.filter(
            F.transform(wanted, lambda w, i: F.get("words", start + i).eqNullSafe(w)), lambda same: same
        )
        return F.size(agree) / F.lit(float(len(template.words)))

    def keyed(start: Column) -> Column:
        whole = F.lit(True)
        for n, word in enumerate(key):
            whole = whole & F.get("words", start + template.key_at + n).eqNullSafe(F.lit(word))
        return whole

    whole = F.filter(begins, keyed)
    struct = F.transform(
        whole,
        lambda s: F.struct(
            F.lit(template.label).alias("label"),
            s.alias("start"),
            cover(s).alias("cover"),
            F.lit(template.base).alias("base"),
        ),
    )
    return F.filter(struct, lambda h: h["cover"] >= template.least).cast(_HIT)


def license_report(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """Counts, first and last places, labels and score of every row, as columns.

    Base hits are complete phrases; labels join the base labels with those of all hits,
    and score is the best share of a template found: 1 for a base phrase, 0 without a hit.
    """
    found = scan_licenses(docs, templates)
    base = F.filter("hits", lambda h: h["base"])
    starts = F.transform(base, lambda h: h["start"])

    def joined(hits: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["cover"])), F.lit(0.0)).alias("score"),
    )
