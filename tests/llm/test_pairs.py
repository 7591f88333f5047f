"""Near-duplicate operators against brute force, with hot groups, ties, nulls and empty tables."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from driftline.llm import components, embeddings, simhash
from driftline.llm.components import connected_components


def smallest_reachable(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, 100 + i) for i in range(1, 300)]
    links = chain[::-1] + star + [(5, 5), (100, 103)]
    random.Random(1).shuffle(links)
    found = dict(connected_components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect())
    assert found == smallest_reachable({x for pair in links for x in pair}, links)


def test_links_made_in_python_are_folded_in_a_stage_of_their_own(spark, monkeypatch):
    plans, write = [], components.staged

    def staged(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(components, "staged", staged)
    made = spark.createDataFrame([(1, 2), (2, 3), (4, 4)], "a long, b long").mapInPandas(lambda rows: rows, "a long, b long")
    assert dict(connected_components(made).collect()) == {1: 1, 2: 1, 3: 1}
    # A stage with two of them holds two Python workers for each of its tasks.
    assert max(plan.count("MapInPandas") for plan in plans) == 1


def test_components_without_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_fingerprint(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts():
    rand = random.Random(3)
    words = ["".join(rand.choices("abcdefgh", k=5)) for _ in range(300)]
    texts = []
    for _ in range(25):
        base = rand.choices(words, k=400)
        texts.append(" ".join(base))
        for _ in range(rand.randrange(4)):
            copy = list(base)
            copy[rand.randrange(400)] = rand.choice(words)
            texts.append(" \n".join(copy).upper() if rand.random() < 0.5 else " ".join(copy))
    texts += [texts[0]] * 40 + [None, "", " \t\n", "one", "ONE", "one two", "é É", "x " * 30000]
    return list(enumerate(texts))


def test_simhash_equals_brute_force(spark):
    rows = near_texts()
    docs = spark.createDataFrame([(t, i, "x", 1) for i, t in rows], "text string, doc_id long, fp string, root int")
    prints = {i: plain_fingerprint(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = smallest_reachable(prints, links)
    assert len(set(roots.values())) < len({t for _, t in rows})
    found = simhash.near_duplicates(docs).collect()
    assert {(r.doc_id, r.fp % 2**64, r.component_id) for r in found} == {(i, prints[i], roots[i]) for i in prints}


def test_simhash_blocks_find_every_link(spark):
    rand = random.Random(5)
    prints = {rand.getrandbits(64) for _ in range(3000)}
    for p in list(prints)[:900]:
        bits = rand.sample(range(64), rand.randrange(1, 4))
        prints.add(p ^ sum(1 << b for b in bits))
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    # Unsigned: numpy counts the bits of the absolute value of signed numbers.
    whole = np.array(signed, dtype=np.int64).view(np.uint64)
    near = np.argwhere(np.bitwise_count(whole[:, None] ^ whole[None, :]) <= 2)
    expected = smallest_reachable(signed, [(signed[a], signed[b]) for a, b in near if a < b])
    for block in (64, 700, 4096):
        simhash.BLOCK, before = block, simhash.BLOCK
        links = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"), 2)
        found = dict(connected_components(links).collect())
        simhash.BLOCK = before
        assert {s: found.get(s, s) for s in signed} == expected


def test_simhash_links_across_the_sign_bit(spark):
    rand = random.Random(6)
    bases = [rand.getrandbits(64) for _ in range(600)]
    masks = [1 << 63 | 1 << b for b in range(63)] + [1 << 63, 7 << 61, 15 << 60, 1 << 63 | 3]
    prints = set(bases) | {b ^ m for b, m in zip(bases, masks * 9, strict=False)}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    roots = smallest_reachable(prints, links)
    signed = {p: p - 2**64 if p >> 63 else p for p in prints}
    for block in (64, 4096):
        simhash.BLOCK, before = block, simhash.BLOCK
        frame = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
        found = dict(connected_components(simhash.fingerprint_links(frame, 2)).collect())
        simhash.BLOCK = before
        groups = {}
        for p in prints:
            groups.setdefault(roots[p], set()).add(found.get(signed[p], signed[p]))
        assert all(len(g) == 1 for g in groups.values())
        assert len(set.union(*groups.values())) == len(groups)


def test_keep_one_keeps_one_row_of_each_group(spark):
    rows = [(1, "a b c d", "u"), (2, "A B C D", "v"), (1, "a b c d", "w"), (3, None, "x"), (None, "", "y"), (4, "z", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def brute_links(rows):
    good = [
        (n, np.array(v, float))
        for n, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = []
    for (i, a), (j, b) in itertools.combinations(good, 2):
        if rows[i][2] == rows[j][2] and len(a) == len(b):
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                links.append((i, j))
    return links


@pytest.mark.parametrize("block", [8, 1024])
def test_embeddings_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rand = np.random.default_rng(2)
    rows = []
    for centre in rand.normal(size=(12, 16)):
        for _ in range(rand.integers(1, 9)):
            rows.append((centre + rand.normal(size=16) * rand.choice([0.05, 0.3])).tolist())
    rows = [(v, int(rand.integers(2))) for v in rows]
    rows += [(rows[0][0], rows[0][1])] * 30 + [([0.0] * 16, 0), (None, 0), ([None] * 16, 1), ([float("nan")] * 16, 1)]
    rows += [(rows[1][0], None), ([1.0, 2.0], 0), ([2.0, 4.0], 0), ([float("inf")] * 16, 0), ([], 1), ([1e200] * 16, 1)]
    rows = [(n * 3 % 211, v, label) for n, (v, label) in enumerate(rows)]
    frame = spark.createDataFrame(
        [(*r, 7, 8) for r in rows], "vec_id long, embedding array<double>, label int, n int, width int"
    )
    links = brute_links(rows)
    ids = [r[0] for r in rows]
    roots = smallest_reachable(ids, [(ids[a], ids[b]) for a, b in links])
    degree = {i: 0 for i in ids}
    for a, b in links:
        degree[ids[a]] += 1
        degree[ids[b]] += 1
    found = embeddings.near_duplicates(frame).collect()
    assert {tuple(r) for r in found} == {(i, degree[i], roots[i], i == roots[i]) for i in ids}
    assert len(found) == len(rows)


def test_embeddings_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_duplicates(empty).collect() == []
