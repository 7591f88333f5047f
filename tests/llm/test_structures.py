"""Merkle manifest, prefix trie and quality scores against plain versions, with odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from driftline.llm import common, merkle, prefix_trie, quality, queries
from driftline.llm.common import held_out

# Ranking


def test_ranks_span_partitions(spark):
    rand = random.Random(1)
    rows = [("hot" if rand.random() < 0.6 else rand.choice("abc"), rand.choice([None, *range(50)]), n) for n in range(2000)]
    frame = spark.createDataFrame(rows, "g string, o int, n int").repartition(7)
    found = common.ranked(frame, ["g"], ["o", "n"], "test", per_part=100).collect()
    want = {}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want.update({r[2]: i for i, r in enumerate(own)})
    assert {r.n: r.idx for r in found} == want and len(found) == len(rows)
    assert common.ranked(frame.limit(0), ["g"], ["o"], "test").collect() == []


# Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes, fanout):
    """Root, and for each node the (left, right) siblings of every level."""
    paths, at, own = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(own) > 1:
        for path, i in zip(paths, at, strict=True):
            run = own[i // fanout * fanout :][:fanout]
            path.append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])))
        at = [i // fanout for i in at]
        own = [sha("".join(own[i : i + fanout])) for i in range(0, len(own), fanout)]
    return own[0], paths


def plain_manifest(rows, fanout=8):
    """rows: (group, order, leaf); returns {(order, leaf): [(subroot, root, path)]}."""
    groups = {}
    for g, o, leaf in rows:
        groups.setdefault(g, []).append((o is not None, o or 0, leaf, o))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in names]
    root, tops = plain_tree([t[0] for t in trees], fanout)
    out = {}
    for g, (subroot, paths), top in zip(names, trees, tops, strict=True):
        for x, path in zip(sorted(groups[g], key=lambda x: x[:3]), paths, strict=True):
            out.setdefault((x[3], x[2]), []).append((subroot, root, path + top))
    return out


@pytest.mark.parametrize("fanout", [2, 8])
def test_manifest_equals_plain_trees(spark, fanout):
    rand = random.Random(3)
    rows = [(n, rand.choice(["x", "é", "", None]), f"text {n}" * rand.randrange(4)) for n in range(150)]
    rows += [(n, "hot", "same") for n in range(1000, 1300)] + [(5, "x", None)] * 3 + [(None, None, "b"), (None, None, "a")]
    rows += [(7000, "one", "long " * 300_000), (7001, "😀", "😀\x00"), (7002, "￿", "")]
    docs = spark.createDataFrame([(*r, "c", "d") for r in rows], "doc_id long, lang string, text string, path string, idx string")
    found = merkle.manifest(docs.repartition(5), ["doc_id", "text"], "lang", "doc_id", fanout=fanout)
    got = {}
    for r in found.collect():
        path = [(s.left.hex(), s.right.hex()) for s in r.path]
        got.setdefault((r.doc_id, r.leaf), []).append((r.subroot, r.root, path))
    want = plain_manifest([(g, i, plain_leaf((i, t))) for i, g, t in rows], fanout)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    checked = found.select((merkle.folded("leaf", found.path) == found.root).alias("ok")).distinct().collect()
    assert [r.ok for r in checked] == [True]


def test_manifest_of_few_rows(spark):
    shape = "doc_id long, lang string, text string"
    assert merkle.manifest(spark.createDataFrame([], shape), ["text"], "lang", "doc_id").collect() == []
    only = merkle.manifest(spark.createDataFrame([(1, None, None)], shape), ["doc_id", "lang", "text"], "lang", "doc_id").first()
    assert only.leaf == only.subroot == only.root == sha("1:1--") and only.path == []


def test_manifest_query_finds_tampering(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.op11_merkle_manifest(spark, sf_dir).collect()}
    docs = queries.table(spark, sf_dir, "documents").collect()
    assert set(rows) == {d.doc_id for d in docs} and len({r.root for r in rows.values()}) == 1
    for d in docs:
        chosen = zlib.crc32(str(d.doc_id).encode()) % 3 == 0
        changed = chosen and any("A" <= c <= "Z" for c in d.text or "")
        assert rows[d.doc_id].verified is (not changed)
        assert rows[d.doc_id].leaf == plain_leaf((d.doc_id, d.source, d.lang, d.n_chars, d.text))


# Prefix trie


def plain_rebuilt(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = sha("".join(f"{len(x.encode())}:{x}" for x in (role, text)))
            convs.setdefault(c, []).append((turn is not None, turn or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members, ends = {}, {}
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path, own in members.items():
        worth = (len(own) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += worth
    return sorted(
        (
            own[0], len(path), members[path[:-1]][0] if path else -1, len(own), len(kids.get(path, [])), leaves[path], saved[path],
            sha(",".join(map(str, ends.get(path, [])))),
        )
        for path, own in members.items()
    )


def trie_rows(found):
    return sorted(tuple(-1 if v is None else v for v in r) for r in found.collect())


def conversations(seed):
    rand = random.Random(seed)
    rows = []
    for c in range(120):
        texts = [rand.choice(["", "hi", "é", f"t{rand.randrange(3)}", None]) for _ in range(rand.randrange(1, 14))]
        rows += [(c, t, rand.choice(["user", None]), x) for t, x in enumerate(texts)]
    rows += [(c, 0, "user", "hello") for c in range(500, 1900)]
    rows += [(7, t % 3, "user", f"tie {t % 5}") for t in range(30)] + [(11, None, "r", "first"), (None, 1, "user", "none"), (3, 0, "a", "x" * 200_000)]
    return rows


def rebuilt(spark, rows):
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, digest string, depth int")
    ident = prefix_trie.F.col("conv_id")
    head = prefix_trie.F.crc32(ident.cast("string").cast("binary")) % 9
    turns = prefix_trie.ordered_turns(frame.repartition(6))
    return prefix_trie.with_shared_heads(turns, ident - ident % 5, head, 8)


def test_trie_equals_plain_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", 3)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 20)
    rows = conversations(4)
    assert trie_rows(prefix_trie.prefix_trie(*rebuilt(spark, rows))) == plain_trie(plain_rebuilt(rows))


def test_trie_of_one_long_conversation_and_of_nothing(spark):
    chain = [(20, t, "user", f"turn {t}") for t in range(1000)] + [(25, t, "user", f"turn {t}") for t in range(700)]
    assert trie_rows(prefix_trie.prefix_trie(*rebuilt(spark, chain))) == plain_trie(plain_rebuilt(chain))
    assert trie_rows(prefix_trie.prefix_trie(*rebuilt(spark, []))) == []
    # The fourth conversation has no turn left: its base is absent and it is shorter than its head.
    lonely = next(c for c in range(1001, 2000) if zlib.crc32(str(c).encode()) % 9 > 2 and c % 5)
    assert trie_rows(prefix_trie.prefix_trie(*rebuilt(spark, [(lonely, 0, "u", "x")]))) == plain_trie({lonely: []})


def test_subtree_totals_of_a_forest_in_few_rounds(spark, monkeypatch):
    rand = random.Random(9)
    parent = {0: None, 5000: None}
    for n in range(1, 400):
        parent[n] = n - 1 if n < 250 else rand.randrange(n)
    kids = {p: list(parent.values()).count(p) for p in parent}
    own = {n: (rand.randrange(5), rand.randrange(100)) for n in parent}
    want = {n: list(own[n]) for n in parent}
    for n in sorted((n for n in parent if parent[n] is not None), reverse=True):
        for i in (0, 1):
            want[parent[n]][i] += want[n][i]
    frame = spark.createDataFrame([(n, parent[n], kids[n], *own[n]) for n in parent], "id long, parent long, n_children long, leaves long, saved long")
    stages = []
    real = prefix_trie.staged
    monkeypatch.setattr(prefix_trie, "staged", lambda df, label: stages.append(label) or real(df, label))
    found = {r.id: [r.leaves, r.saved] for r in prefix_trie.subtree_totals(frame).collect()}
    assert found == want
    assert stages.count("raked") < 40


# Quality


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = queries.op12_quality(spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    docs = queries.table(spark, sf_dir, "documents")
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    good, bad = [p for y, p in held if y], [p for y, p in held if not y]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.06 * len(bad)


def test_normal_equations_equal_one_product(spark):
    rand = random.Random(2)
    words = ["".join(rand.choices("abcdefgh#", k=rand.randrange(1, 9))) for _ in range(200)]
    texts = [" ".join(rand.choices(words, k=rand.randrange(1, 60))) for _ in range(150)] + ["same"] * 60 + [None, "", "\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 3 > 0) for i in range(len(texts))] + [(3, None)], "doc_id long, q boolean")
    labels = labels.selectExpr("doc_id", "CAST(q AS int) AS quality")
    sample = quality.labelled(quality.measure(docs), labels)
    rows = sample.collect()
    vectors = np.array([r.vector for r in rows])
    assert sorted(map(tuple, vectors)) == sorted(tuple(quality.statistics(t)) for t in texts)
    mean, spread = vectors.mean(axis=0), np.ones(vectors.shape[1])
    z = quality.fourier(vectors, mean, spread)
    y = np.array([r.quality for r in rows])
    found = quality.normal_equations(sample, mean, spread)
    for f in range(quality.FOLDS):
        own = np.array([r.fold == f for r in rows])
        assert np.allclose(found[f], z[own].T @ np.column_stack([z[own], y[own]]))
    plain = z[own].T @ z[own] + quality._RIDGE * own.sum() * np.diag([1.0] * quality.FEATURES + [0.0])
    assert np.allclose(plain @ quality.ridge(found[f]), z[own].T @ y[own], atol=1e-6)


def test_isotonic_is_the_best_ascending_fit():
    rand = np.random.default_rng(4)
    for _ in range(30):
        raw = np.arange(12.0)
        count = rand.integers(1, 9, 12).astype(float)
        good = rand.binomial(count.astype(int), np.sort(rand.random(12))).astype(float)
        # The fit at i is the largest of the smallest means of runs that hold i.
        means = [[good[a : b + 1].sum() / count[a : b + 1].sum() if a <= b else 2 for b in range(12)] for a in range(12)]
        best = [max(min(means[a][b] for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        xs, ys = quality.isotonic(raw, good, count)
        assert np.all(np.diff(xs) > 0) and np.all(np.diff(ys) > 0)
        assert sorted(set(np.round(best, 9))) == sorted(set(np.round(ys, 9)))


def test_fourier_features_approximate_the_kernel():
    rand = np.random.default_rng(5)
    x = rand.normal(size=(60, len(quality.STATISTICS)))
    z = quality.fourier(x, np.zeros(x.shape[1]), np.ones(x.shape[1]))[:, :-1]
    apart = ((x[:, None] - x[None, :]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-apart / 2 / quality._WIDTH**2)).mean() < 0.1


def test_quality_of_odd_rows(spark):
    texts = [None, "", " ", "\n", "x", "é漢字😀\x00", "a" * 3_000_000, "word " * 600_000, "same", "same"]
    rows = [(i, t, "s", "p", "v") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, predicted string, vector string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts))] + [(None, 1)], "doc_id long, quality int")
    measured = quality.measure(docs)
    model = quality.fit(measured, labels)
    found = {r.doc_id: r for r in quality.score_documents(docs, model).collect()}
    assert len(found) == len(texts) and found[8].score == found[9].score and found[0].score == found[1].score
    assert {(r.doc_id, r.score) for r in quality.score_measured(measured, model).collect()} == {(i, r.score) for i, r in found.items()}
    assert found[3].vector == "v" and all(0 <= r.score <= 1 for r in found.values())
    assert quality.score_documents(docs.limit(0), model).collect() == []
    blank = quality.fit(measured, labels.limit(0))
    assert {r.score for r in quality.score_documents(docs, blank).collect()} == {0.0}
    assert quality.fit_held_in(measured, labels.where(held_out(labels.doc_id, 4, 2))).score.tolist() == [0.0]


def test_statistics_do_not_depend_on_the_pieces(monkeypatch):
    rand = random.Random(8)
    text = "".join(rand.choice(["word ", "Two\n", "a#b ", "9 ", "é. "]) for _ in range(3000))
    whole = quality.statistics(text)
    monkeypatch.setattr(quality, "_PIECE", 97)
    assert np.allclose(quality.statistics(text)[[0, 1, 2, 4, 5, 6, 7, 9]], whole[[0, 1, 2, 4, 5, 6, 7, 9]])
