"""Conversation prefix trie, its subtree totals by parallel tree contraction.

A prefix of d turns is known by the XOR of a 128-bit mark of every (depth, turn) in it, so
prefixes are made with windows over short blocks of a conversation, however long it is.

Subtree totals come from rounds of two joins. Rake: leaves add what they hold to their
parent and are done. Compress: in chains of nodes with one child, a coin chooses nodes no
two of which touch; the child moves up past its chosen parent and remembers what it passed
over. The tree shrinks by a constant share a round, also where it is one long chain. Then
the rounds are undone from the last: a node that was passed over has its own constant and
the total of the child that passed it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from driftline.llm.common import ranked
from driftline.llm.merkle import framed
from driftline.shared import keyed_join, staged

# Turns of one window, and ids of one piece of text under a digest.
BLOCK_TURNS = 4096
CHUNK_IDS = 512


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, n_bytes) for every row with a conv_id of ``conversations(conv_id, turn, role, text)``.

    pos counts from 1 by turn, a null turn first, rows of one turn by their digest. A null
    role or text is empty. digest is 16 bytes of role and text, n_bytes the text's UTF-8
    size. Rows without a conv_id belong to no conversation. Repeated rows are turns of their
    own. Texts stay where they are: only digests are shuffled.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.unhex(F.substring(F.sha2(F.concat(framed(role), framed(text)), 256), 1, 32)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    placed = ranked(rows, ["conv_id"], ["turn", "digest"], "turns")
    return placed.select("conv_id", (F.col("idx") + 1).alias("pos"), "digest", "n_bytes")


def with_shared_heads(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another one: the turns, and (conv_id, n_turns) of each.

    Each conversation takes the first ``head`` turns, at most ``most``, of conversation
    ``base`` (both made from conv_id), all if there are fewer, and goes on with its own
    after as many. The turns come as (conv_id, depth, n_turns, digest, n_bytes).
    """
    turns = staged(turns, "turns")
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumns({"base": base, "head": head})
    own = staged(own, "conversations")
    lengths = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least(F.col("head"), F.coalesce("base_n", F.lit(0)))
    convs = own.join(lengths, "base", "left").withColumn("taken", taken)
    convs = staged(
        convs.select(
            "conv_id", "base", "head", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("n_turns")
        ),
        "rebuilt",
    )
    rest = turns.join(convs, "conv_id").where("pos > head").withColumn("depth", F.col("taken") + F.col("pos") - F.col("head"))
    heads = turns.where(F.col("pos") <= most).withColumnRenamed("conv_id", "base").withColumnRenamed("pos", "depth")
    first = convs.where("taken > 0").join(heads, "base").where("depth <= taken")
    columns = ["conv_id", "depth", "n_turns", "digest", "n_bytes"]
    return rest.select(*columns).unionAll(first.select(*columns)), convs.select("conv_id", "n_turns")


def _half(text: Column, start: int) -> Column:
    return F.conv(F.substring(text, start, 16), 16, -10).cast("long")


def _prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with (k1, k2), which name the prefix up to a turn, and (p1, p2), the one before it."""
    mark = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("digest")), 256)
    block = F.floor((F.col("depth") - 1) / BLOCK_TURNS).cast("long")
    marked = turns.withColumn("mark", mark).select(
        "*", _half(F.col("mark"), 1).alias("m1"), _half(F.col("mark"), 17).alias("m2"), block.alias("block")
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = staged(
        marked.select(
            "conv_id", "depth", "n_turns", "n_bytes", "block", "m1", "m2",
            F.bit_xor("m1").over(inside).alias("x1"), F.bit_xor("m2").over(inside).alias("x2"),
        ),
        "blocks",
    )
    # Only conversations over one block have anything to carry from block to block.
    long = staged(local.where("block > 0").select("conv_id").distinct(), "long")
    sums = keyed_join(local, long, ["conv_id"], "left_semi").groupBy("conv_id", "block")
    sums = sums.agg(F.bit_xor("m1").alias("b1"), F.bit_xor("m2").alias("b2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "block", F.bit_xor("b1").over(before).alias("c1"), F.bit_xor("b2").over(before).alias("c2"))
    found = keyed_join(local, staged(carried, "carried"), ["conv_id", "block"], "left")
    k1, k2 = (F.col(f"x{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long"))) for i in (1, 2))
    return found.select(
        "conv_id", "depth", "n_turns", "n_bytes", k1.alias("k1"), k2.alias("k2"),
        k1.bitwiseXOR(F.col("m1")).alias("p1"), k2.bitwiseXOR(F.col("m2")).alias("p2"),
    )


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the conversations, the empty one included.

    ``turns`` has (conv_id, depth, n_turns, digest, n_bytes), depths from 1 to n_turns once
    each; ``convs`` has (conv_id, n_turns), also those without turns. Rows are (conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    smallest member, the parent's smallest member, members, children, childless nodes of the
    subtree, text bytes that storing each node of the subtree once saves, and the digest of
    the comma-joined ascending ids that end here. Without conversations there are no rows.

    A prefix with a third of all conversations is counted with map-side combine, a parent
    with a third of all nodes is one row on its side of every join, and ids that end at one
    node are packed in parallel before one task reads the packs in order, as SHA-256 asks.
    """
    rows = staged(_prefixes(turns), "prefixes")
    zero = F.lit(0).cast("long")
    inner = rows.groupBy("k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count("*").alias("n_convs"),
        F.max("n_bytes").alias("n_bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )
    none = F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("k1"), zero.alias("k2"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("n_bytes"), none.alias("p1"), none.alias("p2")
    )
    nodes = staged(inner.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    names = nodes.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    nodes = staged(keyed_join(nodes, staged(names, "names"), ["p1", "p2"], "left"), "linked")
    kids = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids.withColumnRenamed("parent", "id"), "id", "left")
    nodes = staged(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie")

    totals = subtree_totals(
        nodes.select(
            "id", "parent", "n_children",
            (F.col("n_children") == 0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        )
    )
    ends = rows.where("depth = n_turns").select("k1", "k2", "conv_id").unionAll(
        convs.where("n_turns = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id")
    )
    found = nodes.join(totals, "id").join(id_digests(ends, ["k1", "k2"], "conv_id", "ends_sha256"), ["k1", "k2"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _coin(node: str, turn: int) -> Column:
    return F.xxhash64(F.col(node), F.lit(turn)).bitwiseAND(F.lit(1)) == 1


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """(id, leaves, saved): both columns summed over the subtree of every node.

    ``nodes`` has (id, parent, n_children, leaves, saved), whole numbers; the parent of a
    root is null. Works for a forest, and in as many rounds as the logarithm of its nodes
    whether it is broad, deep or one chain.
    """
    zero = F.lit(0).cast("long")
    active = staged(
        nodes.select("id", "parent", F.col("n_children").alias("kids"), "leaves", "saved", zero.alias("e_leaves"), zero.alias("e_saved")),
        "active",
    )
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while active.limit(1).count():
        done = active.where("kids = 0").select("id", "leaves", "saved")
        leaf = F.col("kids") == 0
        given = active.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
            F.count_if(leaf).alias("raked"),
            *[F.sum(F.when(leaf, F.col(c) + F.col(f"e_{c}")).otherwise(zero)).alias(f"r_{c}") for c in ("leaves", "saved")],
            # Of a parent with one child left these are that child's.
            *[F.max(F.when(~leaf, F.col(c))).alias(n) for c, n in (("id", "heir"), ("e_leaves", "h_leaves"), ("e_saved", "h_saved"))],
        )
        own = active.where("kids > 0").join(given, "id").select(
            "id", "parent", (F.col("kids") - F.col("raked")).alias("kids"),
            *[(F.col(c) + F.col(f"r_{c}")).alias(c) for c in ("leaves", "saved")], "e_leaves", "e_saved", "heir", "h_leaves", "h_saved",
        )
        chosen = (F.col("kids") == 1) & F.col("parent").isNotNull() & _coin("id", len(rounds)) & ~_coin("heir", len(rounds))
        raked = staged(own.withColumn("chosen", chosen), "raked")
        over = raked.where("chosen")
        rounds.append(
            (done, over.select("id", "heir", *[(F.col(c) + F.col(f"h_{c}")).alias(f"own_{c}") for c in ("leaves", "saved")]))
        )
        passed = over.select(
            F.col("id").alias("parent"), F.col("parent").alias("up"),
            *[(F.col(c) + F.col(f"e_{c}")).alias(f"x_{c}") for c in ("leaves", "saved")],
        )
        moved = keyed_join(raked.where("NOT chosen"), staged(passed, "passed"), ["parent"], "left")
        active = staged(
            moved.select(
                "id", F.coalesce("up", "parent").alias("parent"), "kids", "leaves", "saved",
                *[(F.col(f"e_{c}") + F.coalesce(f"x_{c}", zero)).alias(f"e_{c}") for c in ("leaves", "saved")],
            ),
            "active",
        )
    found = nodes.limit(0).select("id", "leaves", "saved")
    for done, over in reversed(rounds):
        # What later rounds found: a constant share of what this one adds it to.
        known = found.withColumnRenamed("id", "heir")
        back = over.join(known, "heir").select("id", *[(F.col(f"own_{c}") + F.col(c)).alias(c) for c in ("leaves", "saved")])
        found = staged(found.unionAll(done).unionAll(back), "totals")
    return found


def id_digests(rows: DataFrame, group: list[str], ident: str, name: str) -> DataFrame:
    """(group..., ``name``): SHA-256 of the decimal ids of each group, ascending, comma-joined.

    Neither column holds nulls. Ids are ranked and packed into bounded texts by as many tasks
    as there is work for; a group of several packs is read in order by one task, which keeps
    only the state of the digest.
    """
    packs = ranked(rows, group, [ident], "ends").groupBy(*group, F.floor(F.col("idx") / CHUNK_IDS).alias("pack"))
    packs = staged(packs.agg(F.array_join(F.sort_array(F.collect_list(ident)), ",").alias("ids")), "packs")
    several = staged(packs.where("pack > 0").select(*group).distinct(), "several")
    one = keyed_join(packs, several, group, "left_anti").select(*group, F.sha2("ids", 256).alias(name))
    more = keyed_join(packs, several, group, "left_semi").select(*group, "pack", "ids")
    fields = [rows.schema[c] for c in group]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{name}` string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def out() -> pa.RecordBatch:
            kept = [pa.array([v], batch.schema.field(i).type) for i, v in enumerate(current)]
            return pa.RecordBatch.from_arrays([*kept, pa.array([state.hexdigest()])], names=[*group, name])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(group))]
            for *key, ids in zip(*columns, batch.column(len(group) + 1).to_pylist(), strict=True):
                if key != current:
                    if current is not None:
                        yield out()
                    current, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if current is not None:
            yield out()

    streamed = more.repartition(*group).sortWithinPartitions(*group, "pack").mapInArrow(read, schema)
    return one.unionByName(streamed)
