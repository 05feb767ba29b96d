"""Operator 11: the prefix trie of conversations, built level by level.

A node is a distinct sequence of first turns.  Level by level the live
conversations are grouped by (parent node, next turn); the least conv_id of a
group names the new node.  Then the levels are joined upwards again, from the
deepest, and roll up children, leaves and savings.  What travels is a pair of
64-bit hashes a turn and its size, never a text.

Conversations of one whole sequence are one member with a weight, so copies cost
what one costs.  A node leaves the loop as soon as Spark need not group below it:
with one sequence its turns are its descendants (plain rows and a running sum);
with at most ``SEQUENCES`` sequences and ``TURNS`` turns its subtree is built in a
task, by the same levels.  Larger nodes go on to the next level, however many
there are, so a hot first turn is no group of any task.

Cases: rows of a null conv_id take no part (there is no decimal id to hash or
list); null turns come first; rows of one turn are ordered by role and then by the
hash of role and text, repeated rows are turns like others; a null role or text is
empty; a conversation without turns is a member of the root; a very long
conversation is a chain of rows, never one value; an empty table has no nodes;
further columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clusterio import checkpointed, lean, read, small_side

#: A subtree of at most so many sequences and turns is built in one task.
SEQUENCES, TURNS = 1 << 12, 1 << 18
#: Levels whose turns a live conversation carries along.
STRIDE = 16
BUCKET_TURNS, MIN_BUCKETS = 1 << 18, 64
#: Members whose ids one piece of a list holds.
PIECE = 1 << 16
FAMILY, SHARED = 5, 9


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, k1, k2, size, n): turns in order, from 1, as hashes; n: turns of the conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    hashed = lambda seed: F.xxhash64(F.lit(seed), F.length(role), role, text)
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), hashed(1).alias("k1"), hashed(2).alias("k2"), F.octet_length(text).cast("long").alias("size"))
    conv = Window.partitionBy("conv_id")
    pos = F.row_number().over(conv.orderBy(F.col("turn").asc_nulls_first(), "role", "k1", "k2")).cast("long")
    return rows.select("conv_id", pos.alias("pos"), "k1", "k2", "size", F.count("*").over(conv).alias("n"))


def rebuilt(turns: DataFrame, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """(conv_id), (conv_id, pos, k1, k2, size): each conversation after the first turns of its family's first.

    The first h turns of conversation c - c % family take the place of c's own
    first h; h is c's CRC-32 modulo ``shared``.
    """
    c = F.col("conv_id")
    heads = turns.filter("pos = 1").select("conv_id", "n", (c - c % family).alias("base"), (F.crc32(c.cast("string").cast("binary")) % shared).alias("h"))
    bases = heads.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = checkpointed(heads.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))))
    lent = turns.filter(F.col("pos") < shared).select(F.col("conv_id").alias("base"), "pos", "k1", "k2", "size")
    first = convs.join(lent, "base").filter("pos <= h").select("conv_id", "pos", "k1", "k2", "size")
    own = turns.join(convs.select("conv_id", "h", "m"), "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "k1", "k2", "size")
    return convs.select("conv_id"), first.unionByName(own)


def classes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, rep, n_turns, w): each conversation, the least one of its whole sequence, and their number.

    Sequences are compared by two 64-bit sums over (position, turn), which are
    taken before the shuffle.
    """
    mixed = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "pos", "k1", "k2"))
    facts = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"), mixed(3).alias("d1"), mixed(4).alias("d2"))
    whole = checkpointed(convs.join(facts, "conv_id", "left").fillna(0, ["n_turns", "d1", "d2"]))
    same = ["n_turns", "d1", "d2"]
    reps = whole.groupBy(*same).agg(F.min("conv_id").alias("rep"), F.count("*").alias("w"))
    return whole.join(reps, same).select("conv_id", "rep", "n_turns", "w")


def listed_hashes(members: DataFrame) -> DataFrame:
    """(rep, ends_sha256): hash of the members' ids in order, comma-joined.

    Ids are sorted and joined to pieces over ranges, so a class of a third of all
    rows is spread; the pieces then stream through one hash per class.
    """

    def pieces(batches):
        key, ids = None, []

        def closed():
            return pa.RecordBatch.from_pydict({"rep": [key], "first": [ids[0]], "ids": [",".join(map(str, ids))]}, schema=pa.schema([("rep", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))

        for batch in batches:
            for rep, c in zip(batch["rep"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if ids and (rep != key or len(ids) == PIECE):
                    yield closed()
                    ids = []
                key = rep
                ids.append(c)
        if ids:
            yield closed()

    def hashes(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for rep, ids in zip(batch["rep"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if rep != key:
                    if state:
                        done.append((key, state.hexdigest()))
                    key, state = rep, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _ended(done)
        if state:
            yield _ended([(key, state.hexdigest())])

    def _ended(rows):
        return pa.RecordBatch.from_pydict({"rep": pa.array([r[0] for r in rows], pa.int64()), "ends_sha256": pa.array([r[1] for r in rows], pa.string())})

    cut = members.select("rep", "conv_id").repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id").mapInArrow(pieces, "rep long, first long, ids string")
    return cut.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(hashes, "rep long, ends_sha256 string")


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ender long, ender_w long, top boolean"
_NODE_SCHEMA = pa.schema([*[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ender", "ender_w")], ("top", pa.bool_())])


def grown(rows: pa.Table) -> pa.Table:
    """The nodes below some nodes, level by level.

    rows: node, depth (of the node), rep, w, pos, k1, k2, size, for every turn of
    the node's sequences after ``depth``.  ``top`` marks the node's own children.
    """
    col = {c: rows[c].to_numpy() for c in ("node", "depth", "rep", "w", "pos", "k1", "k2", "size")}
    order = np.lexsort((col["pos"], col["rep"]))
    col = {c: v[order] for c, v in col.items()}
    start = np.flatnonzero(np.concatenate([[True], col["rep"][1:] != col["rep"][:-1]]))
    length = np.diff(np.append(start, len(order)))
    rep, w = col["rep"][start], col["w"][start]
    # the nodes that are given, numbered by (name, depth)
    given, at = np.unique(np.stack([col["node"][start], col["depth"][start]], axis=1), axis=0, return_inverse=True)
    at = at.ravel()
    levels, k, live, first_id = [], 0, np.arange(len(start)), len(given)
    base, parent_names, parent_depths = 0, given[:, 0], given[:, 1]
    while len(live):
        own = start[live] + k
        a, b, parent = col["k1"][own], col["k2"][own], at[live]
        by = np.lexsort((rep[live], b, a, parent))
        live, own, a, b, parent = live[by], own[by], a[by], b[by], parent[by]
        new = np.concatenate([[True], (parent[1:] != parent[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        at[live] = first_id + number
        stops = length[live] == k + 1
        ender, ender_w = np.full(len(first), -1), np.zeros(len(first), np.int64)
        ender[number[stops]], ender_w[number[stops]] = rep[live][stops], w[live][stops]
        n_convs = np.add.reduceat(w[live], first)
        up = parent[first] - base
        levels.append({"conv_id": rep[live][first], "depth": parent_depths[up] + 1, "parent_conv_id": parent_names[up], "n_convs": n_convs, "saved_tokens": (n_convs - 1) * col["size"][own[first]], "ender": ender, "ender_w": ender_w, "up": up, "top": np.full(len(first), k == 0)})
        base, first_id = first_id, first_id + len(first)
        parent_names, parent_depths = levels[-1]["conv_id"], levels[-1]["depth"]
        live, k = live[~stops], k + 1
    for k in range(len(levels) - 1, -1, -1):
        level, n = levels[k], len(levels[k]["conv_id"])
        children, leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64), level["saved_tokens"].copy()
        if k + 1 < len(levels):
            below = levels[k + 1]
            np.add.at(children, below["up"], 1)
            np.add.at(leaves, below["up"], below["n_leaves"])
            np.add.at(saved, below["up"], below["saved_tokens"])
        level |= {"n_children": children, "n_leaves": np.where(children == 0, 1, leaves), "saved_tokens": saved}
    whole = {c: np.concatenate([x[c] for x in levels]) if levels else np.zeros(0, np.int64) for c in _NODE_SCHEMA.names}
    missing = whole["ender_w"] == 0
    return pa.table([pa.array(whole[f.name], f.type, mask=missing if f.name == "ender" else None) for f in _NODE_SCHEMA], schema=_NODE_SCHEMA)


def chained(chains: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes below nodes of one sequence: its further turns (chains: rep, depth, node)."""
    rows = turns.join(chains.select("rep", "depth", "node"), "rep").filter("pos > depth")
    own = (F.col("w") - 1) * F.col("size")
    after = Window.partitionBy("rep").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    last, top = F.col("pos") == F.col("n_turns"), F.col("pos") == F.col("depth") + 1
    return rows.select(
        F.col("rep").alias("conv_id"), F.col("pos").alias("depth"), F.when(top, F.col("node")).otherwise(F.col("rep")).alias("parent_conv_id"), F.col("w").alias("n_convs"), (~last).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.sum(own).over(after).alias("saved_tokens"), F.when(last, F.col("rep")).alias("ender"), F.when(last, F.col("w")).otherwise(F.lit(0).cast("long")).alias("ender_w"), top.alias("top"),
    )


def prefix_trie(convs: DataFrame, turns: DataFrame, sequences: int = SEQUENCES, most_turns: int = TURNS) -> DataFrame:
    """Nodes of the trie over ``turns`` (conv_id, pos, k1, k2, size) of ``convs`` (conv_id).

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.
    """
    turns = checkpointed(turns)
    members = checkpointed(classes(convs, turns))
    reps = members.filter("conv_id = rep").select("rep", "w", "n_turns")
    turns = checkpointed(turns.withColumnRenamed("conv_id", "rep").join(reps, "rep"))
    total = reps.agg(F.min("rep").alias("child"), F.sum("w").alias("n_convs"), F.min(F.when(F.col("n_turns") == 0, F.col("rep"))).alias("ender"), F.coalesce(F.sum(F.when(F.col("n_turns") == 0, F.col("w"))), F.lit(0).cast("long")).alias("ender_w"))
    root = total.filter("n_convs is not null").select("child", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("node"), "n_convs", F.lit(0).cast("long").alias("saved"), "ender", "ender_w")
    levels, chains, smalls, rest = [checkpointed(root)], [], [], 0
    least = levels[0].first()
    live = reps.filter("n_turns > 0").withColumn("node", F.lit(least["child"] if least else None).cast("long"))
    depth = 0
    while True:
        if depth % STRIDE == 0:
            step = F.struct("pos", "k1", "k2", "size")
            ahead = turns.filter(F.col("pos").between(depth + 1, depth + STRIDE)).groupBy("rep").agg(F.sort_array(F.collect_list(step)).alias("ahead"))
            live = live.drop("ahead").join(ahead, "rep")
        now = F.get("ahead", F.lit(depth % STRIDE))
        depth += 1
        kids = live.withColumns({c: now[c] for c in ("k1", "k2", "size")})
        left = F.col("n_turns") - depth
        stops = left == 0
        groups = kids.groupBy("node", "k1", "k2").agg(
            F.min("rep").alias("child"), F.sum("w").alias("n_convs"), F.count("*").alias("n_seqs"), F.min("size").alias("size"), F.sum(left).alias("left"),
            F.min(F.when(stops, F.col("rep"))).alias("ender"), F.coalesce(F.sum(F.when(stops, F.col("w"))), F.lit(0).cast("long")).alias("ender_w"),
        )
        groups = checkpointed(groups.withColumn("kind", F.when(F.col("n_seqs") == 1, "chain").when((F.col("n_seqs") <= sequences) & (F.col("left") <= most_turns), "small").otherwise("large")))
        levels.append(groups.select("child", F.lit(depth).cast("long").alias("depth"), "node", "n_convs", ((F.col("n_convs") - 1) * F.col("size")).alias("saved"), "ender", "ender_w"))
        named = kids.drop("size").join(small_side(groups.select("node", "k1", "k2", "child", "kind")), ["node", "k1", "k2"])
        named = checkpointed(named.select("rep", "w", "n_turns", "ahead", F.col("child").alias("node"), "kind").filter(F.col("n_turns") > depth))
        chains.append(named.filter("kind = 'chain'").select("rep", "node", F.lit(depth).cast("long").alias("depth")))
        smalls.append(named.filter("kind = 'small'").select("rep", "node", F.lit(depth).cast("long").alias("depth")))
        seen = {r["kind"]: r["left"] for r in groups.groupBy("kind").agg(F.sum("left").alias("left")).collect()}
        rest += seen.get("small") or 0
        if not seen.get("large"):
            break
        live = named.filter("kind = 'large'").drop("kind")
    one = lambda parts: reduce(DataFrame.unionByName, parts)
    buckets = max(MIN_BUCKETS, -(-rest // BUCKET_TURNS))
    bucket = F.pmod(F.xxhash64("node", "depth"), F.lit(buckets)).alias("bucket")
    below = turns.join(one(smalls), "rep").filter("pos > depth").select(bucket, "node", "depth", "rep", "w", "pos", "k1", "k2", "size")
    lower = checkpointed(one([chained(one(chains), turns), below.groupBy("bucket").applyInArrow(lean(grown), NODE)]))
    tops = lower.filter("top").groupBy(F.col("parent_conv_id").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved_below"))
    upper = _rolled_up(levels, checkpointed(tops))
    nodes = checkpointed(upper.unionByName(lower.drop("top")))
    several = listed_hashes(members.filter("w > 1"))
    hashed = nodes.filter("ender_w > 1").join(several.withColumnRenamed("rep", "ender"), "ender")
    alone = nodes.filter("ender_w <= 1").withColumn("ends_sha256", F.sha2(F.coalesce(F.col("ender").cast("string"), F.lit("")).cast("binary"), 256))
    return alone.unionByName(hashed).drop("ender", "ender_w")


def _rolled_up(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The levels of the loop, joined upwards from the deepest."""
    done, kids = [], None
    for depth in range(len(levels) - 1, -1, -1):
        offers = tops.filter(F.col("depth") == depth).drop("depth")
        if kids is not None:
            offers = offers.unionByName(kids.groupBy(F.col("parent_conv_id").alias("node")).agg(F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved_below")))
        offers = offers.groupBy(F.col("node").alias("child")).agg(F.sum("n").alias("n"), F.sum("leaves").alias("leaves"), F.sum("saved_below").alias("saved_below"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
        kids = checkpointed(
            levels[depth].join(offers, "child", "left").select(
                F.col("child").alias("conv_id"), "depth", F.col("node").alias("parent_conv_id"), "n_convs", zero("n").alias("n_children"), F.greatest(zero("leaves"), F.lit(1).cast("long")).alias("n_leaves"),
                (F.col("saved") + zero("saved_below")).alias("saved_tokens"), "ender", "ender_w",
            )
        )
        done.append(kids)
    return reduce(DataFrame.unionByName, done)


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = checkpointed(ordered_turns(read(spark, sf_dir, "conversations")))
    return prefix_trie(*rebuilt(turns))
