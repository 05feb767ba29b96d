"""Operators 11 to 13 against brute force."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import covertree, repair, turntrie

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
FACTS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def extra(df):
    """Columns whose names the operators use inside."""
    return df.withColumns({c: F.lit("x") for c in ("pos", "node", "k1", "size", "lost", "fault", "tag", "rid", "cell", "floor")})


def untied(rows):
    seen = {}
    for r in rows:
        seen.setdefault(r[:2], r)
    return list(seen.values())


def nodes_of(df, **bounds):
    return sorted((tuple(r) for r in turntrie.prefix_trie(*turntrie.rebuilt(turntrie.ordered_turns(df)), **bounds).select(*NODE).collect()), key=lambda r: r[:2])


def odd_conversations(rng, n=500):
    rows = [(rng.randrange(-20, 60) if rng.random() > 0.03 else None, rng.choice([None, *range(9)]), rng.choice([None, "", "user", "system"]), rng.choice(["a", "b", None, "é"])) for _ in range(n)]
    return untied(rows) + [(1000 + k, t, "user", "same") for k in range(30) for t in range(20 if k % 3 else 18)]


def test_trie_of_the_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in turntrie.op11_conversation_prefix_trie(spark, small).select(*NODE).collect()), key=lambda r: r[:2])
    assert got == brute.prefix_trie(rows)


@pytest.mark.parametrize("bounds", [{}, {"sequences": 3, "most_turns": 9}])
def test_trie_of_odd_rows(spark, bounds, monkeypatch):
    """Within tasks, and with nodes that go through the levels in Spark and lists in pieces."""
    if bounds:
        monkeypatch.setattr(turntrie, "STRIDE", 2)
        monkeypatch.setattr(turntrie, "PIECE", 4)
    rows = odd_conversations(random.Random(1))
    if bounds:  # fewer levels: each is some Spark jobs
        rows = [r for r in rows if r[0] is not None and (r[1] or 0) < 4]
    assert nodes_of(extra(spark.createDataFrame(rows, TURNS)), **bounds) == brute.prefix_trie(rows)


def test_trie_without_rows_and_with_ties(spark):
    none = spark.createDataFrame([(None, 1, "user", "a")], TURNS)
    assert nodes_of(none) == [] == nodes_of(none.limit(0))
    tied = spark.createDataFrame([(5, 1, "user", "b"), (5, 1, "user", "b"), (5, 1, "assistant", "a")], TURNS)
    got = nodes_of(tied)
    assert got == nodes_of(tied.orderBy(F.desc("role"))) and [r[1] for r in got] == [0, 1, 2, 3]


def test_a_very_long_conversation(spark):
    n = 20_000
    rows = spark.range(2).crossJoin(spark.range(n).withColumnRenamed("id", "turn")).select(F.col("id").alias("conv_id"), "turn", F.lit("user").alias("role"), F.col("turn").cast("string").alias("text"))
    got = turntrie.prefix_trie(*turntrie.rebuilt(turntrie.ordered_turns(rows)))
    # conversation 1 shares its first turns with 0, and goes on with the same ones
    assert got.agg(F.count("*"), F.max("depth"), F.min("n_convs"), F.max("n_leaves")).first()[:] == (n + 1, n, 2, 1)


def test_repair_dp_equals_shortest_path():
    rng = random.Random(0)
    for _ in range(3000):
        turns = [(rng.choice("suaax"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(12))]
        assert repair.repair(bytes("suax".index(x) + 4 * f for x, f in turns)) == brute.cheapest_edits(turns)


def test_repair_of_the_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in repair.op12_conversation_structure_repair(spark, small).select(*FACTS).collect()), key=brute.NULLS_LAST)
    assert got == brute.repaired(rows)


def test_repair_of_odd_rows(spark):
    rng = random.Random(2)
    roles, texts = [None, "", "user", "assistant", "assistant", "system", "tool"], [None, "", "a.", "b", "c! ", "x\n", "d? ", "é."]
    rows = untied([(rng.choice([None, *range(-3, 40)]), rng.choice([None, *range(400)]), rng.choice(roles), rng.choice(texts)) for _ in range(600)])
    rows += [(77, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(3000)]
    rows += [(78, -(1 << 63), "user", "first."), (78, (1 << 63) - 1, "assistant", "z" * 300_000 + ".")]
    want = brute.repaired(rows)
    damage = repair.damaged(extra(spark.createDataFrame(rows, TURNS)))
    got = sorted((tuple(r) for r in repair.repaired(damage).select(*FACTS).collect()), key=brute.NULLS_LAST)
    most = (1 << 63) - 1
    assert got == [(c, min(g, most), *rest) for c, g, *rest in want]
    turns = {}
    for r in repair.repaired_turns(damage).collect():
        turns.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    assert {c: brute.sha("\n".join(x for _, x in sorted(v))) for c, v in turns.items()} == {r[0]: r[-1] for r in want if set(r[-2]) - {"D"}}


def test_repair_of_ties_and_of_no_rows(spark):
    tied = spark.createDataFrame([(9, 3, "user", "b."), (9, 3, "user", "b."), (9, 3, "assistant", "a."), (9, None, "system", "s.")], TURNS)
    one, two = (repair.repaired(repair.damaged(x)).collect() for x in (tied, tied.orderBy(F.desc("role"))))
    assert one == two and len(one) == 1
    assert repair.repaired(repair.damaged(tied.limit(0))).collect() == []


def products_of(df, **bounds):
    return sorted((tuple(r) for r in covertree.nearest_by_product(df, **bounds).collect()), key=brute.by_rank)


def test_products_of_the_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = sorted((tuple(r) for r in covertree.op13_exact_topk_search(spark, small).collect()), key=brute.by_rank)
    assert got == brute.top_products(rows)


def test_products_of_odd_vectors(spark):
    """Ties, copies, nulls, other lengths and numbers beyond a long; many small blocks and groups."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(c % 4 * 3, 1) for c in range(6)] if i % 5 else [float(i % 3), 1.0, 2.0, 0.0, 0.0, 1.0]) for i in range(600)]
    nan, inf = float("nan"), float("inf")
    rows += [(None, [1.0] * 6), (50, [1.0] * 6), (50, [1.0] * 6), (701, None), (700, [nan] * 6), (750, [None, *[1.0] * 5]), (752, [inf, *[1.0] * 5]), (800, [1.0, 2.0]), (801, [2.0, 1.0]), (850, []), (900, [1e30] + [0.0] * 5), (901, [1e200] + [0.0] * 5)]
    got = products_of(extra(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), block_values=600, group_values=60)
    assert got == brute.top_products(rows)
    assert covertree.nearest_by_product(spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>").limit(0)).collect() == []


def test_pairs_of_far_nodes_are_dropped(monkeypatch):
    """Leaves far below the k-th score are not multiplied, and the result stays that of all pairs."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-3000, 3000, (12, 8))
    x = (centres[rng.integers(0, 12, 4000)] + rng.integers(-40, 40, (4000, 8))).astype(float)
    import pyarrow as pa

    def side(rows, leaf):
        table = pa.table({"rid": pa.array(rows), "vec_id": pa.array(rows), "vector": [covertree.packed(x[r][None, :]) for r in rows]})
        return covertree.Side.of(covertree.Side.built(table, leaf)[0])

    data, asks = side(np.arange(4000), 32), side(np.arange(0, 4000, 50), 8)
    found = covertree.Search(asks, data, np.full(80, covertree.LOWEST), 5)
    seen, leaves = [0], found.leaves
    monkeypatch.setattr(found, "leaves", lambda node, d: (seen.__setitem__(0, seen[0] + (asks.end[node] - asks.start[node]) * (data.end[d] - data.start[d])), leaves(node, d)))
    found.run()
    s = (asks.x @ data.x.T).astype(np.int64)
    s[asks.rid[:, None] == data.rid[None, :]] = covertree.LOWEST
    assert (np.sort(s, axis=1)[:, :-6:-1] == found.score).all()
    assert seen[0] < 0.5 * s.size


@pytest.mark.parametrize("name", ["op11_conversation_prefix_trie", "op12_conversation_structure_repair", "op13_exact_topk_search"])
def test_query_equals_its_sql(name, spark, small):
    import duckdb

    import __spark_entry__ as entry
    from quillon.llm import queries

    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    got, want = entry.queries()[name](spark, small), con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(repr(tuple(r)) for r in got.select(*want.columns).collect()) == sorted(map(repr, want.fetchall()))
