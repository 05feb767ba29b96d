"""Operator 13: exact top-k inner products by dual-tree search over cover trees.

Queries and data are indexed by one tree whose top level is a net of pivots from a
bounded sample (``SAMPLE`` rows, for the shape of the tree and for first bounds
alone; every row is indexed).  A pivot's rows form blocks, its queries groups, and
each block and group gets the lower levels in flat arrays: a node is a run of rows
with a centre of its own and the radius that covers them; its children are a
greedy net, the first with the parent's centre.  For a query node with centre q and
radius r and a data node with centre p and radius s no inner product exceeds

    q.p + r |p| + s |q| + r s

and the pair is dropped where that is below the worst k-th score that any query of
the node has so far.  Pivot pairs are dropped the same way before anything moves, by
the sample's scores.  Surviving (group, block) pairs meet in one join on the block's
key, leaves are multiplied as matrices, and each pair sends at most k rows a query.
Blocks, groups and trees are bounded; a pivot that a third of all rows is nearest
to has as many blocks as it needs, so no cell is a group of any task.

Numbers: components are floor(256 x).  Products run in 32-bit floats where all norms
show every sum below 2^24, in 64-bit ones below 2^53, else in unbounded integers;
so scores are exact.  Scores beyond a long are its ends.

Cases: null vectors and those with a null or non-finite component (also after the
factor) take no part; vectors are compared with those of their own length, empty
ones have score 0; a repeated vec_id is a row and, if it qualifies, a query like any
other, and a query leaves out its own row alone; a null vec_id is no query, and as
a candidate comes after others of its score; with fewer candidates all are ranked;
an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clusterio import checkpointed, lean, read, small_side

K, EVERY, SCALE = 5, 50, 256.0
#: Rows and components that the sample has at most.
SAMPLE, SAMPLE_VALUES = 2048, 1 << 20
#: Components of a block and of a group; pivots of a length.
BLOCK_VALUES, GROUP_VALUES = 1 << 22, 1 << 21
MIN_CELLS, MAX_CELLS, CELL_ROWS = 16, 512, 1 << 16
#: Rows of a leaf of data and of queries; children of a node.
LEAF, QUERY_LEAF, FAN = 512, 128, 16
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


# --- numbers ----------------------------------------------------------------------------
def whole(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(SCALE * vectors.astype(np.float64))


def packed(x: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of 2, 4 and 8 bytes; 4 and 8 are floats."""
    most = np.abs(x).max(initial=0)
    kind = np.int16 if most < 1 << 15 else np.float32 if most <= 1 << 24 else np.float64
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    kind = {2: np.int16, 4: np.float32, 8: np.float64}[data[0]]
    x = np.frombuffer(data, kind, offset=1)
    return x.reshape(rows, len(x) // rows).astype(np.float64)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def number_kind(q_norm: float, p_norm: float):
    top = q_norm * p_norm * 1.001 + 1
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else object


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products of rows that are already of the kind they need."""
    if q.dtype == object:
        return np.array([[min(HIGHEST, max(LOWEST, sum(int(a) * int(b) for a, b in zip(x, y, strict=True)))) for y in p] for x in q], np.int64).reshape(len(q), len(p))
    return q @ p.T


# --- trees ------------------------------------------------------------------------------
def net(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(centres, nearest): a greedy net from row 0, each centre the row farthest from those before it.

    It ends at ``most`` centres or where half the first radius covers all rows.
    """
    centres, near = [0], np.zeros(len(x), np.int64)
    far = norms(x - x[0])
    stop = far.max() / 2
    while len(centres) < most and far.max() > stop:
        centres.append(int(far.argmax()))
        d = norms(x - x[centres[-1]])
        closer = d < far
        near[closer], far = len(centres) - 1, np.minimum(far, d)
    return np.array(centres), near


def tree(x: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, nodes, radii) of a cover tree.

    A node is (start, end, first child, children): a run of ``order`` whose first
    row is its centre.  A first child has its parent's centre, so that holds
    however the run is ordered below.
    """
    order = np.arange(len(x))
    nodes, radii = [[0, len(x), 0, 0]], [float(norms(x - x[0]).max())]
    k = 0
    while k < len(nodes):
        start, end = nodes[k][:2]
        if end - start > leaf and radii[k] > 0:
            rows = order[start:end]
            own = x[rows]
            centres, near = net(own, FAN)
            nodes[k][2:] = len(nodes), len(centres)
            runs = []
            for j, c in enumerate(centres):
                run = np.flatnonzero(near == j)
                run = np.concatenate([[c], run[run != c]])
                a = start + sum(map(len, runs))
                nodes.append([a, a + len(run), 0, 0])
                radii.append(float(norms(own[run] - own[c]).max()))
                runs.append(run)
            order[start:end] = rows[np.concatenate(runs)]
        k += 1
    return order, np.array(nodes, np.int64).reshape(-1, 4), np.array(radii)


class Side:
    """The rows of a block or a group in the order of their tree."""

    def __init__(self, x: np.ndarray, rid: np.ndarray, vec_id: np.ndarray, unnamed: np.ndarray, nodes: np.ndarray, radii: np.ndarray):
        self.x, self.rid, self.vec_id, self.unnamed, self.nodes, self.radii = x, rid, vec_id, unnamed, nodes, radii
        self.start, self.end, self.child, self.kids = nodes.T
        self.centres = x[self.start]
        self.norms = norms(self.centres)
        self.most = float(norms(x).max(initial=0))

    @staticmethod
    def built(rows: pa.Table, leaf: int) -> dict:
        """Columns of a packed side from its rows (rid, vec_id, vector)."""
        n = rows.num_rows
        vectors = rows["vector"].to_pylist()
        x = np.stack([unpacked(v, 1)[0] for v in vectors])
        order, nodes, radii = tree(x, leaf)
        vec_id = rows["vec_id"].combine_chunks()
        ids, unnamed = vec_id.fill_null(0).to_numpy(zero_copy_only=False)[order], vec_id.is_null().to_numpy(zero_copy_only=False)[order]
        return {"n": n, "vectors": packed(x[order]), "rids": rows["rid"].to_numpy()[order].tobytes(), "ids": ids.astype(np.int64).tobytes(), "unnamed": unnamed.tobytes(), "nodes": nodes.tobytes(), "radii": radii.tobytes()}, x, radii

    @classmethod
    def of(cls, row: dict, prefix: str = "") -> Side:
        get = lambda c, kind: np.frombuffer(row[prefix + c], kind)
        return cls(unpacked(row[prefix + "vectors"], row[prefix + "n"]), get("rids", np.int64), get("ids", np.int64), get("unnamed", bool), get("nodes", np.int64).reshape(-1, 4), get("radii", np.float64))


def bounds(q: np.ndarray, q_norm: float, q_radius: float, p: np.ndarray, p_norms: np.ndarray, p_radii: np.ndarray) -> np.ndarray:
    """At least the inner product of any row in reach of q with any in reach of each p."""
    most = q_radius * p_norms + p_radii * q_norm + q_radius * p_radii
    return p @ q + most + 1e-9 * (q_norm * p_norms + most) + 1e-6


class Search:
    """Top k of a group's queries over one block."""

    def __init__(self, queries: Side, data: Side, floor: np.ndarray, k: int):
        self.q, self.p, self.k = queries, data, k
        kind = number_kind(queries.most, data.most)
        self.qx, self.px = queries.x.astype(kind), data.x.astype(kind)
        n = len(queries.x)
        self.kth = floor.copy()
        self.score, self.row = np.full((n, k), LOWEST), np.full((n, k), -1)

    def worst(self, node: int) -> int:
        return self.kth[self.q.start[node] : self.q.end[node]].min()

    def run(self) -> None:
        self.visit(0, np.zeros(1, np.int64))

    def visit(self, node: int, frontier: np.ndarray) -> None:
        q, p = self.q, self.p
        while True:
            reach = bounds(q.centres[node], q.norms[node], q.radii[node], p.centres[frontier], p.norms[frontier], p.radii[frontier])
            kept = reach >= self.worst(node)
            frontier, reach = frontier[kept], reach[kept]
            inner = p.kids[frontier] > 0
            if q.kids[node]:
                below = np.concatenate([frontier[~inner], *[np.arange(p.child[d], p.child[d] + p.kids[d]) for d in frontier[inner]]])
                for child in range(q.child[node], q.child[node] + q.kids[node]):
                    self.visit(child, below)
                return
            if not inner.any():
                break
            frontier = np.concatenate([frontier[~inner], *[np.arange(p.child[d], p.child[d] + p.kids[d]) for d in frontier[inner]]])
        for d, most in sorted(zip(frontier.tolist(), reach.tolist(), strict=True), key=lambda x: -x[1]):
            if most >= self.worst(node):
                self.leaves(node, d)

    def leaves(self, node: int, d: int) -> None:
        a, b, c, e = self.q.start[node], self.q.end[node], self.p.start[d], self.p.end[d]
        s = products(self.qx[a:b], self.px[c:e])
        qi, pi = np.nonzero(s >= self.kth[a:b, None])
        own = self.q.rid[a + qi] == self.p.rid[c + pi]
        qi, pi = qi[~own], pi[~own]
        if not len(qi):
            return
        who = np.unique(qi)
        held = self.row[a + who]
        full = held >= 0
        query = np.concatenate([qi, np.repeat(who, full.sum(axis=1))])
        row = np.concatenate([c + pi, held[full]])
        score = np.concatenate([s[qi, pi].astype(np.int64), self.score[a + who][full]])
        order = np.lexsort((self.p.vec_id[row], self.p.unnamed[row], ~score, query))
        query, row, score = query[order], row[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        top = place < self.k
        query, row, score, place = query[top], row[top], score[top], place[top]
        self.score[a + who], self.row[a + who] = LOWEST, -1
        self.score[a + query, place], self.row[a + query, place] = score, row
        last = place == self.k - 1
        self.kth[a + query[last]] = np.maximum(self.kth[a + query[last]], score[last])


# --- Spark ------------------------------------------------------------------------------
_ROW = "dim int, cell int, rid long, vec_id long, floor long, vector binary"
_SIDE = "n long, vectors binary, rids binary, ids binary, unnamed binary, nodes binary, radii binary"
_FOUND = "qid long, query_id long, vec_id long, score long"


def pivots_of(vectors: DataFrame, cells: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Of each length in the sample: the pivots and the sample's whole numbers.

    The sample is the rows of least hash, ``SAMPLE`` at most and fewer of long
    vectors; it shapes the tree and gives first bounds.
    """
    widest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1
    rows = vectors.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(max(16, min(SAMPLE, SAMPLE_VALUES // max(1, widest)))).collect()
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r["embedding"]), []).append(r["embedding"])
    out = {}
    for dim, own in by_dim.items():
        x = whole(np.array(own, np.float64).reshape(len(own), dim))
        out[dim] = x[net(x, cells)[0]], x
    return out


def assigned(vectors: DataFrame, pivots: dict, k: int, every: int) -> DataFrame:
    """Every row with its cell; floor (queries only): a score that k other rows reach.

    The floor is the (k + 1)-th best score over the sample, so it holds with the
    query's own row taken out.
    """

    def run(batches):
        for batch in batches:
            lists = batch["embedding"]
            size = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(size)])
            ids, rid = batch["vec_id"], batch["rid"].to_numpy()
            unnamed = ids.is_null().to_numpy(zero_copy_only=False)
            asks = ~unnamed & (ids.fill_null(1).to_numpy(zero_copy_only=False) % every == 0)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                x = whole(flat[first[at][:, None] + np.arange(dim)])
                finite = np.isfinite(x).all(axis=1)
                at, x = at[finite], x[finite]
                p, sample = pivots.get(int(dim), (np.zeros((1, dim)), np.zeros((0, dim))))
                with np.errstate(over="ignore", invalid="ignore"):
                    cell = (np.einsum("ij,ij->i", p, p)[None, :] - 2 * (x @ p.T)).argmin(axis=1)
                floor = np.full(len(at), LOWEST)
                if len(sample) > k and asks[at].any():
                    kind = number_kind(norms(x[asks[at]]).max(), norms(sample).max())
                    s = products(x[asks[at]].astype(kind), sample.astype(kind))
                    floor[asks[at]] = np.partition(s, -k - 1, axis=1)[:, -k - 1].astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array(np.full(len(at), dim), pa.int32()), "cell": pa.array(cell, pa.int32()), "rid": pa.array(rid[at]), "vec_id": ids.take(pa.array(at)).cast(pa.int64()),
                    "floor": pa.array(floor, pa.int64(), mask=~asks[at]), "vector": pa.array([packed(v[None, :]) for v in x], pa.binary()),
                })

    return vectors.select("vec_id", "embedding", F.monotonically_increasing_id().alias("rid")).mapInArrow(run, _ROW)


def blocks_of(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """(dim, cell, salt, ...): the packed trees of all rows, and what bounds a cell."""

    def build(group: pa.Table) -> pa.Table:
        side, x, radii = Side.built(group, LEAF)
        head = {c: group[c][:1] for c in ("dim", "cell", "salt")}
        return pa.table({**head, **{c: [v] for c, v in side.items()}, "radius": [float(radii[0])], "centre": pa.array([x[0].tolist()], pa.list_(pa.float64()))})

    salted = rows.join(small_side(cells.select("dim", "cell", "n_blocks")), ["dim", "cell"]).withColumn("salt", F.pmod(F.xxhash64("rid"), "n_blocks").cast("int"))
    return salted.select("dim", "cell", "salt", "rid", "vec_id", "vector").groupBy("dim", "cell", "salt").applyInArrow(lean(build), f"dim int, cell int, salt int, {_SIDE}, radius double, centre array<double>")


def groups_of(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """(g, dim, ...): packed trees of queries; neighbouring cells share a group while they fit."""

    def build(group: pa.Table) -> pa.Table:
        side, x, radii = Side.built(group, QUERY_LEAF)
        order = np.frombuffer(side["rids"], np.int64)
        by_rid = dict(zip(group["rid"].to_pylist(), group["floor"].to_pylist(), strict=True))
        floors = np.array([by_rid[r] for r in order.tolist()], np.int64)
        return pa.table({"dim": group["dim"][:1], "g": group["g"][:1], **{c: [v] for c, v in side.items()}, "floors": [floors.tobytes()], "worst": [int(floors.min())], "radius": [float(radii[0])], "centre": pa.array([x[0].tolist()], pa.list_(pa.float64()))})

    asks = rows.filter("floor is not null").join(small_side(cells.select("dim", "cell", "first_group", "n_groups")), ["dim", "cell"])
    asks = asks.withColumn("g", (F.col("first_group") + F.pmod(F.xxhash64("rid"), "n_groups")).cast("long"))
    return asks.select("dim", "g", "rid", "vec_id", "vector", "floor").groupBy("dim", "g").applyInArrow(lean(build), f"dim int, g long, {_SIDE}, floors binary, worst long, radius double, centre array<double>")


def _norm(v):
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def nearest_by_product(vectors: DataFrame, k: int = K, every: int = EVERY, block_values: int = BLOCK_VALUES, group_values: int = GROUP_VALUES, min_cells: int = MIN_CELLS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose vec_id ``every`` divides."""
    number = F.col("embedding")
    sound = number.isNotNull() & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = vectors.filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    n = vectors.count()
    pivots = pivots_of(vectors, max(min_cells, min(MAX_CELLS, n // CELL_ROWS)))
    rows = checkpointed(assigned(vectors, pivots, k, every))
    # one row per cell: at most MAX_CELLS of a length
    cells = rows.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.count("floor").alias("n_queries"))
    before = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    width = F.greatest(F.col("dim"), F.lit(1))
    per = lambda c, values: F.greatest(F.ceil(F.col(c) * width / values), F.lit(1)).cast("long")
    cells = cells.withColumn("n_blocks", per("n", block_values)).withColumn("n_groups", per("n_queries", group_values))
    cells = checkpointed(cells.withColumn("first_group", F.floor(F.coalesce(F.sum("n_queries").over(before), F.lit(0)) * width / group_values)))
    blocks = checkpointed(blocks_of(rows, cells))
    groups = checkpointed(groups_of(rows, cells))
    # pivot pairs: every group against the blocks' centres of its length, by the same bound
    tops = blocks.select("dim", "cell", "salt", F.col("centre").alias("p"), F.col("radius").alias("s"), _norm("centre").alias("p_norm"))
    heads = groups.select("dim", "g", "worst", F.col("centre").alias("q"), F.col("radius").alias("r"), _norm("centre").alias("q_norm"))
    dot = F.aggregate(F.zip_with("q", "p", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    most = F.col("r") * F.col("p_norm") + F.col("s") * F.col("q_norm") + F.col("r") * F.col("s")
    bound = dot + most + 1e-9 * (F.col("q_norm") * F.col("p_norm") + most) + 1e-6
    pairs = heads.join(tops, "dim").filter(bound >= F.col("worst")).select("dim", "g", "cell", "salt")
    asked = groups.drop("radius", "centre", "worst").withColumnsRenamed({c: f"q_{c}" for c in ("n", "vectors", "rids", "ids", "unnamed", "nodes", "radii")})
    met = blocks.drop("radius", "centre").join(pairs, ["dim", "cell", "salt"]).join(asked, ["dim", "g"])

    def search(pair: pa.Table) -> pa.Table:
        row = pair.slice(0, 1).to_pylist()[0]
        found = Search(Side.of(row, "q_"), data := Side.of(row), np.frombuffer(row["floors"], np.int64), k)
        found.run()
        q, place = np.nonzero(found.row >= 0)
        at = found.row[q, place]
        return pa.table({"qid": found.q.rid[q], "query_id": found.q.vec_id[q], "vec_id": pa.array(data.vec_id[at], pa.int64(), mask=data.unnamed[at]), "score": found.score[q, place]})

    best = met.groupBy("dim", "g", "cell", "salt").applyInArrow(lean(search), _FOUND)
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last()))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op13_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_by_product(read(spark, sf_dir, "embeddings"))
