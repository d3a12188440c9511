"""Approximate nearest neighbours by largest inner product: a forest of
random-projection trees, searched through one priority queue for all trees.

Trees are fitted on a bounded sample; every row is indexed. A vector x becomes
(x, sqrt(M^2 - |x|^2)) with M the greatest norm, and a query (q, 0), so the
largest inner product is the smallest angle. All nodes of one level of a tree
share a direction and have their own cuts. A query walks all trees best first:
one queue holds nodes of every tree by how far the query lies on the wrong side
of the cuts above them, and the first leaves that it yields are searched. Leaves
and their queries meet in cells of bounded size; each cell scores its rows
exactly and keeps the best of each query.

How many trees, how deep, and how many leaves a query searches is measured: for
some vectors of the sample the nearest others are found by brute force, and of
all shapes in which the queue reaches ``recall`` of them the one that scores
and sends the fewest rows is taken. In a sample the nearest lie farther off than
in the whole table, which makes the measure a cautious one.

Equal vectors are one class with its smallest ids, so a very common vector is
indexed and searched once.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import bounded_batches, written

#: most trees; half and a quarter of them are tried too
TREES = 8
#: share of the sample's nearest that a query must reach
RECALL = 0.95
#: least rows of a leaf, and the depth that bounds the number of cuts
LEAF_ROWS = 100
MAX_DEPTH = 12
#: vectors that the trees are fitted on, at most SAMPLE_BYTES of them, and how
#: many of these are asked to measure recall
SAMPLE = 65_536
SAMPLE_BYTES = 64 << 20
ASKED = 128
#: what sending a query to a leaf costs, in rows scored
SEND = 50
#: rows and queries that meet in one cell
CELL_ROWS = 4096
CELL_QUERIES = 4096


class Forest:
    """Directions of the levels of all trees (trees, depth, dims) and cuts of
    their nodes (trees, 2**depth - 1), medians of the sample's members."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.depth, self.trees = depth, trees
        normals = rng.normal(size=(trees, depth, sample.shape[1]))
        self.normals = normals / np.linalg.norm(normals, axis=2, keepdims=True)
        self.cuts = np.zeros((trees, (1 << depth) - 1))
        for t in range(trees):
            place = np.zeros(len(sample), np.int64)
            for level in range(depth):
                side = sample @ self.normals[t, level]
                order = np.lexsort((side, place))
                begins = np.searchsorted(place[order], np.arange((1 << level) + 1))
                first, size = begins[:-1], np.diff(begins)
                middle = side[order[np.minimum(first + size // 2, len(sample) - 1)]]
                self.cuts[t, (1 << level) - 1:(2 << level) - 1] = np.where(size > 0, middle, 0.0)
                place = 2 * place + (side > self.cuts[t, (1 << level) - 1 + place])

    def cut_down(self, depth: int, trees: int) -> Forest:
        """The first levels of the first trees."""
        out = object.__new__(Forest)
        out.depth, out.trees = depth, trees
        out.normals, out.cuts = self.normals[:trees, :depth], self.cuts[:trees, :(1 << depth) - 1]
        return out

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point in each tree: (points, trees)."""
        out = np.empty((len(points), self.trees), np.int32)
        for t in range(self.trees):
            side = points @ self.normals[t].T
            place = np.zeros(len(points), np.int64)
            for level in range(self.depth):
                place = 2 * place + (side[:, level] > self.cuts[t, (1 << level) - 1 + place])
            out[:, t] = place
        return out

    def probes(self, points: np.ndarray, most: int) -> list[list[tuple[int, int]]]:
        """The first ``most`` (tree, leaf) that the shared queue yields for each point."""
        sides = np.einsum("nd,tkd->ntk", points, self.normals).tolist()
        cuts, inner, out = self.cuts.tolist(), (1 << self.depth) - 1, []
        for side in sides:
            queue = [(0.0, t, 0, 0) for t in range(self.trees)]
            found = []
            while queue and len(found) < most:
                wrong, t, node, level = heapq.heappop(queue)
                if node >= inner:
                    found.append((t, node - inner))
                    continue
                m = side[t][level] - cuts[t][node]
                heapq.heappush(queue, (max(wrong, m), t, 2 * node + 1, level + 1))
                heapq.heappush(queue, (max(wrong, -m), t, 2 * node + 2, level + 1))
            out.append(found)
        return out


def measured(points: np.ndarray, raised: np.ndarray, rows: int, k: int, trees: int = TREES,
             recall: float = RECALL, leaf_rows: int = LEAF_ROWS) -> tuple[Forest, int]:
    """The forest over the sample ``points`` (``raised``: their last component)
    and the number of leaves to search in a table of ``rows`` vectors."""
    n = len(points)
    deepest = min(MAX_DEPTH, int(math.log2(max(1, n / 16))), max(0, math.ceil(math.log2(max(1, rows) / leaf_rows))))
    up = np.column_stack([points, raised])
    forest = Forest(up, deepest, trees)
    if deepest == 0:
        return forest, trees
    asked = np.arange(min(ASKED, n))
    score = points[asked] @ points.T
    score[asked, asked] = -math.inf
    k = min(k, n - 1)
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    places = forest.leaves(up)[near]  # (asked, k, trees)
    flat = np.column_stack([points[asked], np.zeros(len(asked))])
    sides = np.einsum("nd,tkd->ntk", flat, forest.normals)
    wrong, best = np.zeros((len(asked), trees, 1)), None
    for depth in range(1, deepest + 1):
        m = sides[:, :, depth - 1, None] - forest.cuts[None, :, (1 << depth - 1) - 1:(1 << depth) - 1]
        wrong = np.stack([np.maximum(wrong, m), np.maximum(wrong, -m)], axis=3).reshape(len(asked), trees, -1)
        own = places >> (deepest - depth)
        at = np.take_along_axis(wrong, own.transpose(0, 2, 1), 2)  # (asked, trees, k)
        for some in sorted({max(1, trees // 4), max(1, trees // 2), trees}):
            queue = np.sort(wrong[:, :some].reshape(len(asked), -1), axis=1)
            # leaves that the queue yields up to and with the first that holds the neighbour
            turn = np.array([np.searchsorted(q, a, side="right") for q, a in zip(queue, at[:, :some].min(axis=1))])
            most = max(some, int(np.sort(turn.reshape(-1))[math.ceil(recall * turn.size) - 1]))
            leaf = rows / (1 << depth)
            cost = most * (leaf + SEND * math.ceil(leaf / CELL_ROWS))
            if best is None or cost < best[0]:
                best = cost, depth, some, most
    _, depth, some, most = best
    return forest.cut_down(depth, some), most


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1) if len(flat) else np.empty((0, 0))


def classes(df: DataFrame, id_col: str, vector_col: str, keep: int, every: int) -> DataFrame:
    """Distinct usable vectors: class_id (least id), vector, its ``keep``
    smallest ids, and whether a query is among its rows. The ids of a common
    vector are first cut to the smallest in 64 parts of its rows."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False))
                   & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))))
    part = (rows.groupBy("vector", F.pmod(F.xxhash64("id"), F.lit(64)).alias("_part"))
            .agg(F.slice(F.sort_array(F.collect_set("id")), 1, keep).alias("ids"), F.max((F.col("id") % every == 0)).alias("asks")))
    return (part.groupBy("vector").agg(
        F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"),
        F.max("asks").alias("asks"))
        .select(F.col("ids")[0].alias("class_id"), "vector", "ids", "asks"))


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20,
            trees: int = TREES, recall: float = RECALL, leaf_rows: int = LEAF_ROWS,
            sample: int = SAMPLE) -> DataFrame:
    """The k nearest found of every row whose id is divisible by ``every``:
    query_id, rank (from 1), vec_id, score.

    Rows with a null id, and vectors null, empty, zero or with a null or
    non-finite component take no part. Vectors of a length other than the most
    common one take no part either. A repeated row counts once; an id with
    several vectors is a candidate with each. Equal scores: the smaller id
    first. Fewer usable rows than k: all of them. An empty table has no result.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    found = written(classes(df, id_col, vector_col, k + 1, every), "vectors")
    sizes = found.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    out = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], out)
    dims, n = sizes["d"], sizes["n"]
    found = found.where(F.size("vector") == dims)
    norm2 = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    most = found.agg(F.max(norm2)).first()[0]
    picked = (found.orderBy(F.xxhash64("class_id"), "class_id").limit(max(ASKED, min(sample, SAMPLE_BYTES // (8 * dims))))
              .select("vector").toArrow())
    points = _matrix(picked.column(0))
    raised = np.sqrt(np.maximum(0.0, most - (points ** 2).sum(axis=1)))
    shape, probes = measured(points, raised, n, k, trees, recall, leaf_rows)
    trees, forest = shape.trees, spark.sparkContext.broadcast(shape)

    def index(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            up = np.sqrt(np.maximum(0.0, most - (x ** 2).sum(axis=1)))
            leaf = forest.value.leaves(np.column_stack([x, up]))
            rows = np.repeat(np.arange(len(x)), trees)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(trees, dtype=np.int32), len(x))), pa.array(leaf.reshape(-1)),
                 *[c.take(pa.array(rows)) for c in batch.columns]], names=["tree", "leaf", "class_id", "vector"])

    def ask(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                x = _matrix(part.column(1))
                got = forest.value.probes(np.column_stack([x, np.zeros(len(x))]), probes)
                rows = np.repeat(np.arange(len(x)), [len(g) for g in got])
                flat = np.array([p for g in got for p in g], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat[:, 0]), pa.array(flat[:, 1]), *[c.take(pa.array(rows)) for c in part.columns]],
                    names=["tree", "leaf", "class_id", "vector"])

    cell = "tree int, leaf int, class_id long, vector array<double>"
    members = found.select("class_id", "vector").mapInArrow(index, cell)
    asked = found.where("asks").select("class_id", "vector").mapInArrow(ask, cell)
    # cells of bounded size: a leaf's rows and its queries are dealt to blocks
    leaf_size = members.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("row_blocks"))
    ask_size = asked.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("ask_blocks"))
    blocks = F.broadcast(leaf_size.join(ask_size, ["tree", "leaf"]))  # at most trees * 2**MAX_DEPTH rows

    def dealt(rows, own, other, own_name, other_name):
        return (rows.join(blocks, ["tree", "leaf"])
                .withColumn(own_name, F.pmod(F.xxhash64("class_id"), F.col(own)).cast("int"))
                .withColumn(other_name, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select("tree", "leaf", "rb", "qb", "class_id", "vector"))

    keys = ["tree", "leaf", "rb", "qb"]
    here = dealt(members, "row_blocks", "ask_blocks", "rb", "qb").groupBy(*keys)
    there = dealt(asked, "ask_blocks", "row_blocks", "qb", "rb").groupBy(*keys)
    best_type = T.StructType([T.StructField("asker", T.LongType()), T.StructField("best", T.ArrayType(T.StructType([
        T.StructField("far", T.DoubleType()), T.StructField("class_id", T.LongType())])))])
    take = k + 1  # the query's own class is among them

    def score(rows: pa.Table, queries: pa.Table) -> pa.Table:
        x, q = _matrix(rows.column("vector")), _matrix(queries.column("vector"))
        ids = rows.column("class_id").to_numpy()
        # a few more than asked for: scores that are equal but for rounding are settled below
        m = min(len(x), take + 8) if len(q) else 0
        far, who = [], []
        for i in range(0, len(q) if m else 0, 256):
            part = q[i:i + 256]
            s = part @ x.T
            top = np.argpartition(-s, m - 1, axis=1)[:, :m] if m < len(x) else np.tile(np.arange(m), (len(s), 1))
            # the exact score, summed in one order wherever the pair meets
            exact = (x[top] * part[:, None, :]).sum(axis=2)
            order = np.lexsort((ids[top], -exact), axis=1)[:, :take]
            far.append(-np.take_along_axis(exact, order, 1).reshape(-1))
            who.append(ids[np.take_along_axis(top, order, 1)].reshape(-1))
        best = pa.StructArray.from_arrays([pa.array(np.concatenate(far) if far else np.empty(0)),
                                           pa.array(np.concatenate(who) if who else np.empty(0, np.int64))], ["far", "class_id"])
        offs = pa.array(np.arange(len(q) + 1, dtype=np.int32) * min(m, take))
        return pa.table({"asker": queries.column("class_id"), "best": pa.ListArray.from_arrays(offs, best)})

    cells = here.cogroup(there).applyInArrow(score, best_type)
    # sorted, a class found through several trees stands beside itself
    merged = cells.groupBy("asker").agg(F.sort_array(F.flatten(F.collect_list("best"))).alias("all"))
    fresh = F.filter("all", lambda b, i: (i == 0) | (F.get(F.col("all"), i - 1)["class_id"] != b["class_id"]))
    ranked = merged.select("asker", F.slice(fresh, 1, take).alias("best"))
    # classes back to ids: each has its k + 1 smallest
    pairs = (ranked.select("asker", F.inline("best")).join(found.select("class_id", "ids"), "class_id")
             .groupBy("asker").agg(F.slice(F.sort_array(F.flatten(F.collect_list(F.transform(
                 "ids", lambda x: F.struct("far", x.alias("id")))))), 1, take).alias("best")))
    vectors = found.where("asks").select(F.col("class_id").alias("asker"), "vector")
    askers = (df.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("vector"))
              .where(F.col("query_id") % every == 0).distinct().join(vectors, "vector").select("query_id", "asker"))
    # a query leaves itself out
    kept = (askers.join(pairs, "asker")
            .withColumn("best", F.slice(F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, k)))
    return kept.select("query_id", F.posexplode("best").alias("p", "b")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.far")).alias("score"))
