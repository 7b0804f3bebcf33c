"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample; leaves that get too many rows are split
further, each by its own rows, in a Spark job. A query visits leaves best bin
first, through a priority queue over the whole tree. How many it visits is
calibrated: for some queries the exact neighbours are computed over all vectors,
and visits widen until the leaves visited hold the wanted share of them.

For the search, neighbouring leaves share a cell of bounded size, packed as one
row; a block of queries is packed as well and sent once to every cell that holds
a leaf which one of them visits. A task meets pairs of a cell and a block: matrix
products over the visited leaves pick candidates, whose scores are then computed
exactly.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labormart.llm.common import settle

#: Vectors that the tree is fitted on, and those of them that share a leaf, at most.
SAMPLE_ROWS = 20_000
LEAF_SAMPLE = 48
BRANCHES = 8
#: A leaf with more rows than this is split by a sample of so many of its own rows ...
LEAF_ROWS = 4_096
SPLIT_ROWS = 1_024
#: ... while all centres of the tree take at most so many bytes; beyond that leaves grow instead.
TREE_BYTES = 64 << 20
#: Queries that calibrate, and as many again that measure; the share of true neighbours that visits must reach.
CALIBRATION_QUERIES = 128
WANTED_RECALL = 0.95
#: Bytes of the vectors of a cell, and queries of a block.
CELL_BYTES = 4 << 20
BLOCK_QUERIES = 512


@dataclass
class Tree:
    """Nodes in one array each; a leaf has a number, an inner node its children."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of every vector: the nearest child at each level, the first one of equals."""
        out = np.full(len(vectors), -1)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = np.array(self.children[node])
            centres = self.centres[kids]
            side = (0.5 * (centres**2).sum(1) - exact_products(vectors[rows], centres)).argmin(1)
            todo += [(int(k), rows[side == i]) for i, k in enumerate(kids) if (side == i).any()]
        return out

    def graft(self, splits: dict[int, "Tree"]) -> "Tree":
        """The tree with some leaves replaced by trees of their own; leaves are numbered anew, in order of the walk."""
        centres, children = list(self.centres), [list(c) for c in self.children]
        for node, leaf in enumerate(self.leaf):
            sub = splits.get(int(leaf)) if leaf >= 0 else None
            if sub is None or sub.n_leaves < 2:
                continue
            at = len(centres) - 1  # the sub-tree's root is this leaf
            centres += list(sub.centres[1:])
            children += [[k + at for k in c] for c in sub.children[1:]]
            children[node] = [k + at for k in sub.children[0]]
        return numbered(np.array(centres), children)

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first: the open node whose centre has the largest product comes next."""
        products = self.centres @ query
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
            for k in self.children[node]:
                heapq.heappush(queue, (-float(products[k]), k))


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in component order.

    Equal vectors get equal products wherever they stand, which a blocked
    matrix product does not promise; ties then go by id.
    """
    out = np.zeros((len(left), len(right)))
    for d in range(left.shape[1] if left.ndim == 2 else 0):
        out += left[:, d, None] * right[None, :, d]
    return out


def numbered(centres: np.ndarray, children: list[list[int]]) -> Tree:
    """A tree whose leaves are numbered along the walk, so that neighbours have neighbouring numbers."""
    leaf, todo, n = np.full(len(children), -1), [0], 0
    while todo:
        node = todo.pop()
        if children[node]:
            todo += reversed(children[node])
        else:
            leaf[node], n = n, n + 1
    return Tree(centres, children, leaf)


def fit_tree(sample: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_SAMPLE, rounds: int = 8, seed: int = 5) -> Tree:
    """Split nodes by k-means until a node has at most ``leaf_rows`` rows or equal ones only."""
    rng = np.random.default_rng(seed)
    centres, children = [sample.mean(0) if len(sample) else np.zeros(sample.shape[1])], [[]]
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        points = sample[rows]
        distinct = np.unique(points, axis=0) if len(rows) > leaf_rows else points[:1]
        if len(rows) <= leaf_rows or len(distinct) < 2:
            continue
        middles = distinct[rng.choice(len(distinct), min(branches, len(distinct)), replace=False)].copy()
        side = np.zeros(len(rows), np.int64)
        for _ in range(rounds):
            side = (0.5 * (middles**2).sum(1) - points @ middles.T).argmin(1)
            for k in np.unique(side):
                middles[k] = points[side == k].mean(0)
        used = np.unique(side)
        if len(used) < 2:
            continue
        for k in used:
            children[node].append(len(centres))
            todo.append((len(centres), rows[side == k]))
            centres.append(middles[k])
            children.append([])
    return numbered(np.array(centres), children)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def top_pairs(query_ids: np.ndarray, queries: np.ndarray, vec_ids: np.ndarray, vectors: np.ndarray, k: int, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, score)``: each query's ``k`` best rows but its own, ties to the smaller id.

    ``products`` are approximate, minus infinity where a query may not look; all
    that come near the k-th are candidates, and their scores are computed exactly.
    """
    products[vec_ids[None, :] == query_ids[:, None]] = -np.inf
    limit = np.full(len(query_ids), -np.inf)
    if products.shape[1] > k:
        limit = np.partition(products, products.shape[1] - k, axis=1)[:, products.shape[1] - k]
        limit -= 1e-9 * (1 + np.abs(np.where(np.isfinite(limit), limit, 0)))
    q, row = np.nonzero((products >= limit[:, None]) & np.isfinite(products))
    score = np.zeros(len(q))
    for d in range(queries.shape[1]):
        score += queries[q, d] * vectors[row, d]
    order = np.lexsort((vec_ids[row], -score, q))
    q, row, score = q[order], row[order], score[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], row[keep], score[keep]


def _few_copies(vec_ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows without those that can be nobody's neighbour: of equal vectors the k + 1 smallest ids, each once.

    Equal vectors have equal scores, and ties go to the smaller id.
    """
    _, group = np.unique(np.ascontiguousarray(vectors).view(f"V{vectors.shape[1] * 8}").ravel(), return_inverse=True)
    order = np.lexsort((vec_ids, group))
    g, ids = group[order], vec_ids[order]
    once = np.ones(len(order), bool)
    once[1:] = (g[1:] != g[:-1]) | (ids[1:] != ids[:-1])
    order, g = order[once], g[once]
    return np.sort(order[np.arange(len(g)) - np.searchsorted(g, g) <= k])


_PAIR = "query_id long, vec_id long, score double"
_PACK = "cell int, leaf binary, vec_id binary, matrix binary"
_ASK = "cell int, query_id binary, q_matrix binary, visited binary"


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(vec_id, vector)``: vectors of doubles that are finite and not zero.

    Vectors and components that are null, and rows without an id, are left out;
    so are vectors of another size than most have.
    """
    v = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    v = v.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0))
    common = v.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return v.where(F.size("vector") == (common[0] if common else 0))


def split_leaves(filed: DataFrame, tree: Tree, dimensions: int) -> Tree:
    """The tree with overfull leaves split by k-means over a sample of their own rows.

    A leaf's sample has at most ``SPLIT_ROWS`` rows, by hash of the id; the fits
    run side by side as Spark tasks. What comes back, all centres together, stays
    below ``TREE_BYTES``: the rows that a leaf may hold follow from that.
    """
    counts = {r["leaf"]: r["n"] for r in filed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    most = max(LEAF_ROWS, -(-sum(counts.values()) * 2 * 8 * dimensions // TREE_BYTES))
    over = [(leaf, n) for leaf, n in counts.items() if n > most]
    if not over:
        return tree
    spark = filed.sparkSession
    wanted = F.broadcast(spark.createDataFrame(over, "leaf int, n long"))  # at most one row a leaf of the fitted tree
    by_hash = Window.partitionBy("leaf").orderBy(F.xxhash64("vec_id"), "vec_id")
    rows = filed.join(wanted, "leaf").withColumn("_rank", F.row_number().over(by_hash)).where(F.col("_rank") <= SPLIT_ROWS)

    def fitted(table: pa.Table) -> pa.Table:
        sample = _matrix(table.column("vector").combine_chunks())
        share = max(2, int(len(sample) * most / table.column("n")[0].as_py()))
        return pa.table({"leaf": table.column("leaf")[:1], "tree": pa.array([pickle.dumps(fit_tree(sample, leaf_rows=share))], pa.binary())})

    fits = rows.select("leaf", "n", "vec_id", "vector").groupBy("leaf").applyInArrow(fitted, "leaf int, tree binary").collect()
    return tree.graft({r["leaf"]: pickle.loads(r["tree"]) for r in fits})


def _filed(rows: DataFrame, tree: Tree) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.file(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), batch.column(0), batch.column(1)], ["leaf", "vec_id", "vector"])

    return rows.select("vec_id", "vector").mapInArrow(run, "leaf int, vec_id long, vector array<double>")


def cells_of(counts: np.ndarray, cell_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First cell of each leaf, and how many cells it is cut into; small neighbours share one."""
    first, cuts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    cell, filled = 0, 0
    for leaf, n in enumerate(counts.tolist()):
        if filled and filled + n > cell_rows:
            cell, filled = cell + 1, 0
        first[leaf] = cell
        if n > cell_rows:
            cuts[leaf] = -(-n // cell_rows)
            cell, filled = cell + int(cuts[leaf]), 0
        else:
            filled += n
    return first, cuts


def nearest(vectors: DataFrame, queries, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", wanted: float = WANTED_RECALL) -> DataFrame:
    """The ``k`` rows with the largest inner product for each row that ``queries`` selects.

    ``queries`` is a condition on ``vec_id``. Returns ``(query_id, rank, vec_id,
    score)``; a row is never its own neighbour. Rows that repeat both id and
    vector count once; with other vectors under one id, each is a query and a
    candidate. No usable vector, no rows; fewer than ``k`` candidates, all of them.
    """
    spark = vectors.sparkSession
    rows = settle(usable(vectors, id_column, vector_column), "vectors")
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions = len(picked[0][1])
    tree = fit_tree(np.array([r[1] for r in picked], float))
    index = settle(_filed(rows, tree), "leaves")
    finer = split_leaves(index, tree, dimensions)
    if finer is not tree:
        tree, index = finer, settle(_filed(rows, finer), "leaves")
    asked = index.where(queries).dropDuplicates(["vec_id", "vector"])
    leaves = calibrated_visits(index, asked, tree, k, wanted)[0]
    found = searched(index, asked, tree, leaves, k, max(1, CELL_BYTES // (8 * dimensions)))
    return _ranked(found, k)


def searched(index: DataFrame, asked: DataFrame, tree: Tree, leaves: int, k: int, cell_rows: int) -> DataFrame:
    """``(query_id, vec_id, score)``: of every cell the best rows in the leaves that a query visits."""
    spark = index.sparkSession
    counts = np.zeros(tree.n_leaves, np.int64)
    for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        counts[r["leaf"]] = r["n"]
    first, cuts = cells_of(counts, cell_rows)
    # one row a leaf, and the leaves of the tree are bounded by TREE_BYTES
    places = spark.createDataFrame(list(zip(range(len(counts)), first.tolist(), cuts.tolist(), strict=True)), "leaf int, first long, cuts long")
    dealt = index.join(F.broadcast(places), "leaf").select((F.col("first") + F.pmod(F.xxhash64("vec_id"), "cuts")).cast("int").alias("cell"), "leaf", "vec_id", "vector")

    def packed(table: pa.Table) -> pa.Table:
        leaf, ids, matrix = table.column("leaf").to_numpy(), table.column("vec_id").to_numpy(), _matrix(table.column("vector").combine_chunks())
        keep = _few_copies(ids, matrix, k)
        keep = keep[np.lexsort((ids[keep], leaf[keep]))]
        cut = [x[keep].astype(t).tobytes() for x, t in ((leaf, "<i4"), (ids, "<i8"), (matrix, "<f8"))]
        return pa.table({"cell": table.column("cell")[:1], **{n: pa.array([c], pa.binary()) for n, c in zip(("leaf", "vec_id", "matrix"), cut, strict=True)}})

    cells = settle(dealt.groupBy("cell").applyInArrow(packed, _PACK), "cells")
    shared = spark.sparkContext.broadcast((tree, first, cuts))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree_, first_, cuts_ = shared.value
        cell_of_leaf = np.repeat(first_, cuts_) + np.concatenate([np.arange(c) for c in cuts_])
        leaf_of_cell = np.repeat(np.arange(len(first_)), cuts_)
        for batch in batches:
            ids, matrix = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for low in range(0, len(ids), BLOCK_QUERIES):
                q, m = ids[low : low + BLOCK_QUERIES], matrix[low : low + BLOCK_QUERIES]
                seen = np.zeros((len(q), len(first_)), bool)
                for i, query in enumerate(m):
                    seen[i, [leaf for _, leaf in zip(range(leaves), tree_.visits(query), strict=False)]] = True
                out = []
                used = seen.any(0)[leaf_of_cell]
                for cell in np.unique(cell_of_leaf[used]).tolist():
                    here = leaf_of_cell[np.searchsorted(cell_of_leaf, cell) : np.searchsorted(cell_of_leaf, cell, side="right")]
                    asks = np.flatnonzero(seen[:, here].any(1))
                    out.append((cell, q[asks].tobytes(), m[asks].tobytes(), np.packbits(seen[np.ix_(asks, here)], axis=1).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["cell", "query_id", "q_matrix", "visited"])

    asks = settle(asked.select("vec_id", "vector").mapInArrow(walked, _ASK), "asks")
    pairs = cells.join(asks, "cell").select("cell", "leaf", "vec_id", "matrix", "query_id", "q_matrix", "visited")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, first_, cuts_ = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                cell, leaf, ids, matrix, query, q_matrix, visited = (c[i].as_py() for c in batch.columns)
                leaf, ids, query = np.frombuffer(leaf, "<i4"), np.frombuffer(ids, "<i8"), np.frombuffer(query, "<i8")
                matrix, q_matrix = np.frombuffer(matrix).reshape(len(ids), -1), np.frombuffer(q_matrix).reshape(len(query), -1)
                here = np.flatnonzero((first_ <= cell) & (cell < first_ + cuts_))
                seen = np.unpackbits(np.frombuffer(visited, np.uint8).reshape(len(query), -1), axis=1, count=len(here)).astype(bool)
                products = np.full((len(query), len(ids)), -np.inf)
                for j, n in enumerate(here.tolist()):
                    low, high = np.searchsorted(leaf, n), np.searchsorted(leaf, n, side="right")
                    who = np.flatnonzero(seen[:, j])
                    if high > low and len(who):
                        products[who, low:high] = q_matrix[who] @ matrix[low:high].T
                q, row, score = top_pairs(query, q_matrix, ids, matrix, k, products)
                yield pa.RecordBatch.from_arrays([pa.array(query[q]), pa.array(ids[row]), pa.array(score)], ["query_id", "vec_id", "score"])

    return pairs.mapInArrow(met, _PAIR)


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def exact_nearest(index: DataFrame, queries: list, k: int) -> DataFrame:
    """Exact neighbours of a few queries (id and vector) over all of ``index``, with their leaves."""
    ids = np.array([q[0] for q in queries], np.int64)
    matrix = np.array([q[1] for q in queries], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, vec_id, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))
            keep = _few_copies(vec_id, rows, k)
            leaf, vec_id, rows = leaf[keep], vec_id[keep], rows[keep]
            q, row, score = top_pairs(ids, matrix, vec_id, rows, k, matrix @ rows.T)
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(vec_id[row]), pa.array(score), pa.array(leaf[row])], ["query_id", "vec_id", "score", "leaf"])

    near = index.select("leaf", "vec_id", "vector").mapInArrow(run, f"{_PAIR}, leaf int")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrated_visits(index: DataFrame, asked: DataFrame, tree: Tree, k: int, wanted: float) -> tuple[int, float]:
    """Fewest leaves, in steps that widen, whose visits hold the wanted share of true neighbours.

    Of up to twice ``CALIBRATION_QUERIES`` queries, whatever the input, every
    other one calibrates and the others measure the recall that is returned
    as well; their neighbours, ``k`` for each, are all that reaches the driver.
    """
    queries = asked.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").select("vec_id", "vector").limit(2 * CALIBRATION_QUERIES).collect()
    if not queries:
        return 1, 1.0
    order = {q[0]: {leaf: i for i, leaf in enumerate(tree.visits(np.array(q[1], float)))} for q in queries}
    rank: list[list[int]] = [[], []]
    measures = {q[0] for q in queries[1::2]}
    for r in exact_nearest(index, queries, k).select("query_id", "leaf").collect():
        rank[r["query_id"] in measures].append(order[r["query_id"]][r["leaf"]])
    needed, measured = np.array(rank[0]), np.array(rank[1])
    leaves = 1
    while leaves < tree.n_leaves and len(needed) and (needed < leaves).mean() < wanted:
        leaves += max(1, leaves // 8)
    leaves = min(leaves, tree.n_leaves)
    return leaves, float((measured < leaves).mean()) if len(measured) else 1.0
