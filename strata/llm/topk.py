"""Operator 10, exact top-k search by inner product: ball trees per shard with
branch and bound, nodes in order of their upper bound, and a k-th score that is
shared between shards.

Vectors are dealt to shards of bounded size by a hash of their id.  In a first
round each query searches one shard (its own), which gives a lower bound of its
k-th score; in a second round it searches the other shards with this bound from
the start, so most of their nodes are never opened.  Queries are taken in
blocks of bounded size against each shard; a query's at most k answers per
shard are merged by an aggregate over k * shards rows.

A node is skipped only if its bound ``q . centre + |q| * radius`` is below the
k-th score; nodes that can only tie are opened, because ties go to the smaller
id.  Scores are exact integers.

Results for odd input: rows whose vector or id is null, or whose vector holds
null or non-finite components, take no part; vectors of different length are
never compared; rows with the query's own id are not its candidates; repeated
rows count each; extra columns are left alone; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

SHARD_ROWS = 8192
QUERY_ROWS = 4096
LEAF = 64


class BallTree:
    """Nodes (centre, radius) over rows that are split in halves along the
    direction of the widest spread; node i has the children 2i + 1, 2i + 2."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.order = points, np.arange(len(points))
        self.nodes: list[tuple[int, int, np.ndarray, float, bool]] = []
        self.children: list[tuple[int, int]] = []
        self._add(0, len(points), leaf)

    def _add(self, lo: int, hi: int, leaf: int) -> int:
        at = len(self.nodes)
        rows = self.points[self.order[lo:hi]]
        centre = rows.mean(axis=0)
        gaps = np.sqrt(((rows - centre) ** 2).sum(axis=1))
        # a margin for rounding: bounds must not be too low
        radius = float(gaps.max()) * (1 + 1e-9) + 1e-6
        self.nodes.append((lo, hi, centre, radius, hi - lo <= leaf or gaps.max() == 0))
        self.children.append((-1, -1))
        if not self.nodes[at][4]:
            far = rows[int(gaps.argmax())]
            other = rows[int(((rows - far) ** 2).sum(axis=1).argmax())]
            half = (hi - lo) // 2
            side = np.argpartition(rows @ (other - far), half)
            self.order[lo:hi] = self.order[lo:hi][side]
            self.children[at] = (self._add(lo, lo + half, leaf), self._add(lo + half, hi, leaf))
        return at


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to smaller ids, in order."""
    if len(scores) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= kth
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _dots(points: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products: in doubles where these hold them exactly."""
    if exact:
        return (points @ query).astype(np.int64)
    big = [sum(int(a) * int(b) for a, b in zip(p, query, strict=True)) for p in points]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, x)) for x in big], np.int64)


def search(tree: BallTree, ids: np.ndarray, query: np.ndarray, own: int, k: int,
           least: int | None, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """Branch and bound: opens nodes by falling bound while one can still hold
    an answer.  ``least``: a k-th score known from other shards."""
    import heapq
    norm = float(np.sqrt((query * query).sum())) * (1 + 1e-9)
    found_s, found_i = np.zeros(0, np.int64), np.zeros(0, np.int64)
    kth = -np.inf if least is None else least

    def bound(at: int) -> float:
        _, _, centre, radius, _ = tree.nodes[at]
        b = float(centre @ query) + norm * radius
        return b + 1e-9 * abs(b) + 1e-3

    heap = [(-bound(0), 0)]
    while heap:
        top, at = heapq.heappop(heap)
        if -top < kth:
            break
        lo, hi, _, _, leaf = tree.nodes[at]
        if not leaf:
            for c in tree.children[at]:
                b = bound(c)
                if b >= kth:
                    heapq.heappush(heap, (-b, c))
            continue
        rows = tree.order[lo:hi]
        s, i = _dots(tree.points[rows], query, exact), ids[rows]
        keep = (s >= kth) & (i != own)
        if keep.any():
            found_s, found_i = _best(np.concatenate([found_s, s[keep]]), np.concatenate([found_i, i[keep]]), k)
            if len(found_s) == k:
                kth = max(kth, int(found_s[-1]))
    return found_s, found_i


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    col = table.column(name).combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(table), -1)


def _searcher(k: int, leaf: int):
    def run(key, points: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(points) and len(queries):
            p, q = _matrix(points, "q"), _matrix(queries, "wanted")
            most = max(np.abs(p).max(initial=0), 1.0) * max(np.abs(q).max(initial=0), 1.0) * p.shape[1]
            tree, ids = BallTree(p, leaf), points.column("vec_id").to_numpy()
            least = queries.column("least").to_pylist()
            for row, own in enumerate(queries.column("own").to_pylist()):
                s, i = search(tree, ids, q[row], own, k, least[row], bool(most < 2 ** 53))
                out["query_id"] += [own] * len(s)
                out["vec_id"] += i.tolist()
                out["score"] += s.tolist()
        return pa.table(out, pa.schema([(c, pa.int64()) for c in out]))
    return run


def integers(vector: Column) -> Column:
    """floor(1024 * x) of each component, as whole doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 1024).cast("double"))


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
          shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows with the highest inner
    product for every row that satisfies ``is_query`` (all, if fewer)."""
    good = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(good, F.lit(False))
                            & (F.size(vector_col) > 0))
    rows = stored(usable.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("_query"),
                                F.size(vector_col).alias("_dim"), integers(F.col(vector_col)).alias("q")), "vectors")
    counts = rows.agg(F.count("*").alias("n"), F.count_if("_query").alias("m")).first()
    shards = max(1, -(-counts["n"] // shard_rows))
    blocks = max(1, -(-counts["m"] // query_rows))
    rows = rows.withColumn("_shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    queries = (rows.filter("_query").dropDuplicates(["vec_id", "q"])
               .select(F.col("vec_id").alias("own"), F.col("q").alias("wanted"), F.col("_dim").alias("_d"),
                       F.col("_shard").alias("_s"),
                       F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("_b")))
    # each shard once per block of queries (both counts are known, sizes bounded)
    points = (rows.select("vec_id", "q", "_dim", "_shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
              .groupBy("_dim", "_shard", "_block"))
    schema = "query_id long, vec_id long, score long"
    run = _searcher(k, leaf)
    home = queries.withColumn("least", F.lit(None).cast("long")).groupBy("_d", "_s", "_b")
    first = stored(points.cogroup(home).applyInArrow(run, schema), "home-answers")
    kth = (first.groupBy("query_id").agg(F.min("score").alias("_kth"), F.count("*").alias("_n"))
           .select("query_id", F.when(F.col("_n") >= k, F.col("_kth")).alias("least")))
    away = (queries.join(kth, F.col("own") == F.col("query_id"), "left").drop("query_id")
            .withColumn("_home", F.col("_s"))
            .withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
            .filter("_s <> _home").drop("_home").groupBy("_d", "_s", "_b"))
    rest = points.cogroup(away).applyInArrow(run, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (first.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
