"""Exact centroid clustering by ball-tree filtering.

Vectors become integers. Each task builds metric trees over its own rows: a node is a ball that stores its centre, radius,
count and integer sum, and a leaf holds its vectors. The trees are built once and staged in the shared folder. In a round
each tree is walked level by level with the list of centroids that may still be nearest. By the triangle inequality, a
centroid further from the ball's centre than the nearest one by more than twice the radius is nearest to nothing in it;
a ball with one centroid left goes to it whole, by count and sum, and what comes down to a leaf is compared exactly in
integers. Each task sends a count and a sum for each centroid, which Spark adds up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, staged, table

SIZE, SCALE = 64, 256
CENTROIDS, ROUNDS, SEED = 40, 5, 2
#: Vectors of a tree and of a leaf.
TREE, LEAF = 4096, 16
#: Components stop at this magnitude, so that a squared distance of 64 of them fits into 64 bits.
LARGEST = 1 << 27


@dataclass
class Tree:
    """Nodes in breadth-first order (children of inner nodes are neighbours), and vectors in the order of their leaves."""

    ids: np.ndarray
    null: np.ndarray  # whose id is null
    vectors: np.ndarray
    first: np.ndarray  # of a node: its vectors are first .. first + count
    count: np.ndarray
    child: np.ndarray  # its left child, 0 for a leaf
    radius: np.ndarray
    total: np.ndarray

    def pack(self) -> dict:
        small = next(k for k in (np.int8, np.int16, np.int32) if not self.vectors.size or np.abs(self.vectors).max() <= np.iinfo(k).max)
        return {
            "ids": self.ids.tobytes(), "null": np.packbits(self.null).tobytes(), "width": np.dtype(small).itemsize, "vectors": self.vectors.astype(small).tobytes(),
            "first": self.first.astype(np.int32).tobytes(), "count": self.count.astype(np.int32).tobytes(), "child": self.child.astype(np.int32).tobytes(), "radius": self.radius.tobytes(), "total": self.total.tobytes(),
        }

    @classmethod
    def unpack(cls, row) -> Tree:
        at = lambda name, kind: np.frombuffer(getattr(row, name), kind)
        ids = at("ids", np.int64)
        vectors = at("vectors", f"<i{row.width}").reshape(len(ids), -1)
        first = at("first", np.int32)
        return cls(ids, np.unpackbits(at("null", np.uint8), count=len(ids)).astype(bool), vectors, first, at("count", np.int32), at("child", np.int32), at("radius", np.float64), at("total", np.int64).reshape(len(first), -1))


TREE_SCHEMA = "ids binary, null binary, width int, vectors binary, first binary, count binary, child binary, radius binary, total binary"


def squared(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers, [len(x), len(z)]: by float64 products as long as these are whole."""
    most = max(float(np.abs(x).max(initial=0)), float(np.abs(z).max(initial=0)))
    if 4 * x.shape[1] * most * most < 2**53:
        x, z = x.astype(np.float64), z.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ z.T) + (z * z).sum(1)).astype(np.int64)
    return np.stack([((x.astype(np.int64) - row) ** 2).sum(1) for row in z.astype(np.int64)], 1) if len(z) else np.zeros((len(x), 0), np.int64)


def build(ids: np.ndarray, null: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> Tree:
    """Balls are halved along the line between two far vectors, until a leaf is left or all vectors are equal."""
    order = np.arange(len(vectors))
    nodes, child, radius, total = [(0, len(order))], [], [], []
    at = 0
    while at < len(nodes):
        a, b = nodes[at]
        x = vectors[order[a:b]].astype(np.int64)
        total.append(x.sum(0))
        centre = total[-1] / (b - a)
        far = np.sqrt(((x - centre) ** 2).sum(1))
        # rounding of a centre and a distance stays far below this slack
        radius.append(float(far.max()) * (1 + 1e-9) + 1e-6)
        child.append(0)
        if b - a > leaf and (x != x[0]).any():
            p = x[int(far.argmax())]
            q = x[int(((x - p) ** 2).sum(1).argmax())]
            along = x.astype(np.float64) @ (q - p).astype(np.float64)
            order[a:b] = order[a:b][np.argsort(along, kind="stable")]
            child[at] = len(nodes)
            middle = (a + b) // 2
            nodes += [(a, middle), (middle, b)]
        at += 1
    spans = np.array(nodes)
    return Tree(ids[order], null[order], vectors[order], spans[:, 0], spans[:, 1] - spans[:, 0], np.array(child), np.array(radius), np.array(total))


def walk(tree: Tree, centroids: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Balls (node, centroid) that go to one centroid whole; and the places of the other vectors with their centroids."""
    whole: list[tuple[int, int]] = []
    places, owners = [], []
    frontier, alive = np.zeros(1, np.int64), np.ones((1, len(centroids)), bool)
    z = centroids.astype(np.float64)
    while len(frontier):
        centre = tree.total[frontier] / tree.count[frontier][:, None]
        d = np.sqrt(np.maximum(((centre[:, None, :] - z) ** 2).sum(2), 0)) if len(frontier) * len(z) < 1 << 12 else np.stack([np.sqrt(((centre - c) ** 2).sum(1)) for c in z], 1)
        d[~alive] = np.inf
        alive = d <= d.min(1)[:, None] * (1 + 1e-9) + 2 * tree.radius[frontier][:, None] + 1e-6
        one = alive.sum(1) == 1
        whole += zip(frontier[one].tolist(), alive[one].argmax(1).tolist(), strict=True)
        leaf = ~one & (tree.child[frontier] == 0)
        # leaves with the same list of centroids are compared together
        if leaf.any():
            lists, of = np.unique(alive[leaf], axis=0, return_inverse=True)
            nodes = frontier[leaf]
            for i, left in enumerate(lists):
                of_list = nodes[of.ravel() == i]
                at = np.concatenate([np.arange(tree.first[n], tree.first[n] + tree.count[n]) for n in of_list])
                names = np.flatnonzero(left)
                places.append(at)
                owners.append(names[squared(tree.vectors[at], centroids[names]).argmin(1)])
        inner = ~one & ~leaf
        frontier = np.repeat(tree.child[frontier[inner]], 2).astype(np.int64)
        frontier[1::2] += 1
        alive = np.repeat(alive[inner], 2, axis=0)
    empty = np.zeros(0, np.int64)
    return whole, np.concatenate([*places, empty]), np.concatenate([*owners, empty])


def whole_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and v (array of integers) of the vectors that have ``size`` components, none null or not finite."""
    x = F.col("`embedding`").cast("array<double>")
    kept = vectors.select(F.col("`vec_id`").cast("long").alias("vec_id"), x.alias("x")).where(F.col("x").isNotNull() & (F.size("x") == size))
    kept = kept.where(~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    bound = float(LARGEST)
    # bounded as doubles, before a long would overflow
    return kept.select("vec_id", F.transform("x", lambda v: F.floor(F.greatest(F.least(v * float(scale), F.lit(bound)), F.lit(-bound))).cast("int")).alias("v"))


def plant(whole: DataFrame, tree: int = TREE, leaf: int = LEAF) -> DataFrame:
    """Trees of up to ``tree`` vectors each, from the rows of a partition as they lie."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0

        def made() -> pd.DataFrame:
            ids, null, rows = (np.concatenate(c) for c in zip(*parts, strict=True))
            return pd.DataFrame([build(ids[i : i + tree], null[i : i + tree], rows[i : i + tree], leaf).pack() for i in range(0, held, tree)])

        for batch in batches:
            for i in range(0, len(batch), tree):
                part = batch.iloc[i : i + tree]
                parts.append((part["vec_id"].to_numpy(), part["null"].to_numpy(), np.stack(part["v"].tolist()).astype(np.int64)))
                held += len(part)
                if held >= tree:
                    yield made()
                    parts, held = [], 0
        if held:
            yield made()

    # a null id is a flag, so that pandas doesn't make doubles of the others
    return whole.select(F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("null"), "v").mapInPandas(run, TREE_SCHEMA)


def cluster_sums(trees: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Counts and componentwise sums of the vectors nearest to each centroid."""
    k, size = centroids.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            for row in batch.itertuples(index=False):
                tree = Tree.unpack(row)
                whole, places, owners = walk(tree, centroids)
                for node, c in whole:
                    counts[c] += tree.count[node]
                    sums[c] += tree.total[node]
                counts += np.bincount(owners, minlength=k)
                by = np.argsort(owners, kind="stable")
                heads = np.searchsorted(owners[by], np.arange(k + 1))
                for c in np.flatnonzero(np.diff(heads)):
                    sums[c] += tree.vectors[places[by[heads[c] : heads[c + 1]]]].sum(0, dtype=np.int64)
        yield pd.DataFrame({"cluster": np.arange(k), "n": counts, "sums": list(sums)})

    found = trees.mapInPandas(run, "cluster int, n long, sums array<long>").select("cluster", "n", F.posexplode("sums").alias("i", "s"))
    counts, sums = np.zeros(k, np.int64), [[0] * size for _ in range(k)]
    # a row for each centroid and component; tasks' longs are added as decimals
    for r in found.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect():
        counts[r.cluster], sums[r.cluster][r.i] = r.n, int(r.s)
    return counts, sums


def assign(trees: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of each vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                tree = Tree.unpack(row)
                whole, places, owners = walk(tree, centroids)
                cluster = np.zeros(len(tree.ids), np.int64)
                cluster[places] = owners
                for node, c in whole:
                    cluster[tree.first[node] : tree.first[node] + tree.count[node]] = c
                distance = ((tree.vectors.astype(np.int64) - centroids[cluster]) ** 2).sum(1)
                yield pd.DataFrame({"vec_id": pd.array(tree.ids, "Int64"), "cluster": cluster, "distance": distance}).assign(vec_id=lambda d, t=tree: d["vec_id"].mask(t.null))

    return trees.mapInPandas(run, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, *, size: int = SIZE, scale: int = SCALE, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, tree: int = TREE, leaf: int = LEAF) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256.

    Kept are vectors of ``size`` components, none null or not finite; each component x becomes floor(scale * x), which stops
    at 2**27 either way. The first centroids are the ``k`` vectors of the smallest hash of ``seed:vec_id`` (a null vec_id
    counts as empty; of equal hashes, the smaller components), or all if there are fewer. Ties go to the smaller number,
    empty clusters keep their centroid, repeated rows are vectors of their own, and an empty table gives no rows. Further
    columns are left aside. The driver holds the centroids and their sums: k times size numbers, both parameters."""
    whole = staged(whole_vectors(vectors, size, scale))
    spark = whole.sparkSession
    named = whole.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("h"), "v")
    first = named.orderBy("h", "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r.v for r in first], np.int64)
    trees = staged(plant(whole, tree, leaf))
    release(whole)
    for _ in range(rounds):
        counts, sums = cluster_sums(trees, centroids)
        centroids = np.array([[s // int(n) for s in row] if n else old.tolist() for n, row, old in zip(counts, sums, centroids, strict=True)], np.int64)
    found = staged(assign(trees, centroids))
    release(trees)
    names = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for i, row in enumerate(centroids.tolist())], "cluster int, centroid_sha256 string")
    each = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    every = found.agg(F.sum("distance").alias("inertia"))
    return found.join(F.broadcast(each.join(F.broadcast(names), "cluster")), "cluster").crossJoin(F.broadcast(every)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_ball_tree_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op12_ball_tree_clusters": op12_ball_tree_clusters}


def _sql() -> str:
    """Rounds of assignment and update as common table expressions, the vectors with a row for each component."""
    parts = [
        f"""x AS (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {SIZE})""",
        f"p AS (SELECT i, unnest(range({SIZE})) AS d, unnest(v) AS v FROM x)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256(concat('{SEED}:', vec_id)), v) - 1 AS k, v FROM x QUALIFY k < {CENTROIDS})",
        f"z0 AS (SELECT k, unnest(range({SIZE})) AS d, unnest(v) AS z FROM c0)",
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS (
  SELECT i, arg_min(k, e * 64 + k) AS k, min(e) AS e
  FROM (SELECT i, k, CAST(sum((v - z) * (v - z)) AS BIGINT) AS e FROM p JOIN z{r} USING (d) GROUP BY i, k) GROUP BY i)""")
        if r < ROUNDS:
            parts.append(f"""z{r + 1} AS (
  SELECT k, d, coalesce((s - ((s % n) + n) % n) // n, z) AS z
  FROM z{r} LEFT JOIN (SELECT k, d, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM a{r} JOIN p USING (i) GROUP BY k, d) USING (k, d))""")
    return f"""WITH {", ".join(parts)},
names AS (SELECT k, sha256(string_agg(CAST(z AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM z{ROUNDS} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, e AS distance, CAST(sum(e) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(e) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN names USING (k) JOIN x USING (i)"""


ORACLES = {"op12_ball_tree_clusters": _sql()}
