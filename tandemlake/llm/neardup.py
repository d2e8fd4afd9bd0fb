"""N-gram Jaccard join by a MinHash LSH forest.

Each distinct text is a node with a MinHash signature. A tree of the forest is a trie of one slice of the signatures: its
labels in sorted order, where the nodes below a trie node stand together. Nodes match where they share a prefix of a label.
Prefixes begin at full depth; all pairs that match are verified on their whole shingle sets, in blocks of bounded size, each
pair in the first tree it shares. Each verified similarity says with what chance a pair like it matches at this depth, so the
found links say how many there must be (a Horvitz-Thompson sum). While that recall is below the target, prefixes are
shortened by one value and the pairs that match only now are verified. Links give counts and, by alternating stars,
connected classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import documents, in_chunks, ordered, partitions, release, running_sum, staged, table

WORDS = 5
THRESHOLD = 0.8
TREES = 12
DEPTH = 4
TARGET_RECALL = 0.9995
#: Shingles in a block of a prefix's nodes: 2 MB. Each node counts 256 more, so that a block has at most 1024 nodes and
#: a pair of blocks a product of 16 MB.
BLOCK, NODE_COST = 1 << 18, 256

_U = np.uint64


def recall(similarity: float, depth: int, trees: int) -> float:
    """The chance that a pair shares a prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def estimated_recall(found: int, expected: float, threshold: float, depth: int, trees: int) -> float:
    """The share of links that have been found: of those that must be there by the found ones' similarities; without any,
    the chance at the threshold."""
    return found / expected if found else recall(threshold, depth, trees)


def shingles(texts: list[str | None], k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of k words, and where each text's begin."""
    w = K.words(texts)
    at, h = K.windows(w, k)
    return h, np.searchsorted(w.doc[at], np.arange(len(texts) + 1))


def signatures(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """MinHash signatures (texts x size, 32 bits) and numbers of windows; texts without windows have none."""
    h, first = shingles(texts)
    n = np.diff(first)
    full = n > 0
    a, b = K.stream(size, 5) | _U(1), K.stream(size, 6)
    out = np.zeros((len(texts), size), np.uint32)
    if full.any():
        starts = first[:-1][full]
        with np.errstate(over="ignore"):
            for j in range(size):
                out[full, j] = np.minimum.reduceat(((h * a[j] + b[j]) >> _U(32)).astype(np.uint32), starts)
    return out, n


def labels(sig: np.ndarray, trees: int, depth: int) -> list[bytes]:
    """The label of each node in each tree: the tree's number and its slice of the signature, in bytes that sort like them."""
    out = np.zeros((len(sig), trees, 1 + 4 * depth), np.uint8)
    out[:, :, 0] = np.arange(trees)
    out[:, :, 1:] = sig.reshape(len(sig), trees, depth).astype(">u4").view(np.uint8).reshape(len(sig), trees, -1)
    return [x.tobytes() for x in out.reshape(-1, out.shape[2])]


def shared_prefix(sig: np.ndarray, a: np.ndarray, b: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Values of the common prefix of the labels of nodes a and b: pairs x trees."""
    same = (sig[a] == sig[b]).reshape(len(a), trees, depth)
    return np.where(same.all(2), depth, same.argmin(2))


def verify(sets: list[np.ndarray], side: np.ndarray, cross: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of a block, or of two blocks (cross), whose Jaccard similarity reaches the threshold, and it."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    values, column, df = np.unique(flat, return_inverse=True, return_counts=True)
    shared = df > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    common = np.zeros((n, n), np.float32)
    width = max(256, (1 << 22) // n)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for a in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [a, a + width])
        grid = np.zeros((n, width), np.float32)
        grid[owner[lo:hi], column[lo:hi] - a] = 1
        common += grid @ grid.T
    union = sizes[:, None] + sizes[None, :] - common
    # in whole numbers: 100 * common >= 100 * threshold * union, with some slack for the threshold's own rounding
    linked = np.triu(common >= threshold * union - 1e-6, 1)
    if cross:
        linked &= side[:, None] != side[None, :]
    pairs = np.argwhere(linked)
    return pairs, (common[linked] / union[linked]).astype(float)


def _roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """The least of n nodes in each one's component."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        np.minimum.at(label, pairs[:, 0], least)
        np.minimum.at(label, pairs[:, 1], least)
        label = label[label]
        if (label == before).all():
            return label


def connected(edges: DataFrame) -> DataFrame:
    """node, label: each node of the edges (a, b) with the least node of its component, by alternating large and small
    stars. A round is written to the shared folder; rounds go on until one changes nothing."""

    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        # around each node: its least neighbour or itself; the larger (or not larger) neighbours move there
        around = e if not large else both(e)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = around.join(least, "a")
        if large:
            return moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(moved.select("a", F.col("m").alias("b"))).where("a != b").distinct()

    def down(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()

    summary = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    edges = staged(down(edges))
    before = summary(edges)
    while before[0]:
        edges = staged(down(star(down(star(edges, True)), False)))
        now = summary(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _runs(batches: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """The rows of each value of a column, from batches sorted by it."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        ids = batch[column].to_numpy()
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1), len(batch)]
        if rest and rest[0][column].iloc[0] != ids[0]:
            yield pd.concat(rest, ignore_index=True)
            rest = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rest.append(batch.iloc[a:b])
            if b < len(batch):
                yield pd.concat(rest, ignore_index=True)
                rest = []
    if rest:
        yield pd.concat(rest, ignore_index=True)


def text_node() -> Column:
    """Digest of a row's text; of its doc_id where the text is null."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("t"), F.col("text")), F.concat(F.lit("n"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))))


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL) -> DataFrame:
    """Per document: doc_id, class_id (the least doc_id of its class), n_links (other texts whose set of five-word
    shingles has a Jaccard similarity of at least the threshold with its own), n_copies (documents with just its text,
    itself included), node (the text's digest) and keeper (true for one document of each class).

    Equal texts are one node, however short; texts of fewer than five words link to no other text. A null text is a
    class of its own, as are others by the same doc_id. Repeated rows are copies. target: the estimated recall at which
    prefixes are short enough."""
    n_tasks = partitions(docs)
    rows = documents(docs, "doc_id", "text").select("doc_id", text_node().alias("node"), "text")

    def sign(batch: pd.DataFrame) -> pd.DataFrame:
        sig, n = signatures(batch["text"].tolist(), trees * depth)
        return pd.DataFrame({"doc_id": batch["doc_id"], "node": batch["node"], "n_shingles": n, "signature": [s.tobytes() for s in sig]})

    signed = staged(rows.mapInPandas(in_chunks(sign), "doc_id long, node binary, n_shingles long, signature binary"))
    nodes = staged(signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")))

    def forest(batches):
        for batch in batches:
            sig = np.frombuffer(b"".join(batch["signature"]), np.uint32).reshape(-1, trees * depth)
            yield pd.DataFrame({"label": labels(sig, trees, depth), "node": np.repeat(batch["node"].to_numpy(), trees), "cost": np.repeat(batch["n_shingles"].to_numpy() + NODE_COST, trees)})

    placed = nodes.where("n_shingles > 0").select("node", "n_shingles", "signature").mapInPandas(forest, "label binary, node binary, cost long")

    def units_at(used: int) -> tuple[DataFrame, DataFrame]:
        """Nodes that share a prefix of this length with another one, and the blocks and pairs of blocks to verify."""
        prefix = F.substring("label", 1, 1 + 4 * used)
        shared = placed.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n")).where("n > 1").select("prefix")
        members = ordered(placed.withColumn("prefix", prefix).join(shared, "prefix"), "label", "node", tasks=n_tasks)
        split = running_sum(members, "cost", ["label", "node"], "before", group="prefix").withColumn("block", F.floor(F.col("before") / BLOCK))
        blocks = split.groupBy("prefix").agg((F.max("block") + 1).alias("blocks"))
        # a unit is a block with itself or with another one of its prefix
        paired = split.join(blocks, "prefix").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        tree = F.conv(F.hex(F.substring("label", 1, 1)), 16, 10).cast("int")
        units = staged(paired.select(tree.alias("tree"), "node", "block", F.xxhash64("prefix", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), (F.col("block") != F.col("other")).alias("cross")))
        # a unit whose nodes are just those of one in an earlier tree has no pair of its own
        lists = units.groupBy("unit").agg(F.min("tree").alias("tree"), F.count("*").alias("n"), F.sum(F.xxhash64("node", "cross", F.lit(1)).cast("decimal(20,0)")).cast("string").alias("x"), F.sum(F.xxhash64("node", "cross", F.lit(2)).cast("decimal(20,0)")).cast("string").alias("y"))
        first = lists.groupBy("n", "x", "y").agg(F.min(F.struct("tree", "unit")).alias("first")).select("first.unit")
        return members, units.join(first, "unit")

    def sets(batch: pd.DataFrame) -> pd.DataFrame:
        h, at = shingles(batch["text"].tolist())
        return pd.DataFrame({"node": batch["node"], "shingles": [np.unique(h[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]})

    def verified_at(used: int) -> DataFrame:
        """Links of pairs whose longest shared prefix has ``used`` values (or more, at full depth): per unit and node the
        number of links and a root, and sums over the unit's links of what each stands for at every depth."""
        members, units = units_at(used)
        wanted = members.select("node").distinct().join(nodes, "node").select(F.col("doc_id").alias("rep"), F.col("node").alias("rep_node"), "signature")
        texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("node") == F.col("rep_node"))).select("node", "text")
        content = staged(texts.mapInPandas(in_chunks(sets), "node binary, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles")))
        loaded = units.join(content, "node").join(nodes.select("node", "signature"), "node").repartition(n_tasks, "unit").sortWithinPartitions("unit", "node")

        def links(batches):
            out = []
            for run in _runs(batches, "unit"):
                sig = np.frombuffer(b"".join(run["signature"]), np.uint32).reshape(-1, trees * depth)
                pairs, similar = verify([np.frombuffer(s, np.uint64) for s in run["shingles"]], run["block"].to_numpy(), bool(run["cross"].iloc[0]), threshold)
                if len(pairs):
                    # a pair is this unit's if no earlier tree has it, and no longer prefix had it before
                    common = shared_prefix(sig, pairs[:, 0], pairs[:, 1], trees, depth)
                    own = (common[:, : int(run["tree"].iloc[0])] < used).all(1) & (common.max(1) <= used)
                    pairs, similar = pairs[own], similar[own]
                if len(pairs):
                    counts = np.bincount(pairs.reshape(-1), minlength=len(run))
                    roots = _roots(len(run), pairs)
                    hit = np.flatnonzero(counts)
                    names = run["node"].to_numpy()
                    part = pd.DataFrame({"node": names[hit], "root": names[roots[hit]], "n": counts[hit]})
                    part["stands_for"] = [[]] * len(part)
                    part.at[0, "stands_for"] = [float((1 / recall(similar, d, trees)).sum()) for d in range(1, depth + 1)]
                    out.append(part)
                if len(out) > 200:
                    yield pd.concat(out, ignore_index=True)
                    out = []
            if out:
                yield pd.concat(out, ignore_index=True)

        found = staged(loaded.mapInPandas(links, "node binary, root binary, n long, stands_for array<double>"))
        release(members, content)
        return found

    verified, used = verified_at(depth), depth
    while used > 1:
        sums = verified.agg(F.sum("n").alias("ends"), *[F.sum(F.get("stands_for", F.lit(d - 1))).alias(f"d{d}") for d in range(1, depth + 1)]).first()
        if estimated_recall((sums.ends or 0) // 2, sums[f"d{used}"], threshold, used, trees) >= target:
            break
        used -= 1
        verified = verified.unionByName(verified_at(used))
    counts = verified.groupBy("node").agg(F.sum("n").alias("n_links"))
    components = connected(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = nodes.select("node", "doc_id", "n_copies").join(counts, "node", "left").join(components, "node", "left").select("node", "doc_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("label", "node").alias("label"))
    classes = known.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))).alias("head"))
    resolved = known.select("node", "n_copies", "n_links", "label", F.col("doc_id").alias("first_id")).join(classes, "label").select("node", "n_copies", "n_links", "class_id", "first_id", (F.col("head.node") == F.col("node")).alias("leads"))
    # copies of a text, however many, stay where they lie: the text's row comes to them
    listed = signed.select("doc_id", F.col("node").alias("own")).join(resolved, F.col("own") == F.col("node"))
    keeper = F.col("leads") & F.col("doc_id").eqNullSafe(F.col("first_id"))
    return listed.select("doc_id", "class_id", "n_links", "n_copies", "node", keeper.alias("keeper"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, one document of each class of near_duplicates: its least doc_id."""
    rows = documents(docs, "doc_id", "text", "lang", "source", "n_chars").withColumn("_node", text_node())
    kept = staged(near_duplicates(rows).where("keeper").groupBy(F.col("doc_id").alias("k_id"), F.col("node").alias("k_node")).agg(F.count("*").alias("k_rows")))
    both = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("_node") == F.col("k_node")))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    once = both.where("k_rows = 1").select(*columns)
    if kept.where("k_rows > 1").isEmpty():
        return once
    # rows repeated with their doc_id: any one of them
    again = both.where("k_rows > 1").groupBy("doc_id", "_node").agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("r")).select("doc_id", *[F.col(f"r.{c}").alias(c) for c in columns[1:]])
    return once.unionByName(again)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies", "keeper")


QUERIES = {"op7_jaccard_join": op7_jaccard_join}
ORACLES: dict[str, str] = {}
