"""Importance resampling, ball-tree clusters and maximum-entropy scores against brute force, on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("tandemlake.llm")

from tandemlake.llm import balltree, importance, maxent  # noqa: E402

from test_operators import ROWS, SCHEMA, docs, empty, sentence  # noqa: E402, F401

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(value):
    return None if value is None or value is pd.NA or value != value else value


def rows_of(df):
    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)


# importance resampling


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return words, [zlib.crc32(f.encode()) for f in words + [" ".join(p) for p in zip(words, words[1:])]]


def brute_importance(texts, target, buckets, percent, least, seed):
    s, t = collections.Counter(), collections.Counter()
    for _, text in texts:
        s.update(h % buckets for h in features(text)[1])
    for text in target:
        t.update(h % buckets for h in features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (S + float(buckets)) / ((s[b] + 1.0) * (T + float(buckets))))) for b in range(buckets)]
    out = []
    for doc_id, text in texts:
        words, hashes = features(text)
        weight = sum(gain[h % buckets] for h in hashes) // len(hashes) if hashes else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words), len(hashes), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = i + 1
    return sorted((tuple(r) for r in out), key=repr)


@pytest.mark.parametrize(("buckets", "percent", "least"), [(10_000, 25, 20), (7, 60, 1)])
def test_importance_sample(spark, docs, buckets, percent, least):  # noqa: F811
    rng = random.Random(4)
    target = [sentence(rng, 50), None, "", "Å B\0c 12-a", "ABC abc ÄÖ ä"]
    aimed = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, buckets int")
    got = rows_of(importance.importance_sample(docs, aimed, buckets=buckets, percent=percent, least_words=least))
    assert got == brute_importance([(r[0], r[1]) for r in ROWS], target, buckets, percent, least, importance.SEED)


def test_importance_slices_and_empty_tables(spark, docs, empty, monkeypatch):  # noqa: F811
    aimed = spark.createDataFrame([("one two three",)], "text string")
    whole = rows_of(importance.importance_sample(docs, aimed))
    monkeypatch.setattr(importance, "SLICE", 50)
    assert rows_of(importance.importance_sample(docs.repartition(5), aimed)) == whole
    assert importance.importance_sample(empty, aimed).count() == 0
    assert [r[:4] for r in rows_of(importance.importance_sample(docs, empty))] == [r[:4] for r in brute_importance([(r[0], r[1]) for r in ROWS], [], 10_000, 25, 20, 7)]


def test_importance_prefers_the_target(spark):
    """Documents in the target's words are drawn before others, whatever the noise of a few."""
    rng = random.Random(8)
    like = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60))) for i in range(100)]
    other = [(100 + i, " ".join(rng.choice(["uno", "dos", "tres", "cuatro"]) for _ in range(60))) for i in range(300)]
    out = importance.importance_sample(spark.createDataFrame(like + other, "doc_id long, text string"), spark.createDataFrame([(like[0][1],)], "text string"))
    drawn = [r.doc_id for r in out.where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(d < 100 for d in drawn) > 60  # 25 by chance


# ball trees


def brute_clusters(rows, k, rounds, seed, size):
    kept = [(i, [math.floor(256 * float(v)) for v in x]) for i, x in rows if x is not None and len(x) == size and all(v is not None and math.isfinite(v) for v in x)]
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [x for _, x in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, z)), c) for c, z in enumerate(centroids))
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, x in kept:
            groups[nearest(x)[1]].append(x)
        centroids = [[sum(col) // len(groups[c]) for col in zip(*groups[c])] if c in groups else z for c, z in enumerate(centroids)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    inertia = collections.Counter()
    for _, c, d in found:
        inertia[c] += d
    names = [hashlib.sha256(",".join(map(str, z)).encode()).hexdigest() for z in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), names[c]) for i, c, d in found), key=repr)


def vectors(n, size, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size)) * 2
    rows = [(i, (centres[i % 6] + rng.normal(size=size) * (0.02 if i % 3 else 0.5)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n, rows[0][1]), (n + 1, rows[0][1]), rows[5], (None, rows[7][1]), (n + 2, None), (n + 3, rows[0][1][:-1]), (n + 4, [*rows[0][1][:-1], None]), (n + 5, [*rows[0][1][:-1], float("nan")]), (n + 6, [*rows[0][1][:-1], float("-inf")]), (n + 7, [])]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int, v int, cluster int"


@pytest.mark.parametrize(("k", "tree", "leaf"), [(4, 50, 3), (40, 4096, 16), (500, 64, 1)])
def test_ball_tree_clusters(spark, k, tree, leaf):
    rows = vectors(150, 64)
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS).repartition(3)
    assert rows_of(balltree.cluster_vectors(table, k=k, tree=tree, leaf=leaf)) == brute_clusters(rows, k, balltree.ROUNDS, balltree.SEED, 64)


def test_ball_tree_empty_equal_and_huge(spark):
    assert balltree.cluster_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    same = [(i, [0.5, -0.25]) for i in range(60)]
    out = balltree.cluster_vectors(spark.createDataFrame(same, "vec_id long, embedding array<double>"), size=2, k=5)
    assert {tuple(r)[1:5] for r in out.collect()} == {(0, 0, 0, 0)} and out.count() == 60
    huge = [(1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [1.0, 1.0])]
    got = balltree.cluster_vectors(spark.createDataFrame(huge, "vec_id long, embedding array<float>"), size=2, k=2, rounds=1)
    assert got.count() == 3 and got.where("distance < 0").count() == 0


def test_whole_balls_are_assigned():
    """Far clusters need no leaf: every vector goes with a ball, and equals the exact assignment."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-5000, 5000, (8, 64))
    x = centres[np.arange(800) % 8] + rng.integers(-3, 4, (800, 64))
    tree = balltree.build(np.arange(800), np.zeros(800, bool), x)
    whole, places, owners = balltree.walk(tree, centres)
    assert len(places) < 80 and sum(tree.count[n] for n, _ in whole) + len(places) == 800
    cluster = np.full(800, -1)
    cluster[places] = owners
    for node, c in whole:
        cluster[tree.first[node] : tree.first[node] + tree.count[node]] = c
    assert (cluster == balltree.squared(tree.vectors, centres).argmin(1)).all()
    again = balltree.Tree.unpack(next(pd.DataFrame([tree.pack()]).itertuples()))
    assert (again.vectors == tree.vectors).all() and (again.total == tree.total).all() and (again.radius == tree.radius).all()
    big = x * (1 << 14)
    assert (balltree.squared(big[:5], big[5:9]) == ((big[:5, None] - big[None, 5:9]) ** 2).sum(2)).all()


# maximum entropy


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + ["\n"]


def test_maxent_base_and_counts(spark, docs, empty):  # noqa: F811
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter()
    for r in ROWS:
        if not held(r[0]):
            counts.update(tokens_of(r[1]))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(((r[0], held(r[0]), len(tokens_of(r[1])), sum(counts[t] > 0 for t in tokens_of(r[1])), n, round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens_of(r[1])), 6)) for r in ROWS), key=repr)
    got = maxent.score_texts(docs, rounds=2).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == expected
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    assert maxent.score_texts(empty).count() == 0


def test_maxent_with_rare_words(spark, docs):  # noqa: F811
    """Few known words: the others, and their counts, come by the join, with the same base score."""
    whole = {(r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in maxent.score_texts(docs, rounds=1).collect()}
    few = maxent.score_texts(docs, rounds=1, head_bits=4, known_bits=6)
    assert {(r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in few.collect()} == whole


def trained(spark, seed=5, n=400):
    """Texts in which each word fixes the next one nearly always, and their model."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(n):
        at, out = rng.randrange(40), []
        for _ in range(30):
            out.append(words[at])
            at = (at * 3 + 1) % 40 if rng.random() < 0.9 else rng.randrange(40)
        texts.append(" ".join(out))
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_maxent_learns_what_follows(spark):
    r = maxent.score_texts(trained(spark)).where("held_out").selectExpr("sum(score) / sum(n_tokens) s", "sum(base_score) / sum(n_tokens) b", "count(*) n").first()
    assert r.n > 30 and r.s > r.b + 0.3


def test_maxent_chances_sum_to_one(spark):
    """Over all words that a history may be followed by: known ones, each rare one and one never seen."""
    rows = trained(spark, n=60).selectExpr("doc_id", "text", "false held_out", "0 fold")
    rare = spark.createDataFrame([(900, "seldom " + "w1 w2 " * 3, False, 0)], rows.schema)
    counts = maxent.word_counts(rows.unionByName(rare)).cache()
    v = maxent.vocabulary(counts)
    w = maxent.train(maxent.encoded(rows, v).cache(), v, 1)
    assert any(t.any() for t in w.tables())
    all_ids = np.concatenate([np.arange(len(v.counts)), [-5]])
    history = [0, 3, -7]
    ids = np.concatenate([np.array([*history, i], np.int32) for i in all_ids])
    starts = np.arange(len(all_ids)) * 4
    logs = np.concatenate([maxent.log10_chances(v, w, b) for _, b in maxent.batches(v, w, ids, starts)])[3::4]
    inside = np.concatenate([v.inside, [0.0]])
    assert abs((10 ** (logs + inside)).sum() - 1) < 1e-4


def test_maxent_gradient(spark, monkeypatch):
    """Sums of expected and observed counts against a loop over tokens, whatever the batches."""
    rows = trained(spark, n=12).selectExpr("doc_id", "text", "false held_out", "0 fold")
    v = maxent.vocabulary(maxent.word_counts(rows))
    coded = maxent.encoded(rows, v).cache()
    w = maxent.Weights.none(v, 6, 7)
    rng = np.random.default_rng(2)
    w = maxent.Weights(rng.normal(size=w.classes.shape).astype(np.float32), rng.normal(size=w.words.shape).astype(np.float32))
    ids, starts = maxent.joined(coded.toPandas()["ids"])
    sums = [np.zeros((2, *t.shape)) for t in w.tables()]
    for _, b in maxent.batches(v, w, ids, starts):
        for kind, (p, of_rows, target) in enumerate(zip(maxent.chances(v, w, b), (b.class_rows, b.word_rows), (b.klass, b.column))):
            for i in range(len(p)):
                for r in of_rows:
                    sums[kind][0, r[i]] += p[i]
                    sums[kind][1, r[i], target[i]] += 1
    monkeypatch.setattr(maxent, "BATCH", 17)
    for kind, what, block, values in maxent.gradient(coded.repartition(3), v, w):
        size = sums[kind].shape[1] // maxent.BLOCKS
        assert np.allclose(values.reshape(size, -1), sums[kind][what, block * size : (block + 1) * size], atol=1e-3)
