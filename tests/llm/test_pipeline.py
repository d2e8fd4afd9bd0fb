"""The pipeline's stages, one after the other, on the smallest documents."""

import collections
import random

import numpy as np
import pytest

pytest.importorskip("tandemlake.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, DATA)
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            if name == "language":
                assert docs.count() == before
            if name == "near_duplicates":
                assert docs.select("text").distinct().count() == docs.count() < before
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node int, copies double, row string"


def test_stages_on_an_empty_table(spark):
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, spark.createDataFrame([], SCHEMA), DATA)
        assert out.count() == 0 and (i == 4 or out.columns == COLUMNS)


def test_stages_against_plain_versions(spark):
    """Nulls in every column, empty and long texts, equal texts under several ids, rows repeated whole, clashing columns."""
    from tandemlake.llm import encoding, langid, mixing, pii

    rng = random.Random(23)
    make = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))
    kinds = {"aa": ["ba", "lo", "mi", "ta", "re"], "bb": ["st", "ung", "kei", "der"]}
    rows = [(i, make(kinds[lang], rng.randint(8, 90)), lang, ["x", "y", None][i % 3], 1) for i, lang in enumerate(["aa", "bb"] * 30)]
    words = rows[4][1].split() if len(rows[4][1].split()) > 40 else (rows[4][1] + " " + make(kinds["aa"], 60)).split()
    rows[4] = (4, " ".join(words), "aa", "y", 2)
    rows += [(100, " ".join([*words[:-1], "balomi"]), None, "x", None), (101, rows[7][1], "bb", "y", 5), rows[9], rows[9], (None, make(kinds["bb"], 30), "bb", None, None)]
    rows += [(102, None, "aa", "x", None), (103, "", "aa", "x", 0), (104, "123 456", None, "y", 7), (105, make(kinds["aa"], 5000), "aa", "y", 9), (106, "write to bob.lee@mail.example.org or +1 555 123 4567 " + make(kinds["aa"], 30), "aa", "x", 3)]
    docs = spark.createDataFrame([(*r, "k", 1, 0.5, "r") for r in rows], SCHEMA).repartition(3)
    bag = lambda df: collections.Counter(map(tuple, df.select(*COLUMNS).collect()))
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language"](spark, docs, DATA)
    gone = {(r.doc_id, r.text_hash) for r in langid.identify_language(docs).where("rejected").collect()}
    assert {i for i, _ in gone} >= {102, 103, 104} and len(gone) <= 5
    after = bag(kept)
    assert after == collections.Counter({k: n for k, n in bag(docs).items() if k[0] not in {i for i, _ in gone}})

    docs = spark.createDataFrame(kept.collect(), kept.schema)
    texts = list(dict.fromkeys(k[1] for k in after))
    sets = [set(zip(*[t.split()[j:] for j in range(5)], strict=False)) for t in texts]
    parent = list(range(len(texts)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least: dict[int, tuple] = {}
    for k in after:
        c = find(texts.index(k[1]))
        least[c] = min(least.get(c, k), k, key=lambda k: (k[0] is None, k[0] or 0))
    kept = stages["near_duplicates"](spark, docs, DATA)
    after = bag(kept)
    assert after == collections.Counter(least.values()) and len(after) < sum(bag(docs).values())

    docs = spark.createDataFrame([*kept.collect(), (200, None, None, None, None), (201, "", None, "x", 0)], kept.schema)
    model = pii.Field(*pii.train())
    plain = collections.Counter()
    for k, n in bag(docs).items():
        text = k[1] if k[1] is None else pii.redact(k[1], pii.find([k[1]], model)[0][1])
        plain[(k[0], text, k[2], k[3], k[4] if text is None else len(text))] += n
    redacted = stages["personal_data"](spark, docs, DATA)
    assert bag(redacted) == plain and any(k[1] and k[1].startswith("write to [EMAIL] or [PHONE]") for k in plain)

    docs = spark.createDataFrame([*redacted.collect(), *redacted.limit(1).collect()], redacted.schema)
    plan: dict = {}
    for r in mixing.mix_sources(docs).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.copies
    mixed = stages["mixture"](spark, docs, DATA)
    after = bag(mixed)
    got = collections.Counter()
    for k, n in after.items():
        got[k[0]] += n
    assert got == {k: n for k, n in plan.items() if n} and set(after) <= set(bag(docs))

    docs = spark.createDataFrame(mixed.collect(), mixed.schema)
    pieces = stages["packing"](spark, docs, DATA).orderBy("sequence_id", "offset").collect()
    tokens = collections.Counter()
    for k, n in after.items():
        ids = np.frombuffer(encoding.encode_bytes([k[1]])[0] + b"\0\0", np.uint16)
        for t, c in zip(*np.unique(ids, return_counts=True), strict=True):
            tokens[int(t)] += int(c) * n
    found = collections.Counter()
    for p in pieces:
        found.update(np.frombuffer(p.ids, "<u4").tolist())
    assert found == tokens
    sizes = collections.Counter()
    for p in pieces:
        assert p.offset == sizes[p.sequence_id]
        sizes[p.sequence_id] += p.length
    assert all(n <= 1024 and n & (n - 1) == 0 for n in sizes.values())
