"""The training-data operators against brute force, on a small table of every awkward kind of row."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("tandemlake.llm")

from tandemlake.llm import encoding, kernels, langid, licenses, media, mixing, neardup, packing, pii, quality, substring, tokenfile  # noqa: E402
from tandemlake.llm.common import documents  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pid string, node int, key double, uid string, size string, place boolean, words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice(['ab', 'ex', 'un', 'tor', 'qui'])}{rng.randrange(vocabulary):x}" for _ in range(n))


def awkward() -> list[tuple]:
    rng = random.Random(9)
    passage = sentence(rng, 60)
    base = sentence(rng, 120)
    words = base.split()
    near = [" ".join(words[:i] + ["changed"] + words[i + 1 :]) for i in (0, 40, 119)]
    texts = [sentence(rng, rng.randint(1, 200)) for _ in range(20)]
    texts += [base, base, base, *near, passage + " " + sentence(rng, 30), sentence(rng, 30) + "\n" + passage, "x\n" + passage + "\n\ny", passage]
    texts += [None, None, "", "", " ", "\n\n", "one", "one", "  \x1c", "É ß Σς İ 日本 \U0001f600", "a  b\tc\r\nd", "same same same " * 40, sentence(rng, 6000), "!!! ### $$$ " * 30, "line a b\nline a b\n\nline a b\n"]
    texts += ["mail a.b+c@x-y.example.org, 10.0.0.1 and 4111 1111 1111 1111 or +1 (555) 123-4567.", "[x@y] @@ 1.2.3.999 +12 4111-1111-1111-1112", "tel +1 (269) 555-3296 4524132264652876 end"]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "hot", "hot"][i % 5], len(t) if t else None) for i, t in enumerate(texts)]
    rows += [rows[3], rows[20], (None, "null id " + sentence(rng, 40), "en", "a", 1), (None, None, None, None, None)]
    return rows


ROWS = awkward()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "p", 1, 2.0, "u", "s", True, 3) for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(pdf, columns):
    return collections.Counter(tuple(None if v is pd.NA or v is None or v != v else v for v in r) for r in pdf[columns].itertuples(index=False))


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (quality.quality_rules(empty, labels), langid.identify_language(empty), substring.dedup_substrings(empty), packing.pack_documents(empty), licenses.license_scan(empty), neardup.near_duplicates(empty),
                mixing.mix_sources(empty), pii.find_pii(empty), media.media_columns(media.to_media(empty)), tokenfile.read_tokens(spark, tokenfile.write_tokens(empty))):
        assert out.count() == 0


def test_statistics():
    texts = [r[1] for r in ROWS]
    got = pd.DataFrame(quality.statistics(texts))
    for text, row in zip(texts, got.itertuples(), strict=True):
        w = WORD.findall(text or "")
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        many = collections.Counter(grams)
        covered = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(3)}
        lines, seen = 0, set()
        for line in (text or "").split("\n"):
            if WORD.search(line):
                lines += line in seen
                seen.add(line)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(covered))


def test_quality_rules(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (1, None)], "doc_id long, quality int")
    out = quality.quality_rules(docs, labels).toPandas()
    assert len(out) == len(ROWS) and not out[out.base_failed].kept.any()
    assert quality.quality_rules(docs, None).where("not kept and not base_failed").count() == 0


def test_flat_trees_score_like_a_walk():
    """Node arrays against one row at a time, node by node, and each signed feature against its sign."""
    rng = np.random.default_rng(11)
    signs = list(quality.FEATURES.values())
    x = np.round(rng.random((800, len(signs))), 2)
    model = quality.fit(x, (x[:, 0] + x[:, 5] + 0.3 * rng.random(800) < 1).astype(float), signs)
    for row, got in zip(x[:100], model.margin(x[:100]), strict=True):
        total = model.bias
        for node in model.roots.tolist():
            while model.left[node] != node:
                node = int(model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node])
            total += model.value[node]
        assert abs(total - got) < 1e-9
    for j, sign in enumerate(signs):
        line = np.repeat(x[:1], 50, axis=0)
        line[:, j] = np.linspace(0, 1, 50)
        assert not sign or (np.diff(model.margin(line)) * sign >= -1e-12).all()


def test_quality_sample_is_bounded(spark, docs, monkeypatch):
    """The fit sees just sample_rows labelled rows, the same ones however the rows lie."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y, signs: seen.append((x, y)) or quality.Ensemble(np.zeros(0, int), np.zeros(0), np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0, int), 0, 0.0))
    for rows in (docs, docs.repartition(6)):
        quality.quality_rules(rows, labels, sample_rows=12)
    assert seen[0][0].shape[0] == 12 and (seen[0][0] == seen[1][0]).all() and (seen[0][1] == seen[1][1]).all()


def test_ensemble_is_monotone_and_fits():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = (x[:, 0] + 0.3 * np.sin(20 * x[:, 1]) + 0.1 * rng.normal(size=2000) < 0.5).astype(float)
    model = quality.fit(x, y, [-1, 0, 0])
    assert ((model.probability(x) > 0.5) == (y > 0.5)).mean() > 0.9
    line = np.column_stack([np.linspace(0, 1, 200), np.full(200, 0.3), np.full(200, 0.7)])
    assert (np.diff(model.margin(line)) <= 1e-12).all()


def test_language_models():
    rng = random.Random(4)
    make = lambda parts: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(60))
    train_texts = {"aa": [make(["ba", "lo", "mi"]) for _ in range(20)], "bb": [make(["st", "ung", "kei"]) for _ in range(20)]}
    lang, gram, n = [], [], []
    for i, (_, texts) in enumerate(sorted(train_texts.items())):
        g, c = np.unique(langid.symbols(texts).grams, return_counts=True)
        lang.append(np.full(len(g), i)), gram.append(g), n.append(c)
    model = langid.train(["aa", "bb"], np.concatenate(lang), np.concatenate(gram), np.concatenate(n))
    # each context's probabilities sum to one over the vocabulary and the unseen symbol
    for history in ("bal", "zzz"):
        codes = [langid.symbols([history + c]).grams[-1] for c in sorted({c for t in train_texts["aa"] + train_texts["bb"] for c in t})]
        total = np.exp(model.log_probabilities(np.array(codes, np.uint64))).sum(0)
        assert (total <= 1.0 + 1e-5).all() and (total > 0.8).all()
    s = langid.symbols([make(["ba", "lo", "mi"]), make(["st", "ung", "kei"])])
    p = np.add.reduceat(model.log_probabilities(s.grams), s.bounds[:-1], axis=0)
    assert p.argmax(1).tolist() == [0, 1]


def _kneser_ney(texts, history, symbol, vocabulary):
    """The interpolated probability by its definition, from plain counters."""
    grams = {}
    whole = collections.Counter()
    for t in texts:
        padded = "\1\1\1" + t
        whole.update(padded[i - 3 : i + 1] for i in range(3, len(padded)))
    grams[4] = whole
    for order in (3, 2, 1):
        grams[order] = collections.Counter(g[1:] for g in grams[order + 1])
    p = 1 / vocabulary
    for order in (1, 2, 3, 4):
        ones, twos = (sum(c == v for c in grams[order].values()) for v in (1, 2))
        discount = min(max(ones / max(ones + 2 * twos, 1) if ones + twos else 0.5, 0.05), 0.95)
        of = history[len(history) - order + 1 :] if order > 1 else ""
        follow = {g: c for g, c in grams[order].items() if g[:-1] == of}
        total = sum(follow.values())
        if total:
            p = max(follow.get(of + symbol, 0) - discount, 0) / total + discount * len(follow) / total * p
    return p


def test_language_models_are_kneser_ney():
    rng = random.Random(14)
    texts = {lang: [" ".join("".join(rng.choice(parts) for _ in range(2)) for _ in range(30)) for _ in range(8)] for lang, parts in (("aa", ["ba", "lo", "mi"]), ("bb", ["st", "un", "kei", "lo"]))}
    lang, gram, n = [], [], []
    for i, t in enumerate(texts.values()):
        g, c = np.unique(langid.symbols(t).grams, return_counts=True)
        lang.append(np.full(len(g), i)), gram.append(g), n.append(c)
    model = langid.train(list(texts), np.concatenate(lang), np.concatenate(gram), np.concatenate(n))
    vocabulary = len({c for t in texts.values() for x in t for c in x}) + 1
    for text in ("bal", "un lost", "kei mi"):
        found = np.exp(model.log_probabilities(langid.symbols([text]).grams))
        padded = "\1\1\1" + text
        for i in range(len(text)):
            for k, own in enumerate(texts.values()):
                if (got := _kneser_ney(own, padded[i : i + 3], text[i], vocabulary)) and any(text[i] in x for x in own):
                    assert abs(found[i, k] - got) < 1e-6, (text, i, k)


def test_language_id(docs):
    out = langid.identify_language(docs).toPandas()
    assert len(out) == len(ROWS) and out.score.between(0, 1).all()
    und = {r[0] for r in ROWS if r[1] is None or not any(c.isalpha() for c in r[1])}
    assert set(out[out.lang_pred == "und"].doc_id.astype("Int64").dropna()) == {i for i in und if i is not None}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(60)}
    assert all(held[r.doc_id] == r.held_out for r in out.dropna(subset=["doc_id"]).itertuples())
    assert langid.accepted_documents(docs).count() <= len(ROWS)


def test_hash_array():
    keys = kernels.stream(5000, 3)
    table = langid.HashArray.of(keys, np.arange(5000))
    at = table.find(np.concatenate([keys, kernels.stream(100, 4)]))
    assert (table.rows[at[:5000]] == np.arange(5000)).all() and (at[5000:] == -1).all()


@pytest.mark.parametrize("encode, name", [(encoding.encode_words, "word_bpe_49k.json"), (encoding.encode_bytes, "byte_bpe_50k.json")])
def test_encoding(encode, name):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(2)
    texts = [r[1] or "" for r in ROWS] + ["".join(rng.choice(["a", "B.", ",", "!", "'s", " ", " ", "\n", "é", "1", " ", "\t", "Ω", "́"]) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    assert encode(texts) == [np.array(e.ids, np.uint16).tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_shard_round_trip():
    rng = np.random.default_rng(3)
    ranks = np.concatenate([rng.integers(0, 300, 500), [0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1]]).astype(np.uint32)
    counts, ids = np.array([500, 0, 7]), np.array([-5, 0, 9])
    a, b, c = tokenfile.unpack(tokenfile.pack(ids, counts, ranks))
    assert (a == ids).all() and (b == counts).all() and (c == ranks).all()
    assert [len(x) for x in tokenfile.unpack(tokenfile.pack(ids[:0], counts[:0], ranks[:0]))] == [0, 0, 0]
    with pytest.raises(ValueError):
        tokenfile.unpack(b"none")


def test_token_file(spark, docs, tmp_path):
    path = tokenfile.write_tokens(docs, f"file:{tmp_path}/tokens")
    out = tokenfile.read_tokens(spark, path).toPandas().sort_values("start")
    want = collections.Counter((r[0], encoding.encode_words([r[1]])[0] + b"\2\0") for r in ROWS)
    got = collections.Counter((None if pd.isna(r.doc_id) else r.doc_id, np.frombuffer(r.ids, "<u4").astype(np.uint16).tobytes()) for r in out.itertuples())
    assert got == want
    assert out.start.tolist() == (out.n_tokens.cumsum() - out.n_tokens).tolist() and out.doc_id.dropna().is_monotonic_increasing
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in out.itertuples())
    # the folder alone decodes, without any of the library's state, and reruns agree
    ranked = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").toPandas()
    counts = collections.Counter(t for r in out.itertuples() for t in np.frombuffer(r.ids, "<u4").tolist())
    assert ranked.n.is_monotonic_decreasing and {i: n for i, n in zip(ranked.id, ranked.n, strict=True) if n} == counts
    again = tokenfile.read_tokens(spark, tokenfile.write_tokens(docs.repartition(7))).toPandas().sort_values("start")
    assert again.ids.tolist() == out.ids.tolist() and again.start.tolist() == out.start.tolist()


@pytest.mark.parametrize("group", [1, 256])
def test_substring_dedup(docs, group):
    order = sorted({(r[0] if r[0] is not None else 1 << 62, r[1]) for r in ROWS}, key=lambda x: (x[0], x[1] or ""))
    seen, want = set(), {}
    for doc_id, text in order:
        w = [x.encode() for x in WORD.findall(text or "")]
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if key in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(key)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[(None if doc_id == 1 << 62 else doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode())] = 1
    got = by_row(substring.dedup_substrings(docs, group=group).toPandas(), ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
    assert set(got) == set(want) and sum(got.values()) == len(ROWS)


def _removed(rows, length):
    """Words kept of each (doc_id, text), by brute force."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        w = WORD.findall(text)
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            if key in seen:
                gone[s : s + length] = [True] * length
            seen.add(key)
        out[doc_id] = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
    return out


@pytest.mark.parametrize("length, group", [(1, 2), (4, 3), (20, 2), (20, 8), (75, 4)])
def test_substring_dedup_of_shared_passages(spark, length, group):
    """One passage in all documents, one phrase in all with words of their own around it, periodic texts and near copies."""
    rng = random.Random(17)
    passage, phrase, base = sentence(rng, 80), sentence(rng, 7), sentence(rng, 150).split()
    texts = [f"{sentence(rng, rng.randint(0, 9))} {passage} {sentence(rng, 20)} {phrase} {sentence(rng, 20)}" for _ in range(24)]
    texts += ["a b " * 60, "a " * 100, " ".join(base), *[" ".join([*base[:i], "x", *base[i:]]) for i in range(0, 150, 10)]]
    rows = list(enumerate(texts))
    out = substring.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), length=length, group=group).collect()
    assert {r.doc_id: r.kept for r in out} == _removed(rows, length)


def test_words_of_one_hash_are_told_apart():
    w = kernels.words(["a bb a cc bb ddd", "ddd a", None])
    w.hashes[:] = 7
    plain = b"a bb a cc bb ddd ddd a".split()
    got = kernels.names(w)
    assert [[x == y for y in got] for x in got] == [[x == y for y in plain] for x in plain]
    assert len(kernels.names(kernels.words([None, ""]))) == 0


def test_deep_nodes():
    """Suffix order, depths and earliest leaves against all pairs."""
    rng = np.random.default_rng(5)
    words = rng.integers(0, 2, 300)
    first = np.arange(270)
    sizes = rng.integers(5, 25, 270)
    group = rng.integers(0, 2, 270).astype(np.uint64)
    depth, later, leads = substring.deep_nodes(words, first, sizes, group, [first], 5)
    for i in range(270):
        equal = [j for j in range(270) if group[i] == group[j] and (words[first[i] : first[i] + 5] == words[first[j] : first[j] + 5]).all()]
        shared = min(sizes[j] for j in equal)
        while not all((words[first[j] : first[j] + shared] == words[first[i] : first[i] + shared]).all() for j in equal):
            shared -= 1
        assert depth[i] == shared and later[i] == (i != min(equal)) and leads[i] == (i == min(equal))


def test_packing(docs):
    out = packing.pack_documents(docs).toPandas()
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == (s.length.cumsum() - s.length).tolist()
        n = int(s.length.sum())
        assert n <= 1024 and (n & (n - 1)) == 0
    want = collections.Counter((r[0], encoding.encode_bytes([r[1]])[0] + b"\0\0") for r in ROWS)
    total = sum(len(k[1]) // 2 * n for k, n in want.items())
    assert out.length.sum() == total and (out.ids_crc32 == out.ids.map(zlib.crc32)).all()
    for (doc_id, ids), _n in want.items():
        pieces = out[(out.doc_id.isna() if doc_id is None else out.doc_id == doc_id) & (out.doc_tokens == len(ids) // 2)]
        wide = np.frombuffer(ids, np.uint16).astype("<u4").tobytes()
        assert all(p.ids == wide[4 * p.start : 4 * (p.start + p.length)] for p in pieces.itertuples())


@pytest.mark.parametrize("weights, grain", [((3.0, 1.0, 2.0), 128), ((1.0, 50.0), 7), (None, 16)])
def test_packing_is_a_literal_round_robin(docs, weights, grain):
    """The stream of pieces against queues that are credited and served one round after the other."""
    length = 64
    out = packing.pack_documents(docs, weights=weights, grain=grain, length=length).toPandas()
    queues = {}
    for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        queues.setdefault(r[3], []).extend(np.frombuffer(encoding.encode_bytes([r[1]])[0] + b"\0\0", np.uint16).tolist())
    names = sorted(queues, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] if weights else float(len(queues[s])) for i, s in enumerate(names)}
    quantum = {s: weight[s] / sum(weight.values()) * length for s in names}
    stream, turn, served, pieces = [], 0, dict.fromkeys(names, 0), dict.fromkeys(names, 0)
    while any(served[s] < len(queues[s]) for s in names):
        for s in names:
            size = max(quantum[s], grain)
            while pieces[s] * size < (turn + 1) * quantum[s] - 1e-7 and served[s] < len(queues[s]):
                pieces[s] += 1
                upto = min(len(queues[s]), int(np.ceil(pieces[s] * size - 1e-9)))
                stream += [(s, t) for t in queues[s][served[s] : upto]]
                served[s] = upto
        turn += 1
    out = out.sort_values(["sequence_id", "offset"])
    got = [(None if r.source is None or r.source != r.source else r.source, t) for r in out.itertuples() for t in np.frombuffer(r.ids, "<u4").tolist()]
    # tokens by source; documents of one doc_id may come in any order
    assert [s for s, _ in got] == [s for s, _ in stream]
    assert collections.Counter(got) == collections.Counter(stream)


def test_packing_follows_target_shares(spark):
    rows = [(i, "a b c d e f g h " * 8, None, "x" if i % 4 else "y", 1) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = packing.pack_documents(docs, shares={"x": 1.0, "y": 1.0}, window=4, with_ids=False).toPandas()
    early = out[out.sequence_id < 20].groupby("source").length.sum()
    assert abs(early["x"] - early["y"]) < 1500
    even = packing.pack_documents(docs, window=4, with_ids=False).toPandas()
    for _, part in even[even.sequence_id < 40].groupby(even.sequence_id // 4):
        share = part[part.source == "y"].length.sum() / part.length.sum()
        assert 0.15 < share < 0.35


def test_licenses(spark):
    mit = dict(reversed(licenses.LICENSES))["MIT"]
    texts = ["Copyright (c) 2020 Someone\n\n" + licenses._MIT.upper().replace(",", " ;"), licenses._ISC.replace("\n", "  \n"), "Released under the MIT licence!\nfoo", "foo\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.\n", "", None, "license", mit + " more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.license, r.n_notices, r.notices) for r in licenses.license_scan(docs).collect()}
    assert got[0][0] == "MIT" and got[1][0] == "ISC" and got[3] == (None, 2, "CC-BY-NC-4.0,MIT") and got[7][0] is None
    assert got[2] == (None, 1, "MIT")
    assert all(got[i] == (None, 0, "") for i in (4, 5, 6))


def test_whole_licenses(spark):
    """Each known licence, entire, in another case, spelling, wrapping and punctuation and under another's copyright line;
    with a word more or less it is none."""
    assert {"Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= {name for name, _ in licenses.WHOLE}
    rows, want = [], []
    for name, text in licenses.LICENSES:
        own = re.sub("(?i)license", "licence", text).replace("organization", "organisation").replace("(c) You must", "(c)  You must")
        own = "\n".join("  # " + line.rstrip().replace(",", " , ") for line in own.split("\n"))
        rows += ["  Copyright (C) 2024 Some One\n\n" + own.upper(), text + " and more", " ".join(text.split()[1:])]
        want += [name, None, None]
    known = {tuple(WORD.findall(t)) for _, t in licenses.LICENSES}
    want = [w if i % 3 == 0 or tuple(rows[i].split()) not in known else "any" for i, w in enumerate(want)]
    got = licenses.license_scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.license if w != "any" else "any" for r, w in zip(got, want, strict=True)] == want


@pytest.mark.parametrize("block", [neardup.BLOCK, 700])
def test_near_duplicates(docs, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = list(dict.fromkeys(r[1] for r in ROWS if r[1] is not None))
    sets = [set(zip(*[WORD.findall(t)[j:] for j in range(5)], strict=False)) for t in texts]
    links, parent = collections.Counter(), list(range(len(texts)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    classes = collections.defaultdict(list)
    for r in ROWS:
        if r[1] is not None and r[0] is not None:
            classes[find(texts.index(r[1]))].append(r[0])
    out = neardup.near_duplicates(docs).toPandas()
    assert len(out) == len(ROWS)
    want = {(r[0], min(classes[find(texts.index(r[1]))]), links[texts.index(r[1])]) for r in ROWS if r[1] is not None and r[0] is not None}
    nulls = {r[0] for r in ROWS if r[1] is None}
    got = {(r.doc_id, r.class_id, r.n_links) for r in out.dropna(subset=["doc_id"]).itertuples() if r.doc_id not in nulls}
    assert got == want and sum(links.values()) >= 6
    kept = neardup.distinct_documents(docs).toPandas()
    assert kept.text.dropna().is_unique and len(kept) == out.groupby("class_id", dropna=False).ngroups + 1


def test_connected_components(spark):
    edges = [(b"%04d" % i, b"%04d" % (i + 1)) for i in range(200) if i % 50] + [(b"a", b"b"), (b"c", b"b"), (b"b", b"a")]
    got = {r.node: r.label for r in neardup.connected(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in edges], "a binary, b binary")).collect()}
    assert got[b"c"] == b"a" and got[b"0049"] == b"0001" and got[b"0199"] == b"0151"


def test_recall_of_prefixes():
    assert neardup.recall(0.8, 3, 12) > 0.9995 > neardup.recall(0.8, 4, 12)
    assert neardup.estimated_recall(0, 0.0, 0.8, 3, 12) == neardup.recall(0.8, 3, 12)
    # of many pairs the found ones tell how many there are
    rng = np.random.default_rng(3)
    similar = rng.uniform(0.8, 1, 20000)
    found = similar[rng.random(20000) < neardup.recall(similar, 4, 3)]
    assert abs(neardup.estimated_recall(len(found), (1 / neardup.recall(found, 4, 3)).sum(), 0.8, 4, 3) - len(found) / 20000) < 0.01


def test_labels_are_a_trie():
    rng = np.random.default_rng(4)
    sig = rng.integers(0, 3, (200, 8)).astype(np.uint32)
    found = neardup.labels(sig, 2, 4)
    a, b = np.triu_indices(200, 1)
    common = neardup.shared_prefix(sig, a, b, 2, 4)
    for t in (0, 1):
        own = found[t::2]
        brute = [next((j for j in range(4) if own[x][1 + 4 * j : 5 + 4 * j] != own[y][1 + 4 * j : 5 + 4 * j]), 4) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        assert common[:, t].tolist() == brute and all(x[0] == t for x in own)
        assert sorted(range(200), key=lambda i: own[i]) == sorted(range(200), key=lambda i: sig[i, 4 * t : 4 * t + 4].tolist())


def test_prefixes_are_shortened_until_the_target(spark):
    """Pairs at 0.8 and few trees: full prefixes miss some, shortened ones find all."""
    rng = random.Random(21)
    rows = []
    for i in range(120):
        w = sentence(rng, 85, 1 << 20).split()
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(["x", "y", *w[1:40], "z", *w[41:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    full, short = (neardup.near_duplicates(docs, trees=3, target=t).toPandas() for t in (0.0, 0.995))
    assert (full.n_links > 0).mean() < 0.95 and (short.n_links == 1).mean() > 0.95
    assert (short.class_id == short.doc_id // 2 * 2)[short.n_links == 1].all()


def test_mixing(docs):
    a, b = mixing.mix_sources(docs).toPandas(), mixing.mix_sources(docs.repartition(5)).toPandas()
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    assert by_row(a, cols) == by_row(b, cols) and len(a) == len(ROWS)
    assert (a.taken <= 2 * a["size"]).all()
    assert by_row(a, ["doc_id", "size"]) == collections.Counter((r[0], len(WORD.findall(r[1] or ""))) for r in ROWS)
    sums = a.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"), size=("size", "sum"))
    assert (abs(sums.taken - sums.target) <= sums.most).all() and abs(sums.target.sum() - 1.5 * sums["size"].sum()) < 1e-6
    assert mixing.mixed_documents(docs).count() > 0


def _brute_fill(sizes, weights, total, most):
    caps, full = [most * s for s in sizes], set()
    while len(full) < len(sizes):
        level = max(0.0, total - sum(caps[i] for i in full)) / sum(w for i, w in enumerate(weights) if i not in full)
        over = {i for i in range(len(sizes)) if i not in full and level * weights[i] > caps[i]}
        if not over:
            break
        full |= over
    return [caps[i] if i in full else level * weights[i] for i in range(len(sizes))]


def test_water_fill(spark):
    rng = random.Random(3)
    for n in (1, 3, 40):
        sizes = [rng.choice([0, 10, 100, rng.randrange(5000)]) for _ in range(n)]
        weights = [(3.0, 1.0, 2.0)[i % 3] for i in range(n)]
        rows = [(f"s{i:03}", s, i, w) for i, (s, w) in enumerate(zip(sizes, weights, strict=True))]
        out = {r.source: r.target for r in mixing.water_fill(spark.createDataFrame(rows, "source string, size long, place long, weight double"), 1.5 * sum(sizes)).collect()}
        assert np.allclose([out[f"s{i:03}"] for i in range(n)], _brute_fill(sizes, weights, 1.5 * sum(sizes), 2.0))


def test_source_weights(spark):
    rows = [(s,) for s in ["b", None, "a", "\U0001f600", "\uffee", "a", "", "Z"]]
    got = sorted((r.place, r.source, r.weight) for r in mixing.source_weights(spark.createDataFrame(rows, "source string").repartition(3)).collect())
    assert got == [(i, s, (3.0, 1.0, 2.0)[i % 3]) for i, s in enumerate(["", "Z", "a", "b", "\uffee", "\U0001f600", None])]


def test_mixed_documents_copies_each_row_as_planned(docs):
    plan = mixing.mix_sources(docs).toPandas()
    out = mixing.mixed_documents(docs).toPandas()
    assert len(out) == plan.copies.sum()
    want = plan.fillna({"doc_id": -1}).groupby("doc_id").copies.sum()
    got = out.fillna({"doc_id": -1}).groupby("doc_id").size()
    assert got.to_dict() == want[want > 0].to_dict()


def test_base_spans():
    kinds = pii.KINDS
    email, ip, card, phone = (re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))
    digits = lambda s: re.sub("[^0-9]", "", s)

    def brute(t):
        out = [("email", m.start(), m.end()) for m in email.finditer(t)] + [("ip", m.start(), m.end()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
        for m in card.finditer(t):
            d = digits(m.group())
            if 14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0:
                out.append(("card", m.start(), m.end()))
        out += [("phone", m.start(), m.end()) for m in phone.finditer(t) if 10 <= len(digits(m.group())) <= 15]
        return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))

    rng = random.Random(6)
    for t in [r[1] or "" for r in ROWS] + ["".join(rng.choice("1234ab@@..+- ()%0") for _ in range(rng.randint(0, 40))) for _ in range(20000)]:
        assert pii.base_spans(t) == brute(t)


def test_pii(docs):
    out = pii.find_pii(docs).toPandas()
    assert len(out) == len(ROWS)
    found = {r.doc_id: r.spans for r in out.dropna(subset=["doc_id"]).itertuples()}
    texts = {r[0]: r[1] for r in ROWS}
    at = next(i for i, t in texts.items() if t and t.startswith("tel +1 (269)"))
    assert "phone:4:21" in found[at]
    red = {r.doc_id: r.text for r in pii.redact_pii(docs).collect()}
    at = next(i for i, t in texts.items() if t and t.startswith("mail"))
    assert red[at] == "mail [EMAIL], [IP] and [CARD] or [PHONE]."


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    k = len(pii.LABELS)
    w, t = rng.normal(size=(50, k)), np.where(pii._ALLOWED, rng.normal(size=(k, k)), -1e4)
    seqs = [rng.integers(0, 50, (n, 3)) for n in (1, 4, 2, 3)]
    import itertools

    for s, got in zip(seqs, pii.viterbi([w[s].sum(1) for s in seqs], t), strict=True):
        e = w[s].sum(1)
        score = lambda y: sum(e[i, v] for i, v in enumerate(y)) + sum(t[a, b] for a, b in zip(y[:-1], y[1:], strict=True)) + (-1e4 if pii.LABELS[y[0]].startswith("I") else 0)  # noqa: E731, B023
        assert abs(score(got) - max(score(y) for y in itertools.product(range(k), repeat=len(s)))) < 1e-9


def _field_texts():
    rng = random.Random(31)
    marked = [re.sub(r"\{\w+ ([^}]*)\}", r"\1", line) for line in pii.LABELLED]
    texts = [" ".join(rng.choice([*marked, sentence(rng, 6), "4111", "1111", "555-12", "at", "dot", "(at)", "x" * 1000 + "9", "É日本"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    return [*texts, "", " ", "one", "tel 555-123-4567", "(212) 555-0199", " ".join(marked)]


def test_field_scores():
    """Scores by distinct words are the sums of each word's feature weights."""
    model = pii.Field(*pii.train())
    texts = _field_texts()
    w = kernels.words(texts)
    e, _, _ = model.scores(w)
    for i, t in enumerate(texts):
        own = WORD.findall(t)
        if own:
            assert np.allclose(e[w.first[i] : w.first[i + 1]], model.w[pii._features(own)].sum(1))


def test_field_decodes_whole_texts():
    """Cutting where a label is certain gives the labels of whole texts decoded at once, also by random transitions."""
    rng = np.random.default_rng(7)
    w, t = pii.train()
    for model in (pii.Field(w, t), pii.Field(w, np.where(pii._ALLOWED, t + rng.normal(size=t.shape), -1e4))):
        texts = _field_texts()
        words, runs = model.decode(texts)
        got = np.zeros(len(words.hashes), int)
        for first, labels in runs:
            got[first : first + len(labels)] = labels
        e, _, _ = model.scores(words)
        for i in range(len(texts)):
            a, b = words.first[i : i + 2]
            if a < b:
                assert got[a:b].tolist() == pii.viterbi([e[a:b]], model.t)[0].tolist()
        assert model.open_words(words, e).mean() < 0.6 and (got > 0).any()


def test_field_finds_beyond_long_words():
    """Data after a word of 1,000 characters, and in the middle of a long text."""
    model = pii.Field(*pii.train())
    text = sentence(random.Random(1), 3000) + " call " + "y" * 1000 + " phone (555) 123-4567 after five " + "z" * 1000
    at = text.index("(555)")
    assert pii.find([text], model)[0][1] == [("phone", at, at + 14)]


def test_media(docs):
    out = media.media_columns(media.to_media(docs)).toPandas()
    want = collections.Counter()
    for r in ROWS:
        raw = (r[1] or "").encode()
        p = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        stored = media.store_gif([p])[0]
        bins = [0] * 64
        for i in p:  # the colours of the palette: 3, 3 and 2 bits, of which a bin keeps two each
            red, green, blue = (i >> 5) * 255 // 7, (i >> 2 & 7) * 255 // 7, (i & 3) * 255 // 3
            bins[red // 64 * 16 + green // 64 * 4 + blue // 64] += 1
        feature = f"frames={len(p) // 576};ms={len(p) // 576 * 100};hist=" + ",".join(map(str, bins))
        want[(r[0], len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature)] += 1
    assert by_row(out, ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]) == want


def _plain_lzw(data: bytes, least: int) -> bytes:
    """A plain decoder, code by code."""
    clear, bits = 1 << least, int.from_bytes(data, "little")
    left = 8 * len(data)
    words, width, last, out = [], least + 1, None, b""
    while left >= width:
        code = bits & (1 << width) - 1
        bits >>= width
        left -= width
        if code == clear:
            words, width, last = [bytes([i]) for i in range(clear)] + [b"", b""], least + 1, None
            continue
        if code == clear + 1:
            break
        word = words[code] if code < len(words) else last + last[:1]
        if last is not None and len(words) < 4096:
            words.append(last + word[:1])
            width += len(words) == 1 << width and width < 12
        out, last = out + word, word
    return out


def test_stored_code_streams_grow_a_table():
    rng = random.Random(12)
    payload = media.pad(sentence(rng, 300).encode() + bytes(range(256)) + b"a" * 2000)
    _, _, palette, images = media.parse_gif(media.store_gif([payload])[0])
    assert b"".join(_plain_lzw(i.stream, i.least) for i in images) == payload and (palette == media.PALETTE).all()
    assert sum(len(i.stream) for i in images) < len(payload)


def test_damaged_media(spark):
    good = media.store_gif([media.pad(b"some text " * 100)])[0]
    cut = [good[:n] for n in [0, 3, 8, 12, 300, 785, 790, 800, len(good) - 1]]
    wrong = [b"PNG" + good[3:], good[:781] + b"\x99" + good[782:], good[:-1] + b"\x21", good.replace(good[-40:-30], b"\xff" * 10)]
    rows = [(i, 1, None if d is None else bytearray(d)) for i, d in enumerate([good, None, *cut, *wrong])]
    df = spark.createDataFrame(rows, "doc_id long, n_bytes long, media binary")
    out = {r.doc_id: r for r in media.media_columns(df).collect()}
    assert out[0].payload_bytes == 1152 and out[1].media_bytes is None and len(out) == len(rows)
    assert all(out[i].payload_bytes is None and out[i].feature is None and out[i].media_bytes == len(rows[i][2]) for i in range(2, 2 + len(cut)))
    assert {r.doc_id for r in media.frames_table(df).collect()} == {i for i in out if out[i].payload_bytes is not None}


def _lzw(pixels: bytes, least: int) -> bytes:
    """A plain encoder with a growing table, cleared when full."""
    clear, out, acc, held = 1 << least, bytearray(), 0, 0

    def put(code, width):
        nonlocal acc, held
        acc |= code << held
        held += width
        while held >= 8:
            out.append(acc & 255)
            acc >>= 8
            held -= 8

    table, width, prefix = {bytes([i]): i for i in range(clear)}, least + 1, b""
    put(clear, width)
    nxt = clear + 2
    for i in range(len(pixels)):
        c = pixels[i : i + 1]
        if prefix + c in table:
            prefix += c
            continue
        put(table[prefix], width)
        if nxt < 4096:
            table[prefix + c] = nxt
            if nxt == 1 << width and width < 12:
                width += 1
            nxt += 1
        else:
            put(clear, width)
            table, width, nxt = {bytes([i]): i for i in range(clear)}, least + 1, clear + 2
        prefix = c
    put(table[prefix], width)
    put(clear + 1, width)
    if held:
        out.append(acc & 255)
    return bytes(out)


def test_lzw_with_a_growing_table():
    rng = random.Random(8)
    for least, n in ((2, 300), (4, 5000), (8, 20000)):
        pixels = bytes(rng.choice([0, 1, 2, 3][: 1 << least]) if rng.random() < 0.9 else rng.randrange(1 << least) for _ in range(n))
        streams = [_lzw(pixels, least), _lzw(pixels[: n // 3], least), _lzw(pixels, least)[: n // 20]]
        whole, third, part = (x.tobytes() for x in media.lzw_decode(streams, least, [n, n // 3, n]))
        assert whole == pixels == _plain_lzw(streams[0], least) and third == pixels[: n // 3] and len(part) < n and pixels.startswith(part)


def test_disposal_and_transparency(spark):
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])

    def frame(x, y, w, h, pixels, disposal, clear=None, delay=5):
        body = _lzw(bytes(pixels), 2)
        return b"\x21\xf9\x04" + struct.pack("<BHBB", disposal << 2 | (clear is not None), delay, clear or 0, 0) + b"\x2c" + struct.pack("<HHHHB", x, y, w, h, 0) + b"\x02" + bytes([len(body)]) + body + b"\x00"

    gif = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x81, 0, 0) + palette + frame(0, 0, 2, 2, [1, 1, 1, 1], 1) + frame(0, 0, 2, 1, [2, 0], 3, clear=0) + frame(1, 1, 1, 1, [3], 2) + frame(0, 0, 1, 1, [2], 0) + b"\x3b"
    frames = media.decode_gifs([gif])[0]
    red, green, blue, none = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255), (0, 0, 0, 0)
    shown = [[tuple(p) for p in f.canvas.reshape(-1, 4).tolist()] for f in frames]
    assert shown == [[red] * 4, [green, red, red, red], [red, red, red, blue], [green, red, red, none]]
    assert [f.start_ms for f in frames] == [0, 50, 100, 150]
    table = media.frames_table(spark.createDataFrame([(1, bytearray(gif)), (2, None)], "doc_id long, media binary")).collect()
    assert len(table) == 4 and sum(table[0].histogram) == 4


def test_documents_ignores_other_columns(docs):
    assert documents(docs, "doc_id", "text").columns == ["doc_id", "text"]


def test_language_models_in_parts(spark):
    """Many parts give what one model of all grams gives, and a language of few and rare grams stays."""
    rng = random.Random(6)
    make = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))
    rows = [(i, make(["ba", "lo", "mi", "ta", "re"], 60), "aa") for i in range(40)] + [(40 + i, make(["st", "ung", "kei"], 4), "bb") for i in range(10)]
    rows = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, many = (langid.identify_language(rows, most_grams=m).orderBy("doc_id").toPandas() for m in (1 << 20, 20))
    assert (one.lang_pred == many.lang_pred).all() and np.allclose(one.entropy, many.entropy, atol=1e-6) and np.allclose(one.score, many.score, atol=1e-6)
    assert set(many[many.doc_id >= 40].lang_pred) == {"bb"} and set(many[many.doc_id < 40].lang_pred) == {"aa"}
    learnt = [r for r in rows.collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    lang, gram, n = [], [], []
    for r in learnt:
        g, c = np.unique(langid.symbols([r.text]).grams, return_counts=True)
        lang += [r.lang] * len(g)
        gram += g.view(np.int64).tolist()
        n += c.tolist()
    counts = pd.DataFrame({"lang": lang, "gram": gram, "n": n}).groupby(["lang", "gram"], as_index=False).n.sum()
    whole = langid.train(["aa", "bb"], counts.lang.map({"aa": 0, "bb": 1}).to_numpy(), counts.gram.to_numpy(np.int64).view(np.uint64), counts.n.to_numpy())
    parts = langid.model_parts(spark.createDataFrame(counts), 20)
    asked = langid.symbols([r.text for r in learnt] + ["qué xyz", "привет mir", "balo stung"]).grams
    assert len(parts.sent) > 5
    assert np.allclose(parts.log_probabilities(asked), whole.log_probabilities(asked), atol=1e-5)


def test_language_rejection(spark):
    """Unlearned scripts and random letters go, clean documents stay, held out or not."""
    rng = random.Random(8)
    make = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))
    parts = {"aa": ["ba", "lo", "mi", "ta", "re", "su"], "bb": ["st", "ung", "kei", "der", "och"]}
    clean = [(i, make(parts[lang], rng.randint(3, 80)), lang) for i, lang in enumerate(["aa", "bb"] * 100)]
    foreign = ["привет мир как дела", "καλημέρα κόσμε τι κάνεις", "今日は良い天気ですね", *["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)) for n in (40, 200, 1000)]]
    rows = spark.createDataFrame([*clean, *[(1000 + i, t, None) for i, t in enumerate(foreign)]], "doc_id long, text string, lang string")
    out = langid.identify_language(rows).toPandas().set_index("doc_id")
    assert not out.rejected[out.index < 1000].any() and out.rejected[out.index >= 1000].all()
    assert set(langid.accepted_documents(rows).toPandas().doc_id) == set(range(200))
