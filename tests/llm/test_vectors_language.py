import itertools
import random

import numpy as np
import pytest

from cases import CLASHES, awkward, frame
from conftest import SF
from drydock.llm import language, tokens, vectors

SCHEMA = "vec_id long, embedding array<float>, item long, copies string, leaves string"


def brute_vectors(rows, least=0.9):
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {k: [] for k in range(len(rows))}
    unit = {k: np.array(rows[k][1], dtype=np.float64) / np.linalg.norm(np.array(rows[k][1], dtype=np.float64)) for k in good}
    for a, b in itertools.combinations(good, 2):
        if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
            near[a].append(b)
            near[b].append(a)
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((i, len(near[k]), min((rows[j][0] for j in seen), key=lambda x: (x is None, x or 0))))
    return out


@pytest.mark.parametrize("block_rows", [2048, 7])
def test_near_vectors(spark, block_rows):
    rng = np.random.default_rng(2)
    rows = [(k, rng.standard_normal(16).tolist()) for k in range(60)]
    for c in range(3):
        centre = rng.standard_normal(16)
        rows += [(100 + 50 * c + k, (centre + 0.05 * rng.standard_normal(16)).tolist()) for k in range(25)]
    same = rng.standard_normal(16).tolist()
    rows += [(300 + k, same) for k in range(20)] + [(320, (2 * np.array(same)).tolist()), (300, same)]
    rows += [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [None] * 16), (404, []),
             (405, [float("inf")] + [1.0] * 15), (None, same), (406, [1.0, 2.0]), (407, [1.0, 2.1])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(*r, None, "c", "l") for r in rows], SCHEMA)
    found = vectors.near_vectors(df, leaf_rows=16, block_rows=block_rows).collect()
    assert sorted(repr((r["vec_id"], r["n_links"], r["component_id"])) for r in found) == sorted(map(repr, brute_vectors(rows)))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert vectors.near_vectors(df.limit(0)).collect() == []


def test_recall_on_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = sum(n for _, n, _ in brute_vectors(rows))
    found = sum(r["n_links"] for r in vectors.near_vectors(df).collect())
    assert 0.95 * want <= found <= want


def test_recall_at_the_threshold():
    """Pairs of cosine just above 0.9 among random vectors, where trees have many levels."""
    rng = np.random.default_rng(6)
    base = vectors.unit(rng.standard_normal((2000, 32)))
    other = vectors.unit(base + 0.08 * rng.standard_normal((2000, 32)))
    points = np.concatenate((base, other))
    near = np.flatnonzero((base * other).sum(axis=1) >= 0.9)
    met = np.zeros(len(near), dtype=bool)
    for _ in range(vectors.TREES):
        rows, leaf = vectors.leaves_of(tree := vectors.grow(points, 64, rng), points)
        held = np.zeros((len(points), tree.leaves), dtype=bool)
        held[rows, leaf] = True
        met |= (held[near] & held[near + 2000]).any(axis=1)
    assert len(near) > 500 and met.mean() > 0.95


# -- language -----------------------------------------------------------------


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(3)
    length = np.array([1, 3, 0, 4, 2])
    scores, move = rng.standard_normal((10, 3)), rng.standard_normal((3, 3))
    start = np.concatenate(([0], np.cumsum(length)))[:-1]
    marginal, pairs, logs = language.forward_backward(scores, start[length > 0], length[length > 0], move, pairs=True)
    want, want_pairs, want_logs = np.zeros((10, 3)), np.zeros((3, 3)), 0.0
    for s, n in zip(start, length):
        if not n:
            continue
        paths = list(itertools.product(range(3), repeat=int(n)))
        value = [np.exp(sum(scores[s + k, y] for k, y in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:])))
                 for p in paths]
        want_logs += np.log(sum(value))
        for p, v in zip(paths, value):
            for k, y in enumerate(p):
                want[s + k, y] += v / sum(value)
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += v / sum(value)
    assert np.allclose(marginal, want) and np.allclose(pairs, want_pairs) and np.isclose(logs, want_logs)


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.predict(docs, language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter(
        language.held_out()).collect()
    assert len(found) > 40 and sum(r["lang_pred"] == r["lang"] for r in found) / len(found) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_code_switched_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.training_rows(docs, "text", "lang", language.held_out() | ~language.held_out())
    model = language.fit(rows)
    parts = {k: " ".join(next(t for t, lang in rows if lang == k and len(t.split()) > 60).split()[:60]) for k in ("de", "es")}
    _, _, spans = language.label_texts([parts["de"] + " " + parts["es"]], model)
    by = {k: sum(n for label, n in spans[0] if label == k) for k in model.labels}
    assert by["de"] > 40 and by["es"] > 40 and len(spans[0]) <= 8


def test_language_awkward(spark):
    df = frame(spark, extra=CLASHES)
    model = language.learn(df)
    assert model.labels and language.fit([]).labels == []
    rows = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(df, model).collect()}
    assert {(23, "und", 0.0), (24, "und", 0.0), (25, "und", 0.0), (26, "und", 0.0)} <= rows
    assert language.predict(df, model).count() == len(awkward())
    assert {r["lang_pred"] for r in language.predict(df, language.fit([])).collect()} == {"und"}
    kept = language.accepted(df, model)
    assert kept.columns == df.columns
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in awkward())
    empty = df.limit(0)
    assert language.accepted(empty, language.learn(empty)).collect() == []
    assert language.training_rows(df, "text", "lang", df["doc_id"] == 12) == []


def test_sample_counts_distinct_texts(spark):
    """Copies take no label out of the sample, long texts give a part, and no row goes where nothing is learned."""
    rows = [(k, f"wort haus baum {k % 5}", "de", "s", 1) for k in range(5000)]
    rows += [(6000 + k, f"casa perro {k} " + "gato luna " * 4000, "es", "s", 1) for k in range(3)]
    rows += [(7000 + k, f"word house tree {k}", "en", "s", 1) for k in range(2000)]
    df = frame(spark, rows)
    found = language.training_rows(df, "text", "lang", df["doc_id"].isNotNull())
    count = {k: sum(label == k for _, label in found) for k in ("de", "es", "en")}
    assert count["de"] == 5 and count["es"] == 3 and 200 < count["en"] < 400
    assert max(len(t) for t, _ in found) == language.SAMPLE_CHARS
    predicted = {r["doc_id"]: r["lang_pred"] for r in language.predict(df, language.learn(df)).collect()}
    assert predicted[0] == "de" and predicted[6001] == "es" and predicted[7001] == "en"
    unlabelled = frame(spark, [(1, "some words", None, "s", 1), (2, "12", None, "s", 1), (3, None, None, "s", 1)])
    assert [r["doc_id"] for r in language.accepted(unlabelled, language.learn(unlabelled)).collect()] == [1]
    assert language.fit([("12", "en"), ("3", "de")]).labels == []


# -- tokens -------------------------------------------------------------------


def greedy(word, pieces, longest):
    n = 0
    while word:
        size = next(k for k in range(min(longest, len(word)), 0, -1) if k == 1 or word[:k] in pieces)
        word, n = word[size:], n + 1
    return n


def test_automaton_against_greedy():
    rng = random.Random(1)
    for _ in range(40):
        pieces = {bytes(rng.choice(b" abc") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 25))}
        auto = tokens.build_automaton(sorted(pieces))
        texts = [bytes(rng.choice(b"abcab ") for _ in range(rng.randint(0, 40))) for _ in range(10)] + [b"", b"abc" * 60]
        words, found = tokens.count_texts(auto, texts)
        assert words.tolist() == [len(t.split()) for t in texts]
        assert found.tolist() == [sum(greedy(b" " + w, pieces, 6) for w in t.split()) for t in texts]


def test_token_counts(spark):
    df = frame(spark, extra=CLASHES)
    pieces = set(tokens.read_vocabulary(tokens.VOCABULARY))
    longest = max(map(len, pieces))
    import re
    want = [(r[0], len((r[1] or "").encode()), *(lambda w: (len(w), sum(greedy(b" " + x, pieces, longest) for x in w)))(
        re.findall(rb"[^\x20\x09-\x0D]+", (r[1] or "").encode()))) for r in awkward()]
    assert sorted(map(repr, map(tuple, tokens.token_counts(df).collect()))) == sorted(map(repr, want))
    assert tokens.token_counts(df.limit(0)).collect() == []
