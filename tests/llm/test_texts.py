"""Near duplicates, repeated strings and decontamination against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from cases import CLASHES, awkward, frame, prose
from conftest import SF
from drydock.llm import decontaminate, shingles, substrings
from drydock.llm.common import components, numbered


def shingle_set(text, n=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def brute_links(rows, least=0.8):
    """(n_links, component) of rows ``(id, text)`` by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    near = [[j for j in range(len(rows)) if i != j and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
            for i in range(len(rows))]
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((key, len(near[i]), min(ids) if ids else None))
    return sorted(map(repr, out))


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(["new", "other", "thing"])
    return " ".join(words)


def test_shingles_are_words(spark):
    texts = ["A b, c! d e F", "a-b c", "", "one", "É ß ÄÖ ü x y z"]
    found, start, n_words = shingles.shingle_hashes(texts)
    assert n_words.tolist() == [6, 3, 0, 1, 7]
    assert np.diff(start).tolist() == [2, 1, 0, 1, 3]
    again, _, _ = shingles.shingle_hashes(["zz a b c d e f"])
    assert set(found[:2]) <= set(again) and len(set(again)) == 3


@pytest.mark.parametrize("blocks", [False, True])
def test_near_texts(spark, monkeypatch, blocks):
    if blocks:  # every group met in many blocks
        monkeypatch.setattr(shingles, "BLOCK_ROWS", 3)
        monkeypatch.setattr(shingles, "VERIFY_ROWS", 4)
    rng = random.Random(11)
    rows = [(r[0], r[1]) for r in awkward()]
    hot = prose(rng, 120)
    rows += [(100 + k, edited(rng, hot, k % 4)) for k in range(40)] + [(200 + k, hot) for k in range(5)]
    for k in range(20):
        text = prose(rng, 100)
        rows += [(300 + 2 * k, text), (301 + 2 * k, edited(rng, text, rng.randint(1, 3)))]
    df = frame(spark, [(*r, None, None, None) for r in rows], extra=CLASHES)
    found = shingles.near_texts(df).collect()
    assert sorted(repr((r["doc_id"], r["n_links"], r["component_id"])) for r in found) == brute_links(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    kept = shingles.distinct_texts(df)
    assert kept.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    sets = [shingle_set(t) for _, t in rows]
    alone = [r for r, s in zip(rows, sets) if not s]
    assert sorted(map(repr, (r for r in got if not shingle_set(r[1])))) == sorted(map(repr, alone))
    groups = len({r["group"] for r in found if r["group"] is not None})
    assert len(got) == groups + len(alone)
    assert not any(int(n) for _, n, _ in (eval(x) for x in brute_links(got)))


def test_empty_tables(spark):
    df = frame(spark).limit(0)
    assert shingles.near_texts(df).collect() == [] and shingles.distinct_texts(df).columns == df.columns
    assert substrings.without_repeats(df).collect() == []
    assert decontaminate.matches(frame(spark), spark.createDataFrame([], "item_id long, text string")).count() == len(awkward())


def test_small_table_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    df = spark.read.parquet(f"{SF}/documents.parquet")
    found = shingles.near_texts(df).collect()
    assert sorted(repr((r["doc_id"], r["n_links"], r["component_id"])) for r in found) == brute_links(rows)


def test_depth_is_shortened():
    assert shingles.recall_at(0.8, 8, 16) < 0.999 < shingles.recall_at(0.8, 4, 16)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (103, 102), (101, 102), (7, 7), (-5, 200)]
    found = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[k] == 0 for k in range(61)) and {found[k] for k in (100, 101, 102, 103)} == {100}
    assert found[200] == found[-5] == -5
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_numbered(spark):
    df = spark.createDataFrame([(f"s{k:03}",) for k in range(200)] + [(None,)], "source string")
    found = numbered(df, [df["source"].asc_nulls_last()], "at").collect()
    assert sorted((r["at"], r["source"]) for r in found if r["source"]) == [(k, f"s{k:03}") for k in range(200)]
    assert [r["at"] for r in found if r["source"] is None] == [200]


# -- repeated strings ---------------------------------------------------------


def brute_repeats(rows, length):
    """Kept bytes of documents ``(id, text)``, in the order the operator states."""
    docs = sorted({(k is None, k or 0, t or b"") for k, t in rows}, key=lambda d: d[:2])
    seen = set()
    out = {}
    for none, key, text in docs:
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            piece = text[p:p + length]
            if piece in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(piece)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out[(None if none else key, text)] = (bytes(c for c, g in zip(text, gone) if not g), spans)
    return out


@pytest.mark.parametrize("length,gram,hot", [(100, 32, 32), (24, 8, 32), (12, 12, 32), (100, 32, 3), (24, 8, 2), (12, 3, 1)])
def test_repeats(spark, monkeypatch, length, gram, hot):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(substrings, "HOT_ANCHORS", hot)
    rng = random.Random(length)
    shared = [prose(rng, 40) for _ in range(3)]
    rows = [(r[0], r[1]) for r in awkward() if r[0] not in (20, 21)]
    rows += [(50, shared[0]), (51, shared[0]), (51, shared[0]), (52, shared[0][5:-7])]
    for k in range(60, 90):
        rows.append((k, prose(rng, rng.randint(0, 30)) + rng.choice(shared)[rng.randint(0, 60):] + prose(rng, 5)
                     + rng.choice(shared)[:rng.randint(0, 150)]))
    rows += [(90, "ab" * 300), (91, "a" * 400), (92, "ab" * 300)]
    df = frame(spark, [(*r, None, None, None) for r in rows], extra=CLASHES).repartition(5)
    found = substrings.without_repeats(df, length=length, gram=gram).collect()
    want = brute_repeats([(k, None if t is None else t.encode()) for k, t in rows], length)
    assert len(found) == len(rows)
    got = sorted(repr((r["doc_id"], bytes(r["kept"]), [tuple(s) for s in r["removed"]])) for r in found)
    assert got == sorted(repr((k, *want[(k, (t or "").encode())])) for k, t in rows)
    for r in found:
        assert r["kept_sha256"] == hashlib.sha256(bytes(r["kept"])).hexdigest()
        assert r["n_bytes"] == len(r["kept"]) + sum(b - a for a, b in r["removed"])


def test_small_table_repeats(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = brute_repeats([(k, t.encode()) for k, t in rows], 100)
    found = substrings.without_repeats(spark.read.parquet(f"{SF}/documents.parquet"), with_text=False).collect()
    texts = dict(rows)
    for r in found:
        kept, spans = want[(r["doc_id"], texts[r["doc_id"]].encode())]
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest() and [tuple(s) for s in r["removed"]] == spans


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(2)
    text = bytes(rng.choice(b"abc") for _ in range(900))
    whole = substrings.find_anchors([text], 20, 6)
    pieces = substrings.pieces_of([text], 100, 20)
    windows = sorted(p + k for _, p, b in pieces for k in range(len(b) - 20 + 1))
    assert windows == list(range(len(text) - 20 + 1))
    owned = sorted(w for lo, hi in zip(whole["lo"], whole["hi"]) for w in range(lo, hi + 1))
    assert owned == windows


def test_loser_tree_shares_prefixes():
    rng = random.Random(4)
    for _ in range(50):
        parts = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(0, 5)))
                 for _ in range(rng.randint(0, 6))]
        merged = [(parts[r][p], n) for r, p, n in substrings.merge_runs(
            parts, [substrings.prefix_lengths(x).tolist() for x in parts])]
        assert [s for s, _ in merged] == sorted(sum(parts, []))
        for (x, _), (y, n) in zip(merged, merged[1:]):
            assert x[:n] == y[:n] and (n in (len(x), len(y)) or x[n] != y[n])


# -- decontamination ----------------------------------------------------------


def brute_distance(item, region):
    row = [0] * (len(region) + 1)
    for i, c in enumerate(item, 1):
        step = [i]
        for j, d in enumerate(region, 1):
            step.append(min(row[j - 1] + (c != d), row[j] + 1, step[-1] + 1))
        row = step
    return min(row)


def test_banded_distance():
    rng = random.Random(8)
    for _ in range(500):
        a = [rng.randint(0, 2) for _ in range(rng.randint(1, 9))]
        b = [rng.randint(0, 2) for _ in range(rng.randint(0, 12))]
        assert decontaminate.banded_distance(np.array(a), np.array(b, dtype=np.int64), -len(a) - 1, len(b) + 1, 20) \
            == brute_distance(a, b)


def mutated(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = "#"
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, "#")
    return "".join(chars)


@pytest.mark.parametrize("block_chars", [2_000_000, 300])
def test_matches(spark, block_chars):
    rng = random.Random(9)
    items = [(k, prose(rng, rng.randint(4, 40))) for k in range(15)]
    items += [(40, "too short"), (41, None), (42, ""), (3, items[3][1]), (0, "a second text of the same id, quite long")]
    rows = [(r[0], r[1]) for r in awkward()]
    for k in range(40):
        item = rng.choice(items[:15])[1]
        rows.append((100 + k, f"{prose(rng, 20)}\n {mutated(rng, item, rng.choice([0, 1, 3, 8, 20])).upper()} {prose(rng, 20)}"))
    rows.append((200, " ".join(t for _, t in items[:6]) + " " + items[0][1]))
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    df = frame(spark, [(*r, None, None, None) for r in rows], extra=CLASHES)
    found = decontaminate.matches(df, bench, block_chars=block_chars).collect()
    assert len(found) == len(rows)
    want = []
    for key, text in rows:
        region = decontaminate.normal(text)
        near = set()
        for item, body in items:
            body = decontaminate.normal(body)
            if len(body) >= decontaminate.Q and len(region) < 2000 and brute_distance(body, region) <= decontaminate.budget(len(body)):
                near.add(item)
        want.append(repr((key, sorted(near))))
    assert sorted(repr((r["doc_id"], sorted({m["item_id"] for m in r["matches"]}))) for r in found) == sorted(want)
    kept = decontaminate.clean(df, bench, block_chars=block_chars)
    assert kept.columns == df.columns
    assert sorted(repr((r["doc_id"], [])) for r in kept.collect()) == sorted(w for w in want if w.endswith("[])"))


def test_items_keep_the_type_of_their_id(spark):
    bench = spark.createDataFrame([("math/1", "what is the sum of two and three apples"), ("math/2", "an item nobody has copied")],
                                  "item_id string, text string")
    rows = [(1, "so: What is the sum of two and three  apples?", None, None, None), (2, "clean", None, None, None)]
    found = {r["doc_id"]: r["item_ids"] for r in decontaminate.leaked(spark, frame(spark, rows), bench).collect()}
    assert found == {1: ["math/1"], 2: []}
    assert [r["doc_id"] for r in decontaminate.clean(frame(spark, rows), bench).collect()] == [2]


def test_short_items_have_their_edits(spark):
    """Items of 20 to 23 characters may have one edit, wherever it is."""
    item = "quick brown foxes jump!"
    rows, want = [], {}
    for size in (19, 20, 21, 22, 23, 24):
        for at in range(size):
            body = item.ljust(24, "z")[:size]
            key = 100 * size + at
            rows.append((key, f"before {body[:at]}#{body[at + 1:]} after", None, None, None))
            want[key] = [size] if size >= 20 else []
    for size in (19, 20, 21, 22, 23, 24):
        bench = spark.createDataFrame([(size, item.ljust(24, "z")[:size])], "item_id long, text string")
        own = [r for r in rows if r[0] // 100 == size]
        found = decontaminate.matches(frame(spark, own), bench).collect()
        assert {r["doc_id"]: [m["item_id"] for m in r["matches"]] for r in found} == {r[0]: want[r[0]] for r in own}


def test_planted_items_are_found(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    found = {r["doc_id"]: set(r["item_ids"]) for r in decontaminate.leaked(spark, docs, bench).collect()}
    planted = defaultdict(set)
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    for r in docs.collect():
        planted[r["doc_id"]] |= {i for i, t in items if t in r["text"]}
    assert any(planted.values()) and all(planted[d] <= found[d] for d in found)
    assert sum(len(found[d] - planted[d]) for d in found) <= 2
