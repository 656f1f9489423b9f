"""Fill-in-the-middle and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import CLASHES, awkward, frame, prose
from drydock.llm import infill, variants

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]")
MIXED = "aZ é€🎉 <P ß\n\t漢"


def random_text(rng, n):
    return "".join(rng.choice(MIXED) for _ in range(n))


# -- fill in the middle -----------------------------------------------------------


def brute_infill(key, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = UNITS.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def infill_rows():
    rng = random.Random(12)
    texts = [random_text(rng, rng.randint(0, 60)) for _ in range(150)] + [
        "has <S> mark", "ends <S", "<", "<<P", ">P><M", "é", "漢" * 50, "a" * 300, "\x00 a\x00", "🎉a"]
    return awkward() + [(100 + k, t, None, None, None) for k, t in enumerate(texts)]


def test_infill_equals_brute_force_and_restores(spark):
    rows = infill_rows()
    docs = frame(spark, rows, CLASHES + ("cut", "form", "digest", "output", "h1"))
    found = infill.rearranged(docs)
    back = found.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in back))) == sorted(repr(brute_infill(r[0], r[1])) for r in rows)
    assert Counter(r["back"] for r in back) == Counter(r[1] or "" for r in rows)
    assert {r["form"] for r in back} == {"plain", "psm", "spm"}


def test_infill_of_an_empty_table(spark):
    empty = infill.rearranged(frame(spark, []))
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


@pytest.mark.parametrize("block", [4, 7, 64, 1 << 20])
def test_long_texts_are_cut_in_blocks(block):
    rng = random.Random(block)
    texts = [random_text(rng, rng.randint(0, 200)) for _ in range(60)] + [None, "", "漢" * 70, "x" * 300]
    first, second = (np.array([rng.randrange(1 << 32) for _ in texts]) for _ in range(2))
    array = pa.concat_arrays([pa.array(["zz"]), pa.array(texts)])[1:]  # an offset, as slices have
    found = infill.cut_texts(array, first, second, block).to_pylist()
    for text, a, b, got in zip(texts, first.tolist(), second.tolist(), found, strict=True):
        units = UNITS.findall(text or "")
        low, high = sorted((a % (len(units) + 1), b % (len(units) + 1)))
        p, m = "".join(units[:low]), "".join(units[low:high])
        assert tuple(got.values()) == (len(units), len(p.encode()), len(m.encode()), len(p), len(m))


def test_the_index_holds_exceptions_only():
    text = "plain é and 漢 and 🎉 end"
    index = infill.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    assert len(index.at) == 3
    points = np.arange(len(text) + 1)
    at = np.array([len(text[:k].encode()) for k in points])
    assert index.to_bytes(points).tolist() == at.tolist()
    assert index.to_points(at).tolist() == points.tolist()


def test_a_text_of_millions_of_characters(spark):
    text = random_text(random.Random(5), 1000) * 6000
    row = infill.rearranged(frame(spark, [(1, text, None, None, None)])).collect()[0]
    assert tuple(row) == brute_infill(1, text)


# -- spelling variants ------------------------------------------------------------


def brute_counts(rows):
    counts = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts):
    words = {w: n for w, n in counts.items() if w and len(w) >= 6 and n >= 5}
    near = {w: [x for x in words if x != w and one_edit(x, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def test_variants_equal_brute_force(spark):
    rng = random.Random(13)
    letters = "abÉé"
    counts = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 8))): rng.choice([4, 5, 6, 30, 200, 5000])
              for _ in range(700)}
    rows = [(w, n) for w, n in counts.items()] + [(None, 9), ("nocount", None), ("x" * 3000, 50), ("x" * 2999, 7)]
    counts |= {"x" * 3000: 50, "x" * 2999: 7}
    found = variants.variants(spark.createDataFrame(rows, "word string, n long"))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, brute_variants(counts)))


def test_spelling_variants_of_texts(spark):
    rng = random.Random(3)
    words = [prose(rng, 1) + rng.choice(["ation", "ement", "ÀÈ", "×÷îns"]) for _ in range(40)]
    rows = awkward() + [(k, " ".join(rng.choice(words).capitalize() for _ in range(400)), None, None, None)
                        for k in range(60)]
    rows += rows[-5:] + [(None, "Réunion_reunion reunion2 " * 9, None, None, None)]
    docs = frame(spark, rows, CLASHES + ("word", "n", "run", "h"))
    counts = {r["word"]: r["n"] for r in variants.word_counts(docs).collect() if r["word"]}
    brute = brute_counts(rows)
    assert counts == {w: n for w, n in brute.items() if w}
    found = sorted(map(tuple, variants.spelling_variants(docs).collect()), key=repr)
    assert found == sorted(brute_variants(brute), key=repr)


def test_chains_lead_to_the_last_form(spark):
    chain = [("aaaaaa" + "b" * k, 5 ** (k + 1)) for k in range(12)]
    found = {r["word"]: r["root"] for r in variants.variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert set(found.values()) == {chain[-1][0]}


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    plans = []

    def executed(df):
        rows = df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return rows

    staged = variants.staged
    monkeypatch.setattr(variants, "staged", lambda df, label: (executed(df), staged(df, label))[1])
    rng = random.Random(7)
    counts = {"".join(rng.choice("abÉé") for _ in range(rng.randint(6, 8))): rng.choice([5, 6, 30, 200, 5000])
              for _ in range(300)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(map(repr, map(tuple, executed(variants.variants(words))))) == sorted(map(repr, brute_variants(counts)))
    assert sum("SortMergeJoin" in plan for plan in plans) >= 3  # of near words, a round of roots, and the result
    assert not [plan for plan in plans if "Broadcast" in plan]


def test_signatures_of_small_files_are_not_broadcast(spark, tmp_path):
    words = spark.range(100).selectExpr("concat('word', 100000 + id) AS word", "5L AS n")
    words.write.parquet(f"{tmp_path}/words")
    plan = variants.near_words(spark.read.parquet(f"{tmp_path}/words"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_signatures_are_exact():
    rng = random.Random(1)
    for _ in range(500):
        word = "".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 12)))
        k = rng.randrange(len(word))
        other = rng.choice([word[:k] + word[k + 1:], word[:k] + "z" + word[k + 1:], word[:k] + rng.choice("abz") + word[k:]])
        if other != word:
            a, b = variants.signatures([word, other])
            assert set(a.tolist()) & set(b.tolist())


def test_no_words(spark):
    assert variants.spelling_variants(frame(spark, [])).collect() == []
    assert variants.spelling_variants(frame(spark, [(1, "a b c", None, None, None)])).collect() == []
