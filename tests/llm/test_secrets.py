"""Secret scans against brute force, and the inference of formats."""

import hashlib
import random
import re

import numpy as np
import pytest

from cases import CLASHES, awkward, frame, prose
from conftest import SF
from drydock.llm import queries, secrets

# The base patterns as the contract gives them.
BASE = [("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
         lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def brute(text):
    return sorted(((m.start(), k, m.end(), name) for k, (name, pattern, good) in enumerate(BASE)
                   for m in pattern.finditer(text or "") if good(m)))


def token(rng, symbols, n):
    return "".join(rng.choice(symbols) for _ in range(n))


HEX, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def planted(rng, n=60):
    """Texts with keyworded credentials of two formats, which teach, and bare ones, which are to be found."""
    rows, bare = [], {}
    for k in range(n):
        rows.append((1000 + k, f"{prose(rng, 20)} token = \"sk_{token(rng, UPPER, 24)}\" {prose(rng, 20)}", None, None, None))
        rows.append((2000 + k, f"{prose(rng, 9)} Password: {token(rng, HEX, 20)}", None, None, None))
    for k in range(12):
        value = f"sk_{token(rng, UPPER, 24)}"
        bare[3000 + k] = value
        rows.append((3000 + k, f"{prose(rng, 30)} ({value}). {prose(rng, 10)}", None, None, None))
    return rows, bare


AWKWARD = ["password=short", "token=a:token=bbbbbbb", "password=password=abcdefgh", "Api_Key'  :  'xyz_123.=", "APIKEY=ab",
           "ſecret=abcdefgh toKen=abcdefgh", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIAAKIA" + "9" * 20, "f" * 23, "f" * 24,
           "F" * 30 + "0" * 30 + "g" + "a" * 40, "é🎉 secret = " + "d" * 30 + " AKIA" + "Z" * 20, "passwd\n=abcdefgh",
           "passwd  =\tabcdefgh", "secret\"=\"" + "AKIA" + "B" * 18 + "\"", "=" * 50, "." * 50, "x" * 70]


def test_base_spans_equal_brute_force_and_stay(spark):
    rng = random.Random(11)
    rows = awkward() + [(100 + k, t, None, None, None) for k, t in enumerate(AWKWARD)] + planted(rng)[0]
    rows += [(500 + k, token(rng, "tokens=: \"aAKI0f", 300), None, None, None) for k in range(60)]
    docs = frame(spark, rows, CLASHES + ("spans", "word", "candidates", "kind"))
    found = secrets.find_secrets(docs).select("doc_id", secrets.listed(secrets.F.filter("spans", lambda s: ~s["learned"])),
                                              secrets.listed(secrets.F.col("spans"))).collect()
    want = sorted(repr((r[0], ",".join(f"{name}:{a}:{b}" for a, _, b, name in brute(r[1])))) for r in rows)
    assert sorted(repr((r[0], r[1])) for r in found) == want
    for _, base, every in found:
        assert set(filter(None, base.split(","))) <= set(filter(None, every.split(",")))


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_secret_scan"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute(docs[r["doc_id"]])
        text = ",".join(f"{name}:{a}:{b}" for a, _, b, name in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[3] == k for s in base) for k in secrets.KINDS]
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_learned_formats_find_bare_credentials_and_leave_prose_alone(spark):
    rng = random.Random(7)
    rows, bare = planted(rng)
    clean = [(9000 + k, prose(rng, 200) + " someverylongordinarywordhere path/to/some/readme.txt", None, None, None)
             for k in range(60)]
    found = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(frame(spark, rows + clean)).collect()}
    texts = {r[0]: r[1] for r in rows}
    for key, value in bare.items():
        span, = found[key]
        assert (span["value"], span["learned"], span["kind"]) == (value, True, "assign")
        assert texts[key][span["start"]:span["stop"]] == value
    assert not any(found[k] for k, *_ in clean)


def test_nothing_to_learn_from(spark):
    assert secrets.find_secrets(frame(spark, [])).collect() == []
    row, = secrets.find_secrets(frame(spark, [(1, "only text " + "Zq9" * 20, None, None, None)])).collect()
    assert row["spans"] == []


def test_a_text_of_millions_of_characters(spark):
    text = "word " * 600_000 + "AKIA" + "Q" * 16 + " " + "Ab9+" * 500_000
    row, = secrets.find_secrets(frame(spark, [(1, text, None, None, None)])).collect()
    assert [(s["kind"], s["start"]) for s in row["spans"]] == [("access", 3_000_000)]


def test_states_with_one_future_are_merged():
    rng = random.Random(2)
    values = []
    for _ in range(1000):  # every pair is the last with the same probability, so all ends have one future
        n = 1
        while rng.random() < 0.6:
            n += 1
        values.append("ab" * n)
    auto = secrets.infer(values)
    assert len(auto.step) <= 4
    inside, outside = auto.score(["ababab", "abababababab"]), auto.score(["aabb", "ba"])
    assert inside.min() > outside.max()


def test_states_with_different_futures_stay_apart():
    rng = random.Random(4)
    values = ["AK" + token(rng, "0123456789", 6) for _ in range(500)] + ["zz" + token(rng, "xy", 6) for _ in range(500)]
    auto = secrets.infer(values)
    good = auto.score(["AK123456", "zzxyxyxy"])
    assert good.min() > auto.score(["AKxyxyxy", "zz123456"]).max() + 10


def test_probabilities_sum_to_one():
    rng = random.Random(6)
    auto = secrets.infer([token(rng, HEX, rng.randint(3, 9)) for _ in range(400)])
    assert np.allclose(np.exp(auto.log).sum(axis=1), 1)


@pytest.mark.parametrize("n", [1, 40, 128, 129, 500])
def test_long_values_are_scored_alike(n):
    rng = random.Random(n)
    auto = secrets.infer([token(rng, HEX + "_-", 20) for _ in range(200)])
    value = token(rng, HEX + "_-", n)
    assert auto._score_long(value) == pytest.approx(auto.score([value, "a"])[0])
