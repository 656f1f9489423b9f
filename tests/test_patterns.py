"""The automaton over many patterns against a search for each of them."""

import random

import pytest

from drydock.config import Dataset, Registry
from drydock.functions.patterns import _NONE, word_automaton
from drydock.operators import lookups
from drydock.operators.lookups import classify, with_dataset_description, with_dictionary_table


def brute(words, text):
    return next((k for k, w in enumerate(words) if w in (text or "")), _NONE)


@pytest.mark.parametrize("seed", range(8))
def test_first_word(seed):
    rng = random.Random(seed)
    letters = "ABÄ🎉_"[:rng.randint(1, 5)]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 25))]
    texts = [None, ""] + ["".join(rng.choice(letters + "x") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    assert word_automaton(words).first(texts).tolist() == [brute(words, t) for t in texts]


def test_words_in_words():
    assert word_automaton(["ABCD", "BC", "B"]).first(["XABCX", "ABCD", "ABD", "AXC"]).tolist() == [1, 0, 2, _NONE]
    assert word_automaton(["Q", ""]).first(["", "Q", "x"]).tolist() == [1, 0, 1]
    assert word_automaton([]).first(["a", None]).tolist() == [_NONE, _NONE]


def test_a_long_registry_gives_what_a_short_one_gives(spark, monkeypatch):
    registry = Registry((Dataset("b", "AB", "TB", "x"), Dataset("a", "A", "TA", "y"), Dataset("c", "Z", "TZ", "z")))
    files = spark.createDataFrame([("/x/my_ab.zip", 1), ("/ab/a.tar.gz", 2), ("/x/b.ab", 3), ("/x/none.zip", 4), ("/x/z.zip", 5),
                                   (None, 6), ("", 7)], "path string, dict_table int")
    named = files.selectExpr("CASE dict_table WHEN 1 THEN 'a' WHEN 2 THEN 'c' ELSE path END AS dataset", "dict_table AS n")

    def everything():
        found = (classify(files, registry), with_dictionary_table(named, registry), with_dataset_description(named, registry))
        return [sorted(repr(sorted(r.asDict().items())) for r in df.collect()) for df in found]

    short = everything()
    monkeypatch.setattr(lookups, "DATASETS_IN_PLAN", 0)
    assert everything() == short
