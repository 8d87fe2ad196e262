import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arborlex.functions import text as T


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_normalize_and_tokens(spark):
    assert one(spark, T.normalize_text(F.lit("  Media \t&  Ethics\n"))) == "media & ethics"
    assert one(spark, T.name_tokens(F.lit("The Media & the Ethics of media"))) == ["ethics", "media"]
    assert T.token_list("The Media & the Ethics of media") == ["ethics", "media"]


def test_ids_are_the_hashes_they_are_defined_by(spark):
    p = "P_" + hashlib.sha256(b"d1\x000\x00Name\x00Def").hexdigest()[:20]
    g = "G_" + hashlib.sha256(b"name x\x00def").hexdigest()[:20]
    assert one(spark, T.proposal_id(F.lit("d1"), F.lit(0), F.lit("Name"), F.lit("Def"))) == p
    assert one(spark, T.proposal_group_id(F.lit(" NAME  x"), F.lit("Def"))) == g


@pytest.mark.parametrize(("name", "fine"), [("Robotics", True), ("A-b (c/d)", True), ("1x", False), ("x_y", False), ("x" * 81, False), ("ok\n", True), ("a\nb", False), ("  ", False)])
def test_label_validity(spark, name, fine):
    assert one(spark, T.valid_label(F.lit(name), F.lit("A definition"))) is fine


def test_repair():
    assert T.repair_label_text("Robot_ics", 80) == "Robotics"
    assert T.repair_label_text("a_b_c", 80) == "bc"
    assert T.repair_label_text("123", 80) is None
    assert T.repair_label_text("x" * 90, 80) == "x" * 80
    assert T.repair_label_text(5, 80) is None


def test_fix_output():
    p = {"name": "A", "definition": "B"}
    ids, kept = T.fix_output(["x", "y", "x"], [p, {"name": " a ", "definition": "b"}, {"name": "_", "definition": "b"}, {"name": "C"}])
    assert ids == ["x", "y"] and kept == [p]
    with pytest.raises(TypeError):
        T.fix_output([], ["no object"])


def test_similarity():
    score = lambda a, b: T.similarity(a, b)[0]
    pool = ["Media Ethics & Journalism", "Media & Journalism", "Media & Journalism", "Journalism & Media"]
    assert all(score(a, b) >= 0.8 for a in pool for b in pool)
    assert score("a&b", "a & b") == 1.0
    assert score("&", "of") < 1


@given(st.text("ab &x", max_size=12), st.text("ab &x", max_size=12))
@settings(max_examples=200, deadline=None)
def test_similarity_is_between_0_and_1(a, b):
    assert 0 <= T.similarity(a, b)[0] <= 1
    assert T.similarity(a, a)[0] == 1


def test_formats(spark):
    for v in (0.8, 0.85, 1.0, 0.123456, 0.0):
        assert one(spark, T.threshold_label(F.lit(v))) == T.threshold_text(v)
    for v in (0, 59, 60, 3599, 3600, 86399):
        assert one(spark, T.format_duration(F.lit(v))) == T.seconds_text(v)


def test_truncate():
    assert T.truncate("a b c", 3) == "a b c"
    assert T.truncate("a b c d", 3) == "a b c\n[TRUNCATED]"
    assert T.truncate("a b c d", 4, budget=2) == "a b\n[TRUNCATED]"
    with pytest.raises(ValueError):
        T.truncate("a b", 2, budget=0)


def test_ratio_is_that_of_difflib():
    import difflib
    import random

    rng = random.Random(3)
    for _ in range(4000):
        a, b = ("".join(rng.choice("abc de") for _ in range(rng.randint(0, 30))) for _ in range(2))
        if rng.random() < 0.5:
            at = rng.randint(0, len(a))
            b = a[at:] + b + a[:at]
        assert T.ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio(), (a, b)
    long = "ab " * 100
    assert T.ratio("b ab", long) == difflib.SequenceMatcher(None, "b ab", long).ratio()


def test_many_similarities_are_those_of_each_pair():
    rng = random.Random(8)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(40)] + ["and", "the", "é", "ß", "&"]
    names = list(dict.fromkeys([" ".join(rng.sample(words, rng.randint(1, 5))) for _ in range(300)] + ["", "The", "x" * 64, "x" * 65, "ab" * 32, "abc " * 60, "Media & Law", "media and law"]))
    left, right = (np.array([rng.randrange(len(names)) for _ in range(6000)]) for _ in "lr")
    want = np.array([T.similarity(names[a], names[b]) for a, b in zip(left, right, strict=True)]).T
    assert (T.similarities(names, left, right) == want).all()
    for least in (0.3, 0.6, 0.8):
        got = T.similarities(names, left, right, least)
        assert (got == want)[:, want[0] >= least].all() and (got[0] < least)[want[0] < least].all() and (got == -1).any()
