"""The learned tagger against brute force: counts, Viterbi, windows, both ways of meeting the model."""

import itertools
import math
import random
import time

import numpy as np
import pytest
from docloom.operators import hmm
from pyspark.sql import functions as F

RNG = random.Random(5)


def sentences(n, rng, most=30):
    """Made-up annotated texts: a drug is a capital word and long words after it, an endpoint ends in a comma."""
    out = []
    for _ in range(n):
        words, tags = [], []
        for _ in range(rng.randrange(most)):
            w = rng.choice(["Aspirin", "Ibu", "tablets", "of", "the", "result,", "outcome,", "x1", "milligram", f"rare{rng.randrange(10**6)}"])
            tags.append("B-DRUG" if w[0].isupper() else "I-DRUG" if tags and tags[-1][2:] == "DRUG" and len(w) > 5 else "B-ENDPOINT" if w.endswith(",") else "O")
            words.append(w)
        out.append((words, tags))
    return out


@pytest.fixture(scope="module")
def learned(spark):
    data = sentences(120, random.Random(1)) + [([], []), (None, None), (["Aspirin", None], ["B-DRUG", "O"])]
    return data, hmm.learn(spark.createDataFrame(data, "words array<string>, tags array<string>").repartition(3))


def test_counts(learned):
    data, model = learned
    tokens = [(w, t, before) for words, tags in data if words for w, t, before in zip(words, tags, [None, *tags]) if w is not None]
    tags = sorted({t for _, t, _ in tokens})
    assert model.tags == tags
    often = {w.lower() for w, _, _ in tokens if sum(v.lower() == w.lower() for v, _, _ in tokens) >= 2}
    forms = {(w.lower() if w.lower() in often else hmm.shape_of(w)) for w, _, _ in tokens}
    got = {r.form: r.scores for r in model.forms.collect()}
    assert set(got) == forms
    for f in forms:
        for t, s in zip(tags, got[f], strict=True):
            n = sum(x == t and (w.lower() if w.lower() in often else hmm.shape_of(w)) == f for w, x, _ in tokens)
            assert s == round(1e6 * math.log((n + 1) / (sum(x == t for _, x, _ in tokens) + len(forms))))
    for i, b in enumerate(tags):
        for j, t in enumerate(tags):
            n, every = sum((x, y) == (b, t) for _, y, x in tokens), sum(x == b for _, _, x in tokens)
            assert model.pairs[i][j] == round(1e6 * math.log((n + 1) / (every + len(tags))))


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    first, pairs = rng.integers(-9, 0, 3), rng.integers(-9, 0, (3, 3))
    cut = [rng.integers(-9, 0, (n, 3)) for n in (0, 1, 5, 7, 3, 5)]
    for begins in ([True] * 6, [False, True] * 3):
        for s, b, path in zip(cut, begins, hmm.viterbi(cut, begins, first, pairs), strict=True):
            value = lambda p: sum(s[i, t] for i, t in enumerate(p)) + sum(pairs[a, c] for a, c in itertools.pairwise(p)) + (first[p[0]] if b and len(p) else 0)  # noqa: B023, E731
            best = max((value(p) for p in itertools.product(range(3), repeat=len(s))), default=0)
            assert len(path) == len(s) and value(tuple(path)) == best


def texts(spark, rows):
    return spark.createDataFrame(rows, "id int, text string").withColumn("form", F.lit("kept")).withColumn("window", F.lit("kept"))


def labels(df):
    return {r.id: None if r.tokens is None else [(t.label, t.start, t.end, round(t.confidence, 9)) for t in r.tokens] for r in df.collect()}


def test_both_ways_agree_and_long_texts_are_whole(spark, learned):
    rng = random.Random(9)
    rows = [(i, " ".join(w)) for i, (w, _) in enumerate(sentences(30, rng, 40))] + [(100, None), (101, ""), (102, " \n "), (103, " ".join(" ".join(w) for w, _ in sentences(200, rng)))]
    df = texts(spark, rows)
    model = learned[1]
    here = labels(hmm.tagged(df, model, ["id"]))
    assert here[100] is None and here[101] == here[102] == []
    for step, overlap in ((384, 64), (40, 10)):
        assert labels(hmm.tagged(df, model, ["id"], step=step, overlap=overlap)) == labels(hmm.tagged(df, model, ["id"], step=step, overlap=overlap, broadcast_bytes=0))
    text = rows[-1][1]
    assert len(here[103]) == len(text.split()) > 1000 and [text[a:b] for _, a, b, _ in here[103]] == text.split()
    whole = labels(hmm.tagged(df, model, ["id"], step=10**6))
    assert [t[0] for t in here[103]] == [t[0] for t in whole[103]]  # windows with overlap find what one window does


def test_it_learns_what_a_neighbour_decides(spark, learned):
    rows = [(i, " ".join(w)) for i, (w, _) in enumerate(sentences(60, random.Random(77)))]
    truth = {i: t for i, (_, t) in enumerate(sentences(60, random.Random(77)))}
    got = labels(hmm.tagged(texts(spark, rows), learned[1], ["id"]))
    pairs = [(a, b[0]) for i in truth for a, b in zip(truth[i], got[i], strict=True)]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.9
    assert sum(a == b == "I-DRUG" for a, b in pairs) > 0.8 * sum(a == "I-DRUG" for a, _ in pairs) > 0


def test_no_annotations(spark):
    model = hmm.learn(spark.createDataFrame([], "words array<string>, tags array<string>"))
    for most in (1, -1):
        assert [t[0] for t in labels(hmm.tagged(texts(spark, [(1, "a b")]), model, ["id"], broadcast_bytes=most))[1]] == ["O", "O"]


def test_learning_takes_no_text_apart_for_each_word(spark, tmp_path):
    """Twelve thousand words in one turn: where the words were cut anew for each of them, this took minutes."""
    from docloom.plans import learned

    rows = [(1, 1, "Aspirin tablets of the result, " * 2_400), (1, 2, None), (1, 3, "")]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    began = time.time()
    assert hmm.learn(learned.annotated_turns(spark, str(tmp_path))).tags == ["B-BIOMARKER", "B-DRUG", "I-DRUG", "O"]
    assert time.time() - began < 20
