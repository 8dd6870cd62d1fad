import pytest

from tabproof.llm.quality import (
    BAD, GOOD, HEURISTICS, NONE, classify_quality, fit_label_model, keep_quality, look, train_scorer, votes)


def test_votes_see_the_kinds_of_bad_text(words):
    good = "The way of the cat is to be in it for the day. " * 1 + words(60, 3) + " of the in to and is. It was the and."
    assert BAD not in votes(look(good))
    bad = {
        "symbols": "the&&& cat*** is$$$ on%%% it### " * 4, "capitals": "THE CAT IS ON IT NOW " * 3,
        "exclamations": "cat!! dog!! bird!! " * 4, "cells": "cat | dog | bird | fish | " * 3,
        "repeats": "cat " * 20 + "dog " * 20,
    }
    for name, text in bad.items():
        assert votes(look(text))[HEURISTICS.index(name)] == BAD, name
    assert votes(look("")) == votes(look(" \n")) == [NONE] * len(HEURISTICS)


def test_label_model_needs_no_labels():
    """Heuristics that err on 1 in 100 good texts and find a third of the bad ones each."""
    import random

    rng, patterns, truth = random.Random(1), {}, {}
    for i in range(4000):
        bad = i % 5 == 0
        kinds = rng.sample(range(9), 4) if bad else []
        cast = [BAD if h in kinds or rng.random() < 0.005 else GOOD for h in range(9)]
        key = "".join(map(str, cast))
        patterns[key] = patterns.get(key, 0) + 1
        truth.setdefault(key, []).append(not bad)
    model = fit_label_model(patterns)
    right = sum(sum(t == (model.posterior(k) >= 0.5) for t in known) for k, known in truth.items())
    assert right / 4000 > 0.99 and abs(model.prior - 0.8) < 0.03
    assert fit_label_model({}).prior > 0.5


def test_held_out_accuracy(spark):
    """The given labels are not used in training."""
    sf = "/root/testdata/sf0.01"
    judged = classify_quality(spark.read.parquet(f"{sf}/documents.parquet"))
    assert judged.columns == ["doc_id", "score", "kept"]
    rows = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) / len(rows) > 0.98
    assert sum(not r["kept"] for r in rows if r["quality"] == 1) == 0


def test_awkward_tables(spark, docs, rows, no_docs):
    found = classify_quality(docs).collect()
    assert len(found) == len(rows)
    assert all(not r["kept"] and r["score"] == 0 for r in found if r["doc_id"] in (5, 6, 7))
    assert keep_quality(docs).columns == docs.columns
    assert classify_quality(no_docs).count() == 0


def test_bound_on_the_fitted_rows(docs):
    scorer, _ = train_scorer(docs, fit_rows=5)
    assert scorer.weights.shape == (1024,) and pytest.approx(scorer.intercept) == scorer.intercept
