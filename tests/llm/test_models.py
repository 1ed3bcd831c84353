"""Classifiers: held-out accuracy on the shared tables, the parts by hand, and edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from tidegauge.llm import gam, toxicity
from tidegauge.llm.labels import labelled_sample
from tidegauge.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score string, extra int"
EDGE = [(1, None, "x", 1), (2, "", "x", None), (3, "a " * 60_000, None, 2), (3, "a " * 60_000, None, 2), (None, "no id", "x", 3)]


@pytest.mark.parametrize("name, label, modulus, remainder, least", [
    ("op10_quality_gam", "quality", 4, 2, 0.95), ("op1_toxicity", "toxic", 3, 1, 0.93),
])
def test_held_out_accuracy(spark, name, label, modulus, remainder, least):
    got = QUERIES[name][0](spark, TABLES).toPandas()
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    assert sorted(got.doc_id) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert (got.held_out == [zlib.crc32(str(i).encode()) % modulus == remainder for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held[label]).mean() >= least


@pytest.mark.parametrize("train, score, label", [(gam.train, gam.score, "quality"), (toxicity.train, toxicity.score, "toxic")])
def test_edge_documents(spark, train, score, label):
    docs = spark.createDataFrame(EDGE, DOCS)
    for labels in ([], [(1, 1), (2, 0), (3, None), (None, 1), (3, 1)]):
        table = spark.createDataFrame(labels, f"doc_id long, {label} int")
        out = score(docs, train(docs, table))
        rows = out.collect()
        assert out.columns == ["doc_id", "text", "extra", "score"] and len(rows) == len(EDGE)
        assert all(0.0 <= r.score <= 1.0 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1
    empty = docs.limit(0)
    assert score(empty, train(empty, table)).count() == 0


def test_sample_is_bounded_and_repeatable(spark):
    labels = spark.range(5000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    a = {r.doc_id for r in labelled_sample(labels, "toxic", 3, 1, 500).collect()}
    assert a == {r.doc_id for r in labelled_sample(labels.repartition(7), "toxic", 3, 1, 500).collect()}
    assert 350 < len(a) < 650 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in a)


def test_additive_model_finds_an_interaction():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = gam.fit(x[:3000], y[:3000], pairs=2)
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.85
    alone = gam.fit(x[:3000], y[:3000], pairs=0)
    assert ((alone.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() < 0.65


def test_score_is_the_sum_of_bins():
    model = gam.Model(0.5, [np.array([1.0, 2.0])], [np.array([-1.0, 0.0, 1.0])], [(0, 0)], [np.array([1.5])], [np.array([[0.25, 0], [0, -0.25]])])
    total = np.array([0.5 - 1.0 + 0.25, 0.5 + 0.0 + 0.25, 0.5 + 1.0 - 0.25])
    assert np.allclose(model.score(np.array([[0.5], [1.0], [2.0]])), 1 / (1 + np.exp(-total)))


@pytest.fixture(scope="module")
def reader():
    words = "you are stupid moron an idiot and a loser trash worthless clown here we go walking the scum road"
    return toxicity.Reader(toxicity.language_costs(toxicity.trigram_counts([words] * 50)))


@pytest.mark.parametrize("written, read", [
    ("1d10t", "idiot"), ("!diot!", "idiot"), ("$tup1d", "stupid"), ("m0r0n", "moron"), ("stuuuupid", "stupid"), ("l0s3r$", "loser"),
    ("w.o.r.t.h.l.e.s.s", "worthles"), ("cl0wn,", "clown"), ("sc*m", "scum"), ("trash***", "trash"), ("road", "road"), ("12345", ""), ("***", ""),
])
def test_restoration(reader, written, read):
    assert reader.restored(written) == read


def test_words_set_apart(reader):
    assert "stupid" in reader.words("you are s t u p i d here")
    assert {"idiot", "moron"} <= reader.words("i-d-i-o-t and m o r o n")
    assert reader.words("") == set() and reader.words(None) == set()


def test_viterbi_is_the_cheapest_path(reader):
    """Against all paths of small lattices."""

    def all_paths(word):
        units = list(toxicity._runs(word))
        paths = [("", 0.0)]
        for i, (sign, count) in enumerate(units):
            options = toxicity._readings(sign, count, i == 0, i == len(units) - 1)
            paths = [(out + letters, cost + channel) for out, cost in paths for letters, channel in options]

        def total(path):
            cells = [0, 0, *map(toxicity.cell, path[0]), 0]
            return path[1] + sum(reader.restorer.costs[a, b, c] for a, b, c in zip(cells, cells[1:], cells[2:], strict=False))

        return min(map(total, paths)), {p[0] for p in paths if abs(total(p) - min(map(total, paths))) < 1e-9}

    for word in ("1d10t", "$t0o0p", "a!!b", "sc*m", "l0..ser", "aaab0"):
        assert reader.restorer.word(word) in all_paths(word)[1]


def test_restored_text(spark):
    docs = spark.createDataFrame([(1, "You $tup1d m o r o n"), (2, None)], "doc_id long, text string")
    words = "you stupid moron " * 50
    model = toxicity.Model(toxicity.language_costs(toxicity.trigram_counts([words])), {}, 0.05)
    got = {r.doc_id: r.restored for r in toxicity.restore(docs, model).collect()}
    assert got == {1: "you stupid moron", 2: ""}


@pytest.mark.parametrize("text", [
    "y o u  a r e  s t u p i d", "y o u a r e s t u p i d", "y   o   u   a r e   s   t   u   p   i   d", "s\tt\tu\tp\ti\td",
    "y\no\nu\na\nr\ne\ns\nt\nu\np\ni\nd", "y/o/u/a/r/e/s/t/u/p/i/d", "s,t,u,p,1,d", "y|o|u|a|r|e|s|t|u|p|i|d", "you are st up id",
])
def test_set_apart_sentences(text):
    plain = ["you are stupid. he is a stupid man, and you are not. are you there? stupid people are here"] * 20
    costs = toxicity.language_costs(toxicity.trigram_counts(iter(plain)))
    assert any(f.startswith("stupid") for f in toxicity.features(toxicity.Reader(costs).words(text)))
