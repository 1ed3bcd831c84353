"""Repeated passages and prefix tries against brute force and DuckDB, with edge cases and small limits."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from test_sql import EDGE_DOCS, EDGE_TURNS, TABLES, same
from tidegauge.llm import blocks, collocations, prefix_trie, suffix_dedup

NONE = 1 << 70


def removed(rows, width=50):
    """A row per document, by looking up every string of `width` bytes."""
    first: dict[bytes, int] = {}
    known = [(NONE if i is None else i, (t or "").encode(), i) for i, t in rows]
    for key, text, _ in known:
        for j in range(len(text) - width + 1):
            first[text[j : j + width]] = min(key, first.get(text[j : j + width], NONE))
    out = []
    for key, text, doc_id in known:
        cover = bytearray(len(text))
        for j in range(len(text) - width + 1):
            if first[text[j : j + width]] < key:
                cover[j : j + width] = b"\1" * width
        runs = sum(1 for j, c in enumerate(cover) if c and not (j and cover[j - 1]))
        kept = bytes(b for b, c in zip(text, cover, strict=True) if not c)
        out.append((doc_id, len(text), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([30, 49, 50, 51, 80, 300]))) for _ in range(12)]
    own = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(60)))
    rows = [
        (rng.choice([None, *range(60)]), "".join(rng.choice([*shared, "x" * rng.randrange(120), own()]) for _ in range(rng.randrange(6))))
        for _ in range(80)
    ]
    return [*rows, (5, None), (6, ""), (7, "a" * 49), (8, "a" * 50), (9, "a" * 5000), (3, "ab" * 500), (4, "ba" * 500)]


SMALL = {"block_bytes": 2000, "slice_grams": 50, "slice_records": 20, "hot": 3}


@pytest.mark.parametrize("rows", [passages(1), passages(2), [(i, t) for i, t, _ in EDGE_DOCS], [(None, None)], []])
@pytest.mark.parametrize("limits", [{}, SMALL])
def test_repeats_against_brute_force(spark, rows, limits):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "'x' AS ids", "2 AS slice", "3 AS kept")
    assert sorted(map(tuple, suffix_dedup.repeats_report(docs.repartition(3), **limits).collect()), key=repr) == removed(rows)


def test_repeats_on_shared_tables(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    want = removed([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, suffix_dedup.repeats_report(docs).collect()), key=repr) == want
    assert sum(r[2] for r in want) > 10_000


def test_passage_of_a_third_of_all_documents(spark):
    passage = "This very passage is in every third document of the table, word for word. "
    rows = [(i, f"{i} {chr(97 + i % 26) * 30} {passage if i % 3 == 0 else ''}{i * 7} end {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.repeats(docs, hot=20, block_bytes=1000).collect()}
    assert sorted(map(tuple, suffix_dedup.repeats_report(docs, hot=20).collect()), key=repr) == removed(rows)
    assert passage.encode() in got[0].kept and all(passage.encode() not in got[i].kept for i in range(3, 300, 3))
    for i, text in rows:
        cut = text.encode()
        for span in reversed(got[i].spans):
            cut = cut[: span.begin] + cut[span.end :]
        assert cut == bytes(got[i].kept)


def test_other_widths(spark):
    rows = passages(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (16, 33, 100):
        assert sorted(map(tuple, suffix_dedup.repeats_report(docs, width=width).collect()), key=repr) == removed(rows, width)
    with pytest.raises(ValueError):
        suffix_dedup.gram_size(15)


@pytest.mark.parametrize("rows", [EDGE_TURNS, EDGE_TURNS[-1:], []])
def test_trie_edges(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS depth", "'x' AS path", "2 AS head")
    same(prefix_trie.trie_report(turns), prefix_trie.SQL, conversations=turns)


@pytest.mark.parametrize("limits", [{}, {"deep_rows": 3, "id_slice": 2}, {"deep_rows": 0}])
def test_trie_of_shared_beginnings(spark, limits):
    rng = random.Random(4)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a b", "", "c"])) for c in range(120) for t in range(rng.randrange(1, 7))]
    rows += [(400, t, "user", f"turn {t % 5}") for t in range(150)] + [(401, t, "user", f"turn {t % 5}") for t in range(140)]
    rows += [(c, 0, "user", "the same") for c in range(500, 700)] + [(1003, 0, "user", "gone"), (-5, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    same(prefix_trie.trie_report(turns, **limits), prefix_trie.SQL, conversations=turns)


PHRASES = [
    (1, "New York is big. new york, NEW YORK\tnew york " * 3, "en"), (2, "new york " * 9 + "\n" + "a a a a " * 5, None),
    (3, "a b\x0bc d\x0ca b\x1fc " * 8, "und"), (4, None, "en"), (5, "", "de"), (6, " .;\t! ", "fr"), (7, "É é É é " * 12, "fr"),
    (7, "É é É é " * 12, "fr"), (None, "x" * 3000 + " y " * 30, "en"),
]


@pytest.mark.parametrize("rows", [PHRASES, PHRASES[3:5], []])
@pytest.mark.parametrize("limits", [{}, {"block_bytes": 300, "slice_mass": 40}])
def test_collocation_edges(spark, rows, limits):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS n", "'x' AS phrase", "2 AS size")
    same(collocations.collocations(docs.repartition(2), **limits), collocations.SQL, documents=docs)


def test_summary_keeps_what_is_frequent():
    rng = np.random.default_rng(5)
    for least, spread in ((10, 40), (3, 400), (25, 5)):
        items = (rng.pareto(1.1, 4000) * spread).astype(np.uint64)
        summary = collocations.Summary(len(items) // least + 1)
        for part in np.split(items, 20):
            summary.merge(*np.unique(part, return_counts=True))
            assert len(summary.cells) <= summary.capacity
        values, counts = np.unique(items, return_counts=True)
        assert summary.short < least and set(values[counts >= least].tolist()) <= set(summary.may_have(least).tolist())
        held = dict(zip(summary.cells.tolist(), summary.counts.tolist(), strict=True))
        assert all(held.get(v, 0) <= c <= held.get(v, 0) + summary.short for v, c in zip(values.tolist(), counts.tolist(), strict=True))


def test_packed_numbers():
    for top in (1, 200, 70_000, 1 << 40, (1 << 64) - 1):
        values = np.array([0, top, top // 2, 1], np.uint64)
        assert (blocks.unpack(blocks.pack(values)) == values).all()
        assert (blocks.unpack_ascending(blocks.pack_ascending(np.sort(values))) == np.sort(values)).all()
    assert len(blocks.unpack(blocks.pack(np.zeros(0, np.int64)))) == 0
