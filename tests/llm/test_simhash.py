from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegauge.llm import simhash
from tidegauge.llm.components import components


def slow_fingerprint(text: str | None) -> int:
    """The contract, word for word."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(nodes: list[tuple], linked) -> dict:
    parent = list(range(len(nodes)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(nodes)), 2):
        if linked(nodes[i], nodes[j]):
            parent[find(i)] = find(j)
    return {i: find(i) for i in range(len(nodes))}


def test_spark_and_library_hash_alike(spark):
    texts = ["a b c d", "é ü 日本", ""]
    got = [r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("h")).collect()]
    assert [g % (1 << 64) for g in got] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "A b\tC d e  f é\xa0x", "x " * 5000, "ÄÖ Ü a b c d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 4) == slow_fingerprint(text)


def test_masks_cover_every_pair():
    """For any 4 positions some mask holds none of them."""
    masks = [m % (1 << 64) for m in simhash.covering_masks(4)]
    assert len(masks) == 31
    picked = random.Random(1)
    for _ in range(20_000):
        flips = sum(1 << b for b in picked.sample(range(64), 4))
        assert any(not m & flips for m in masks)
    few = [m % (1 << 12) for m in simhash.covering_masks(2, 12)]
    assert all(any(not m & (1 << a | 1 << b) for m in few) for a, b in itertools.combinations(range(12), 2))


@pytest.mark.parametrize("group_rows", [4096, 3])
def test_links_connect_what_exact_pairs_connect(spark, group_rows):
    picked = random.Random(2)
    centres = [picked.getrandbits(64) for _ in range(12)]
    prints = {0, 1, (1 << 64) - 1}
    for c in centres:
        for _ in range(40):
            prints.add(c ^ sum(1 << b for b in picked.sample(range(64), picked.randint(0, 5))))
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 4, group_rows)
    rows = [(r.a, r.b) for r in links.collect()]
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 4 for a, b in rows)
    roots = {r.node: r.root for r in components(links).collect()}
    want = slow_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    groups: dict = {}
    for i, root in want.items():
        groups.setdefault(root, set()).add(signed[i][0])
    for members in groups.values():
        assert len({roots.get(m, m) for m in members}) == 1
    assert len({roots.get(s[0], s[0]) for s in signed}) == len(groups)


def test_spanning_links_are_few():
    near = np.array([1 << b for b in range(64)] + [0], np.uint64).view(np.int64)
    assert len(simhash.spanning_links([near], 4)) == 64


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    odd = [(5000, 5000), (None, 7), (6000, 6001), (6001, 6000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + odd, "a long, b long")).collect()}
    assert len({got[i] for i in range(201)}) == 1 and len({got[1000 + i] for i in range(300)}) == 1
    assert set(got) == set(range(201)) | {1000 + i for i in range(300)} | {6000, 6001}
    assert len(set(got.values())) == 3
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def documents() -> list[tuple]:
    picked = random.Random(3)
    base = [" ".join(picked.choices("alpha beta gamma delta eps zeta eta theta".split(), k=120)) for _ in range(6)]
    rows = [(i * 10 + j, b if j < 3 else b.replace("alpha", "omega", 1) + f" tail{j}") for i, b in enumerate(base) for j in range(6)]
    return rows + [(900, None), (901, ""), (902, " "), (903, "word"), (904, "word"), (904, "word"), (None, "no id"), (None, base[0])]


def test_report(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "'x' AS fingerprint", "2 AS _fp")
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr)
    prints = [slow_fingerprint(t) for _, t in rows]
    roots = slow_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {r: min((rows[i][0] for i in roots if roots[i] == r and rows[i][0] is not None), default=None) for r in roots.values()}
    want = sorted(((rows[i][0], f"{prints[i]:016x}", smallest[roots[i]]) for i in range(len(rows))), key=repr)
    assert got == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.count() == len(smallest) and kept.columns == [c for c in docs.columns]
    assert {r.doc_id for r in kept.collect()} == set(smallest.values())
