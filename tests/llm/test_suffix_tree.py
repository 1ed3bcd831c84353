from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pytest

from tidegauge.llm import suffix_tree as st
from tidegauge.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.01"


@dataclass
class Level:
    """Contexts of one length, ascending, with the factor for symbols without an own entry; and their entries."""

    contexts: np.ndarray
    factors: np.ndarray
    entries: np.ndarray
    values: np.ndarray


@dataclass
class Tree:
    """The tree of one small set of texts, in memory, grown level by level with `grow`."""

    size: int  # number of symbols, the start mark included
    root: np.ndarray
    levels: list[Level] = field(default_factory=list)

    def probabilities(self, history: list[np.ndarray], symbol: np.ndarray) -> np.ndarray:
        """Of each symbol behind its history: history[0] is the symbol before, history[1] the one before that; -1: none."""
        p = self.root[symbol]
        key, whole, power = np.zeros(len(symbol), np.int64), np.ones(len(symbol), bool), 1
        for level, before in zip(self.levels, history, strict=False):
            whole = whole & (before >= 0)
            key, power = key + before * power, power * self.size
            if not len(level.contexts):
                continue
            at = np.flatnonzero(whole)
            place = np.minimum(np.searchsorted(level.contexts, key[at]), len(level.contexts) - 1)
            hit = level.contexts[place] == key[at]
            at, place = at[hit], place[hit]
            full = key[at] * self.size + symbol[at]
            entry = np.minimum(np.searchsorted(level.entries, full), len(level.entries) - 1)
            p[at] = np.where(level.entries[entry] == full, level.values[entry], level.factors[place] * p[at])
        return p


def histories(symbols: np.ndarray, owner_start: np.ndarray, depth: int) -> list[np.ndarray]:
    """For a flat array of texts, the symbols 1, 2, ... places before each, -1 beyond the start of the text."""
    place = np.arange(len(symbols)) - owner_start
    found = []
    for back in range(1, depth + 1):
        before = np.full(len(symbols), -1, np.int64)
        before[back:] = symbols[:-back] if back < len(symbols) + 1 else before[back:]
        found.append(np.where(place >= back, before, -1))
    return found


def _split(key: np.ndarray, size: int, length: int) -> list[np.ndarray]:
    """Symbols of a run, the last one first."""
    return [(key // size**i) % size for i in range(length)]


def grow(tree: Tree, contexts: np.ndarray, totals: np.ndarray, runs: np.ndarray, counts: np.ndarray) -> None:
    """Add the level of contexts one symbol longer than the last: those whose followers differ from the shorter context's."""
    size, length = tree.size, len(tree.levels) + 1
    owner_key = runs // size
    place = np.searchsorted(contexts, owner_key)
    held = st._member(owner_key, contexts)
    runs, counts, place, owner_key = runs[held], counts[held], place[held], owner_key[held]
    n = totals[place].astype(np.float64)
    parts = _split(runs, size, length + 1)
    shorter = tree.probabilities(parts[1:length], parts[0]) if length > 1 else tree.root[parts[0]]
    value = np.minimum((counts - st.DISCOUNT) / n, 1 - 1e-9)
    owned = np.bincount(place, value, len(contexts))
    lent = np.bincount(place, shorter, len(contexts))
    # where every symbol has an entry of its own, nothing is left for others: the discounts go back to the entries
    value = np.where(lent[place] > 1 - 1e-9, value / owned[place], value)
    owned = np.bincount(place, value, len(contexts))
    left, lent_left = np.maximum(1 - owned, 1e-12), np.maximum(1 - lent, 1e-12)
    gain = np.bincount(place, value * np.log(value / np.maximum(shorter, 1e-300)), len(contexts)) + left * np.log(left / lent_left)
    keep = (np.bincount(place, minlength=len(contexts)) > 0) & (gain * totals >= st.LEAST_GAIN)
    tree.levels.append(
        Level(contexts[keep], (left / lent_left)[keep], runs[keep[place]], value[keep[place]])
    )


def words(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def brute_base(rows: list[tuple]) -> dict:
    out = [zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in rows]
    c = Counter(w for (_, t), held in zip(rows, out, strict=True) if not held for w in words(t))
    n, v = sum(c.values()), len(c)
    return [
        (i, held, len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)))
        for (i, t), held in zip(rows, out, strict=True)
    ]


def check(frame, rows) -> None:
    key = lambda r: (repr(r[0]), r[2], r[5])
    got, want = sorted(map(tuple, frame.collect()), key=key), sorted(brute_base(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(math.isfinite(g[6]) and g[6] <= 1e-9 for g in got)


def test_split_as_the_contract():
    texts = ["  a B ", "", None, "x\x0by\x0cz\r\n\tq\x1cw\x85v é\xa0K Ä", "one"]
    flat, offsets = st.split_words(pa.array(texts, pa.string()))
    got = [flat.to_pylist()[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
    assert got == [words(t)[:-1] for t in texts]


def test_report_and_held_out_gain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()]
    frame = QUERIES["op9_suffix_tree_lm"][0](spark, TABLES).cache()
    check(frame, rows)
    held = frame.filter("held_out").toPandas()
    assert held.score.sum() > held.base_score.sum()


@pytest.mark.parametrize("block_bytes", [24 << 20, 40])
def test_edge_documents(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(st, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(st, "PIECE_SYMBOLS", block_bytes)
    rows = [(None, None), (0, ""), (1, "a b a b"), (1, "a b a b"), (2, " \n"), (3, "x " * 30_000), (16, "a b unseen"), (5, None), (6, "É a B")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS words", "'x' AS counts", "2 AS block")
    check(st.lm_scores(docs), rows)
    held = [(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    check(st.lm_scores(spark.createDataFrame(held, "doc_id long, text string")), held)
    assert st.lm_scores(docs.limit(0)).count() == 0


def small_tree() -> tuple[Tree, list[list[int]]]:
    r = np.random.default_rng(1)
    texts = [[2, 3, 4] * 30 + r.integers(1, 6, 20).tolist() for _ in range(20)]
    size = 7
    counts = Counter(s for t in texts for s in t)
    n = sum(counts.values()) + len(texts)
    root = np.array([len(texts) / n, *[counts[s] / n for s in range(1, 6)], 0.0])
    tree = Tree(size, root)
    contexts, seen = np.arange(1, 7), np.array([*[counts[s] for s in range(1, 6)], len(texts)])
    lists = pa.array(texts, pa.list_(pa.int32()))
    flat, begins, _ = st.flat_texts(lists, size - 1)
    for length in (1, 2, 3):
        before = histories(flat, begins, length)
        ok = before[-1] >= 0
        key = flat[ok] + sum(h[ok] * size ** (i + 1) for i, h in enumerate(before))
        runs, n_runs = np.unique(key, return_counts=True)
        kept = n_runs >= 3
        grow(tree, contexts, seen, runs[kept], n_runs[kept])
        contexts, seen = runs[kept], n_runs[kept]
    return tree, texts


def test_distributions_sum_to_one():
    tree, _ = small_tree()
    assert [len(level.contexts) > 0 for level in tree.levels] == [True, True, False]
    symbols = np.arange(tree.size)
    for a in range(-1, tree.size):
        for b in range(-1, tree.size) if a >= 0 else [-1]:
            history = [np.full(tree.size, a), np.full(tree.size, b), np.full(tree.size, -1)]
            assert tree.probabilities(history, symbols).sum() == pytest.approx(1.0, abs=1e-6)


def test_longest_context_decides():
    tree, _ = small_tree()
    p = lambda *h: tree.probabilities([np.array([x]) for x in h], np.array([4]))[0]
    assert p(3, -1, -1) > 0.5 > p(-1, -1, -1)
    assert p(3, 2, -1) > p(3, -1, -1)


def test_histories():
    flat, begins, owner = st.flat_texts(pa.array([[5, 6], [], [7]], pa.list_(pa.int32())), 9)
    assert flat.tolist() == [9, 5, 6, 0, 9, 0, 9, 7, 0] and owner.tolist() == [0] * 4 + [1] * 2 + [2] * 3
    one, two = histories(flat, begins, 2)
    assert one.tolist() == [-1, 9, 5, 6, -1, 9, -1, 9, 7] and two.tolist() == [-1, -1, 9, 5, -1, -1, -1, -1, 9]


def test_rare_phrases_stay_in_a_large_table(spark):
    """A phrase seen eight times is learned beside 900,000 other tokens as it is beside few."""
    r = np.random.default_rng(2)
    learned = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = next(i for i in range(100) if i not in learned)
    phrase = [(i, "north harbour tide gauge") for i in learned[:8]] + [(held, "north harbour tide gauge")]
    filler = [(i, " ".join(f"w{x}" for x in r.integers(0, 300, 20_000))) for i in learned[8:53]]
    score = lambda rows: {x.doc_id: x for x in st.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}[held]
    found = score(phrase + filler)
    assert found.train_tokens > 900_000 and found.score > found.base_score + 10


def test_tables_hold_the_tree_in_memory(spark, monkeypatch):
    monkeypatch.setattr(st, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(st, "SLICE_WORDS", 3_000)
    r = np.random.default_rng(3)
    lines = [[f"w{x}" for x in np.minimum(r.geometric(0.08, 8), 60)] for _ in range(40)]
    rows = [(i, " ".join(w for k in r.integers(0, 40, 12) for w in lines[k]) + f" once{i}") for i in range(70)]
    learned = [t.split() for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in learned for w in t)
    n, v = sum(counts.values()) + len(learned), len(counts) + 1
    once, twice = (sum(c == k for c in [*counts.values(), len(learned)]) for k in (1, 2))
    totals = st.Totals(n, v, len(learned), min(0.9, once / (once + 2 * twice)))
    common = sorted(w for w, c in counts.items() if c >= st.LEAST)
    number = {w: st.WORDS + i for i, w in enumerate(common)}
    rare = [c for w, c in counts.items() if w not in number]
    size = st.WORDS + len(common) + 1
    rest = sum(c - totals.discount for c in rare) / n + totals.unknown
    root = np.array([totals.known(len(learned)), rest, *(totals.known(counts[w]) for w in common), 1e-300])
    root[:-1] /= root[:-1].sum()
    tree = Tree(size, root)
    flat = lambda texts: st.flat_texts(pa.array([[number.get(w, st.REST) for w in t] for t in texts], pa.list_(pa.int32())), size - 1)
    symbols, begins, _ = flat(learned)
    contexts, seen = np.arange(1, size), np.array([sum(rare), *(counts[w] for w in common), len(learned)])
    contexts, seen = contexts[seen > 0], seen[seen > 0]
    for length in range(1, st.DEPTH + 1):
        before = histories(symbols, begins, length)
        ok = before[-1] >= 0
        runs, times = np.unique(symbols[ok] + sum(h[ok] * size ** (i + 1) for i, h in enumerate(before)), return_counts=True)
        runs, times = runs[times >= st.LEAST], times[times >= st.LEAST]
        grow(tree, contexts, seen, runs, times)
        contexts, seen = runs, times
    assert all(len(level.contexts) for level in tree.levels)
    got = {x.doc_id: x.score for x in st.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        words = text.split()
        line, start, _ = flat([words])
        p = tree.probabilities([h[1:] for h in histories(line, start, st.DEPTH)], line[1:])
        inside = sum(math.log10((totals.known(counts[w]) if counts[w] else totals.unknown) / rest) for w in words if w not in number)
        assert got[i] == pytest.approx(np.log10(p).sum() + inside, abs=1e-6)


def test_a_pair_in_every_block_and_in_a_third_of_all_pairs(spark, monkeypatch):
    """Counts of runs, added over a block per text, are those of the texts, whatever the number of slices."""
    monkeypatch.setattr(st, "BLOCK_BYTES", 1)
    monkeypatch.setattr(st, "SLICE_WORDS", 2_000)
    r = np.random.default_rng(5)
    rows = [(i, " ".join(["hot pair"] * 6 + [f"w{x}" for x in r.integers(0, 40, 12)])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    slices = st.B.slice_bits(sum(len(t) for _, t in rows) // 2, st.SLICE_WORDS)
    assert slices > 1
    coded = st.stage(st.coded_blocks(docs, 7, 2, slices), "coded")
    assert coded.count() == len(rows)
    answers = st.stage(st.word_answers(coded), "answers")
    own = st.stage(st.run_answers(coded, answers, 2, slices), "answers")
    got = sorted(n for x in own.filter("block = -1").collect() for n in x.n)
    seen = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            line = ["<", *t.split(), ">"]
            seen.update(zip(line, line[1:], strict=False))
    assert got == sorted(n for n in seen.values() if n >= st.LEAST)
    assert own.filter("block >= 0").select("block").distinct().count() == len(rows)


def test_what_a_slice_says_of_a_run_takes_less_than_a_byte(spark):
    """Answers are kept on disk until the texts are scored, a copy of each frequent run for every block that has it."""
    r = np.random.default_rng(7)
    words = np.minimum(r.geometric(0.002, 60_000), 3_000).reshape(30, 2_000)
    rows = [(i, " ".join(f"w{x}" for x in np.tile(line, 8))) for i, line in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    coded = st.stage(st.coded_blocks(docs, 7, 2, 2), "coded")
    answers = st.stage(st.word_answers(coded), "answers")
    told = [x.asDict() for length in (2, 3) for x in _level(coded, answers, length) if x.block >= 0 and x.level == length]
    runs = sum(len(st.B.unpack_ascending(x["ids"])) for x in told)
    assert runs > 1_000
    taken = sum(len(v) for x in told for v in x.values() if isinstance(v, bytearray | bytes))
    assert taken < runs, taken / runs


def _level(coded, answers, length):
    for k in range(2, length + 1):
        answers = answers.unionByName(st.stage(st.run_answers(coded, answers, k, 2), "answers"))
    return answers.collect()
