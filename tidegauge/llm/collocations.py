"""Phrases that belong together, per language: frequent runs of words, scored by how seldom their parts are apart.

Counting takes two passes. First every block of texts sends its counters, hashed, to slices of the hash space; a slice merges
them into one Misra-Gries summary with more counters than its mass divided by the least count. Such a summary is short by less
than the least count, so each run of words that is frequent enough is still in it, whatever else there is. A block's own
counters are bounded by the block and stay whole. The answer, one bit per counter sent, goes back to the block; the second pass
counts the words of the surviving runs exactly, once per block and run, and a grouped sum decides. Runs that share a counter by
hash only survive together and are told apart in the second pass.

Scores are computed with 38-digit decimals. Every part of a candidate occurs at least as often as the candidate, so the counts
of all parts are among the frequent ones.

Defined cases: a null text is empty; a null lang is `und`, together with the texts that say `und`; rows that repeat count
repeatedly; doc_id and other columns have no part in the result; an empty table gives no rows; a text without words counts
nothing. Ties of the score go to the more frequent phrase, then to the one that comes first in bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import stage
from . import blocks as B
from .blocks import U64

LEAST, LONGEST, TOP, KEPT_SHARE = 10, 3, 2000, 50
BLOCK_BYTES = 8 << 20
SLICE_MASS = 12_000_000
RANK_SALTS = 64

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Words:
    """The words of a block: codes into its dictionary, language, and which word starts a run of a given length."""

    def __init__(self, texts: B.Texts) -> None:
        data = texts.data
        kind = _KIND[data]
        inside = kind == 0
        start, stop = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        full = texts.sizes > 0
        first, last = texts.begins[full], texts.ends[full] - 1  # a text's first and last byte bound its words
        start[first], stop[last] = inside[first], inside[last]
        begins, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
        self.letters, self.offsets = _LOWER[data[inside]], np.concatenate([[0], np.cumsum(ends - begins)])
        plain = pa.Array.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(self.offsets.astype(np.int64)), pa.py_buffer(self.letters)]
        )
        coded = plain.dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.codes, self.words = place[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))  # codes are in order of the words
        text = np.searchsorted(texts.ends, begins, "right")
        # the breaks before a word: ends of pieces and of texts
        breaks = np.cumsum(kind == 2, dtype=np.int32)[begins] if len(begins) else np.zeros(0, np.int32)
        self.joined = (breaks[1:] == breaks[:-1]) & (text[1:] == text[:-1])
        self.langs, of_text = np.unique(np.array([t if t is not None else "und" for t in texts.tags], object).astype(str), return_inverse=True)
        self.lang = of_text[text] if len(text) else np.zeros(0, np.int64)

    def starts(self, length: int) -> np.ndarray:
        """Words that start a run of `length` words within a piece."""
        n = len(self.codes) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(reduce(np.logical_and, [self.joined[i : n + i] for i in range(length - 1)], np.ones(n, bool)))

    def hashes(self, longest: int) -> list[np.ndarray]:
        """Hash of the run of each length at each of its starts; it depends on the language and the words alone."""
        offsets = np.frombuffer(self.words.buffers()[1], np.int64)[: len(self.words) + 1]
        letters = np.frombuffer(self.words.buffers()[2] or b"", np.uint8)
        word = B.hashed_strings(letters, offsets)[self.codes] if len(self.codes) else np.zeros(0, U64)
        langs = [s.encode() + b"\0" for s in self.langs]
        marks = B.hashed_strings(np.frombuffer(b"".join(langs), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in langs])]).astype(np.int64))
        h, found = B.mixed(word + marks[self.lang]) if len(word) else word, []
        for length in range(1, longest + 1):
            if length > 1:
                h = B.mixed(h[:-1] * U64(0xD1342543DE82EF95) + word[length - 1 :]) if len(h) else h
            found.append(h[self.starts(length)])
        return found


def counters(texts: B.Texts, bits: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all runs of a block, ascending, and how many runs each has."""
    cells = np.sort(np.concatenate(Words(texts).hashes(longest)) >> U64(64 - bits))
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
    return cells[first], np.diff(np.concatenate([first, [len(cells)]]))


class Summary:
    """A mergeable Misra-Gries summary: at most `capacity` counters, each short of the true count by `short` at most.

    `short` is at most the mass divided by capacity + 1, so a capacity above mass / least keeps every item with `least`.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity, self.short = capacity, 0
        self.cells, self.counts = np.zeros(0, U64), np.zeros(0, np.int64)

    def merge(self, cells: np.ndarray, counts: np.ndarray) -> None:
        both = np.concatenate([self.cells, cells])
        order = np.argsort(both, kind="stable")
        both, summed = both[order], np.concatenate([self.counts, counts])[order]
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
        self.cells, self.counts = both[first], np.add.reduceat(summed, first) if len(first) else summed
        if len(self.cells) > self.capacity:
            cut = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            left = self.counts > cut
            self.cells, self.counts, self.short = self.cells[left], self.counts[left] - cut, self.short + cut

    def may_have(self, least: int) -> np.ndarray:
        """The cells that may hold an item with `least` occurrences."""
        return self.cells[self.counts + self.short >= least]


def survivors(blocks: DataFrame, runs: int, *, least: int, longest: int, slice_mass: int) -> DataFrame:
    """(block, slice, cells): for every block and slice the block's cells that may be frequent."""
    bits, slices = B.cell_bits(runs), B.slice_bits(runs, slice_mass)

    def send(number: int, texts: B.Texts) -> Iterator[pa.RecordBatch]:
        cells, counts = counters(texts, bits, longest)
        rows = [(number, s, int(counts[at].sum()), B.pack_ascending(cells[at]), B.pack(counts[at])) for s, at in B.sliced(cells, bits, slices)]
        names = ["block", "slice", "mass", "cells", "counts"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=SENT)

    def merge(rows: pa.Table) -> pa.Table:
        mass = pc.sum(rows["mass"]).as_py()
        summary = Summary(mass // least + 1)
        packed = list(zip(rows["cells"], rows["counts"], strict=True))
        for cells, counts in packed:
            summary.merge(B.unpack_ascending(cells.as_py()), B.unpack(counts.as_py()).astype(np.int64))
        frequent = summary.may_have(least)
        back = [B.pack(np.packbits(np.isin(B.unpack_ascending(c.as_py()), frequent, assume_unique=True))) for c, _ in packed]
        return pa.table({"block": rows["block"], "slice": rows["slice"], "kept": pa.array(back, pa.binary())})

    sent = B.each_block(blocks, send, "block long, slice long, mass long, cells binary, counts binary")
    return B.each_slice(sent, merge, "block long, slice long, kept binary")


SENT = pa.schema([("block", pa.int64()), ("slice", pa.int64()), ("mass", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())])


def exact_counts(blocks: DataFrame, answers: DataFrame, runs: int, *, least: int, longest: int, slice_mass: int) -> DataFrame:
    """(lang, size, phrase, n) of the surviving runs with at least `least` occurrences; size 0 has all words of the language.

    A block sends its surviving runs once each, as sorted lists per slice.
    """
    bits, slices = B.cell_bits(runs), B.slice_bits(runs, slice_mass)

    def count(number: int, texts: B.Texts, answer: pa.Table) -> pa.Table:
        words = Words(texts)
        hashes = [h >> U64(64 - bits) for h in words.hashes(longest)]
        sent = np.unique(np.concatenate(hashes))
        kept = np.zeros(len(sent), bool)
        bits_of = dict(zip(answer["slice"].to_pylist(), answer["kept"].to_pylist(), strict=True))
        for s, at in B.sliced(sent, bits, slices):
            kept[at] = np.unpackbits(B.unpack(bits_of[s]).astype(np.uint8), count=at.stop - at.start).astype(bool)
        frequent = sent[kept]
        del sent, kept
        rows, langs = [], words.langs.tolist()
        totals = np.bincount(words.lang, minlength=len(langs))
        rows.append(_listed(0, 0, langs, np.arange(len(langs)), pa.array([""] * len(langs), pa.large_string()), totals))
        # rank: the number of the run one word shorter at each place, among the block's surviving runs of that length
        rank, wide = words.lang.astype(np.int64), max(len(words.words), 1)
        for length in range(1, longest + 1):
            places = words.starts(length)
            place = np.minimum(np.searchsorted(frequent, hashes[length - 1]), max(len(frequent) - 1, 0))
            held = frequent[place] == hashes[length - 1] if len(frequent) else np.zeros(len(places), bool)
            held &= rank[places] >= 0  # its beginning is at least as frequent
            hit = places[held]
            keys, at, inverse, n = np.unique(rank[hit] * wide + words.codes[hit + length - 1], return_index=True, return_inverse=True, return_counts=True)
            rank = np.full(len(words.codes), -1, np.int64)
            rank[hit] = inverse
            some = hit[at]
            parts = [words.words.take(pa.array(words.codes[some + i])).cast(pa.large_string()) for i in range(length)]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if length > 1 else parts[0]
            to = (hashes[length - 1][held][at] >> U64(bits - slices)).astype(np.int64) if slices else np.zeros(len(at), np.int64)
            order = np.argsort(to, kind="stable")  # words stay in order within a slice
            cuts = [0, *(np.flatnonzero(np.diff(to[order])) + 1).tolist(), len(order)] if len(order) else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                of = order[a:b]
                rows.append(_listed(int(to[of[0]]), length, langs, words.lang[some[of]], phrase.take(pa.array(of)), n[of]))
        return pa.Table.from_pylist(rows, schema=LISTED)

    def add(rows: pa.Table) -> pa.Table:
        parts = []
        for row in rows.to_pylist():
            text = pa.array([pa.Codec("zstd").decompress(row["phrases"], row["length"], asbytes=True).decode()], pa.large_string())
            phrase, n = pc.split_pattern(text, "\n").values, B.unpack(row["counts"]).astype(np.int64)
            lang = pa.array(row["langs"], pa.string()).take(pa.array(B.unpack(row["lang"])))
            parts.append(pa.table({"lang": lang, "size": pa.array(np.full(len(n), row["size"], np.int32)), "phrase": phrase, "n": n}))
        summed = pa.concat_tables(parts).group_by(["lang", "size", "phrase"]).aggregate([("n", "sum")]).rename_columns(["lang", "size", "phrase", "n"])
        summed = summed.filter(pc.or_(pc.greater_equal(summed["n"], least), pc.equal(summed["size"], 0)))
        return summed.set_column(2, "phrase", summed["phrase"].cast(pa.string()))

    lists = B.each_answered_block(blocks, answers, count, "slice long, size int, langs array<string>, lang binary, length long, phrases binary, counts binary")
    return B.each_slice(lists, add, "lang string, size int, phrase string, n long")


def _listed(to: int, size: int, langs: list[str], lang: np.ndarray, phrases: pa.Array, n: np.ndarray) -> dict:
    """Phrases of one size and their counts as a row for a slice."""
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(phrases)], pa.int32()), phrases), pa.scalar("\n", pa.large_string()))[0].as_buffer()
    return {
        "slice": to, "size": size, "langs": langs, "lang": B.pack(lang), "length": whole.size,
        "phrases": pa.Codec("zstd", 1).compress(whole, asbytes=True), "counts": B.pack(n),
    }


LISTED = pa.schema([
    ("slice", pa.int64()), ("size", pa.int32()), ("langs", pa.list_(pa.string())), ("lang", pa.binary()), ("length", pa.int64()),
    ("phrases", pa.binary()), ("counts", pa.binary()),
])


def frequent_phrases(
    docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES, slice_mass: int = SLICE_MASS
) -> DataFrame:
    """(lang, size, phrase, n): all runs of up to `longest` words with at least `least` occurrences, counted exactly.

    The rows with size 0 hold the words of each language.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    blocks = B.text_blocks(rows, "lang", block_bytes)
    # a word has two bytes at least, its end included; only the sizes of cells and slices hang on it
    runs = longest * (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2
    answers = survivors(blocks, runs, least=least, longest=longest, slice_mass=slice_mass)
    return exact_counts(blocks, answers, runs, least=least, longest=longest, slice_mass=slice_mass)


def _spans(words, size, shortest: int):
    """All shorter stretches of at least `shortest` words of a phrase."""
    starts = lambda n: F.transform(F.sequence(F.lit(0), size - n), lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    return F.flatten(F.transform(F.sequence(F.lit(shortest), size - 1), starts))


def collocations(
    docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, top: int = TOP, kept_share: int = KEPT_SHARE, **sizes
) -> DataFrame:
    """Report of the operator: the best `top` phrases of each language.

    A phrase scores by the cut that parts it worst; one that lies inside a longer candidate is left out if the longer one has
    at least `kept_share` percent of its occurrences.
    """
    counts = stage(frequent_phrases(docs, least=least, longest=longest, **sizes), "phrases")
    parts = counts.filter("size > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    words = F.split("phrase", " ")
    candidates = counts.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    # a part may begin or end very many candidates: such partitions of a join are split by Spark (adaptive skew join)
    for part, n in (("first", "l"), ("rest", "r")):
        cut = cut.join(parts.select("lang", F.col("part").alias(part), F.col("f").alias(n)), ["lang", part])
    score = F.expr("(1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cut.groupBy("lang", F.concat_ws(" ", "first", "rest").alias("phrase")).agg(
        F.max("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    )
    longer = (
        candidates.filter("size > 2")
        .select("lang", F.explode(F.array_distinct(_spans(words, F.col("size"), 2))).alias("phrase"), F.col("a").alias("in_longer"))
        .groupBy("lang", "phrase").agg(F.max("in_longer").alias("in_longer"))
    )
    alone = best.join(longer, ["lang", "phrase"], "left").filter(
        F.col("in_longer").isNull() | (100 * F.col("in_longer") < kept_share * F.col("a"))
    )
    # the best of each of `RANK_SALTS` parts of a language first, so the last ranking has a bounded number of rows
    order = [F.desc("best.score"), F.desc("a"), "phrase"]
    salted = alone.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)))
    best_of = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best_of.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = counts.filter("size = 0").select("lang", F.col("n"))  # a row per language
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
        F.col("best.score").cast("long").alias("score"),
    )


_LETTERS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LETTERS}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
runs AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
         FROM w, range(1, {LONGEST + 1}) AS sizes(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= {LEAST}),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
cut AS (SELECT c.lang, c.phrase, c.k AS size, c.f AS a, j, array_to_string(string_split(c.phrase, ' ')[:j], ' ') AS first,
               array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ') AS rest
        FROM f AS c, range(1, {LONGEST}) AS cuts(j) WHERE c.k > j),
scored AS (SELECT cut.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
           FROM cut JOIN f AS x ON x.lang = cut.lang AND x.phrase = first JOIN f AS y ON y.lang = cut.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (SELECT * FROM best AS b WHERE NOT EXISTS (SELECT 1 FROM f AS t WHERE t.lang = b.lang AND t.k > b.size
             AND contains(' ' || t.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * t.f >= {KEPT_SHARE} * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
