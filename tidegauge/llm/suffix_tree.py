"""LM scoring with a probabilistic suffix tree over words.

Tree: a context is a run of up to `DEPTH` symbols. Symbols are the end of a text and the words with at least `LEAST` training
occurrences; all other words are one symbol, whose share is passed on to a word by its count. Level by level, the runs with at
least `LEAST` occurrences are counted, and a context stays in the tree if the distribution behind it differs from that of the
longest shorter context in the tree (a likelihood-ratio test). A context's distribution is its discounted counts; what is left
over goes to the other symbols as the shorter context has them. Unknown words have the mass that absolute discounting takes
from the known ones. A text is scored by the longest context in the tree at each token, and all distributions sum to 1 over
known words, the end and "unknown". `LEAST` is a count, not a share: the tree grows with the texts.

Work: a text is split once. A block of texts is one row with a dictionary of its own; dictionaries, not tokens, go to slices of
the hash space that add them, and counts come back to the block. Each longer level works alike: a block sends its distinct runs,
once each with their count, packed in a row per slice, and gets back a bit for each, which says whether it is frequent, and the
ids and counts of those that are; the block finds again what it sent by doing the same work. A run is named by the ids of its first and its
last part, so only runs of two frequent parts are sent, and all counts are exact. A run comes to its slice at most once per block,
however frequent it is, and slices grow in number with the texts. The tree's tables hold each frequent run once; what a block
needs of them comes back packed, only for contexts that are kept: a run's probability follows from its count and its context's.

Defined cases: a null text is empty, and an empty text is its end alone; a null id is never held out; repeated rows count
repeatedly; without training texts every word is unknown; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import remove_path, stage
from . import blocks as B
from .blocks import U64
from .labels import held_out
from .workers import map_batches, ship_package

LEAST = 5
DEPTH = 3
BLOCK_BYTES = 8 << 20
PIECE_SYMBOLS = 400_000
DISCOUNT = 0.5
LEAST_GAIN = 20.0
# texts of about that many words share a slice
SLICE_WORDS = 8_000_000
# symbols: end of text, any rare word, then the frequent words and runs of a slice from slice << SLICE_SHIFT on; the start mark
END, REST, WORDS, START = 0, 1, 2, 1 << 62
SLICE_SHIFT = 36
TEXTS = ["block", "ids", "held_out", "sizes", "codes"]
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch, A-Z in lower case, and the offsets of each text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "").cast(pa.string())))
    flat, offsets = parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
    real = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), before[offsets]


@contextmanager
def shuffles_end_with_their_query(spark: SparkSession):
    """What is written inside the block is staged, so the shuffle files behind it go as soon as it is written."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def unstage(table: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    files = table.inputFiles()
    if files:
        remove_path(table.sparkSession, files[0].rsplit("/", 1)[0])


def _pieces(batch: pa.RecordBatch, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about `block_bytes` of text (a longer text is a piece of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes) // block_bytes
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def coded_blocks(docs: DataFrame, modulus: int, remainder: int, slices: int) -> DataFrame:
    """A row per block: its texts as codes into the block's dictionary, and the dictionary in parts, one per slice.

    A part has the words that hash to the slice, in order, and their training counts; codes count through all parts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    block_bytes = BLOCK_BYTES
    marked = docs.select("doc_id", "text", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"))
    part = pa.struct([("slice", pa.int64()), ("length", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for piece in _pieces(batch, block_bytes):
                words, offsets = split_words(piece.column("text"))
                found = words.dictionary_encode()
                held = piece.column("held_out").to_numpy(zero_copy_only=False)
                ascending = pc.sort_indices(found.dictionary).to_numpy()
                dictionary = found.dictionary.take(pa.array(ascending)).cast(pa.large_string())
                ends = np.frombuffer(dictionary.buffers()[1], np.int64)[: len(dictionary) + 1]
                letters = np.frombuffer(dictionary.buffers()[2] or b"", np.uint8)[: ends[-1] if len(dictionary) else 0]
                to = _slice_of(B.hashed_strings(letters, ends) if len(dictionary) else np.zeros(0, U64), slices)
                order = np.argsort(to, kind="stable")
                place = np.empty(len(order), np.int64)
                place[ascending[order]] = np.arange(len(order))
                codes = place[found.indices.to_numpy(zero_copy_only=False)]
                counts = np.bincount(codes[np.repeat(~held, np.diff(offsets))], minlength=len(order))
                parts = []
                for number_of, at in _stretches(to[order]):
                    chosen = dictionary.take(pa.array(order[at]))
                    lines = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(chosen)], pa.int64()), chosen), pa.scalar("\n", pa.large_string()))
                    whole = lines[0].as_buffer()
                    parts.append({
                        "slice": number_of, "length": whole.size, "words": pa.Codec("zstd", 1).compress(whole, asbytes=True),
                        "counts": B.pack(counts[at]),
                    })
                one = pa.array([0, piece.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]), pa.ListArray.from_arrays(one, piece.column("doc_id")),
                        pa.ListArray.from_arrays(one, piece.column("held_out")), pa.array([B.pack(np.diff(offsets))], pa.binary()),
                        pa.array([B.pack(codes)], pa.binary()), pa.array([parts], pa.list_(part)),
                    ],
                    names=["block", "ids", "held_out", "sizes", "codes", "parts"],
                )
                number += 1

    return map_batches(
        marked,
        run,
        f"block long, ids array<{kind}>, held_out array<boolean>, sizes binary, codes binary, "
        "parts array<struct<slice:long,length:long,words:binary,counts:binary>>",
    )


def _slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return (hashes >> U64(64 - slices)).astype(np.int64) if slices else np.zeros(len(hashes), np.int64)


def _stretches(ascending: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Equal numbers of an ascending array, each with its stretch."""
    cuts = [0, *(np.flatnonzero(np.diff(ascending)) + 1).tolist(), len(ascending)] if len(ascending) else [0]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield int(ascending[a]), slice(a, b)


#: What a slice says: to each block about the items it sent, in their order (a: the count of each word; of each run, a bit: is it
#: frequent), with the ids and counts of the frequent ones; and (block -1) the slice's own table.
ANSWERS = pa.schema([
    ("block", pa.int64()), ("level", pa.int64()), ("slice", pa.int64()), ("a", pa.binary()), ("ids", pa.binary()),
    ("counts", pa.binary()), ("pre", pa.list_(pa.int64())), ("suf", pa.list_(pa.int64())), ("id", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())),
    ("stats", pa.list_(pa.int64())),
])
ANSWERS_SQL = (
    "block long, level long, slice long, a binary, ids binary, counts binary, pre array<long>, suf array<long>, id array<long>, "
    "n array<long>, stats array<long>"
)
TOLD = ["block", "level", "slice", "a", "ids", "counts"]


def _ids(number: int, frequent: np.ndarray) -> np.ndarray:
    """Ids of the frequent items of a slice, in their order."""
    return WORDS + (number << SLICE_SHIFT) + np.cumsum(frequent) - 1


def word_answers(coded: DataFrame) -> DataFrame:
    """Training counts of all words, added per slice: to the blocks the counts (a) and the ids of the frequent words."""
    sent = coded.select("block", F.inline("parts"))

    def add(rows: pa.Table) -> pa.Table:
        number, parts = rows["slice"][0].as_py(), []
        for length, words in zip(rows["length"].to_pylist(), rows["words"].to_pylist(), strict=True):
            text = pa.array([pa.Codec("zstd").decompress(words, length, asbytes=True).decode()], pa.large_string())
            parts.append(pc.split_pattern(text, "\n").values)
        counts = [B.unpack(c).astype(np.int64) for c in rows["counts"].to_pylist()]
        found = pa.concat_arrays(parts).dictionary_encode()
        del parts
        order = pc.sort_indices(found.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = rank[found.indices.to_numpy()]
        n = np.bincount(place, np.concatenate(counts), len(order)).astype(np.int64)
        frequent = n >= LEAST
        ids = _ids(number, frequent)
        rare = (n > 0) & ~frequent
        stats = [int(x) for x in (n.sum(), (n > 0).sum(), (n == 1).sum(), (n == 2).sum(), n[rare].sum(), rare.sum())]
        made = [{"block": -1, "level": 1, "slice": number, "id": ids[frequent], "n": n[frequent], "stats": stats}]
        ends = np.cumsum([len(c) for c in counts])
        for block, end, c in zip(rows["block"].to_pylist(), ends, counts, strict=True):
            at = place[end - len(c) : end]
            made.append({"block": block, "level": 1, "slice": number, "a": B.pack(n[at]), "ids": B.pack_ascending(ids[at][frequent[at]].astype(U64))})
        return pa.Table.from_pylist(made, schema=ANSWERS)

    return B.each_slice(sent, add, ANSWERS_SQL)


@dataclass
class Totals:
    """Figures of the training tokens."""

    tokens: int
    distinct: int
    texts: int
    discount: float

    @property
    def unknown(self) -> float:
        """Probability of an unknown word."""
        return self.discount * self.distinct / self.tokens if self.tokens else 1.0

    def known(self, count):
        """Probability of a token by its count."""
        return np.maximum(count - self.discount, 1e-12) / max(self.tokens, 1)

    def base(self, count):
        """Add-one probability of a token by its count."""
        return (count + 1.0) / (self.tokens + self.distinct + 1.0)


def totals_of(answers: DataFrame, texts: int) -> tuple[Totals, int, float]:
    """From the word slices and the number of training texts, each of which has one end; also the occurrences of rare words
    and what is left of them after discounting."""
    got = answers.filter("block = -1").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(6)]).first()
    n, v, n1, n2, rare, rare_words = (int(x or 0) for x in got)
    once, twice = n1 + (texts == 1), n2 + (texts == 2)
    discount = min(0.9, once / (once + 2 * twice)) if once else DISCOUNT
    return Totals(n + texts, v + (texts > 0), texts, discount), rare, rare - discount * rare_words


def symbol_table(answers: DataFrame, totals: Totals, rare: int, rare_left: float) -> tuple[DataFrame, float]:
    """Level of single symbols: `id`, training count `n` and probability `p` without a context; and what all p were divided by."""
    common = answers.filter("block = -1").select(F.inline(F.arrays_zip("id", "n")))
    known = F.greatest(F.col("n") - F.lit(totals.discount), F.lit(1e-12)) / F.lit(max(totals.tokens, 1))
    rest = max(rare_left / max(totals.tokens, 1) + totals.unknown, 1e-12)
    end = float(totals.known(totals.texts)) if totals.texts else totals.unknown
    words = common.agg(F.sum(known).alias("p")).first().p or 0.0
    whole = max(end + rest + words, 1e-300)  # the end may lack its share when no text is learned from
    # nothing is followed by the start mark
    marks = [(END, 0, end / whole), (REST, rare, rest / whole), (START, totals.texts, 1e-300)]
    return common.select("id", "n", (known / F.lit(whole)).alias("p")).unionByName(
        answers.sparkSession.createDataFrame(marks, "id long, n long, p double")
    ), whole


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, n) if len(values) else np.zeros(n)


def flat_texts(lists: pa.Array, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other, each with the start mark before and the end behind it; also each position's text start
    and the number of its text."""
    offsets = lists.offsets.to_numpy() - (lists.offsets[0].as_py() if len(lists) else 0)
    sizes = np.diff(offsets) + 2
    stops = np.cumsum(sizes)
    flat = np.full(int(sizes.sum()), END, np.int64)
    begins = stops - sizes
    inner = np.ones(len(flat), bool)
    inner[begins], inner[stops - 1] = False, False
    flat[inner] = lists.flatten().to_numpy()
    flat[begins] = start
    return flat, np.repeat(begins, sizes), np.repeat(np.arange(len(sizes)), sizes)


def _member(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(keys), bool)
    return of[np.minimum(np.searchsorted(of, keys), len(of) - 1)] == keys


def _distinct(keys: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the place of each key among them, over pieces of a fixed size."""
    parts = [np.unique(keys[start : start + piece], return_inverse=True) for start in range(0, len(keys), piece)]
    if len(parts) < 2:
        return parts[0] if parts else (keys, np.zeros(0, np.int64))
    found, place = np.unique(np.concatenate([some for some, _ in parts]), return_inverse=True)
    begins = np.cumsum([0, *(len(some) for some, _ in parts)])
    return found, np.concatenate([place[begin + of] for begin, (_, of) in zip(begins[:-1], parts, strict=True)])


@dataclass
class Runs:
    """Distinct runs of a block in the order they are sent: by slice, then by the ids of their parts. `place` has the places
    where one ends, and `which` the run there; `before` is the number of the run without its last symbol."""

    place: np.ndarray
    which: np.ndarray
    slices: np.ndarray
    before: np.ndarray
    pre: np.ndarray
    suf: np.ndarray


class Block:
    """Texts of a block as one line of symbols, and at each place the run of each length that ends there.

    `answers` has rows (level, slice, a, ids, counts) about the block's words and runs, and rows (level, slice, size, at, ...) with
    their figures. The block's runs of a length that are in the tables are numbered in the order they were sent, which is that of
    their ids, and so are its symbols: the pairs of numbers of two parts, in their order, are in the order of the ids too.
    """

    def __init__(self, row: pa.Table, answers: pa.Table, slices: int, piece: int) -> None:
        row = row.combine_chunks()
        self.number, self.slices, self.piece = row["block"][0].as_py(), slices, piece
        self.doc_ids, held = (pa.concat_arrays(row[c].chunks).flatten() for c in ("ids", "held_out"))
        self.held_out = held.to_numpy(zero_copy_only=False).astype(bool)
        sizes = B.unpack(row["sizes"][0].as_py()).astype(np.int64)
        self.offsets, self.codes = np.concatenate([[0], np.cumsum(sizes)]), B.unpack(row["codes"][0].as_py()).astype(np.int64)
        answers = answers.sort_by([("level", "ascending"), ("slice", "ascending")])
        self.answers = answers.filter(pc.is_valid(answers["ids"]))
        self.figures = answers.filter(pc.is_null(answers["ids"]))
        self.counts = np.concatenate([np.zeros(0, np.int64), *(c.astype(np.int64) for c in self._all("a", 1, B.unpack))])
        self.frequent = self.counts >= LEAST
        of_code = np.full(len(self.counts), REST, np.int64)
        of_code[self.frequent] = self._joined_ids(1)
        self.size = WORDS + len(self.counts) + 1  # the dictionary's codes are 0, 1, ...
        self.ids = {1: np.concatenate([[END, REST], of_code, [START]]).astype(np.int64)}
        local = np.where(self.frequent, np.arange(len(self.counts)) + WORDS, REST).astype(np.int32)
        coded = pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), pa.array(local[self.codes], pa.int32()))
        self.flat, self.begins, self.owner = flat_texts(coded, self.size - 1)
        self.places, self.contexts = {1: self.flat}, {}

    def _all(self, column: str, level: int, read: Callable) -> list:
        """What the answers of a level, or its figures, have in a column, by slice."""
        rows = self.answers if column in ("slice", "a", "ids", "counts") else self.figures
        return [read(x.as_py()) for x in rows[column].filter(pc.equal(rows["level"], level))]

    def _joined_ids(self, level: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(x.astype(np.int64) for x in self._all("ids", level, B.unpack_ascending))])

    def runs(self, length: int) -> Runs:
        """The block's distinct runs of `length` symbols whose two parts are in the tables."""
        parts = self.at(length - 1)
        ids = self.ids[length - 1]
        ok = parts[1:] >= 0
        ok &= self.begins[1:] != np.arange(1, len(parts)) if length == 2 else parts[:-1] >= 0
        place = np.flatnonzero(ok) + 1
        width = max(len(ids), 1)
        keys, which = _distinct(parts[place - 1] * width + parts[place], self.piece)
        before, last = np.divmod(keys, width)
        pre, suf = ids[before].astype(U64), ids[last].astype(U64)
        to = _slice_of(B.mixed(B.mixed(pre) + suf), self.slices)
        order = np.argsort(to.astype(np.uint16) if self.slices <= 16 else to, kind="stable")
        sent = np.empty(len(order), np.int64)
        sent[order] = np.arange(len(order))
        return Runs(place, sent[which], to[order], before[order], pre[order], suf[order])

    def at(self, length: int) -> np.ndarray:
        """For each place the number of the run of that length ending there, among the block's runs in the tables; -1: none."""
        if length not in self.places:
            runs = self.runs(length)
            held = np.zeros(len(runs.pre), bool)
            bits = dict(zip(self._all("slice", length, int), self._all("a", length, bytes), strict=True))
            for number, of in _stretches(runs.slices):
                if number in bits:
                    held[of] = np.unpackbits(np.frombuffer(bits[number], np.uint8), count=of.stop - of.start).astype(bool)
            numbers = np.where(held, np.cumsum(held) - 1, -1)
            self.ids[length], self.contexts[length] = self._joined_ids(length), runs.before[held]
            self.places[length] = np.full(len(self.flat), -1, np.int64)
            self.places[length][runs.place] = numbers[runs.which]
        return self.places[length]

    def counts_of(self, length: int) -> np.ndarray:
        """Training count of each run of that length, in the order of the numbers."""
        return np.concatenate([np.zeros(0), *self._all("counts", length, B.unpack)])

    def figures_of(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Factor and scale of each run of that length (or each frequent word), in the order of the numbers; NaN: it is no
        context of the tree."""
        sizes = self._all("size", level, int)
        factor, scale = np.full(sum(sizes), np.nan), np.full(sum(sizes), np.nan)
        where = [begin + at.astype(np.int64) for begin, at in zip(np.cumsum([0, *sizes])[:-1], self._all("at", level, B.unpack_ascending), strict=True)]
        for found, column in ((factor, "factor"), (scale, "scale")):
            for at, x in zip(where, self._all(column, level, unpack_figures), strict=True):
                found[at] = x
        return factor, scale


def pack_figures(values: np.ndarray) -> bytes:
    """Floats as their distinct values and the place of each among them; figures of counts repeat much."""
    some, place = np.unique(values, return_inverse=True)
    head = B.pack(some.view(U64))
    return len(head).to_bytes(8, "little") + head + B.pack(place)


def unpack_figures(data: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(data[:8], "little")
    return B.unpack(data[8:end]).astype(U64).view(np.float64)[B.unpack(data[end:])]


def run_answers(coded: DataFrame, answers: DataFrame, length: int, slices: int) -> DataFrame:
    """Runs of `length` symbols with at least `LEAST` training occurrences.

    A block sends each of its distinct runs once (with count 0 if only held-out texts have it), as the ids of the run without its
    last (pre) and without its first symbol (suf), in packed lists per slice; the slice adds the counts and answers which are
    frequent, as a bit for each, and with the ids and counts of those.
    """
    piece = PIECE_SYMBOLS
    ship_package(coded.sparkSession)
    schema = pa.schema([("block", pa.int64()), ("slice", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("counts", pa.binary())])

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        block = Block(left, right, slices, piece)
        runs = block.runs(length)
        counts = np.bincount(runs.which, ~block.held_out[block.owner[runs.place]], len(runs.pre)).astype(np.int64)
        rows = [
            {
                "block": block.number, "slice": s, "a": B.pack_ascending(runs.pre[at]), "b": B.pack(runs.suf[at]),
                "counts": B.pack(counts[at]),
            }
            for s, at in _stretches(runs.slices)
        ]
        return pa.Table.from_pylist(rows, schema=schema)

    def add(rows: pa.Table) -> pa.Table:
        number = rows["slice"][0].as_py()
        read = lambda c, how: [how(x.as_py()) for x in rows[c]]
        pres, sufs, counts = read("a", B.unpack_ascending), read("b", B.unpack), read("counts", B.unpack)
        pre, suf = (np.concatenate(x).astype(np.int64) for x in (pres, sufs))
        some_pre, at_pre = np.unique(pre, return_inverse=True)
        some_suf, at_suf = np.unique(suf, return_inverse=True)
        found, place = np.unique(at_pre * len(some_suf) + at_suf, return_inverse=True)
        n = np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)
        frequent = n >= LEAST
        ids, kept = _ids(number, frequent), found[frequent]
        made = [{
            "block": -1, "level": length, "slice": number, "pre": some_pre[kept // len(some_suf)], "suf": some_suf[kept % len(some_suf)],
            "id": ids[frequent], "n": n[frequent],
        }]
        end = 0
        for block, own in zip(rows["block"].to_pylist(), counts, strict=True):
            of = slice(end, end + len(own))
            end, held = of.stop, frequent[place[of]]
            if held.any():
                made.append({
                    "block": block, "level": length, "slice": number, "a": np.packbits(held).tobytes(),
                    "ids": B.pack_ascending(ids[place[of]][held].astype(U64)), "counts": B.pack(n[place[of]][held]),
                })
        return pa.Table.from_pylist(made, schema=ANSWERS)

    texts = coded.select(*TEXTS)
    to_blocks = answers.filter("block >= 0").select(*TOLD)
    sent = texts.groupBy("block").cogroup(to_blocks.groupBy("block")).applyInArrow(send, "block long, slice long, a binary, b binary, counts binary")
    return B.each_slice(sent, add, ANSWERS_SQL)


def grown(table: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contexts of a level that are kept (id, factor, scale), and the table (id, n, p) of the runs one symbol longer."""
    context, last = table.select(F.col("id").alias("pre"), F.col("n").alias("whole")), table.select(F.col("id").alias("suf"), F.col("p").alias("shorter"))
    own = runs.select("pre", "suf", "id", "n").join(context, "pre").join(last, "suf")
    share = F.least((F.col("n") - F.lit(DISCOUNT)) / F.col("whole"), F.lit(1 - 1e-9))
    own = stage(own.select("pre", "id", "n", "whole", "shorter", share.alias("value")), "followers")
    # where every symbol has an entry of its own, nothing is left for others: the discounts go back to the entries
    sums = own.groupBy("pre").agg(
        F.max("whole").alias("whole"), F.sum("value").alias("owned"), F.sum("shorter").alias("lent"),
        F.sum(F.col("value") * F.log(F.col("value") / F.greatest("shorter", F.lit(1e-300)))).alias("gain"),
    )
    scaled = sums.withColumn("scale", F.when(F.col("lent") > 1 - 1e-9, 1 / F.col("owned")).otherwise(1.0))
    rest = lambda x: F.greatest(1 - x, F.lit(1e-12))
    parts = scaled.withColumn("left", rest(F.col("owned") * F.col("scale"))).withColumn("lent_left", rest(F.col("lent")))
    scaled_gain = F.col("scale") * (F.col("gain") + F.col("owned") * F.log("scale"))
    gain = scaled_gain + F.col("left") * F.log(F.col("left") / F.col("lent_left"))
    kept = parts.filter(gain * F.col("whole") >= LEAST_GAIN)
    contexts = stage(kept.select("pre", "scale", (F.col("left") / F.col("lent_left")).alias("factor")), "contexts")
    p = F.coalesce(F.col("value") * F.col("scale"), "shorter")
    longer = own.join(contexts.select("pre", "scale"), "pre", "left").select("id", "n", p.alias("p"))
    longer = stage(longer, "level")
    unstage(own)
    return contexts.select(F.col("pre").alias("id"), "factor", "scale"), longer


VALUED = pa.schema([
    ("block", pa.int64()), ("level", pa.int64()), ("slice", pa.int64()), ("size", pa.int64()), ("at", pa.binary()),
    ("factor", pa.binary()), ("scale", pa.binary()),
])
VALUED_SQL = "block long, level long, slice long, size long, at binary, factor binary, scale binary"


def values_of(answers: DataFrame, values: DataFrame) -> DataFrame:
    """The figures that the tree has for the runs of the answers, a row for each answer: which are contexts that are kept, and
    their `factor` and `scale`. `values` has (level, id, factor, scale)."""
    ship_package(answers.sparkSession)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("id")
        known, factor, scale = (right[c].to_numpy() for c in ("id", "factor", "scale"))
        made = []
        for row in left.to_pylist():
            ids = B.unpack_ascending(row.pop("ids")).astype(np.int64)
            held = np.flatnonzero(_member(ids, known))
            place = np.searchsorted(known, ids[held])
            made.append(row | {
                "size": len(ids), "at": B.pack_ascending(held.astype(U64)), "factor": pack_figures(factor[place]),
                "scale": pack_figures(scale[place]),
            })
        return pa.Table.from_pylist(made, schema=VALUED)

    # runs of the last length are no contexts
    to_blocks = answers.filter(f"block >= 0 AND level <= {DEPTH}").select("block", "level", "slice", "ids")
    of_slice = values.withColumn("slice", F.shiftright("id", SLICE_SHIFT))
    return to_blocks.groupBy("level", "slice").cogroup(of_slice.groupBy("level", "slice")).applyInArrow(run, VALUED_SQL)


def with_scores(
    coded: DataFrame, answers: DataFrame, valued: DataFrame, marks: dict[int, tuple], totals: Totals, whole: float, slices: int
) -> DataFrame:
    """Figures and `score`, the log10 probability, of each text. `marks` has p, factor, scale and count of the symbols that are no
    words."""
    kind, piece = coded.schema["ids"].dataType.elementType.simpleString(), PIECE_SYMBOLS
    ship_package(coded.sparkSession)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left, right, slices, piece)
        n = len(block.doc_ids)
        count, frequent = block.counts, block.frequent
        owner = np.repeat(np.arange(n), np.diff(block.offsets))
        base = np.log10(totals.base(count))
        rest = np.log10(marks[REST][0])
        inside = np.where(frequent, 0.0, np.log10(np.where(count > 0, totals.known(count), totals.unknown)) - rest)
        ends = lambda i, of: np.concatenate([[marks[END][i], marks[REST][i]], of, [marks[START][i]]])
        p = ends(0, totals.known(count) / whole)[block.flat]
        of_word = np.full((2, len(count)), np.nan)
        of_word[:, frequent] = block.figures_of(1)
        factors, scales, counts = ends(1, of_word[0]), ends(2, of_word[1]), ends(3, count)
        for length in range(1, DEPTH + 1):
            place, context, longer = np.arange(1, len(p)), block.at(length)[:-1], block.at(length + 1)[1:]
            inner = (context >= 0) & (block.begins[1:] != place)
            hit, miss = np.flatnonzero(longer >= 0), np.flatnonzero(inner & (longer < 0))
            if len(miss) and len(factors):
                factor = factors[context[miss]]
                p[miss + 1] *= np.where(np.isnan(factor), 1.0, factor)
            before, n_runs = block.contexts[length + 1], block.counts_of(length + 1)
            if len(hit):
                own = (np.minimum((n_runs - DISCOUNT) / counts[before], 1 - 1e-9) * scales[before])[longer[hit]]
                p[hit + 1] = np.where(np.isnan(own), p[hit + 1], own)
            if length < DEPTH:
                (factors, scales), counts = block.figures_of(length + 1), n_runs
        real = np.flatnonzero(np.arange(len(p)) != block.begins)
        score = _per_text(np.log10(p[real]), block.owner[real], n) + _per_text(inside[block.codes], owner, n)
        return pa.table({
            "doc_id": block.doc_ids,
            "held_out": pa.array(block.held_out),
            "n_tokens": pa.array(np.diff(block.offsets).astype(np.int64) + 1),
            "n_known": pa.array(_per_text((count > 0)[block.codes], owner, n).astype(np.int64) + (totals.texts > 0)),
            "base_score": pa.array(_per_text(base[block.codes], owner, n) + np.log10(totals.base(totals.texts))),
            "score": pa.array(score),
        })

    made = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    told = answers.filter("block >= 0").select(*TOLD).unionByName(valued, allowMissingColumns=True)
    return coded.select(*TEXTS).groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, made)


def lm_scores(docs: DataFrame, *, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """Query of the operator: base figures and the tree's log10 probability of every text."""
    spark = docs.sparkSession
    # a word has two bytes at least, its end included; only the number of slices hangs on it
    slices = B.slice_bits((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2, SLICE_WORDS)
    with shuffles_end_with_their_query(spark):
        with_words = stage(coded_blocks(docs, modulus, remainder, slices), "coded")
        answers = stage(word_answers(with_words), "answers")
        coded = stage(with_words.select(*TEXTS), "texts")  # nothing reads the words any more
        unstage(with_words)
        learned = F.size(F.filter("held_out", lambda x: ~x))
        totals, *rare = totals_of(answers, coded.agg(F.sum(learned)).first()[0] or 0)
        table, whole = symbol_table(answers, totals, *rare)
        table, values = stage(table, "level"), []
        for length in range(2, DEPTH + 2):
            found = stage(run_answers(coded, answers, length, slices), "answers")
            runs = found.filter("block = -1").select(F.inline(F.arrays_zip("pre", "suf", "id", "n")))
            contexts, longer = grown(table, runs)
            values.append(contexts.select(F.lit(length - 1).cast("long").alias("level"), "id", "factor", "scale"))
            if length == 2:
                marks = _marks(table, contexts)
            unstage(table)
            table, answers = longer, answers.unionByName(found)
        unstage(table)
        valued = stage(values_of(answers, reduce(DataFrame.union, values)), "valued")
    return with_scores(coded, answers, valued, marks, totals, whole, slices).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def _marks(table: DataFrame, contexts: DataFrame) -> dict[int, tuple[float, float, float, int]]:
    """p, factor, scale and count of the three symbols that are no words; a symbol that is no context has factor 1 and no scale."""
    three = F.col("id").isin(END, REST, START)
    rows = table.filter(three).join(contexts.filter(three), "id", "left")
    return {r.id: (r.p, r.f, r.s, r.n) for r in rows.select("id", "p", F.coalesce("factor", F.lit(1.0)).alias("f"), F.coalesce("scale", F.lit(float("nan"))).alias("s"), "n").collect()}
