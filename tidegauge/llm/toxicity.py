"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

Channel: a writer may replace letters by look-alikes (`1d10t`), repeat them (`stuuupid`), put signs between them or set them
apart (`s t u p i d`). A disguised word is a lattice of characters: every sign is one of the letters it looks like, itself, or
nothing, and a run of one letter is one or two of it. A Viterbi search finds the path with the least channel cost plus cost
under a character trigram model, which is counted over all documents. A word without any such sign has one path, itself. In a
run of single signs or pairs that are set apart, each gap is nothing or a word's end, so the search also finds the words.

Score: features are the restored words and their beginnings, doubled letters written once. On a bounded sample of labelled
documents that are not held out, a feature becomes part of the lexicon if nearly all documents with it are toxic and their
number cannot be chance; copies count once there, by a min-hash of their words. A document's score combines its lexicon
features as independent causes.

The trigram counts have a fixed number of cells and the lexicon comes from the bounded sample, so both are sent to all tasks.
Scoring is one pass over whole texts without a shuffle.

Defined cases: a null text is empty and scores the base rate; without toxic labels the lexicon is empty; repeated rows score
alike; an empty table gives no rows; other columns pass through, and a column with the name of an output column is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import SAMPLE_ROWS, held_out, labelled_sample
from .workers import map_batches, schema_of

# Letters of the model: 0 is a word's edge, 1-26 a-z, all other letters share 37 cells by their code point.
CELLS = 64
# What a sign may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
}
# Channel costs, in nats: a sign for a letter; a sign that means nothing, by kind; a digit as it stands; a repeated letter.
SWAP, DROP_SIGN, DROP_MARK, DROP_EDGE, KEEP, REPEAT = 1.5, 8.0, 1.5, 0.5, 6.0, 0.7
WIDE_GAP = 3.0  # a gap wider than the run's narrowest that is no word's end
WORD_MEMORY = 200_000

SIGN = re.compile(r"[^\W\d_]")
DISGUISED = re.compile(r"(.)\1\1|[\d@$!|+(€£¡*.\-_]")
# Three or more groups of one or two signs, with any blanks and separators between them.
GAP = r"[\s.,;:\-_*/\\|~·•]++"
APART = re.compile(rf"(?<![\w@$!])(?:[^\W_]|[@$!]){{1,2}}(?:{GAP}(?:[^\W_]|[@$!]){{1,2}}){{2,}}(?![\w@$!])")
GAPS = re.compile(f"({GAP})")
DOUBLES = re.compile(r"(.)\1+")
MIN_PREFIX, MAX_PREFIX = 4, 8
WINDOW = 12


def cell(letter: str) -> int:
    if "a" <= letter <= "z":
        return ord(letter) - 96
    return 27 + ord(letter) % (CELLS - 27) if letter.isalpha() else 0


def _cell_table() -> np.ndarray:
    return np.array([cell(chr(i).lower()[0]) for i in range(65_536)] + [0], np.int64)


def trigram_counts(texts: Iterator[str | None]) -> np.ndarray:
    """Counts of letter trigrams, flat, over whole texts; everything that is no letter is a word's edge."""
    table, total = _cell_table(), np.zeros(CELLS**3, np.int64)
    for text in texts:
        if text:
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            c = np.concatenate([[0, 0], table[np.minimum(points, 65_536)], [0]])
            total += np.bincount(c[:-2] * CELLS**2 + c[1:-1] * CELLS + c[2:], minlength=CELLS**3)
    return total


def language_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of a letter after two letters, smoothed by the probability after one."""
    three = counts.reshape(CELLS, CELLS, CELLS).astype(np.float64)
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1.0) / (one.sum() + CELLS)
    p2 = (two + 20.0 * p1) / (two.sum(axis=1, keepdims=True) + 20.0)
    p3 = (three + 20.0 * p2[None]) / (three.sum(axis=2, keepdims=True) + 20.0)
    return -np.log(p3)


def _runs(word: str) -> Iterator[tuple[str, int]]:
    at = 0
    while at < len(word):
        stop = at + 1
        while stop < len(word) and word[stop] == word[at]:
            stop += 1
        yield word[at], stop - at
        at = stop


def _readings(sign: str, count: int, first: bool, last: bool) -> list[tuple[str, float]]:
    """What a run of one sign may stand for, each with its channel cost.

    A digit, `@` or `$` hardly means nothing; other signs may be marks, most easily at the end of a word.
    """
    if sign.isalpha():
        found = [(sign, REPEAT * (count == 2))]
        if count > 1:
            found.append((sign * 2, REPEAT * (count > 2)))
        return found
    letters = LOOKS_LIKE.get(sign, "")
    if sign.isdigit() or sign in "@$" and not last:
        found = [("", DROP_SIGN)]
    elif last or first and not letters:
        found = [("", DROP_EDGE)]
    else:
        found = [("", DROP_MARK if not first else DROP_SIGN)]
    for letter in letters:
        found.append((letter, SWAP + REPEAT * (count > 1) + (len(letters) > 2)))
        if count > 1:
            found.append((letter * 2, SWAP + REPEAT))
    if sign.isdigit():
        found.append((sign * count, KEEP))
    return found


class Restorer:
    """Viterbi search over the lattice of a disguised word."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = costs

    def word(self, written: str) -> str:
        return "".join(self._search([written], []))

    def words(self, run: str) -> list[str]:
        """The words of a run of groups that are set apart."""
        parts = GAPS.split(run)
        gaps = list(map(len, parts[1::2]))
        narrow = min(gaps)
        return "".join(self._search(parts[::2], [WIDE_GAP * (n > narrow) for n in gaps])).split()

    def _search(self, groups: list[str], inside: list[float]) -> list[str]:
        """Readings along the best path; between two groups a blank, or nothing at the cost of being inside a word."""
        end = len(groups) - 1
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}  # paths are linked backwards
        for g, group in enumerate(groups):
            if g:
                a_blank = min(((cost + self.costs[a, b, 0], path) for (a, b), (cost, path) in best.items()), key=lambda x: x[0])
                best = {state: (cost + inside[g - 1], path) for state, (cost, path) in best.items()}
                if (0, 0) not in best or a_blank[0] < best[0, 0][0]:
                    best[0, 0] = (a_blank[0], (a_blank[1], " "))
            units = list(_runs(group))
            for i, (sign, count) in enumerate(units):
                first, last = g == 0 and i == 0, g == end and i == len(units) - 1
                reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
                for (a, b), (cost, path) in best.items():
                    for letters, channel in _readings(sign, count, first, last):
                        x, y, total = a, b, cost + channel
                        for letter in letters:
                            c = cell(letter)
                            total += self.costs[x, y, c]
                            x, y = y, c
                        if (x, y) not in reached or total < reached[x, y][0]:
                            reached[x, y] = (total, (path, letters))
                best = reached
        path = min(((cost + self.costs[a, b, 0], path) for (a, b), (cost, path) in best.items()), key=lambda x: x[0])[1]
        found = []
        while path is not None:
            path, letters = path
            found.append(letters)
        return found[::-1]


def _plain(word: str) -> str:
    return DOUBLES.sub(r"\1", word)


class Reader:
    """Restored words of whole texts; distinct written words are restored once while they are remembered."""

    def __init__(self, costs: np.ndarray) -> None:
        self.restorer = Restorer(costs)
        self.known: dict[str, str] = {}
        self.apart: dict[str, set[str]] = {}

    def restored(self, written: str) -> str:
        """A written word as it is read: lower case, disguise undone, doubled letters once; no letters: empty."""
        found = self.known.get(written)
        if found is None:
            word = written.strip(".,;:?\"'()[]{}<>«»„“”-_*#%&")
            if not SIGN.search(word):
                found = ""
            elif DISGUISED.search(word):
                found = _plain(self.restorer.word(word))
            else:
                found = _plain(word)
            if len(self.known) >= WORD_MEMORY:
                self.known.clear()
            if len(written) <= 64:
                self.known[written] = found
        return found

    def set_apart(self, run: str) -> set[str]:
        """The words of a run of groups that are set apart; in a run of single signs a word may begin at each, whatever its length."""
        found = self.apart.get(run)
        if found is None:
            found = set(map(_plain, self.restorer.words(run))) if SIGN.search(run) else set()
            signs = GAPS.split(run)[::2]
            if found and all(len(sign) == 1 for sign in signs):
                # equal gaps hide where words begin: each sign may begin one, and as many signs are read as its beginning needs
                line = "".join(signs)
                found.update(self.beginning(line[i : i + WINDOW]) for i in range(len(line) - MIN_PREFIX + 1))
            if len(self.apart) >= WORD_MEMORY:
                self.apart.clear()
            if len(run) <= 64:
                self.apart[run] = found
        return found

    def beginning(self, signs: str) -> str:
        found = self.known.get(f" {signs}")
        if found is None:
            if len(self.known) >= WORD_MEMORY:
                self.known.clear()
            found = self.known[f" {signs}"] = _plain(self.restorer.word(signs))
        return found

    def words(self, text: str | None) -> set[str]:
        """The distinct restored words of a text, with those that were set apart."""
        lower = (text or "").lower()
        found = set(map(self.restored, set(lower.split())))
        for run in APART.finditer(lower):
            found |= self.set_apart(run.group())
        found.discard("")
        return found


def features(words: set[str]) -> set[str]:
    """Whole words, marked by a final blank, and their beginnings."""
    found = {f"{w} " for w in words}
    for w in words:
        found.update(w[:n] for n in range(MIN_PREFIX, min(MAX_PREFIX, len(w)) + 1))
    return found


@dataclass
class Model:
    costs: np.ndarray
    lexicon: dict[str, float]
    base: float


def train_language(docs: DataFrame) -> np.ndarray:
    """The character model from all documents: partial counts per task, summed by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS**3, np.int64)
        for batch in batches:
            total += trigram_counts(t.as_py() for t in batch.column(0))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["cell", "n"])

    summed = map_batches(docs.select("text"), run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(CELLS**3, np.int64)
    for row in summed.collect():  # at most CELLS^3 cells
        counts[row.cell] = row.n
    return language_costs(counts)


def _min_hash(words: set[str]) -> int:
    return min((xxhash.xxh64_intdigest(w) for w in words), default=0) >> 1


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    modulus: int = 3,
    remainder: int = 1,
    rows: int = SAMPLE_ROWS,
    least: int = 6,
    purity: float = 0.9,
) -> Model:
    """Character model from all documents, lexicon from at most about `rows` labelled ones."""
    costs = train_language(docs)
    sent = docs.sparkSession.sparkContext.broadcast(costs)
    sample = labelled_sample(labels, "toxic", modulus, remainder, rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", F.col("y").cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, clean, seen = Reader(sent.value), Counter(), set()
        totals = Counter()
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1), strict=True):
                words = reader.words(text.as_py())
                if y.as_py() > 0:
                    key = _min_hash(words)
                    seen.update((f, key) for f in features(words))
                    totals["toxic"] += 1
                else:
                    clean.update(features(words))
                    totals["clean"] += 1
        names = [f for f, _ in seen] + list(clean) + [f" {k}" for k in totals]
        keys = [k for _, k in seen] + [None] * (len(clean) + len(totals))
        counts = [0] * len(seen) + list(clean.values()) + list(totals.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["f", "k", "n"]
        )

    counted = map_batches(picked, run, "f string, k long, n long")
    by_key = counted.groupBy("f", "k").agg(F.sum("n").alias("n"))
    by_feature = by_key.groupBy("f").agg(F.count("k").alias("t"), F.sum("n").alias("n"))
    pure = F.col("t") >= purity * (F.col("t") + F.col("n"))
    chosen = by_feature.filter(((F.col("t") >= least) & pure) | F.startswith("f", F.lit(" "))).collect()
    totals = {r.f: r.n for r in chosen if r.f.startswith(" ")}
    toxic, clean = totals.get(" toxic", 0), totals.get(" clean", 0)
    base = (toxic + 0.5) / (toxic + clean + 1.0)
    # by chance, t of t documents with a feature are toxic with probability base^t; it must be far below one in a million
    lexicon = {
        r.f: (r.t + 0.25) / (r.t + r.n + 0.5)
        for r in chosen
        if not r.f.startswith(" ") and (r.t - r.n) * np.log(base) < np.log(1e-5)
    }
    return Model(costs, lexicon, min(base, 0.05))


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """The documents with the probability of being toxic in column `into`.

    Restored words are independent causes; of a word's lexicon features the strongest counts.
    """
    # plain values: a broadcast is read without the package
    sent = docs.sparkSession.sparkContext.broadcast((model.costs, model.lexicon, model.base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, lexicon, base = sent.value
        reader, weights = Reader(costs), {}

        def weight(word: str) -> float:
            found = weights.get(word)
            if found is None:
                found = max((lexicon[f] for f in features({word}) if f in lexicon), default=0.0)
                if len(weights) >= WORD_MEMORY:
                    weights.clear()
                weights[word] = found
            return found

        for batch in batches:
            values = []
            for text in batch.column(batch.schema.get_field_index("text")):
                clear = 1.0 - base
                for w in reader.words(text.as_py()):
                    clear *= 1.0 - weight(w)
                values.append(1.0 - clear)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, into]
            )

    kept = docs.drop(into)
    return map_batches(kept, run, f"{schema_of(kept)}, `{into}` double")


def restore(docs: DataFrame, model: Model, into: str = "restored") -> DataFrame:
    """The documents with their texts restored word by word in column `into` (blanks between words become one)."""
    sent = docs.sparkSession.sparkContext.broadcast(model.costs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(sent.value)

        def word(written: str) -> str:
            core = written.strip(".,;:?\"'()[]{}<>«»„“”-_*#%&")
            if SIGN.search(core) and DISGUISED.search(core):
                return written.replace(core, restorer.word(core), 1)
            return written

        def apart(run: re.Match) -> str:
            found = restorer.words(run.group())
            return run.group() if found == GAPS.split(run.group())[::2] else " ".join(found)

        for batch in batches:
            texts = []
            for text in batch.column(batch.schema.get_field_index("text")):
                joined = APART.sub(apart, (text.as_py() or "").lower())
                texts.append(" ".join(map(word, joined.split())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into]
            )

    kept = docs.drop(into)
    return map_batches(kept, run, f"{schema_of(kept)}, `{into}` string")


def toxicity_report(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7) -> DataFrame:
    """Query of the operator."""
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
