"""Quality classifier: a generalised additive model with pairwise interactions, scored by vectorised bin additions.

Features are figures of the whole text (lengths, character classes, repetition). Each is cut into bins at quantiles of the
training sample. Shallow trees, one feature at a time in turn, are boosted on the log loss, and their leaves are added up in
one lookup table per feature; then the pairs that best explain what is left get two-dimensional tables in the same way. A
score is the sum of the looked-up values through the logistic function.

The model is fitted on the driver on at most `SAMPLE_ROWS` labelled documents, of which only the figures are fetched;
scoring is one pass over the documents without a shuffle.

Defined cases: a null text is empty, and an empty text has all figures 0 and a score like any other; without labels of both
kinds every score is the smoothed share of label 1; repeated rows score alike; an empty table gives no rows; other columns
pass through, and a column with the name of an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import SAMPLE_ROWS, held_out, labelled_sample
from .workers import map_batches, schema_of

FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "lower", "digit", "mark", "symbol", "blank", "line_ends", "bang",
    "bar", "symbol_end", "distinct_words", "doubled_words", "distinct_lines", "words_per_line", "top_word", "short_words",
    "upper_words",
)
UPPER, LOWER, DIGIT, MARK, SYMBOL, BLANK, LINE_END, OTHER = range(8)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Character class by code point; code points from 65,536 on share the last entry."""
    table = np.full(65_537, OTHER, np.uint8)
    for i in range(65_536):
        c = chr(i)
        if c.isupper():
            table[i] = UPPER
        elif c.isalpha():
            table[i] = LOWER
        elif c.isdigit():
            table[i] = DIGIT
        elif c == "\n":
            table[i] = LINE_END
        elif c.isspace():
            table[i] = BLANK
        elif c in ".,;:?'\"()-–—„“”«»’":
            table[i] = MARK
        elif c.isprintable():
            table[i] = SYMBOL
    return table


def figures(text: str) -> list[float]:
    """The features of one whole text, in the order of FEATURES."""
    if not text:
        return [0.0] * len(FEATURES)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    share = np.bincount(_classes()[np.minimum(points, 65_536)], minlength=8) / n
    words = text.split()
    m = max(len(words), 1)
    counts: dict[str, int] = {}
    doubled, ended, short, upper, before = 0, 0, 0, 0, None
    for w in words:
        counts[w] = counts.get(w, 0) + 1
        doubled += w == before
        before = w
    for w, c in counts.items():
        last = w[-1]
        if not last.isalnum() and last not in ".,;:?":
            ended += c
        if len(w) == 1:
            short += c
        if len(w) > 1 and w.isupper():
            upper += c
    lines = [line for line in text.split("\n") if line]
    many = max(len(lines), 1)
    return [
        np.log1p(n), np.log1p(len(words)), (n - len(words)) / m, share[UPPER], share[LOWER], share[DIGIT], share[MARK],
        share[SYMBOL], share[BLANK], share[LINE_END], text.count("!") / n, text.count("|") / n, ended / m,
        len(counts) / m, doubled / m, len(set(lines)) / many, np.log1p(len(words) / many),
        max(counts.values(), default=0) / m, short / m, upper / m,
    ]


@dataclass
class Model:
    """Lookup tables: `cuts` and `tables` per feature, `pairs` with their coarse cuts and two-dimensional tables."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of rows of features, by adding up table entries."""
        total = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, j], side="right")]
        places = {j: np.searchsorted(self.coarse[j], x[:, j], side="right") for pair in self.pairs for j in pair}
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[places[a], places[b]]
        return 1.0 / (1.0 + np.exp(-total))


def _quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.empty(0)


def _leaf(g, h, penalty: float):
    return -g / (h + penalty)


def _gain(g, h, penalty: float):
    return g * g / (h + penalty)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, penalty: float, least: float) -> np.ndarray:
    """A tree of up to `leaves` leaves over ordered bins: the value of every bin. Splits go where the gain is largest."""
    spans, value = [(0, len(g))], np.full(len(g), _leaf(g.sum(), h.sum(), penalty))
    for _ in range(leaves - 1):
        best = (1e-9, None, None)
        for a, b in spans:
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gain = _gain(left_g, left_h, penalty) + _gain(all_g - left_g, all_h - left_h, penalty) - _gain(all_g, all_h, penalty)
            gain[(left_h < least) | (all_h - left_h < least)] = -1.0
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], (a, b), a + at + 1)
        if best[1] is None:
            break
        (a, b), cut = best[1], best[2]
        spans.remove((a, b))
        for c, d in ((a, cut), (cut, b)):
            spans.append((c, d))
            value[c:d] = _leaf(g[c:d].sum(), h[c:d].sum(), penalty)
    return value


def _pair_tree(g: np.ndarray, h: np.ndarray, penalty: float, least: float) -> tuple[float, np.ndarray]:
    """One split of the first feature and one of the second on either side: gain, and the value of every cell."""
    best, value = 0.0, np.zeros_like(g)
    root = _gain(g.sum(), h.sum(), penalty)
    for cut in range(1, g.shape[0]):
        gain, cells = -root, np.zeros_like(g)
        for rows in (slice(0, cut), slice(cut, None)):
            gs, hs = g[rows].sum(axis=0), h[rows].sum(axis=0)
            side = _tree(gs, hs, 2, penalty, least)
            cells[rows] = side
            edges = np.flatnonzero(np.diff(side)) + 1
            for a, b in zip([0, *edges], [*edges, len(gs)], strict=True):
                gain += _gain(gs[a:b].sum(), hs[a:b].sum(), penalty)
        if gain > best:
            best, value = gain, cells
    return best, value


def fit(
    x: np.ndarray,
    y: np.ndarray,
    *,
    bins: int = 64,
    pair_bins: int = 8,
    rounds: int = 150,
    pair_rounds: int = 40,
    pairs: int = 6,
    rate: float = 0.1,
    leaves: int = 3,
    penalty: float = 1.0,
    least: float = 2.0,
) -> Model:
    """Boost the tables on rows `x` with labels `y` of 0 and 1."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Model(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    width = x.shape[1]
    model.cuts = [_quantile_cuts(x[:, j], bins) for j in range(width)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    place = [np.searchsorted(model.cuts[j], x[:, j], side="right") for j in range(width)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            size = len(model.tables[j])
            step = rate * _tree(
                np.bincount(place[j], g, size), np.bincount(place[j], h, size), leaves, penalty, least
            )
            model.tables[j] += step
            total += step[place[j]]

    model.coarse = [_quantile_cuts(x[:, j], pair_bins) for j in range(width)]
    coarse = [np.searchsorted(model.coarse[j], x[:, j], side="right") for j in range(width)]
    sizes = [len(c) + 1 for c in model.coarse]
    grid = lambda a, b, v: np.bincount(coarse[a] * sizes[b] + coarse[b], v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])
    g, h = slopes()
    gains = [
        (_pair_tree(grid(a, b, g), grid(a, b, h), penalty, least)[0], a, b) for a in range(width) for b in range(a + 1, width)
    ]
    model.pairs = [(a, b) for gain, a, b in sorted(gains, key=lambda t: (-t[0], t[1:]))[:pairs] if gain > 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            g, h = slopes()
            step = rate * _pair_tree(grid(a, b, g), grid(a, b, h), penalty, least)[1]
            model.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return model


def _figure_rows(texts: pa.Array) -> np.ndarray:
    rows = [figures(t.as_py() or "") for t in texts]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, *, modulus: int = 4, remainder: int = 2, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled documents that are not held out, at most about `rows` of them."""
    sample = labelled_sample(labels, "quality", modulus, remainder, rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most about `rows` ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _figure_rows(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["doc_id", "y", "x"]
            )

    fetched = map_batches(
        picked.select("doc_id", "text", F.col("y").cast("double").alias("y")),
        run,
        f"{schema_of(docs.select('doc_id'))}, y double, x array<double>",
    )
    # one row per labelled id, also where very many rows repeat it: the sample's bound holds for what the driver gets
    one_each = fetched.groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("r")).select("doc_id", "r.x", "r.y")
    got = sorted((r.doc_id, r.x, r.y) for r in one_each.collect())  # one order, so one model in every run
    x = np.array([r[1] for r in got], np.float64).reshape(len(got), len(FEATURES))
    return fit(x, (np.array([r[2] for r in got]) > 0.5).astype(np.float64))


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """The documents with the model's probability of label 1 in column `into`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _figure_rows(batch.column(batch.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.score(x), pa.float64())], names=[*batch.schema.names, into]
            )

    kept = docs.drop(into)
    return map_batches(kept, run, f"{schema_of(kept)}, `{into}` double")


def quality_report(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7) -> DataFrame:
    """Query of the operator."""
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
