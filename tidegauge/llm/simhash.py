"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: every shingle of a text is hashed with XXH64; a bit of the fingerprint is 1 if it is set in over half the
hashes. Two fingerprints link at `radius` or fewer differing bits.

Covering: each bit position gets a vector of radius + 1 bits, and each non-zero vector v gives a mask of the positions whose
vector has an odd product with v. For any `radius` positions some v is orthogonal to all their vectors, so its mask holds none
of them: every pair within the radius agrees under at least one of the 2^(radius+1) - 1 masks. A table groups the
fingerprints that agree under a mask, and an exact comparison decides.

Only distinct fingerprints are grouped, so copies cost one row. A group is worked off in one task by a search that compares
each member with those not yet reached, so its output is a spanning tree, never all pairs. A group over `group_rows`
members is cut into blocks by a hash, and every pair of its blocks is compared by a task of its own: no link is lost, and no
task grows with the group. (The comparisons of such a group still grow with its square.)

Defined cases: null and blank texts have fingerprint zero and link like any other; a text of fewer words than a shingle is
one shingle; repeated shingles count repeatedly; an empty table gives no rows; extra columns are ignored; rows with equal
ids keep their own fingerprints and share the smallest id of their component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import stage
from .components import components
from .workers import map_batches, schema_of

BITS = 64
SEED = 42
GROUP_ROWS = 4096
BATCH_HASHES = 1 << 16


def hash_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set; bit 0 is the lowest. Worked off in pieces of fixed size."""
    total = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), BATCH_HASHES):
        rows = np.unpackbits(hashes[start : start + BATCH_HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += rows.sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, shingle: int, seed: int = SEED) -> int:
    """Fingerprint of one whole text."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z and the six ASCII blanks
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    width = min(shingle, len(words))
    begins, ends = (stops - sizes)[: len(words) - width + 1].tolist(), stops[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(begins, ends, strict=True)), np.uint64, len(begins))
    bits = hash_counts(hashes) * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = 4, seed: int = SEED) -> DataFrame:
    """`doc_id` and `fp`, the fingerprint as a signed 64-bit number."""
    return append_fingerprints(docs.select("doc_id", "text"), shingle, seed).select("doc_id", F.col("_fp").alias("fp"))


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The masks, as signed 64-bit numbers. Positions get the vectors 1, 2, ... in turn, so each mask keeps about half the bits."""
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(bits)]
    masks = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i, p in enumerate(vectors) if (p & v).bit_count() % 2)
        masks.append(mask - (1 << bits) if mask >> (bits - 1) else mask)
    return masks


def spanning_links(sides: list[np.ndarray], radius: int) -> list[tuple[int, int]]:
    """Links that connect whatever the exact links connect: among one set of fingerprints, or between two.

    Breadth first; each step compares one fingerprint with those not yet reached, so at most one link per member results.
    """
    rest, found = [side.view(np.uint64) for side in sides], []  # bits are counted on unsigned numbers
    while len(rest[0]):
        front, rest[0] = [(0, rest[0][0])], rest[0][1:]
        while front:
            side, one = front.pop()
            other = len(sides) - 1 - side
            if not len(rest[other]):
                continue
            near = np.bitwise_count(np.bitwise_xor(rest[other], one)) <= radius
            if near.any():
                reached = rest[other][near]
                rest[other] = rest[other][~near]
                start = int(one.view(np.int64))
                found.extend((start, x) for x in reached.view(np.int64).tolist())
                front.extend((other, x) for x in reached)
    return found


def _group_links(radius: int):
    """Walk sorted rows (table, masked, p, q, block, fp) and link within each group; a group may span batches."""

    def flush(fp: np.ndarray, block: np.ndarray) -> list[tuple[int, int]]:
        lower = block == block[0]
        fp = np.ascontiguousarray(fp)
        return spanning_links([fp] if lower.all() else [fp[lower], fp[~lower]], radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None  # rows of the group that is still open
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            held = rows if held is None else np.concatenate([held, rows])
            starts = np.flatnonzero(np.any(held[1:, :4] != held[:-1, :4], axis=1)) + 1
            bounds = [0, *starts.tolist()]
            links = [x for a, b in zip(bounds, bounds[1:], strict=False) for x in flush(held[a:b, 5], held[a:b, 4])]
            held = held[bounds[-1] :]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])
        if held is not None and len(held):
            links = flush(held[:, 5], held[:, 4])
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])

    return run


def near_links(nodes: DataFrame, radius: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) that connect exactly what all pairs of distinct fingerprints within the radius connect."""
    masks = F.array(*[F.lit(m).cast("bigint") for m in covering_masks(radius)])
    tables = nodes.select("fp", F.posexplode(masks).alias("table", "mask"))
    keyed = tables.select("table", F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "fp")
    groups = stage(
        keyed.groupBy("table", "masked")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1"),
        "groups",
    )
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = groups.filter(F.col("n") == 2).filter(apart <= radius).select("a", "b")

    blocks = F.ceil(F.col("n") / group_rows).cast("int")
    members = keyed.join(groups.filter("n > 2").select("table", "masked", "n"), ["table", "masked"])
    own = members.select(
        "table", "masked", "fp", blocks.alias("_blocks"), F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block")
    )
    paired = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = paired.select(
        "table", "masked", F.least("block", "_other").alias("p"), F.greatest("block", "_other").alias("q"), "block", "fp"
    ).repartition("table", "masked", "p", "q")
    found = map_batches(
        dealt.sortWithinPartitions("table", "masked", "p", "q", "block"), _group_links(radius), "a long, b long"
    )
    return pairs.unionByName(found)


def classes(prints: DataFrame, radius: int = 4) -> DataFrame:
    """One row per distinct fingerprint: `fp`, `first_id` (its smallest id) and `component_id`. Takes (doc_id, fp)."""
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = components(near_links(nodes, radius), "near")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "first_id", "component_id", "root")


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """Query of the operator: `doc_id`, `fingerprint`, `component_id` for every document."""
    prints = stage(with_fingerprints(docs, shingle), "fingerprints")
    found = classes(prints, radius).select("fp", "component_id")
    return prints.join(found, "fp").select("doc_id", fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The documents with one row per group of near-duplicates, the one with the smallest id (without an id, any one)."""
    names = docs.columns
    marked = stage(append_fingerprints(docs, shingle), "marked")
    found = classes(marked.select("doc_id", "_fp").toDF("doc_id", "fp"), radius)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "fp")).alias("_k"))
    kept = best.select(F.col("_k")["fp"].alias("_kfp"), F.col("_k")["first_id"].alias("_kid"))
    same = (F.col("_fp") == F.col("_kfp")) & F.col("doc_id").eqNullSafe(F.col("_kid"))
    return marked.join(kept, same, "left_semi").dropDuplicates(["_fp", "doc_id"]).select(names)


def append_fingerprints(docs: DataFrame, shingle: int = 4, seed: int = SEED) -> DataFrame:
    """All columns of the documents and `_fp`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            found = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, "_fp"]
            )

    kept = docs.drop("_fp")
    return map_batches(kept, run, f"{schema_of(kept)}, _fp long")
