"""Blocks of whole texts, packed numbers, and the slices of a hash space that blocks and merging tasks exchange.

A block is one row: some megabytes of whole texts with their ids. What a block has to say about hashed items goes out as one
row per block and slice of the hash space, as sorted cells in packed form, and the answer comes back in the order of what was
sent, so a block finds it again by doing the same work on the same texts. Rows of one slice come from all blocks, and a block
sends an item once however often it has it, so no item is a hot key. A slice covers a range of cells; the number of slices
follows the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import stage
from .workers import map_batches, ship_package

BLOCK_SCHEMA = "block long, ids array<long>, tags array<string>, sizes binary, text binary"
U64 = np.uint64


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over the whole range; one to one."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


#: A random 64-bit number per byte value.
BYTE_NUMBERS = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def hashed_strings(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty byte string data[offsets[i]:offsets[i+1]]."""
    if len(offsets) < 2:
        return np.zeros(0, U64)
    sizes = np.diff(offsets)
    place = np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], sizes)
    powers = np.multiply.accumulate(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, U64))
    return mixed(np.add.reduceat(BYTE_NUMBERS[data] * powers[place], offsets[:-1] - offsets[0]))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers that are at least zero, as compressed planes of bytes of equal weight."""
    top = int(values.max()) if len(values) else 0
    kind = next(k for k in ("u1", "u2", "u4", "u8") if top < 1 << 8 * int(k[1]))
    planes = np.ascontiguousarray(values.astype(f"<{kind}").view(np.uint8).reshape(-1, int(kind[1])).T)
    return kind[1].encode() + len(values).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    """What `pack` packed, as unsigned numbers."""
    width, n = int(data[:1]), int.from_bytes(data[1:9], "little")
    planes = pa.Codec("zstd").decompress(data[9:], width * n, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(f"<u{width}").ravel()


def pack_ascending(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values[:1] * 0))


def unpack_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).astype(U64), dtype=U64)


def text_blocks(docs: DataFrame, tag: str | None, block_bytes: int) -> DataFrame:
    """Whole texts (null: empty) with doc_id and a tag column as block rows of about `block_bytes`, written once.

    A text longer than that is a block of its own.
    """
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        (F.col(tag).cast("string") if tag else F.lit(None).cast("string")).alias("tag"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, filled = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            ends = filled + np.cumsum(sizes, dtype=np.int64)
            begin = 0
            while len(ends) - begin:
                stop = begin + int(np.searchsorted(ends[begin:], block_bytes, "right"))
                if stop == begin and not held:
                    stop = begin + 1
                held.append(batch.slice(begin, stop - begin))
                if stop == batch.num_rows:
                    filled = int(ends[-1])
                    break
                yield _block_row(number, held)
                number, held, begin, ends = number + 1, [], stop, ends - (ends[stop - 1] if stop else filled)
                filled = 0
        if held:
            yield _block_row(number, held)

    return stage(map_batches(chosen, run, BLOCK_SCHEMA), "blocks")


def _block_row(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts).combine_chunks()
    texts = rows["text"].cast(pa.large_string()).combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])) if len(texts) and texts.buffers()[2] else b""
    blob = pa.Codec("zstd", 1).compress(data, asbytes=True) if len(data) else b""
    one = lambda column, kind: pa.array([column.to_pylist()], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number]), one(rows["id"], pa.int64()), one(rows["tag"], pa.string()),
            pa.array([pack(np.diff(offsets))]), pa.array([blob], pa.binary()),
        ],
        names=["block", "ids", "tags", "sizes", "text"],
    )


class Texts:
    """The texts of one block: all bytes in one array, and the end of each text."""

    def __init__(self, ids: list, tags: list, sizes: bytes, text: bytes) -> None:
        self.ids, self.tags = ids, tags
        self.sizes = unpack(sizes).astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        whole = int(self.sizes.sum())
        self.data = np.frombuffer(pa.Codec("zstd").decompress(text, whole, asbytes=True) if whole else b"", np.uint8)


def each_block(blocks: DataFrame, run: Callable[[int, Texts], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What `run` yields for every block."""

    def batches(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in got:
            for i in range(batch.num_rows):
                number, *rest = (batch.column(k)[i].as_py() for k in range(5))
                yield from run(number, Texts(*rest))

    return map_batches(blocks, batches, schema)


def each_answered_block(blocks: DataFrame, answers: DataFrame, run: Callable[[int, Texts, pa.Table], pa.Table], schema: str) -> DataFrame:
    """What `run` returns for every block with the rows of `answers` (block, ...) that are for it."""
    ship_package(blocks.sparkSession)

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        number, *rest = (left.column(k)[0].as_py() for k in range(5))
        return run(number, Texts(*rest), right)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(both, schema)


def each_slice(sent: DataFrame, run: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """What `run` returns for all rows that blocks have sent to a slice."""
    ship_package(sent.sparkSession)
    return sent.groupBy("slice").applyInArrow(run, schema)


def slice_bits(items: float, per_slice: int) -> int:
    """Bits of the slice number, for slices of about `per_slice` items."""
    return max(0, int(np.ceil(np.log2(max(items, 1) / per_slice))))


def cell_bits(items: float) -> int:
    """Bits of a cell so that an item shares its cell with another one in about one of a thousand cases, whatever their number."""
    return int(min(64, np.ceil(np.log2(max(items, 2))) + 10))


def sliced(cells: np.ndarray, bits: int, slices: int) -> Iterator[tuple[int, slice]]:
    """The slices that sorted cells of `bits` bits fall into, each with its stretch of the array; 2**slices slices."""
    if not len(cells):
        return
    number = (cells >> U64(bits - slices)).astype(np.int64) if slices else np.zeros(len(cells), np.int64)
    cuts = np.flatnonzero(np.diff(number)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)], strict=True):
        yield int(number[a]), slice(a, b)
