"""Repeated passages: bytes covered by a string of `width` bytes that also starts in a document with a smaller id.

Suffixes are compared up to `width` bytes, by blockwise sorting with a difference cover. A difference cover is a sample of text
positions such that any two suffixes that are to be compared reach a sampled position after the same number of bytes, so that a tie is
resolved by the ranks of the two sampled suffixes. Residues of the position form such a sample, at a fifth of all positions. Here the
sample is chosen by what the text says: in every window of `width` bytes the first one of the k-byte grams with the smallest hash. Equal
windows choose the same place whatever their position is, so the property holds for the pairs that matter, at a twelfth of all positions.

1. Each block of texts sends the hashes of its sampled grams to slices of the hash space, which answer which of them occur in
   several documents. A window whose gram is nowhere else is nowhere else itself.
2. The sampled suffixes that are left go, with the bytes around them, to buckets by the hash of their first k bytes. A bucket is
   sorted on its own, in memory bounded by its slice: first the sampled suffixes, which gives each one a rank at every length;
   then, for each distance to the sample, the suffixes that begin that many bytes before it, by their few leading bytes and the rank. The
   suffixes of one rank are equal in all `width` bytes, and the smallest id among them is their owner.
3. The answer, a bit per suffix, goes back to the block, which cuts out what is covered.

A block sends equal stretches once, with the smallest id it has for them, so whole copies cost nothing more. A gram found in more than
`HOT` documents would be a hot bucket: its suffixes are dealt one by one by a hash of their `width` bytes instead, once per block.
Comparisons are of bytes; hashes only choose where they meet.

Defined cases: a null text is empty; a null id counts as larger than all others; rows with the same id, and rows without one, don't
remove each other's strings; each row is returned once; an empty table gives no rows; other columns are ignored. A document is
one value in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import stage
from . import blocks as B
from .blocks import U64

WIDTH = 50
BLOCK_BYTES = 4 << 20
SLICE_GRAMS = 1_000_000
SLICE_RECORDS = 100_000
HOT = 4_096
_CHUNK = 1 << 18
_NO_ID = U64((1 << 64) - 1)
_STEPS = B.mixed(np.arange(101, 117, dtype=U64)) | U64(1)


def gram_size(width: int) -> int:
    """Bytes of a sampled gram: a window has at most 32 grams."""
    if width < 16:
        raise ValueError("windows have 16 bytes at least")
    return max(width // 2 + 1, width - 31)


def _gram_hashes(words: np.ndarray, k: int, at) -> np.ndarray:
    """Hash of the k bytes at each place; `words` has the eight bytes from every place on."""
    offsets = [*range(0, k - 7, 8), *([k - 8] if k % 8 else [])]
    h = words[at(0)] * _STEPS[0]
    for i, offset in enumerate(offsets[1:], 1):
        h = (h ^ (h >> U64(29))) * _STEPS[i] + words[at(offset)]
    return B.mixed(h)


@dataclass
class Cover:
    """Sampled places of a block; place p is chosen by the windows that begin at p - most ... p - least."""

    place: np.ndarray
    least: np.ndarray
    most: np.ndarray
    gram: np.ndarray


def cover(texts: B.Texts, width: int) -> Cover:
    data, k = texts.data, gram_size(width)
    span, n = width - k + 1, len(data) - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Cover(none, none, none, none.astype(U64))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    chosen = np.empty(n, np.int32)
    for a in range(0, n, _CHUNK):
        b = min(a + _CHUNK, n)
        h = _gram_hashes(words, k, lambda offset: slice(a + offset, b + span - 1 + offset))  # noqa: B023
        low = (h & ~U64(0xFFFFFF)) | np.arange(len(h), dtype=U64)
        size = 1
        while size * 2 <= span:
            low, size = np.minimum(low[:-size], low[size:]), size * 2
        if size < span:
            low = np.minimum(low[: b - a], low[span - size : span - size + b - a])
        chosen[a:b] = (low[: b - a] & U64(0xFFFFFF)).astype(np.int32) + np.int32(a)
    for begin, end in zip(texts.begins.tolist(), texts.ends.tolist(), strict=True):
        chosen[max(begin, end - width + 1) : end] = -1  # windows don't cross texts
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:], [n]]) - 1
    real = chosen[first] >= 0
    place = chosen[first[real]].astype(np.int64)
    return Cover(place, place - last[real], place - first[real], _gram_hashes(words, k, lambda offset: place + offset))


def _ids(texts: B.Texts) -> np.ndarray:
    """Ids as unsigned numbers in the same order, those without one last."""
    return np.array([_NO_ID if i is None else U64(i + (1 << 63)) for i in texts.ids], U64)


def shared_grams(blocks: DataFrame, grams: float, width: int, slice_grams: int, hot: int) -> DataFrame:
    """(block, slice, codes, records): for each block and slice, of each of the block's grams: 0 in one document only, 1 in
    several, 2 in more than `hot`; and how many stretches that is."""
    bits, slices = B.cell_bits(grams), B.slice_bits(grams, slice_grams)

    def send(number: int, texts: B.Texts) -> Iterator[pa.RecordBatch]:
        found = cover(texts, width)
        cells = found.gram >> U64(64 - bits)
        order = np.argsort(cells, kind="stable")
        cells, owner = cells[order], np.searchsorted(texts.ends, found.place[order], "right")
        head = np.concatenate([[True], cells[1:] != cells[:-1]])[: len(cells)]
        fresh = head | np.concatenate([[True], owner[1:] != owner[:-1]])[: len(cells)]
        first = np.flatnonzero(head)
        docs = np.add.reduceat(fresh.astype(np.int64), first) if len(first) else first
        rows = [{"block": number, "slice": s, "cells": B.pack_ascending(cells[first][at]), "docs": B.pack(docs[at])} for s, at in B.sliced(cells[first], bits, slices)]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("block", pa.int64()), ("slice", pa.int64()), ("cells", pa.binary()), ("docs", pa.binary())]))

    def merge(rows: pa.Table) -> pa.Table:
        cells = [B.unpack_ascending(c.as_py()) for c in rows["cells"]]
        docs = [B.unpack(d.as_py()).astype(np.int64) for d in rows["docs"]]
        _, place, = np.unique(np.concatenate(cells), return_inverse=True)
        total = np.bincount(place, np.concatenate(docs))[place]
        codes = np.where(total < 2, 0, np.where(total > hot, 2, 1))
        cuts = np.cumsum([len(c) for c in cells])[:-1]
        parts = np.split(codes, cuts)
        weight = [int((d * (c == 1)).sum() + width // 2 * (d * (c == 2)).sum()) for d, c in zip(docs, parts, strict=True)]
        return pa.table({
            "block": rows["block"], "slice": rows["slice"], "codes": pa.array([B.pack(c) for c in parts], pa.binary()), "records": pa.array(weight, pa.int64()),
        })

    sent = B.each_block(blocks, send, "block long, slice long, cells binary, docs binary")
    return stage(B.each_slice(sent, merge, "block long, slice long, codes binary, records long"), "grams")


@dataclass
class Stretches:
    """Distinct stretches of bytes around sampled places of a block, in the order of the slices they go to."""

    place: np.ndarray
    least: np.ndarray
    most: np.ndarray
    of: np.ndarray  # which distinct stretch each sampled place has
    owner: np.ndarray  # id of the document of each sampled place
    smallest: np.ndarray  # of each distinct stretch, the smallest id in the block
    head: np.ndarray  # of each distinct stretch, a sampled place that has it
    slices: list[tuple[int, slice]]


def stretches(texts: B.Texts, answer: dict[int, bytes], width: int, bits: int, slices: int, dealt: int) -> Stretches:
    """What of a block's sample may be elsewhere, by the answers to its grams; dealt to 2**dealt buckets."""
    found = cover(texts, width)
    cells, inverse = np.unique(found.gram >> U64(64 - bits), return_inverse=True)
    codes = np.zeros(len(cells), np.int64)
    for s, at in B.sliced(cells, bits, slices):
        codes[at] = B.unpack(answer[s])
    code = codes[inverse]
    one, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
    times = found.most[hot] - found.least[hot] + 1
    each = np.repeat(hot, times)
    distance = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times) + found.least[each]
    place = np.concatenate([found.place[one], found.place[each]])
    least, most = np.concatenate([found.least[one], distance]), np.concatenate([found.most[one], distance])
    begin, size = place - most, width + most - least
    data = _gathered(texts.data, begin, size)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    of = coded.indices.to_numpy().astype(np.int64)
    n = len(coded.dictionary)
    owner = _ids(texts)[np.searchsorted(texts.ends, place, "right")]
    smallest, head = np.full(n, _NO_ID), np.zeros(n, np.int64)
    np.minimum.at(smallest, of, owner)
    head[of[::-1]] = np.arange(len(of))[::-1]
    # a hot gram's suffixes are dealt by all their bytes
    key = np.concatenate([found.gram[one], np.zeros(len(each), U64)])
    if len(each):
        key[len(one) :] = B.hashed_strings(data[offsets[len(one)] :], offsets[len(one) :] - offsets[len(one)])
    to = (key[head] >> U64(64 - dealt)).astype(np.int64) if dealt else np.zeros(n, np.int64)
    order = np.argsort(to, kind="stable")
    new = np.empty(n, np.int64)
    new[order] = np.arange(n)
    to = to[order]
    cuts = [0, *(np.flatnonzero(np.diff(to)) + 1).tolist(), n] if n else [0]
    parts = [(int(to[a]), slice(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return Stretches(place, least, most, new[of], owner, smallest[order], head[order], parts)


def _gathered(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after the other."""
    whole, some, at = np.empty(int(size.sum()), np.uint8), 1 << 15, 0
    for i in range(0, len(size), some):
        b, n = begin[i : i + some], size[i : i + some]
        ends = np.cumsum(n)
        whole[at : at + ends[-1]] = data[np.arange(ends[-1]) + np.repeat(b - ends + n, n)]
        at += int(ends[-1])
    return whole


def _ranks(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix, and how many leading bytes each sorted row shares with the one before."""
    n, width = matrix.shape
    words = np.zeros((n, -(-width // 8) * 8), np.uint8)
    words[:, :width] = matrix
    words = words.view(">u8").astype(U64)
    order = np.lexsort(words.T[::-1])
    differ = matrix[order[1:]] != matrix[order[:-1]]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.concatenate([[0], shared]) if n else np.zeros(0, np.int64)


def owners(ids: np.ndarray, least: np.ndarray, most: np.ndarray, data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """For each stretch, a bit per distance: the window that begins so far before the sampled place is also in a smaller document."""
    n, span = len(ids), width - gram_size(width) + 1
    by_id = np.argsort(ids, kind="stable")
    ids, least, most, begin = ids[by_id], least[by_id], most[by_id], offsets[:-1][by_id]
    place, size = begin + most, offsets[1:][by_id] - begin
    right, left = np.zeros((n, width), np.uint8), np.zeros((n, span - 1), np.uint8)
    for i in range(width):
        there = np.flatnonzero(size - most > i)
        right[there, i] = data[place[there] + i]
    for i in range(span - 1):
        there = np.flatnonzero(most > i)
        left[there, i] = data[place[there] - 1 - i]
    (r_order, r_shared), (l_order, l_shared) = _ranks(right), _ranks(left)
    masks, r_rank, l_rank = np.zeros(n, np.uint32), np.empty(n, np.int64), np.empty(n, np.int64)
    for distance in range(span):
        there = np.flatnonzero((least <= distance) & (distance <= most))
        if len(there) < 2:
            continue
        r_rank[r_order] = np.cumsum(r_shared < width - distance)
        l_rank[l_order] = np.cumsum(l_shared < distance)
        key = l_rank[there] * (n + 1) + r_rank[there]
        order = np.argsort(key, kind="stable")  # ids ascend within equal suffixes
        key = key[order]
        head = np.concatenate([[True], key[1:] != key[:-1]])
        owner = ids[there[order[np.flatnonzero(head)]]][np.cumsum(head) - 1]
        taken = there[order[ids[there[order]] > owner]]
        masks[taken] |= np.uint32(1 << distance)
    out = np.empty(n, np.uint32)
    out[by_id] = masks
    return out


def repeats(
    docs: DataFrame, *, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, slice_grams: int = SLICE_GRAMS,
    slice_records: int = SLICE_RECORDS, hot: int = HOT,
) -> DataFrame:
    """Per document: doc_id, n_bytes, `spans` (begin, end) of the removed runs of bytes, and `kept`, the bytes that are left."""
    blocks = B.text_blocks(docs, None, block_bytes)
    whole = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    grams = 2 * whole / (width - gram_size(width) + 2)
    bits, slices = B.cell_bits(grams), B.slice_bits(grams, slice_grams)
    answers = shared_grams(blocks, grams, width, slice_grams, hot)
    dealt = B.slice_bits(answers.agg(F.sum("records")).first()[0] or 0, slice_records)
    codes_of = lambda rows: dict(zip(rows["slice"].to_pylist(), rows["codes"].to_pylist(), strict=True))

    def send(number: int, texts: B.Texts, answer: pa.Table) -> pa.Table:
        s = stretches(texts, codes_of(answer), width, bits, slices, dealt)
        least, most, begin = s.least[s.head], s.most[s.head], s.place[s.head] - s.most[s.head]
        rows = []
        for bucket, at in s.slices:
            data = _gathered(texts.data, begin[at], width + most[at] - least[at]).tobytes()
            rows.append({
                "block": number, "bucket": bucket, "ids": B.pack(s.smallest[at]), "least": B.pack(least[at]), "most": B.pack(most[at]),
                "size": len(data), "data": pa.Codec("zstd", 1).compress(data, asbytes=True),
            })
        return pa.Table.from_pylist(rows, schema=RECORDS)

    def sort(rows: pa.Table) -> pa.Table:
        whole = [np.concatenate([B.unpack(x.as_py()) for x in rows[c]]) for c in ("ids", "least", "most")]
        least, most = whole[1].astype(np.int64), whole[2].astype(np.int64)
        data = b"".join(pa.Codec("zstd").decompress(d.as_py(), n.as_py(), asbytes=True) for d, n in zip(rows["data"], rows["size"], strict=True))
        offsets = np.concatenate([[0], np.cumsum(width + most - least)])
        masks = owners(whole[0].astype(U64), least, most, np.frombuffer(data, np.uint8), offsets, width)
        cuts = np.cumsum([len(B.unpack(x.as_py())) for x in rows["least"]])[:-1]
        return pa.table({"block": rows["block"], "bucket": rows["bucket"], "masks": pa.array([B.pack(m) for m in np.split(masks, cuts)], pa.binary())})

    def cut(number: int, texts: B.Texts, answer: pa.Table) -> pa.Table:
        grams, marks = answer.filter(pc.is_valid(answer["slice"])), answer.filter(pc.is_valid(answer["bucket"]))
        s = stretches(texts, codes_of(grams), width, bits, slices, dealt)
        masks_of = dict(zip(marks["bucket"].to_pylist(), marks["masks"].to_pylist(), strict=True))
        mask = np.zeros(len(s.smallest), np.uint32)
        for bucket, at in s.slices:
            mask[at] = B.unpack(masks_of[bucket])
        everywhere = np.uint32(0xFFFFFFFF)  # the block has the stretch in a smaller document
        mask = np.where(s.owner > s.smallest[s.of], everywhere, mask[s.of]) if len(s.of) else np.zeros(0, np.uint32)
        starts = np.zeros(len(texts.data) + 1, bool)
        for distance in range(width - gram_size(width) + 1):
            there = (s.least <= distance) & (distance <= s.most) & ((mask >> np.uint32(distance)) & 1).astype(bool)
            starts[s.place[there] - distance] = True
        return _cut_texts(texts, starts, width)

    sent = B.each_answered_block(blocks, answers, send, "block long, bucket long, ids binary, least binary, most binary, size long, data binary")
    ship = sent.groupBy("bucket").applyInArrow(sort, "block long, bucket long, masks binary")
    back = answers.select("block", "slice", "codes").unionByName(ship, allowMissingColumns=True)
    return B.each_answered_block(blocks, back, cut, "doc_id long, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary")


RECORDS = pa.schema([
    ("block", pa.int64()), ("bucket", pa.int64()), ("ids", pa.binary()), ("least", pa.binary()), ("most", pa.binary()), ("size", pa.int64()),
    ("data", pa.binary()),
])
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _cut_texts(texts: B.Texts, starts: np.ndarray, width: int) -> pa.Table:
    """Spans and the bytes left, from the places where removed windows start."""
    n = len(texts.data)
    upto = np.cumsum(starts[:n], dtype=np.int32)
    upto[width:] -= upto[:-width].copy() if n > width else upto[:0]
    covered = upto > 0
    edge = np.zeros(n + 1, bool)
    edge[1:n] = covered[1:] != covered[:-1]
    if n:
        edge[0], edge[n] = covered[0], covered[n - 1]
        full = texts.begins[texts.sizes > 0]
        inner = full[full > 0]
        edge[inner] |= covered[inner]  # a run ends with its text; the next one may begin at once
    on = np.flatnonzero(edge[:n] & covered)
    off = np.minimum.reduce([_next(np.flatnonzero(edge), on, n), texts.ends[np.searchsorted(texts.ends, on, "right")]]) if len(on) else on
    text = np.searchsorted(texts.ends, on, "right")
    offsets = np.searchsorted(text, np.arange(len(texts.sizes) + 1))
    spans = pa.StructArray.from_arrays([pa.array(on - texts.begins[text]), pa.array(off - texts.begins[text])], ["begin", "end"])
    left = np.concatenate([[0], np.cumsum(~covered)])
    kept_at = left[np.concatenate([texts.begins, [n]])].astype(np.int32)
    kept = pa.Array.from_buffers(pa.binary(), len(texts.sizes), [None, pa.py_buffer(kept_at), pa.py_buffer(np.ascontiguousarray(texts.data[~covered]))])
    return pa.table({
        "doc_id": pa.array(texts.ids, pa.int64()), "n_bytes": pa.array(texts.sizes),
        "spans": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans).cast(_SPANS), "kept": kept,
    })


def _next(edges: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The first edge behind each place."""
    return np.concatenate([edges, [n]])[np.searchsorted(edges, at, "right")]


def repeats_report(docs: DataFrame, **limits) -> DataFrame:
    """Query of the operator."""
    spans = F.transform("spans", lambda s: s["end"] - s["begin"])
    return repeats(docs, **limits).select(
        "doc_id", "n_bytes", F.aggregate(spans, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
