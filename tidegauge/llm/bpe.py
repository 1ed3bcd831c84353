"""BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can never end up inside one token, so every such pair in a text marks a
certain cut. A text is split as the vocabulary's pre-tokenizer does, each piece is cut at its certain boundaries, and the
fragments are encoded independently: their ids, one after the other, are the ids of the whole text. Fragments are short and
repeat, so each distinct one is merged once per worker and kept in a memory of bounded size. Documents are independent;
nothing is shuffled, and a lost task reads its documents again.

Special tokens of the file that occur in a text become their ids, as the file's own library has it. Decoding maps ids to
bytes and reads them as UTF-8, broken sequences replaced.

Defined cases: a null text is empty, and an empty text has no ids; repeated rows are encoded as any other; an empty table
gives no rows; extra columns are ignored by the query and kept by `encode`.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .workers import map_batches, schema_of

# The split pattern of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pieces and fragments remembered per worker: at most twice this number each.
REMEMBERED = 300_000
LONG = 64
NO_MERGE = 1 << 62


class Memory:
    """A map of bounded size in two generations: what was used since the last change of generations stays."""

    def __init__(self, size: int = REMEMBERED) -> None:
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def byte_letters() -> dict[str, int]:
    """The letters that byte-level files write for bytes: printable ones for themselves, the rest from 256 on, in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Coder:
    """One vocabulary: its merges, the byte pairs that never stand inside a token, and the fragments met so far."""

    def __init__(self, spec: dict) -> None:
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = {token: i for token, i in vocab.items() if token not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        # by both ids in one number: rank and new id in one number
        self.rank = {plain[a] << 20 | plain[b]: i << 20 | plain[a + b] for i, (a, b) in enumerate(pairs)}
        self.single = [plain.get(letter) for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.bytes_of = {i: raw(token) for token, i in plain.items()} | {i: t.encode() for t, i in special.items()}
        self.joined = frozenset(pair for token in map(raw, plain) for pair in zip(token, token[1:], strict=False))
        self.special = special
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.pieces = regex.compile(PATTERN).findall
        self.digits = {i: str(i) for i in self.bytes_of}
        self.known, self.fragments = Memory(), Memory()

    def merge(self, fragment: bytes) -> tuple[int, ...]:
        """Merge a fragment: lowest rank first, then leftmost."""
        ids = [self.single[b] for b in fragment]
        if len(ids) > LONG:
            return self._merge_long(ids)
        find = self.rank.get
        open_ranks = [find(a << 20 | b, NO_MERGE) for a, b in zip(ids, ids[1:], strict=False)]
        while open_ranks:
            best = min(open_ranks)
            if best == NO_MERGE:
                break
            i = open_ranks.index(best)
            ids[i : i + 2] = [best & 0xFFFFF]
            del open_ranks[i]
            if i:
                open_ranks[i - 1] = find(ids[i - 1] << 20 | ids[i], NO_MERGE)
            if i < len(open_ranks):
                open_ranks[i] = find(ids[i] << 20 | ids[i + 1], NO_MERGE)
        return tuple(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        """The same with a heap over a linked list, for fragments without a bound."""
        n, find = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = enumerate(zip(ids, ids[1:], strict=False))
        heap = [(rank, i, a, b) for i, (a, b) in pairs if (rank := find(a << 20 | b, NO_MERGE)) != NO_MERGE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank & 0xFFFFF, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    a, b = ids[left], ids[after[left]]
                    if (rank := find(a << 20 | b, NO_MERGE)) != NO_MERGE:
                        heapq.heappush(heap, (rank, left, a, b))
        return tuple(i for i in ids if i >= 0)

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Cut a piece of the split pattern at its certain boundaries and join the fragments' ids."""
        data, joined = piece.encode("utf-8", "surrogatepass"), self.joined
        cuts = [k for k, pair in enumerate(zip(data, data[1:], strict=False), 1) if pair not in joined]
        if not cuts:
            return self.merge(data)
        ids: list[int] = []
        for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True):
            fragment = data[a:b]
            found = self.fragments.get(fragment)
            if found is None:
                found = self.merge(fragment)
                if len(fragment) <= LONG:
                    self.fragments.put(fragment, found)
            ids.extend(found)
        return tuple(ids)

    def _extend(self, ids: list[int], text: str) -> None:
        young, known, extend = self.known.young.get, self.known, ids.extend
        for piece in self.pieces(text):
            found = young(piece)
            if found is None:
                found = known.get(piece)
                if found is None:
                    found = self.encode_piece(piece)
                    if len(piece) <= LONG:
                        known.put(piece, found)
                young = known.young.get
            extend(found)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        ids: list[int] = []
        if not any(t in text for t in self.special):
            self._extend(ids, text)
            return ids
        for part in self.split_special.split(text):
            if part in self.special:
                ids.append(self.special[part])
            else:
                self._extend(ids, part)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of a list of ids; unknown ids are left out."""
        known = self.bytes_of
        try:
            data = b"".join([known[i] for i in ids])
        except KeyError:
            data = b"".join([known.get(i, b"") for i in ids])
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _coder(spec: str) -> Coder:
    return Coder(json.loads(spec))


def per_document(docs: DataFrame, vocabulary: str, out: Callable[[Coder, str], tuple], fields: list[pa.Field], types: str):
    """Add columns computed from each whole text with the coder of a vocabulary file; other columns pass through.

    The file is read once on the driver and sent along (a few MB, fixed by the vocabulary), as tasks may not see its path.
    """
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    names = {f.name for f in fields}
    rest = docs.drop(*[c for c in docs.columns if c in names and c != "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(spec.value)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            made = [out(coder, text.as_py() or "") for text in batch.column(at)]
            columns = list(zip(*made, strict=True)) if made else [()] * len(fields)
            values = dict(zip(batch.schema.names, batch.columns, strict=True))
            values |= {f.name: pa.array(c, f.type) for f, c in zip(fields, columns, strict=True)}
            yield pa.RecordBatch.from_arrays(list(values.values()), names=list(values))

    return map_batches(rest, run, f"{schema_of(rest)}, {types}")


def encode(docs: DataFrame, vocabulary: str, into: str = "ids") -> DataFrame:
    """The documents with the ids of their texts in column `into`."""
    return per_document(
        docs, vocabulary, lambda coder, text: (coder.encode(text),), [pa.field(into, pa.list_(pa.int32()))], f"`{into}` array<int>"
    )


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """The rows with the texts of their ids in column `into`."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = rows.sparkSession.sparkContext.broadcast(file.read())
    rest = rows.drop(into) if into != ids else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(spec.value)
        for batch in batches:
            texts = [coder.decode(x.as_py() or []) for x in batch.column(batch.schema.get_field_index(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return map_batches(rest, run, f"{schema_of(rest)}, `{into}` string")


def _digests(coder: Coder, text: str) -> tuple[int, str, str]:
    ids = coder.encode(text)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return len(ids), sha(",".join([coder.digits[i] for i in ids]).encode()), sha(coder.decode(ids).encode())


DIGESTS = [
    pa.field("n_tokens", pa.int64()),
    pa.field("ids_sha256", pa.string()),
    pa.field("decoded_sha256", pa.string()),
]
DIGEST_TYPES = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def with_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The documents with the number of ids and digests of ids and decoded text."""
    return per_document(docs, vocabulary, _digests, DIGESTS, DIGEST_TYPES)


def encode_report(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Query of the operator."""
    return with_digests(docs.select("doc_id", "text"), vocabulary).drop("text")
