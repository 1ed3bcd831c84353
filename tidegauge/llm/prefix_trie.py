"""Prefix trie of conversations by truncation peeling, from the deepest level to the root.

Each conversation is known by the digests of its prefixes. A level of the trie is made from two kinds of rows: conversations that
end there, and nodes of the level below with their last turn cut off. Rows of the same prefix are merged into the node; its
figures (members, children, leaves, saved words of the subtree) are sums over these rows, so the node, and all that is known of
its subtree, comes out of the one grouping that finds it. Then its last turn goes, and it meets its siblings one level up.

Levels with many rows are grouped by Spark with map-side sums, so a beginning that a third of all conversations share is no one
task's work, and equal conversations are one row before the first level. The few conversations that go on beyond
the depth where at most `DEEP_ROWS` are left are peeled by the same rule in groups that share the prefix of that depth, so the
number of jobs follows the usual length of a conversation, not the longest one.

Defined cases: turns are ordered by turn, a null turn first, equal turns by the digest of role and text; a null role or text is
empty; repeated rows are repeated turns; rows without a conv_id are left out; a conversation that is rebuilt to nothing is a member of
the root; an empty table gives no rows, not even a root; other columns are ignored. A conversation's digests are one value in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import lookup, stage, stage_counted
from .workers import map_batches, ship_package

FAMILY = 20
DEEP_ROWS = 1_000
ID_SLICE = 4_096

NODE = "key binary, parent binary, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary"


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, each as digest of role and text and number of words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.sha2(F.concat(F.sha2(role, 256), F.sha2(text, 256)), 256).alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))).alias("words"),
    )
    return told.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "words"))).alias("turns"))


def rebuilt(conversations: DataFrame, family: int = FAMILY) -> DataFrame:
    """Each conversation with the first crc32(id) % 4 turns of the first conversation of its family in place of its own."""
    c = F.col("conv_id")
    heads = conversations.filter(c % family == 0).select(c.alias("head_id"), F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(c.cast("string")) % 4).cast("int")
    own = conversations.withColumn("h", h).withColumn("head_id", c - c % family)
    joined = own.join(heads, "head_id", "left")  # at most `family` conversations per head
    own_rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h")), own_rest).alias("turns"))


def with_prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, path, words): path[d] is the digest of the first d turns; words[d] counts the words of turn d."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, words = [], []
            for turns in batch.column("turns").to_pylist():
                path = [b""]
                for turn in turns:
                    path.append(hashlib.sha256(path[-1] + bytes.fromhex(turn["digest"])).digest())
                paths.append(path)
                words.append([0, *(turn["words"] for turn in turns)])
            depth = [len(p) - 1 for p in paths]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(depth, pa.int32()), pa.array(paths, pa.list_(pa.binary())), pa.array(words, pa.list_(pa.int64()))],
                names=["conv_id", "depth", "path", "words"],
            )

    return map_batches(conversations, run, "conv_id long, depth int, path array<binary>, words array<bigint>")


def ended_groups(prefixes: DataFrame, id_slice: int = ID_SLICE) -> DataFrame:
    """Equal conversations as one row: path, words, smallest id, number, and the digest of their ids.

    Ids are joined into texts per range of ids first; the digest then runs over these texts in order, holding one at a time.
    """
    key = F.element_at("path", -1)
    group = F.floor(F.col("conv_id") / F.lit(id_slice)).alias("id_slice")
    texts = (
        prefixes.groupBy(key.alias("key"), group)
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
        .repartition("key")
        .sortWithinPartitions("key", "id_slice")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for batch in batches:
            keys, digests = [], []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != last:
                    if digest is not None:
                        keys.append(last)
                        digests.append(digest.digest())
                    last, digest = k, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.binary())], names=["key", "ends"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([digest.digest()], pa.binary())], names=["key", "ends"])

    digests = map_batches(texts, run, "key binary, ends binary")
    groups = prefixes.groupBy(key.alias("key")).agg(
        F.max("depth").alias("depth"), F.any_value("path").alias("path"), F.any_value("words").alias("words"),
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
    )
    return stage(groups.join(digests, "key").drop("key"), "ended")


def _rows_of(ended: DataFrame) -> DataFrame:
    """Conversations that end at a level, as rows to be merged into its nodes."""
    return ended.select(
        "path", "words", "conv_id", "n_convs", F.lit(0).cast("long").alias("child"), F.lit(0).cast("long").alias("leaves"),
        F.lit(0).cast("long").alias("below"), "ends",
    )


def _merged(rows: DataFrame, depth: int) -> DataFrame:
    """The nodes of a level from the rows that end or survive there, still with path and words."""
    merged = rows.groupBy(F.element_at("path", -1).alias("key")).agg(
        F.any_value("path").alias("path"), F.any_value("words").alias("words"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("child").alias("n_children"), F.sum("leaves").alias("leaves"),
        F.sum("below").alias("below"), F.max("ends").alias("ends"),
    )
    return merged.select(
        "key", "path", "words", F.lit(depth).alias("depth"), "conv_id", "n_convs", "n_children",
        F.greatest("leaves", F.lit(1)).alias("n_leaves"),
        (F.col("below") + (F.col("n_convs") - 1) * F.element_at("words", -1)).alias("saved_tokens"), "ends",
    )


def _cut_off(nodes: DataFrame) -> DataFrame:
    """Nodes without their last turn: rows of the level above."""
    shorter = lambda c: F.slice(c, 1, F.size(c) - 1).alias(c)
    return nodes.select(
        shorter("path"), shorter("words"), "conv_id", "n_convs", F.lit(1).cast("long").alias("child"), F.col("n_leaves").alias("leaves"),
        F.col("saved_tokens").alias("below"), F.lit(None).cast("binary").alias("ends"),
    )


def peel_deep(ended: DataFrame, top: int) -> DataFrame:
    """Nodes deeper than `top` of the conversations that end below it, peeled in groups of the same first `top` turns.

    Rows of nodes have a depth; the rows left at the end, one per child of a node at `top`, have path and words instead.
    """
    ship_package(ended.sparkSession)
    rows = ended.withColumn("anchor", F.element_at("path", top + 1))

    def run(table: pa.Table) -> pa.Table:
        got = table.select(["depth", "path", "words", "conv_id", "n_convs", "ends"]).to_pylist()
        by_depth: dict[int, list[dict]] = {}
        for row in got:
            by_depth.setdefault(row["depth"], []).append(row)
        alive, nodes = [], []  # a row: path and words of some member, and the node's figures so far
        for depth in range(max(by_depth), top, -1):
            merged: dict[bytes, list] = {}
            for row in by_depth.get(depth, []):
                merged[row["path"][depth]] = [row, row["conv_id"], row["n_convs"], 0, 0, 0, row["ends"]]
            for row, conv, n, leaves, below in alive:
                node = merged.setdefault(row["path"][depth], [row, conv, 0, 0, 0, 0, None])
                node[1] = min(node[1], conv)
                node[2:6] = node[2] + n, node[3] + 1, node[4] + leaves, node[5] + below
            alive = []
            for key, (row, conv, n, children, leaves, below, ends) in merged.items():
                leaves, below = max(leaves, 1), below + (n - 1) * row["words"][depth]
                nodes.append((key, row["path"][depth - 1], depth, conv, n, children, leaves, below, ends, None, None))
                alive.append((row, conv, n, leaves, below))
        for row, conv, n, leaves, below in alive:
            nodes.append((None, None, None, conv, n, 1, leaves, below, None, row["path"][: top + 1], row["words"][: top + 1]))
        return pa.table({name: pa.array([node[i] for node in nodes], kind) for i, (name, kind) in enumerate(PEELED)})

    return rows.groupBy("anchor").applyInArrow(run, f"{NODE}, path array<binary>, words array<bigint>")


PEELED = [
    ("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.binary()),
    ("path", pa.list_(pa.binary())), ("words", pa.list_(pa.int64())),
]


def trie_nodes(prefixes: DataFrame, *, deep_rows: int = DEEP_ROWS, id_slice: int = ID_SLICE) -> DataFrame:
    """All nodes with their own and their parent's digest; `ends` is null where no conversation ends."""
    ended = ended_groups(prefixes, id_slice)
    sizes = {r.depth: r.n for r in ended.groupBy("depth").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per length
    if not sizes:
        return prefixes.sparkSession.createDataFrame([], NODE)
    longest = max(sizes)
    beyond = np.cumsum([sizes.get(d, 0) for d in range(longest, 0, -1)])[::-1]  # conversations of at least 1, 2, ... turns
    top = int((beyond > deep_rows).sum())  # the depth beyond which few go
    levels, alive = [], None
    if top < longest:
        deep = stage(peel_deep(ended.filter(F.col("depth") > top), top), "deep")
        levels.append(deep.filter("depth IS NOT NULL").drop("path", "words"))
        alive = deep.filter("depth IS NULL").select(
            "path", "words", "conv_id", "n_convs", F.lit(1).cast("long").alias("child"), F.col("n_leaves").alias("leaves"),
            F.col("saved_tokens").alias("below"), F.lit(None).cast("binary").alias("ends"),
        )
    for depth in range(top, -1, -1):
        rows = _rows_of(ended.filter(F.col("depth") == depth))
        nodes = stage(_merged(rows.unionByName(alive) if alive is not None else rows, depth), "level")
        parent = F.when(F.size("path") > 1, F.element_at("path", F.greatest(F.size("path") - 1, F.lit(1))))
        levels.append(nodes.withColumn("parent", parent).select("key", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"))
        alive = _cut_off(nodes)
    return reduce(DataFrame.unionByName, levels)


def trie_report(turns: DataFrame, **limits) -> DataFrame:
    """Query of the operator: a row per node of the trie of the rebuilt conversations."""
    prefixes = stage(with_prefixes(rebuilt(conversations_of(turns))), "prefixes")
    nodes, rows = stage_counted(trie_nodes(prefixes, **limits), "nodes")
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = F.sha2(F.lit(""), 256)
    return lookup(nodes, parents, ["parent"], table_rows=rows).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce(F.lower(F.hex("ends")), none).alias("ends_sha256"),
    )


SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(sha256(role) || sha256(text))) AS i,
                  sha256(sha256(role) || sha256(text)) AS digest, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
           FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS head, xor(list_reduce(
             list_concat([4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
             lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))), 4294967295) % 4 AS h FROM t)  , -- crc32, a step per bit
r AS (SELECT c.conv_id, t.i, t.digest, t.words FROM c JOIN t ON t.conv_id = c.head AND t.i <= h
      UNION ALL SELECT c.conv_id, t.i, t.digest, t.words FROM c JOIN t USING (conv_id) WHERE t.i > h),
n AS (SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d FROM r),
p AS (SELECT conv_id, d, words, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM n
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(d) AS length FROM p GROUP BY conv_id),
node AS MATERIALIZED (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CASE WHEN length = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM p JOIN l USING (conv_id) GROUP BY path, d),
kids AS (SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
whole AS (SELECT a.path, a.depth, sum((b.n_convs - 1) * b.words)::BIGINT AS saved, count(*) FILTER (k.n IS NULL)::BIGINT AS leaves
          FROM node AS a JOIN node AS b ON b.depth >= a.depth AND left(b.path, 64 * a.depth) = a.path LEFT JOIN kids AS k ON k.path = b.path
          GROUP BY ALL)
SELECT node.conv_id, node.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       whole.leaves AS n_leaves, whole.saved AS saved_tokens, node.ends_sha256
FROM node JOIN whole USING (path) LEFT JOIN kids ON kids.path = node.path
LEFT JOIN node AS up ON node.depth > 0 AND up.depth = node.depth - 1 AND up.path = left(node.path, 64 * up.depth)
"""
