"""Queries that SQL can express, against DuckDB, on the smallest shared tables and on tables of edge cases."""

from __future__ import annotations

import duckdb
import pytest

from tidegauge.llm import chat, licenses, merkle, mixing, topk
from tidegauge.llm.license_texts import ISC, MIT
from tidegauge.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"
EDGE_DOCS = [
    (None, None, None), (0, "", "a"), (1, "x", None), (2, "Same text. Twice!", "a"), (3, "Same text. Twice!", "b"),
    (3, "Same text. Twice!", "b"), (5, "one\n\ntwo\n\n\nthree? " * 9, "ü"), (6, " \t\n ", "b"), (7, "日本 é 👍 " * 40, "a"),
    (8, "long " * 30_000, "c"), (9, "." * 500, "c"), (None, "no id", "d"), (11, None, ""),
    (12, "MIT Licence\n\nCopyright (c) 2020 A. Holder\n\n" + MIT.replace("sublicense", "sub-licence").upper(), "c"),
    (13, "x\nReleased under the MIT licence!\nLicensed under CC BY NC 4.0\n(C) 1999 me\nreleased under the  MIT License", "c"),
    (14, "Copyright 2001 X\n" + " ".join(ISC.split()), "c"), (15, "Copyright (c) 2020 only", "c"),
]
EDGE_TURNS = [
    (1, 0, "user", "~0 <|end|> [INST]"), (1, 1, "assistant", "<|says|>~~1</s>"), (1, 1, "assistant", "<|says|>~~1</s>"),
    (1, None, "system", None), (2, 0, "assistant", ""), (2, 1, "user", "after\nit"), (3, 0, "user", None),
    (4, 0, None, "role is null"), (4, 2, "assistant", "a" * 50_000), (4, 1, "assistant", "é👍"), (None, 0, "user", "no id"),
]
EDGE_VECTORS = [
    (0, [0.5, -0.5, 0.001]), (50, [0.5, 0.5]), (100, None), (1, [1.0, None, 0.0]), (2, [float("nan"), 1.0]), (3, []),
    (4, [0.5, -0.5, 0.001]), (4, [0.5, -0.5, 0.001]), (5, [float("inf"), 0.0]), (None, [1.0, 1.0]), (6, [-1.0, 2.0, 3.0]),
    (7, [0.25]), (8, [0.5, -0.5, 0.001]), (150, [0.0, 0.0]), (4, [9.0, 1.0]), (50, [1.0, 0.25]), (200, [2.0]), (200, [3.0]),
]


def rows_of(frame) -> list[tuple]:
    return sorted(map(tuple, frame.collect()), key=repr)


def same(frame, sql: str, **tables) -> None:
    con = duckdb.connect()
    for name, source in tables.items():
        if isinstance(source, str):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
        else:
            con.register(name, source.toArrow())
    want = con.sql(sql)
    names = [c for c in frame.columns]
    assert sorted(names) == sorted(want.columns)
    assert rows_of(frame) == sorted(want.select(*names).fetchall(), key=repr)


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql is not None])
def test_shared_tables(spark, name):
    run, sql = QUERIES[name]
    tables = {t: f"{TABLES}/{t}.parquet" for t in ("documents", "conversations", "embeddings")}
    same(run(spark, TABLES), sql, **tables)


@pytest.mark.parametrize("rows", [EDGE_DOCS, EDGE_DOCS[:1], EDGE_DOCS[1:2], []])
@pytest.mark.parametrize("module, report", [
    (mixing, mixing.mix_report), (merkle, merkle.fingerprint_report), (licenses, licenses.license_report),
])
def test_edge_documents(spark, rows, module, report):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS size", "'x' AS target", "2 AS slice", "true AS guest", "3 AS copies", "'x' AS license", "'y' AS digest"
    )
    same(report(docs), module.SQL, documents=docs)


@pytest.mark.parametrize("rows", [EDGE_TURNS, []])
def test_edge_conversations(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n", "'x' AS piece")
    same(chat.chat_report(turns), chat.SQL, conversations=turns)


@pytest.mark.parametrize("rows", [EDGE_VECTORS, [], EDGE_VECTORS[:1]])
def test_edge_vectors(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS v", "2 AS cb", "3 AS score")
    same(topk.search_report(table), topk.SQL, embeddings=table)


def test_too_large_components_are_an_error(spark):
    with pytest.raises(ValueError, match="too large"):
        topk.search_report(spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>"))


def test_small_blocks_give_the_same_search(spark):
    vectors = topk.integer_vectors(spark.read.parquet(f"{TABLES}/embeddings.parquet"))
    queries = vectors.filter("vec_id % 50 = 0")
    want = rows_of(topk.top_k(queries, vectors))
    assert rows_of(topk.top_k(queries, vectors, candidate_rows=37, query_rows=3)) == want


def test_many_slices_give_the_same_neighbours(spark):
    docs = spark.range(3000).selectExpr("id * id AS doc_id", "concat('text ', id) AS text")
    got = {r.doc_id: r.next_text for r in merkle.with_next(docs, slice_rows=7).collect()}
    assert got == {i * i: f"text {(i + 1) % 3000}" for i in range(3000)}


def test_likeness_and_edits(spark):
    rows = [("A b. C d.\ne f\n\ng h", "A b. C d.\ne X\n\ng h"), ("same", "same"), ("", ""), ("a", "b\n\nc")]
    df = spark.createDataFrame(rows, "a string, b string")
    from pyspark.sql import functions as F

    a, b = F.col("a"), F.col("b")
    got = df.select(
        merkle.likeness(merkle.leaf_set(a), merkle.leaf_set(b)).alias("like"),
        (merkle.root(merkle.tree(a)) == merkle.root(merkle.tree(b))).alias("equal"),
        merkle.edits(merkle.tree(a), merkle.tree(b)).alias("edits"),
    ).collect()
    assert [r.like for r in got] == [0.75, 1.0, 1.0, 0.0]
    assert [r.equal for r in got] == [False, True, True, False]
    assert [[tuple(e) for e in r.edits] for r in got] == [[(0, 1)], [], [], [(0, 0), (1, 0)]]


def test_examples_train_each_reply_once(spark):
    turns = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "q3")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = chat.examples(chat.format_conversations(df)).orderBy("example").collect()
    assert [r.reply for r in got] == ["a1", "a2", ""]
    assert got[0].prompt == "<|start|>user<|says|>q1<|end|><|start|>assistant<|says|>"
    assert got[1].prompt.startswith(got[0].prompt + "a1<|end|>")
    assert all(len(r.prompt + r.reply + r.close) == r.chars for r in got)


def test_mix_meets_targets(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "repeat('w ', cast(1 + id % 7 AS int)) AS text",
        "CASE WHEN id % 3 < 2 THEN 'big' WHEN id % 2 = 0 THEN 'mid' ELSE 'tiny' END AS source",
    )
    report = mixing.mix_report(docs).toPandas()
    assert (report.taken <= 3 * report["size"]).all()
    by = report.groupby("target").agg(taken=("taken", "sum")).reset_index()
    assert ((by.taken - by.target).abs() < 0.05 * by.target).all()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.select(mixing.words(mixed.text).alias("n")).toPandas().n.sum() == report.taken.sum()
    assert rows_of(mixing.mix_report(docs)) == rows_of(mixing.mix_report(docs.repartition(3)))


def test_licenses_found(spark):
    docs = spark.createDataFrame(EDGE_DOCS, "doc_id long, text string, source string")
    got = {r.doc_id: (r.license, r.line_licenses, r.license_lines) for r in licenses.license_report(docs).collect()}
    assert got[12][0] == "MIT" and got[14][0] == "ISC"
    assert got[13] == (None, "CC-BY-NC-4.0,MIT", 3)
    assert got[15] == got[0] == got[11] == (None, "", 0)
    assert licenses.scan(docs, licenses.known_licenses(spark).limit(0)).filter("license IS NOT NULL OR license_lines > 0").count() == 0


def test_long_licenses_and_standard_notices(spark):
    """Entire licences as the container has them, rewrapped or with a changed appendix, and the usual notices."""
    folder = "/usr/share/common-licenses"
    text = lambda name: open(f"{folder}/{name}", encoding="utf-8").read()  # noqa: E731, SIM115
    apache = text("Apache-2.0")
    names = {
        "Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-1": "GPL-1.0-only", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only",
        "LGPL-2": "LGPL-2.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
        "Artistic": "Artistic-1.0-Perl", "GFDL-1.2": "GFDL-1.2-only", "GFDL-1.3": "GFDL-1.3-only", "BSD": "BSD-3-Clause",
    }
    whole = [(i, text(n), names[n]) for i, n in enumerate(names)]
    whole += [(50, apache[: apache.index("END OF TERMS")], "Apache-2.0"), (51, text("MPL-2.0").upper().replace("\n", "\r\n  "), "MPL-2.0")]
    notice = apache[apache.index("   Licensed under the") :]
    gnu = text("GPL-3")
    gnu = gnu[gnu.index("    This program is free software: you") : gnu.index("Also add information on how")]
    whole += [(52, "Copyright 2020 A. Holder\n" + notice, "Apache-2.0"), (53, gnu, "GPL-3.0-or-later")]
    lines = [(60, "int x;\n" + notice, "Apache-2.0"), (61, "// SPDX-License-Identifier: MPL-2.0\nint y;", "MPL-2.0")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in whole + lines], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_report(docs).collect()}
    assert {i: got[i].license for i, _, _ in whole} == {i: n for i, _, n in whole}
    assert {i: (got[i].license, got[i].line_licenses) for i, _, _ in lines} == {i: (None, n) for i, _, n in lines}


def test_mix_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 7, 8), (2, "c", "t", 9, 10)], "doc_id long, text string, source string, _copy int, _taken int")
    got = mixing.mix(docs)
    assert got.columns == docs.columns and {(r.doc_id, r._copy, r._taken) for r in got.collect()} <= {(1, 7, 8), (2, 9, 10)}
