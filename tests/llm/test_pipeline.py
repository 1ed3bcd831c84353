from __future__ import annotations

import hashlib

import corpus_pipeline as pipeline
import public_tokenizers
from tokenizers import Tokenizer

from tidegauge.llm import gam, mixing, simhash, toxicity
from tidegauge.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mix", "encode"]


def test_each_stage_acts_on_what_the_last_one_kept(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    kept = pipeline.quality_stage(spark, docs, TABLES)
    assert ids(kept) == ids(gam.score(docs, gam.train(docs, labels)).filter("score >= 0.7")) and kept.columns == docs.columns
    clean = pipeline.toxicity_stage(spark, kept, TABLES)
    assert ids(clean) == ids(toxicity.score(kept, toxicity.train(kept, labels)).filter("score < 0.7"))
    single = pipeline.near_duplicate_stage(spark, clean, TABLES)
    assert ids(single) == sorted({r.component_id for r in simhash.near_duplicates(clean).collect()})
    mixed = pipeline.mix_stage(spark, single, TABLES)
    copies = {r.doc_id: r.copies for r in mixing.repetitions(single).collect()}
    assert ids(mixed) == sorted(i for i, n in copies.items() for _ in range(n))

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in mixed.collect()}
    rows = pipeline.run(spark, TABLES).collect()
    assert sorted(r.doc_id for r in rows) == ids(mixed)
    for r in rows:
        tokens = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{TABLES}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_nulls_repeats_and_clashing_columns_through_all_stages(spark, tmp_path):
    given = spark.read.parquet(f"{TABLES}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None), (None, "", "a"), (None, None, None), (70_001, None, "a"), (70_002, "", None), (70_003, "word " * 40_000, "a")],
        "doc_id long, text string, source string",
    )
    docs = given.unionByName(given.limit(5)).unionByName(odd, allowMissingColumns=True)
    docs = docs.selectExpr("*", "1 AS size", "'x' AS target", "2 AS copies", "doc_id AS _copy", "0.5 AS score", "'y' AS _stage_score", "3 AS component_id")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    more = spark.createDataFrame([(None, 1, 0), (70_001, None, None), (0, 1, 1)], "doc_id long, quality int, toxic int")
    labels.unionByName(more).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, step in pipeline.STAGES[:-1]:
        kept = step(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        docs = pipeline.stage(kept, "edges")
    rows = pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} <= ids and len(rows) == docs.count()
