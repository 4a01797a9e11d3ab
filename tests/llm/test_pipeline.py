import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from newslens.llm import simhash, surrogates
from test_rules import plain as plain_rules
from test_simhash import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, _rules string, entities string, fp string, row string"
FUNCTIONS = dict(corpus_pipeline.STAGES)


def prose(seed, n=90):
    draw = random.Random(seed)
    return " ".join(draw.choice("the quick brown fox jumps over lazy dogs and cats while rain falls on old stone roofs".split()) + str(draw.randint(0, 40)) + draw.choice(["", "", ",", "."]) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def docs(spark):
    first = prose(1)
    rows = [(1, first), (2, first), (3, first.replace("rain", "snow", 1)), (4, prose(4)), (5, prose(5) + "\nMail ann@example.com or 10.0.0.1.")]
    rows += [(6, None), (7, ""), (8, "too short."), (9, "| a | b | c\n" * 50), (10, "same same " * 80), (11, prose(11) + "\nAll rights reserved."), (4, prose(44)), (None, prose(12)), (13, prose(13, 9000))]
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "r", "e", "f", "w") for i, t in rows], COLUMNS).repartition(2)


def test_rules_stage(spark, docs):
    kept = FUNCTIONS["quality_rules"](spark, docs, "")
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    rows = kept.collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 2, 3, 4, 4, 5, 11, 13]
    assert all(not plain_rules(r.text)[-1] and r.n_chars == len(r.text) for r in rows if r.doc_id != 13)
    assert next(r.text for r in rows if r.doc_id == 11) == prose(11)
    assert {(r.score, r._rules, r.entities) for r in rows} == {("x", "r", "e")}
    assert FUNCTIONS["quality_rules"](spark, docs.limit(0), "").count() == 0


def test_classifier_stage(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("score", F.lit("s"))
    kept = FUNCTIONS["quality_classifier"](spark, docs, sf)
    assert kept.dtypes == docs.dtypes
    good = spark.read.parquet(f"{sf}/labels.parquet").join(docs, "doc_id").filter("quality = 1")
    assert 0 < kept.count() < docs.count()
    assert good.join(kept, "doc_id", "left_anti").count() <= 0.05 * good.count()


def test_dedup_stage(spark, docs):
    kept = FUNCTIONS["simhash_near_dedup"](spark, docs, "")
    assert kept.dtypes == docs.dtypes
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for _, _, c in brute(rows)})
    assert kept.filter("doc_id is null").count() == 1
    assert FUNCTIONS["simhash_near_dedup"](spark, docs.limit(0), "").count() == 0


def test_dedup_stage_decides_by_row(spark):
    near = prose(1).replace("rain", "snow", 1)
    rows = [(10, prose(1)), (500, prose(1)), (500, prose(2)), (500, prose(2)), (None, near), (None, prose(3)), (None, prose(3)), (None, prose(4)), (600, prose(5)), (600, prose(5) + " "), (700, prose(6))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x", "r", "e", "f", "w") for i, t in rows], COLUMNS).repartition(3)
    kept = FUNCTIONS["simhash_near_dedup"](spark, docs, "")
    assert kept.dtypes == docs.dtypes
    want = [(10, prose(1)), (500, prose(2)), (None, prose(3)), (None, prose(4)), (600, prose(5)), (700, prose(6))]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted((i or 0, t) for i, t in want)


def test_dedup_stage_does_not_send_all_groups_to_all(spark, docs):
    plan = FUNCTIONS["simhash_near_dedup"](spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    inner = [line for line in plan.split("\n") if "Join" in line and "Inner" in line]
    assert inner and all("SortMergeJoin" in line for line in inner)


def test_pii_stage(spark, docs):
    done = FUNCTIONS["pii_surrogates"](spark, docs, "")
    assert done.dtypes == docs.dtypes and done.count() == docs.count()
    key = __import__("hashlib").blake2b(corpus_pipeline.SURROGATE_KEY.encode(), digest_size=32).digest()
    want = sorted((r.doc_id or 0, surrogates.replace(r.text, lambda k, v: surrogates.surrogate(key, k, v))[0] or "") for r in docs.collect())
    assert sorted((r.doc_id or 0, r.text or "") for r in done.collect()) == want


def test_packing_stage(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for r in FUNCTIONS["packing"](spark, docs, "").collect():
        got.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    want = sorted([*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.collect())
    assert sorted([x for r in sorted(p, key=lambda r: r.start) for x in r.ids] for p in got.values()) == want


def test_whole_run(spark):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    rows = out.collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
    left = simhash.near_duplicates(docs.join(out.select("doc_id").distinct(), "doc_id", "left_semi"))
    assert left.filter("doc_id <> component_id").count() <= 2  # lines and entities changed after the link
    assert np.isin([r.length for r in rows], range(1, 2049)).all() and corpus_pipeline.ORACLE_SQL is None
