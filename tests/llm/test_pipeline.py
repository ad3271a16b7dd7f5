"""The stages one after the other, each against a plain form of its rule."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
import public_tokenizers
from test_decontaminate import brute as brute_contamination
from test_mixing import brute_mix
from test_simhash import brute_components, brute_print
from threadtone.llm.quality import THRESHOLD, fit_quality, grade_of, graded
from threadtone.llm.queries import WEIGHTS, domain_of


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    sf_dir, folder = "/root/testdata/sf0.01", tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = found[name] = spark.read.parquet(f"{folder}/{name}")
    return found


def keyed(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_return_documents(stages):
    columns = stages["documents"].columns
    for name in ("quality", "near_dedup", "decontamination", "mixing"):
        assert stages[name].columns == columns
        assert stages[name].exceptAll(stages["documents"]).filter("false").count() == 0
    for name in ("quality", "near_dedup", "decontamination"):
        assert stages[name].exceptAll(stages["documents"]).count() == 0


def test_quality(spark, stages):
    docs = stages["documents"]
    grades = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", grade_of().alias("grade"))
    kept = graded(docs, fit_quality(docs, grades)).filter(F.col("tail") >= THRESHOLD)
    assert {r.doc_id for r in kept.collect()} == set(keyed(stages["quality"]))
    judged = grades.join(stages["quality"].select("doc_id").withColumn("kept", F.lit(1)), "doc_id", "left")
    share = {r.grade: r.share for r in judged.groupBy("grade").agg(F.avg(F.coalesce("kept", F.lit(0))).alias("share")).collect()}
    assert share[2] > 0.97 and share[1] < 0.3 and share[0] < 0.6


def test_near_dedup(stages):
    rows = sorted((r.doc_id, r.text) for r in stages["quality"].collect())
    parts = brute_components([brute_print(t) for _, t in rows])
    assert set(keyed(stages["near_dedup"])) == {rows[i][0] for i in set(parts.values())}


def test_decontamination(spark, stages):
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in stages["near_dedup"].collect()]
    clean = {r[0] for r in brute_contamination(rows, items) if not r[-1]}
    assert set(keyed(stages["decontamination"])) == clean and len(clean) < len(rows)


def test_mixing(stages):
    tree = stages["decontamination"].select("doc_id", "text", domain_of("source"), "lang", "source")
    expect = [r[0] for r in brute_mix([tuple(r) for r in tree.collect()], WEIGHTS, (1, 1), 2)]
    assert sorted(r.doc_id for r in stages["mixing"].collect()) == sorted(expect)


def test_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expect, at = [], 0
    for r in sorted(stages["mixing"].collect(), key=lambda r: (r.doc_id, r.text)):
        ids = [*library.encode(r.text, add_special_tokens=False).ids, 2]
        expect.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((tuple(r) for r in stages["tokens"].collect()), key=lambda r: r[1]) == expect


def test_odd_rows(spark, odd_docs, no_docs):
    sf_dir = "/root/testdata/sf0.001"
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, sf_dir)
            if name != "tokens":
                assert found.columns == docs.columns
            assert found.count() <= 2 * docs.count()


def test_registered():
    names = contract.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "tokens"]
