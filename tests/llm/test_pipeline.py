"""The pipeline's stages and the contract of the registered queries."""

import collections
import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from panelkit.llm import jaccard, mixing
from panelkit.llm.queries import QUERIES
from tests.llm.conftest import plain_words
from tests.llm.test_texts import plain_groups

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

COLUMNS = {
    "op1_": "doc_id held_out score predicted", "op2_": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op3_": "doc_id n_words n_removed kept_sha256", "op4_": "doc_id size source_size target taken",
    "op5_": "doc_id piece start length ids_crc32 sequence_id offset", "op6_": "query_id rank vec_id score",
    "op7_": "doc_id n_shingles component_id", "op8_": "page_id host path rule verdict",
    "op9_": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_": "doc_id size text_crc32 law shard slot grown_shard",
    "op11_": "page_id payload_bytes payload_digest record_type refers_to",
    "op12_": "lang rank phrase a l r n score", "op13_": "word form root n n_near form_n"}


def test_every_operator_has_one_query():
    for prefix in COLUMNS:
        assert sum(q.startswith(prefix) for q in QUERIES) == 1
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    out = QUERIES[name](spark, SF)
    want = next(v for k, v in COLUMNS.items() if name.startswith(k)).split()
    assert out.columns[:len(want)] == want
    if name.startswith(("op5_", "op6_", "op12_", "op13_")):
        assert out.count() > 0
    else:
        source = "pages" if name.startswith(("op8_", "op11_")) else "documents"
        assert out.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        after = jaccard.written(stage(spark, kept, SF))
        sizes[name] = after.count()
        if name != "packing":
            assert after.schema == docs.schema
        if name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
            groups = plain_groups(rows)
            assert sizes[name] == len({c for _, n, c in groups if n}) + sum(k for (_, n, _), k in groups.items() if not n)
        if name == "mixing":
            plan = collections.Counter({r["doc_id"]: r["copies"] for r in mixing.mix(kept).collect() if r["copies"]})
            assert collections.Counter(r["doc_id"] for r in after.collect()) == plan
            assert all(plain_words(r["text"]) for r in after.collect())
        if name == "packing":
            assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in kept.collect()}
        kept = after
    assert sizes["pii"] == sizes["near_duplicates"] <= sizes["toxicity"] <= docs.count()
