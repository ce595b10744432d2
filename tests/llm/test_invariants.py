"""What the queries without SQL must keep, on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from quillsieve.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def _run(spark, name):
    return QUERIES[name][0](spark, FOLDER)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_reports_are_the_rows_grouped(spark):
    for whole, report, keys, count in (
        ("p8_found", "p8_items", ["item_id"], "documents"),
        ("p9_found", "p9_counts", ["kind"], "mentions"),
        ("p4_found", "p4_counts", ["tbl", "defect"], "answers"),
    ):
        grouped = _run(spark, whole).groupBy(*keys).agg(F.count("*").alias(count))
        assert _rows(grouped) == _rows(_run(spark, report).select(*grouped.columns)), report


def test_placeholders_stand_for_mentions(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    found = {}
    for r in _run(spark, "p9_found").collect():
        found.setdefault(r.doc_id, []).append((r.start_pos, r.kind))
    hidden = {r.doc_id: r.text for r in _run(spark, "p9_redacted").collect()}
    assert set(hidden) == set(docs)
    for doc_id, text in docs.items():
        marks = sorted(found.get(doc_id, []))
        if not marks:
            assert hidden[doc_id] == text
            continue
        assert hidden[doc_id].startswith(text[: marks[0][0]] + f"[{marks[0][1].upper()}]")
        assert all(hidden[doc_id].count(f"[{k.upper()}]") >= sum(x == k for _, x in marks) for _, k in marks)


def test_every_token_is_packed_once(spark):
    capacity = spark.read.parquet(f"{FOLDER}/pack_bins.parquet").first()["capacity_tokens"]
    packed = _run(spark, "p7_bins")
    sizes = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("text IS NOT NULL").select("doc_id", (F.octet_length("text") + 1).cast("bigint").alias("n"))
    assert _rows(packed.groupBy("doc_id").agg(F.sum("size").alias("n"))) == _rows(sizes)
    filled = packed.filter("bin >= 0").groupBy("bin").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0]
    assert filled <= capacity
    assert {r.doc_id for r in _run(spark, "p7_found").collect()} == {r.doc_id for r in sizes.filter(F.col("n") > capacity).collect()}


def test_mixes_keep_their_bounds(spark):
    targets = {(r.mix_id, r.label): r for r in spark.read.parquet(f"{FOLDER}/mix_targets.parquet").collect()}
    shares = {(r.mix_id, r.label): r for r in _run(spark, "p2_shares").collect()}
    assert set(shares) == set(targets)
    for key, r in shares.items():
        assert r.most_copies <= targets[key].max_repeats
    unmet = {(r.mix_id, r.label) for r in _run(spark, "p2_found").collect()}
    assert {k for k, r in shares.items() if not r.can_be_met} == unmet


def test_cut_shares_count_the_cut_texts(spark):
    cut = _run(spark, "p1_found").count()
    assert sum(r.cut_texts for r in _run(spark, "p1_rates").collect()) == cut
    segments = _run(spark, "p5_segments")
    assert segments.groupBy("sample_id", "turn", "segment_no").count().filter("count > 1").count() == 0
    assert segments.filter("confidence < 0 OR confidence > 1").count() == 0
