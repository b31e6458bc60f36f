import os

import duckdb
import pytest

import corpus_pipeline
from shipyard.llm.queries import ORACLES, QUERIES
from tests.llm.cases import TEXTS, documents, empty
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_simhash import fingerprint, roots

SF = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    rows = con.execute(ORACLES[name])
    names = [x[0] for x in rows.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, rows.fetchall()))


def test_stages_by_brute_force(spark):
    """Every stage on what its predecessor kept, against plain Python."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.written(corpus_pipeline.quality(spark, docs, SF), "t1")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in ids for i in good) >= 0.97 * len(good) and kept.columns == FIELDS
    assert sum(i in ids for i, q in labels.items() if q == 0) <= 0.1 * len(labels)

    lines = corpus_pipeline.written(corpus_pipeline.line_dedup(spark, kept, SF), "t2")
    got = lines.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == [w[:2] for w in brute_lines([(r["doc_id"], r["text"]) for r in kept.collect()])]
    assert all(r["n_chars"] == len(r["text"]) for r in got) and lines.columns == FIELDS

    single = corpus_pipeline.written(corpus_pipeline.near_dedup(spark, lines, SF), "t3")
    prints = {r["doc_id"]: fingerprint(r["text"]) for r in got}
    different = sorted(set(prints.values()))
    of = roots([(a, b) for k, a in enumerate(different) for b in different[k:] if (a ^ b).bit_count() <= 3])
    least = {}
    for i, p in prints.items():
        least[of[p]] = min(i, least.get(of[p], i))
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(least.values())

    mixed = corpus_pipeline.written(corpus_pipeline.mixing(spark, single, SF), "t4")
    sizes = {r["doc_id"]: len(r["text"].split()) for r in single.collect()}
    chosen = [r["doc_id"] for r in mixed.collect()]
    assert len(chosen) == len(set(chosen)) and set(chosen) <= set(sizes)
    total = sum(sizes.values())
    assert 0.75 * total <= sum(sizes[i] for i in chosen) <= 0.9 * total

    pieces = corpus_pipeline.packing(spark, mixed, SF)
    per_doc = {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()}
    assert per_doc == set(chosen)
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_run_equals_the_stages(spark):
    a = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "again")
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, a.select(*keys).collect())) == sorted(map(tuple, docs.select(*keys).collect()))


def test_awkward_documents(spark, tmp_path):
    labels = [(i, int(i % 2 == 0)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (documents(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            before = docs
            docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), "odd")
            if stage is not corpus_pipeline.packing:
                assert docs.columns == before.columns
    one = corpus_pipeline.near_dedup(spark, documents(spark), "")
    assert one.where("doc_id = 8 OR doc_id = 0").count() == 1
    assert len(TEXTS) > one.count() and os.path.isdir(SF)
