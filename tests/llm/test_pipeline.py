"""The pipeline's stages on the smallest tables."""

import itertools

import corpus_pipeline
from activity_mart.llm import registry
from activity_mart.llm.common import new_path


def test_stages_keep_columns_and_pack_everything(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, f"test-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            after = {r.doc_id for r in docs.collect()}
            assert after <= before
            clean = [i for i in before if quality.get(i) == 1]
            if name.startswith("quality"):
                assert sum(i in after for i in clean) >= 0.95 * len(clean)
            before = after
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == before
    for _, group in itertools.groupby(sorted(pieces, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        assert sum(r.length for r in group) <= 2048


def test_run_gives_the_last_stage(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_rules_query_equals_its_sql(spark, sf_dir):
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = connection.execute(registry.ORACLES["op3_quality_rules"]).df().sort_values("doc_id").reset_index(drop=True)
    got = registry.QUERIES["op3_quality_rules"](spark, sf_dir).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert got[list(want.columns)].equals(want)
