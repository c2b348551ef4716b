"""The pipeline on the smallest tables, stage by stage."""

import corpus_pipeline
import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        counts.append(docs.count())
        if k < 4:
            assert docs.columns == columns
    assert counts[1] <= counts[0] and counts[2] == counts[1] and counts[3] < counts[2]


def test_operators_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
