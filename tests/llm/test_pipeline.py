"""The pipeline on a small table: its stages' decisions take effect."""

import corpus_pipeline as P
from qaspark.llm import bpe
from qaspark.llm.common import documents

SF_SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = documents(spark, SF_SMALL)
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == columns, name
        n = out.count()
        if name == "near_dedup":
            assert n < docs.count()
        docs = out
    got = sorted(r["ids_sha256"] for r in P.run(spark, SF_SMALL).collect())
    assert got == sorted(r["ids_sha256"] for r in bpe.digests(docs).collect())


def test_empty_table(spark):
    docs = documents(spark, SF_SMALL).where("false")
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0
