"""The registered queries of the training-data operators at the smallest scale."""

import pytest
from compare import connect, differences
from conftest import SF

import __spark_entry__ as entry_module
import corpus_pipeline
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert differences(df, connect(SF), ORACLES[name]) == []
    else:
        assert df.count() > 0 or name == "op10_secret_scans"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "packing"]


def test_queries_take_whole_tables(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_substring_dedup", "op4_simhash", "op5_toxicity", "op8_crf_pii", "op11_periodic_runs", "op12_sentencepiece", "op13_fill_in_middle"):
        assert QUERIES[name](spark, SF).count() == n
