"""What the tests of this folder share. Not a conftest: the folder above has one."""

import os

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


#: Names that operators use inside, and those of their results.
CLASHES = (
    "id", "n", "sig", "comp", "cell", "key", "size", "keep", "license", "notices", "canonical_digest", "lang_pred",
    "lang_score", "lang_spans", "shard_size", "shard_key", "shard", "slot", "toxicity", "item_id", "cosine", "lcs_share",
    "answer_share", "mix_size", "mix_source_size", "mix_target", "mix_copies", "_mix_key", "_set", "_drop", "_id", "_cell",
    "keep_id", "group_size", "kept", "component_id", "n_shingles", "pos", "dropped", "n_words", "runs", "collapsed",
)


def table(spark, name, sf=SMALL):
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


@pytest.fixture()
def make(spark):
    """Documents from ``(doc_id, text[, source])`` rows, with extra columns whose names
    clash with those the operators use inside and with those of their results."""

    def build(rows):
        rows = [(*r, None)[:3] for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        return df.withColumns({c: F.lit("clash") for c in CLASHES})

    return build
