"""Every query of the subpackage on tables with rows of nulls, repeated rows and columns of clashing names, and on empty tables."""

import pytest
from pyspark.sql import functions as F

from cropmill.llm import queries

BASE = "/root/testdata/sf0.001"
TABLES = ("samples", "source_docs", "documents", "mix_targets", "split_targets", "source_weights")
CLASHING = ("rank", "group", "n", "key", "less", "cell", "tokens", "units", "copies", "container", "spam_share", "held", "doc", "score", "value", "root", "node", "block", "at", "bits", "md5", "pairs", "piece", "length", "count", "short", "host", "phrase", "canonical", "candidate_id", "label", "measured")


def key(v):
    return repr(v)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    noisy, empty = str(tmp_path_factory.mktemp("noisy")), str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        df = spark.read.parquet(f"{BASE}/{t}.parquet")
        fixed = t in ("mix_targets", "split_targets", "source_weights")
        nulls = spark.createDataFrame([tuple([None] * len(df.columns))] * 2, df.schema)
        more = df if fixed else df.unionByName(nulls)
        if t == "samples":  # delivered again
            more = more.unionByName(df.limit(200))
        more.withColumns({c: F.lit(None if c == "n" else "x").cast("string") for c in CLASHING if c not in df.columns}).write.parquet(f"{noisy}/{t}.parquet")
        (df if fixed else df.limit(0)).write.parquet(f"{empty}/{t}.parquet")
    return noisy, empty


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_noise_changes_nothing(spark, folders, name):
    query = queries.queries()[name]
    clean, noisy = query(spark, BASE), query(spark, folders[0])
    assert clean.columns == noisy.columns
    a, b = (sorted(map(key, df.collect())) for df in (clean, noisy))
    if name in ("p6_containers", "p8_replicated", "p7_mix", "p3_splits", "p4_order", "p1_sample", "p2_canonical", "p6_report") or name.endswith("_found") or name in ("p1_check", "p3_check", "p6_check", "p7_check"):
        assert a == b
    elif name == "p8_evidence":  # every row of the table has one
        assert len(b) == len(a) + 2
    else:  # reports count the rows of nulls as documents
        assert len(a) == len(b)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, folders, name):
    rows = queries.queries()[name](spark, folders[1]).collect()
    if name not in ("p1_found", "p1_report", "p6_report", "p7_report") and not name.endswith("_check"):
        assert rows == []
