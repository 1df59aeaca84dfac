import math

import pytest
from pyspark.sql import functions as F

from cropmill import config
from cropmill.functions import notation, ordering, text


def col(spark, f, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


def test_normal_forms(spark):
    assert col(spark, text.normalize_text, " \x1cé\r\nx 　") == "é\nx"
    for given, want in (("$$x+1$$", "x+1"), (r"\[ a \]", "a"), (r"\(b\)", "b"), ("$ c $", "c"), ("$$a$", "$a"), ("x", "x"), ("", ""), ("$", "")):
        assert col(spark, text.normalize_formula, given) == want
    assert col(spark, text.normalize_text, None) is None


def test_distances(spark):
    assert col(spark, text.normalized_distance, "héé", "hee") == pytest.approx(2 / 3)
    assert col(spark, text.normalized_distance, "", "") == 0
    assert col(spark, text.cer, "axc", "abc") == pytest.approx(1 / 3)
    assert col(spark, text.cer, "aaaa", "b") == 4 and col(spark, text.cer, "a", "") is None
    assert col(spark, text.wer, "a x", "a b") == 0.5 and col(spark, text.wer, "a", "b") is None


def test_digest_equals_json(spark):
    for parts in (["a", "b"], ['q"uo\\te', "zeile\n"], ["é中", ""]):
        assert col(spark, lambda a, b: text.digest_list(42, a, b), *parts) == text.digest([42, *parts])
    assert col(spark, lambda a: text.digest_list(a), None) == text.digest([None])
    h = int(text.digest([42, "s", "d"])[:8], 16) / 2**32
    assert col(spark, lambda a, b: text.unit_hash(text.digest_list(42, a, b)), "s", "d") == h
    assert col(spark, lambda a, b: ordering.hash_split(42, a, b, 1.0), "s", "d") == "eval"


def test_small_functions(spark):
    assert col(spark, text.escape_html, "<a & \"b'>") == "&lt;a &amp; &quot;b&#x27;&gt;"
    assert col(spark, text.is_numeric_cell, "+1,234.50%") and not col(spark, text.is_numeric_cell, "1a")
    assert col(spark, lambda c: text.missing_glyphs(c, "abc"), "abz c") == ["z"]
    assert col(spark, text.plain_endpoint, "https://h/v1") and not col(spark, text.plain_endpoint, "https://u:p@h/v1") and not col(spark, text.plain_endpoint, "ftp://h") and not col(spark, text.plain_endpoint, "https://h/?a=1")


def test_notation(spark):
    for f, given, want in (
        (notation.label, " Web-Harvest\n", "web_harvest"), (notation.label, "N/A", None), (notation.label, None, None), (notation.document_id, "DOC_0aF ", "doc-0af"),
        (notation.document_id, "unknown", None), (notation.content_hash, "SHA256:0AB", "0ab"), (notation.content_hash, "0" * 64, None), (notation.split, "Validation ", "val"), (notation.split, None, "train"), (notation.split, "", "train"),
    ):
        assert col(spark, f, given) == want


@pytest.mark.parametrize("bad", [{"metrics": {"formula": "x"}}, {"pairs": {"mode": "x"}}, {"mining": {"buckets": {"regression": 0.5, "learnable": 0.4, "coverage": 0.2}}}, {"mining": {"weights": [0, 0, 0]}}, {"mining": {"weights": [1, math.inf, 0]}}, {"inference": {"samples": 0}}, {"inference": {"retries": -1}}, {"pairs": {"margin": 0}}, {"mining": {"middle_quantiles": [0.8, 0.2]}}, {"inference": {"preprocess": {"mode": "gray"}}}, {"mixture": {"task": {"text": -1, "table": 2}}}])
def test_bad_config(bad):
    with pytest.raises(config.ConfigError):
        config.load(bad)


def test_config_merge_and_secrets():
    c = config.load({"mining": {"budget": 7}})
    assert c["mining"]["budget"] == 7 and c["mining"]["weights"] == [0.4, 0.4, 0.2] and config.DEFAULTS["mining"]["budget"] == 1000
    assert config.redact({"a": [{"API_Key": "x", "b": 1}]}) == {"a": [{"API_Key": "[REDACTED]", "b": 1}]}
    assert config.scrub({"k": ["my secret s3"]}, "s3") == {"k": ["my secret [REDACTED]"]} and config.scrub("x", "") == "x"


def test_notation_of_hashes(spark):
    h = "ab" * 32
    forms = [h, h.upper(), f" {h} ", f"{h}\n", f"sha256:{h}", f"SHA-256: {h}", f"0x{h}", f"0X{h.upper()}", f"sha256:0x{h}"]
    got = spark.createDataFrame([(x,) for x in forms], "h string").select(notation.content_hash(F.col("h")).alias("h")).distinct().collect()
    assert [r.h for r in got] == [h]
    none = spark.createDataFrame([(x,) for x in (None, "", "none", "0" * 64, "0x" + "0" * 64)], "h string").select(notation.content_hash(F.col("h")).alias("h"))
    assert none.filter("h IS NOT NULL").count() == 0
