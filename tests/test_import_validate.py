import pytest
from pyspark.sql import functions as F

from cropmill import config
from cropmill.functions.text import digest
from cropmill.operators import importing, validate

SFT = "n int, image_info array<struct<image_url:string,matched_text_index:int>>, text_info array<struct<text:string,tag:string>>"


def sft(prompt="OCR:", answer="hi", image="a.png", index=0, tags=("mask", "no_mask")):
    return (1, [(image, index)], [(prompt, tags[0]), (answer, tags[1])])


@pytest.mark.parametrize("given,task,fmt", [(sft(), "text", "text"), (sft(" Table Recognition: ", " <table><tr>"), "table", "html"), (sft("Table Recognition:", "<fcel>"), "table", "otsl"), (sft("Formula Recognition:", "x"), "formula", "latex")])
def test_official_records(spark, given, task, fmt):
    r = importing.adapt_sft(spark.createDataFrame([given], SFT)).first()
    assert (r.task, r.gt_format, r.image, r.sft_error) == (task, fmt, "a.png", None)


@pytest.mark.parametrize("given", [sft("Chart:"), sft(index=1), (1, [("a", 0), ("b", 0)], [("OCR:", "mask"), ("x", "no_mask")]), (1, None, None), sft(tags=("no_mask", "mask")), sft(answer=" \n"), sft(answer=None), sft(image=""), sft(image=None), (1, [("a", 0)], [("OCR:", "mask")]), (1, [None], [None, None])])
def test_rejected_records(spark, given):
    r = importing.adapt_sft(spark.createDataFrame([given], SFT)).first()
    assert r.sft_error and r.task is None and r.gt is None


def test_conflict_with_explicit_columns(spark):
    df = spark.createDataFrame([sft()], SFT)
    assert importing.adapt_sft(df.withColumn("task", F.lit("table"))).first().sft_error == "conflict with explicit annotation"
    assert importing.adapt_sft(df.withColumn("task", F.lit(None).cast("string"))).first().sft_error is None


COLS = "n int, id string, image string, task string, pixel_hash string, document_id string, split string, gt string, gt_format string, html string, otsl string, text string, latex string, gt_trusted boolean"


def sample(n=1, id_="i", task="text", ph="h", doc=None, split=None, gt=None, fmt=None, html=None, otsl=None, text=None, latex=None, trusted=None):
    return (n, id_, "p.png", task, ph, doc, split, gt, fmt, html, otsl, text, latex, trusted)


def norm(spark, *rows, **over):
    return importing.normalize(spark.createDataFrame(list(rows), COLS), config.load(over)).orderBy("n").collect()


def test_truth_and_defaults(spark):
    a, b, c, d = norm(spark, sample(1, text="t"), sample(2, None, "table", otsl="<fcel>a<nl>", html="<table><tr><td>a</td></tr></table>"), sample(3, task="formula", latex="x"), sample(4))
    assert (a.gt, a.gt_format, a.target, a.split, a.import_error) == ("t", "text", "t", "train", None)
    assert b.id == digest(["h", "table"])[:20] and b.gt_format == "otsl" and b.target == "<fcel>a<nl>" and b.score_gt == "<table><tbody><tr><td>a</td></tr></tbody></table>" and b.table_features.cells == 1
    assert (c.gt_format, c.score_gt) == ("latex", "x") and (d.conversion_status, d.target) == ("missing_gt", None)


@pytest.mark.parametrize("bad,why", [(sample(task="chart", gt="x"), "task must be table, text or formula"), (sample(gt="  "), "blank gt"), (sample(task="table", gt="x", fmt="html"), "table has no grid"), (sample(task="table", gt="x"), "a table's gt_format must be html or otsl"), (sample(gt="x", fmt="latex"), "gt_format doesn't fit the task"), (sample(split="dev", gt="x"), "unsupported split"), (sample(task="table", otsl="<fcel>a<nl>", html="<table><tr><td>b</td></tr></table>"), "annotations conflict"), (sample(task=None, gt="x"), "task must be table, text or formula")])
def test_errors(spark, bad, why):
    r = norm(spark, bad)[0]
    assert r.import_error == why and r.target is None


def test_domain_whitelist_and_fields(spark):
    df = spark.createDataFrame([sample(gt="x")], COLS).withColumn("area", F.lit("odd"))
    c = config.load({"fields": {"domain": "area", "nothing": "absent"}, "mixture": {"domain": {"private": 1.0}}})
    assert importing.normalize(df, c).first().import_error == "domain outside the mixture"


def test_hash_split_only_without_a_split_column(spark):
    df = spark.createDataFrame([sample(i, f"i{i}", doc=f"d{i}", gt="x") for i in range(40)], COLS)
    c = config.load({"data": {"eval_fraction": 0.5}})
    assert {r.split for r in importing.normalize(df, c).collect()} == {"train"}
    got = {r.document_id: r.split for r in importing.normalize(df.drop("split"), c).collect()}
    assert got == {f"d{i}": "eval" if int(digest([42, "user", f"d{i}"])[:8], 16) / 2**32 < 0.5 else "train" for i in range(40)}


def test_import_protects_evaluation(spark):
    rows = [sample(1, "a", ph="h1", doc="D", gt="x"), sample(2, "b", ph="h2", doc="D", split="test", task="table", gt="bad", fmt="html"), sample(3, "c", ph="h3", doc="E", gt=" "), sample(4, "c", ph="h4", doc="E", gt="ok"), sample(5, "c", ph="h5", doc="E", gt="ok"), sample(6, "d", ph="h6", doc="F", gt="ok")]
    out = {r.n: r.reason for r in importing.import_rows(spark.createDataFrame(rows, COLS), config.load(), ["n"]).collect()}
    assert out == {1: "evaluation_overlap", 2: "import_error: table has no grid", 3: "import_error: blank gt", 4: None, 5: "import_error: duplicate id", 6: None}
    manifest = spark.createDataFrame([("F",)], "document_id string")
    out = {r.n: r.reason for r in importing.import_rows(spark.createDataFrame(rows, COLS), config.load(), ["n"], manifest).collect()}
    assert out[6] == "evaluation_overlap"
    assert importing.import_rows(spark.createDataFrame([], COLS), config.load(), ["n"]).count() == 0


DPO = "n int, messages array<struct<role:string,content:string>>, images array<string>, rejected_response string"


def test_validate_pairs(spark):
    good = ([("user", "<image>OCR:"), ("assistant", "a")], ["i"], "b")
    rows = [(1, *good), (2, *good), (3, good[0][:1], ["i"], "b"), (4, [("user", "<image><image>"), ("assistant", "a")], ["i"], "b"), (5, good[0], [], "b"), (6, good[0], None, "b"), (7, [("user", "<image>"), ("assistant", " \n")], ["i"], "b"), (8, good[0], ["i"], "a"), (9, None, None, None), (10, good[0], ["i"], None)]
    got = {r.n: r.problem for r in validate.validate_pairs(spark.createDataFrame(rows, DPO), ["n"]).collect()}
    assert got == {1: None, 2: "duplicate pair", 3: "two messages, user and assistant, required", 4: "one <image> mark required", 5: "one image required", 6: "one image required", 7: "blank answer", 8: "chosen equals rejected", 9: "two messages, user and assistant, required", 10: "blank answer"}


def test_preflight_and_align(spark):
    df = spark.createDataFrame([(1, [-100, 5], [-100, 6]), (2, [-100], [1]), (3, [1], [-100]), (4, [1] * 9, [1]), (5, None, None)], "n int, c array<int>, r array<int>")
    got = {r.n: r.verdict for r in validate.preflight(df, "c", "r", config.load({"training": {"max_length": 8}})).collect()}
    assert got == {1: None, 2: "no trainable chosen response tokens", 3: "no trainable rejected response tokens", 4: "overlength: 9", 5: "no trainable chosen response tokens"}
    a, b = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, d string"), spark.createDataFrame([(2, "z"), (3, None), (4, "q")], "k int, d string")
    assert {(r.k, r.problem) for r in validate.align(a, b, "k", "d").collect()} == {(1, "no audit"), (2, "digest differs"), (4, "no pair")}
