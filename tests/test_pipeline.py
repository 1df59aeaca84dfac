import json
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import cropmill.__main__ as cli
from cropmill import config
from cropmill.operators import inference, score
from cropmill.plans import pipeline
from cropmill.plans import queries as core
from cropmill.sources import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors don't have the tests
ENDPOINTS = {r: {"base_url": "u", "model": f"{r}-m", "revision": "1"} for r in ("base", "sft")}
TRUTH = {"text": "hello world", "table": "<fcel>a<fcel>b<nl>", "formula": "x+1"}


def answer(request):
    """A stand-in model: sft is right first and wrong in later samples, base is wrong."""
    task = {v: k for k, v in config.DEFAULTS["prompts"].items()}[request["prompt"]]
    right = TRUTH[task]
    wrong = {"text": "help worm", "table": "<fcel>a<fcel>c<nl>", "formula": "y-2"}[task]
    return (right if request["role"] == "sft" and request["index"] == 0 else wrong), "stop"


@pytest.fixture
def raw(tmp_path):
    rows = []
    for i, (task, prompt) in enumerate((("text", "OCR:"), ("table", "Table Recognition:"), ("formula", "Formula Recognition:"))):
        (tmp_path / f"{i}.png").write_bytes(f"image {i}".encode())
        rows.append({"id": f"r{i}", "task": task, "image": f"{i}.png", "gt": TRUTH[task], "gt_format": {"text": "text", "table": "otsl", "formula": "latex"}[task], "document_id": f"d{i}"})
    rows.append({"id": "gone", "task": "text", "image": "missing.png", "gt": "x", "gt_format": "text", "document_id": "d9"})
    path = tmp_path / "in.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return path


def lines(folder):
    return [json.loads(x) for f in sorted(Path(folder).glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]


def test_run_three_tasks_and_reuse_answers(spark, raw, tmp_path, monkeypatch):
    c = config.load()
    monkeypatch.setattr(files, "with_image_hashes", no_pillow(files.with_image_hashes))
    cache, out = str(tmp_path / "cache"), str(tmp_path / "out")
    stats = pipeline.run(files.read_rows(spark, str(raw)), c, ENDPOINTS, answer, str(tmp_path), out, cache)
    made = lines(f"{out}/dpo.pairs")
    assert stats["selected"] == 3 and {m["messages"][1]["content"] for m in made} == set(TRUTH.values())
    assert [a["sample_id"] for a in lines(f"{out}/dpo.audit")] == [r["id"] for r in lines(f"{out}/dpo.selected")]
    assert "import_error: FileNotFoundError" in {r["reason"] for r in lines(f"{out}/dpo.pending")}
    assert spark.read.parquet(cache).count() == 18 and "<svg" in Path(out, "report", "index.html").read_text() and Path(out, "report", "samples-1.html").exists()
    pipeline.run(files.read_rows(spark, str(raw)), c, ENDPOINTS, forbidden, str(tmp_path), str(tmp_path / "again"), cache)
    assert spark.read.parquet(cache).count() == 18


def forbidden(request):
    raise inference.Fatal("asked again")


def no_pillow(f):
    """The fixture's images are no pictures: their pixel hash is that of the file."""
    return lambda rows, base, column="image", data=None: f(rows, base, column, data).withColumn("pixel_hash", F.col("image_hash")).withColumn("image_error", F.when(F.col("image_hash").isNull(), F.col("image_error")))


def test_manifests_and_broken_held_out_records_guard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "with_image_hashes", no_pillow(files.with_image_hashes))
    sub = tmp_path / "sub"
    sub.mkdir()
    for i in range(6):
        (tmp_path / f"{i}.png").write_bytes(f"image {i}".encode())
    (sub / "other.png").write_bytes(b"image 3")
    sft = lambda ident, images, split, tag="mask": {"id": ident, "split": split, "document_id": f"d-{ident}", "image_info": [{"image_url": x, "matched_text_index": 0} for x in images], "text_info": [{"text": "OCR:", "tag": tag}, {"text": "words", "tag": "no_mask"}]}
    records = [sft(f"r{i}", [f"{i}.png"], "train") for i in range(6)] + [sft("several", ["0.png", "1.png"], "test"), sft("tag", ["2.png"], "val", "wrong"), sft("broken_train", ["5.png"], "train", "wrong")]
    (tmp_path / "in.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records))
    (sub / "m.jsonl").write_text(json.dumps({"image": "other.png"}) + "\n" + json.dumps({"image": "gone.png", "pixel_hash": "abc"}) + "\n")
    (sub / "n.json").write_text(json.dumps([{"document_id": "d-r4"}, {"document_id": "77"}]))
    (sub / "k.jsonl").write_text(json.dumps({"document_id": 77, "image_info": [{"image_url": "other.png"}]}) + "\n")
    raw = files.read_rows(spark, str(tmp_path / "in.jsonl"))
    leaks = lambda *m: {r.id for r in pipeline.convert(raw, config.load({"data": {"exclude_manifests": [str(sub / x) for x in m]}}), str(tmp_path))[1].filter("reason = 'evaluation_overlap'").collect()}
    assert leaks() == {"r0", "r1", "r2"}
    assert leaks("m.jsonl", "n.json", "k.jsonl") == {"r0", "r1", "r2", "r3", "r4"}
    (sub / "lost.jsonl").write_text(json.dumps({"image": "gone.png"}) + "\n")
    with pytest.raises(ValueError, match="gone.png"):
        leaks("lost.jsonl")


def test_commands(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "with_image_hashes", no_pillow(files.with_image_hashes))
    cli.main(["convert", "-i", str(raw), "-o", str(tmp_path / "c")])
    assert {r["id"] for r in lines(tmp_path / "c")} == {"r0", "r1", "r2"} and [r["id"] for r in lines(tmp_path / "c.errors")] == ["gone"]
    with pytest.raises(SystemExit):
        cli.main(["convert", "-i", str(raw), "-o", str(raw)])
    cli.main(["synth-template", "-o", str(tmp_path / "t")])
    cli.main(["synth-variants", "-i", str(tmp_path / "t"), "-o", str(tmp_path / "v"), "--variants", "3"])
    assert len(lines(tmp_path / "t")) == 4 and len(lines(tmp_path / "v")) == 12
    for m, v in (("a", 1.0), ("b", 3.0)):
        (tmp_path / m).mkdir()
        (tmp_path / m / "x.safetensors").write_bytes(files.build_safetensors([(k, [2], "F32", np.array([v, v])) for k in ("p", "q")]))
    cli.main(["average", "--models", str(tmp_path / "a"), str(tmp_path / "b"), "--weights", "1", "3", "-o", str(tmp_path / "m"), "--dtype", "F32"])
    back = {r.key: list(r["values"]) for r in files.read_checkpoints(spark, {"m": str(tmp_path / "m")}).collect()}
    assert back == {"p": [2.5, 2.5], "q": [2.5, 2.5]}


def test_checkpoint_sink(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i}", [4], "BF16", [1.0, 2.0, -3.0, 0.5]) for i in range(5)], "key string, shape array<int>, dtype string, values array<float>")
    index = files.write_checkpoint(df, str(tmp_path / "m"), 17)
    assert len(set(index["weight_map"].values())) == 3 and index["metadata"]["total_size"] == 40
    assert json.loads((tmp_path / "m" / "model.safetensors.index.json").read_text()) == index
    with pytest.raises(FileExistsError):
        files.write_checkpoint(df, str(tmp_path / "m"), 17)


def test_external_formula_metric(spark):
    row = "id string, task string, score_gt string, candidates array<struct<id:string,text:string,role:string,kind:string,status:string,finish_reason:string>>"
    df = spark.createDataFrame([("f", "formula", "$x+1$", [("s", "x+1", "sft", "greedy", "ok", "stop"), ("b", "boom", "base", "greedy", "ok", "stop"), ("e", "", "sft", "sample", "ok", "stop")]), ("t", "text", "ab", [("s", "ab", "sft", "greedy", "ok", "stop")])], row)
    c = config.load({"metrics": {"formula": "cdm"}})

    def metric(p, g):
        if p == "boom":
            raise RuntimeError("no render")
        return 1.0 if p == g else 0.25

    out = {r.id: [(x.quality.score, x.quality.status, x.quality.metric) for x in r.candidates] for r in score.score_rows(df, c, metric).collect()}
    assert out == {"f": [(1.0, "ok", "cdm"), (None, "metric_error", None), (0.0, "ok", "cdm")], "t": [(1.0, "ok", "text_ned")]}
    for bad in (None, lambda p, g: 0.5):
        with pytest.raises(ValueError):
            score.score_rows(df, c, bad)


def test_scans_are_pruned(spark):
    d = "/root/testdata/sf0.001"
    plan = lambda name: core.queries()[name](spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "candidates" not in plan("hash_split").split("ReadSchema")[1].split("\n")[0]
    text = plan("preflight_lengths")
    assert "created_at" not in text and "Exchange" not in text
    assert "PushedFilters" in plan("stale_pages") or "ReadSchema" in plan("stale_pages")


def test_an_unread_image_claims_no_id(spark, tmp_path, monkeypatch):
    """A row whose image can't be read, or whose record is broken, leaves its id and its place in the group to a later row; what was rejected keeps its record."""
    monkeypatch.setattr(files, "with_image_hashes", no_pillow(files.with_image_hashes))
    for i in range(2):
        (tmp_path / f"{i}.png").write_bytes(b"same image")
    row = lambda ident, image, gt: {"id": ident, "task": "text", "image": image, "gt": gt, "document_id": "d"}
    records = [row("a", "missing.png", "one"), row("a", "0.png", "two"), row("b", "1.png", "two"), row("a", "1.png", "three")]
    (tmp_path / "in.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records))
    good, bad = pipeline.convert(files.read_rows(spark, str(tmp_path / "in.jsonl")), config.load(), str(tmp_path))
    assert [(r.id, r.gt, json.loads(r.raw_annotation)) for r in good.collect()] == [("a", "two", {"gt": "two"})]
    left = {(r.id, r.gt): r for r in bad.collect()}
    assert left["b", "two"].reason == "duplicate_image" and left["b", "two"].duplicate_of == "a"
    assert left["a", "one"].reason == "import_error: FileNotFoundError" and json.loads(left["a", "one"].raw) == records[0]
    assert left["a", "three"].reason == "import_error: duplicate id" and left["a", "three"].input_index > left["a", "one"].input_index
