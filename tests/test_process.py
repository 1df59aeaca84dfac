import hashlib
import http.server
import json
import random
import struct
import threading
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cropmill import config
from cropmill.functions import grid
from cropmill.functions.text import digest
from cropmill.operators import inference, pages, report, synthesis, tensors
from cropmill.sources import files, images
from cropmill.sources.tables import materialize
from cropmill.streaming import ingest

C = config.load()
ENDPOINTS = {r: {"base_url": "u", "model": f"{r}-m", "revision": "1"} for r in ("base", "sft")}


def rows(spark):
    return spark.createDataFrame([(f"s{i}", t, f"h{i}") for i, t in enumerate(("text", "table", "formula"))], "id string, task string, image_hash string")


def test_requests_cache_and_resume(spark):
    greedy = inference.requests(rows(spark), C, ENDPOINTS)
    sampled = inference.requests(rows(spark), C, ENDPOINTS, True)
    assert (greedy.count(), sampled.count()) == (6, 12) and greedy.unionByName(sampled).select("id").distinct().count() == 18
    r = greedy.filter("role = 'sft' AND sample_id = 's0'").first()
    identity = {"image": "h0", "model": "sft-m", "revision": "1", "endpoint": "u", "prompt": "OCR:", "params": {"temperature": 0, "top_p": 1.0, "max_tokens": 4096, "seed": 42}, "preprocess": C["inference"]["preprocess"], "extra_body": {}, "kind": "greedy", "index": 0}
    assert r.id == digest(identity)
    empty = spark.createDataFrame([], inference.ANSWER)
    todo = inference.misses(greedy, empty)
    cache = materialize(inference.ask(todo, lambda q: (q["prompt"] + q["role"], "stop"), C))
    assert cache.count() == 6 and inference.misses(greedy, cache).count() == 0
    failed = cache.withColumn("status", F.when(F.col("id") == r.id, "transport_error").otherwise(F.col("status")))
    assert [x.id for x in inference.misses(greedy, failed).collect()] == [r.id]
    other = inference.requests(rows(spark), C, {**ENDPOINTS, "sft": {**ENDPOINTS["sft"], "revision": "2"}})
    assert inference.misses(other, cache).count() == 3
    out = inference.attach(rows(spark), greedy, cache)
    assert [(c.role, c.text) for c in out.filter("id = 's0'").first().candidates] == [("base", "OCR:base"), ("sft", "OCR:sft")]
    more = inference.attach(out, sampled, materialize(inference.ask(sampled, lambda q: ("x", "length"), C)), True)
    assert [len(r.candidates) for r in more.collect()] == [6, 6, 6]
    assert inference.changed_provenance(out, config.load({"prompts": {"text": "Read:"}})).first().id == "s0"
    assert {r.role: r.alive for r in inference.role_liveness(out).collect()} == {"base": True, "sft": True}
    with pytest.raises(ValueError):
        inference.requests(rows(spark), C, {"base": {"base_url": "u", "model": "m"}})


def test_retries(spark):
    def provider(request):
        if request["role"] == "base":
            raise inference.failure_of(404)
        raise inference.failure_of(429)

    got = {(r.status, r.attempts) for r in inference.ask(inference.requests(rows(spark), C, ENDPOINTS), provider, C, lambda s: None).collect()}
    assert got == {("transport_error", 1), ("transport_error", 4)}


def test_report(spark):
    df = spark.createDataFrame([(i, f"<s{i}>", "text" if i % 3 else None, (i / 10, None if i % 2 else 0.5)) for i in range(20)], "n int, id string, task string, signals struct<base_score:double,sft_score:double>")
    assert {(r.field, r.value): r.n for r in report.counts(df, ["task"]).collect()} == {("task", "text"): 13, ("task", "unknown"): 7}
    h = {(r.field, r.bin): r.n for r in report.histogram(df, {"b": F.col("signals.base_score"), "z": F.lit(0.0), "none": F.lit(None), "nan": F.lit(float("nan"))}).collect()}
    want = [0] * 10
    for i in range(20):
        want[min(9, int(i / 10 / 1.9 * 10))] += 1
    assert [h["b", k] for k in range(10)] == want and h["z", 0] == 20 and ("none", 0) not in h and ("nan", 0) not in h
    assert [r.value for r in report.top_bars(df, "task", F.col("n")).orderBy("place").collect()] == ["unknown", "text"]
    assert report.scatter(df).count() == 10
    assert {r.page: r["count"] for r in report.pages(df, ["n"], 8).groupBy("page").count().collect()} == {0: 8, 1: 8, 2: 4}
    page = report.render(df, df.select("id", F.lit("<b>why</b>").alias("reason")))
    assert "<s1>" not in page and "&lt;s1&gt;" in page and "&lt;b&gt;why" in page
    assert "<h1>" in report.render(df.limit(0), df.limit(0).select("id", F.lit("x").alias("reason")))
    with pytest.raises(ValueError):
        report.pages(df, ["n"], 0)
    paired = spark.createDataFrame([("a", [("c0",), ("c1",), ("c2",)], ("c1", "c0"))], "id string, candidates array<struct<id:string>>, pair_audit struct<chosen_id:string,rejected_id:string>")
    assert {r.candidate_id: r.badge for r in report.badges(paired).collect()} == {"c0": "rejected", "c1": "chosen", "c2": ""}


TENSOR = "model string, key string, shape array<int>, dtype string, values array<double>"


def test_weighted_mean(spark):
    t = [("a", "w", [2], "F32", [1.0, 2.0]), ("b", "w", [2], "F32", [3.0, 4.0]), ("a", "n", [1], "I64", [7.0]), ("b", "n", [1], "I64", [7.0]), ("a", "m", [1], "I64", [7.0]), ("b", "m", [1], "I64", [8.0]), ("a", "x", [1], "F32", [float("nan")]), ("b", "x", [1], "F32", [1.0]), ("a", "y", [1], "F32", [1.0]), ("a", "e", [0], "F32", []), ("b", "e", [0], "F32", [])]
    out = {r.key: r for r in tensors.weighted_mean(spark.createDataFrame(t, TENSOR), {"a": 1, "b": 1}).collect()}
    assert list(out["w"]["values"]) == [2.0, 3.0] and list(out["n"]["values"]) == [7.0] and out["e"]["values"] == []
    assert {k: r.problem for k, r in out.items()} == {"w": None, "n": None, "m": "models differ", "x": "not finite", "y": "missing in a model", "e": None}
    assert list({r.key: r for r in tensors.weighted_mean(spark.createDataFrame(t[:2], TENSOR), {"a": 1, "b": 3}).collect()}["w"]["values"]) == [2.5, 3.5]
    assert {r.key: r.problem for r in tensors.key_problems(spark.createDataFrame(t, TENSOR)).collect()} == {"y": "missing in a model"}
    for bad in ({}, {"a": 0.0}, {"a": -1, "b": 2}):
        with pytest.raises(ValueError):
            tensors.weighted_mean(spark.createDataFrame(t, TENSOR), bad)


def test_shards_and_maps(spark):
    rng = random.Random(2)
    sizes = [(f"k{i:03}", rng.randint(1, 60)) for i in range(50)] + [("k999", 500)]
    got = [(r.key, r.shard) for r in tensors.shards(spark.createDataFrame(sizes, "key string, bytes bigint"), 100).orderBy("key").collect()]
    want, shard, used = [], 0, 0
    for k, n in sorted(sizes):
        if used and used + n > 100:
            shard, used = shard + 1, 0
        used += n
        want.append((k, shard))
    assert got == want
    a = spark.createDataFrame([("x", "1"), ("y", "1")], "key string, shard string")
    b = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "1")], "key string, shard string")
    assert {r.key for r in tensors.map_problems(a, b).collect()} == {"y", "z"}


def test_checkpoint_files(spark, tmp_path):
    for model, w in (("a", [1.0, 2.0]), ("b", [3.0, 4.0])):
        (tmp_path / model).mkdir()
        (tmp_path / model / "m.safetensors").write_bytes(files.build_safetensors([("w", [2], "BF16", np.array(w)), ("n", [1], "I64", np.array([5]))]))
    t = files.read_checkpoints(spark, {m: str(tmp_path / m) for m in "ab"})
    out = {r.key: list(r["values"]) for r in tensors.weighted_mean(t, {"a": 1, "b": 3}).collect()}
    assert out == {"w": [2.5, 3.5], "n": [5.0]}
    with pytest.raises(ValueError):
        list(files.parse_safetensors(b"\xff" * 7 + b"\x00" + b"{}"))


def test_templates_and_variants(spark):
    built = synthesis.builtin_templates()
    assert len(built) == 4 and all(synthesis.problem(t) is None for t in built)
    df = spark.createDataFrame(built, synthesis.TEMPLATE)
    v = synthesis.variants(df, 4).collect()
    assert len(v) == 16 and all(grid.canonical(r.otsl) == r.html for r in v)
    assert [r.html for r in v] == [r.html for r in synthesis.variants(df, 4).collect()]
    by = {(r.template_family_id, r["index"]): r.html for r in v}
    assert all(by[t["template_family_id"], 0] == t["seed_html"] and by[t["template_family_id"], 1] != by[t["template_family_id"], 2] for t in built if t["template_family_id"] != "wrapped_text")
    t = built[0]
    for change in ({"split": "test"}, {"rows": 0}, {"cells": t["cells"][1:]}, {"cells": t["cells"] + t["cells"][:1]}, {"header_rows": 99}, {"style": {"width": 10, "font_size": 15}}, {"seed_html": "<table><tr><td>z</td></tr></table>"}):
        assert synthesis.problem({**t, **change})
    with pytest.raises(ValueError):
        synthesis.variants(df, 0)


def test_seeds_and_records(spark):
    s = spark.createDataFrame([(1, "a", "i", "table", "<fcel>q<nl>", "d1", "train", "h1", "s", "private", None), (2, "b", "i", "text", "x", "d2", "train", "h2", None, None, None), (3, "c", "i", "table", "bad", "d3", "train", "h3", None, None, None), (4, "d", "i", "table", "<fcel>q<nl>", "d4", "test", "h4", None, None, None), (5, "e", "i", "table", "<fcel>q<nl>", "d4", "train", "h5", None, None, None), (6, "f", "i", "table", None, "d6", "train", "h6", None, None, True)], "n int, id string, image string, task string, gt string, document_id string, split string, pixel_hash string, source string, domain string, gt_trusted boolean")
    made, bad = synthesis.make_templates(s.withColumn("target", F.col("gt")), ["n"])
    assert [r.seed_sample_id for r in made.collect()] == ["a"] and made.first().source == "s"
    assert {r.id: r.reason for r in bad.collect()} == {"b": "v1_table_only", "c": "no table element", "d": "held_out_or_untrusted_seed", "e": "evaluation_overlap", "f": "missing table GT"}
    h, o = "<table><tr><td>a</td></tr></table>", "<fcel>a<nl>"
    rec = spark.createDataFrame([(1, h, o, "train", ("passed",), "x", "x"), (2, h, o, "train", ("passed",), "x", "x"), (3, h, o, "train", ("passed",), "y", "z"), (4, h, "<fcel>b<nl>", "train", ("passed",), "q", "q"), (5, h, o, "test", ("passed",), "r", "r"), (6, h, o, "train", None, "t", "t"), (7, None, None, "train", ("passed",), "u", "u")], "n int, html string, otsl string, split string, qa struct<status:string>, image_hash string, actual_hash string")
    assert {r.n: r.reason for r in synthesis.check_records(rec, ["n"]).collect()} == {1: None, 2: "duplicate image", 3: "image hash mismatch", 4: "HTML/OTSL mismatch", 5: "held-out or failed render QA", 6: "held-out or failed render QA", 7: "HTML/OTSL mismatch"}


def test_agent_repairs(spark):
    def propose(seed, k, issues, start):
        good = {"html": "<table><tr><td>a</td></tr></table>", "title": f"{k} from {start and start['title']}", "header_rows": 1, "style": {"width": 700, "font_size": 15, "more": 1}}
        if k == 0 and not issues:
            return '```json\n{"html": "bad", "title": "", "header_rows": 1, "style": {"width": 700, "font_size": 15}}\n```', "stop"
        return json.dumps(good), "stop" if k < 2 else "length"

    def review(html, picture):
        return json.dumps({"approved": picture.startswith(b"<!doctype"), "issues": []}), "stop"

    audit = materialize(synthesis.run_agent(spark.createDataFrame([("s",)], "id string"), propose, review, templates_per_seed=3, repairs=1, renderer=str.encode))
    titles = [json.loads(r.template)["title"] for r in audit.filter("accepted").orderBy("template_index").collect()]
    assert titles == ["0 from ", "1 from 0 from "] and synthesis.agent_manifest(audit, 3, 1) == {"generated": 2, "pending": 1, "seeds": 1, "attempts": 5, "status": "partial"}
    for wrong in ({"header_rows": "1"}, {"title": None}, {"style": {"width": 7, "font_size": 15}}, {"header_rows": 9}, {"html": "<table><tr><td>&lt;nl&gt;</td></tr></table>"}):
        with pytest.raises(ValueError):
            synthesis.template_from_reply({"html": "<table><tr><td>a</td></tr></table>", "title": "t", "header_rows": 1, "style": {"width": 700, "font_size": 15}} | wrong, {"id": "s"}, "f")
    rows = spark.createDataFrame([(i, f"r{i}", "table" if i else "text", "<fcel>a<nl>", "train", True) for i in range(5)], "_ord int, id string, task string, gt string, split string, gt_trusted boolean")
    seeds, left = synthesis.choose_seeds(rows, ["_ord"], 2)
    assert [r.id for r in seeds.orderBy("_ord").collect()] == ["r1", "r2"] and {r.id: r.reason[:9] for r in left.collect()} == {"r0": "v1_table_", "r3": "max_seeds", "r4": "max_seeds"}
    assert [(r.template_index, r.attempt, r.accepted) for r in audit.orderBy("template_index", "attempt").collect()] == [(0, 0, False), (0, 1, True), (1, 0, True), (2, 0, False), (2, 1, False)]
    last = {r.template_index: r for r in synthesis.agent_result(audit).collect()}
    assert last[0].accepted and last[0].reason is None and last[2].reason == "repair budget exhausted; see audit"


def test_pages(spark):
    df = spark.createDataFrame([("a/x.png", "1"), ("b/x.jpg", "2"), ("c.txt", "3"), ("d/e.PNG", "4")], "image string, h string")
    assert {r.image: r.problem for r in pages.check_inputs(df).collect()} == {"a/x.png": "stem not unique", "b/x.jpg": "stem not unique", "c.txt": "unsupported suffix", "d/e.PNG": None}
    inputs = df.select(pages.stem(F.col("image")).alias("stem"), pages.page_key("r1", F.col("h")).alias("key")).filter("stem <> 'x'")

    def parse(r):
        if r["stem"] == "c":
            raise RuntimeError("no")
        return "# " + r["stem"]

    done = materialize(pages.export(pages.open_pages(inputs, spark.createDataFrame([], pages.STATUS)), parse))
    assert {r.stem: r.status for r in done.collect()} == {"c": "error", "e": "ok"}
    assert [r.stem for r in pages.open_pages(inputs, done).collect()] == ["c"]
    assert [r.stem for r in pages.open_pages(inputs, done.withColumn("markdown", F.lit("changed"))).orderBy("stem").collect()] == ["c", "e"]
    assert [r.stem for r in pages.stale_pages(inputs.filter("stem = 'e'"), done).collect()] == ["c"]


def test_json_files(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": "1", "x": null}\n\n  \n{"id": "2"}\n{"id": "é", "x": 3}\n', encoding="utf-8")
    df = files.read_jsonl(spark, str(p))
    there = df.orderBy("_ord").select(F.expr("variant_get(raw, '$.id', 'string')").alias("id"), F.expr("is_variant_null(variant_get(raw, '$.x'))").alias("x"), F.expr("variant_get(raw, '$.x') IS NULL").alias("missing")).collect()
    assert [(r.id, r.x, r.missing) for r in there] == [("1", True, False), ("2", False, True), ("é", False, False)]
    typed = files.read_jsonl(spark, str(p), "id string, x int")
    assert [(r.id, r.x) for r in typed.orderBy("_ord").collect()] == [("1", None), ("2", None), ("é", 3)]
    files.write_jsonl(typed, str(tmp_path / "out"), ["_ord"], one_file=True)
    lines = [json.loads(x) for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]
    assert [x["id"] for x in lines] == ["1", "2", "é"]
    (tmp_path / "bad.jsonl").write_text('[1]\n')
    with pytest.raises(Exception, match="expected an object"):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "b.json").write_text('[{"a": 1}, {"a": 2}]')
    assert [r._ord for r in files.read_json(spark, str(tmp_path / "b.json")).orderBy("_ord").collect()] == [0, 1]
    for bad in ('{"a": 1}', "[1]"):
        (tmp_path / "c.json").write_text(bad)
        with pytest.raises(Exception, match="expected"):
            files.read_json(spark, str(tmp_path / "c.json")).collect()
    files.write_json({"a": "é"}, str(tmp_path / "d" / "s.json"))
    assert (tmp_path / "d" / "s.json").read_text(encoding="utf-8") == '{\n  "a": "é"\n}\n'
    with pytest.raises(ValueError):
        files.write_json({"a": float("nan")}, str(tmp_path / "s.json"))
    for bad in ("double('NaN') as v", "named_struct('a', array(1D, double('inf'))) as v", "map('k', float('NaN')) as v"):
        with pytest.raises(Exception, match="finite"):
            files.write_jsonl(spark.sql(f"select {bad}"), str(tmp_path / "nan"))
    files.write_jsonl(spark.sql("select null as v, named_struct('a', cast(null as double), 'b', 1) as w"), str(tmp_path / "nulls"))
    assert [json.loads(x) for f in (tmp_path / "nulls").glob("part-*") for x in f.read_text().splitlines()] == [{"v": None, "w": {"a": None, "b": 1}}]
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "a.png").write_bytes(b"123")
    r = files.read_images(spark, str(tmp_path / "img"), 2).first()
    assert (r.length, r.content) == (3, None) and len(r.image_hash) == 64


def test_streaming_upsert_and_windows(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    (tmp_path / "src").mkdir()
    schema = "k string, v int, t string"
    (tmp_path / "src" / "1.json").write_text('{"k": "a", "v": 1, "t": "x"}\n{"k": "b", "v": 1, "t": "x"}\n')
    ingest.start(ingest.read_stream(spark, src, schema), out, "k", "v", ck).awaitTermination()
    (tmp_path / "src" / "2.json").write_text('{"k": "a", "v": 3, "t": "new"}\n{"k": "b", "v": 0, "t": "old"}\n')
    ingest.start(ingest.read_stream(spark, src, schema), out, "k", "v", ck).awaitTermination()
    assert {(r.k, r.v, r.t) for r in ingest.current(spark, out).collect()} == {("a", 3, "new"), ("b", 1, "x")}
    events = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:10:00", "a", 4.0)], "ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(str(tmp_path / "ev"))
    q = ingest.windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev"))).writeStream.format("memory").queryName("w").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.n, r.total) for r in spark.table("w").collect()) == [(1, 4.0), (2, 3.0)]


def test_report_pages_rendering_and_page_files(spark, tmp_path):
    row = "id string, task string, target string, candidates array<struct<id:string,role:string,kind:string,text:string>>, signals struct<base_score:double>, pair_audit struct<chosen_id:string,rejected_id:string>"
    df = spark.createDataFrame([(f"<{i}>", "table" if i % 2 else "text", "<fcel>a<nl>" if i % 2 else "x<y", [("c0", "sft", "greedy", "bad")], (0.5,), ("c0", None)) for i in range(5)] + [("z", None, None, None, None, None)], row)
    n = report.write_report(df, df.select("id", F.lit("why").alias("reason")), str(tmp_path / "r"), ["id"], 4)
    assert n == 2 and sorted(p.name for p in (tmp_path / "r").iterdir()) == ["index.html", "samples-1.html", "samples-2.html"]
    text = (tmp_path / "r" / "samples-1.html").read_text()
    assert "&lt;1&gt;" in text and "<td>a</td>" in text and "chosen" in text and "x&lt;y" in text and "<1>" not in text
    made = synthesis.variants(spark.createDataFrame(synthesis.builtin_templates(), synthesis.TEMPLATE), 2)

    def renderer(page):
        if "merged_header-1" in page:
            raise RuntimeError("no")
        return page.encode()

    out = materialize(synthesis.render_variants(made, renderer))
    checked = {r.id: r.reason for r in synthesis.check_records(out.withColumn("actual_hash", F.col("image_hash")), ["id"]).collect()}
    assert len(checked) == 8 and {k: v for k, v in checked.items() if v} == {"merged_header-1": "held-out or failed render QA"}
    assert synthesis.render_manifest(out) == {"generated": 7, "failed": 1, "families": 4, "status": "partial"} and synthesis.gallery(out).count("<article>") == 7
    done = pages.export(spark.createDataFrame([("a", "k"), ("b", "k"), ("c", "k")], "stem string, key string"), lambda r: {"a": {"markdown": "# é ![](i/x.png)", "json": {"n": 1}, "assets": {"i/x.png": b"png"}}, "b": {"markdown": "", "assets": {"../x": b""}}, "c": "c"}[r["stem"]])
    assert pages.write_pages(done, str(tmp_path / "p")) == {"pages": 3, "written": 2, "by_status": {"ok": 2, "error": 1}, "status": "partial"}
    assert (tmp_path / "p" / "assets" / "a" / "i" / "x.png").read_bytes() == b"png" and json.loads((tmp_path / "p" / "a.json").read_text()) == {"n": 1}
    assert (tmp_path / "p" / "a.md").read_text(encoding="utf-8") == "# é ![](assets/a/i/x.png)"


def test_images(tmp_path):
    rng = np.random.default_rng(3)
    pixels = rng.integers(0, 256, (7, 5, 3), dtype=np.uint8)
    data = images.png(pixels)
    assert (images.rgb(data) == pixels).all() and images.pixel_digest(images.rgb(data)) == images.pixel_digest(pixels)
    ppm = b"P6\n5 7\n255\n" + pixels.tobytes()
    assert images.pixel_digest(images.rgb(ppm)) == images.pixel_digest(pixels) != images.pixel_digest(pixels.swapaxes(0, 1))
    for bad in (b"", b"P9 1 1", b"words", data[:40]):
        with pytest.raises(Exception):
            images.rgb(bad)
    flat = images.shrink(np.full((40, 20, 3), 77, np.uint8), 10)
    assert flat.shape == (10, 5, 3) and (flat == 77).all() and images.shrink(pixels, None) is pixels
    (tmp_path / "a.png").write_bytes(data)
    assert images.fetch(images.locate("a.png", str(tmp_path))) == data
    with pytest.raises(ValueError, match="exceeds"):
        images.fetch(str(tmp_path / "a.png"), most_bytes=10)


def filtered_png(pixels, how):
    """A PNG whose lines are all filtered one way."""
    h, w, c = pixels.shape
    raw, out = pixels.reshape(h, w * c).astype(int), bytearray()
    for y in range(h):
        out.append(how)
        for x in range(w * c):
            a, b, d = (raw[y, x - c] if x >= c else 0), (raw[y - 1, x] if y else 0), (raw[y - 1, x - c] if y and x >= c else 0)
            p = a + b - d
            near = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - d) else b if abs(p - b) <= abs(p - d) else d
            out.append(int(raw[y, x] - [0, a, b, (a + b) // 2, near][how]) % 256)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[c], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(out))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("how", range(5))
@pytest.mark.parametrize("channels", [1, 3, 4])
def test_png_filters(how, channels):
    pixels = np.random.default_rng(how).integers(0, 256, (6, 4, channels), dtype=np.uint8)
    assert (images.rgb(filtered_png(pixels, how)) == (np.repeat(pixels, 3, 2) if channels == 1 else pixels[:, :, :3])).all()


class Server(http.server.BaseHTTPRequestHandler):
    seen: list = []

    def do_GET(self):
        Server.seen.append(self.path)
        self.send_response(200)
        self.end_headers()
        self.wfile.write(b"x" * 100)

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Server.seen.append((self.path, body, self.headers["Authorization"]))
        busy = len(Server.seen) == 1
        self.send_response(503 if busy else 401 if body["model"] == "closed" else 200)
        self.end_headers()
        self.wfile.write(b"k3y is wrong" if body["model"] == "closed" else json.dumps({"choices": [{"message": {"content": "hello"}, "finish_reason": "stop"}]}).encode())

    def log_message(self, *a):
        pass


@pytest.fixture
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    Server.seen.clear()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_images_and_models_over_http(server, tmp_path):
    for _ in range(2):
        assert images.fetch(f"{server}/a.png", cache=str(tmp_path / "c")) == b"x" * 100
    assert Server.seen == ["/a.png"]
    with pytest.raises(ValueError, match="exceeds"):
        images.fetch(f"{server}/b.png", most_bytes=99)
    Server.seen.clear()
    endpoint = {"base_url": f"{server}/v1", "model": "m", "api_key": "k3y"}
    waits = []
    client = inference.VisionClient(endpoint, pause=waits.append)
    assert client.ask("what?", b"png") == ("hello", "stop") and waits == [1]
    path, body, key = Server.seen[1]
    assert path == "/v1/chat/completions" and key == "Bearer k3y" and [c["type"] for c in body["messages"][0]["content"]] == ["image_url", "text"]
    with pytest.raises(inference.Fatal) as e:
        inference.chat(endpoint | {"model": "closed"}, [], {}, 5)
    assert "k3y" not in str(e.value)
    provider = inference.http_provider(C, {"sft": endpoint}, lambda r: b"png")
    assert provider({"role": "sft", "kind": "greedy", "seed": 42, "prompt": "OCR:"}) == ("hello", "stop")
    for bad in ("ftp://h/v1", "http://u:p@h/v1", "http://h/v1?q=1", "http:///v1", "words"):
        with pytest.raises(ValueError):
            inference.VisionClient({"base_url": bad, "model": "m"})


def test_pictures_for_requests(spark, tmp_path):
    data = images.png(np.full((30, 10, 3), 9, np.uint8))
    (tmp_path / "a.png").write_bytes(data)
    h = hashlib.sha256(data).hexdigest()
    df = spark.createDataFrame([("a", "a.png", h), ("b", "a.png", "other"), ("c", "gone.png", h)], "id string, image string, image_hash string")
    out = {r.id: r for r in inference.prepare_images(df, str(tmp_path), {"mode": "rgb", "max_side": 15}).collect()}
    assert images.rgb(bytes(out["a"].picture)).shape == (15, 5, 3) and "changed" in out["b"].error and "FileNotFound" in out["c"].error


def test_provenance_of_image_and_model(spark):
    row = "id string, task string, image_hash string, candidates array<struct<role:string,kind:string,prompt:string,image_hash:string,model:string,revision:string>>"
    c = lambda **k: tuple(({"role": "sft", "kind": "greedy", "prompt": "OCR:", "image_hash": "h", "model": "m", "revision": "1"} | k).values())
    changes = [{}, {"prompt": "other"}, {"image_hash": "g"}, {"model": "n"}, {"revision": "2"}, {"kind": "sample", "model": "n"}]
    df = spark.createDataFrame([(str(i), "text", "h", [c(**k)]) for i, k in enumerate(changes)], row)
    assert sorted(r.id for r in inference.changed_provenance(df, C, {"sft": {"model": "m", "revision": "1"}}).collect()) == ["1", "2", "3", "4"]


def test_models_that_must_not_be_averaged(spark, tmp_path):
    a, b = {"hidden": 4, "torch_dtype": "f"}, {"hidden": 4, "torch_dtype": "g"}
    assert tensors.config_problems({"a": a, "b": b}) == [] and tensors.config_problems({"a": a, "b": {**b, "hidden": 5, "layers": 1}}) == ["b: hidden differs from a", "b: layers differs from a"]
    assert tensors.config_problems({"a": {**a, "quantization_config": {"bits": 4}}}) == ["a: quantized"]
    assert tensors.side_problems({"a": {"tokenizer.json": "1", "config.json": "x", "x.bin": "1"}, "b": {"tokenizer.json": "2", "config.json": "y", "merges.txt": "1", "adapter_config.json": "z"}}) == ["b: adapter_config.json is an adapter", "b: merges.txt differs from a", "b: tokenizer.json differs from a"]
    t = spark.createDataFrame([("a", "x", [1], "F32", [1.0]), ("a", "y", [1], "F32", [1.0]), ("b", "x", [1], "F32", [1.0]), ("b", "y", [1], "F32", [2.0])], TENSOR)
    assert [r.model for r in tensors.tied_problems(t, [("x", "y")]).collect()] == ["b"] and tensors.tied_problems(t, []).count() == 0
    (tmp_path / "x.safetensors").write_bytes(files.build_safetensors([("w", [1], "F32", np.array([1.0]))]))
    for shard, ok in (("x.safetensors", True), ("y.safetensors", False)):
        (tmp_path / "model.safetensors.index.json").write_text(json.dumps({"weight_map": {"w": shard}}))
        if ok:
            assert files.read_checkpoints(spark, {"m": str(tmp_path)}).count() == 1
        else:
            with pytest.raises(ValueError, match="agree"):
                files.read_checkpoints(spark, {"m": str(tmp_path)})


def test_mathml_is_cleaned():
    ok = '<math xmlns="http://www.w3.org/1998/Math/MathML" display="inline" onclick="x"><mi href="y">a</mi></math>'
    assert "onclick" not in report.clean_mathml(ok) and "href" not in report.clean_mathml(ok) and 'display="inline"' in report.clean_mathml(ok)
    with pytest.raises(ValueError):
        report.clean_mathml(ok.replace("<mi", '<b xmlns="z"').replace("</mi", "</b"))


def test_report_before_and_after(spark):
    rows = spark.createDataFrame([(i, f"r{i}", "b" if i < 3 else "a", (i / 10, 0.5), "xy") for i in range(8)], "_ord int, id string, task string, signals struct<base_score:double,sft_score:double>, target string")
    page = report.render(rows.filter("_ord > 4"), rows.select("_ord", F.concat(F.lit("p"), 9 - F.col("_ord")).alias("id"), F.lit("why").alias("reason")), before=rows, sample_pages=2)
    assert page.count("<circle") == 8 and "task (before)" in page and "task (after)" in page and "samples-2.html" in page and "gt_length" in page
    assert page.index(">b<") < page.index(">a<") and page.index("p9\twhy") < page.index("p2\twhy")


def test_rows_of_a_folder_keep_their_order_and_shape(spark, tmp_path):
    (tmp_path / "out").mkdir()
    for part in range(4):  # later files are larger, so a scan by size would begin with them
        rows_ = [{"id": i, "text": "x" * 20 * (part + 1), "nothing": None} for i in range(50 * part, 50 * part + 50)]
        (tmp_path / "out" / f"part-{part}.txt").write_text("".join(json.dumps(r) + "\n" for r in rows_))
    back = files.read_rows(spark, str(tmp_path / "out"))
    assert [r.id for r in back.orderBy("_ord").collect()] == list(range(200)) and "nothing" not in back.columns
    for name, text in (("a.json", '{"id": 1}'), ("b.json", "[1, 2]"), ("c.jsonl", '{"id": 1}\n[2]\n'), ("d.json", "")):
        (tmp_path / name).write_text(text)
        with pytest.raises(ValueError, match="expected"):
            files.read_rows(spark, str(tmp_path / name))
    (tmp_path / "e.json").write_text(' [{"id": 2}, {"id": 1}]')
    assert [r.id for r in files.read_rows(spark, str(tmp_path / "e.json")).orderBy("_ord").collect()] == [2, 1]
