import random

import pytest
from pyspark.sql import functions as F

from cropmill import config
from cropmill.functions.text import digest
from cropmill.operators import mine, quota
from cropmill.operators.isolate import isolate, kept

SCHEMA = "n int, id string, image string, task string, target string, document_id string, split string, pixel_hash string, parent_image_hash string"
ORDER = ["n"]


def reference_isolate(rows):
    """The rules of isolation as a loop."""
    docs, hashes = set(), set()
    for r in rows:
        if (r["split"] or "train") != "train":
            docs |= {r["document_id"]} - {None, ""}
            hashes |= {r["pixel_hash"], r["parent_image_hash"]} - {None, ""}
    out, first, broken = {}, {}, set()
    for r in rows:
        if (r["split"] or "train") == "train" and (r["document_id"] in docs or hashes & {r["pixel_hash"], r["parent_image_hash"]}):
            out[r["n"]] = ("evaluation_overlap", None)
            continue
        key = r["pixel_hash"]
        if key not in first:
            first[key], out[r["n"]] = r, (None, None)
            continue
        f = first[key]
        differs = (f["target"], f["task"]) != (r["target"], r["task"])
        out[r["n"]] = ("duplicate_conflicting_gt" if differs else "duplicate_image", f["id"])
        if differs:
            broken.add(f["n"])
    return {n: ("duplicate_conflicting_gt", None) if n in broken else v for n, v in out.items()}


@pytest.mark.parametrize("seed", range(4))
def test_isolate_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    rows = [dict(n=i, id=f"i{i}", image=f"p{i}", task=rng.choice(["text", "table"]), target=rng.choice(["a", "b", None]), document_id=rng.choice([None, "", *[f"d{k}" for k in range(30)]]), split=rng.choice([None, *["train"] * 12, "test"]), pixel_hash=rng.choice([None, *[f"h{k}" for k in range(40)]]), parent_image_hash=rng.choice([None, "", *[f"h{k}" for k in range(200)]])) for i in range(120)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    got = {r.n: (r.reason, r.duplicate_of) for r in isolate(df, ORDER).collect()}
    assert got == reference_isolate(rows)


def test_isolate_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert isolate(empty, ORDER).count() == 0
    df = spark.createDataFrame([(1, "a", "p", "text", "x", "D", None, "h1", None), (2, "b", "q", "text", "x", None, None, "h2", None)], SCHEMA)
    manifest = spark.createDataFrame([("D", "other")], "document_id string, extra string")
    assert [r.id for r in kept(isolate(df, ORDER, manifest)).collect()] == ["b"]
    assert set(kept(isolate(df.withColumn("reason_", F.lit(1)), ORDER)).columns) == {*df.columns, "reason_"}


def test_apportion(spark):
    assert quota.apportion(10, {"a": 1, "b": 1, "c": 1}) == {"a": 4, "b": 3, "c": 3}
    assert quota.apportion(0, {"a": 1}) == {"a": 0}
    assert quota.apportion(1000, {"regression": 0.4, "learnable": 0.4, "coverage": 0.2}) == {"regression": 400, "learnable": 400, "coverage": 200}
    t = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0)], "k string, s double")
    assert {r.k: r.quota for r in quota.apportion_table(t, 10, "s", F.col("k")).collect()} == {"a": 4, "b": 3, "c": 3}


def test_quantiles_bit_for_bit(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.choice([rng.random(), 0.25]), i) for i in range(500)] + [("d", None, 1000), ("e", 0.5, 1001)]
    df = spark.createDataFrame(rows, "g string, v double, i int")
    got = {(r.g, r.q): r.threshold for r in quota.quantiles(df, ["g"], "v", [0.0, 0.2, 0.8, 1.0], "i").collect()}
    for g in "abce":
        v = sorted(x for k, x, _ in rows if k == g and x is not None)
        for q in (0.0, 0.2, 0.8, 1.0):
            p = (len(v) - 1) * q
            lo, hi = int(p), -int(-p // 1)
            assert got[g, q] == v[lo] + (v[hi] - v[lo]) * (p - lo)
    assert ("d", 0.2) not in got


MINE = SCHEMA + ", domain string, score_gt string, gt_trusted boolean, signals struct<sft_score:double,gt_error:double,regression:double,priority:double,candidate_gap:double>"


def sample_rows(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = rng.choice([None, round(rng.random(), 3)])
        rows.append((i, f"i{i:03}", f"p{i}", rng.choice(["text", "table", "formula"]), "t", f"d{i % 60}", "test" if i % 17 == 0 else None, f"h{i if i % 13 else 0}", None, rng.choice(["private", "general"]), rng.choice(["t", "t", "t", None]), rng.choice([None, True, True, False]), (s, None if s is None else 1 - s, rng.choice([None, 0.0, 0.2]), round(rng.random(), 2), rng.choice([0.0, 0.3]))))
    return rows


def loop_mine(rows, c):
    names = ["n", "id", "image", "task", "target", "document_id", "split", "pixel_hash", "parent_image_hash", "domain", "score_gt", "gt_trusted", "signals"]
    rows = [dict(zip(names, r)) | {"s": dict(zip(["sft_score", "gt_error", "regression", "priority", "candidate_gap"], r[-1]))} for r in rows]
    why = reference_isolate(rows)
    clean = [r for r in rows if why[r["n"]][0] is None]
    able = [r for r in clean if r["split"] is None and r["score_gt"] is not None and r["gt_trusted"] is not False]

    def quant(v, q):
        v = sorted(v)
        if not v:
            return 0.0
        p = (len(v) - 1) * q
        lo, hi = int(p), -int(-p // 1)
        return v[lo] + (v[hi] - v[lo]) * (p - lo)

    lim = {t: [quant([r["s"]["gt_error"] for r in able if r["task"] == t and r["s"]["gt_error"] is not None], q) for q in (0.2, 0.8)] for t in ("table", "text", "formula")}
    buckets = {}
    for r in able:
        s = r["s"]
        if s["sft_score"] is None:
            continue
        lo, hi = lim[r["task"]]
        b = "regression" if (s["regression"] or 0) >= 0.05 else "learnable" if lo <= s["gt_error"] <= hi and s["candidate_gap"] >= 0.05 else "coverage"
        buckets.setdefault(b, []).append(r)

    def pick(rows, n, shuffle):
        want = quota.desired_quotas(n, c)
        rows = list(rows)
        if shuffle:
            random.Random(42).shuffle(rows)
        else:
            rows.sort(key=lambda r: (-r["s"]["priority"], r["id"]))
        cat = lambda r: f"{r['domain']}/{r['task']}"
        inside, rest, seen = [], [], {}
        for r in rows:
            seen[cat(r)] = seen.get(cat(r), 0) + 1
            (inside if seen[cat(r)] <= want.get(cat(r), 0) else rest).append(r)
        return inside + rest[: max(0, n - len(inside))]

    out = []
    for i, (b, n) in enumerate(quota.apportion(c["mining"]["budget"], c["mining"]["buckets"]).items()):
        out += [(i, r["id"], b) for r in pick(buckets.get(b, []), n, b == "coverage")]
    used = {x[1] for x in out}
    rest = [r for g in buckets.values() for r in g if r["id"] not in used]
    bucket_of = {r["id"]: b for b, g in buckets.items() for r in g}
    return out + [(3, r["id"], bucket_of[r["id"]]) for r in pick(rest, max(0, c["mining"]["budget"] - len(out)), False)], clean, able


@pytest.mark.parametrize("seed,budget", [(1, 30), (2, 70), (3, 0)])
def test_mine_equals_the_loop(spark, seed, budget):
    c = config.load({"mining": {"budget": budget}, "mixture": {"domain": {"private": 0.5, "general": 0.5}, "task": {"table": 0.4, "text": 0.4, "formula": 0.2}}})
    rows = sample_rows(seed)
    chosen, left, _ = mine.mine_rows(spark.createDataFrame(rows, MINE), c, ORDER)
    want, clean, _ = loop_mine(rows, c)
    got = [(r.position["__stage"], r.id, r.mining_bucket) for r in chosen.orderBy("position").collect()]
    assert got == want
    why = {r.id: r.reason for r in left.collect()}
    assert set(why) | {x[1] for x in want} == {r[1] for r in rows} and not set(why) & {x[1] for x in want}
    assert set(why.values()) <= {"evaluation_overlap", "duplicate_image", "duplicate_conflicting_gt", "missing_or_failed_sft_score", "held_out", "missing_gt_disagreement_only", "untrusted_gt", "not_selected_budget"}


def test_stratify_hash_order_of_coverage(spark):
    c = config.load()
    df = spark.createDataFrame([(f"i{k}", "text", "private", "coverage", (0.5,)) for k in range(50)], "id string, task string, domain string, mining_bucket string, signals struct<priority:double>")
    sel, rep = quota.stratify(df, 10, c, quota.priority_order(c, True), True)
    want = sorted((f"i{k}" for k in range(50)), key=lambda i: (-int(digest([42, i])[:8], 16) / 2**32, i))[:10]
    assert [r.id for r in sel.orderBy("__position").collect()] == want
    assert {r.category: (r.desired, r.in_quota, r.actual, r.shortfall) for r in rep.collect()}["*/*/coverage"] == (2, 2, 10, 0)


def test_a_third_of_all_rows_in_one_group(spark):
    """No hash at all, one hash, one document and one id, each of a third of 90,000 rows or more: the verdicts are those of small groups."""
    n = 90_000
    third = F.col("n") % 3
    df = spark.range(n).withColumnRenamed("id", "n").select(
        "n", F.concat(F.lit("r"), F.col("n")).alias("id"), F.lit("text").alias("task"), F.when(F.col("n") == 0, "other").otherwise("t").alias("target"), F.when(F.col("n") == 1, "test").otherwise("train").alias("split"),
        F.when(third == 0, None).when(third == 1, "hot").otherwise(F.concat(F.lit("h"), F.col("n"))).alias("pixel_hash"), F.when(third == 2, "hot").otherwise(F.concat(F.lit("d"), F.col("n"))).alias("document_id"),
    )
    held = spark.createDataFrame([("hot",)], "document_id string")
    got = {(r.reason, r.duplicate_of): r["count"] for r in isolate(df, ["n"], held).groupBy("reason", "duplicate_of").count().collect()}
    # Without a hash: the first row has another target, so it and all later ones conflict. One hash: a held-out row, r1, guards it.
    assert got == {("duplicate_conflicting_gt", None): 1, ("duplicate_conflicting_gt", "r0"): n // 3 - 1, (None, None): 1, ("evaluation_overlap", None): 2 * n // 3 - 1}
