import random

import pytest
from pyspark.sql import functions as F

from cropmill import config
from cropmill.functions import grid, text
from cropmill.functions.text import digest
from cropmill.operators import pairs, score

C = config.load()
ROW = "id string, image string, task string, domain string, source string, document_id string, split string, target string, score_gt string, gt_trusted boolean, pixel_hash string, candidates array<struct<id:string,text:string,role:string,index:int,kind:string,status:string,finish_reason:string,quality:struct<score:double,status:string>>>, signals struct<priority:double>, extra int"


def cand(i, t, role="sft", index=0, status="ok", finish="stop", q=None, qs="ok"):
    return (i, t, role, index, "greedy" if index == 0 else "sample", status, finish, (q, qs))


def row(id_="s", task="text", target="hello", cands=(), split="train", trusted=None, **_):
    return (id_, f"{id_}.png", task, "private", "src", f"d-{id_}", split, target, target, trusted, f"h-{id_}", None if cands is None else list(cands), (0.5,), 1)


def make(spark, rows, **over):
    return pairs.make_pairs(spark.createDataFrame(rows, ROW), config.load({"pairs": over}))


def test_direction_and_hard_negative(spark):
    c = [cand("b0", "hxllo", "base", q=0.8), cand("s0", "hello", q=1.0), cand("s1", "hexxo", index=1, q=0.6), cand("s2", "helxo", index=2, q=0.8)]
    r = make(spark, [row(cands=c)]).first()
    a = r.pair_audit
    assert (a.chosen_id, a.rejected_id, a.chosen_source) == ("s0", "s2", "sft") and a.gap == pytest.approx(0.2)
    assert r.pair.messages[0].content == "<image>OCR:" and r.pair.images == ["s.png"] and r.pair.rejected_response == "helxo"
    assert a.pair_hash == digest({"messages": [{"role": m.role, "content": m.content} for m in r.pair.messages], "images": r.pair.images, "rejected_response": r.pair.rejected_response})


@pytest.mark.parametrize("mode,chosen,reason", [("model_pair", None, "no_reliable_model_positive"), ("gt_pair", "gt", None), ("hybrid", "gt", None)])
def test_modes_without_a_good_answer(spark, mode, chosen, reason):
    r = make(spark, [row(cands=[cand("s0", "hxxlo", q=0.6)])], mode=mode).first()
    assert r.pair_reason == reason and (chosen is None or r.pair_audit.chosen_id == chosen)


def test_mode_gt_ignores_good_answers(spark):
    c = [cand("s0", "hello", q=1.0), cand("s1", "hxxlo", index=1, q=0.6)]
    assert make(spark, [row(cands=c)], mode="gt_pair").first().pair_audit.chosen_id == "gt"


def test_reasons_in_their_order(spark):
    bad = [cand("s0", "x", q=0.0)]
    rows = [
        row("a", cands=bad, split="test", target=None), row("b", cands=bad, target=None, trusted=False), row("c", cands=bad, trusted=False), row("d", cands=[cand("s0", "x", status="transport_error", q=0.0)]), row("e", cands=[cand("s0", "x", finish="length", q=0.0)]),
        row("f", cands=None), row("g", cands=[]), row("h", cands=[cand("s0", "hello", q=1.0), cand("s1", " hello ", index=1, q=0.5)]), row("i", cands=[cand("s0", None, q=0.0)]), row("j", cands=[cand("s0", "x", q=None)]),
    ]
    got = {r.id: r.pair_reason for r in make(spark, rows).collect()}
    assert got == {"a": "held_out", "b": "missing_gt", "c": "untrusted_gt", "d": "no_scored_candidates", "e": "no_scored_candidates", "f": "no_scored_candidates", "g": "no_scored_candidates", "h": "no_meaningful_preference_gap", "i": None, "j": "no_scored_candidates"}


def test_margin_has_slack_and_ties_go_to_the_least_id(spark):
    c = [cand("s1", "hello", q=1.0), cand("s0", "hello", index=1, q=1.0), cand("n2", "hella", index=2, q=0.95), cand("n1", "hellb", index=3, q=0.95)]
    a = make(spark, [row(cands=c)]).first().pair_audit
    assert (a.chosen_id, a.rejected_id) == ("s0", "n1")


def test_table_positive_must_be_otsl(spark):
    html, otsl = "<table><tr><td>a</td></tr></table>", "<fcel>a<nl>"
    c = [cand("s0", html, q=1.0), cand("s1", "<fcel>b<nl>", index=1, q=0.5), cand("s2", "junk", index=2, q=0.0, qs="invalid_prediction")]
    r = make(spark, [row(task="table", target=otsl, cands=c)]).first()
    assert r.pair_audit.chosen_id == "gt" and r.pair_audit.rejected_id == "s1"
    r = make(spark, [row(task="table", target=otsl, cands=[cand("s0", otsl, q=1.0), cand("s1", html, index=1, q=0.5)])]).first()
    assert r.pair_reason == "no_meaningful_preference_gap"  # equal as tables


def test_build_pairs(spark):
    rows = [row(f"s{i:02}", cands=[cand("s0", "hello", q=1.0), cand("s1", "x", index=1, q=0.0)]) for i in range(12)] + [row("t", split="val")]
    sel, pending, rep = pairs.build_pairs(spark.createDataFrame(rows, ROW), config.load({"mining": {"budget": 5}}), ["id"])
    assert [r.id for r in sel.orderBy("position").collect()] == [f"s{i:02}" for i in range(5)]
    assert sorted((r.id, r.reason) for r in pending.collect()) == [*((f"s{i:02}", "pair_quota_budget") for i in range(5, 12)), ("t", "held_out")]
    assert rep.first().actual == 5
    sel, pending, _ = pairs.build_pairs(spark.createDataFrame([], ROW), C, ["id"])
    assert sel.count() == 0 and pending.count() == 0


def loop_quality(task, c, gt):
    if c[5] != "ok" or c[6] not in ("stop", "eos"):
        return None, "generation_error"
    if gt is None:
        return None, "missing_gt"
    return loop_compare(task, c[1], gt)


def loop_compare(task, p, g):
    if task == "table":
        q = grid.compare_tables(p, g)
        return q.get("score"), q["status"]
    p, g = p.replace("\r\n", "\n").strip(), g.replace("\r\n", "\n").strip()
    if task == "formula":
        for left, right in text.DELIMITERS:
            if p.startswith(left) and p.endswith(right):
                p = p[len(left) : max(len(left), len(p) - len(right))].strip()
                break
        for left, right in text.DELIMITERS:
            if g.startswith(left) and g.endswith(right):
                g = g[len(left) : max(len(left), len(g) - len(right))].strip()
                break
    if not g:
        return None, "invalid_gt"
    return 1 - text.edit_distance(p, g) / max(len(p), len(g), 1), "ok"


def test_score_equals_the_loop(spark):
    rng = random.Random(4)
    texts = {"text": ["abc", " abd\r\n", "", "中文 abc"], "formula": ["$$x+1$$", "x+1", r"\[x+2\]", "$ $"], "table": ["<fcel>a<fcel>b<nl>", "<table><tr><td>a</td><td>c</td></tr></table>", "bad", "<fcel>a<nl>"]}
    rows = []
    for i in range(120):
        task = rng.choice(list(texts))
        pick = lambda: rng.choice(texts[task])  # noqa: E731, B023
        cands = [cand(f"{r}{k}", pick(), r, k, rng.choice(["ok", "ok", "ok", "transport_error"]), rng.choice(["stop", "eos", "length"])) for r in ("base", "sft") for k in range(rng.randint(0, 2))]
        rows.append(row(f"r{i}", task, rng.choice([None, pick()]), cands))
    out = {r.id: r for r in score.score_rows(spark.createDataFrame(rows, ROW), C).collect()}
    for r in rows:
        id_, task, gt, cands = r[0], r[2], r[8], r[11]
        want = [loop_quality(task, c, gt) for c in cands]
        got = out[id_]
        assert [(c.quality.score, c.quality.status) for c in got.candidates] == [(pytest.approx(s) if s is not None else None, st) for s, st in want]
        first = lambda role: next((k for k, c in enumerate(cands) if c[2] == role and c[4] == "greedy"), None)  # noqa: E731, B023
        b, s = first("base"), first("sft")
        bs, ss = want[b][0] if b is not None else None, want[s][0] if s is not None else None
        dis = None
        if b is not None and s is not None and all(cands[k][5] == "ok" and cands[k][6] in ("stop", "eos") for k in (b, s)):
            f, w = loop_compare(task, cands[s][1], cands[b][1])[0], loop_compare(task, cands[b][1], cands[s][1])[0]
            dis = 1 - (f + w) / 2 if f is not None and w is not None else None
        parts = [1 - ss if ss is not None else None, max(bs - ss, 0) if bs is not None and ss is not None else None, dis]
        den = sum(w for w, v in zip((0.4, 0.4, 0.2), parts) if v is not None)
        pri = sum(w * v for w, v in zip((0.4, 0.4, 0.2), parts) if v is not None) / den if den else 0.0
        sc = [x for x, _ in want if x is not None]
        assert (got.signals.base_score, got.signals.sft_score, got.signals.disagreement) == tuple(pytest.approx(x) if x is not None else None for x in (bs, ss, dis))
        assert got.signals.priority == pytest.approx(pri) and got.signals.candidate_gap == pytest.approx(max(sc) - min(sc) if sc else 0)
    assert score.score_rows(spark.createDataFrame([row("n", cands=None)], ROW), C).first().candidates == []
    assert score.score_rows(spark.createDataFrame([], ROW), C).count() == 0


def test_regression_of_hand_values(spark):
    c = [cand("b", "abcde", "base"), cand("s", "abcdx")]
    s = score.score_rows(spark.createDataFrame([row(target="abcde", cands=c)], ROW), C).first().signals
    assert s.regression == pytest.approx(0.2) and s.gt_error == pytest.approx(0.2)


def test_usable(spark):
    df = spark.createDataFrame([row(cands=[cand("a", "x", q=1.0), cand("b", "x", q=None), cand("c", "x", q=0.0, qs="invalid_prediction"), cand("d", "x", q=1.0, finish=None)])], ROW)
    assert [c.id for c in df.select(F.filter("candidates", pairs.usable).alias("u")).first().u] == ["a", "c"]
