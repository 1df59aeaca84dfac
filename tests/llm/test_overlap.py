import random

import numpy as np
from pyspark.sql import functions as F

from cropmill.functions.text import edit_distance
from cropmill.llm import overlap as o

SCHEMA = "id string, split string, source string, document_id string, pixel_hash string, parent_image_hash string, gt string, held int, extra string"
WORDS = [f"{a}{b}{c}" for a in ("kel", "mor", "tan", "vis", "or") for b in ("da", "li", "no", "ri") for c in ("st", "ne", "m", "lo")]


def edited(rng, s, k):
    s = list(s)
    for _ in range(k):
        i, how = rng.randrange(len(s)), rng.random()
        if how < 0.5:
            s[i] = rng.choice("abcxyz019 é中")
        elif how < 0.75 and len(s) > 80:
            del s[i]
        else:
            s.insert(i, rng.choice("qwz "))
    return "".join(s)


def close(a, b):
    return abs(len(a) - len(b)) * 10 <= max(len(a), len(b)) and edit_distance(a, b) * 10 <= max(len(a), len(b))


def brute(rows):
    seen = {}
    for r in rows:
        seen.setdefault(r[0], r)
    tr = [r for r in seen.values() if (r[1] or "train").strip().lower() == "train"]
    he = [r for r in seen.values() if r not in tr]
    out = set()
    for t in tr:
        for h in he:
            images = lambda r: {x for x in (r[4], r[5]) if x and x != "0" * 64 and x != "none"}
            doc = t[3] and t[3] == h[3] and t[3] not in ("unknown",)
            text = t[6] and h[6] and len(t[6]) >= 80 and len(h[6]) >= 80 and close(t[6], h[6])
            if doc or images(t) & images(h) or text:
                out.add((t[0], h[0]))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(14, 24))) for _ in range(40)]
    rows = []
    for i in range(150):
        base = rng.choice(texts)
        gt = rng.choice([None, "short", base, *[edited(rng, base, rng.randint(0, len(base) // 10)) for _ in range(4)], " ".join(rng.choices(WORDS, k=20))])
        rows.append((f"r{i:03}", rng.choice([None, "train", "Train ", "test", "val", "EVAL"]), "s", rng.choice([None, "", "unknown", *[f"d{k}" for k in range(60)]]), rng.choice([None, *[f"h{k}" for k in range(90)]]), rng.choice([None, "none", "0" * 64, *[f"h{k}" for k in range(90)]]), gt, 1, "e"))
    df = spark.createDataFrame(rows + rows[:20], SCHEMA)
    got = [tuple(r) for r in o.overlaps(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    rep = o.report(df).agg(F.sum("pairs")).first()[0]
    assert rep == len(got)
    assert all(r.id_a < r.id_b for r in o.ordered(o.overlaps(df)).collect())


def test_recall_at_the_limit(spark):
    """Held-out texts beside copies with exactly 10 % edits spread over them, among texts of the same words."""
    rng = random.Random(5)
    rows, want = [], set()
    for i in range(250):
        t = " ".join(rng.choices(WORDS, k=rng.randint(13, 26)))
        e = edited(rng, t, len(t) // 10)
        rows += [(f"h{i:03}", "test", "s", None, None, None, t, 1, ""), (f"t{i:03}", "train", "s", None, None, None, e, 1, "")]
        if len(e) >= 80 and close(t, e):
            want.add((f"t{i:03}", f"h{i:03}"))
    got = {tuple(r) for r in o.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(want) > 200 and not want - got


def test_rarest_segments_of_a_stranger(spark):
    """A train text with 4 edits against a hot group of near copies; one unrelated held-out text shares just the 28 edited characters."""
    rng = random.Random(8)
    base = "".join(rng.choices("abcdefghijklmnop", k=200))
    copies = [base[:190] + f"{i:02}" + base[192:] for i in range(50)]
    train = base[:56] + "".join("Z" if k % 7 == 3 else c for k, c in enumerate(base[56:84])) + base[84:]
    stranger = "X" * 56 + train[56:84] + "Y" * 116
    rows = [("t", "train", "s", None, None, None, train, 1, "")] + [(f"h{i:02}", "test", "s", None, None, None, c, 1, "") for i, c in enumerate([*copies, stranger])]
    got = {tuple(r) for r in o.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows) == {("t", f"h{i:02}") for i in range(50)}


def test_hot_keys_are_salted(spark, monkeypatch):
    monkeypatch.setattr(o, "ROWS_PER_SALT", 10)
    rows = [(f"t{i}", None, "s", "hot", None, None, None, 0, "") for i in range(90)] + [(f"h{i}", "val", "s", "hot", None, None, None, 0, "") for i in range(35)]
    got = [tuple(r) for r in o.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(set(got)) == 90 * 35


def test_copies_expand_and_empty(spark):
    t = "x y z " * 30
    rows = [(f"t{i}", None, "s", None, None, None, t, 0, "") for i in range(5)] + [("h0", "test", "s", None, None, None, t + "q", 0, ""), ("h1", "test", "s", None, None, None, t, 0, ""), (None, "test", "s", None, None, None, t, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in o.overlaps(df).collect()} == {(f"t{i}", h) for i in range(5) for h in ("h0", "h1")}
    assert o.overlaps(df.limit(0)).count() == 0 and o.report(df.limit(0)).count() == 0


def test_segments_fit_at_every_length():
    """t + 1 disjoint segments fit into each piece's part of the text, so one of them outlives t edits."""
    for n in range(o.LEAST, 20_000):
        pieces = max(1, n // o.PIECE)
        sizes = [(k + 1) * n // pieces - k * n // pieces for k in range(pieces)]
        wanted = [-(-size * (o._tau(n) + 1) // n) for size in sizes]
        assert sum(wanted) > o._tau(n) and all(w * o.Q <= size for w, size in zip(wanted, sizes))


def test_segments_chosen_are_the_rarest():
    """Against all ways to place the segments, on texts short enough to try them, by a loop over prefixes."""
    rng = random.Random(9)
    texts = ["".join(rng.choices("ab<>", k=rng.randint(80, 300))) for _ in range(30)]
    t = o._Texts(list(range(len(texts))), texts)
    counts = np.array([rng.randint(0, 9) for _ in range(1 << o.CELL_BITS)])
    text, at = o.rarest(t, counts)
    for i, s in enumerate(texts):
        mine = sorted(at[text == i])
        assert len(mine) >= o._tau(len(s)) + 1 and all(y - x >= o.Q for x, y in zip(mine, mine[1:])) and mine[-1] <= len(s) - o.Q
        if len(s) < 2 * o.PIECE:
            k, inf = len(mine), float("inf")
            cost = counts[t.cells(t.start[i] + np.arange(len(s) - o.Q + 1))] + 1
            best = [[0.0] + [inf] * k]
            for n in range(1, len(s) + 1):
                skip = best[-1]
                best.append([skip[j] if n < o.Q or not j else min(skip[j], best[n - o.Q][j - 1] + cost[n - o.Q]) for j in range(k + 1)])
            assert sum(cost[x] for x in mine) == best[-1][k]


def differ(a, b):
    return ((int(a) ^ int(b)) & (1 << 64) - 1).bit_count()


def test_ring_code_radius():
    """An edit flips at most two bits of the fingerprints of what follows a segment."""
    rng = random.Random(2)
    seen = 0
    for _ in range(300):
        rest = "".join(rng.choices("abcdefgh é中", k=rng.randint(80, 150)))
        k = rng.randint(0, 9)
        a, b = "SEGMENT" + rest, "SEGMENT" + edited(rng, rest, k)
        t = o._Texts([0, 1], [a, b])
        close, far = t.codes(np.array([0, 1]), np.array([0, 0]))
        high, low = (x >> 32 & 0xFFFFFFFF for x in close), (x & 0xFFFFFFFF for x in close)
        apart = [differ(*x) for x in (high, low, far)]
        seen += apart[2]
        assert max(apart) <= 2 * k
    assert seen


def test_a_segment_without_edits_follows_the_cycle_lemma():
    """Of t + 1 segments one at least agrees, from it on around the ring, within the radius of its cells."""
    rng = random.Random(12)
    for _ in range(150):
        a = "".join(rng.choices("abcdefghij <>", k=rng.randint(90, 260)))
        b = edited(rng, a, o._tau(len(a)) - 1)
        if not close(a, b) or len(b) < 80:
            continue
        t = o._Texts([0, 1], [a, b])
        text, at = o.rarest(o._Texts([0], [a]), np.zeros(1 << o.CELL_BITS, np.int64))
        others, mine = o.cells(o._Texts([0], [a]), text, at), t.codes(text, at)
        every = np.arange(len(b) - o.Q + 1)
        held = t.codes(np.ones_like(every), every)
        ok = False
        for i, p in enumerate(at):
            for q in every[abs(every - p) <= len(a) // 10 + 1]:
                if a[p : p + o.Q] == b[q : q + o.Q]:
                    x = (int(mine[0][i]) ^ int(held[0][q])) & (1 << 64) - 1
                    bits = [(x >> 32).bit_count(), (x & 0xFFFFFFFF).bit_count(), differ(mine[1][i], held[1][q])]
                    ok |= all(n <= 2 * (int(others[i]) >> 8 * k & 255) for k, n in enumerate(bits))
        assert ok


def test_texts_of_any_length(spark):
    """Long texts, in many pieces and at the border of two levels, with as many edits as allowed."""
    rng = random.Random(4)
    rows = []
    for i, n in enumerate([80, 81, 127, 128, 129, 255, 256, 257, 511, 513, 1023, 1025, 4097, 30_000]):
        t = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz <>/", k=n))
        e = list(t)
        for x in rng.sample(range(n), n // 10):
            e[x] = "#"
        cut = t[n // 20 :]
        rows += [(f"h{i:02}", "test", "s", None, None, None, t, 1, ""), (f"t{i:02}", "train", "s", None, None, None, "".join(e), 1, ""), (f"u{i:02}", "train", "s", None, None, None, cut, 1, "")]
    got = {tuple(r) for r in o.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {(f"t{i:02}", f"h{i:02}") for i in range(14)} | {(f"u{i:02}", f"h{i:02}") for i in range(14) if len(rows[3 * i + 2][6]) >= 80}
    assert got == want


def test_hot_blocks_are_salted(spark, monkeypatch):
    """A third of all texts are near copies of one: each block is met by all of them, in pieces, and no pair is lost."""
    rng = random.Random(6)
    base = "<td></td>" * 9
    rows = [(f"t{i:02}", None, "s", None, None, None, f"{i:02}" + base, 0, "") for i in range(60)] + [(f"h{i:02}", "val", "s", None, None, None, base + f"{i:02}", 0, "") for i in range(30)]
    rows += [(f"x{i:02}", rng.choice([None, "val"]), "s", None, None, None, " ".join(rng.choices(WORDS, k=20)), 0, "") for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {tuple(r) for r in o.overlaps(df).collect()}
    seen, plain = [], o._salted
    monkeypatch.setattr(o, "ROWS_PER_SALT", 5)
    monkeypatch.setattr(o, "_salted", lambda *a: seen.append(1) or plain(*a))
    got = [tuple(r) for r in o.overlaps(df).collect()]
    assert len(seen) == 2 and len(got) == len(set(got)) and set(got) == want and len(want) >= 1800
