"""Records of held-out splits that also occur, exactly or almost, in the train split.

Pairs come from shared keys (document, image) and from near-equal gt. For the latter every text gets a similarity code.
Its blocks are hashes of segments of Q characters and of their rough position: a train text has those of t + 1 disjoint
segments, a held-out text those of all its windows. t edits touch at most t of t + 1 segments, so any partner has one of
them unchanged, at most t characters away, and no pair is lost. Which t + 1 segments a text shows is free, so a
dynamic program takes those that are rarest among the held-out texts, by counts in a table of fixed size.

Texts that agree in a block are held against bit fingerprints: counts of groups of characters as ring codes, of which an
edit flips at most two bits, so the Hamming radius of e edits is 2e. They cover fixed numbers of characters from the
segment on, the text taken as a ring. The segments cut that ring into t + 1 cells with t edits at most, so by the cycle
lemma one cell has no edit and, from it on, any number of following cells has fewer edits than there are cells: near the
segment the radius is a few bits. This happens in the join, before anything is shuffled again;
what is left is verified on the texts by edit distance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmill.functions import notation
from cropmill.operators import skew
from cropmill.sources.tables import materialize

#: Least length of a gt that takes part, and the edits allowed in 100 characters of the longer one.
LEAST, EDITS = 80, 10
#: Characters of a segment.
Q = 6
#: The table of counts: cells, and cells a row of it when it is summed. The driver and each task hold it, 4 MB.
CELL_BITS, PART = 19, 4096
#: Characters that the dynamic program looks at together, at most twice as many; the number of such pieces side by side.
PIECE, SIDE_BY_SIDE = 128, 1024
#: Characters whose arrays are held at once (a longer text is held whole).
AT_ONCE = 2_000_000
#: Characters from a segment on that a fingerprint covers, all of them fewer than LEAST.
NEAR, MIDDLE, FAR = 16, 32, 64
#: Ring codes of 0 to 7 and of 0 to 3: neighbours, the last and 0 too, differ in one bit, so a count that an edit changes
#: by 1 flips one.
RING8 = np.array([0b0000, 0b0001, 0b0011, 0b0111, 0b1111, 0b1110, 0b1100, 0b1000], np.uint64)
RING4 = np.array([0b00, 0b01, 0b11, 0b10], np.uint64)
#: Rows of a key that one task joins with as many of the other side.
ROWS_PER_SALT = 5_000


def _tau(n: np.ndarray | int) -> np.ndarray | int:
    """Most edits between a text of n characters and any text it may pair with."""
    return n * 100 // (100 - EDITS) * EDITS // 100


class _Texts:
    """Texts laid end to end: their characters, where each begins, its length, and the hash of the Q characters from each place on."""

    def __init__(self, keys: list[int], texts: list[str]) -> None:
        each = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        self.keys, self.n = np.array(keys, np.int64), np.array([len(p) for p in each], np.int64)
        self.start = np.cumsum(self.n) - self.n
        points = np.concatenate([*each, np.zeros(Q, np.uint32)]).astype(np.uint64)
        # 32 groups of characters; a text and its first FAR characters again, so that it is a ring.
        self.group = [((p.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(59)).astype(np.uint8) for p in each]
        m = len(points) - Q
        h = np.zeros(m, np.uint64)
        for k in range(Q):
            h = (h ^ points[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        self.hash = h

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, position) of every window of Q characters."""
        text = np.repeat(np.arange(len(self.n)), self.n)
        at = np.arange(len(text)) - self.start[text]
        whole = at <= self.n[text] - Q
        return text[whole], at[whole]

    def cells(self, places: np.ndarray) -> np.ndarray:
        return (self.hash[places] >> np.uint64(64 - CELL_BITS)).astype(np.int64)

    def codes(self, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints from each position on: NEAR with MIDDLE, and FAR."""
        group = np.concatenate([x for g in self.group for x in (g, g[:FAR])])
        start = self.start + FAR * np.arange(len(self.n))
        here = start[text] + at
        close, far = np.zeros(len(text), np.uint64), np.zeros(len(text), np.uint64)
        for g in range(16):
            even = np.zeros(len(group) + 1, np.uint8)
            # Sums modulo 256 keep what is counted modulo 8.
            np.cumsum(group == 2 * g, dtype=np.uint8, out=even[1:])
            odd = np.zeros(len(group) + 1, np.uint8)
            np.cumsum(group == 2 * g + 1, dtype=np.uint8, out=odd[1:])
            both = even + odd
            for k, c in enumerate((even, odd)):
                close |= ((c[here + NEAR] - c[here]) & 1).astype(np.uint64) << np.uint64(32 + 2 * g + k)
            close |= RING4[(both[here + MIDDLE] - both[here]) & 3] << np.uint64(2 * g)
            far |= RING8[(both[here + FAR] - both[here]) & 7] << np.uint64(4 * g)
        return close.view(np.int64), far.view(np.int64)


def _slices(batches: Iterator[pd.DataFrame], keep: Callable[[pd.DataFrame], dict] = lambda b: {}) -> Iterator[tuple[_Texts, dict]]:
    """Batches of (key, gt, ...) in slices of AT_ONCE characters."""
    for batch in batches:
        if not len(batch):
            continue
        ends = batch["gt"].str.len().cumsum() // AT_ONCE
        for _, part in batch.groupby(ends.to_numpy(), sort=True):
            yield _Texts(part["key"].tolist(), part["gt"].tolist()), keep(part)


def _level(n: np.ndarray) -> np.ndarray:
    """floor(log2(n)): texts meet within a level, whose places are as wide as half its least length."""
    return np.frexp(n.astype(np.float64))[1].astype(np.int64) - 1


def _blocks(hashes: np.ndarray, place: np.ndarray, level: np.ndarray) -> np.ndarray:
    h = (hashes ^ (place * 64 + level).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


#: at: position x 2^32 + length of the text. close, far: fingerprints. cells: the numbers of other segments within
#: NEAR, MIDDLE and FAR characters from this one on, a byte each; 0 for held-out texts.
BLOCKS = "block bigint, key bigint, at bigint, close bigint, far bigint, cells bigint"


def _rows(t: _Texts, block: np.ndarray, text: np.ndarray, at: np.ndarray, codes: tuple[np.ndarray, ...], cells: np.ndarray | int = 0) -> pd.DataFrame:
    return pd.DataFrame({"block": block, "key": t.keys[text], "at": (at << 32) + t.n[text], **dict(zip(("close", "far"), codes)), "cells": cells})


def _shown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Held-out texts -> the blocks of all windows."""
    for t, _ in _slices(batches):
        text, at = t.windows()
        level = _level(t.n)[text]
        yield _rows(t, _blocks(t.hash[t.start[text] + at], at // (1 << level - 1), level), text, at, t.codes(text, at))


def _placed(t: _Texts, text: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which, blocks): the blocks of segments of train texts, at each level and rough position where a partner may have them."""
    low, high = _level(-(-t.n * (100 - EDITS) // 100))[text], _level(t.n * 100 // (100 - EDITS))[text]
    hashes, tau = t.hash[t.start[text] + at], _tau(t.n)[text]
    for level, meant in ((low, np.ones(len(text), bool)), (high, high > low)):
        width = 1 << level - 1
        first, last = np.maximum(at - tau, 0) // width, (at + tau) // width
        for k in range(int((last - first).max(initial=-1)) + 1):
            which = np.flatnonzero(meant & (first + k <= last))
            yield which, _blocks(hashes[which], (first + k)[which], level[which])


def rarest(t: _Texts, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, position) of t + 1 or more disjoint segments of each text whose counts have the least sum.

    Exact within pieces of PIECE characters or up to twice as many, each of which gives its part of the segments, so the
    cost is linear in the length of a text.
    """
    pieces = np.maximum(1, t.n // PIECE)
    text = np.repeat(np.arange(len(t.n)), pieces)
    k = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin, end = k * t.n[text] // pieces[text], (k + 1) * t.n[text] // pieces[text]
    size, wanted = end - begin, -(-(end - begin) * (_tau(t.n)[text] + 1) // t.n[text])
    cost = counts[t.cells(slice(None))].astype(np.float32) + 1
    order, out = np.argsort(size, kind="stable"), []
    for s in range(0, len(order), SIDE_BY_SIDE):
        o = order[s : s + SIDE_BY_SIDE]
        long, most, every = int(size[o].max()), int(wanted[o].max()), np.arange(len(o))
        c = cost[np.minimum((t.start[text[o]] + begin[o])[:, None] + np.arange(long), len(cost) - 1)]
        c[np.arange(long) > (size[o] - Q)[:, None]] = np.inf
        # best[i, x, j]: least sum of j disjoint segments among the first i characters of piece x.
        best = np.full((long + 1, len(o), most + 1), np.inf, np.float32)
        best[:, :, 0] = 0
        for i in range(Q, long + 1):
            best[i] = best[i - 1]
            np.minimum(best[i, :, 1:], best[i - Q, :, :-1] + c[:, i - Q, None], out=best[i, :, 1:])
        i, left = np.full(len(o), long), wanted[o].copy()
        while (x := every[left > 0]).size:
            taken = best[i[x], x, left[x]] != best[i[x] - 1, x, left[x]]
            hit = x[taken]
            i[hit] -= Q
            left[hit] -= 1
            out.append((text[o[hit]], begin[o[hit]] + i[hit]))
            i[x[~taken]] -= 1
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _counted(texts: DataFrame) -> np.ndarray:
    """How many windows of the texts fall into each of 2^CELL_BITS cells. Tasks send their table in parts, which are summed by part."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(1 << CELL_BITS, np.int64)
        for t, _ in _slices(batches):
            text, at = t.windows()
            table += np.bincount(t.cells(t.start[text] + at), minlength=len(table))
        if table.any():
            yield pd.DataFrame({"part": np.arange(len(table) // PART), "counts": [x.tobytes() for x in table.reshape(-1, PART)]})

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b["part"], b["counts"]):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int64)
        yield pd.DataFrame({"part": list(sums), "counts": [x.tobytes() for x in sums.values()]}).astype({"part": "int64"})

    kind = "part bigint, counts binary"
    parts = texts.select("key", "gt").mapInPandas(partial, kind).repartition("part").mapInPandas(total, kind).collect()  # 4 MB at any size
    table = np.zeros(1 << CELL_BITS, np.int64)
    for r in parts:
        table[r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["counts"], np.int64)
    return table


def _chosen(texts: DataFrame, counts: np.ndarray) -> DataFrame:
    """Rows of two kinds: of each train text the positions of its segments (key, gt, places), and of blocks that many held-out windows may have (block, t, h) how many train rows and at most how many held-out ones they have."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)  # 4 MB

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t, gt in _slices(batches, lambda b: {"gt": b["gt"].to_numpy()}):
            text, at = rarest(t, shared.value)
            order = np.lexsort((at, text))
            text, at = text[order], at[order]
            places = np.split(at.astype(np.int32), np.cumsum(np.bincount(text, minlength=len(t.n)))[:-1])
            yield pd.DataFrame({"key": t.keys, "gt": gt["gt"], "places": places, "block": pd.array([None] * len(t.n), "Int64"), "t": pd.array([None] * len(t.n), "Int64"), "h": pd.array([None] * len(t.n), "Int64")})
            held = shared.value[t.cells(t.start[text] + at)]
            often = held > ROWS_PER_SALT
            if often.any():
                text, at, held = text[often], at[often], held[often]
                found = [(b, held[which]) for which, b in _placed(t, text, at)]
                b, h = (np.concatenate(x) for x in zip(*found))
                block, first, n = np.unique(b, return_index=True, return_counts=True)
                none = [None] * len(block)
                yield pd.DataFrame({"key": pd.array(none, "Int64"), "gt": none, "places": none, "block": pd.array(block, "Int64"), "t": pd.array(n, "Int64"), "h": pd.array(h[first], "Int64")})

    return texts.select("key", "gt").mapInPandas(run, "key bigint, gt string, places array<int>, block bigint, t bigint, h bigint")


def cells(t: _Texts, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each segment the other segments of its text that begin within NEAR, MIDDLE and FAR characters after it on the ring."""
    apart = 2 * int(t.n.max()) + FAR
    here = text * apart + at
    ring = np.sort(np.concatenate([here, here + t.n[text]]))
    return sum((np.searchsorted(ring, here + r, "left") - np.searchsorted(ring, here, "right")) << 8 * k for k, r in enumerate((NEAR, MIDDLE, FAR)))


def _sought(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Train texts with the places chosen -> the blocks of these segments."""
    for t, more in _slices(batches, lambda b: {"places": b["places"].tolist()}):
        text, at = np.repeat(np.arange(len(t.n)), [len(p) for p in more["places"]]), np.concatenate(more["places"]).astype(np.int64)
        codes, others = t.codes(text, at), cells(t, text, at)
        for which, block in _placed(t, text, at):
            yield _rows(t, block, text[which], at[which], tuple(c[which] for c in codes), others[which])


def close(a: Column, b: Column) -> Column:
    """Whether two texts differ by at most EDITS in 100 characters of the longer one; the band of that width decides it."""
    most = F.floor(F.greatest(F.char_length(a), F.char_length(b)) * EDITS / 100).cast("int")
    return F.call_function("levenshtein", a, b, most) >= 0


def _salted(rows: DataFrame, hot: DataFrame, own: str, other: str) -> DataFrame:
    """Rows with salts a and b: hot blocks get one salt by the row's key and the other in every value; blocks not hot get 0."""
    wide = rows.join(hot, rows["block"] == hot["__hot"], "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("st", "sh")})
    mine, each = F.pmod(F.xxhash64("key"), F.col(own)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    return wide.withColumn("a", mine if own == "st" else each).withColumn("b", mine if own == "sh" else each).drop("__hot", "st", "sh")


def _place(c: str) -> Column:
    return F.shiftright(F.col(c), 32)


def _size(c: str) -> Column:
    return F.col(c).bitwiseAND(0xFFFFFFFF)


def _met(sought: DataFrame, shown: DataFrame) -> DataFrame:
    """(t_key, h_key): texts that agree in a segment and, from it on, are no farther apart than the edits allowed."""
    on = [c for c in sought.columns if c in ("block", "a", "b")]
    side = lambda df, x, *more: df.select(*on, *[F.col(c).alias(f"{x}_{c}") for c in ("key", "at", "close", "far", *more)])
    edits = F.floor(F.greatest(_size("t_at"), _size("h_at")) * EDITS / 100)
    left, right = F.abs(_place("t_at") - _place("h_at")), F.abs((_size("t_at") - _place("t_at")) - (_size("h_at") - _place("h_at")))
    differ = lambda c: F.col(f"t_{c}").bitwiseXOR(F.col(f"h_{c}"))
    most = lambda k: F.shiftright("t_cells", 8 * k).bitwiseAND(255) * 2
    near = (
        (F.bit_count(F.shiftrightunsigned(differ("close"), 32)) <= most(0)) & (F.bit_count(differ("close").bitwiseAND(0xFFFFFFFF)) <= most(1)) & (F.bit_count(differ("far")) <= most(2))
        & (left + right <= edits) & (F.col("t_key") != F.col("h_key"))
    )
    return side(sought, "t", "cells").join(side(shown, "h"), on).filter(near).select("t_key", "h_key").distinct()


def near_texts(texts: DataFrame) -> DataFrame:
    """(train, held): md5 of different gt texts within the limit.

    texts: (key, md5, gt, in_train, in_held), each gt once, of at least LEAST characters. Two texts of one 64-bit key
    are both verified, so a collision loses nothing. Blocks and texts with many partners are cut into pieces.
    """
    held = texts.filter("in_held")
    made = materialize(_chosen(texts.filter("in_train"), _counted(held)))
    sought = made.filter("key IS NOT NULL").select("key", "gt", "places").mapInPandas(_sought, BLOCKS)
    shown = held.select("key", "gt").mapInPandas(_shown, BLOCKS)
    often = materialize(made.filter("block IS NOT NULL").groupBy("block").agg(F.sum("t").alias("t"), F.max("h").alias("h")).withColumn("n", F.col("t").cast("double") * F.col("h")))
    hot = skew.hot_keys(often, least=ROWS_PER_SALT**2)
    hot = hot.select(F.col("block").alias("__hot"), skew.salts(F.col("t"), ROWS_PER_SALT).alias("st"), skew.salts(F.col("h"), ROWS_PER_SALT).alias("sh"))
    if not hot.isEmpty():
        sought, shown = _salted(sought, F.broadcast(hot), "st", "sh"), _salted(shown, F.broadcast(hot), "sh", "st")
    return _verified(materialize(_met(sought, shown)), texts)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(train, held): the pairs within the edit distance."""
    hot = lambda c: skew.hot_keys(pairs.groupBy(c).agg(F.count("*").alias("n")))
    side = lambda s: texts.filter(f"in_{s}").select(F.col("key").alias(f"{s[0]}_key"), F.col("md5").alias(s), F.col("gt").alias(f"{s}_gt"))
    both = skew.spread(skew.spread(pairs, side("train"), "t_key", hot("t_key"), ["h_key"]), side("held"), "h_key", hot("h_key"), ["t_key"])
    return both.filter((F.col("train") != F.col("held")) & close(F.col("train_gt"), F.col("held_gt"))).select("train", "held").distinct()


def _sides(keys: DataFrame) -> DataFrame:
    """(id, held, key) -> (train id, held id) of equal keys. Hot keys are cut into a grid of salts on both sides."""
    counts = keys.groupBy("key").agg(F.count_if(~F.col("held")).alias("nt"), F.count_if("held").alias("nh"), F.count("*").alias("n"))
    hot = skew.hot_keys(counts, least=ROWS_PER_SALT).select("key", skew.salts(F.col("nt"), ROWS_PER_SALT).alias("st"), skew.salts(F.col("nh"), ROWS_PER_SALT).alias("sh"))
    rows = keys.join(F.broadcast(hot), "key", "left").na.fill(1, ["st", "sh"])
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    train = rows.filter(~F.col("held")).select("key", F.col("id").alias("train"), own("st").alias("a"), each("sh").alias("b"))
    held = rows.filter("held").select("key", F.col("id").alias("held_id"), each("st").alias("a"), own("sh").alias("b"))
    return train.join(held, ["key", "a", "b"]).select("train", F.col("held_id").alias("held"))


def records(samples: DataFrame) -> DataFrame:
    """The samples in one notation: id, split, source, held, doc, images, gt and its md5 where it takes part."""
    rows = samples.select(
        notation.record_id(F.col("id")).alias("id"), notation.split(F.col("split")).alias("split"), notation.label(F.col("source")).alias("source"), notation.document_id(F.col("document_id")).alias("doc"),
        F.array_compact(F.array_distinct(F.array(notation.content_hash(F.col("pixel_hash")), notation.content_hash(F.col("parent_image_hash"))))).alias("images"),
        F.when(F.char_length("gt") >= LEAST, F.col("gt")).alias("gt"),
    )
    return rows.filter(F.col("id").isNotNull()).withColumn("held", F.col("split") != "train").withColumn("md5", F.unhex(F.md5("gt")))


def overlaps(samples: DataFrame) -> DataFrame:
    """(train, held): ids of each train and held-out sample that share a document or an image or have near-equal gt, each pair once.

    Null, empty and placeholder values relate nothing; a null split means train; deliveries of a sample in several rows
    count once; gt shorter than LEAST relates nothing, texts of any length are compared whole. Equal texts are
    compared once and then expanded to the samples that have them. Empty tables give an empty result.
    """
    rows = records(samples)
    named = lambda kind, c: F.unhex(F.md5(F.concat(F.lit(kind), c)))
    keys = F.array_compact(F.concat(F.array(named("d:", F.col("doc"))), F.transform("images", lambda x: named("i:", x)), F.array(named("t:", F.hex("md5")))))
    exact = materialize(rows.select("id", "held", F.explode_outer(keys).alias("key")).filter("key IS NOT NULL").distinct())
    texts = rows.filter(F.col("gt").isNotNull()).groupBy("gt").agg(F.first("md5").alias("md5"), F.bool_or(~F.col("held")).alias("in_train"), F.bool_or("held").alias("in_held"), F.count("*").alias("n"))
    texts = materialize(texts.withColumn("key", F.xxhash64("gt")))
    near = materialize(near_texts(texts))
    # A pair of near texts is a key of its own, which the samples of both texts share.
    ends = near.select(F.posexplode(F.array("train", "held")).alias("__end", "md5"), F.unhex(F.md5(F.concat("train", "held"))).alias("key"))
    members = skew.spread(rows.filter(F.col("md5").isNotNull()).select("id", "held", "md5"), ends, "md5", skew.hot_keys(texts), ["id"])
    near_keys = members.filter(F.col("held").cast("int") == F.col("__end")).select("id", "held", "key").distinct()
    return _sides(exact.unionByName(near_keys)).distinct()


def ordered(pairs: DataFrame) -> DataFrame:
    """(id_a, id_b) with id_a < id_b."""
    return pairs.select(F.least("train", "held").alias("id_a"), F.greatest("train", "held").alias("id_b"))


def report(samples: DataFrame) -> DataFrame:
    """(split, source, held_samples, pairs, train_samples) of the overlaps, by split and source of the held-out sample."""
    found = materialize(overlaps(samples))
    names = records(samples).filter("held").groupBy("id").agg(F.first("split").alias("split"), F.first("source").alias("source"))
    each = found.groupBy("held").agg(F.count("*").alias("n"))
    by = each.join(names, each["held"] == names["id"]).groupBy("split", "source").agg(F.count("*").alias("held_samples"), F.sum("n").alias("pairs"))
    return by
