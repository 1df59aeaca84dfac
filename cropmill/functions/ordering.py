"""Orders that decide: which row is first, which is taken."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cropmill.functions.text import digest_list, unit_hash


def hash_order(seed: int, ident: Column) -> Column:
    """The pseudo-random place of a record in [0, 1): the digest of [seed, id]."""
    return unit_hash(digest_list(seed, ident))


def hash_split(seed: int, source: Column, document: Column, fraction: float) -> Column:
    """eval for the part `fraction` of (source, document), else train; whole documents go one way."""
    return F.when(unit_hash(digest_list(seed, source, document)) < fraction, "eval").otherwise("train")
