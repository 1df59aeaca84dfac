"""Distributions of a data set, and their report as a web page."""

from __future__ import annotations

import html
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropmill.functions.text import DELIMITERS
from cropmill.operators.ranking import global_rank
from cropmill.sources.tables import materialize

#: What is counted, bins of a histogram, bars of a chart, rows of the preview, width of a chart in points.
COUNTED = ("task", "source", "domain", "language")
BINS, BARS, PREVIEW, WIDTH = 10, 30, 100, 320


def counts(df: DataFrame, columns: Iterable[str] = COUNTED) -> DataFrame:
    """(field, value, n) of all columns in one pass; null counts as unknown."""
    columns = list(columns)
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("value")) for c in columns])).alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


def top_bars(df: DataFrame, column: str, order: Column) -> DataFrame:
    """(value, n, place) of the BARS values seen first, in the order they were first seen."""
    seen = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("unknown")).alias("value")).agg(F.count("*").alias("n"), F.min(F.struct(order)).alias("__first"))
    first = seen.orderBy("__first", "value").limit(BARS)
    return first.withColumn("place", F.row_number().over(W.orderBy("__first", "value"))).drop("__first")


def histogram(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(field, bin, n): BINS equal bins from 0 to the greatest value (1 if that is 0) of each field; null, NaN and infinite values don't count.

    Fields without a value have no rows, fields with one have all bins.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), v.cast("double").alias("v")) for k, v in values.items()])).alias("x")).select("x.*").filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    top = long.groupBy("field").agg(F.max("v").alias("hi")).withColumn("hi", F.when(F.col("hi") == 0, 1.0).otherwise(F.col("hi")))
    at = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), (F.col("v") / F.col("hi") * BINS).cast("int")))
    found = long.join(F.broadcast(top), "field").groupBy("field", at.alias("bin")).agg(F.count("*").alias("n"))
    every = top.select("field", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("bin"))
    return every.join(found, ["field", "bin"], "left").select("field", "bin", F.coalesce("n", F.lit(0)).alias("n"))


def scatter(df: DataFrame) -> DataFrame:
    """(id, cx, cy): where a sample with both scores stands on the chart of base against sft."""
    s = df.filter(F.col("signals.base_score").isNotNull() & F.col("signals.sft_score").isNotNull())
    return s.select("id", F.round(30 + 300 * F.col("signals.base_score"), 2).alias("cx"), F.round(310 - 300 * F.col("signals.sft_score"), 2).alias("cy"))


def exclusion_reasons(pending: DataFrame) -> DataFrame:
    return pending.groupBy(F.coalesce("reason", F.lit("unknown")).alias("reason")).agg(F.count("*").alias("n"))


def pages(df: DataFrame, order: list[Column], page_size: int) -> DataFrame:
    """The rows with their page, from 0, in a total order."""
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    return global_rank(df, order, materialize, name="__at").withColumn("page", F.floor((F.col("__at") - 1) / page_size)).drop("__at")


def badges(rows: DataFrame) -> DataFrame:
    """(id, candidate_id, badge): which answers of a paired sample were chosen and rejected."""
    each = rows.select("id", "pair_audit", F.explode("candidates").alias("c"))
    badge = F.when(F.col("c.id") == F.col("pair_audit.chosen_id"), "chosen").when(F.col("c.id") == F.col("pair_audit.rejected_id"), "rejected").otherwise("")
    return each.select("id", F.col("c.id").alias("candidate_id"), badge.alias("badge"))


def _bars(title: str, items: list[tuple[str, int]]) -> str:
    most = max((n for _, n in items), default=1) or 1
    lines = [f'<text x="0" y="{27 * i + 21}">{html.escape(str(k))[:100]}</text><rect x="205" y="{27 * i + 5}" width="{n / most * WIDTH:.2f}" height="20"/><text x="{210 + n / most * WIDTH:.2f}" y="{27 * i + 21}">{n}</text>' for i, (k, n) in enumerate(items[:BARS])]
    return f'<section><h2>{html.escape(title)}</h2><svg viewBox="0 0 600 {max(60, 27 * len(lines) + 10)}">{"".join(lines)}</svg></section>'


#: Titles of charts: measured signals, and features of tables.
SIGNALS = ("base_score", "sft_score", "regression", "candidate_gap", "disagreement")
FEATURES = ("cells", "merged_cells", "rows", "columns")


def _arrival(df: DataFrame) -> Column:
    """What says in which order rows came: their position, else the order they were read in, else their id."""
    return F.struct(F.col(next((c for c in ("position", "_ord") if c in df.columns), "id")))


def _distributions(df: DataFrame, when: str) -> str:
    out = ""
    for c in (c for c in COUNTED if c in df.columns):
        out += _bars(f"{c} ({when})", [(r["value"], r["n"]) for r in top_bars(df, c, _arrival(df)).orderBy("place").collect()])
    return out


def _histograms(df: DataFrame) -> str:
    signals = df.schema["signals"].dataType.fieldNames() if "signals" in df.columns else []
    values = {s: F.col(f"signals.{s}") for s in SIGNALS if s in signals}
    if "target" in df.columns:
        values["gt_length"] = F.coalesce(F.char_length("target"), F.lit(0))
    features = df.schema["table_features"].dataType if "table_features" in df.columns else None
    values |= {f"table_{f}": F.col(f"table_features.{f}") for f in FEATURES if isinstance(features, T.StructType) and f in features.names}
    bins: dict[str, list] = {k: [] for k in values}
    if values:
        for r in histogram(df, values).orderBy("field", "bin").collect():
            bins[r["field"]].append((str(r["bin"]), r["n"]))
    return "".join(_bars(k, v) for k, v in bins.items())


def _scatter(df: DataFrame) -> str:
    """Dots of base against sft; dots that fall on one place of the grid of the chart are drawn once, so their number is bounded."""
    signals = df.schema["signals"].dataType.fieldNames() if "signals" in df.columns else []
    dots = []
    if {"base_score", "sft_score"} <= set(signals):
        at = [F.round(c).cast("int").alias(c) for c in ("cx", "cy")]
        dots = scatter(df).groupBy(*at).agg(F.count("*").alias("n"), F.min(F.col("id").cast("string")).alias("id")).orderBy("cx", "cy").collect()  # at most 301 x 301
    marks = "".join(f'<circle cx="{r["cx"]}" cy="{r["cy"]}" r="2" opacity="0.4"><title>{html.escape(str(r["id"]))} ({r["n"]})</title></circle>' for r in dots)
    return f'<section><h2>base against sft</h2><svg viewBox="0 0 340 340"><path d="M30 10V310H330M30 310L330 10" fill="none" stroke="#999"/>{marks}</svg></section>'


def render(rows: DataFrame, pending: DataFrame, title: str = "Data report", before: DataFrame | None = None, sample_pages: int = 0) -> str:
    """A web page that needs nothing else: distributions before and after selection, histograms, the chart of both models, reasons and a preview of what is pending, in order of arrival. All text is escaped.

    Only aggregates and PREVIEW rows reach the driver. Without `before`, what was there before is `rows`.
    """
    had = rows if before is None else before
    links = " ".join(f'<a href="samples-{i + 1}.html">{i + 1}</a>' for i in range(sample_pages))
    body = f"<p>before {had.count()}, after {rows.count()}, pending {pending.count()}</p><nav>{links}</nav>"
    body += _distributions(had, "before") + _distributions(rows, "after") + _histograms(had)
    reasons = exclusion_reasons(pending).orderBy(F.col("n").desc(), "reason").limit(BARS).collect()
    body += _bars("reasons", [(r["reason"], r["n"]) for r in reasons]) + _scatter(had)
    first = pending.orderBy(_arrival(pending), "reason").select("id", "reason").limit(PREVIEW).collect()
    preview = "\n".join(f"{r['id']}\t{r['reason']}" for r in first)
    return f'<!doctype html><html><meta charset="utf-8"><title>{html.escape(title)}</title><body><h1>{html.escape(title)}</h1>{body}<pre>{html.escape(preview)}</pre></body></html>'


def render_content(task: str | None, text: str | None) -> str:
    """A truth or an answer as HTML: a table as its canonical form, a formula as MathML where the converter is installed, and always the escaped text."""
    from cropmill.functions import grid

    raw = f"<pre>{html.escape(text or '')}</pre>"
    if not text:
        return raw
    if task == "formula":
        return _mathml(text) + raw
    if task != "table":
        return raw
    try:
        return grid.canonical(text) + raw
    except grid.GridError as e:
        return f"<small>{html.escape(str(e))}</small>{raw}"


#: Attributes that MathML may carry here; all others are dropped.
MATHML_ATTRIBUTES = frozenset("display mathvariant stretchy fence separator accent accentunder columnalign rowspacing columnspacing linethickness displaystyle scriptlevel width height depth lspace rspace encoding".split())
MATHML = "http://www.w3.org/1998/Math/MathML"


def clean_mathml(markup: str) -> str:
    """MathML with nothing but its own elements and MATHML_ATTRIBUTES; ValueError for any other element."""
    import xml.etree.ElementTree as ET

    root = ET.fromstring(markup)
    for node in root.iter():
        if not str(node.tag).startswith(f"{{{MATHML}}}"):
            raise ValueError("an element that is not MathML")
        node.attrib = {k: v for k, v in node.attrib.items() if k in MATHML_ATTRIBUTES}
    ET.register_namespace("", MATHML)
    return ET.tostring(root, encoding="unicode")


def _mathml(text: str) -> str:
    try:
        from latex2mathml.converter import convert
    except ImportError:
        return ""
    plain = text.strip()
    for left, right in DELIMITERS:
        if plain.startswith(left) and plain.endswith(right) and len(plain) >= len(left) + len(right):
            plain = plain[len(left) : len(plain) - len(right)].strip()
            break
    try:
        return clean_mathml(convert(plain))
    except Exception as e:  # the text itself is shown in any case
        return f"<small>{html.escape(str(e))}</small>"


def sample_pages(rows: DataFrame, order: list[Column], page_size: int) -> DataFrame:
    """(page, html): the samples side by side with their answers, page_size on a page; a page is one group."""
    has = set(rows.columns)
    audit = F.col("pair_audit") if "pair_audit" in has else F.lit(None).cast("struct<chosen_id:string,rejected_id:string>")
    badge = lambda c: F.when(c["id"] == audit["chosen_id"], "chosen").when(c["id"] == audit["rejected_id"], "rejected").otherwise("")
    answers = F.transform(F.coalesce("candidates", F.array()), lambda c: F.struct(c["role"].alias("role"), c["kind"].alias("kind"), c["text"].alias("text"), badge(c).alias("badge")))
    slim = rows.select(F.col("id").cast("string").alias("id"), "task", F.col("target").alias("gt"), answers.alias("answers"), *[c for c in rows.columns if c not in ("id", "task", "gt", "answers") and any(str(o) == c for o in order)])

    def render_page(group: pd.DataFrame) -> pd.DataFrame:
        body = ""
        for r in group.to_dict("records"):
            cells = f"<section><h3>truth</h3>{render_content(r['task'], r['gt'])}</section>"
            for a in r["answers"]:
                cells += f"<section><h3>{html.escape(' '.join(str(a[k] or '') for k in ('role', 'kind', 'badge')))}</h3>{render_content(r['task'], a['text'])}</section>"
            body += f"<article><h2>{html.escape(str(r['id']))} - {html.escape(str(r['task']))}</h2>{cells}</article>"
        page = int(group["page"].iloc[0])
        return pd.DataFrame({"page": [page], "html": [f'<!doctype html><html><meta charset="utf-8"><title>Samples {page + 1}</title><body><a href="index.html">index</a>{body}</body></html>']})

    return pages(slim, order, page_size).groupBy("page").applyInPandas(render_page, "page bigint, html string")


def write_report(rows: DataFrame, pending: DataFrame, out: str, order: list[Column], page_size: int, before: DataFrame | None = None) -> int:
    """index.html and samples-N.html in a folder all nodes reach; returns the number of sample pages."""
    from pathlib import Path

    Path(out).mkdir(parents=True, exist_ok=True)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for page, text in zip(b["page"], b["html"]):
                Path(out, f"samples-{page + 1}.html").write_text(text, encoding="utf-8")
            yield b[["page"]]

    n = sample_pages(rows, order, page_size).mapInPandas(write, "page bigint").count()
    Path(out, "index.html").write_text(render(rows, pending, before=before, sample_pages=n), encoding="utf-8")
    return n
