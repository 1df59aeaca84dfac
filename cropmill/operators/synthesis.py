"""Synthetic tables: templates, their validity, seeded variants, and quality control of rendered records."""

from __future__ import annotations

import json
import random
import re
from collections.abc import Callable, Iterator
from html import escape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropmill.functions import grid
from cropmill.functions.text import NUMERIC_CELL, digest
from cropmill.operators.isolate import is_train, isolate
from cropmill.operators.mine import trusted

#: Bounds of a template, and variants a family may have.
MOST_ROWS, MOST_COLUMNS, WIDTHS, FONTS, MOST_VARIANTS = 300, 40, (400, 1800), (10, 30), 100
TEMPLATE = "version int, template_family_id string, seed_sample_id string, document_id string, source string, domain string, split string, title string, seed_html string, rows int, columns int, cells array<struct<row:int,col:int,rowspan:int,colspan:int,text:string>>, header_rows int, style struct<width:int,font_size:int>"
_NUMBER = re.compile(NUMERIC_CELL)


def template(family: str, sample: str, value: str, **more) -> dict:
    """A template from a table."""
    g = grid.parse(value)
    base = {"version": 1, "template_family_id": family, "seed_sample_id": sample, "document_id": sample, "source": "user", "domain": "private", "split": "train", "title": "Synthetic table", "header_rows": 1}
    return base | {"seed_html": grid.to_html(g), "rows": g.rows, "columns": g.columns, "cells": [c._asdict() for c in g.cells], "style": {"width": min(1400, max(700, g.columns * 140)), "font_size": 15}} | more


def builtin_templates() -> list[dict]:
    """Four families of tables that need no seed: merged header, dense numbers, wrapped text, joint spans."""
    row = lambda cells: "<tr>" + "".join(c if c.startswith("<td") else f"<td>{escape(c)}</td>" for c in cells) + "</tr>"
    table = lambda rows: "<table>" + "".join(map(row, rows)) + "</table>"
    merged = [['<td rowspan="2">Region</td>', '<td colspan="2">This year</td>', '<td colspan="2">Last year</td>'], ["Volume", "Share", "Volume", "Share"]]
    merged += [[name, f"{a:,.2f}", f"{b:.1f}%", f"{a * 0.9:,.2f}", f"{b - 1:.1f}%"] for name, a, b in (("North", 8412.5, 31.2), ("South", 6120.75, 24.8), ("East", 9034.1, 27.5), ("West", 3011.4, 16.5))]
    dense = [["Part", *(f"Week {i}" for i in range(1, 7)), "Change"]]
    dense += [[f"P-{400 + i}", *(f"{(i + 2) * 61.3 + k * 17.9:,.2f}" for k in range(6)), f"{i - 6:+.1f}%"] for i in range(14)]
    wrap = [["No.", "Property", "Requirement", "Finding"]]
    wrap += [[str(i), a, b, "met"] for i, (a, b) in enumerate([("Storage temperature", "from 5 to 40 °C, for at least 72 hours, without loss of function"), ("Interchange of data", "records in UTF-8, with decimal points, brackets and percent signs kept"), ("Continuous use", "no unplanned stop within 30 days; logs kept for 90 days"), ("Recovery", "after a lost connection all records not yet confirmed are sent again")], 1)]
    spans = [['<td rowspan="2" colspan="2">Group</td>', '<td colspan="3">Mean</td>'], ["Day 1", "Day 5", "Day 9"]]
    for name in ("Control", "Low dose", "High dose"):
        spans += [[*([f'<td rowspan="2">{name}</td>'] if k == 0 else []), f"Run {k + 1}", *(f"{10 + k + d:.2f}" for d in range(3))] for k in range(2)]
    families = (("merged_header", merged, 2), ("dense_numbers", dense, 1), ("wrapped_text", wrap, 1), ("joint_spans", spans, 2))
    return [template(name, f"builtin:{name}", table(rows), document_id=f"synthetic-builtin:{name}", source="synthetic_demo", header_rows=header) for name, rows, header in families]


def problem(t: dict) -> str | None:
    """Why a template must not be used; None if it may."""
    if t["version"] != 1 or (t["split"] or "train") != "train":
        return "not a training template"
    rows, columns = t["rows"] or 0, t["columns"] or 0
    if not (1 <= rows <= MOST_ROWS and 1 <= columns <= MOST_COLUMNS):
        return "grid out of bounds"
    slots: set[tuple[int, int]] = set()
    for c in t["cells"]:
        area = [(r, k) for r in range(c["row"], c["row"] + c["rowspan"]) for k in range(c["col"], c["col"] + c["colspan"])]
        if c["text"] is None or not area or any(not (0 <= r < rows and 0 <= k < columns) for r, k in area):
            return "cell out of bounds"
        if slots & set(area):
            return "overlapping cells"
        slots.update(area)
    if len(slots) != rows * columns:
        return "incomplete grid"
    if not 0 <= t["header_rows"] <= rows:
        return "header out of bounds"
    if not (WIDTHS[0] <= t["style"]["width"] <= WIDTHS[1] and FONTS[0] <= t["style"]["font_size"] <= FONTS[1]):
        return "style out of bounds"
    own = grid.Grid(tuple(grid.Cell(*(c[k] for k in ("row", "col", "rowspan", "colspan", "text"))) for c in t["cells"]), rows, columns)
    try:
        if grid.canonical(t["seed_html"]) != grid.to_html(own):
            return "cells differ from seed"
        grid.to_otsl(own)
    except grid.GridError as e:
        return str(e)
    return None


def variant(t: dict, index: int, seed: int) -> tuple[list[dict], dict]:
    """(cells, style) of a variant: numbers of the body outside the first column move by up to a quarter, variant 0 keeps them.

    The generator is seeded by family, index and seed, so a variant can be made again anywhere.
    """
    if why := problem(t):
        raise ValueError(why)
    rng = random.Random(digest([t["template_family_id"], index, seed]))
    cells = []
    for c in t["cells"]:
        text = c["text"]
        m = _NUMBER.fullmatch(text) if index and c["row"] >= t["header_rows"] and c["col"] > 0 else None
        if m:
            value = float(text.rstrip("%").replace(",", "")) * rng.uniform(0.75, 1.25)
            text = f"{value:{',' if ',' in text else ''}.{max(0, len(m[3] or '.') - 1)}f}{m[4] or ''}"
        cells.append({**c, "text": text})
    odd = index % 2 == 1
    style = {**t["style"], "font_size": t["style"]["font_size"] - odd, "padding": 7 if odd else 10, "rule": "light" if odd else "full", "stripe": not odd}
    return cells, style


def _rows(batch: pd.DataFrame) -> list[dict]:
    return [{**r, "cells": [dict(c) if not isinstance(c, dict) else c for c in (r["cells"] if r["cells"] is not None else [])]} for r in batch.to_dict("records")]


def check_templates(templates: DataFrame) -> DataFrame:
    """(template_family_id, problem) of each template."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"template_family_id": b["template_family_id"], "problem": [problem(t) for t in _rows(b)]})

    return templates.mapInPandas(run, "template_family_id string, problem string")


def variants(templates: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """(template_family_id, index, html, otsl, style) of n variants of each valid template."""
    if not 1 <= n <= MOST_VARIANTS:
        raise ValueError(f"1 to {MOST_VARIANTS} variants")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t in _rows(b):
                if problem(t):
                    continue
                for i in range(n):
                    cells, style = variant(t, i, seed)
                    g = grid.Grid(tuple(grid.Cell(*(c[k] for k in ("row", "col", "rowspan", "colspan", "text"))) for c in cells), t["rows"], t["columns"])
                    out.append((t["template_family_id"], i, grid.to_html(g), grid.to_otsl(g), json.dumps(style, sort_keys=True)))
            yield pd.DataFrame(out, columns=["template_family_id", "index", "html", "otsl", "style"])

    return templates.mapInPandas(run, "template_family_id string, index int, html string, otsl string, style string")


def seed_reason(rows: DataFrame) -> Column:
    """Why a row can't seed a template; null if it may."""
    return F.when(~F.coalesce(F.col("task") == "table", F.lit(False)), "v1_table_only").when(~is_train(rows) | ~trusted(), "held_out_or_untrusted_seed").when(F.col("gt").isNull(), "missing table GT")


def make_templates(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(templates, rejected (id, reason)) from isolated table samples."""
    isolated = isolate(rows, order)
    judged = isolated.withColumn("reason", F.coalesce("reason", seed_reason(isolated)))
    names = [x.split()[0] for x in re.split(r", (?=\w+ )", TEMPLATE)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                try:
                    canon = grid.canonical(r["gt"])
                    t = template("seed-" + digest([r["id"], canon])[:16], r["id"], canon, document_id=r["document_id"] or r["id"], source=r["source"] or "user", domain=r["domain"] or "private")
                    out.append([r["id"], None, *(t[k] for k in names)])
                except grid.GridError as e:
                    out.append([r["id"], str(e), *([None] * len(names))])
            yield pd.DataFrame(out, columns=["__id", "__reason", *names]).astype({k: "Int32" for k in ("version", "rows", "columns", "header_rows")})

    made = judged.filter("reason IS NULL").select("id", "gt", "document_id", "source", "domain").mapInPandas(run, f"__id string, __reason string, {TEMPLATE}")
    bad = judged.filter("reason IS NOT NULL").select("id", "reason").unionByName(made.filter("__reason IS NOT NULL").select(F.col("__id").alias("id"), F.col("__reason").alias("reason")))
    return made.filter("__reason IS NULL").drop("__id", "__reason"), bad


def check_records(records: DataFrame, order: list[Column]) -> DataFrame:
    """The records with `reason`, null when accepted: the first failing check of hash, annotation, quality status; then, of accepted ones, a repeated image.

    Needs html, otsl, split, qa.status, image_hash and actual_hash (of the file as it is).
    """
    h, o = grid.describe_column(F.col("html")), grid.describe_column(F.col("otsl"))
    judged = records.withColumn("__h", h["canonical"]).withColumn("__o", o["canonical"])
    reason = (
        F.when(~F.col("actual_hash").eqNullSafe(F.col("image_hash")), "image hash mismatch")
        .when(F.col("__h").isNull() | ~F.col("__h").eqNullSafe(F.col("__o")), "HTML/OTSL mismatch")
        .when(~F.coalesce((F.col("split") == "train") & (F.col("qa.status") == "passed"), F.lit(False)), "held-out or failed render QA")
    )
    judged = judged.withColumn("reason", reason)
    again = F.row_number().over(W.partitionBy("image_hash", F.col("reason").isNull()).orderBy(*order)) > 1
    return judged.withColumn("reason", F.when(F.col("reason").isNull() & again, "duplicate image").otherwise(F.col("reason"))).drop("__h", "__o")


def reply_object(reply: str, finish: str | None) -> dict:
    """The JSON object of a model's reply, with or without a code fence; only a finished reply counts."""
    if finish != "stop":
        raise ValueError("reply was cut off")
    m = re.fullmatch(r"\s*```(?:json)?\s*(.*?)\s*```\s*", reply, re.S)
    value = json.loads(m[1] if m else reply)
    if not isinstance(value, dict):
        raise ValueError("reply is no object")
    return value


def page_html(table: str, title: str, style: dict, header_rows: int = 0) -> str:
    """The page a renderer shoots."""
    css = f"body{{width:{style['width']}px;font-size:{style['font_size']}px;margin:20px}}td{{border:1px solid #222;padding:{style.get('padding', 8)}px}}tr:nth-child(-n+{header_rows}){{font-weight:bold}}"
    return f'<!doctype html><html><head><meta charset="utf-8"><style>{css}</style></head><body><h1>{escape(title)}</h1>{table}</body></html>'


def template_from_reply(reply: dict, seed: dict, family: str) -> dict:
    """A template from a model's proposal: html, title, header_rows and style of width and font_size, each of its own type; everything else comes from the seed.

    The html is rebuilt from its grid, so nothing of a reply is used as it came. ValueError says what is wrong.
    """
    style = {k: reply["style"][k] for k in ("width", "font_size")}
    if not isinstance(reply["title"], str) or any(type(v) is not int for v in (*style.values(), reply["header_rows"])):
        raise ValueError("title, header_rows or style of another type")
    of_seed = {k: seed.get(k) for k in ("document_id", "source", "domain") if seed.get(k)}
    made = template(family, str(seed["id"]), reply["html"], title=reply["title"], header_rows=reply["header_rows"], style=style, **of_seed)
    if why := problem(made):
        raise ValueError(why)
    return made


def choose_seeds(rows: DataFrame, order: list[Column], max_seeds: int) -> tuple[DataFrame, DataFrame]:
    """(seeds, rejected (id, reason)): the first max_seeds table samples that may seed, in `order`."""
    why = seed_reason(rows)
    first = rows.filter(why.isNull()).orderBy(*order).limit(max_seeds)
    over = rows.filter(why.isNull()).select("id").join(first.select("id"), "id", "left_anti").withColumn("reason", F.lit("max_seeds budget; input order preserved"))
    return first, rows.filter(why.isNotNull()).select("id", why.alias("reason")).unionByName(over)


AUDIT = "seed_id string, template_index int, attempt int, accepted boolean, issues string, html string, template string"


def run_agent(seeds: DataFrame, propose: Callable[[dict, int, list[str], dict | None], tuple[str, str | None]], review: Callable[[str, bytes | None], tuple[str, str | None]], templates_per_seed: int = 2, repairs: int = 2, renderer: Callable[[str], bytes] | None = None) -> DataFrame:
    """AUDIT of the loop propose, check, render, review, repair; each seed (id, ...) is worked through on its own, seeds in parallel.

    propose(seed, index, issues, start) gives (reply, finish_reason); start is the proposal to go on from: the one just
    refused, else the last accepted one of this seed, else None. A proposal becomes a template, is rendered where a
    renderer (page -> picture) is given, and is accepted when review(html, picture) approves without issues; else the
    issues go into the next attempt, until `repairs` are used. An accepted template is kept as JSON.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for seed in b.to_dict("records"):
                accepted_last = None
                for k in range(templates_per_seed):
                    issues: list[str] = []
                    start = accepted_last
                    for attempt in range(repairs + 1):
                        made, table, accepted = None, None, False
                        try:
                            made = reply_object(*propose(seed, k, issues, start))
                            t = template_from_reply(made, seed, "agent-" + digest([seed["id"], k])[:16])
                            table = t["seed_html"]
                            picture = renderer(page_html(table, t["title"], t["style"], t["header_rows"])) if renderer else None
                            said = reply_object(*review(table, picture))
                            if type(said.get("approved")) is not bool or not isinstance(said.get("issues"), list):
                                raise ValueError("a review holds approved and issues")
                            issues = [str(x) for x in said["issues"]]
                            accepted = said["approved"] and not issues
                            issues = issues or ([] if accepted else ["not approved"])
                        except (ValueError, KeyError, TypeError, OSError, RuntimeError) as e:
                            issues = [str(e)]
                        out.append((seed["id"], k, attempt, accepted, "; ".join(issues), table, json.dumps(t, ensure_ascii=False) if accepted else None))
                        start = made or start
                        if accepted:
                            accepted_last = made
                            break
            yield pd.DataFrame(out, columns=[x.split()[0] for x in AUDIT.split(", ")])

    return seeds.mapInPandas(run, AUDIT)


def agent_result(audit: DataFrame) -> DataFrame:
    """(seed_id, template_index, accepted, html, template, reason): the last attempt of each, with a reason when the repairs were used up."""
    last = audit.groupBy("seed_id", "template_index").agg(F.max(F.struct("attempt", "accepted", "html", "template")).alias("l"))
    return last.select("seed_id", "template_index", F.col("l.accepted").alias("accepted"), "l.html", "l.template", F.when(~F.col("l.accepted"), "repair budget exhausted; see audit").alias("reason"))


def agent_manifest(audit: DataFrame, templates_per_seed: int, seeds: int) -> dict:
    """Numbers of a run of the agent: accepted, pending, attempts, and whether every template came to be."""
    r = agent_result(audit).agg(F.count_if("accepted").alias("generated"), F.count_if(~F.col("accepted")).alias("pending")).first()
    return {"generated": r["generated"], "pending": r["pending"], "seeds": seeds, "attempts": audit.count(), "status": "complete" if r["generated"] == seeds * templates_per_seed else "partial"}


def render_manifest(rendered: DataFrame) -> dict:
    """Numbers of rendered records: generated, failed, families, and whether all came out."""
    r = rendered.agg(F.count_if(F.col("qa.status") == "passed").alias("generated"), F.count_if(~F.col("qa.status").eqNullSafe("passed")).alias("failed"), F.countDistinct("template_family_id").alias("families")).first()
    return {**r.asDict(), "status": "complete" if not r["failed"] else "partial"}


def gallery(rendered: DataFrame, most: int = 200) -> str:
    """A page of rendered records with their tables and OTSL, for the first `most` by id (a preview, so the rest is only counted)."""
    good = rendered.filter(F.col("qa.status") == "passed")
    cards = "".join(
        f'<article><h2>{escape(r["id"])}</h2><img loading="lazy" src="data:image/png;base64,{r["picture"]}"><details><summary>table</summary>{r["html"]}</details><details><summary>OTSL</summary><pre>{escape(r["otsl"])}</pre></details></article>'
        for r in good.orderBy("id").limit(most).select("id", F.base64("image").alias("picture"), "html", "otsl").collect()
    )
    return f'<!doctype html><html><meta charset="utf-8"><title>Synthetic tables</title><body><p>{good.count()} records</p>{cards}</body></html>'


RENDERED = "id string, template_family_id string, index int, html string, otsl string, image binary, image_hash string, split string, qa struct<status:string>, error string"


def render_variants(made: DataFrame, renderer: Callable[[str], bytes]) -> DataFrame:
    """RENDERED records of variants, by a renderer (page -> PNG bytes) that the caller gives; one that fails has its error and failed quality."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for b in batches:
            out = []
            for r in b.to_dict("records"):
                name = f"{r['template_family_id']}-{r['index']}"
                try:
                    image = renderer(page_html(r["html"], name, json.loads(r["style"])))
                    out.append((name, r["template_family_id"], r["index"], r["html"], r["otsl"], image, hashlib.sha256(image).hexdigest(), "train", {"status": "passed"}, None))
                except Exception as e:
                    out.append((name, r["template_family_id"], r["index"], r["html"], r["otsl"], None, None, "train", {"status": "failed"}, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in RENDERED.split(", ")])

    return made.mapInPandas(run, RENDERED)
