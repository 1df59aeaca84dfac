"""Page export that resumes: which pages still have to be made, and which results nothing asks for."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from pathlib import Path, PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cropmill.sources.files import write_json

#: Suffixes of page images.
SUFFIXES = ("png", "jpg", "jpeg", "bmp", "webp", "tif", "tiff")
STATUS = "stem string, key string, status string, markdown string, markdown_hash string, json string, assets map<string,binary>, error string"


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def check_inputs(inputs: DataFrame, path: str = "image") -> DataFrame:
    """The inputs with stem and `problem`: unsupported suffix, or a stem that comes twice."""
    suffix = F.lower(F.regexp_extract(F.col(path), r"\.([^./]*)$", 1))
    named = inputs.withColumn("stem", stem(F.col(path)))
    twice = F.count("*").over(W.partitionBy("stem")) > 1
    return named.withColumn("problem", F.when(~suffix.isin(*SUFFIXES), "unsupported suffix").when(twice, "stem not unique"))


def page_key(revision: str, content_hash: Column) -> Column:
    """What a page's result depends on."""
    return F.sha2(F.concat(F.lit(revision + "\n"), content_hash), 256)


def open_pages(inputs: DataFrame, done: DataFrame) -> DataFrame:
    """Inputs (stem, key) without a good result of the same key whose text is still what was hashed; done: STATUS."""
    good = done.filter((F.col("status") == "ok") & F.col("markdown_hash").eqNullSafe(F.sha2("markdown", 256)))
    return inputs.join(good.select("stem", "key").distinct(), ["stem", "key"], "left_anti")


def stale_pages(inputs: DataFrame, done: DataFrame) -> DataFrame:
    """Stems of results that no input has."""
    return done.select("stem").distinct().join(inputs.select("stem").distinct(), "stem", "left_anti")


def export(todo: DataFrame, parse: Callable[[dict], str | dict]) -> DataFrame:
    """STATUS of each page (stem, key, ...), parsed by the function given; a page that fails has its error and stops no other.

    parse gives the text, or a dict of markdown, json (any value) and assets ({relative name: bytes}). In the text the
    names of assets are replaced by where write_pages puts them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                try:
                    made = parse(r)
                    made = made if isinstance(made, dict) else {"markdown": made}
                    md, assets = made["markdown"], made.get("assets") or {}
                    for name in sorted(assets, key=len, reverse=True):
                        if PurePosixPath(name).is_absolute() or ".." in PurePosixPath(name).parts:
                            raise ValueError(f"asset outside its folder: {name}")
                        md = md.replace(name, f"assets/{r['stem']}/{name}")
                    value = json.dumps(made["json"], ensure_ascii=False) if "json" in made else None
                    out.append((r["stem"], r["key"], "ok", md, hashlib.sha256(md.encode()).hexdigest(), value, assets, None))
                except Exception as e:  # a page's own failure
                    out.append((r["stem"], r["key"], "error", None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in STATUS.split(", ")])

    return todo.mapInPandas(run, STATUS)


def write_pages(done: DataFrame, folder: str) -> dict:
    """Write each good page into a folder all nodes reach, each file whole or not at all: <stem>.md, <stem>.json, assets/<stem>/..., and manifest.json of all pages by status, which is returned."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def put(target: Path, data: bytes) -> None:
            target.parent.mkdir(parents=True, exist_ok=True)
            part = target.with_name(f".{target.name}.part")
            part.write_bytes(data)
            part.replace(target)

        root = Path(folder)
        for b in batches:
            for r in b.to_dict("records"):
                for name, data in dict(r["assets"] or {}).items():
                    put(root / "assets" / r["stem"] / name, data)
                if r["json"] is not None:
                    put(root / f"{r['stem']}.json", r["json"].encode())
                put(root / f"{r['stem']}.md", r["markdown"].encode())
            yield b[["stem"]]

    written = done.filter("status = 'ok'").select("stem", "markdown", "json", "assets").mapInPandas(run, "stem string").count()
    by = {r["status"]: r["n"] for r in done.groupBy("status").agg(F.count("*").alias("n")).collect()}
    manifest = {"pages": sum(by.values()), "written": written, "by_status": by, "status": "complete" if set(by) <= {"ok"} else "partial"}
    write_json(manifest, str(Path(folder, "manifest.json")))
    return manifest
