"""Answers of models: which requests a data set needs, which of them are cached, and asking for the rest."""

from __future__ import annotations

import base64
import hashlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmill.config import scrub
from cropmill.functions.text import json_string
from cropmill.sources import images

#: A provider takes a request (dict) and returns (text, finish_reason); it raises Retry or Fatal.
Provider = Callable[[dict], tuple[str, str | None]]
ANSWER = "id string, status string, text string, finish_reason string, error string, attempts int"
#: Status codes of the 400s that may pass, and the longest pause between attempts.
PASSING, LONGEST_PAUSE = (408, 429), 8


class Retry(Exception):
    """A failure that may pass."""


class Fatal(Exception):
    """A failure that won't."""


def failure_of(status: int, message: str = "") -> Exception:
    """Which kind of failure an HTTP status is."""
    return Fatal(f"HTTP {status} {message}") if 400 <= status < 500 and status not in PASSING else Retry(f"HTTP {status} {message}")


def parameters(config: dict, sampling: bool) -> dict:
    o = config["inference"]
    return {"temperature": o["temperature"] if sampling else 0, "top_p": o["top_p"] if sampling else 1.0, "max_tokens": o["max_tokens"]}


def fan_out(rows: DataFrame, config: dict, sampling: bool = False) -> DataFrame:
    """(sample_id, role, kind, index, prompt, seed, image_hash): one greedy request of each model, or `samples` of the sft model."""
    roles, n = (["sft"], config["inference"]["samples"]) if sampling else (["base", "sft"], 1)
    prompt = F.lit(None).cast("string")
    for task, words in config["prompts"].items():
        prompt = F.when(F.col("task") == task, words).otherwise(prompt)
    jobs = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(i).alias("index")) for r in roles for i in range(n)])
    each = rows.select(F.col("id").alias("sample_id"), "image_hash", prompt.alias("prompt"), F.explode(jobs).alias("j"))
    return each.select("sample_id", "j.role", F.lit("sample" if sampling else "greedy").alias("kind"), "j.index", "prompt", (F.lit(config["seed"]) + F.col("j.index")).alias("seed"), "image_hash")


def request_key(config: dict, endpoints: dict[str, dict], sampling: bool) -> Column:
    """The digest of all that an answer depends on: image, model, revision, endpoint, prompt, parameters, seed, kind and index.

    What is constant for a role is written as JSON once on the driver, with marks where the columns go.
    """
    out = F.lit(None).cast("string")
    for role, e in endpoints.items():
        missing = [k for k in ("base_url", "model", "revision") if not e.get(k)]
        if missing:
            raise ValueError(f"models.{role}.{missing[0]} is required")
        marks = {"image": "@image@", "prompt": "@prompt@", "index": "@index@", "seed": "@seed@"}
        identity = {"image": marks["image"], "model": e["model"], "revision": e["revision"], "endpoint": e["base_url"], "prompt": marks["prompt"], "params": parameters(config, sampling) | {"seed": marks["seed"]}, "preprocess": config["inference"]["preprocess"], "extra_body": e.get("extra_body", {}), "kind": "sample" if sampling else "greedy", "index": marks["index"]}
        text = F.lit(json.dumps(identity, sort_keys=True, ensure_ascii=False))
        for name, value in (("image", json_string(F.col("image_hash"))), ("prompt", json_string(F.col("prompt"))), ("index", F.col("index").cast("string")), ("seed", F.col("seed").cast("string"))):
            text = F.replace(text, F.lit(f'"{marks[name]}"'), value)
        out = F.when(F.col("role") == role, F.sha2(text, 256)).otherwise(out)
    return out


def requests(rows: DataFrame, config: dict, endpoints: dict[str, dict], sampling: bool = False) -> DataFrame:
    return fan_out(rows, config, sampling).withColumn("id", request_key(config, endpoints, sampling))


def misses(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests without a good answer in the cache (id, status, ...), each once; failed answers are asked again."""
    return wanted.dropDuplicates(["id"]).join(cache.filter(F.col("status") == "ok").select("id").distinct(), "id", "left_anti")


def ask(wanted: DataFrame, provider: Provider, config: dict, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """Answers (ANSWER) to requests, asked partition by partition with retries; a request that fails has status transport_error.

    Materialise the result before reading it twice: it is evaluated, and so asked, once an action.
    """
    retries = config["inference"]["retries"]

    def one(request: dict) -> dict:
        error = ""
        for attempt in range(retries + 1):
            try:
                text, finish = provider(request)
                if not isinstance(text, str):
                    raise Retry("answer is no text")
                return {"id": request["id"], "status": "ok", "text": text, "finish_reason": finish, "error": None, "attempts": attempt + 1}
            except Fatal as e:
                error = str(e)
                break
            except Retry as e:
                error = str(e)
                if attempt < retries:
                    pause(min(2**attempt, LONGEST_PAUSE))
        return {"id": request["id"], "status": "transport_error", "text": "", "finish_reason": None, "error": error, "attempts": attempt + 1}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [one(r) for r in batch.to_dict("records")]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in ANSWER.split(", ")])

    return wanted.mapInPandas(run, ANSWER)


def attach(rows: DataFrame, wanted: DataFrame, answers: DataFrame, sampling: bool = False) -> DataFrame:
    """The rows with `candidates` from their answers, in the order of role and index; with sampling the greedy ones already there come first."""
    given = wanted.join(answers.drop("error", "attempts") if "error" in answers.columns else answers, "id")
    kind = "array<struct<id:string,text:string,role:string,index:int,kind:string,status:string,finish_reason:string,prompt:string>>"
    each = F.array_sort(F.collect_list(F.struct("role", "index", F.struct("id", "text", "role", F.col("index").cast("int").alias("index"), "kind", "status", "finish_reason", "prompt").alias("c"))))
    new = given.groupBy("sample_id").agg(F.transform(each, lambda x: x["c"]).cast(kind).alias("__new"))
    joined = rows.join(new, rows["id"] == new["sample_id"], "left").drop("sample_id").withColumn("__new", F.coalesce("__new", F.array().cast(kind)))
    if sampling and "candidates" in rows.columns:
        before = F.transform(F.filter("candidates", lambda c: c["kind"] == "greedy"), lambda c: F.struct(*[c[f].alias(f) for f in ("id", "text", "role", "index", "kind", "status", "finish_reason", "prompt")])).cast(kind)
        joined = joined.withColumn("__new", F.concat(F.coalesce(before, F.array().cast(kind)), "__new"))
    return joined.drop("candidates").withColumnRenamed("__new", "candidates")


def changed_provenance(rows: DataFrame, config: dict, endpoints: dict[str, dict] | None = None) -> DataFrame:
    """(id): rows whose greedy answers were asked with another prompt, image, model or revision than the present ones; sampling on top of them would mix.

    image, model and revision are compared where the answers carry them.
    """
    prompt = F.lit(None).cast("string")
    for task, words in config["prompts"].items():
        prompt = F.when(F.col("task") == task, words).otherwise(prompt)
    has = rows.schema["candidates"].dataType.elementType.fieldNames()

    def other(c: Column) -> Column:
        bad = ~c["prompt"].eqNullSafe(prompt)
        if "image_hash" in has and "image_hash" in rows.columns:
            bad = bad | (c["image_hash"].isNotNull() & ~c["image_hash"].eqNullSafe(F.col("image_hash")))
        for field in ("model", "revision"):
            if field in has:
                for role, e in (endpoints or {}).items():
                    bad = bad | ((c["role"] == role) & c[field].isNotNull() & (c[field] != F.lit(str(e.get(field)))))
        return (c["kind"] == "greedy") & bad

    return rows.filter(F.exists("candidates", other)).select("id")


def role_liveness(rows: DataFrame) -> DataFrame:
    """(role, alive): whether any answer of a model is good."""
    return rows.select(F.explode("candidates").alias("c")).groupBy("c.role").agg(F.bool_or(F.coalesce(F.col("c.status") == "ok", F.lit(False))).alias("alive"))


def prepare_images(rows: DataFrame, base: str, preprocess: dict, data: dict | None = None) -> DataFrame:
    """(id, image_hash, picture, error): the PNG that is sent to a model: RGB, no side above preprocess.max_side.

    The file must still have the image_hash of its row, else the error says that it changed.
    """
    data = data or {}
    root, limits = data.get("image_root") or base, {"timeout": data.get("image_timeout", 60), "most_bytes": data.get("max_image_bytes", 50_000_000), "cache": data.get("image_cache")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for ident, place, known in zip(b["id"], b["image"], b["image_hash"]):
                try:
                    content = images.fetch(images.locate(place, root), **limits)
                    if hashlib.sha256(content).hexdigest() != known:
                        raise ValueError("image changed since it was imported")
                    out.append((ident, known, images.png(images.shrink(images.rgb(content), preprocess.get("max_side"))), None))
                except Exception as e:
                    out.append((ident, known, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["id", "image_hash", "picture", "error"])

    return rows.select(F.col("id").cast("string").alias("id"), "image", "image_hash").mapInPandas(run, "id string, image_hash string, picture binary, error string")


def post(url: str, body: dict, key: str | None, timeout: float) -> dict:
    """The JSON answer of a server; Retry or Fatal for what went wrong. The key is sent, never told."""
    head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
    try:
        with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), head), timeout=timeout) as answer:
            return json.loads(answer.read())
    except urllib.error.HTTPError as e:
        raise failure_of(e.code, scrub(e.read(500).decode(errors="replace"), key)) from None
    except (OSError, ValueError) as e:
        raise Retry(scrub(f"{type(e).__name__}: {e}", key)) from None


def chat(endpoint: dict, content: list[dict], options: dict, timeout: float) -> tuple[str, str | None]:
    """(text, finish reason) of one user message at a chat-completions server."""
    body = {"model": endpoint["model"], "messages": [{"role": "user", "content": content}], **options, **endpoint.get("extra_body", {})}
    answer = post(endpoint["base_url"].rstrip("/") + "/chat/completions", body, endpoint.get("api_key"), timeout)
    try:
        choice = answer["choices"][0]
        return choice["message"]["content"], choice.get("finish_reason")
    except (KeyError, IndexError, TypeError):
        raise Retry("answer without a choice") from None


def http_provider(config: dict, endpoints: dict[str, dict], picture: Callable[[dict], bytes]) -> Provider:
    """A provider that asks chat-completions servers: the prompt with the picture that `picture` gives for a request."""
    timeout = config["inference"]["timeout"]

    def ask_one(request: dict) -> tuple[str, str | None]:
        image = {"type": "image_url", "image_url": {"url": "data:image/png;base64," + base64.b64encode(picture(request)).decode()}}
        options = parameters(config, request["kind"] == "sample") | {"seed": int(request["seed"])}
        return chat(endpoints[request["role"]], [image, {"type": "text", "text": request["prompt"]}], options, timeout)

    return ask_one


class VisionClient:
    """A model that is asked for tables and for reviews, with retries; its `ask` fits the synthesis loop."""

    def __init__(self, endpoint: dict, retries: int = 3, timeout: float = 180, max_tokens: int = 4096, temperature: float = 0.2, pause: Callable[[float], None] = time.sleep) -> None:
        if not plain_endpoint(endpoint["base_url"]):
            raise ValueError("base_url: http(s) with a host, without credentials, query and fragment")
        self.endpoint, self.retries, self.timeout, self.pause = endpoint, retries, timeout, pause
        self.options = {"max_tokens": max_tokens, "temperature": temperature}

    def ask(self, prompt: str, *pictures: bytes) -> tuple[str, str | None]:
        content = [{"type": "image_url", "image_url": {"url": "data:image/png;base64," + base64.b64encode(p).decode()}} for p in pictures]
        for attempt in range(self.retries + 1):
            try:
                return chat(self.endpoint, [*content, {"type": "text", "text": prompt}], self.options, self.timeout)
            except Retry:
                if attempt == self.retries:
                    raise
                self.pause(min(2**attempt, LONGEST_PAUSE))
        raise AssertionError


def plain_endpoint(url: str) -> bool:
    """Whether a URL is http(s) with a host and without credentials, query and fragment."""
    try:
        u = urlsplit(url)
        return u.scheme in ("http", "https") and bool(u.hostname) and u.username is None and u.password is None and not u.query and not u.fragment
    except ValueError:
        return False
