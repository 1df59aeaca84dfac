"""JSON and JSONL with the order of rows, image files, and checkpoints."""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropmill.operators.ranking import global_rank
from cropmill.sources import images
from cropmill.sources.tables import materialize


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Rows of a JSONL file with `_ord`, their order, blank lines skipped; a line that is no object is an error.

    Without a schema the row comes as `raw`, a VARIANT, which keeps a missing key apart from a null.
    """
    lines = spark.read.text(path, wholetext=False).select(F.col("value"), F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("_ord"))
    lines = lines.filter(F.trim("value", F.lit(" \t\r")) != "").select("_ord", "value")
    parsed = F.try_parse_json("value")
    checked = lines.withColumn("raw", F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed).otherwise(F.raise_error(F.concat(F.lit("expected an object: "), F.substring("value", 1, 80))).cast("variant")))
    if schema is None:
        return checked.select("_ord", "raw")
    return checked.select("_ord", F.from_json("value", schema).alias("r"), "raw").filter(F.col("raw").isNotNull()).select("_ord", "r.*")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows (`_ord`, raw) of a JSON file whose root is a list of objects; another root or element is an error."""
    whole = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    listed = F.when(F.schema_of_variant("v").startswith("ARRAY"), F.col("v")).otherwise(F.raise_error(F.lit("expected a list of objects")).cast("variant"))
    each = whole.select(F.posexplode(F.variant_get(listed, "$", "array<variant>")).alias("_ord", "raw"))
    return each.withColumn("raw", F.when(F.schema_of_variant("raw").startswith("OBJECT"), F.col("raw")).otherwise(F.raise_error(F.lit("expected an object")).cast("variant")))


def _unfinite(c: Column, kind: T.DataType) -> Column:
    """Whether a value holds a NaN or an infinite number at any depth."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        bad = F.isnan(c) | (F.abs(c) == float("inf"))
    elif isinstance(kind, T.StructType):
        bad = F.lit(False)
        for f in kind.fields:
            if _has_numbers(f.dataType):
                bad = bad | _unfinite(c[f.name], f.dataType)
    elif isinstance(kind, T.ArrayType):
        bad = F.exists(c, lambda x: _unfinite(x, kind.elementType))
    else:
        bad = F.exists(F.map_values(c), lambda x: _unfinite(x, kind.valueType))
    return F.coalesce(bad, F.lit(False))


def _has_numbers(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_numbers(f.dataType) for f in kind.fields)
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType if isinstance(kind, T.MapType) else None
    return _has_numbers(inner) if inner is not None else isinstance(kind, (T.DoubleType, T.FloatType))


def write_jsonl(df: DataFrame, path: str, order: list[Column] | None = None, one_file: bool = False) -> None:
    """One object a line with every column, null where it is null, non-ASCII kept. The committer publishes the folder when it is whole.

    NaN and infinite numbers at any depth are an error.
    """
    ordered = df.orderBy(*order) if order else df
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    for f in df.schema.fields:
        if _has_numbers(f.dataType):
            line = F.when(_unfinite(F.col(f.name), f.dataType), F.raise_error(F.lit(f"{f.name} holds a number that is not finite")).cast("string")).otherwise(line)
    lines = ordered.select(line.alias("value"))
    (lines.coalesce(1) if one_file else lines).write.mode("overwrite").text(path)


def write_json(value: object, path: str) -> None:
    """A small value, pretty, without NaN; the file appears when it is whole."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(f".{target.name}.part")
    part.write_text(json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False) + "\n", encoding="utf-8")
    part.replace(target)


def read_images(spark: SparkSession, path: str, most_bytes: int = 50_000_000) -> DataFrame:
    """(path, length, image_hash, content) of files; content is null beyond most_bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("image_hash"), F.when(F.col("length") <= most_bytes, F.col("content")).alias("content"))


def _pixels(s: pd.Series) -> pd.DataFrame:
    out = []
    for content in s:
        try:
            pixels = images.rgb(content)
            out.append((images.pixel_digest(pixels), [pixels.shape[1], pixels.shape[0]], None))
        except Exception as e:
            out.append((None, None, str(e)))
    return pd.DataFrame(out, columns=["pixel_hash", "size", "error"])


def pixel_hash(content: Column) -> Column:
    """Struct (pixel_hash, size, error) of image bytes: SHA-256 of size and RGB pixels; the error where they can't be read."""
    return F.pandas_udf(_pixels, "pixel_hash string, size array<int>, error string")(content)


TENSORS = "model string, key string, shape array<int>, dtype string, values array<double>, shard string"
#: Element types of the format, as numpy reads them; BF16 is the upper half of a float.
DTYPES = {"F64": "<f8", "F32": "<f4", "F16": "<f2", "BF16": "<u2", "I64": "<i8", "I32": "<i4", "I16": "<i2", "I8": "<i1", "U8": "<u1", "BOOL": "?"}


def parse_safetensors(data: bytes) -> Iterator[tuple[str, list[int], str, np.ndarray]]:
    """(key, shape, dtype, flat values) of a file: 8 bytes of header size, a JSON header, then the bytes it points into."""
    (size,) = struct.unpack_from("<Q", data)
    if size > len(data) - 8:
        raise ValueError("header exceeds file")
    for key, t in json.loads(data[8 : 8 + size]).items():
        if key == "__metadata__":
            continue
        start, end = t["data_offsets"]
        raw = np.frombuffer(data[8 + size + start : 8 + size + end], DTYPES[t["dtype"]])
        if raw.size != int(np.prod(t["shape"], dtype=np.int64)):
            raise ValueError(f"{key}: bytes don't fit the shape")
        if t["dtype"] == "BF16":
            raw = (raw.astype(np.uint32) << 16).view(np.float32)
        yield key, t["shape"], t["dtype"], raw


def build_safetensors(tensors: list[tuple[str, list[int], str, np.ndarray]]) -> bytes:
    """The bytes of a file; BF16 is rounded to nearest, ties to even."""
    header, body, at = {}, [], 0
    for key, shape, dtype, values in tensors:
        if dtype == "BF16":
            bits = np.asarray(values, np.float32).view(np.uint32).astype(np.uint64)
            raw = ((bits + 0x7FFF + ((bits >> 16) & 1)) >> 16).astype("<u2").tobytes()
        else:
            raw = np.asarray(values).astype(DTYPES[dtype]).tobytes()
        header[key] = {"dtype": dtype, "shape": [int(n) for n in shape], "data_offsets": [at, at + len(raw)]}
        body.append(raw)
        at += len(raw)
    head = json.dumps(header).encode()
    head += b" " * (-len(head) % 8)
    return struct.pack("<Q", len(head)) + head + b"".join(body)


def read_checkpoints(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """TENSORS of the *.safetensors files of models {name: folder}; a file is read by one task.

    Where a folder has an index its weight map must be what the shards hold, key by key, else it is an error.
    """
    from cropmill.operators.tensors import map_problems

    out = None
    for model, path in paths.items():
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.safetensors").load(path).select("path", "content")

        def run(batches: Iterator[pd.DataFrame], model: str = model) -> Iterator[pd.DataFrame]:
            for b in batches:
                for p, content in zip(b["path"], b["content"]):
                    for key, shape, dtype, values in parse_safetensors(content):
                        yield pd.DataFrame({"model": [model], "key": [key], "shape": [list(shape)], "dtype": [dtype], "values": [values.astype(np.float64)], "shard": [p.rsplit("/", 1)[-1]]})

        own = files.mapInPandas(run, TENSORS)
        for index in Path(path).glob("*.safetensors.index.json"):
            listed = spark.createDataFrame(list(json.loads(index.read_text())["weight_map"].items()), "key string, shard string")
            if wrong := map_problems(listed, own).take(3):
                raise ValueError(f"{index}: the index and the shards don't agree: {wrong}")
        out = own if out is None else out.unionByName(own)
    return out


def beside_weights(path: str) -> tuple[dict, dict[str, str]]:
    """(configuration, {name: digest} of the other files) of a model's folder."""
    folder = Path(path)
    own = {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in sorted(folder.iterdir()) if f.is_file() and f.suffix != ".safetensors"}
    config = folder / "config.json"
    return (json.loads(config.read_text()) if config.exists() else {}), own


def write_checkpoint(tensors: DataFrame, path: str, most_bytes: int, metadata: dict | None = None) -> dict:
    """Write (key, shape, dtype, values) as shards of at most `most_bytes` and an index; the folder appears when it is whole.

    Shards are packed in order of keys and written by one task each into a folder beside the target, which is read
    back and compared before it is renamed. An existing target is an error. Returns the index.
    """
    from cropmill.operators.tensors import BYTES, shards

    target = Path(path)
    if target.exists():
        raise FileExistsError(path)
    part = target.with_name(f".{target.name}.part")
    part.mkdir(parents=True)
    width = F.lit(None).cast("int")
    for kind, n in BYTES.items():
        width = F.when(F.col("dtype") == kind, n).otherwise(width)
    sized = tensors.withColumn("bytes", F.size("values") * width)
    placed = sized.join(shards(sized.select("key", "bytes"), most_bytes).select("key", "shard"), "key")
    folder = str(part)

    def write(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        name = f"model-{int(group['shard'].iloc[0]) + 1:05d}.safetensors"
        data = build_safetensors([(k, list(s), d, np.asarray(v, np.float64)) for k, s, d, v in zip(group["key"], group["shape"], group["dtype"], group["values"])])
        Path(folder, name).write_bytes(data)
        back = {k: s for k, s, *_ in parse_safetensors(Path(folder, name).read_bytes())}
        if sorted(back) != sorted(group["key"]):
            raise OSError(f"{name} doesn't read back")
        return pd.DataFrame({"key": group["key"], "shard": name, "bytes": group["bytes"]})

    rows = placed.groupBy("shard").applyInPandas(write, "key string, shard string, bytes bigint").collect()
    index = {"metadata": {"total_size": sum(r["bytes"] for r in rows), **(metadata or {})}, "weight_map": {r["key"]: r["shard"] for r in sorted(rows)}}
    (part / "model.safetensors.index.json").write_text(json.dumps(index, indent=2))
    part.replace(target)
    return index


def with_image_hashes(rows: DataFrame, base: str, column: str = "image", data: dict | None = None) -> DataFrame:
    """Append image_hash (of the file), pixel_hash (of size and RGB pixels) and image_error.

    Relative paths start from data.image_root, else `base`; the folder must be reachable from all executors. URLs are
    downloaded within data.image_timeout, once with data.image_cache; files beyond data.max_image_bytes and images that
    can't be read have an error and no pixel_hash.
    """
    data = data or {}
    root, limits = data.get("image_root") or base, {"timeout": data.get("image_timeout", 60), "most_bytes": data.get("max_image_bytes", 50_000_000), "cache": data.get("image_cache")}

    def one(value):
        if not value:
            return None, None, "no image"
        try:
            content = images.fetch(images.locate(value, root), **limits)
        except (OSError, ValueError) as e:
            return None, None, str(e) if isinstance(e, ValueError) else type(e).__name__
        digest = hashlib.sha256(content).hexdigest()
        try:
            return digest, images.pixel_digest(images.rgb(content)), None
        except Exception as e:
            return digest, None, str(e)

    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(v) for v in s], columns=["image_hash", "pixel_hash", "image_error"])

    hashed = F.pandas_udf(run, "image_hash string, pixel_hash string, image_error string")(F.col(column))
    return rows.withColumn("__h", hashed).withColumns({k: F.col(f"__h.{k}") for k in ("image_hash", "pixel_hash", "image_error")}).drop("__h")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a JSON list, of JSONL, or of a folder of JSONL files, with inferred columns and `_ord`, their order (files by name).

    Columns that no row has a value in are absent; missing and null are one. A root that is no list, and a line or
    element that is no object, is an error.
    """
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()
    lines = folder or path.endswith(".jsonl")
    if not lines:
        head = spark.read.text(path, wholetext=True).select(F.ltrim("value").startswith("[")).first()
        if head is None or not head[0]:
            raise ValueError(f"{path}: expected a list of objects")
    df = spark.read.option("dropFieldIfAllNull", True).option("multiLine", not lines).json(path)
    if "_corrupt_record" in df.columns:
        raise ValueError(f"{path}: expected objects")
    if not folder:
        return df.withColumn("_ord", F.monotonically_increasing_id())
    if "_ord" in df.columns:  # written by a stage, with the order it had
        return df
    placed = df.withColumn("__file", F.col("_metadata.file_path")).withColumn("__at", F.monotonically_increasing_id())
    return global_rank(materialize(placed), [F.col("__file"), F.col("__at")], materialize, name="_ord").drop("__file", "__at")
