"""Image files: where they are, their bytes, and their pixels.

Pillow reads any format where it is installed. Without it PNG (8 bits a channel, not interlaced) and binary PPM and PGM are
read here; any other image is an error, as a hash of the file would not know the same pixels in another file again.
"""

from __future__ import annotations

import hashlib
import os
import struct
import urllib.request
import zlib
from io import BytesIO
from pathlib import Path

import numpy as np


def locate(value: str, base: str) -> str:
    """A URL as it is; `~` is the home folder, and relative paths start from `base`."""
    return value if value.startswith(("http://", "https://")) else str(Path(base).expanduser() / Path(value).expanduser())


def fetch(place: str, timeout: float = 60, most_bytes: int = 50_000_000, cache: str | None = None) -> bytes:
    """The bytes of a file or URL; ValueError beyond most_bytes. With a cache folder a URL is downloaded once and kept under its digest."""
    if not place.startswith(("http://", "https://")):
        if os.path.getsize(place) > most_bytes:
            raise ValueError(f"image exceeds {most_bytes} bytes")
        return Path(place).read_bytes()
    kept = Path(cache, hashlib.sha256(place.encode()).hexdigest()) if cache else None
    if kept and kept.exists():
        return kept.read_bytes()
    with urllib.request.urlopen(place, timeout=timeout) as answer:
        data = answer.read(most_bytes + 1)
    if len(data) > most_bytes:
        raise ValueError(f"image exceeds {most_bytes} bytes")
    if kept:
        kept.parent.mkdir(parents=True, exist_ok=True)
        part = kept.with_name(f"{kept.name}.{os.getpid()}.part")
        part.write_bytes(data)
        part.replace(kept)
    return data


def _png(data: bytes) -> np.ndarray:
    at, body, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        at += 12 + size
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(part)
    if head is None or head[2] != 8 or head[6] != 0 or head[3] not in (0, 2, 3, 4, 6):
        raise ValueError("this PNG needs Pillow")
    width, height, _, color = head[:4]
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    stride = width * channels
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, stride + 1)
    out = np.zeros((height, stride), np.uint8)
    above = np.zeros(stride, np.uint8)
    for y in range(height):
        how, line = lines[y, 0], lines[y, 1:]
        if how == 2:
            line = line + above
        elif how == 1:
            line = np.cumsum(line.reshape(width, channels), 0, dtype=np.uint8).reshape(-1)
        elif how in (3, 4):
            done = bytearray(line.tobytes())
            up = above.tobytes()
            for x in range(stride):
                a, b = done[x - channels] if x >= channels else 0, up[x]
                if how == 3:
                    guess = (a + b) // 2
                else:
                    c = up[x - channels] if x >= channels else 0
                    p = a + b - c
                    guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                done[x] = (done[x] + guess) & 255
            line = np.frombuffer(bytes(done), np.uint8)
        out[y] = above = line
    image = out.reshape(height, width, channels)
    if color == 3:
        return palette[image[:, :, 0]]
    return np.repeat(image[:, :, :1], 3, 2) if color in (0, 4) else image[:, :, :3]


def _netpbm(data: bytes) -> np.ndarray:
    words, at = [], 2
    while len(words) < 3:
        while data[at : at + 1].isspace():
            at += 1
        end = at
        while not data[end : end + 1].isspace():
            end += 1
        words.append(int(data[at:end]))
        at = end
    width, height, top = words
    if top != 255:
        raise ValueError("this image needs Pillow")
    channels = 3 if data[1:2] == b"6" else 1
    image = np.frombuffer(data, np.uint8, width * height * channels, at + 1).reshape(height, width, channels)
    return image if channels == 3 else np.repeat(image, 3, 2)


def rgb(data: bytes) -> np.ndarray:
    """Height x width x 3 bytes; ValueError for what can't be read."""
    try:
        from PIL import Image
    except ImportError:
        Image = None
    if Image is not None:
        with Image.open(BytesIO(data)) as im:
            return np.asarray(im.convert("RGB"))
    if data.startswith(b"\x89PNG\r\n\x1a\n"):
        return _png(data)
    if data[:2] in (b"P5", b"P6"):
        return _netpbm(data)
    raise ValueError("Pillow is needed to read this image")


def pixel_digest(pixels: np.ndarray) -> str:
    """SHA-256 of size and RGB pixels."""
    height, width = pixels.shape[:2]
    return hashlib.sha256(str((width, height)).encode() + np.ascontiguousarray(pixels).tobytes()).hexdigest()


def png(pixels: np.ndarray) -> bytes:
    """RGB pixels as a PNG."""
    height, width = pixels.shape[:2]
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = np.hstack([np.zeros((height, 1), np.uint8), np.ascontiguousarray(pixels, np.uint8).reshape(height, width * 3)])
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def shrink(pixels: np.ndarray, max_side: int | None) -> np.ndarray:
    """The pixels so that no side exceeds max_side: by Pillow's Lanczos filter, else by the mean of the area under each new pixel."""
    height, width = pixels.shape[:2]
    if not max_side or max(height, width) <= max_side:
        return pixels
    h, w = (max(1, round(n * max_side / max(height, width))) for n in (height, width))
    try:
        from PIL import Image
    except ImportError:
        return _mean(_mean(pixels.astype(float), h).swapaxes(0, 1), w).swapaxes(0, 1).round().astype(np.uint8)
    return np.asarray(Image.fromarray(pixels).resize((w, h), Image.Resampling.LANCZOS))


def _mean(values: np.ndarray, n: int) -> np.ndarray:
    """The first axis as n cells, each the mean of the area it covers."""
    edges = np.linspace(0, len(values), n + 1)
    sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, 0)])
    low = np.minimum(edges.astype(int), len(values) - 1)
    at = sums[low] + values[low] * (edges - low).reshape(-1, *[1] * (values.ndim - 1))
    return np.diff(at, axis=0) / (len(values) / n)
