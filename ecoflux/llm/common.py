"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoflux.session import written  # a general helper, passed on

__all__ = ["ASCII_SPACE", "ASCII_UPPER", "ascii_lower", "narrowed", "packed", "table", "text_bytes", "text_key", "unpacked", "utf8", "word_pieces", "written"]

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_SPACE = " \t\n\x0b\f\r"
#: Bytes of text that a task splits into words at once.
PIECE_BYTES = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would also fold letters beyond ASCII)."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def text_key(c: Column) -> Column:
    """64-bit hash of a text (null as empty). Together with the document id it tells apart
    rows that share an id; rows equal in both are repeats of one document."""
    return F.xxhash64(F.coalesce(c, F.lit("")))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow text column (null as empty) and the row offsets in them."""
    a = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = a.buffers()
    off = np.frombuffer(offsets, np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """Each text of an Arrow column as UTF-8 bytes (null as empty), one at a time."""
    raw, off = utf8(column)
    view = memoryview(np.ascontiguousarray(raw))
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield bytes(view[a:b])


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text (what ASCII white space parts), some at a time, so that a
    very long text is never a list of all its words."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE_BYTES)
        end = gap.start() if gap else len(text)
        yield text[at:end].split()
        at = end


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one message."""
    return struct.pack("<I", len(arrays)) + b"".join(struct.pack("<cQ", a.dtype.char.encode(), a.nbytes) + a.tobytes() for a in arrays)


def unpacked(body: bytes) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<I", body), 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<cQ", body, at)
        out.append(np.frombuffer(body, kind.decode(), size // np.dtype(kind.decode()).itemsize, at + 9))
        at += 9 + size
    return out


def narrowed(a: np.ndarray) -> np.ndarray:
    """Non-negative numbers in the fewest bytes that hold them."""
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)
