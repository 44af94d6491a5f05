"""Helpers shared by the text operators: whole-text tokens and hashes in tasks,
row packing, and settings of the Arrow exchange.

Words of the ``space`` class are the maximal runs of characters outside
``[\\x20\\x09-\\x0D]``; words of the ``alnum`` class are runs of ASCII letters and
digits and of all other non-punctuation characters.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch; texts are a few KB, so a batch stays at a few MB.
BATCH_ROWS = 1000
#: Bytes of text a task hashes at once (a longer single text is one piece).
PIECE_BYTES = 2 << 20

WORD_SQL = r"[^\\x20\\x09-\\x0D]+"

_RNG = np.random.Generator(np.random.PCG64(20240117))
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SHINGLE_R = np.uint64(0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_NOT_ALNUM = np.ones(256, bool)
_NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of one Arrow batch (texts can be long)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is planned and written inside the block; they
    are as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def limited_batches(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows inside the block."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


def pack(df: DataFrame) -> DataFrame:
    """One struct column ``_row`` holding every column, so that columns an
    operator adds cannot clash with the caller's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def unpack(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


#: A lean worker gives freed arrays of this size back at once.
LEAN_BYTES = 1 << 20
#: Inside reused_memory: the size below which freed arrays stay, and what may stay at the end of the heap.
REUSED_BYTES, KEPT_BYTES = 16 << 20, 64 << 20
_MMAP_THRESHOLD, _TRIM_THRESHOLD = -3, -1  # options of mallopt
_LEAN: list[bool] = []
_TABLES: dict = {}


def worker_table(key: Hashable, build: Callable[[], object]):
    """The large table ``key`` of this Python worker, built once and kept for its
    later tasks.  A worker serves the stages of all operators, so it holds one
    table at a time."""
    if key not in _TABLES:
        _drop_tables()
        _TABLES[key] = build()
    return _TABLES[key]


def _malloc(call: str, *values: int) -> None:
    """A setting of the GNU C library's allocator; another library has none."""
    try:
        getattr(ctypes.CDLL(None), call)(*values)
    except (OSError, AttributeError):
        pass


def _drop_tables() -> None:
    if not _TABLES:
        return
    _TABLES.clear()
    _malloc("malloc_trim", 0)


def lean_memory(keep: Hashable = None) -> None:
    """Let this Python worker give large freed arrays back to the system at once,
    and the table that another operator left in it (all but ``keep``).
    Workers are kept for later tasks, and by default also what they once held."""
    if keep not in _TABLES:
        _drop_tables()
    if _LEAN:
        return
    _LEAN.append(True)
    pa.set_memory_pool(pa.system_memory_pool())
    _malloc("mallopt", _MMAP_THRESHOLD, LEAN_BYTES)


@contextmanager
def reused_memory() -> Iterator[None]:
    """Inside the block, arrays of up to REUSED_BYTES take the place of freed ones:
    for work that makes the same arrays again and again, fresh pages cost more
    than the work itself.  At its end all is lean again and what is free given back."""
    _malloc("mallopt", _MMAP_THRESHOLD, REUSED_BYTES)
    _malloc("mallopt", _TRIM_THRESHOLD, KEPT_BYTES)
    try:
        yield
    finally:
        _malloc("mallopt", _MMAP_THRESHOLD, LEAN_BYTES)
        _malloc("mallopt", _TRIM_THRESHOLD, 128 << 10)
        _malloc("malloc_trim", 0)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a polynomial hash is usable."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["up"]) < n:
        size = max(n, PIECE_BYTES + 1)
        if size > 4 * PIECE_BYTES:  # a giant text: do not keep its tables
            return _powers(_R, n), _powers(_R_INV, n)
        _POW["up"], _POW["down"] = _powers(_R, size), _powers(_R_INV, size)
    return _POW["up"][:n], _POW["down"][:n]


def _fold_alnum(buf: np.ndarray) -> np.ndarray:
    """Lower-case Latin-1 letters and blank the general punctuation block
    (U+2000 - U+203F), on UTF-8 bytes."""
    out = _LOWER[buf]
    if len(buf) > 2 and (buf >= 0xC3).any():
        after_c3 = np.zeros(len(buf), bool)
        after_c3[1:] = buf[:-1] == 0xC3
        up = after_c3 & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)
        out[up] += 32
        at = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x80))
        for d in range(3):
            out[at + d] = 32
    return out


def word_hashes(texts: list[bytes], kind: str = "space") -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of ``texts`` in order, and
    the word offsets of each text (``len(texts) + 1``).

    Every byte has a fixed random value; a word's hash is the polynomial of its
    byte values, read off one running sum over the whole buffer.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    # One separator after each text keeps words from running into the next one.
    buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    low = _LOWER[buf] if kind == "space" else _fold_alnum(buf)
    gap = (_SPACE if kind == "space" else _NOT_ALNUM)[low]
    if len(buf) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=np.int8(1)))
    start, end = edge[0::2], edge[1::2]  # the last byte is always a gap
    up, down = _power_tables(len(buf))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[low] * up, out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    text_end = np.cumsum(lengths + 1)
    offsets = np.concatenate([[0], np.searchsorted(start, text_end)])
    return hashes, offsets


def pieces(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of at most ``limit`` bytes together (one text at least)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, texts[first:]


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words of one text (fewer words: none)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out = out * _SHINGLE_R + words[j : j + n]
    return mix(out)
