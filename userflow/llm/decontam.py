"""Benchmark decontamination: SimHash windows of item size, looked up through
multi-index Hamming blocks, verified by exact weighted-shingle similarity.

A document is cut into words once.  For every item length (in shingles) the
windows of that length get a SimHash; the index holds the items of that length
under the 16-bit blocks of their fingerprints, and probing every block within
its share of the radius finds, by the pigeonhole principle, all items within
that radius.  Each such window is then compared exactly: shingles weighted
by how often they occur, sum of minima over sum of maxima, at least 0.8.

A window that can reach the similarity holds enough shingles of the benchmark
as a whole; windows with fewer are not fingerprinted.  This bound follows from
the similarity itself, so it drops nothing (``prefilter=False`` fingerprints
every window, and the tests compare the two).

Radius: a fingerprint's bit is the sign of a sum of +1 / -1 over shingles.  A
window at the similarity lacks so few of an item's shingles, and has so few
others, that only bits whose sum in the item is small can turn.  Their number is
the item's radius: no window at the similarity lies beyond it.  Items of many
shingles have many such bits, so there the exact check does the work.

The items are broadcast in slices of bounded text size (``SLICE_CHARS``), one
pass over the documents for each slice; workers build the slice's index, and
documents are never shuffled.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.llm.common import (arrow_batches, lean_memory, pack, pieces, shingle_hashes, text_bytes, unpack,
                                  word_hashes, worker_table)
from userflow.session import materialize

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BLOCK_BITS = 16
BLOCKS = 64 // BLOCK_BITS
#: Benchmark text that one broadcast index holds at most (characters).
SLICE_CHARS = 4_000_000
#: Windows fingerprinted at once.
WINDOW_BATCH = 2048


def _hit_type(id_type: str) -> tuple[str, pa.DataType]:
    ids = pa.string() if id_type == "string" else pa.int64()
    return (f"array<struct<item_id: {id_type}, similarity: double, start_word: int, n_words: int, bits: int>>",
            pa.list_(pa.struct([("item_id", ids), ("similarity", pa.float64()), ("start_word", pa.int32()),
                                ("n_words", pa.int32()), ("bits", pa.int32())])))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """+1 / -1 for each of the 64 bits of each hash."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).view(np.int8) * 2 - 1


def _pack_bits(positive: np.ndarray) -> np.ndarray:
    return np.packbits(positive, axis=1).view(np.uint64).ravel()


def radius_for(sums: np.ndarray, n_shingles: int, similarity: float) -> int:
    """Bits within which all windows at the similarity lie of an item whose bits
    have these sums: each shingle that differs moves a sum by one."""
    most = int(2 * n_shingles * (1 - similarity) / (1 + similarity) + 1e-9)
    return int(np.count_nonzero((sums <= most) & (sums > -most) & (most > 0)))


def _block_radii(radius: int) -> list[int]:
    """Radii r_i with sum(r_i + 1) = radius + 1 or just above: if every block
    differed by more than its radius, the whole would differ by more."""
    left = radius + 1
    out = []
    for i in range(BLOCKS):
        share = ceil(left / (BLOCKS - i))
        out.append(share - 1)
        left -= share
    return out


def _flips(radius: int) -> np.ndarray:
    """All BLOCK_BITS-bit masks of at most ``radius`` bits (none for -1)."""
    return np.array([sum(1 << b for b in chosen) for r in range(radius + 1)
                     for chosen in combinations(range(BLOCK_BITS), r)], np.uint64)


def _member(pool: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are in the sorted, non-empty ``pool``."""
    return pool[np.minimum(np.searchsorted(pool, values), len(pool) - 1)] == values


@dataclass
class _Length:
    """The items of one (words per shingle, shingles) size."""

    ids: list = field(default_factory=list)
    prints: list = field(default_factory=list)
    shingles: list = field(default_factory=list)
    pool: np.ndarray | None = None  # all shingles of these items, sorted
    radii: list = field(default_factory=list)  # of each item
    probes: list = field(default_factory=list)  # what each block's value is changed by
    blocks: list = field(default_factory=lambda: [defaultdict(list) for _ in range(BLOCKS)])


class ItemIndex:
    """Fingerprints and shingles of a bounded set of items."""

    def __init__(self, items: list[tuple], k: int, similarity: float, radius: int | None = None):
        self.k, self.similarity = k, similarity
        self.sizes: dict[int, dict[int, _Length]] = defaultdict(lambda: defaultdict(_Length))
        pool: dict[int, list] = defaultdict(list)
        hashes, at = word_hashes([t for _, t in items], "alnum")
        for i, (item_id, _) in enumerate(items):
            words = hashes[at[i] : at[i + 1]]
            if not len(words):
                continue  # nothing to look for
            width = min(k, len(words))
            shingles = shingle_hashes(words, width)
            size = self.sizes[width][len(shingles)]
            sums = _bits(shingles).sum(0, dtype=np.int32)
            print_ = _pack_bits(sums[None, :] > 0)[0]
            size.radii.append(radius_for(sums, len(shingles), similarity) if radius is None else radius)
            for b in range(BLOCKS):
                size.blocks[b][int(print_ >> np.uint64(b * BLOCK_BITS)) & 0xFFFF].append(len(size.ids))
            size.ids.append(item_id)
            size.prints.append(print_)
            size.shingles.append(np.unique(shingles, return_counts=True))
            pool[width].append(shingles)
        self.sizes = {w: dict(v) for w, v in self.sizes.items()}
        for sizes in self.sizes.values():
            for size in sizes.values():
                size.pool = np.unique(np.concatenate([own for own, _ in size.shingles]))
                size.prints = np.array(size.prints, np.uint64)
                size.radii = np.array(size.radii)
                radii = _block_radii(int(size.radii.max()))
                # Fewer items than probes: their blocks are tested, not looked up.
                n_probes = sum(comb(BLOCK_BITS, i) for r in radii for i in range(r + 1))
                size.probes = [] if len(size.ids) <= n_probes else [_flips(r) for r in radii]
        self.pool = {w: np.unique(np.concatenate(v)) for w, v in pool.items()}
        # A bitmap on the top hash bits answers most membership tests.
        self.bitmap = {}
        for w, v in self.pool.items():
            self.bitmap[w] = np.zeros(1 << 20, bool)
            self.bitmap[w][(v >> np.uint64(44)).astype(np.int64)] = True

    def _known(self, width: int, shingles: np.ndarray) -> np.ndarray:
        out = self.bitmap[width][(shingles >> np.uint64(44)).astype(np.int64)]
        maybe = np.flatnonzero(out)
        out[maybe] = _member(self.pool[width], shingles[maybe])
        return out

    def _near(self, size: _Length, window_print: np.uint64) -> list[tuple[int, int]]:
        """(item position, bits) of the items within their radius."""
        if size.probes:
            places = set()
            for b, flips in enumerate(size.probes):
                table = size.blocks[b]
                block = (window_print >> np.uint64(b * BLOCK_BITS)) & np.uint64(0xFFFF)
                for v in (block ^ flips).tolist():
                    places.update(table.get(v, ()))
            at = np.array(sorted(places), np.int64)
        else:
            at = np.arange(len(size.ids))
        bits = np.bitwise_count(size.prints[at] ^ window_print)
        near = np.flatnonzero(bits <= size.radii[at])
        return list(zip(at[near].tolist(), bits[near].tolist()))

    def _windows(self, shingles: np.ndarray, starts: np.ndarray, n: int) -> Iterator[tuple[int, np.uint64]]:
        for i in range(0, len(starts), WINDOW_BATCH):
            some = starts[i : i + WINDOW_BATCH]
            lo, hi = int(some.min()), int(some.max()) + n
            if hi - lo <= 4 * n + 4 * len(some):
                run = np.zeros((hi - lo + 1, 64), np.int32)
                np.cumsum(_bits(shingles[lo:hi]), axis=0, dtype=np.int32, out=run[1:])
                sums = run[some - lo + n] - run[some - lo]
                yield from zip(some.tolist(), _pack_bits(sums > 0))
            else:
                for s in some.tolist():
                    yield s, _pack_bits(_bits(shingles[s : s + n]).sum(0, dtype=np.int32)[None, :] > 0)[0]

    def hits(self, words: np.ndarray, prefilter: bool = True) -> list[dict]:
        """The best window of every item found in one text."""
        best: dict = {}
        for width, sizes in self.sizes.items():
            shingles = shingle_hashes(words, width)
            if not len(shingles):
                continue
            known = self._known(width, shingles)
            if prefilter and not known.any():
                continue
            places = np.flatnonzero(known)
            for m, size in sizes.items():
                n = min(m, len(shingles))  # a text shorter than the item is one window
                # shared / (n + m - shared) >= similarity
                need = ceil(self.similarity * (n + m) / (1 + self.similarity) - 1e-9)
                if need > n:
                    continue
                starts = np.arange(len(shingles) - n + 1)
                if prefilter:
                    if len(places) < need:
                        continue
                    own = places[_member(size.pool, shingles[places])]
                    if len(own) < need:
                        continue
                    starts = starts[np.searchsorted(own, starts + n) - np.searchsorted(own, starts) >= need]
                for start, window_print in self._windows(shingles, starts, n):
                    for j, bits in self._near(size, window_print):
                        score = self._similarity(size.shingles[j], shingles[start : start + n], m)
                        key = size.ids[j]
                        if score >= self.similarity and (key not in best or score > best[key]["similarity"]):
                            best[key] = {"item_id": key, "similarity": score, "start_word": start,
                                         "n_words": n + width - 1, "bits": bits}
        return [best[key] for key in sorted(best, key=lambda x: (x is None, x))]

    @staticmethod
    def _similarity(item: tuple[np.ndarray, np.ndarray], window: np.ndarray, m: int) -> float:
        own, counts = np.unique(window, return_counts=True)
        _, p, q = np.intersect1d(item[0], own, assume_unique=True, return_indices=True)
        shared = int(np.minimum(item[1][p], counts[q]).sum())
        return shared / (m + len(window) - shared)


def _slices(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple]]:
    """(id, text) of the items, in runs of at most ``limit`` characters (one item
    at least); rows stream to the driver one partition at a time."""
    rows = benchmark.select(F.col(id_col).cast(_id_type(benchmark, id_col)).alias("id"), F.col(text_col).alias("t")).where("t is not null")
    held, size = [], 0
    for r in rows.toLocalIterator():
        if held and size + len(r["t"]) > limit:
            yield held
            held, size = [], 0
        held.append((r["id"], r["t"].encode()))
        size += len(r["t"])
    if held:
        yield held


def _id_type(df: DataFrame, column: str) -> str:
    return "long" if isinstance(df.schema[column].dataType, T.IntegralType) else "string"


def _hits_udf(shared, id_type: str, k: int, similarity: float, radius: int | None, prefilter: bool):
    name = uuid.uuid4().hex
    kind, arrow = _hit_type(id_type)

    @F.arrow_udf(kind)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lean_memory(keep=name)
        own = worker_table(name, lambda: ItemIndex(shared.value, k, similarity, radius))
        for batch in batches:
            out = []
            for _, some in pieces(text_bytes(batch)):
                hashes, at = word_hashes(some, "alnum")
                out += [own.hits(hashes[at[i] : at[i + 1]], prefilter) for i in range(len(some))]
            yield pa.array(out, arrow)

    return find.asNondeterministic()  # else a filter on the hits would run it twice


def _passes(slices: Iterator[list[tuple]], spark: SparkSession, step: Callable) -> Iterator[DataFrame]:
    """``step(broadcast items)`` for each slice.  The last result is lazy; each
    earlier one is written and its broadcast dropped, so one slice is held at a time."""
    items = next(slices, None)
    while items is not None:
        shared = spark.sparkContext.broadcast(items)
        following = next(slices, None)
        found = step(shared)
        if following is not None:
            found = materialize(found)
            shared.destroy()
        yield found
        items = following


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", k: int = SHINGLE_WORDS,
               similarity: float = SIMILARITY, radius: int | None = None, prefilter: bool = True,
               slice_chars: int = SLICE_CHARS) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words, bits): one row for each
    document row and benchmark item of which it holds a window that is similar
    enough; the best window, the first of equals.

    Words are letters and digits in lower case.  Null, empty or word-less texts
    and items match nothing; items of fewer than ``k`` words are one shingle;
    a text shorter than an item is compared whole; repeated rows each give
    their rows; items that repeat an id count as one item (its best window), and
    so do all items without an id (``item_id`` null).  Ids that are not whole numbers
    are text.  ``radius`` is by default that of :func:`radius_for`.  Empty tables give
    an empty result.  Other columns are not read.
    """
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = _id_type(benchmark, item_id)

    def step(shared) -> DataFrame:
        hits = _hits_udf(shared, id_type, k, similarity, radius, prefilter)("text")
        return (rows.select("doc_id", hits.alias("hits")).where("size(hits) > 0")
                .select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*"))

    parts = list(_passes(_slices(benchmark, item_id, item_text, slice_chars), docs.sparkSession, step))
    if parts:
        return reduce(DataFrame.unionByName, parts)
    return rows.select("doc_id").limit(0).selectExpr(
        "doc_id", f"cast(null as {id_type}) as item_id", "0.0D as similarity", "0 as start_word", "0 as n_words", "0 as bits")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", k: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
               radius: int | None = None, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """``docs`` without the rows in which an item is found, items without an id
    included; all columns, rows and their order within files stay as they are
    otherwise.

    Rows with a null, empty or word-less text stay, as do repeated rows; an empty
    benchmark drops nothing and empty ``docs`` stay empty."""
    arrow_batches(docs.sparkSession)
    left, id_type = docs, _id_type(benchmark, item_id)

    def step(shared) -> DataFrame:
        find = _hits_udf(shared, id_type, k, similarity, radius, True)
        return unpack(pack(left).withColumn("_hits", find(F.col(f"_row.{text_col}"))).where("size(_hits) = 0"))

    for left in _passes(_slices(benchmark, item_id, item_text, slice_chars), docs.sparkSession, step):
        pass
    return left
