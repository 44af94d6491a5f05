"""Language-model scores from a log-frequency Bloom filter.

Counting.  A task counts the unigrams and bigrams of its training texts in
runs of ``RUN_TOKENS`` tokens and sends each run's distinct n-grams packed by
hash bucket; a bucket's runs are merged in one task.  A frequent n-gram is one
entry per run, so buckets are even; their number follows the size of the text.

Filter.  A count c is quantised to level ``1 + floor(log2 c)`` and the n-gram is
inserted once for every level up to its own, so its level is read back by
probing level after level until one is missing.  Each bucket fills its own
segment of bits, ``BITS_PER_ENTRY`` for every entry, and every count is kept:
the segments are a table that grows with the text, a task holds one of them.

Probes.  A run of ``SCORE_TOKENS`` tokens is written as its distinct words and
the place of each token among them.  From these its distinct words and bigrams
go packed to their buckets, which answer with a level for each key (and the
exact count of a word); the answers meet the run again in one task.

Score.  p(w | h) = (c(h w) + MU p(w)) / (c(h) + MU), p(w) = (c(w) + 1) / (N + V + 1),
all counts from probes (the middle of their level); the first word follows a
start mark, the end of the text is a token.

Base score.  The same with p(w) alone, from the exact counts.

Words are known by a 64-bit hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm.common import arrow_batches, lean_memory, limited_batches, mix, pieces, text_bytes, word_hashes
from userflow.session import materialize

RUN_TOKENS = 1 << 20
#: Tokens scored at once.
SCORE_TOKENS = 3 << 18
#: Text bytes that one bucket stands for.
BUCKET_BYTES = 8 << 20
BITS_PER_ENTRY = 10
PROBES = 6
MU = 2.0
HOLDOUT_OF, HOLDOUT_AT = 7, 2

END = np.uint64(0x656E642D6F662D74)
START = np.uint64(0x73746172742D6F66)
_BIGRAM_R = np.uint64(0xC2B2AE3D27D4EB4F)
UNIGRAM, BIGRAM = 1, 2


def held_out(id_column: Column, of: int = HOLDOUT_OF, at: int = HOLDOUT_AT) -> Column:
    """Whether a row is kept out of training: crc32 of the id as text (a row
    without an id trains)."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % of == at, F.lit(False))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each followed by END, and text offsets."""
    words, at = word_hashes(texts, "space")
    ends = at[1:] + np.arange(len(texts))
    out = np.empty(len(words) + len(texts), np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word] = words
    out[ends] = END
    return out, np.concatenate([[0], ends + 1])


def histories(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The token before each token, START at the beginning of a text."""
    out = np.empty_like(words)
    out[1:] = words[:-1]
    out[at[:-1]] = START
    return out


def bigrams(history: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(history * _BIGRAM_R + words)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Buckets in key order: the top 32 bits, scaled."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane: the upper planes are
    zero and vanish in the compression of the shuffle."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Small numbers, byte plane by byte plane, deflated."""
    width = numbers.dtype.itemsize
    return zlib.compress(np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, width).T.tobytes(), 1)


def unpack_numbers(data: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


#: Rows of one bucket or run that go to Spark together.
PACKED_ROWS = 64


def _packed(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), PACKED_ROWS):
        columns = zip(*rows[i : i + PACKED_ROWS])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets that sorted keys have, with their range of keys."""
    of = bucket_of(keys, buckets)
    first = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
    for start, stop in zip(first, [*first[1:], len(of)]):
        yield int(of[start]), slice(start, stop)


_COUNTED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
COUNTED = "kind int, bucket int, keys binary, counts binary"
SEGMENT = "kind int, bucket int, bits binary, keys binary, counts binary, grams long, total long"


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str], limit: int) -> Iterator[tuple[list[bytes], list]]:
    """Texts in runs of about ``limit`` tokens (six bytes each), with the other columns."""
    texts: list[bytes] = []
    rest: list[list] = [[] for _ in columns]
    size = 0
    for batch in batches:
        batch_texts = text_bytes(batch.column("text"))
        values = [batch.column(c).to_pylist() for c in columns]
        for i, t in enumerate(batch_texts):
            texts.append(t)
            for own, v in zip(rest, values):
                own.append(v[i])
            size += len(t) + 6
            if size >= 6 * limit:
                yield texts, rest
                texts, rest, size = [], [[] for _ in columns], 0
    if texts:
        yield texts, rest


def _tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words, ends = [], [np.zeros(1, np.int64)]
    for _, some in pieces(texts):
        w, at = tokens(some)
        words.append(w)
        ends.append(at[1:] + ends[-1][-1])
    return np.concatenate(words), np.concatenate(ends)


def train(docs: DataFrame, buckets: int) -> DataFrame:
    """The model of column ``text`` as a table of one row per kind and bucket: the
    bucket's segment of the filter, the exact counts of its words (unigrams
    only), its number of distinct n-grams and their total."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for texts, _ in _runs(batches, [], RUN_TOKENS):
            words, at = _tokens_of(texts)
            history = histories(words, at)
            starts = np.full(len(texts), START, np.uint64)  # their count is that of the start history
            for kind, grams in ((UNIGRAM, np.concatenate([words, starts])), (BIGRAM, bigrams(history, words))):
                keys, n = np.unique(grams, return_counts=True)
                yield from _packed([(kind, b, pack_keys(keys[own]), n[own].astype(np.int64).tobytes())
                                    for b, own in by_bucket(keys, buckets)], _COUNTED)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        lean_memory()
        kind = key[0].as_py()
        keys = np.concatenate([unpack_keys(x) for x in table.column("keys").to_pylist()])
        n = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()])
        order = np.argsort(keys, kind="stable")  # runs are sorted already
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
        keys, n = keys[first], np.add.reduceat(n, first)
        word = keys != START
        return pa.table({
            "kind": pa.array([kind], pa.int32()), "bucket": pa.array([key[1].as_py()], pa.int32()),
            "bits": pa.array([_segment(keys, n)], pa.binary()),
            "keys": pa.array([pack_keys(keys) if kind == UNIGRAM else None], pa.binary()),
            "counts": pa.array([pack_numbers(n) if kind == UNIGRAM else None], pa.binary()),
            "grams": pa.array([int(word.sum())], pa.int64()), "total": pa.array([int(n[word].sum())], pa.int64())})

    return materialize(docs.select("text").mapInArrow(count, COUNTED).groupBy("kind", "bucket").applyInArrow(merge, SEGMENT))


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count)."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    """The count a level stands for: the middle of [2^(l-1), 2^l), 0 for none."""
    return np.where(level > 1, 0.75 * np.exp2(level.astype(np.float64)), level.astype(np.float64))


def _positions(keys: np.ndarray, level: np.ndarray | int, probe: int, bits: np.ndarray) -> np.ndarray:
    a = mix(keys + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64))
    b = mix(a ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    return ((a + np.uint64(probe) * b) >> np.uint64(8)) % bits


class CountFilter:
    """Segments of bits, one for each (kind, bucket)."""

    def __init__(self, buckets: int, segments: dict[tuple[int, int], bytes]):
        self.buckets = buckets
        sizes = np.zeros((3, buckets), np.uint64)
        starts = np.zeros((3, buckets), np.uint64)
        parts, at = [], 0
        for (kind, bucket), data in sorted(segments.items()):
            sizes[kind, bucket], starts[kind, bucket] = 8 * len(data), 8 * at
            parts.append(data)
            at += len(data)
        self.sizes, self.starts = sizes, starts
        self.data = np.frombuffer(b"".join(parts) or b"\0", np.uint8)

    def levels(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """The level of each key: probe level 1, 2, ... until one is missing."""
        out = np.zeros(len(keys), np.int64)
        bucket = bucket_of(keys, self.buckets)
        left = np.flatnonzero(self.sizes[kind][bucket] > 0)
        size, start = self.sizes[kind][bucket], self.starts[kind][bucket]
        level = 0
        while len(left):
            level += 1
            for probe in range(PROBES):
                at = start[left] + _positions(keys[left], level, probe, size[left])
                bit = self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
                left = left[bit == 1]
                if not len(left):
                    break
            out[left] = level
        return out


def _segment(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The bits of one bucket."""
    level = levels(counts)
    entries = int(level.sum())
    if not entries:
        return b""
    bits = 8 * max(8, entries * BITS_PER_ENTRY // 8)
    flat, of = np.repeat(keys, level), np.arange(entries) - np.repeat(np.cumsum(level) - level, level) + 1
    out = np.zeros(bits, bool)
    for probe in range(PROBES):
        out[_positions(flat, of, probe, np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


_DOC = np.dtype([("id", "<i8"), ("null", "?"), ("held", "?"), ("n", "<i8")])
_RUN = pa.schema([("run", pa.int64()), ("docs", pa.binary()), ("keys", pa.binary()), ("often", pa.binary()), ("places", pa.binary())])
RUN = "run long, docs binary, keys binary, often binary, places binary"
_PROBE = pa.schema([("run", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary())])
PROBE = "run long, kind int, bucket int, keys binary"
ANSWER = "run long, kind int, bucket int, levels binary, counts binary"


def pack_places(places: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Level of each word in the run, and the places as ranks by level: frequent
    words have small numbers."""
    often = levels(counts).astype(np.uint8)
    order = np.argsort(np.uint8(64) - often, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return pack_numbers(often), pack_numbers(rank[places])


def unpack_places(often: bytes, ranks: bytes) -> np.ndarray:
    order = np.argsort(np.uint8(64) - unpack_numbers(often, "u1"), kind="stable")
    return order[unpack_numbers(ranks, "<u4")]


def _histories_of(places: np.ndarray, at: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The place of the token before each token."""
    out = np.empty_like(places)
    out[1:] = places[:-1]
    out[at[:-1]] = np.searchsorted(words, START)
    return out


def _ends(docs_: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(docs_["n"])])


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", of: int = HOLDOUT_OF,
                at: int = HOLDOUT_AT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row
    per row of ``docs``, trained on the rows that are not held out.

    A null text is empty and has one token, its end; repeated rows each count
    and score; without training rows every count is 0; an empty table gives an
    empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       held_out(F.col(id_col), of, at).alias("held"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("s")).head()["s"] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    segments = train(rows.where("NOT held"), buckets)
    found = segments.where(f"kind = {UNIGRAM}").agg(F.sum("total").alias("n"), F.sum("grams").alias("v")).head()
    n_train, n_distinct = found["n"] or 0, found["v"] or 0
    denominator = float(np.log10(n_train + n_distinct + 1.0))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        number = 0
        for texts, (ids, held) in _runs(batches, ["doc_id", "held"], SCORE_TOKENS):
            tokens_, ends = _tokens_of(texts)
            run = TaskContext.get().partitionId() << 32 | number
            number += 1
            docs_ = np.zeros(len(texts), _DOC)
            docs_["id"], docs_["null"] = [i or 0 for i in ids], [i is None for i in ids]
            docs_["held"], docs_["n"] = held, np.diff(ends)
            words, places, n = np.unique(np.append(tokens_, START), return_inverse=True, return_counts=True)
            yield from _packed([(run, docs_.tobytes(), pack_keys(words), *pack_places(places[:-1], n))], _RUN)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for batch in batches:
            for run, data, keys, often, places in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                words, places = unpack_keys(keys), unpack_places(often, places)
                before = _histories_of(places, _ends(np.frombuffer(data, _DOC)), words)
                for kind, grams in ((UNIGRAM, words), (BIGRAM, np.unique(bigrams(words[before], words[places])))):
                    yield from _packed([(run, kind, b, pack_keys(grams[own])) for b, own in by_bucket(grams, buckets)], _PROBE)

    def look_up(key: tuple, table: pa.Table) -> pa.Table:
        """The level of each key that a run sent, and the exact count of each word."""
        lean_memory()
        kind, bucket = key[0].as_py(), key[1].as_py()
        own, words, n = CountFilter(1, {}), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        runs_, sent = [], []
        for run, keys, bits, counts in zip(*(table.column(c).to_pylist() for c in ("run", "keys", "bits", "counts"))):
            if run is not None:
                runs_.append(run)
                sent.append(unpack_keys(keys))
                continue
            own = CountFilter(1, {(kind, 0): bits})
            if kind == UNIGRAM:
                words, n = unpack_keys(keys), unpack_numbers(counts, "<i8")
        asked, back = np.unique(np.concatenate([*sent, words[:0]]), return_inverse=True)
        level, exact = own.levels(asked, kind).astype(np.uint8), np.zeros(len(asked), np.int64)
        if len(words):
            place = np.minimum(np.searchsorted(words, asked), len(words) - 1)
            exact = np.where(words[place] == asked, n[place], 0)
        own_keys = np.split(back, np.cumsum([len(x) for x in sent]))[:-1] if sent else []
        return pa.table({
            "run": pa.array(runs_, pa.int64()), "kind": pa.array([kind] * len(sent), pa.int32()),
            "bucket": pa.array([bucket] * len(sent), pa.int32()),
            "levels": pa.array([pack_numbers(level[x]) for x in own_keys], pa.binary()),
            "counts": pa.array([pack_numbers(exact[x]) if kind == UNIGRAM else None for x in own_keys], pa.binary())})

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        """The rows of one run, from the answers of all buckets in key order."""
        lean_memory()
        answers = {UNIGRAM: [], BIGRAM: []}
        for kind, bucket, level, counts, data, keys, often, places in zip(*(table.column(c).to_pylist() for c in (
                "kind", "bucket", "levels", "counts", "docs", "keys", "often", "places"))):
            if kind is None:
                docs_, words, at_word = np.frombuffer(data, _DOC), unpack_keys(keys), unpack_places(often, places)
            else:
                answers[kind].append((bucket, level, counts))
        for own in answers.values():
            own.sort(key=lambda x: x[0])
        at = _ends(docs_)
        before_at = _histories_of(at_word, at, words)
        exact = np.concatenate([unpack_numbers(x[2], "<i8") for x in answers[UNIGRAM]])[at_word]
        level = {kind: np.concatenate([unpack_numbers(x[1], "u1") for x in own]) for kind, own in answers.items()}
        known = level_count(level[UNIGRAM])
        one = (known[at_word] + 1) / (n_train + n_distinct + 1)
        before = known[before_at]
        _, back = np.unique(bigrams(words[before_at], words[at_word]), return_inverse=True)
        two = np.minimum(level_count(level[BIGRAM])[back], before)
        return pa.table({
            "doc_id": pa.array(docs_["id"], mask=docs_["null"]), "held_out": pa.array(docs_["held"]),
            "n_tokens": pa.array(docs_["n"]), "n_known": pa.array(np.add.reduceat((exact > 0).astype(np.int64), at[:-1])),
            "train_tokens": pa.array(np.full(len(docs_), n_train, np.int64)),
            "base_score": pa.array(np.add.reduceat(np.log10(exact + 1.0), at[:-1]) - docs_["n"] * denominator),
            "score": pa.array(np.add.reduceat(np.log10((two + MU * one) / (before + MU)), at[:-1]))})

    written = materialize(rows.mapInArrow(runs, RUN))  # a run keeps its number and texts when a task is repeated
    asked = written.mapInArrow(probes, PROBE)
    found = (asked.unionByName(segments.select("kind", "bucket", "bits", "keys", "counts"), allowMissingColumns=True)
             .groupBy("kind", "bucket").applyInArrow(look_up, ANSWER))
    scored = found.unionByName(written, allowMissingColumns=True).groupBy("run").applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    with limited_batches(spark, 1):  # a row is a whole run
        return materialize(scored)
