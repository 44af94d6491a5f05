"""Token-id files, compressed per shard by a Re-Pair grammar.

A shard holds the ids of consecutive documents in id order.  Frequent pairs of
neighbouring symbols are replaced by a new symbol (a nonterminal) round after
round; the shard stores the rules, the expansion length of every nonterminal
and where each document's symbols start, so any range of ids is found by
adding up lengths and expanded without touching the rest.  Pairs never cross
the end of a document.

One round replaces many pairs at once: the most frequent ones of which no
symbol is both a left and a right part, so that no two occurrences overlap and
every count is exact.  A pair of equal symbols counts at every second place of a
run and shares its symbol with no other pair of the round.  Rounds end when no
pair occurs often enough to pay for its rule, or all 16-bit symbols are used.

Shard layout (little-endian): magic, version, then int64 counts (documents,
ids, rules, symbols, first nonterminal), document ids (int64), a null mark for
each document (uint8), ids before each document in the shard (int64, one more
than documents), symbols before each document (int64, one more), left and right
part (uint16) and expansion length (uint32) of each rule, symbols (uint16).
Shards are rows of a Parquet table, committed by Spark to any store.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from userflow.llm.bpe import MARKS, UnitEncoder
from userflow.llm.common import arrow_batches, lean_memory, reused_memory
from userflow.session import materialize, shared_path

END_ID = 0
#: A shard is closed at the first document that brings it to this many ids.
SHARD_IDS = 1 << 20
#: Symbols are 16 bits wide.
MAX_SYMBOL = 1 << 16
#: A pair must occur this often: a rule takes 8 bytes, an occurrence saves 2.
MIN_COUNT = 8
#: A round must shorten the shard by this share, or it is the last.
MIN_GAIN = 0.01
MAX_ROUNDS = 24
PAIRS_PER_ROUND = 4096
_BUCKETS = 18
#: Units of text with their ids in a worker's table.
MAX_UNITS = 2_000_000
#: Bytes of text that are encoded together.
ENCODE_BYTES = 16 << 20

_MAGIC = b"RPTF\x01\x00\x00\x00"
SHARDS = "part int, shard int, n_docs long, n_tokens long, data binary"
_SHARDS_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()),
                           ("n_tokens", pa.int64()), ("data", pa.binary())])


def _second_places(seq: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """``inner`` without the second, fourth, ... place of each run of one symbol:
    pairs at neighbouring places of a run overlap."""
    same = np.flatnonzero((seq[1:] == seq[:-1]) & inner)
    if not len(same):
        return inner
    first = np.flatnonzero(np.diff(same, prepend=-2) != 1)
    start = np.repeat(same[first], np.diff(np.append(first, len(same))))
    out = inner.copy()
    out[same[(same - start) % 2 == 1]] = False
    return out


def _bucket_of(code: np.ndarray) -> np.ndarray:
    bucket = code * np.uint32(0x9E3779B1)
    bucket >>= np.uint32(32 - _BUCKETS)
    return bucket.astype(np.intp)


def _frequent_pairs(seq: np.ndarray, inner: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chosen pair codes, the places where they occur, and which pair is at
    each.  ``inner``: whether a place and the next are of one document.

    Counts over hashed buckets (upper bounds) narrow the places to few; their
    pairs are counted exactly.  Chosen pairs have buckets of their own, by which
    their places are found again."""
    inner = _second_places(seq, inner)
    code = seq[:-1].astype(np.uint32)
    code <<= np.uint32(16)
    code |= seq[1:]
    bucket = _bucket_of(code)
    bucket[~inner] = 1 << _BUCKETS  # no pair
    counts = np.bincount(bucket, minlength=(1 << _BUCKETS) + 1)
    counts[-1] = 0
    enough = max(MIN_COUNT, int(np.partition(counts, -limit)[-limit]))
    places = np.flatnonzero((counts >= enough)[bucket])
    own, own_bucket = code[places], bucket[places]
    pairs, n = np.unique(own, return_counts=True)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] >= MIN_COUNT][:limit]
    chosen, left, right = [], set(), set()
    slot = np.zeros(len(counts), np.int32)
    for c, k in zip(pairs[order].tolist(), _bucket_of(pairs[order]).tolist()):
        a, b = c >> 16, c & 0xFFFF
        if a not in right and b not in left and (a != b or (a not in left and a not in right)) and not slot[k]:
            left.add(a)
            right.add(b)
            chosen.append(c)
            slot[k] = len(chosen)
    picked = np.array([0, *chosen], np.uint32)
    which = slot[own_bucket]
    hit = np.flatnonzero((which > 0) & (picked[which] == own))
    return picked[1:], places[hit], which[hit] - 1


def compress(ids: np.ndarray, doc_end: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of ``ids`` (uint16 range, all below ``first``).  ``doc_end[i]``: id
    i is the last of its document.  Returns symbols, their doc_end, the rules
    (n x 2) and the expansion lengths."""
    seq, last = ids.astype(np.uint16), doc_end.copy()
    rules: list[np.ndarray] = []
    lengths = np.zeros(0, np.uint32)
    for _ in range(MAX_ROUNDS):
        used = first + len(lengths)
        limit = min(PAIRS_PER_ROUND, MAX_SYMBOL - used)
        if len(seq) < 2 * MIN_COUNT or limit < 1:
            break
        picked, places, which = _frequent_pairs(seq, ~last[:-1], limit)
        if not len(picked) or len(places) < MIN_GAIN * len(seq):
            break
        parts = np.stack([picked >> np.uint32(16), picked & np.uint32(0xFFFF)], axis=1).astype(np.int64)
        known = np.concatenate([np.ones(first, np.uint32), lengths])
        rules.append(parts.astype(np.uint16))
        lengths = np.concatenate([lengths, known[parts].sum(1, dtype=np.uint32)])
        seq[places] = (used + which).astype(np.uint16)
        last[places] = last[places + 1]
        keep = np.ones(len(seq), bool)
        keep[places + 1] = False
        seq, last = seq[keep], last[keep]
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint16)
    return seq, last, table, lengths


def pack_shard(doc_ids: list[int | None], ids: list[np.ndarray], first: int) -> bytes:
    """The file bytes of documents with ids ``ids`` (each with its end id)."""
    sizes = np.array([len(x) for x in ids], np.int64)
    token_at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    if len(flat) and int(flat.max()) >= first:
        raise ValueError(f"an id of {int(flat.max())} is outside the vocabulary of {first}")
    end = np.zeros(len(flat), bool)
    end[token_at[1:] - 1] = True
    seq, last, rules, lengths = compress(flat, end, first)
    symbol_at = np.concatenate([[0], np.flatnonzero(last) + 1]).astype(np.int64)
    return b"".join([
        _MAGIC, np.array([len(ids), len(flat), len(rules), len(seq), first], "<i8").tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        token_at.astype("<i8").tobytes(), symbol_at.astype("<i8").tobytes(),
        rules[:, 0].astype("<u2").tobytes(), rules[:, 1].astype("<u2").tobytes(), lengths.astype("<u4").tobytes(),
        seq.astype("<u2").tobytes()])


class Shard:
    """Random access to the ids of one shard."""

    def __init__(self, data: bytes):
        if data[: len(_MAGIC)] != _MAGIC:
            raise ValueError("not a token shard")
        self._at = len(_MAGIC)

        def take(kind: str, n: int) -> np.ndarray:
            out = np.frombuffer(data, kind, n, self._at)
            self._at += out.nbytes
            return out

        docs, self.n_tokens, n_rules, n_symbols, self.first = take("<i8", 5).tolist()
        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if z else d for d, z in zip(ids.tolist(), null)]
        self.token_at, self.symbol_at = take("<i8", docs + 1), take("<i8", docs + 1)
        self.left, self.right = take("<u2", n_rules), take("<u2", n_rules)
        self.lengths = take("<u4", n_rules)
        self.symbols = take("<u2", n_symbols)
        self._opened: tuple[np.ndarray, np.ndarray] | None = None
        self._length_of = np.concatenate([np.ones(self.first, np.int64), self.lengths.astype(np.int64)])

    def _open(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that ``symbols`` stand for, one level of the grammar at a time."""
        out = symbols.astype(np.uint32)
        while True:
            compound = out >= self.first
            if not compound.any():
                return out
            # Each step opens one level: a compound symbol becomes its two parts.
            at = np.cumsum(compound) - compound + np.arange(len(out))
            rule = out[compound] - self.first
            wide = np.empty(len(out) + len(rule), np.uint32)
            wide[at[~compound]] = out[~compound]
            wide[at[compound]] = self.left[rule]
            wide[at[compound] + 1] = self.right[rule]
            out = wide

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that ``symbols`` stand for.  Few are opened level by level; for
        many, every rule is opened once and copied from."""
        if len(symbols) < len(self.left):
            return self._open(symbols)
        if self._opened is None:
            rules = self._open(np.arange(self.first, self.first + len(self.left), dtype=np.uint32))
            ends = self.first + np.cumsum(self.lengths.astype(np.int64))
            self._opened = (np.concatenate([np.arange(self.first, dtype=np.uint32), rules]),
                            np.concatenate([np.arange(self.first), ends - self.lengths]))
        ids, start = self._opened
        n = self._length_of[symbols]
        ends = np.cumsum(n)
        return ids[np.repeat(start[symbols] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, its end id included."""
        return self.expand(self.symbols[self.symbol_at[i] : self.symbol_at[i + 1]])

    def slice(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the shard: the document is found by
        its offset, the symbols in it by their expansion lengths."""
        stop = min(start + n, self.n_tokens)
        if start >= stop:
            return np.zeros(0, np.uint32)
        lo, hi = (int(np.searchsorted(self.token_at, x, "right")) - 1 for x in (start, stop - 1))
        symbols = self.symbols[self.symbol_at[lo] : self.symbol_at[hi + 1]]
        ends = int(self.token_at[lo]) + np.cumsum(self._length_of[symbols])
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left"))
        before = int(ends[a - 1]) if a else int(self.token_at[lo])
        return self.expand(symbols[a : b + 1])[start - before : stop - before]

    def documents(self, at_once: int = 1 << 16) -> Iterator[np.ndarray]:
        """Ids of every document in order; symbols are expanded in runs."""
        i = 0
        while i < len(self.doc_ids):
            j = max(i + 1, int(np.searchsorted(self.symbol_at, self.symbol_at[i] + at_once, "right")) - 1)
            j = min(j, len(self.doc_ids))
            flat = self.expand(self.symbols[self.symbol_at[i] : self.symbol_at[j]])
            base = self.token_at[i]
            for d in range(i, j):
                yield flat[self.token_at[d] - base : self.token_at[d + 1] - base]
            i = j


#: One piece of the usual split pattern: Latin letters, which may follow a blank.
_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The character that stands for each byte in a byte-level vocabulary.
_BYTE_CHARS = dict(zip([*_SHOWN, *(b for b in range(256) if b not in _SHOWN)], map(chr, [*_SHOWN, *range(256, 324)])))


def _byte_level(word: str) -> str:
    if word.isascii():
        return word.replace(" ", "\u0120")
    return word.encode().decode("latin-1").translate(_BYTE_CHARS)


def _splits_at_blanks(tokenizer: Tokenizer) -> bool:
    """Whether texts go to the model as the pieces of the usual split pattern, byte by byte."""
    steps = json.loads(tokenizer.to_str())
    cut = steps["pre_tokenizer"] or {}
    return steps["normalizer"] is None and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]


_CODERS: dict[str, UnitEncoder] = {}


def worker_tokenizer(name: str, content) -> UnitEncoder:
    """The encoder of this Python worker; ``name`` stands for the broadcast
    tokenizer file ``content``.  Special strings in a text are what the library
    makes of them: their own ids."""
    coder = _CODERS.get(name)
    if coder is None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = Tokenizer.from_str(content.value)

        model, whole = tokenizer.model, _splits_at_blanks(tokenizer)

        def encode_strings(strings: list[str]) -> list[bytes]:
            """A single word is one piece, which goes to the library's model at once."""
            one = [whole and _WORD(s) is not None for s in strings]
            rest = iter(tokenizer.encode_batch_fast([s for s, o in zip(strings, one) if not o], add_special_tokens=False))
            return [array("I", [t.id for t in model.tokenize(_byte_level(s))] if o else next(rest).ids).tobytes()
                    for s, o in zip(strings, one)]

        added = "".join(t.content for t in tokenizer.get_added_tokens_decoder().values())
        marks = "".join(m for m in MARKS if m not in added)  # a special string is never cut
        _CODERS.clear()
        coder = _CODERS[name] = UnitEncoder(encode_strings, MAX_UNITS, marks)
    return coder


def _together(batches: Iterator[pa.RecordBatch], limit: int = ENCODE_BYTES) -> Iterator[tuple[list, list]]:
    """Ids and texts of batches of at least ``limit`` bytes together."""
    doc_ids, texts, size = [], [], 0
    for batch in batches:
        doc_ids += batch.column("doc_id").to_pylist()
        texts += batch.column("text").to_pylist()
        size += batch.nbytes
        if size >= limit:
            yield doc_ids, texts
            doc_ids, texts, size = [], [], 0
    if texts:
        yield doc_ids, texts


def shard_rows(batches: Iterator[pa.RecordBatch], coder: UnitEncoder, part: int, first: int, end_id: int = END_ID,
               shard_ids: int = SHARD_IDS) -> Iterator[pa.RecordBatch]:
    """The shards of documents (doc_id, text) in their order, a row each."""
    shard, held_ids, held, size, end = 0, [], [], 0, np.array([end_id], np.uint32)

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(
                (part, shard, len(held), size, pack_shard(held_ids, held, first)), _SHARDS_ARROW)],
            schema=_SHARDS_ARROW)

    with reused_memory():
        for doc_ids, texts in _together(batches):
            for doc_id, ids in zip(doc_ids, coder.encode(texts)):
                held_ids.append(doc_id)
                held.append(np.concatenate([np.frombuffer(ids, np.uint32), end]))
                size += len(held[-1])
                if size >= shard_ids:
                    yield close()
                    shard, held_ids, held, size = shard + 1, [], [], 0
        if held:
            yield close()


def write_shards(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of all texts, in ascending id order (null ids first, equal
    ids by the hash of their text), as a table of shards at ``path``.

    The rows are dealt out by ranges of the id; a task streams its range and
    holds one shard.  (part, shard) in ascending order is the global order.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    name, content = hashlib.sha256(text.encode()).hexdigest(), spark.sparkContext.broadcast(text)
    first = max(Tokenizer.from_str(text).get_vocab_size(), end_id + 1)
    if first > MAX_SYMBOL:
        raise ValueError("symbols are 16 bits wide; this vocabulary has more ids")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        coder = worker_tokenizer(name, content)
        yield from shard_rows(batches, coder, TaskContext.get().partitionId(), first, end_id, shard_ids)

    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    (rows.repartitionByRange(spread, "doc_id").sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"))
     .mapInArrow(shards, SHARDS).write.parquet(path))


def read_documents(table: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a shard table:
    start counts the ids of all documents before it."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        with reused_memory():
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = Shard(batch.column("data")[i].as_py())
                    crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in shard.documents()]
                    n = len(crc)
                    yield pa.record_batch({
                        "part": pa.array(np.full(n, batch.column("part")[i].as_py(), np.int32)),
                        "shard": pa.array(np.full(n, batch.column("shard")[i].as_py(), np.int32)),
                        "doc_id": pa.array(shard.doc_ids, pa.int64()),
                        "at": pa.array(shard.token_at[:-1].astype(np.int64)),
                        "n_tokens": pa.array(np.diff(shard.token_at).astype(np.int64)),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    })

    rows = table.select("part", "shard", "data").mapInArrow(
        documents, "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    sizes = materialize(table.select("part", "shard", "n_tokens"))
    # One number for each part, then running sums inside each part.
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    parts = parts.select(F.col("part").alias("p"), upto.alias("part_start"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    starts = materialize(sizes.withColumn("s", inside).join(parts, F.col("part") == F.col("p"))
                         .select(F.col("part").alias("p"), F.col("shard").alias("q"),
                                 (F.col("s") + F.col("part_start")).alias("shard_start")))
    return rows.join(starts, (F.col("part") == F.col("p")) & (F.col("shard") == F.col("q"))).select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "part", "shard")


def tokenize_to_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards (default: to a new place in the shared folder) and return
    what is read back from them, one row per row of ``docs``.

    A null text is an empty one, of which only the end id remains; rows that
    repeat an id follow one another; an empty table writes nothing and gives an
    empty result.  Texts are encoded whole; other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    path = path or shared_path(spark, "tokens")
    write_shards(docs, tokenizer_path, path, id_col, text_col, end_id, shard_ids)
    return read_documents(spark.read.schema(SHARDS).parquet(path))
