"""Byte-level BPE by a lazily determinised finite-state transducer, and a
streaming decoder.

A sequence of tokens is the BPE encoding of its bytes exactly if every two
neighbours are: merging the bytes of both gives back the two.  So each prefix
of a piece has one last token, and the transducer reads a piece byte by byte
with, as its state, the starts a token in progress may have, each with the
tokens not yet emitted on the way there.  Tokens on which all starts agree are
emitted; a start dies once no vocabulary entry continues it, so the lookahead
is bounded by the longest entry.  A transition on which the token emitted last
has a say has two branches, chosen by whether the two tokens may be neighbours;
so states do not multiply with that token.  States and transitions are made when
first met and dropped together when there are too many, also inside a piece.

Text is cut into pieces by the split pattern; a bounded table keeps their ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.llm.common import arrow_batches, lean_memory, pack, worker_table

#: States, and strings with their ids in one generation, that a worker keeps.
MAX_STATES = 150_000
MAX_UNITS = 300_000
MAX_UNIT_CHARS = 64
_TEXTS_AT_ONCE = 1000
#: Ids decoded at a time.
DECODE_IDS = 1 << 16


def read_ranks(path: str) -> bytes:
    """The rank file, read on the driver (it has under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from base64-and-rank lines."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


#: In place of the token emitted last, at the start of a piece.
START = 1 << 20


class Transducer:
    """Encodes pieces of bytes by merge ranks."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.continued = {t[:i] for t in ranks for i in range(1, len(t))}
        self.max_states = max_states
        self._pairs: dict[int, bool] = {}
        self._made_of: dict[int, tuple[int, int]] = {}
        self._self: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        #: (longest start, ((length of start, pending tokens), ...)) to its number; the empty
        #: start comes last, and its pending tokens end a piece there.
        self._number: dict = {}
        self._state: list = []
        #: state * 256 + byte to (state, emitted tokens), or to [-1, token, step if the token
        #: does not fit the last emitted one, step if it does].
        self._next: dict = {}
        self._add((b"", ((0, ()),)))

    def _add(self, state: tuple) -> int:
        n = self._number.setdefault(state, len(self._state))
        if n == len(self._state):
            self._state.append(state)
        return n

    def merge(self, piece: bytes, stop: int = 1) -> list[int]:
        """Encoding by repeated merges of the lowest rank (leftmost first), until
        ``stop`` tokens are left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _halves(self, rank: int) -> tuple[int, int]:
        """The two tokens whose merge makes a token (of a single byte: itself)."""
        known = self._made_of.get(rank)
        if known is None:
            parts = self.merge(self.token[rank], 2)
            known = self._made_of[rank] = (parts[0], parts[-1]) if len(parts) == 2 else (rank, rank)
        return known

    def _fits(self, last: int, new: int) -> bool:
        """Whether ``new`` may follow ``last`` (START: it begins the piece).

        Undo the merges of both, latest first: at each point the two tokens that
        meet at the border must not make one that would have been merged before
        the merge undone last."""
        key = last << 20 | new
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > self.max_states:
                self._pairs.clear()
            if last == START:
                known = self._pairs[key] = self._whole(new)
                return known
            token, ranks = self.token, self.ranks
            left, right, before, known = last, new, len(ranks), True
            while True:
                merged = ranks.get(token[left] + token[right])
                if merged is not None and merged < before:
                    known = False
                    break
                inner_left, inner_right = self._halves(left)[1], self._halves(right)[0]
                left_open, right_open = inner_left != left, inner_right != right
                if left_open and (left > right or not right_open):
                    before, left = left, inner_left
                elif right_open:  # of equals the left border wins: it comes first
                    before, right = right + 1, inner_right
                else:
                    break
            self._pairs[key] = known
        return known

    def _whole(self, rank: int) -> bool:
        """Whether a token is the encoding of its own bytes."""
        known = self._self.get(rank)
        if known is None:
            known = self._self[rank] = self.merge(self.token[rank]) == [rank]
        return known

    def _step(self, number: int, byte: int, fits_last: bool | None = None):
        """What a byte does in a state: (state, emitted tokens) or, where that turns
        on the last emitted token and ``fits_last`` is not given, the token it
        would be followed by."""
        longest, starts = self._state[number]
        seen = longest + bytes((byte,))
        end = len(seen) - 1
        ranks, continued = self.ranks, self.continued
        reached, live = None, []
        for length, pending in starts:
            own = seen[end - length :]
            if reached is None:
                rank = ranks.get(own)
                if rank is not None:
                    if not pending and fits_last is None:
                        return rank
                    if self._fits(pending[-1], rank) if pending else fits_last:
                        reached = (*pending, rank)
            if own in continued:
                live.append((length + 1, pending))
        live.append((0, reached))
        out: tuple = ()
        if len(live) == 1:
            out, live[0] = reached, (0, ())
        else:
            first = live[0][1]
            agreed = 0
            for i in range(len(first)):
                token = first[i]
                if any(len(p) <= i or p[i] != token for _, p in live):
                    break
                agreed = i + 1
            if agreed:
                out = first[:agreed]
                live = [(length, p[agreed:]) for length, p in live]
        # Starts come longest first.
        return self._add((seen[end + 1 - live[0][0] :], tuple(live))), out

    def _grow(self, number: int, byte: int, last: int, step):
        """The missing step (``step``: the branches known so far); too many states are dropped."""
        if step is None:
            step = self._step(number, byte)
            if isinstance(step, int):
                step = [-1, step, None, None]
            self._next[number << 8 | byte] = step
        if step[0] < 0:
            branch = 3 if self._fits(last, step[1]) else 2
            if step[branch] is None:
                step[branch] = self._step(number, byte, branch == 3)
            step = step[branch]
        if len(self._state) > self.max_states or len(self._next) > 4 * self.max_states:
            state = self._state[step[0]]
            self._reset()
            step = (self._add(state), step[1])
        return step

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        out: list[int] = []
        at, last, find, fits = 0, START, self._next.get, self._pairs.get
        for byte in piece:
            step = find(at << 8 | byte)
            if step is None or step[0] < 0:
                fit = None if step is None else fits(last << 20 | step[1])
                known = None if fit is None else step[3 if fit else 2]
                if known is None:
                    step = self._grow(at, byte, last, step)
                    find = self._next.get  # the tables may be new
                else:
                    step = known
            at, emitted = step
            if emitted:
                out += emitted
                last = emitted[-1]
        out += self._state[at][1][-1][1]
        return out


class IdTable:
    """Ids (little-endian 32-bit) of strings, kept in two generations: when the
    young one is full the old one is dropped and replaced by it, and strings
    still in use come back from there."""

    def __init__(self, encode_new: Callable[[list[str]], list[bytes]], size: int = MAX_UNITS):
        self.encode_new, self.size = encode_new, size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def joined(self, lists: list[list[str]]) -> Iterator[bytes]:
        """For each list the ids of its strings, one after the other.  The strings
        of some lists go through a small table of their own: it stays in the
        processor's cache, which the large one does not."""
        for first in range(0, len(lists), _TEXTS_AT_ONCE):
            some = lists[first : first + _TEXTS_AT_ONCE]
            here = dict.fromkeys(set().union(*some))
            young, old, add, new = self.young, self.old, {}, []
            for u in here:
                ids = young.get(u)
                if ids is None:
                    ids = old.get(u)
                    if ids is None:
                        new.append(u)
                        continue
                    add[u] = ids
                here[u] = ids
            fresh = dict(zip(new, self.encode_new(new)))
            here.update(fresh)
            add.update((u, ids) for u, ids in fresh.items() if len(u) <= MAX_UNIT_CHARS)
            if len(young) + len(add) > self.size:
                self.old, self.young = young, {}
            self.young.update(add)
            for strings in some:
                yield b"".join(map(here.__getitem__, strings))


_PLANE = "".join(map(chr, range(1 << 16)))
_BEYOND = re.compile("[\U00010000-\U0010ffff]").search
#: What a split pattern may consist of to mean the same to both engines.
_PART = re.compile(r"\\[sS]|\\p\{[LN]\}|\[\^?|\]|\(\?[!:]|[ '|?+()A-Za-z0-9]")


def plane_pattern(pattern: str) -> str | None:
    """The split pattern for the standard library's engine, which is faster: classes
    of characters are spelt out as ranges of the first 65,536 code points.  None
    if the pattern has other parts than those of :data:`_PART`."""
    parts, out, inside = _PART.findall(pattern), [], False
    if "".join(parts) != pattern or "[]" in pattern or "[^]" in pattern:
        return None
    for part in parts:
        if part[0] == "[":
            inside = True
        elif part == "]":
            inside = False
        elif part[0] == "\\":
            runs = [m.span() for m in regex.finditer(f"{part}+", _PLANE)]
            ranges = "".join(f"\\u{first:04x}-\\u{end - 1:04x}" for first, end in runs)
            part = ranges if inside else f"[{ranges}]"
        out.append(part)
    return "".join(out)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pattern in a text."""
    whole, plane = regex.compile(pattern).findall, plane_pattern(pattern)
    if plane is None:
        return whole
    fast = re.compile(plane).findall
    return lambda text: fast(text) if text.isascii() or not _BEYOND(text) else whole(text)


class PieceEncoder:
    """Ids of whole texts, cut into pieces by the split pattern."""

    def __init__(self, machine: Transducer, pattern: str, size: int = MAX_UNITS):
        self.machine, self.split = machine, splitter(pattern)
        self.table = IdTable(lambda new: [array("I", machine.encode(p.encode())).tobytes() for p in new], size)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return list(self.table.joined([self.split(t) if t else [] for t in texts]))


#: A blank before white space or the end.
_BLANKS = re.compile(r" (?:\s|\Z)").search
#: Marks that start a new piece after a letter; a single line end is a piece by itself.
MARKS = ",.;:!?\n"
#: Units whose ids are put together at once.
_UNITS_AT_ONCE = 1 << 15


_VISIBLE = np.array([False, True, True, True, False, False, False])
_CUT, _ODD = 1, 2


def _cut_table(marks: str) -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte (1 - 3: visible ASCII), and for two classes (8 * first +
    second) whether a text is cut between them, and whether they may be a blank
    and white space."""
    kind = np.zeros(256, np.uint8)
    kind[33:127] = 1
    kind[[*range(65, 91), *range(97, 123)]] = 2
    kind[list(marks.replace("\n", "").encode())] = 3
    kind[32] = 5
    kind[[*range(9, 14), *range(28, 32), 0xC2, 0xE1, 0xE2, 0xE3]] = 6  # these bytes begin the other white space
    if "\n" in marks:
        kind[10] = 4
    cut = np.zeros((8, 8), np.uint8)
    cut[:, 5] = cut[2, 3] = _CUT
    cut[5, 4:7] |= _ODD
    return kind, cut.ravel()


class UnitTable:
    """Ids of units, as one flat array; those not used for longest go first."""

    def __init__(self, size: int):
        self.size, self.tick = size, 0
        self.units = pa.array([], pa.large_binary())
        self.ids, self.n, self.used = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of known units, and which units are not known (``units`` are distinct).
        The smaller side is hashed, the larger one looked up in it."""
        if len(units) < len(self.units):
            number = pc.index_in(self.units, value_set=units)
            known = number.is_valid().to_numpy(zero_copy_only=False)
            places, missing = np.zeros(len(units), np.int64), np.ones(len(units), bool)
            number = number.drop_null().to_numpy()
            places[number], missing[number] = np.flatnonzero(known), False
        else:
            at = pc.index_in(units, value_set=self.units)
            missing = at.is_null().to_numpy(zero_copy_only=False)
            places = at.fill_null(0).to_numpy().astype(np.int64)
        self.tick += 1
        self.used[places[~missing]] = self.tick
        return places, missing

    def add(self, units: pa.Array, ids: np.ndarray, n: np.ndarray) -> None:
        """New units with their ids, one after the other."""
        self.units = pa.concat_arrays([self.units, units])
        self.ids, self.n = np.concatenate([self.ids, ids]), np.concatenate([self.n, n])
        self.used = np.concatenate([self.used, np.full(len(n), self.tick)])
        if len(self.n) > self.size:
            kept = np.zeros(len(self.n), bool)
            kept[np.argsort(self.used, kind="stable")[len(self.n) - self.size // 2 :]] = True
            self.ids = self.ids[np.repeat(kept, self.n)]
            self.units, self.n, self.used = self.units.filter(pa.array(kept)), self.n[kept], self.used[kept]


class UnitEncoder:
    """Ids of whole texts for a library that encodes strings whole, from the ids
    of units, cut where the usual split pattern always starts a new piece: before
    single blanks, before a mark of ``marks`` that follows an ASCII letter, around
    single line ends between visible ASCII.  ``encode_strings(list of str) -> list of bytes``.

    The units of all texts are numbered in one buffer, each is looked up once."""

    def __init__(self, encode_strings: Callable[[list[str]], list[bytes]], size: int = MAX_UNITS, marks: str = MARKS):
        self.encode_strings = encode_strings
        self.kind, self.cut = _cut_table(marks)
        self.table = UnitTable(size)

    def _units(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts, and the first unit of each text (one more than texts)."""
        coded = [t.encode() for t in texts]
        start = np.concatenate([[0], np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))])
        data = b"".join(coded)
        kind = self.kind[np.frombuffer(data, np.uint8)]
        first = np.zeros(len(data) + 1, bool)
        pairs = self.cut[kind[:-1] << np.uint8(3) | kind[1:]]
        first[1:-1] = pairs & _CUT
        line = np.flatnonzero(kind[1:-1] == 4) + 1
        line = line[_VISIBLE[kind[line - 1]] & _VISIBLE[kind[line + 1]]]
        first[line] = first[line + 1] = True
        ends = start[1:][start[1:] > 0] - 1
        odd = np.concatenate([np.flatnonzero(pairs & _ODD), ends[kind[ends] == 5]])
        for i in np.unique(np.searchsorted(start, odd, "right") - 1).tolist():
            if _BLANKS(texts[i]):  # runs of blanks are pieces of their own: such a text is encoded whole
                first[start[i] : start[i + 1]] = False
        first[start] = True
        offsets = np.flatnonzero(first)
        units = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return units, np.searchsorted(offsets, start)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        units, first = self._units([t or "" for t in texts])
        found = units.dictionary_encode()
        places, missing = self.table.find(found.dictionary)
        known = self.table
        start = np.concatenate([[0], np.cumsum(known.n)])
        fresh = found.dictionary.filter(pa.array(missing))
        coded = self.encode_strings(fresh.cast(pa.large_string()).to_pylist())
        n_new = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        ids = np.frombuffer(b"".join(coded), np.uint32)
        # Ids of the unit with each number: from the table, or after it the new ones.
        pool, n, at = np.concatenate([known.ids, ids]), np.zeros(len(places), np.int32), start[places]
        n[~missing] = known.n[places[~missing]]
        n[missing], at[missing] = n_new, len(known.ids) + np.cumsum(n_new) - n_new
        numbers, out = found.indices.to_numpy(), []
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(first, first[i] + _UNITS_AT_ONCE, "right")) - 1)
            j = min(j, len(texts))
            own = numbers[first[i] : first[j]]
            size = n[own]
            ends = np.concatenate([[0], np.cumsum(size)])
            place = np.repeat(at[own] - ends[:-1], size)
            place += np.arange(ends[-1])
            flat = pool[place].tobytes()
            cuts = (4 * ends[first[i : j + 1] - first[i]]).tolist()
            out += [flat[a:b] for a, b in zip(cuts, cuts[1:])]
            i = j
        kept = pc.less_equal(pc.binary_length(fresh), MAX_UNIT_CHARS).to_numpy(zero_copy_only=False)
        self.table.add(fresh.filter(pa.array(kept)), ids[np.repeat(kept, n_new)], n_new[kept])
        return out


def id_list(ids: list[bytes]) -> pa.Array:
    """list<int32> of little-endian id bytes."""
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), np.int32)))


class Utf8Stream:
    """Incremental UTF-8 decoding: the state is the unfinished sequence at the
    end of what was fed; malformed bytes become U+FFFD."""

    def __init__(self) -> None:
        self.left = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Bytes at the end that start a sequence but do not finish it."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:  # inside a sequence
                continue
            need = 4 if 0xF0 <= byte <= 0xF4 else 3 if 0xE0 <= byte <= 0xEF else 2 if 0xC2 <= byte <= 0xDF else 1
            return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.left + data
        keep = self._unfinished(data)
        self.left = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        left, self.left = self.left, b""
        return left.decode("utf-8", "replace")


def decode_ids(ids: np.ndarray, table: list[bytes]) -> Iterator[str]:
    """The text of ``ids`` in pieces of at most DECODE_IDS ids."""
    stream = Utf8Stream()
    for i in range(0, len(ids), DECODE_IDS):
        yield stream.feed(b"".join(map(table.__getitem__, ids[i : i + DECODE_IDS].tolist())))
    yield stream.finish()


def _lists(batch: pa.Array) -> Iterator[np.ndarray]:
    """The values of each list of a list array (a null list is empty)."""
    lengths = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, ends = batch.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
    return (flat[end - n : end] for n, end in zip(lengths, ends))


def worker_coder(name: str, content, pattern: str) -> PieceEncoder:
    """The encoder of this Python worker, kept for its later tasks.  ``name``
    stands for the broadcast ``content``."""
    key = ("bpe", name, pattern)
    lean_memory(keep=key)
    return worker_table(key, lambda: PieceEncoder(Transducer(parse_ranks(content.value)), pattern))


def encode_column(spark: SparkSession, text: Column, rank_path: str, pattern: str, packed: bool = False) -> Column:
    """array<int>, or packed as little-endian unsigned 32-bit integers in a
    binary: the ids of a text column (null: no id)."""
    ranks = read_ranks(rank_path)
    name, content = hashlib.sha256(ranks).hexdigest(), spark.sparkContext.broadcast(ranks)

    @F.arrow_udf("binary" if packed else "array<int>")
    def bpe_ids(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = worker_coder(name, content, pattern)
        for batch in texts:
            ids = coder.encode(batch.to_pylist())
            yield pa.array(ids, pa.binary()) if packed else id_list(ids)

    return bpe_ids.asNondeterministic()(text)


def _token_table(ranks: dict[bytes, int]) -> list[bytes]:
    table = [b""] * (max(ranks.values()) + 1)
    for token, r in ranks.items():
        table[r] = token
    return table


def decode_column(spark: SparkSession, ids: Column, rank_path: str, packed: bool = False) -> Column:
    """string: the text of ids as :func:`encode_column` gives them (null: empty)."""
    content = spark.sparkContext.broadcast(read_ranks(rank_path))

    @F.arrow_udf("string")
    def bpe_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = _token_table(parse_ranks(content.value))
        for batch in batches:
            lists = (np.frombuffer(x, "<u4") for x in batch.fill_null(b"").to_pylist()) if packed else _lists(batch)
            yield pa.array(["".join(decode_ids(x, table)) for x in lists], pa.string())

    return bpe_text(ids)


def round_trip_column(spark: SparkSession, text: Column, rank_path: str, pattern: str) -> Column:
    """struct<ids: binary, text: string>: the packed ids of a text column, and the
    text decoded from them, by one Python worker with one set of tables."""
    ranks = read_ranks(rank_path)
    name, content = hashlib.sha256(ranks).hexdigest(), spark.sparkContext.broadcast(ranks)

    @F.arrow_udf("struct<ids: binary, text: string>")
    def bpe_both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = worker_coder(name, content, pattern)
        table = _token_table(coder.machine.ranks)
        for batch in texts:
            ids = coder.encode(batch.to_pylist())
            back = ["".join(decode_ids(np.frombuffer(x, "<u4"), table)) for x in ids]
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(back, pa.string())], ["ids", "text"])

    return bpe_both.asNondeterministic()(text)


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           packed: bool = False) -> DataFrame:
    """(doc_id, ids) of every row, as tiktoken encodes ordinary text
    with these ranks and this split pattern.

    Null and empty texts have no ids; repeated rows each give a row; an empty
    table gives an empty result; other columns are not read.  Nothing is
    shuffled and a text is never cut.
    """
    arrow_batches(docs.sparkSession, 400)
    return docs.select(F.col(id_col).alias("doc_id"),
                       encode_column(docs.sparkSession, F.col(text_col), rank_path, pattern, packed).alias("ids"))


def decode(encoded: DataFrame, rank_path: str, ids_col: str = "ids", packed: bool = False) -> DataFrame:
    """``encoded`` with column ``text`` decoded from its ids."""
    return encoded.withColumn("text", decode_column(encoded.sparkSession, F.col(ids_col), rank_path, packed))


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): packed ids as :func:`encode` and, in the same pass, the
    text that :func:`decode` makes of them; nulls, repeated rows and empty tables
    as there (a null text comes back as the empty one)."""
    arrow_batches(docs.sparkSession, 400)
    both = round_trip_column(docs.sparkSession, F.col(text_col), rank_path, pattern)
    return docs.select(F.col(id_col).alias("doc_id"), both.alias("both")).select("doc_id", "both.ids", "both.text")


def add_ids(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", ids_name: str = "token_ids",
            count_name: str = "n_tokens") -> DataFrame:
    """``docs`` with its ids and their number; columns of these names are replaced,
    all others stay.  A null or empty text has no ids and the number 0; repeated
    rows each keep theirs; an empty table stays empty."""
    arrow_batches(docs.sparkSession, 400)
    rows = pack(docs).withColumn("_ids", encode_column(docs.sparkSession, F.col(f"_row.{text_col}"), rank_path, pattern))
    kept = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in (ids_name, count_name)]
    return rows.select(*kept, F.size("_ids").cast("long").alias(count_name), F.col("_ids").alias(ids_name))
