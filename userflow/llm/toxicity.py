"""Toxicity scores of restored text.

Noisy channel.  Writers hide words by leet characters (``1d10t``), spacing
(``i d i o t``) and repetition (``idiooot``).  A suspicious token spans a lattice: each
leet character stands for one of its letters (``!`` at the end also for nothing), a
run of three or more equal letters for one or two, three or more single
characters with separators between them for one word.  Tokens may be of any
length and border on ``_``.  Viterbi decoding under a character trigram model (counted
over all documents) and channel costs gives the likeliest word; against it
stands the hypothesis that the token is a code, each character equally likely.

Score.  Evidence is a short list of word beginnings (3 to 12 bytes; characters of
three bytes and more, which scripts without blanks use, each begin one too) and
whole words of any length that toxic texts hold and others do not, learnt from a
bounded sample of labelled rows (``FIT_ROWS``, by the hash of their ids): they
are picked one after the other by the toxic texts that no earlier pick covers,
less a penalty for clean texts newly covered, so copies of one text add
nothing.  A logistic curve on the strongest evidence and the number of picks
found turns it into a score.  Every text is restored and scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm.common import _BYTE_VALUE, _NOT_ALNUM, _power_tables, arrow_batches, mix
from userflow.session import materialize

FIT_ROWS = 20_000
THRESHOLD = 0.7
HOLDOUT_OF, HOLDOUT_AT = 3, 1
GRAM_SIZES = tuple(range(3, 13))
#: A pick must cover this share of the toxic texts anew, a clean text weighs as
#: so many toxic ones.
MIN_COVER, CLEAN_COST = 0.002, 4.0
#: Beginnings in this share of the toxic texts and in hardly any clean one are
#: evidence too, whatever else covers those texts.
COMMON_SHARE, COMMON_CLEAN = 0.05, 0.0005
#: An n-gram must be in this share of the toxic texts to be considered.
MIN_SHARE = 0.004

#: The letters that a character is written for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
LEET_COST, REPEAT_COST, SPACING_COST = 2.0, 1.0, 1.0
_CODE_CHAR = log(1 / 36)
_SYMBOLS = "@$!|+"
_LETTER = "a-zß-öø-ɏ"
_WRITTEN = rf"{_LETTER}0-9{re.escape(_SYMBOLS)}"
_BEGIN, _END = rf"(?<![^\W_])(?<![{re.escape(_SYMBOLS)}])", rf"(?![^\W_])(?![{re.escape(_SYMBOLS)}])"
_SEPARATOR = r"[ ._\-*]+"
_SPACED = re.compile(rf"{_BEGIN}[{_WRITTEN}](?:{_SEPARATOR}[{_WRITTEN}]){{2,}}{_END}")
_LEETED = re.compile(rf"{_BEGIN}(?=[0-9{re.escape(_SYMBOLS)}]*[{_LETTER}])(?=[{_LETTER}]*[0-9{re.escape(_SYMBOLS)}])[{_WRITTEN}]{{3,}}{_END}")
_REPEATED = re.compile(rf"(?<![^\W_])[{_LETTER}]*([{_LETTER}])\1\1[{_LETTER}]*(?![^\W_])")
#: Restored tokens that a worker remembers, of at most so many characters.
MAX_KNOWN_CHARS = 64
MAX_RESTORED = 200_000

#: Character classes of the language model: 0 is a gap, 1-26 a-z, the rest shares five.
CLASSES = 32
_CLASS = np.zeros(0x3000, np.int64)
for _c in range(len(_CLASS)):
    _s = chr(_c).lower()
    if _s.isalpha():
        _CLASS[_c] = ord(_s) - 96 if "a" <= _s <= "z" else 27 + ord(_s[0]) % 5


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < len(_CLASS), _CLASS[np.minimum(points, len(_CLASS) - 1)], 27 + (points % 5).astype(np.int64))


class CharModel:
    """Trigram log probabilities of character classes, add-one smoothed."""

    def __init__(self, counts: np.ndarray):
        table = counts.reshape(CLASSES, CLASSES, CLASSES).astype(np.float64) + 1.0
        self.log_p = np.log(table / table.sum(axis=2, keepdims=True))
        self.rows = self.log_p.tolist()


def class_of(char: str) -> int:
    point = ord(char)
    return int(_CLASS[point]) if point < len(_CLASS) else 27 + point % 5


class Restorer:
    """Viterbi decoding of suspicious tokens, with a bounded table of results."""

    def __init__(self, model: CharModel):
        self.model = model
        self.known: dict[str, str] = {}

    def text(self, text: str) -> str:
        """The lower-cased text, suspicious tokens replaced by what they stand for."""
        low = text.lower()
        low = _SPACED.sub(lambda m: self.token(m.group(), True), low)
        low = _LEETED.sub(lambda m: m.group() if m.group().rstrip("!").isalpha() else self.token(m.group()), low)
        return _REPEATED.sub(lambda m: self.token(m.group()), low)

    def token(self, token: str, spaced: bool = False) -> str:
        out = self.known.get(token)
        if out is None:
            out = self._decode(token, spaced)
            if len(token) <= MAX_KNOWN_CHARS:
                if len(self.known) >= MAX_RESTORED:
                    self.known.clear()
                self.known[token] = out
        return out

    @staticmethod
    def lattice(token: str, spaced: bool) -> list[list[tuple[str, float]]]:
        """What each run of equal characters may stand for, with its cost."""
        chars = re.sub(_SEPARATOR, "", token) if spaced else token
        out = []
        for m in re.finditer(r"(.)\1*", chars, re.S):
            char, n = m.group(1), len(m.group())
            letters = [(char, 0.0)] if char.isalpha() else [(x, LEET_COST) for x in LEET.get(char, "")]
            copies = (n,) if n < 3 else (1, 2)
            out.append([(letter * k, cost * min(n, 2) + (REPEAT_COST if k != n else 0.0)) for letter, cost in letters for k in copies])
        if out and chars[-1] == "!":
            out[-1].append(("", 0.0))
        return out

    def _decode(self, token: str, spaced: bool) -> str:
        rows = self.model.rows
        # (class two back, class one back): (log probability, restored)
        paths = {(0, 0): (-SPACING_COST if spaced else 0.0, "")}
        for options in self.lattice(token, spaced):
            new: dict = {}
            for (a, b), (p, done) in paths.items():
                for written, cost in options:
                    x, y, q = a, b, p - cost
                    for c in written:
                        z = class_of(c)
                        q += rows[x][y][z]
                        x, y = y, z
                    if (x, y) not in new or q > new[x, y][0]:
                        new[x, y] = (q, done + written)
            paths = new
            if not paths:  # a character that stands for no letter
                return token
        best, word = max((p + rows[a][b][0], w) for (a, b), (p, w) in paths.items())
        n_chars = len(re.sub(_SEPARATOR, "", token)) if spaced else len(token)
        return word if best > _CODE_CHAR * n_chars else token


_GRAM_R = np.uint64(0x9E3779B97F4A7C15)


#: Bytes of text whose n-grams are hashed at once (a longer single text is one piece).
_GRAM_BYTES = 1 << 18
_PAD = b" " * (GRAM_SIZES[-1] + 1)


def _grams(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the first 3, 4, ... bytes of every word, also from each character
    of three or more bytes in it, and of the whole words, repeats included, with
    the places where they begin.  Words are runs of letters, marks and digits;
    ``data`` ends with ``_PAD``."""
    buf = np.frombuffer(data, np.uint8)
    gap = _NOT_ALNUM[buf]
    edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=np.int8(1)))
    start, end = edge[0::2], edge[1::2]
    long = end - start > GRAM_SIZES[-1]
    if long.any():
        up, down = _power_tables(len(buf))
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[buf] * up, out=total[1:])
        yield mix((total[end[long]] - total[start[long]]) * down[start[long]] + np.uint64(1000)), start[long]
    inner = np.flatnonzero(buf >= 0xE0)
    if len(inner):
        inner = inner[~np.isin(inner, start, assume_unique=True)]
        start, end = np.append(start, inner), np.append(end, end[np.searchsorted(start, inner, "right") - 1])
    h = np.zeros(len(start), np.uint64)
    for n in range(1, GRAM_SIZES[-1] + 1):
        long_enough = end - start >= n
        start, end, h = start[long_enough], end[long_enough], h[long_enough]
        h = h * _GRAM_R + _BYTE_VALUE[buf[start + n - 1]]
        if n in GRAM_SIZES:
            yield mix(h + np.uint64(n)), start
            whole = end - start == n
            yield mix(h[whole] + np.uint64(1000 + n)), start[whole]


def gram_keys(text: str) -> np.ndarray:
    """The hashes of :func:`_grams` of one text."""
    return np.concatenate([keys for keys, _ in _grams(text.encode("utf-8", "replace") + _PAD)])


@dataclass
class ToxicModel:
    chars: CharModel
    keys: np.ndarray  # sorted
    weights: np.ndarray
    curve: tuple[float, float, float]

    def __post_init__(self):
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def evidence(self, restored: list[str]) -> np.ndarray:
        """Per text 1, the largest weight found, log(1 + picks found), repeats included."""
        out = np.zeros((len(restored), 3))
        out[:, 0] = 1.0
        if not len(self.keys):
            return out
        coded = [t.encode("utf-8", "replace") + _PAD for t in restored]
        ends = np.cumsum([len(c) for c in coded])
        first = 0
        while first < len(coded):  # some texts at a time, each whole
            before = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + _GRAM_BYTES, "right")))
            for keys, start in _grams(b"".join(coded[first:last])):
                near = np.flatnonzero(self.bitmap[(keys >> np.uint64(44)).astype(np.int64)])
                keys = keys[near]
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                hit = self.keys[at] == keys
                text = np.searchsorted(ends, before + start[near[hit]], "right")
                np.maximum.at(out[:, 1], text, self.weights[at[hit]])
                np.add.at(out[:, 2], text, 1.0)
            first = last
        out[:, 2] = np.log1p(out[:, 2])
        return out

    def score(self, evidence: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(evidence @ np.array(self.curve), -30, 30))))


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % HOLDOUT_OF == HOLDOUT_AT, F.lit(False))


def char_counts(rows: DataFrame) -> np.ndarray:
    """Trigram counts of character classes over all texts (a fixed table)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    c = np.concatenate([[0, 0], classes(text), [0]])
                    total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.record_batch({"code": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})

    table = np.zeros(CLASSES**3, np.int64)
    for r in rows.select("text").mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        table[r["code"]] = r["n"]  # at most CLASSES ^ 3 rows
    return table


def _sample(rows: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """(text, toxic): at most ``fit_rows`` labelled rows, one of each text."""
    known = labels.where("toxic IS NOT NULL").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    ids = (rows.where("NOT held").select("doc_id").distinct().join(known, F.col("doc_id") == F.col("label_id"))
           .select(F.col("doc_id").alias("fit_id"), "toxic").orderBy(F.xxhash64("fit_id"), "fit_id").limit(fit_rows))
    ids = materialize(ids)
    # Bounded by fit_rows pairs of numbers.
    return (rows.join(F.broadcast(ids), F.col("doc_id") == F.col("fit_id")).where("text IS NOT NULL")
            .select("text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("text").alias("h"))
            .dropDuplicates(["h"]).select("text", "toxic"))


def _grams_of_toxic(sample: DataFrame, least: int) -> np.ndarray:
    """Keys of n-grams in at least ``least`` toxic texts."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(gram_keys(t)) for t in batch.column("text").to_pylist()]
            if own:
                keys, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.record_batch({"key": pa.array(keys.view(np.int64)), "n": pa.array(n)})

    rows = (sample.where("toxic = 1").select("text").mapInArrow(grams, "key long, n long")
            .groupBy("key").agg(F.sum("n").alias("n")).where(f"n >= {least}").select("key"))
    keys = np.array([r["key"] for r in rows.toLocalIterator()], np.int64).view(np.uint64)
    return np.sort(keys)


def _matches(sample: DataFrame, keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each sampled text the places of its n-grams in ``keys``; its label."""
    shared = sample.sparkSession.sparkContext.broadcast(keys)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                k = np.unique(gram_keys(text))
                at = np.minimum(np.searchsorted(own, k), len(own) - 1)
                found.append(at[own[at] == k].astype(np.int32).tobytes())
            yield pa.record_batch({"toxic": batch.column("toxic"), "found": pa.array(found, pa.binary())})

    # One row for each sampled text.
    rows = sample.mapInArrow(match, "toxic int, found binary").collect()
    return [np.frombuffer(bytes(r["found"]), np.int32) for r in rows], np.array([r["toxic"] for r in rows])


def _clean_counts(sample: DataFrame, keys: np.ndarray) -> np.ndarray:
    """In how many clean sampled texts each key is."""
    shared = sample.sparkSession.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros(len(own), np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                k = np.unique(gram_keys(text))
                at = np.minimum(np.searchsorted(own, k), len(own) - 1)
                total[at[own[at] == k]] += 1
        at = np.flatnonzero(total)
        yield pa.record_batch({"at": pa.array(at), "n": pa.array(total[at])})

    out = np.zeros(len(keys), np.int64)
    for r in (sample.where("toxic = 0").select("text").mapInArrow(count, "at long, n long")
              .groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator()):
        out[r["at"]] = r["n"]
    return out


def _cover(found: list[np.ndarray], toxic: np.ndarray, n_keys: int) -> list[tuple[int, int, int]]:
    """Picks (key place, toxic texts, clean texts) by what they cover anew."""
    by_key: list[list[int]] = [[] for _ in range(n_keys)]
    for i, own in enumerate(found):
        for k in own.tolist():
            by_key[k].append(i)
    texts = [np.array(x, np.int64) for x in by_key]
    open_ = np.ones(len(found), bool)
    weight = np.where(toxic == 1, 1.0, -CLEAN_COST)
    least = max(2.0, MIN_COVER * float((toxic == 1).sum()))
    gain = np.array([weight[t].sum() for t in texts])
    picks = []
    while n_keys:  # each pick covers MIN_COVER anew, so they end
        # Gains only fall as texts are covered... but rise where clean ones are.
        best = int(np.argmax(gain))
        now = float(weight[texts[best]][open_[texts[best]]].sum())
        if now < gain[best] - 1e-9:
            gain[best] = now
            continue
        if now < least:
            break
        own = texts[best]
        picks.append((best, int((toxic[own] == 1).sum()), int((toxic[own] == 0).sum())))
        open_[own] = False
        gain[best] = -1.0
    picked = {k for k, _, _ in picks}
    n_toxic, n_clean = int((toxic == 1).sum()), int((toxic == 0).sum())
    for k, own in enumerate(texts):
        p = int((toxic[own] == 1).sum())
        if k not in picked and p >= COMMON_SHARE * n_toxic and len(own) - p <= COMMON_CLEAN * n_clean:
            picks.append((k, p, len(own) - p))
    return picks


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression (first column: ones)."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(rows: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicModel:
    """Fit on ``rows`` (doc_id, text, held) and ``labels`` (doc_id, toxic)."""
    chars = CharModel(char_counts(rows))
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(chars)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Restorer(shared.value)
        for batch in batches:
            yield pa.record_batch({"text": pa.array([own.text(t) for t in batch.column("text").to_pylist()], pa.string()),
                                   "toxic": batch.column("toxic")})

    sample = materialize(_sample(rows, labels, fit_rows).mapInArrow(restore, "text string, toxic int"))
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    nothing = np.zeros(0, np.uint64)
    prior = log((toxic + 0.5) / (clean + 0.5)) if toxic + clean else -2.0
    keys = _grams_of_toxic(sample, max(3, int(MIN_SHARE * toxic))) if toxic else nothing
    if len(keys):  # far commoner among toxic texts, to begin with
        keys = keys[_clean_counts(sample, keys) * 50 <= max(50, clean)]
    if not len(keys):
        return ToxicModel(chars, nothing, np.zeros(0), (prior, 0.0, 0.0))
    found, label = _matches(sample, keys)
    picks = sorted(_cover(found, label, len(keys)))
    if not picks:
        return ToxicModel(chars, nothing, np.zeros(0), (prior, 0.0, 0.0))
    places = np.array([k for k, _, _ in picks])
    weights = np.array([log((p + 0.5) / (toxic + 1)) - log((c + 0.5) / (clean + 1)) for _, p, c in picks])
    weights = np.maximum(weights, 0.0)
    model = ToxicModel(chars, keys[places], weights, (0.0, 0.0, 0.0))
    x, y = _evidence_of(sample, model)
    model.curve = tuple(_logistic(x, y).tolist())
    return model


def _evidence_of(sample: DataFrame, model: ToxicModel) -> tuple[np.ndarray, np.ndarray]:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = own.evidence(batch.column("text").to_pylist())
            yield pa.record_batch({"toxic": batch.column("toxic"), "a": pa.array(found[:, 1]), "b": pa.array(found[:, 2])})

    # One row for each sampled text.
    rows = sample.mapInArrow(measure, "toxic int, a double, b double").collect()
    return np.array([[1.0, r["a"], r["b"]] for r in rows]), np.array([float(r["toxic"] == 1) for r in rows])


def score_column(model: ToxicModel, text: Column, spark) -> Column:
    """Score of a text column (null: the empty text)."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        restorer = Restorer(own.chars)
        for batch in batches:
            restored = [restorer.text(t or "") for t in batch.to_pylist()]
            yield pa.array([own.score(e) for e in own.evidence(restored)], pa.float64())

    return toxic.asNondeterministic()(text)


def score_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts score as texts without evidence; repeated rows each get
    a row; an id labelled twice is toxic if one label says so; null labels are
    not learnt from; without labels every text has the same low score; an empty
    table gives an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held"))
    model = train(rows, labels, fit_rows)
    return rows.select("doc_id", F.col("held").alias("held_out"), score_column(model, F.col("text"), spark).alias("score")
                       ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
