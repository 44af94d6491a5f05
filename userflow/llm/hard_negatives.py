"""Hard negatives by exact integer inner products.

Vectors are cut to integers and compared by a residue number system: for some
small primes p the residues of both matrices are multiplied in float32, where
every sum stays below 2^24 and so is exact in any order of addition; the scores
modulo the primes give the signed score by Chinese remaindering (mixed radix
with balanced digits).  There are as many primes as the largest possible score
asks for, so the result never depends on rounding.

Anchors meet all rows in blocks: rows and anchors are dealt into blocks of
bounded size by a hash of their id, an equality join on the block's number
brings each row block to each anchor block, and a task returns the best few of
its tiles for every anchor.  A first pass finds the positives, a second one the
negatives within a window that each positive's score sets.  No anchor or row
passes through the driver; it reads three numbers (rows, anchors, largest
component and length).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from userflow.llm.common import limited_batches
from userflow.session import materialize

#: Rows and anchors of one block, anchors scored at once in a task.
ROW_BLOCK, ANCHOR_BLOCK, ANCHOR_STEP = 16384, 2048, 256
#: Components multiplied in one exact float32 product; sums stay below this.
SLICE, EXACT = 1024, 1 << 24
POSITIVES, NEGATIVES = 5, 3
#: Candidates that a task holds before it keeps only the best of them.
HELD_ROWS = 200_000
#: A negative's score lies within these hundredths of its positive's.
WINDOW = (50, 95)
SCALE = 256.0
_NONE = np.iinfo(np.int64).min


def residue_primes(length: int, largest: int) -> list[int]:
    """Primes, largest first, whose product tells apart all inner products of
    ``length`` components of at most ``largest``; sums of a slice stay exact."""
    span, product, out = 2 * max(length, 1) * max(largest, 1) ** 2 + 1, 1, []
    if span >= 1 << 63:
        raise ValueError(f"scores of {length} components up to {largest} do not fit a long")
    half = int(np.sqrt((EXACT - 1) // min(max(length, 1), SLICE)))
    p = 2 * half + 1
    while product < span:
        if all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            out.append(p)
            product *= p
        p -= 2
        if p < 3:
            raise ValueError(f"no primes left for {length} components up to {largest}")
    return out


def residues(matrix: np.ndarray, p: int) -> np.ndarray:
    """Balanced residues of whole doubles, as float32."""
    r = np.fmod(matrix, p)
    h = (p - 1) // 2
    r[r > h] -= p
    r[r < -h] += p
    return r.astype(np.float32)


def _balance(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` (whole float32 below 2^24) taken to a balanced residue, in place;
    right to one p near the ends where |x| is above 2^20."""
    x -= np.rint(x * np.float32(1 / p)) * np.float32(p)
    return x


class Residues:
    """The residue matrices of some vectors (rows), component slice by slice."""

    def __init__(self, matrix: np.ndarray, primes: list[int]):
        self.primes = primes
        self.of = [residues(matrix, p) for p in primes]


def scores(a: Residues, b: Residues) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b`` (longs)."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(a.primes):
        x, y = a.of[i], b.of[i]
        r = np.zeros((len(x), len(y)), np.float32)
        for s in range(0, x.shape[1], SLICE):
            part = x[:, s : s + SLICE] @ y[:, s : s + SLICE].T
            r = _balance(r + _balance(_balance(part, p), p), p)
        if digits:  # what the digits so far leave to this prime
            known = digits[-1].copy()
            for q, d in zip(a.primes[i - 2 :: -1] if i > 1 else [], digits[-2::-1]):
                known = _balance(known * np.float32(q % p) + d, p)
            known = _balance(known, p)
            below = int(np.prod([q % p for q in a.primes[:i]], dtype=object)) % p
            inverse = pow(below, -1, p)
            inverse -= p if inverse > p // 2 else 0
            r = _balance(_balance(r - known, p) * np.float32(inverse), p)
        digits.append(r)
    total, weight = np.zeros(digits[0].shape, np.int64), 1
    for p, d in zip(a.primes, digits):
        total += d.astype(np.int64) * weight
        weight *= p
    return total


def _matrix(cell: bytes, rows: int, length: int) -> np.ndarray:
    return np.frombuffer(cell, np.float64).reshape(rows, length)


def _pack(length: int, scale: float, limit: int):
    """Rows of one block as a few cells (ids ascending), at most ``limit`` in each."""

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        labels = rows.column("label").to_numpy().astype(np.int64)
        vectors = rows.column("vec").combine_chunks()
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        matrix = np.zeros((len(ids), length))
        matrix[np.arange(length) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
        matrix = np.floor(matrix * scale)
        extra = rows.column("found").combine_chunks() if "found" in rows.column_names else None
        out = {"block": [], "ids": [], "labels": [], "vectors": []} | ({"found": []} if extra is not None else {})
        for s in range(0, len(ids), limit):
            at = order[s : s + limit]
            out["block"].append(key[0].as_py())
            out["ids"].append(ids[at].tobytes())
            out["labels"].append(labels[at].tobytes())
            out["vectors"].append(matrix[at].tobytes())
            if extra is not None:
                out["found"].append(extra.take(pa.array(at)).to_pylist())
        types = {"block": pa.int64(), "ids": pa.binary(), "labels": pa.binary(), "vectors": pa.binary(),
                 "found": pa.list_(pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())])))}
        return pa.table({c: pa.array(v, types[c]) for c, v in out.items()})

    return pack


_CELLS = "block long, ids binary, labels binary, vectors binary"
_FOUND = "found array<array<struct<id: long, score: long>>>"


def _blocks(rows: DataFrame, n: int, length: int, scale: float, limit: int) -> DataFrame:
    # The input partition spreads rows that repeat one id.
    dealt = rows.withColumn("block", F.expr(f"pmod(xxhash64(id, spark_partition_id()), {n}L)"))
    return materialize(dealt.groupBy("block").applyInArrow(
        _pack(length, scale, limit), _CELLS + (f", {_FOUND}" if "found" in rows.columns else "")))


def _best_positives(primes: list[int], length: int, positives: int):
    """For each anchor of a tile its best other rows of one label."""

    def tile(a_ids, a_labels, a_vectors, ids, labels, vectors, _found) -> list[tuple]:
        out = []
        for label in np.intersect1d(a_labels, labels):
            mine, theirs = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
            right = Residues(vectors[theirs], primes)
            for s in range(0, len(mine), ANCHOR_STEP):
                some = mine[s : s + ANCHOR_STEP]
                got = scores(Residues(a_vectors[some], primes), right)
                got[a_ids[some][:, None] == ids[theirs][None, :]] = _NONE
                for _ in range(min(positives, len(theirs))):
                    best = got.argmax(1)  # the first of ties: the smallest id
                    value = got[np.arange(len(some)), best]
                    there = value != _NONE
                    out += zip(a_ids[some][there].tolist(), ids[theirs[best]][there].tolist(), value[there].tolist())
                    got[np.arange(len(some)), best] = _NONE
        return out

    return tile


def _best_negatives(primes: list[int], length: int, negatives: int, window: tuple[int, int]):
    """For each anchor and positive of a tile the best rows of other labels in
    the window of the positive's score."""
    low, high = window

    def tile(a_ids, a_labels, a_vectors, ids, labels, vectors, found) -> list[tuple]:
        out = []
        right = Residues(vectors, primes)
        for s in range(0, len(a_ids), ANCHOR_STEP):
            got = scores(Residues(a_vectors[s : s + ANCHOR_STEP], primes), right)
            for i, row in enumerate(got, s):
                bounds = [(f["id"], f["score"], -(-low * f["score"] // 100), high * f["score"] // 100) for f in found[i]]
                bounds = [b for b in bounds if b[2] <= b[3]]
                if not bounds:
                    continue
                within = (row >= min(b[2] for b in bounds)) & (row <= max(b[3] for b in bounds)) & (labels != a_labels[i])
                at = np.flatnonzero(within)
                at = at[np.argsort(-row[at], kind="stable")]  # ties stay by id
                down = -row[at]
                for positive, value, least, most in bounds:
                    start = np.searchsorted(down, -most)
                    out += [(int(a_ids[i]), positive, value, int(ids[x]), int(row[x]))
                            for x in at[start : start + negatives] if row[x] >= least]
        return out

    return tile


def _keep_best(rows: np.ndarray, by: int, n: int) -> np.ndarray:
    """The ``n`` best rows of each value of the first ``by`` columns: the last column
    is the score, the one before it the id that decides ties."""
    order = np.lexsort([rows[:, -2], -rows[:, -1], *(rows[:, c] for c in reversed(range(by)))])
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :by] != rows[:-1, :by]).any(1)
    start = np.flatnonzero(new)
    rank = np.arange(len(rows)) - np.repeat(start, np.diff(np.append(start, len(rows))))
    return rows[rank < n]


def _tiles(anchors: DataFrame, rows: DataFrame, n_rows: int, n_anchors: int, length: int, work: Callable, names: list[str],
           by: int, best: int) -> DataFrame:
    """``work`` on every pair of an anchor block and a row block.  Tiles of one
    anchor block follow one another; a task keeps only the ``best`` rows of all its
    tiles for each value of the first ``by`` columns."""
    spark = rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out(found: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch({c: pa.array(found[:, i].copy()) for i, c in enumerate(names)})

        for batch in batches:
            for t in batch.to_pylist():
                a_ids, ids = np.frombuffer(t["a_ids"], np.int64), np.frombuffer(t["ids"], np.int64)
                found = work(a_ids, np.frombuffer(t["a_labels"], np.int64), _matrix(t["a_vectors"], len(a_ids), length),
                             ids, np.frombuffer(t["labels"], np.int64), _matrix(t["vectors"], len(ids), length), t.get("found"))
                held.append(np.array(found, np.int64).reshape(-1, len(names)))
                size += len(found)
                if size > HELD_ROWS:
                    held = [_keep_best(np.concatenate(held), by, best)]
                    size = len(held[0])
                    if size > HELD_ROWS // 2:  # other anchors have come in between
                        yield out(held[0])
                        held, size = [], 0
        if held:
            yield out(_keep_best(np.concatenate(held), by, best))

    left = anchors.select(F.col("block").alias("a_block"), *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "vectors")],
                          *[c for c in ["found"] if c in anchors.columns])
    pairs = n_rows * n_anchors
    grid = spark.range(0, pairs, 1, min(pairs, 10 * spark.sparkContext.defaultParallelism)).selectExpr(
        f"id % {n_rows} as block", f"id div {n_rows} as a_block")
    full = grid.join(rows, "block").join(left, "a_block").drop("block", "a_block")
    with limited_batches(spark, 1):
        return materialize(full.mapInArrow(run, ", ".join(f"{c} long" for c in names)))


def _best(found: DataFrame, by: list[str], score: str, id_col: str, n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(id_col))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         anchor_every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, scale: float = SCALE, row_block: int = ROW_BLOCK,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``anchor_every``; their positives
    the ``positives`` best other rows of their label; the negatives of a positive
    the ``negatives`` best rows of other labels whose score lies within ``window``
    hundredths of the positive's.  Scores are inner products of
    ``floor(scale * component)``; ties go to the smaller id.

    Rows with a null id, label, vector or component, or a component that is not
    finite, take no part.  Shorter vectors count as filled up with zeros.  Rows
    that repeat an id are so many candidates, but one anchor (its least label and
    vector), and never candidates of an anchor of their id's own label.  Other
    columns are not read; an empty table gives an empty result.  A table whose
    scores could exceed a long is refused with an error.
    """
    vec = f"`{vec_col}`"
    table = rows.selectExpr(f"cast(`{id_col}` as long) as id", f"cast(`{label_col}` as long) as label", f"{vec} as vec").where(
        "id is not null and label is not null and vec is not null and not exists(vec, x -> x is null) and "
        "(size(vec) = 0 or (array_max(vec) < double('Infinity') and array_min(vec) > double('-Infinity')))")
    anchors = table.where(f"id % {int(anchor_every)} = 0").groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.*")
    n, m, length, largest = table.agg(
        F.count("*"), F.count_distinct(F.expr(f"if(id % {int(anchor_every)} = 0, id, null)")), F.max(F.size("vec")),
        F.max(F.expr("greatest(abs(double(array_max(vec))), abs(double(array_min(vec))))"))).head()
    length = max(length or 0, 1)
    primes = residue_primes(length, int(np.ceil((largest or 0.0) * scale)) + 1)
    n_rows, n_anchors = -(-n // row_block) or 1, -(-m // anchor_block) or 1

    blocks = _blocks(table, n_rows, length, scale, row_block)
    first = _tiles(_blocks(anchors, n_anchors, length, scale, anchor_block), blocks, n_rows, n_anchors, length,
                   _best_positives(primes, length, positives), ["anchor_id", "id", "score"], 1, positives)
    found = _best(first, ["anchor_id"], "score", "id", positives).groupBy("anchor_id").agg(
        F.collect_list(F.struct("id", "score")).alias("found"))
    ready = anchors.join(found, anchors["id"] == found["anchor_id"]).drop("anchor_id")
    second = _tiles(_blocks(ready, n_anchors, length, scale, anchor_block), blocks, n_rows, n_anchors, length,
                    _best_negatives(primes, length, negatives, window),
                    ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"], 2, negatives)
    return _best(second, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle_sql() -> str:
    """The registered query in DuckDB SQL."""
    return f"""
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                 CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}),
    n AS (SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
                 row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
          FROM p JOIN s USING (anchor_id)
          WHERE NOT same AND {WINDOW[0]} * positive_score <= 100 * score AND 100 * score <= {WINDOW[1]} * positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= {NEGATIVES}"""
