"""SimHash near-duplicates over deletion-variant signatures.

Fingerprints at most ``d`` bits apart, cut into ``ceil((d + 1) / 2)`` segments
(fewer than the ``d + 1`` of plain blocks), agree in some segment but for one
bit.  So every fingerprint is indexed under each of its segments with each one
bit wildcarded; fingerprints that share a signature are candidates, verified
by their bit distance.  Only distinct fingerprints are indexed: copies with
one fingerprint are linked through it.

A signature with two fingerprints gives its pair from the pre-aggregated
minimum and maximum.  Fingerprints under a signature with more are looked up
once more with up to ``d`` wildcards in the whole fingerprint (for the default
two bits: two in one half, or one in each), where a signature has at most
2^d members: no crowded signature is ever expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm.common import arrow_batches, lean_memory, mix, pack, text_bytes, unpack
from userflow.llm.components import connected_components
from userflow.session import materialize

SHINGLE_WORDS = 3
MAX_BITS = 2
BITS = 64
#: Rows (longs) of a written table up to which it is broadcast.
BROADCAST_ROWS = 1_000_000
_SEED = 42


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text (none or no word: zero)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < k:
        hashes = [digest(b" ".join(words), _SEED)]
    else:
        hashes = [digest(b" ".join(run), _SEED) for run in zip(*(words[i:] for i in range(k)))]
    counts = np.zeros(BITS, np.int64)
    all_hashes = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    for i in range(0, len(all_hashes), 1 << 16):
        counts += np.unpackbits(all_hashes[i : i + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(np.uint64)[0])


def _fingerprint_udf(k: int):
    @F.arrow_udf("long")
    def simhash(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lean_memory()
        for batch in texts:
            prints = np.fromiter((fingerprint(t, k) for t in text_bytes(batch)), np.uint64, len(batch))
            yield pa.array(prints.view(np.int64))

    return simhash


def simhash_column(text: str | Column, k: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long (null text: 0)."""
    return _fingerprint_udf(k)(F.col(text) if isinstance(text, str) else text)


def _masks(bits: int, max_bits: int) -> list[int]:
    """For each segment and each bit in it, what is kept of the fingerprint."""
    segments = max_bits // 2 + 1
    cuts = [bits * i // segments for i in range(segments + 1)]
    out = []
    for lo, hi in zip(cuts, cuts[1:]):
        whole = ((1 << hi) - 1) ^ ((1 << lo) - 1)
        out += [whole ^ (1 << b) for b in range(lo, hi)]
    return out


def _signatures(fps: DataFrame, masks: list[int]) -> DataFrame:
    """(fp, sig): the fingerprint under every mask, hashed together with the
    mask's number into one long.  Two signatures that collide only add
    candidates, which are verified.  Every row becomes many, so the rows are
    dealt out first."""
    table = np.array(masks, np.uint64)
    salt = mix(np.arange(1, len(masks) + 1, dtype=np.uint64))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            step = max(1, (1 << 18) // len(table))
            for i in range(0, len(fp), step):
                some = fp[i : i + step]
                sig = mix((some.view(np.uint64)[:, None] & table[None, :]) ^ salt[None, :])
                yield pa.record_batch({"fp": pa.array(np.repeat(some, len(table))),
                                       "sig": pa.array(sig.view(np.int64).ravel())})

    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fps.select("fp").repartition(spread, "fp").mapInArrow(expand, "fp long, sig long")


def _small(df: DataFrame) -> DataFrame:
    """``df`` (a written table of one long), broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): every pair of different fingerprints in column ``fp`` (distinct
    longs) that differ in at most ``max_bits`` bits, perhaps repeated.

    Pairs of a signature with up to two members come from its minimum and
    maximum; larger ones go through :func:`_crowded_pairs`."""
    signed = _signatures(fps, _masks(BITS, max_bits))
    groups = materialize(signed.groupBy("sig").agg(
        F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
    near = F.expr(f"bit_count(a ^ b) <= {max_bits}")
    pairs = groups.where(near).select("a", "b")
    crowded = materialize(groups.where("n > 2").select("sig"))
    if crowded.isEmpty():
        return pairs
    members = materialize(signed.join(_small(crowded), "sig", "left_semi").select("fp").distinct())
    return pairs.unionByName(_crowded_pairs(members, max_bits))


def _crowded_pairs(fps: DataFrame, max_bits: int) -> DataFrame:
    """Pairs within ``max_bits`` among ``fps`` with a signature for every choice
    of ``max_bits`` wildcards in the whole fingerprint: a signature has at most
    2^max_bits members, so the pairs of its short list are bounded."""
    whole = (1 << BITS) - 1
    masks = [whole ^ sum(1 << b for b in chosen) for chosen in combinations(range(BITS), max_bits)]
    lists = (_signatures(fps, masks).groupBy("sig")
             .agg(F.sort_array(F.collect_list("fp")).alias("m")).where("size(m) > 1"))
    return lists.selectExpr("explode(flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), "
                            "y -> struct(x as a, y as b))))) as p").select("p.a", "p.b").where(
        f"bit_count(a ^ b) <= {max_bits}").distinct()  # signatures can collide


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root): fingerprints with a near one, and one fingerprint of their
    component.  ``fps`` holds column ``fp`` (repeats allowed)."""
    distinct = materialize(fps.select("fp").where("fp is not null").distinct())
    return (connected_components(near_pairs(distinct, max_bits))
            .select(F.col("node").alias("fp"), "root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): per row its fingerprint (signed long) and the
    smallest id of the rows its fingerprint reaches over links of at most
    ``max_bits`` bits.

    Null and word-less texts have fingerprint 0 and link as any other.  Rows
    that repeat an id each get a row; null ids never become a component id
    unless a component has no other.  An empty table gives an empty result.
    Other columns of ``docs`` are not read.
    """
    arrow_batches(docs.sparkSession)
    rows = materialize(docs.select(F.col(id_col).alias("doc_id"), simhash_column(text_col, k).alias("fp")))
    firsts = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    linked = link_fingerprints(firsts, max_bits)
    grouped = firsts.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    grouped = materialize(grouped)
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = materialize(grouped.join(least, "root").select("fp", "component_id"))
    return rows.join(of_print, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that with the
    smallest id (rows without an id last; of rows with one id, the first).

    Any columns are passed through unchanged, whatever their names.
    """
    arrow_batches(docs.sparkSession)
    rows = materialize(pack(docs).select(
        "_row", F.monotonically_increasing_id().alias("_no"), simhash_column(F.col(f"_row.{text_col}"), k).alias("fp")))
    order = F.struct(F.col(f"_row.{id_col}").isNull().alias("no_id"), F.col(f"_row.{id_col}").alias("id"),
                     F.col("_no").alias("no"))
    firsts = materialize(rows.groupBy("fp").agg(F.min(order).alias("first")))
    linked = link_fingerprints(firsts, max_bits)
    grouped = materialize(firsts.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"))
    chosen = grouped.groupBy("root").agg(F.min("first").alias("first"))
    of_print = materialize(grouped.select("fp", "root").join(chosen, "root").select("fp", F.col("first.no").alias("chosen")))
    # Few rows go, compared with those that stay: the texts are only matched with these.
    gone = materialize(rows.select("fp", "_no").join(of_print, "fp").where("_no <> chosen").select("_no"))
    return unpack(rows.join(_small(gone), "_no", "left_anti"))
