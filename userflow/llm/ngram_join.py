"""Jaccard self-join of documents over word n-grams: size-banded tiles, hashed
bitmaps, exact sorted-array intersection.

A document's set holds the 64-bit hashes of its distinct n-word shingles.  Equal
sets form one class, and only one row of a class is compared.

Bands and tiles.  Two sets of sizes s and t that link differ in at most
``d = (s + t) * (1 - J) / (1 + J)`` shingles.  Pairs are banded by d; the hash
space of a band is cut into more than d parts, so a linked pair agrees on the
whole content of some part.  A tile holds the classes with one content in one
part of one band; a class is in the one or two bands its size can meet.  (Parts
with very few shingles say little.  Each band has some spare parts, so a linked
pair agrees on more parts than a class may leave out; a class with more thin
parts than that is listed under all of them.)

Pairs.  A tile of two is a pair.  In a larger tile every member is first paired
with the tile's most central member (that with the most company in its tiles:
of a text and its edited copies, the text).  Classes that link are joined to
components; tiles that still span several components are finished by all their
pairs (up to :data:`SMALL_TILE` members) or, beyond, in bounded blocks: classes
connected by such tiles form a crowd, its members are dealt into blocks, and
pairs of blocks are compared in tasks that return only a spanning forest.
Blocks within the largest component of a crowd are never compared.

Check.  Each class has a bitmap of its hashes (at least two bits a shingle).  A
bit of one bitmap missing in the other is a shingle missing there, which bounds
the overlap from above; pairs that pass are compared by their sorted arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm.common import limited_batches, mix, pieces, settings, shingle_hashes, text_bytes, word_hashes
from userflow.llm.components import connected_components
from userflow.session import materialize

SHINGLE_WORDS = 3
#: Two sets link when ``intersection / union >= 90 / 100``.
SIMILARITY = (90, 100)
#: Parts with at most so many shingles are thin; one spare part for so many parts.
THIN, SPARE_EVERY = 2, 16
#: Members of a tile up to which its pairs are listed.
SMALL_TILE = 16
#: Members of a block of a crowd.
BLOCK = 256
#: Measured size up to which a side of the many small joins is broadcast.
BROADCAST = "4MB"
#: Rows of an Arrow batch of texts, and of pairs of whole arrays.
BATCH_ROWS, ARRAY_ROWS = 250, 64

_TOPS = [1]  # largest difference of each band, a quarter wider each time
while _TOPS[-1] < 1 << 40:
    _TOPS.append(max(_TOPS[-1] + 1, _TOPS[-1] * 5 // 4))
_BANDS = np.array(_TOPS, np.int64)
_OTHER = np.uint64(0xA0761D6478BD642F)


def shingle_set(words: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of one text's word hashes (fewer words
    than ``k``: the whole sequence as one; no word: none)."""
    return np.unique(shingle_hashes(words, min(k, len(words)))) if len(words) else np.zeros(0, np.uint64)


def bitmap(found: np.ndarray) -> bytes:
    """One bit for each hash, at least two bits of room a hash (a power of two)."""
    width = 1 << max(6, (2 * len(found) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(found & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap (last axis) as one of ``size`` bytes (a power of two below its own)."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def may_link(n_a, bits_a: np.ndarray, n_b, bits_b: np.ndarray, similarity=SIMILARITY) -> np.ndarray:
    """Whether the bit counts leave room for a link.  ``n_b`` and ``bits_b`` may be
    one set or many (one row each)."""
    num, den = similarity
    size = min(bits_a.shape[-1], bits_b.shape[-1])
    a, b = (_fold(x, size).view(np.uint64) for x in (bits_a, bits_b))
    only_a = np.bitwise_count(a & ~b).sum(-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(-1, dtype=np.int64)
    most = np.minimum(n_a - only_a, n_b - only_b)
    return most * (den + num) >= num * (n_a + n_b)


def linked(a: np.ndarray, b: np.ndarray, similarity=SIMILARITY) -> bool:
    """Exact test on two sorted arrays of distinct hashes."""
    num, den = similarity
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int(np.count_nonzero(b[at] == a))
    return shared * (den + num) >= num * (len(a) + len(b))


def tile_signatures(found: np.ndarray, similarity=SIMILARITY) -> np.ndarray:
    """The tiles of one set, each as a long.  Linked, unequal sets share one."""
    num, den = similarity
    n = len(found)
    least, most = (((n + t) * (den - num)) // (den + num) for t in (-(-n * num // den), n * den // num))
    if most < 1:  # only equal sets link
        return np.zeros(0, np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(found), dtype=np.uint64)])
    high, out = found >> np.uint64(32), []
    for band in range(np.searchsorted(_BANDS, max(least, 1)), np.searchsorted(_BANDS, most) + 1):
        d = int(_BANDS[band])
        spare = (d + 1) // SPARE_EVERY
        parts = d + 1 + spare
        edge = np.searchsorted((high * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
        salt = mix(np.arange(1, parts + 1, dtype=np.uint64) + np.uint64(band << 48))
        sig = mix(total[edge[1:]] - total[edge[:-1]] + salt)
        thick = np.diff(edge) > THIN
        out.append(sig[thick] if parts - np.count_nonzero(thick) <= spare else sig)
    return np.concatenate(out)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    for _, texts in pieces(text_bytes(batch.column("text"))):
        hashes, at = word_hashes(texts)
        for a, b in zip(at, at[1:]):
            yield shingle_set(hashes[a:b], k)


def _describe(k: int, similarity):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, prints, bits, sigs = [], [], [], []
            for found in _sets(batch, k):
                n.append(len(found))
                prints.append((mix(found).sum(dtype=np.uint64), mix(found ^ _OTHER).sum(dtype=np.uint64)))
                bits.append(bitmap(found))
                sigs.append(tile_signatures(found, similarity))
            ends = np.cumsum([0, *map(len, sigs)]).astype(np.int32)
            tiles = np.concatenate([*sigs, np.zeros(0, np.uint64)]).view(np.int64)
            prints = np.array(prints, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "t1": batch.column("t1"), "t2": batch.column("t2"),
                "n": pa.array(n, pa.int64()), "h1": pa.array(prints[:, 0].copy()), "h2": pa.array(prints[:, 1].copy()),
                "bits": pa.array(bits, pa.binary()), "sigs": pa.ListArray.from_arrays(ends, pa.array(tiles))})

    return describe


def _arrays(k: int):
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.tobytes() for x in _sets(batch, k)]
            yield pa.record_batch({"cid": batch.column("cid"), "hashes": pa.array(found, pa.binary())})

    return arrays


def _text_key(text: str | Column) -> list[Column]:
    """Two seeded hashes of a text, by which it is found again in its table."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(F.lit(i), text).alias(f"t{i}") for i in (1, 2)]


def _may_link_udf(similarity):
    @F.arrow_udf("boolean")
    def check(n_a: pa.Array, bits_a: pa.Array, n_b: pa.Array, bits_b: pa.Array) -> pa.Array:
        return pa.array([bool(may_link(n, np.frombuffer(x, np.uint8), m, np.frombuffer(y, np.uint8), similarity))
                         for n, x, m, y in zip(*(c.to_pylist() for c in (n_a, bits_a, n_b, bits_b)))], pa.bool_())

    return check


def _linked_udf(similarity):
    @F.arrow_udf("boolean")
    def check(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity)
                         for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())

    return check


def _both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` (a, b) with ``columns`` of ``table`` (by cid) of either side."""
    for side in ("a", "b"):
        pairs = pairs.join(table.select(F.col("cid").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def _verified(pairs: DataFrame, bits: DataFrame, arrays: DataFrame, similarity) -> DataFrame:
    """The linked ones of distinct candidate pairs: bit counts, then arrays."""
    close = _both(pairs, bits, ["n", "bits"]).where(_may_link_udf(similarity)("n_a", "bits_a", "n_b", "bits_b"))
    close = materialize(close.select("a", "b"))
    with limited_batches(pairs.sparkSession, ARRAY_ROWS):  # two whole arrays a row
        return materialize(_both(close, arrays, ["hashes"]).where(_linked_udf(similarity)("hashes_a", "hashes_b")).select("a", "b"))


def _block_links(similarity):
    """Compares the members of two blocks (or within one) of a crowd."""

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block, ids, n = (np.array(rows.column(c).to_pylist(), np.int64) for c in ("block", "cid", "n"))
        parent = {x: x for x in rows.column("root").to_pylist()}
        roots = rows.column("root").to_pylist()

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        bits = [np.frombuffer(x, np.uint8) for x in rows.column("bits").to_pylist()]
        arrays = [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
        width = np.array([len(x) for x in bits])
        out = []
        first = np.flatnonzero(block == i)
        second = first if i == j else np.flatnonzero(block == j)
        classes = [(at, np.stack([bits[x] for x in at])) for w in np.unique(width[second])
                   for at in [second[width[second] == w]]]
        for x in first:
            for at, maps in classes:
                near = at[may_link(n[x], bits[x], n[at], maps, similarity)]
                for y in near[near > x] if i == j else near:
                    a, b = find(roots[x]), find(roots[y])
                    if a != b and linked(arrays[x], arrays[y], similarity):
                        parent[max(a, b)] = min(a, b)
                        out.append((ids[x], ids[y]))
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _crowd_links(tiles: DataFrame, bits: DataFrame, arrays: DataFrame, similarity, block: int = BLOCK) -> DataFrame:
    """Links that finish the tiles (sig, cid, root): a pair of blocks at a time.
    Components that share a tile are of one crowd."""
    held = tiles.select("sig", "root").distinct()
    first = held.groupBy("sig").agg(F.min("root").alias("first"))
    crowds = connected_components(held.join(first, "sig").select("root", "first"), "root", "first")
    members = materialize(tiles.select("cid", "root").distinct().join(
        crowds.select(F.col("node").alias("root"), F.col("root").alias("crowd")), "root"))
    sizes = members.groupBy("crowd", "root").agg(F.count("*").alias("n"))
    plan = sizes.groupBy("crowd").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("all")).selectExpr(
        "crowd", "main.root as main_root", f"ceil((all - main.n) / {block}) as rest_blocks",
        f"ceil(main.n / {block}) as main_blocks")
    dealt = (members.join(plan, "crowd").withColumn("is_main", F.expr("root = main_root"))
             .withColumn("block", F.expr("if(is_main, rest_blocks + pmod(xxhash64(cid), main_blocks), pmod(xxhash64(cid), rest_blocks))"))
             .withColumn("other", F.expr("explode(sequence(0, if(is_main, rest_blocks, rest_blocks + main_blocks) - 1))"))
             .selectExpr("crowd", "least(block, other) as i", "greatest(block, other) as j", "block", "cid", "root"))
    full = dealt.join(bits, "cid").join(arrays, "cid")
    return materialize(full.groupBy("crowd", "i", "j").applyInArrow(_block_links(similarity), "a long, b long"))


def _pairs_of_lists(lists: DataFrame) -> DataFrame:
    """(a, b) of every two members of a short list ``m`` in different components."""
    each = ("flatten(transform(m, (x, i) -> transform(filter(slice(m, i + 2, size(m)), y -> y.root <> x.root), "
            "y -> struct(least(x.cid, y.cid) as a, greatest(x.cid, y.cid) as b))))")
    return lists.selectExpr(f"explode({each}) as p").select("p.a", "p.b").distinct()


def _joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (cid, root; a class without a row is its own root) after more
    links: only the components that they join are looked at again."""
    ends = links.withColumn("no", F.struct("a", "b"))
    for side in ("a", "b"):
        ends = ends.join(roots.select(F.col("cid").alias(side), F.col("root").alias(f"root_{side}")), side, "left").withColumn(
            f"root_{side}", F.coalesce(f"root_{side}", side))
    moved = materialize(connected_components(ends.select("root_a", "root_b").distinct(), "root_a", "root_b")
                        .select(F.col("node").alias("root"), F.col("root").alias("to")))
    old = roots.join(moved, "root", "left").select("cid", F.coalesce("to", "root").alias("root"))
    new = moved.join(roots, moved["root"] == roots["cid"], "left_anti").select(F.col("root").alias("cid"), F.col("to").alias("root"))
    return materialize(old.unionByName(new))


def _open(tiles: DataFrame, roots: DataFrame) -> DataFrame:
    """The tiles (sig, cid, size, root) that span several components."""
    state = materialize(tiles.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    several = state.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("sig")
    return materialize(state.join(several, "sig", "left_semi"))


def class_roots(reps: DataFrame, arrays_of, similarity=SIMILARITY, small: int = SMALL_TILE, block: int = BLOCK) -> DataFrame:
    """(cid, root): for every class with a link the smallest class it reaches.

    ``reps``: cid, n, bits, sigs; ``arrays_of(cids)`` gives (cid, hashes)."""
    bits = reps.select("cid", "n", "bits")
    signed = reps.select("cid", F.explode("sigs").alias("sig"))
    groups = materialize(signed.groupBy("sig").agg(
        F.count("*").alias("size"), F.min("cid").alias("a"), F.max("cid").alias("b")).where("size > 1"))
    twos = groups.where("size = 2").select("a", "b")
    tiles = materialize(signed.join(groups.where("size > 2").select("sig", "size"), "sig"))
    company = tiles.groupBy("cid").agg(F.sum("size").alias("company"))
    pivots = tiles.join(company, "cid").groupBy("sig").agg(F.max(F.struct("company", "cid")).alias("best"))
    stars = tiles.join(pivots.select("sig", F.col("best.cid").alias("pivot")), "sig").where("cid <> pivot").select(
        F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b"))
    pairs = materialize(twos.unionByName(stars).distinct())
    met = pairs.selectExpr("explode(array(a, b)) as cid").unionByName(tiles.select("cid")).distinct()
    arrays = materialize(arrays_of(met))
    links = _verified(pairs, bits, arrays, similarity)
    roots = materialize(connected_components(links).withColumnRenamed("node", "cid"))

    left = _open(tiles, roots)
    lists = left.where(F.col("size") <= small).groupBy("sig").agg(F.collect_list(F.struct("cid", "root")).alias("m"))
    more = materialize(_pairs_of_lists(lists).join(pairs, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        roots = _joined_roots(roots, _verified(more, bits, arrays, similarity))
    large = left.where(F.col("size") > small)
    if not large.isEmpty():
        large = _open(large.drop("root"), roots)
        roots = _joined_roots(roots, _crowd_links(large.select("sig", "cid", "root"), bits, arrays, similarity, block))
    return roots


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                      similarity: tuple[int, int] = SIMILARITY, small: int = SMALL_TILE, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id): per row the size of its shingle set
    and the smallest id it reaches over links.

    Words are the maximal runs outside ``[\\x20\\x09-\\x0D]``, A-Z in lower case.
    A text with fewer than ``k`` words is one shingle; null, empty and word-less
    texts have none, link with nothing and keep their own id.  Repeated rows and
    ids each get a row; a null id is never a component id unless a component has
    no other.  An empty table gives an empty result; columns beside the two are
    not read.
    """
    with settings(docs.sparkSession, {
            "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
            "spark.sql.autoBroadcastJoinThreshold": BROADCAST, "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST}):
        return _similar(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")),
                        k, similarity, small, block)


def _similar(docs: DataFrame, k: int, similarity, small: int, block: int) -> DataFrame:
    source = docs.select("doc_id", *_text_key(F.col("text")), "text")
    id_type = source.schema["doc_id"].dataType.simpleString()
    rows = materialize(source.mapInArrow(
        _describe(k, similarity),
        f"doc_id {id_type}, t1 long, t2 long, n long, h1 long, h2 long, bits binary, sigs array<long>")
        .withColumn("cid", F.monotonically_increasing_id()))  # written: the numbers stay
    classes = materialize(rows.where("n > 0").groupBy("h1", "h2", "n").agg(
        F.min("cid").alias("cid"), F.min("doc_id").alias("least")))
    reps = materialize(rows.join(classes.select("cid"), "cid", "left_semi"))

    def arrays_of(cids: DataFrame) -> DataFrame:
        wanted = materialize(reps.join(cids, "cid", "left_semi").select("cid", "t1", "t2", F.col("doc_id").alias("_id")))
        found = source.join(wanted, ["t1", "t2"]).where(F.col("doc_id").eqNullSafe(F.col("_id")))
        return found.select("cid", "text").mapInArrow(_arrays(k), "cid long, hashes binary").dropDuplicates(["cid"])

    roots = class_roots(reps, arrays_of, similarity, small, block)
    rooted = materialize(classes.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = materialize(rooted.join(least, "root").select("h1", "h2", "n", "component_id"))
    return materialize(rows.select("doc_id", "n", "h1", "h2").join(of_class, ["h1", "h2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
