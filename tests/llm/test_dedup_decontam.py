"""Near-duplicates, components and decontamination against brute force."""

import random
from collections import Counter

import numpy as np

from userflow.llm import components, decontam, simhash
from userflow.llm.common import shingle_hashes, text_bytes, word_hashes

from llm_fixtures import frame, words  # noqa: F401


def union_find(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)]  # a chain and a star
    edges += [(rng.randint(200, 320), rng.randint(200, 320)) for _ in range(70)] + [(5, 5), (7, None), (0, 1)]
    got = {r["node"]: r["root"] for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if b is not None and a != b]
    want = union_find(400, real)
    assert got == {x: want[x] for e in real for x in e}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_crowded_signatures_link_every_near_pair(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {base} | {base ^ (1 << i) for i in range(0, 64, 3)}  # one crowd
    prints |= {base ^ (1 << i) ^ (1 << (i + 5)) ^ (1 << (i + 9)) for i in range(20)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {tuple(sorted(r)) for r in simhash.near_pairs(df).collect()}
    mask = (1 << 64) - 1
    want = {tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & mask).bit_count() <= 2}
    assert got == want


def _brute_fingerprint(text):
    import xxhash

    w = (text or "").encode().lower().split()
    runs = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_brute_force_and_edges(frame):
    long = words(400)
    rows = [(5, long), (3, long), (9, long.upper()), (8, long + " tail"), (1, None), (2, ""), (4, " \t\n"), (6, "one"),
            (7, "one two"), (7, "one two"), (10, words(30, 2)), (None, words(30, 2)), (None, "alone here again")]
    got = sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(frame(rows)).collect()), key=repr)
    fps = [_brute_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    roots = union_find(len(rows), pairs)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted(((i, f - (1 << 64) if f >> 63 else f, least.get(r)) for (i, _), f, r in zip(rows, fps, roots)), key=repr)
    assert got == want
    assert simhash.near_duplicates(frame([])).count() == 0


def test_keep_one_keeps_the_smallest_id_and_all_columns(frame):
    df = frame([(5, words(200)), (3, words(200)), (3, words(200)), (9, words(50, 4)), (None, words(50, 4)), (2, None), (1, "")])
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 9]


def test_word_hashes_split_like_the_pattern():
    texts = ["A b\tC", "", "x", None, "é É z", "a\x0bb\x0cc\x1cd"]
    import pyarrow as pa

    hashes, at = word_hashes(text_bytes(pa.array(texts)))
    lists = [hashes[a:b].tolist() for a, b in zip(at, at[1:])]
    other, at2 = word_hashes([b"a", b"b", b"c", b"x", "é".encode(), "É z".encode(), b"c\x1cd"])
    one = dict(zip("abcxéÉd", (int(h) for h in other)))
    assert lists == [[one["a"], one["b"], one["c"]], [], [one["x"]], [], [one["é"], one["É"]], [one["a"], one["b"], one["d"]]]
    assert len(set(one.values())) == 7


def _brute_leaks(docs, items, k=5, t=0.8):
    def toks(x):
        return [int(h) for h in word_hashes([(x or "").encode()], "alnum")[0]]

    out = {}
    for d, text in docs:
        for item, body in items:
            w = toks(body)
            if not w:
                continue
            width = min(k, len(w))
            own = shingle_hashes(np.array(w, np.uint64), width).tolist()
            doc = shingle_hashes(np.array(toks(text), np.uint64), width).tolist()
            n = min(len(own), len(doc))
            best = 0
            for s in range(len(doc) - n + 1 if n else 0):
                shared = sum((Counter(own) & Counter(doc[s:s + n])).values())
                best = max(best, shared / (len(own) + n - shared))
            if best >= t:
                out[d, item] = round(best, 9)
    return out


def test_leaks_match_every_window_compared(frame, spark):
    item = words(40, 9)
    w = item.split()
    items = [(1, item), (2, words(22, 11)), (3, "only three words"), (4, None), (5, ""), (6, words(60, 13)),
             (7, " ".join(["again"] * 12))]
    docs = [(1, words(80, 20) + " " + item.upper() + ", " + words(30, 21)), (2, None), (3, ""), (4, words(200, 22)),
            (5, "x " + " ".join(w[:38]) + " y z " + words(22, 11)),          # cut at the end
            (6, " ".join(w[:20] + ["changed"] + w[20:])),                     # one word put in
            (7, " ".join(w[:10] + ["a", "b", "c"] + w[10:])), (8, "well only three words here"),
            (9, " ".join(["again"] * 30)), (10, words(48, 13)), (10, item), (11, "again again")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in decontam.find_leaks(frame(docs), bench).collect()}
    assert got == _brute_leaks(docs, items)
    every = decontam.find_leaks(frame(docs), bench, prefilter=False)
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in every.collect()} == got
    sliced = decontam.find_leaks(frame(docs), bench, slice_chars=50)
    assert sorted(map(tuple, sliced.collect())) == sorted(map(tuple, decontam.find_leaks(frame(docs), bench).collect()))
    left = decontam.drop_leaks(frame(docs), bench)
    assert left.columns == frame(docs).columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(d for d, t in docs if not _brute_leaks([(d, t)], items))
    assert decontam.find_leaks(frame([]), bench).count() == 0
    assert decontam.find_leaks(frame(docs), bench.limit(0)).count() == 0


def test_multi_index_finds_all_items_within_the_radius():
    rng = np.random.default_rng(2)
    items = [(i, words(12, 50 + i).encode()) for i in range(60)]
    index = decontam.ItemIndex(items, 5, 0.8, 18)
    size = index.sizes[5][8]
    size.probes = [decontam._flips(r) for r in decontam._block_radii(18)]  # look blocks up, although there are few items
    for print_ in [*rng.integers(0, 2**63, 60, dtype=np.uint64), *size.prints]:
        for _ in range(3):
            near = print_
            for b in rng.choice(64, rng.integers(0, 19), replace=False):
                near ^= np.uint64(1) << np.uint64(b)
            want = {j for j, p in enumerate(size.prints) if int(near ^ p).bit_count() <= 18}
            assert {j for j, _ in index._near(size, near)} == want


def _item_and_window(rng, n, refrain):
    """An item of n words and a text that holds it with its refrain of one
    repeated word replaced by another's: similarity close above 0.8."""
    body = [f"w{rng.randrange(10**6)}" for _ in range(n - refrain)]
    return (" ".join(body + ["la"] * refrain), " ".join(body + ["na"] * refrain))


def test_items_with_refrains_are_found(frame, spark):
    rng = random.Random(3)
    items, docs = [], []
    for i in range(45):
        n = (45, 85, 135, 235)[i % 4]
        item, text = _item_and_window(rng, n, int(n * 0.1))
        items.append((i, item))
        docs.append((i, words(30, i, "x") + " " + text + " " + words(20, i, "y")))
    want = _brute_leaks(docs[:12], items[:12])
    assert len(want) >= 10
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in decontam.find_leaks(frame(docs), bench).collect()}
    assert {k: v for k, v in got.items() if k[0] < 12} == want
    assert {d for d, _ in got} >= {d for d, _ in want} and len(got) >= 40


def test_repeated_shingles_match_every_window_compared(frame, spark):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice("a b c d e".split()) for _ in range(rng.randint(6, 40)))) for i in range(12)]
    items += [(20, "x y " * 15), (21, "la " * 30), (22, words(20, 3) + " la la la la la")]
    docs = [(i, " ".join(rng.choice("a b c d e la x y".split()) for _ in range(rng.randint(5, 70)))) for i in range(30)]
    docs += [(100 + i, t[: len(t) * 9 // 10] + " la la") for i, t in items] + [(200, words(20, 3) + " na na na na na")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in decontam.find_leaks(frame(docs), bench).collect()}
    assert got == _brute_leaks(docs, items) and got


def test_items_without_an_id_or_with_text_ids(frame, spark):
    text = words(40, 4)
    docs = [(1, words(5, 1) + " " + text), (2, words(60, 2)), (None, text)]
    for schema, ids in (("item_id long, text string", [None, 7]), ("item_id string, text string", [None, "it-7"])):
        bench = spark.createDataFrame([(ids[0], text), (ids[1], words(30, 9)), (ids[0], words(33, 6))], schema)
        found = decontam.find_leaks(frame(docs), bench).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in found if r["doc_id"]) == [(1, None)] and len(found) == 2
        assert [r["doc_id"] for r in decontam.drop_leaks(frame(docs), bench).collect()] == [2]
        assert [r["doc_id"] for r in decontam.drop_leaks(frame(docs), bench, slice_chars=50).collect()] == [2]
        assert decontam.find_leaks(frame(docs), bench, slice_chars=50).count() == 2


def test_colliding_signatures_give_no_far_pairs(spark):
    whole = (1 << 64) - 1
    masks = [whole ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a + 1, 64)]
    salts = simhash.mix(np.arange(1, len(masks) + 1, dtype=np.uint64)).tolist()
    rng = random.Random(2)
    prints = []
    while len(prints) < 8:  # x under mask i and y under mask j have one signature
        x, i = rng.getrandbits(64), rng.randrange(len(masks))
        for j in rng.sample(range(len(masks)), 400):
            y = (x & masks[i]) ^ salts[i] ^ salts[j]
            if y & masks[j] == y and (x ^ y).bit_count() > 2:
                prints += [x, y]
                break
    near = prints[0] ^ 5
    signed = [v - (1 << 64) if v >> 63 else v for v in [*prints, near]]
    got = simhash._crowded_pairs(spark.createDataFrame([(v,) for v in signed], "fp long"), 2).collect()
    assert {tuple(sorted(r)) for r in got} == {tuple(sorted((signed[0], signed[-1])))}
