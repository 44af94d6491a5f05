"""N-gram Jaccard join, hard negatives and fill-in-the-middle against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from userflow.llm import fim, hard_negatives, ngram_join
from userflow.llm.common import word_hashes

from llm_fixtures import frame, words  # noqa: F401
from test_dedup_decontam import union_find


# --- n-gram Jaccard join ------------------------------------------------------

def _shingles(text, k=3):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def _brute_join(rows, num=90, den=100):
    sets = [_shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i)
             if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    roots = union_find(len(rows), pairs)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, len(s), least.get(r)) for (i, _), s, r in zip(rows, sets, roots)), key=repr)


def _edited(text, n, rng):
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = f"z{rng.randrange(10**6)}"
    return " ".join(w)


def _near_groups(seed):
    """Texts with few to many changed words, so similarities lie on both sides
    of the threshold; chains, stars without their centre, cut and joined texts."""
    rng = random.Random(seed)
    texts = []
    for g, n in enumerate((12, 21, 40, 57, 95, 160, 400, 1500)):
        base = words(n, 31 + g)
        texts += [base, base.upper(), base + " end", base + "  and more", " ".join(base.split()[: n - 1]), base + " " + words(n // 9, 7)]
        texts += [_edited(base, k, rng) for k in (1, 1, 1, 2, 2, 3, max(1, n // 60), max(1, n // 45)) if k <= n]
    chain = words(90, 77)
    for _ in range(12):
        chain = _edited(chain, 1, rng)
        texts.append(chain)
    hidden = words(64, 5)  # the centre itself is not among the texts
    texts += [_edited(hidden, 1, rng) for _ in range(40)]
    texts += ["", " \t\n", None, "one", "One", "one two", "two one", "one two three", "one two three four"]
    texts += [" ".join(["again"] * n) for n in (2, 3, 9, 30)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("small, block", [(16, 256), (2, 4)])
def test_join_matches_all_pairs(frame, small, block):
    texts = _near_groups(small)
    rows = [(i * 3 % 1000, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "alone in here today"), (5, texts[1]), (5, texts[1])]
    got = ngram_join.similar_documents(frame(rows), small=small, block=block)
    assert sorted(map(tuple, got.collect()), key=repr) == _brute_join(rows)


def test_join_of_small_texts_at_the_threshold(frame):
    rng = random.Random(9)
    rows = []
    for i in range(150):  # 10 to 60 words over a small vocabulary, many near the threshold
        n = rng.randint(10, 60)
        rows.append((i, " ".join(f"w{(j * 7 + 3) % 61}" for j in range(n)) + (" x" * rng.randint(0, 3))))
    assert sorted(map(tuple, ngram_join.similar_documents(frame(rows)).collect()), key=repr) == _brute_join(rows)
    other = ngram_join.similar_documents(frame(rows), similarity=(3, 4))
    assert sorted(map(tuple, other.collect()), key=repr) == _brute_join(rows, 3, 4)


def test_join_of_no_rows(frame):
    assert ngram_join.similar_documents(frame([])).count() == 0


def test_linked_sets_share_a_tile_and_pass_the_bitmap():
    rng = np.random.default_rng(4)
    for n in [*range(9, 60), 100, 333, 1000, 7000]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            cut = rng.integers(0, max(1, n // 9) + 1)
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[cut:]],
                                          rng.integers(0, 2**64, rng.integers(0, n // 9 + 1), dtype=np.uint64)]))
            shared = len(np.intersect1d(a, b))
            link = 100 * shared >= 90 * (len(a) + len(b) - shared)
            assert ngram_join.linked(a, b) == link
            if link:
                bits = [np.frombuffer(ngram_join.bitmap(x), np.uint8) for x in (a, b)]
                assert ngram_join.may_link(len(a), bits[0], len(b), bits[1])
                if len(a) != shared or len(b) != shared:
                    assert set(ngram_join.tile_signatures(a)) & set(ngram_join.tile_signatures(b)), (n, len(b), shared)


def test_sets_of_texts():
    hashes, at = word_hashes([b"a b c a b c", b"A b", b"", b"a  b"])
    found = [ngram_join.shingle_set(hashes[x:y]) for x, y in zip(at, at[1:])]
    assert [len(x) for x in found] == [3, 1, 0, 1] and (found[1] == found[3]).all()


# --- hard negatives -----------------------------------------------------------

def _brute_negatives(rows):
    clean = [(i, [int(np.floor(256 * float(x))) for x in v], y) for i, v, y in rows
             if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, va, ya in clean:
        if a % 50:
            continue
        rest = sorted(((-sum(x * z for x, z in zip(va, v)), i, y) for i, v, y in clean if i != a))
        for ps, p, _ in [r for r in rest if r[2] == ya][:5]:
            near = [r for r in rest if r[2] != ya and 50 * -ps <= 100 * -r[0] <= 95 * -ps][:3]
            out += [(a, p, k, i, -ps, -s) for k, (s, i, _) in enumerate(near, 1)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("length, spread", [(1, 3.0), (7, 1.0), (64, 0.3), (40, 300.0)])
def test_negatives_match_all_scores(spark, length, spread):
    rng = np.random.default_rng(length)
    rows = [(int(i), rng.normal(0.2, spread, length).astype(np.float32).round(1).tolist(), int(i % 4)) for i in range(260)]
    rows += [(900, None, 1), (950, rows[3][1], None), (None, rows[3][1], 1), (951, [None] * length, 1),
             (952, [float("nan")] * length, 1), (953, [float("inf")] * length, 2), (1000, [0.0] * length, 1), (1001, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as id", "'y' as block", "1 as score").repartition(5)
    want = _brute_negatives(rows)
    assert want
    assert sorted(map(tuple, hard_negatives.mine(df).collect())) == want
    assert sorted(map(tuple, hard_negatives.mine(df, row_block=40, anchor_block=2).collect())) == want


def test_only_the_best_of_each_group_are_kept():
    rng = np.random.default_rng(6)
    for by in (1, 2):
        rows = rng.integers(0, 6, (400, by + 2))
        got = hard_negatives._keep_best(rows, by, 3)
        want = []
        for key in sorted({tuple(r[:by]) for r in rows.tolist()}):
            want += sorted((r for r in rows.tolist() if tuple(r[:by]) == key), key=lambda r: (-r[-1], r[-2]))[:3]
        assert got.tolist() == want
    assert len(hard_negatives._keep_best(np.zeros((0, 3), np.int64), 1, 3)) == 0


def test_negatives_of_no_rows_and_restored_setting(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)).count() == 0
    assert spark.conf.get(key) == before


@pytest.mark.parametrize("length, largest", [(1, 1), (3, 10**6), (64, 255), (64, 10**8), (1500, 900), (4096, 60000)])
def test_residue_scores_are_exact(length, largest):
    rng = np.random.default_rng(length)
    a, b = (rng.integers(-largest, largest + 1, (6, length)).astype(float) for _ in range(2))
    a[0], b[0], b[1] = largest, largest, -largest
    primes = hard_negatives.residue_primes(length, largest)
    got = hard_negatives.scores(*(hard_negatives.Residues(x, primes) for x in (a, b)))
    assert got.tolist() == (a.astype(int).astype(object) @ b.astype(int).astype(object).T).tolist()


def test_scores_beyond_a_long_are_refused():
    with pytest.raises(ValueError):
        hard_negatives.residue_primes(64, 1 << 30)


# --- fill-in-the-middle -------------------------------------------------------

def _brute_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i:i + 8], 16) for i in (0, 8, 16, 24)]
    sha = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text, sha
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), out, sha


def test_fill_in_middle_matches_unit_lists(frame):
    rng = random.Random(6)
    marks = ["a", "Z", " ", "\n", "é", "日本", "😀", "<", "<P", "<S", ">", "word", "1", " ", "ab" * 700]
    texts = [None, "", "x", "<P>", "a<S>b", "<", "one two", "y" * 5000, "é" * 3000, "😀 " * 900]
    texts += ["".join(rng.choices(marks, k=rng.randint(1, 400))) for _ in range(120)]
    rows = [(i * 17, t) for i, t in enumerate(texts)] + [(None, "no id at all"), (17, "x"), (17, "x")]
    made = fim.fill_in_middle(frame(rows, extra=("fim", "form", "output", "_row")))
    got = [(r["_row"]["doc_id"], f["n"], f["form"], f["prefix_chars"], f["middle_chars"], f["output"], f["restored_sha256"])
           for r in made.collect() for f in [r["fim"]]]
    want = [_brute_fim(i, t) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(frame([])).count() == 0


def test_every_cut_of_a_text_in_every_block_size():
    text = "Ab, cd é日本 x<y\n\n😀zz9 end"
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    for block in (1, 2, 3, 5, 8, 64):
        index = fim.UnitIndex(text.encode(), block)
        assert (index.n_units, index.n_chars) == (len(units), len(text))
        for u in range(len(units) + 1):
            head = "".join(units[:u])
            assert index.cut(u) == (len(head.encode()), len(head))
