"""Token files, BPE and archives: exact round trips and public libraries."""

import base64
import gc
import hashlib
import os
import random
import re
import subprocess
import sys
import weakref
import zlib
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from userflow.llm import bpe, common, token_files, warc

from llm_fixtures import frame, words  # noqa: F401

RANKS = P.path("byte_bpe_50k.tiktoken")
ODD = [" ", "  ", "\n", "\n ", " \n", "\t", "a", "é", '"', "日本", "😀", "'s", "'ll", "123", "\x1c", "foo", "...", "ing", "​",
       "A", "<|endoftext|>", " the", "　", "\x85"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(bpe.read_ranks(RANKS)), special_tokens={})


def test_transducer_equals_merges_and_resets():
    ranks = bpe.parse_ranks(bpe.read_ranks(RANKS))
    rng = random.Random(4)
    tokens = list(ranks)
    small = bpe.Transducer(ranks, max_states=50)  # forced to start over again and again
    for _ in range(400):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 5)))
        assert small.encode(piece) == small.merge(piece)


def test_states_are_bounded_inside_a_long_piece(reference):
    ranks = bpe.parse_ranks(bpe.read_ranks(RANKS))
    rng = random.Random(7)
    piece = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60_000))
    small, most = bpe.Transducer(ranks, max_states=1000), []
    grow = small._grow

    def watched(*args):
        step = grow(*args)
        most.append((len(small._state), len(small._next)))
        return step

    small._grow = watched
    assert small.encode(piece.encode()) == reference.encode_ordinary(piece)
    assert max(n for n, _ in most) <= 1001 and max(n for _, n in most) <= 4001
    whole = bpe.Transducer(ranks)
    assert whole.encode(piece.encode()) == small.encode(piece.encode())
    assert len(whole._state) > 1001


def test_random_bytes_equal_merges():
    ranks = bpe.parse_ranks(bpe.read_ranks(RANKS))
    rng = random.Random(11)
    machine = bpe.Transducer(ranks)
    tokens = sorted(ranks)
    for _ in range(3000):
        if rng.random() < 0.5:
            piece = bytes(rng.choices(range(256), k=rng.randint(1, 12)))
        else:
            piece = b"".join(t[: rng.randint(1, len(t))] for t in rng.choices(tokens, k=rng.randint(1, 6)))
        assert machine.encode(piece) == machine.merge(piece)


def test_bpe_equals_tiktoken_and_round_trips(frame, reference):
    texts = [None, "", *odd_texts(120), words(3000), "x" * 5000, " " * 300 + "end", "Žluťoučký kůň\n\n  a  b"]
    df = frame(list(enumerate(texts)))
    for packed in (False, True):
        rows = bpe.decode(bpe.encode(df, RANKS, P.PATTERN, packed=packed), RANKS, packed=packed).collect()
        assert len(rows) == len(texts)
        for r in rows:
            ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist() if packed else r["ids"]
            assert ids == reference.encode_ordinary(texts[r["doc_id"]] or "")
            assert r["text"] == (texts[r["doc_id"]] or "")
    for r in bpe.round_trip(df, RANKS, P.PATTERN).collect():
        t = texts[r["doc_id"]] or ""
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == reference.encode_ordinary(t) and r["text"] == t
    assert bpe.encode(frame([]), RANKS, P.PATTERN).count() == 0


def test_both_engines_cut_texts_alike():
    want, got = regex.compile(P.PATTERN).findall, bpe.splitter(P.PATTERN)
    plane = re.compile(bpe.plane_pattern(P.PATTERN)).findall
    rng = random.Random(12)
    likely = " \t\n\x1c\x1f\x85\xa0\u2003\u3000'strem9٣½Ⅷé日\u0301_-.😀𝒳"
    for t in [*odd_texts(200, 3), *("".join(rng.choice(likely) if rng.random() < 0.8 else chr(rng.randrange(0xD800)) for _ in range(rng.randrange(30)))
                                   for _ in range(5000))]:
        assert got(t or "") == want(t or "")
        if not re.search("[\U00010000-\U0010ffff]", t or ""):
            assert plane(t or "") == want(t or "")
    every = "".join(chr(c) + "a" for c in range(1 << 16) if not 0xD800 <= c < 0xE000)
    assert plane(every) == want(every)
    assert bpe.plane_pattern(r"\w+|(?i:x)|\d{2}") is None and bpe.splitter(r"\d{2}")("12345") == ["12", "34"]


def test_id_table_generations_keep_results_right(reference):
    machine = bpe.Transducer(bpe.parse_ranks(bpe.read_ranks(RANKS)))
    texts = [words(40, i % 7) for i in range(600)] + odd_texts(300, 8) + [None, ""]
    want = [reference.encode_ordinary(t or "") for t in texts]
    pieces = bpe.PieceEncoder(machine, P.PATTERN, size=20)
    assert [np.frombuffer(x, np.uint32).tolist() for x in pieces.encode(texts)] == want
    whole = bpe.UnitEncoder(lambda us: [np.array(reference.encode_ordinary(u or ""), np.uint32).tobytes() for u in us], size=20)
    assert [np.frombuffer(x, np.uint32).tolist() for x in whole.encode(texts)] == want


def test_units_are_cut_where_the_library_starts_pieces_and_looked_up_once(reference):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        coder = token_files.worker_tokenizer("units-test", SimpleNamespace(value=f.read()))
    rng = random.Random(21)
    likely = [" ", " ", "\n", "\n\n", "\t", "\x85", "\x1c", "\u3000", ",", ".", "!?", "'s", "'", "<|endoftext|>", "7", "_",
              "stem", "Oñate", "ÿ", "×", "ª", "ǅ", "日", "e\u0301", "😀"]
    texts = ["".join(rng.choices(likely, k=rng.randint(0, 12))) for _ in range(6000)] + odd_texts(2000, 5) + [None, ""]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    seen, encode = [], coder.encode_strings
    coder.encode_strings = lambda units: (seen.extend(units), encode(units))[1]
    try:
        for at in range(0, len(texts), 1500):
            got = coder.encode(texts[at : at + 1500])
            assert [np.frombuffer(x, np.uint32).tolist() for x in got] == want[at : at + 1500]
        before = len(seen)
        assert coder.encode(["stem, stem.\nstem stem! Oñate"] * 3) == coder.encode(["stem, stem.\nstem stem! Oñate"] * 3)
        assert set(seen[before:]) <= {"stem", ",", " stem", ".", "\n", "!", " Oñate"}  # a word is met once, whatever mark follows
    finally:
        token_files._CODERS.clear()


def test_unit_table_keeps_what_was_used_last():
    table, asked = bpe.UnitTable(100), []
    coder = bpe.UnitEncoder(lambda units: (asked.extend(units), [np.array([len(u), 7], np.uint32).tobytes() for u in units])[1])
    coder.table = table
    for i in range(200):
        coder.encode([" often " + f"new{i} long" + "x" * 80])
    assert asked.count(" often") == 1 and len(table.n) <= 100 and len(table.ids) == table.n.sum() == 2 * len(table.units)
    assert not any(len(u) > bpe.MAX_UNIT_CHARS for u in table.units.to_pylist())


def test_units_are_found_whichever_side_is_larger():
    table = bpe.UnitTable(1000)
    words_of = lambda ns: pa.array([b"u%d" % i for i in ns], pa.large_binary())
    table.add(words_of(range(100)), np.arange(100, dtype=np.uint32), np.ones(100, np.int64))
    for asked in ([], [150], [99, 200, 0, 7], range(50, 150), range(60, 300)):
        places, missing = table.find(words_of(asked))
        assert missing.tolist() == [i >= 100 for i in asked]
        assert places.tolist() == [i if i < 100 else 0 for i in asked]
        assert set(np.flatnonzero(table.used == table.tick).tolist()) == {i for i in asked if i < 100}


def test_shards_after_the_first_are_made_in_memory_at_hand():
    code = """
import resource
import numpy as np, pyarrow as pa
from userflow.llm import common, token_files
common.lean_memory()
faults = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_minflt
ids = (np.random.default_rng(1).zipf(1.3, 1 << 19) % 50000).astype(np.uint32).tobytes()
class Coder:
    encode = staticmethod(lambda texts: [ids] * len(texts))
rows = pa.record_batch({"doc_id": pa.array(range(6)), "text": pa.array(["x"] * 6)})
seen = [(faults(), row) for row in token_files.shard_rows(iter([rows]), Coder, 0, 50257, shard_ids=1 << 19)]
assert all((token_files.Shard(r.column("data")[0].as_py()).document(0)[:-1] == np.frombuffer(ids, np.uint32)).all() for _, r in seen)
print(len(seen), seen[-1][0] - seen[1][0])
"""
    root = Path(__file__).parents[2]
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": str(root)}, capture_output=True, text=True, check=True)
    shards, faults = map(int, out.stdout.split())
    assert shards == 6 and faults < 4 * 5000  # fresh pages: some 20,000 a shard when every large array is one


def test_utf8_stream_over_every_cut():
    text = "aé日😀z" * 3
    data = text.encode()
    for cut in range(1, 6):
        stream = bpe.Utf8Stream()
        got = "".join(stream.feed(data[i:i + cut]) for i in range(0, len(data), cut)) + stream.finish()
        assert got == text
    stream = bpe.Utf8Stream()
    assert stream.feed(b"a\xe6\x97") + stream.finish() == "a�"


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    phrase = rng.integers(0, 50000, 40)
    docs = [np.concatenate([phrase, rng.integers(0, 50000, rng.integers(0, 50)), phrase, [0]]).astype(np.uint32) for _ in range(120)]
    docs += [np.array([0], np.uint32), np.zeros(500, np.uint32), np.tile([5, 6], 300).astype(np.uint32)]
    data = token_files.pack_shard([*range(len(docs) - 1), None], docs, 50257)
    shard = token_files.Shard(data)
    flat = np.concatenate(docs)
    assert len(data) < 2 * len(flat) and len(shard.left) > 10
    assert shard.doc_ids == [*range(len(docs) - 1), None]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(shard.documents(at_once=64), docs, strict=True))
    for _ in range(300):
        a, n = int(rng.integers(0, len(flat) + 5)), int(rng.integers(0, 700))
        assert shard.slice(a, n).tolist() == flat[a:a + n].tolist()
    assert (shard.document(3) == docs[3]).all()
    with pytest.raises(ValueError):
        token_files.pack_shard([1], [np.array([60000, 0], np.uint32)], 50257)


def test_runs_of_one_id_are_compressed():
    rng = np.random.default_rng(3)
    for n in range(1, 40):  # every second place of a run, never over a border
        seq = rng.integers(0, 2, n).astype(np.uint16)
        inner = rng.random(n - 1) < 0.8 if n > 1 else np.zeros(0, bool)
        want, taken = inner.copy(), False
        for i in range(n - 1):
            if inner[i] and seq[i] == seq[i + 1]:
                taken = not taken
                want[i] = taken
            else:
                taken = False
        assert token_files._second_places(seq, inner).tolist() == want.tolist()
    docs = [np.array([7] * n + [0], np.uint32) for n in (1, 2, 3, 64, 999, 5000)] + [np.array([7, 7, 9] * 400 + [0], np.uint32)]
    data = token_files.pack_shard(list(range(len(docs))), docs, 50257)
    shard = token_files.Shard(data)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(shard.documents(), docs, strict=True))
    assert len(shard.symbols) < 300  # of some 7,000 ids
    assert shard.slice(70, 400).tolist() == np.concatenate(docs)[70:470].tolist()


def test_token_files_equal_the_library(frame):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert tokenizer.encode("end <|endoftext|> start", add_special_tokens=False).ids == [437, 220, 50256, 923]
    special = ["end <|endoftext|> start", "<|endoftext|>", "a<|endoftext|>b  <|endoftext|>", "<|endoftext|> " * 40, "<|endof text|>"]
    rows = [(1000 + i, t) for i, t in enumerate(special)] + [(i * 3, t) for i, t in enumerate([None, "", *odd_texts(60, 3), words(2500)])] + [(None, "no id"), (6, "again")]
    random.Random(2).shuffle(rows)
    got = token_files.tokenize_to_files(frame(rows), P.path("byte_bpe_50k.json"), shard_ids=500).collect()
    coded = {(i, t): np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in rows}
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
        (-1 if i is None else i, len(x), zlib.crc32(x.tobytes())) for (i, _), x in coded.items())
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):  # ascending ids without a gap
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert len({(r["part"], r["shard"]) for r in got}) > 2
    assert token_files.tokenize_to_files(frame([]), P.path("byte_bpe_50k.json")).count() == 0


def test_warc_records_and_revisits(spark, tmp_path):
    big, dup = "ä" * 70_000, "d" * 100
    rows = [(1, "http://a/1", big), (2, None, dup), (3, "http://a/3\r\nx", dup), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (7, "u", ""), (8, "u", big), (2, "u2", dup), (9, "u", "e" * 99), (10, "u", "e" * 99), (None, "u", dup)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as n")
    path = f"{tmp_path}/warc"
    got = warc.archive_pages(df, path, chunk_bytes=1000).collect()
    assert all(r["whole"] for r in got) and len(got) == len(rows)
    first = {big: 1, dup: 2}
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 100 and i is not None and i > first.get(h, i)
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    assert sorted(map(repr, want)) == sorted(
        repr((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in got)
    assert max(r["n_chunks"] for r in got) == 140
    table = spark.read.schema(warc.TABLE).parquet(path)
    assert table.selectExpr("max(octet_length(data))").head()[0] <= 1000
    out = b"".join(b"".join(warc.export_archive(table, a["archive"])) for a in table.select("archive").distinct().collect())
    assert out.count(b"WARC/1.1\r\n") == len(rows) and big.encode() in out
    broken = warc.read_table(table.where("NOT (chunk_no = 5)"))
    assert sum(not r["whole"] for r in broken.collect()) == 1  # page 1 lacks a chunk; page 8 is a revisit
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_worker_holds_one_large_table(monkeypatch):
    """The encoder stays for later tasks and goes when another operator starts."""
    monkeypatch.setattr(common, "_LEAN", [True])
    ranks = SimpleNamespace(value=b"".join(base64.b64encode(bytes([i])) + b" %d\n" % i for i in range(256)))
    coder = bpe.worker_coder("bytes", ranks, P.PATTERN)
    assert bpe.worker_coder("bytes", ranks, P.PATTERN) is coder
    held = weakref.ref(coder)
    del coder
    common.lean_memory()
    gc.collect()
    assert held() is None
