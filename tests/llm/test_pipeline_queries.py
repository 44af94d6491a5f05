"""The pipeline against brute force, and the registered queries."""

import ast
import os

import corpus_pipeline
import public_tokenizers as P
import pytest
import tiktoken
from llm_fixtures import frame, labels, words  # noqa: F401
from oracle_compare import compare, duck
from test_dedup_decontam import _brute_fingerprint, _brute_leaks, union_find
from test_rules_models import _brute_spans, _counts

import __spark_entry__ as entry
from userflow.llm import bpe, queries, secret_ledger

SF = "/root/testdata/sf0.001"


def test_pipeline_rows_match_brute_force(spark, frame, tmp_path):  # noqa: F811
    item = words(30, 77)
    docs = [(i, words(60 + i, i) + "\nEnd of text.") for i in range(40)]
    docs += [(100, docs[3][1]), (101, docs[4][1].upper()), (102, words(90, 300) + " " + item + " " + words(20, 301)),
             (103, words(70, 302) + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + words(9, 303)),
             (104, None), (105, ""), (106, "too short"), (107, "again and again " * 60), (2, docs[2][1]), (None, words(75, 304))]
    df = frame(docs, extra=())
    sf = str(tmp_path)
    df.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == [*df.columns, "n_tokens", "token_ids"]

    good = [(i, t) for i, t in docs if (c := _counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]]
    fps = [_brute_fingerprint(t) for _, t in good]
    roots = union_find(len(good), [(i, j) for i in range(len(good)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    groups = {}
    for d, r in zip(good, roots):
        groups.setdefault(r, []).append(d)
    one = [min(g, key=lambda d: (d[0] is None, d[0])) for g in groups.values()]
    clean = [(i, t) for i, t in one if not _brute_leaks([(0, t)], [(1, item)])]
    assert {102} == {i for i, _ in one} - {i for i, _ in clean} and len(one) < len(good)
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                                 mergeable_ranks=bpe.parse_ranks(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))))
    want = []
    for i, t in clean:
        out, at = "", 0
        for s, _, e in _brute_spans(t):
            if s >= at:
                out += t[at:s] + secret_ledger.MASK
            at = max(at, e)
        out += t[at:]
        want.append((i, out, len(out), encoding.encode_ordinary(out)))
    assert sorted(map(repr, want)) == sorted(
        repr((r["doc_id"], r["text"], r["n_chars"], r["token_ids"])) for r in got.collect())
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in got.collect())


def test_pipeline_of_an_empty_table(spark, frame, tmp_path):  # noqa: F811
    sf = str(tmp_path)
    frame([], extra=()).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "mask_secrets", "token_ids"]
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 11)} <= {x[: x.index("_") + 1] for x in names if x.startswith("op")}
    assert set(queries.ORACLE_SQL) <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    ok, said = compare(spark, name, entry.queries()[name], queries.ORACLE_SQL[name], SF, duck(SF))
    assert ok, said


def test_nothing_else_in_the_library_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(f"{root}/userflow"):
        if folder.endswith("llm"):
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as source:
                    tree = ast.parse(source.read())
                for node in ast.walk(tree):
                    names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(
                        node, ast.ImportFrom) else []
                    assert not any(n.startswith("userflow.llm") for n in names), f
