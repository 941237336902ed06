from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarterwise.llm import merkle, queries
from tests.llm.conftest import SCHEMA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root of the nodes and the siblings (left, right) of each, from the leaf up."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, place):
            run = nodes[at // 16 * 16 :][:16]
            path.append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        nodes = [sha(*nodes[a : a + 16]) for a in range(0, len(nodes), 16)]
        place = [at // 16 for at in place]
    return nodes[0], paths


def brute(rows):
    """The results of op11 from rows (doc_id, text, lang, source, n_chars)."""
    sources = defaultdict(list)
    for r in rows:
        sources[r[3]].append((leaf(r[0], r[3], r[2], r[4], r[1]), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for s in names:
        own = sorted(sources[s], key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        made.append((own, *tree([x[0] for x in own])))
    root, above = tree([m[1] for m in made]) if made else (None, [])
    out = []
    for (own, subroot, paths), rest in zip(made, above):
        for (digest, r), path in zip(own, paths):
            path = path + rest
            node = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                node = leaf(r[0], r[3], r[2], r[4], r[1].translate(LOWER))
            for left, right in path:
                node = sha(left, node, right)
            out.append((r[0], digest, subroot, root, sha(*(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def found(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op11(spark, str(tmp_path)).collect()), key=str)


def test_results_equal_brute_force_over_sources_of_many_sizes(spark, tmp_path):
    rows = []
    for k, n in enumerate((1, 2, 15, 16, 17, 256, 257, 300)):
        rows += [(1000 * k + 7 * i, f"Text {i} of {k} É" if i % 5 else None, None if i % 7 == 0 else "en", f"s{k}", i) for i in range(n)]
    rows += [(50_000 + i, "No Source", "en", None, None) for i in range(20)] + [(60_000 + k, "One", "en", f"one{k}", 1) for k in range(12)]
    got = found(spark, spark.createDataFrame(rows, SCHEMA), tmp_path)
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_messy_rows_repeated_rows_and_an_empty_table(spark, messy, no_docs, tmp_path):
    rows = [tuple(r)[:5] for r in messy.collect()]
    # 40 equal rows: whole blocks of equal leaves are one record
    same = [(None, "again", "en", "a", 5)] * 40
    docs = messy.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(same, SCHEMA))
    got = found(spark, docs, tmp_path / "messy")
    expected = brute(rows + same)
    assert len(got) == len(expected)
    # equal leaves may take each other's ranks
    assert sorted(r[1:] for r in got) == sorted(r[1:] for r in expected)
    assert found(spark, no_docs, tmp_path / "none") == []


@pytest.mark.parametrize("n", [1, 16, 17])
def test_single_sources_and_single_leaves(spark, tmp_path, n):
    rows = [(i, "Words", "en", "only", 5) for i in range(n)]
    assert found(spark, spark.createDataFrame(rows, SCHEMA), tmp_path) == brute(rows)


def test_some_requests_expand_only_their_blocks(spark):
    docs = spark.range(600).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "if(id % 3 = 0, 'hot', concat('s', id % 40)) as source", "id as n_chars")
    made = merkle.manifest(merkle.document_leaves(docs, ["doc_id"]))
    assert {tuple(sorted(r.asDict())) for r in made.records[0].collect()} == {("children", "digest")}
    asked = made.leaves.where("row.doc_id in (0, 3, 599, 41)").select(F.col("row.doc_id").alias("request"), "tree", "at")
    got = merkle.proofs(made, asked).withColumn("top", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    own = {r.row.doc_id: r.leaf for r in made.leaves.collect()}
    assert {(r.request, r.leaf) for r in got} == {(i, own[i]) for i in (0, 3, 599, 41)}
    assert all(r.top == r.root for r in got) and len({r.root for r in got}) == 1


def test_ranks_use_all_tasks_and_follow_the_order(spark):
    rows = spark.range(5000).selectExpr("id % 7 as k", "cast(id as string) as s")
    out = merkle.ranked(merkle.stored(rows), "k")
    got = out.orderBy("at").collect()
    assert [r.at for r in got] == list(range(5000)) and [r.k for r in got] == sorted(r.k for r in got)
    largest = max(r["count"] for r in out.groupBy(F.input_file_name()).count().collect())
    assert largest < 2500
