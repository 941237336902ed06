from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from quarterwise.llm import line_dedup
from quarterwise.llm.line_dedup import SPACES, LineRuns, keys, line_hashes, without_repeated_lines
from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(doc_id, n_lines, n_dropped, kept) of (doc_id, text) rows, every row a document."""
    held = defaultdict(list)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    for i, lines in split:
        for key in {line.strip(SPACES).translate(LOWER) for line in lines}:
            if len(key) >= 20:
                held[key].append(i)
    top = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= 3}
    out = []
    for i, lines in split:
        lost = [(k := line.strip(SPACES).translate(LOWER)) in top and top[k] != i for line in lines]
        out.append((i, len(lines), sum(lost), "\n".join(x for x, gone in zip(lines, lost) if not gone)))
    return out


def found(docs, **options):
    got = without_repeated_lines(docs, **options).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted((tuple(r) for r in got), key=str)


def sample(seed, docs):
    draw = random.Random(seed)
    stock = [prose(5, k) for k in range(12)] + ["short line", "", "É" * 20, "é" * 20, "x" * 19, "x" * 20]
    rows = []
    for i in range(docs):
        lines = [draw.choice(stock) for _ in range(draw.randrange(6))]
        lines = [draw.choice(["", " ", "\t\x0b"]) + (x.upper() if draw.random() < 0.2 and x.isascii() else x) + draw.choice(["", "\r", " \x0c"]) for x in lines]
        rows.append((draw.choice([i, i, i, 3, None]), "\n".join(lines)))
    return rows


def test_lines_equal_brute_force_over_any_batches(docs_of):
    rows = sample(1, 60)
    expected = sorted(brute(rows), key=str)
    assert sum(r[2] for r in expected) > 30
    for options in ({}, {"batches": 1}, {"batches": 9, "fan": 2}):
        assert found(docs_of(rows), **options) == expected


def test_nulls_messy_rows_and_an_empty_table(messy, no_docs):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    out = without_repeated_lines(messy)
    assert sorted((r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.where("row.doc_id is not null").collect()) == sorted(x for x in brute(rows) if x[0] is not None)
    assert out.select("row.*").columns == messy.columns
    assert found(no_docs) == []


def test_a_line_of_a_third_of_all_documents_is_one_row_a_task(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same footer in many documents', concat('only here, number ', id)) as text")
    got = without_repeated_lines(docs).agg(F.sum("n_dropped"), F.max(F.when(F.col("kept").startswith("the same"), F.col("row.doc_id")))).first()
    assert tuple(got) == (999, 2997)
    hashed = docs.select(F.col("doc_id").alias("id"), line_hashes(F.col("text")).alias("hashes"))
    plan = keys(hashed)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_max" in plan and "Python" not in plan


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "a bigint, b bigint, docs bigint, top bigint")


def test_runs_share_no_key_and_are_merged_level_by_level(spark):
    runs = LineRuns(spark, fan=2)
    try:
        for k in range(5):
            runs.add(batch(spark, (k, 0, 1, k), (100, 1, 1, k), (200 + k // 2, 2, 1, k)))
        assert [len(level) for level in runs.levels] == [1, 0, 1]
        stored = runs._rows(runs.live()).select("a", "b").collect()
        assert len(stored) == len(set(stored)) == 9
        totals = {(r.a, r.b): (r.docs, r.top) for r in runs.totals().collect()}
        assert totals[100, 1] == (5, 4) and totals[200, 2] == (2, 1) and totals[204 // 1 - 2, 2] == (1, 4) and len(totals) == 9
    finally:
        runs.close()


def test_runs_meet_a_batch_without_a_shuffle_of_their_own(spark):
    runs = LineRuns(spark, fan=3)
    try:
        runs.add(batch(spark, (1, 1, 1, 1), (2, 2, 1, 1)))
        runs.add(batch(spark, (3, 3, 1, 1)))
        joined = batch(spark, (1, 1, 1, 2)).groupBy("a", "b").agg(F.max("top")).join(runs._rows(runs.live()).hint("merge"), ["a", "b"], "left_anti")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
        summed = line_dedup._summed(runs._rows(runs.live()))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in summed
    finally:
        runs.close()


def test_the_query_gives_digests_of_whole_tables(spark, small):
    from quarterwise.llm import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    expected = {(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(rows)}
    assert {tuple(r) for r in queries.op13(spark, small).collect()} == expected
