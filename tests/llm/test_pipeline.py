import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quarterwise.llm import decontamination, mixing, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, small).write.parquet(path)
        out.append((name, docs.toPandas(), spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_stages_keep_columns_and_each_does_its_work(stages, spark, small):
    names = [n for n, _, _ in stages]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    kept = {n: (before, after.toPandas()) for n, before, after in stages}
    for n in names[:-1]:
        assert list(kept[n][1].columns) == COLUMNS
    labels = spark.read.parquet(f"{small}/labels.parquet").toPandas().set_index("doc_id").toxic
    before, after = kept["toxicity"]
    gone = set(before.doc_id) - set(after.doc_id)
    known = [i for i in gone if i in labels.index]
    assert sum(labels[i] for i in known) >= 0.8 * len(known)
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    before, after = kept["exact_dedup"]
    expected = before.assign(key=before.text.map(lower)).groupby("key").doc_id.max()
    assert set(after.doc_id) == set(expected)
    before, after = kept["near_dedup"]
    sets = {i: frozenset(zip(*(re.findall(r"\S+", lower(t))[k:] for k in range(5)), strict=False)) for i, t in zip(before.doc_id, before.text, strict=True)}
    alike = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    rest = [sets[i] for i in after.doc_id]
    assert not any(alike(a, b) for k, a in enumerate(rest) for b in rest[:k])
    assert all(any(alike(sets[i], r) for r in sets.values() if r is not sets[i]) for i in set(before.doc_id) - set(after.doc_id))
    before, after = kept["decontamination"]
    items = [" ".join(re.findall(r"[^\W_]+", t.lower())) for t in spark.read.parquet(f"{small}/benchmark.parquet").toPandas().text]
    holds = lambda t: any(f" {i} " in f" {' '.join(re.findall(r'[^\W_]+', t.lower()))} " for i in items)
    assert not any(map(holds, after.text))
    assert all(holds(t) for t in before[~before.doc_id.isin(after.doc_id)].text)
    before, after = kept["mixing"]
    mixed = mixing.mixed_documents(spark.createDataFrame(before)).toPandas()
    assert sorted(after.doc_id) == sorted(mixed[mixed.mix_taken > 0].doc_id) and len(after) > 0.5 * len(before) and abs(after.mix_taken.sum() - mixed.mix_size.sum()) <= before.source.nunique()


def test_toxic_documents_go_and_clean_ones_stay(spark):
    """On the middle data folder: the smallest has too few labels for a lexicon."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, folder).select("doc_id").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert sum(i not in kept for i, t in labels.items() if t) >= 0.6 * sum(labels.values())
    assert sum(i in kept for i, t in labels.items() if not t) >= 0.99 * sum(not t for t in labels.values())


def test_run_is_the_stages_in_turn(stages, spark, small):
    got = corpus_pipeline.run(spark, small).toPandas().sort_values("doc_id")
    last = stages[-1][2].toPandas().sort_values("doc_id")
    assert got.drop(columns="text").to_dict("list") == last.drop(columns="text").to_dict("list")


def test_every_stage_takes_messy_and_empty_documents(spark, small, messy, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, messy, small)
        assert out.columns[: len(messy.columns)] == messy.columns, name
        assert 0 < out.count() <= messy.count()
        assert stage(spark, no_docs, small).count() == 0


def test_registered_queries():
    names = set(entry.queries())
    assert {*queries.QUERIES, "pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, small, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{small}/documents.parquet'")
    df = queries.QUERIES[name](spark, small)
    result = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(map(tuple, result.fetchall()))


def test_decontamination_parameters():
    assert decontamination.LEAST_COVERAGE == 0.5 and decontamination.SEED == 5


def test_filters_of_finished_steps_leave_no_file_on_the_driver(spark, small):
    docs, folder = spark.read.parquet(f"{small}/documents.parquet"), spark.sparkContext._temp_dir
    for name, stage in corpus_pipeline.STAGES:
        before = set(os.listdir(folder))
        stage(spark, docs, small).count()
        left = [os.path.getsize(f"{folder}/{f}") for f in set(os.listdir(folder)) - before]
        assert sum(left) < 1 << 20, name
