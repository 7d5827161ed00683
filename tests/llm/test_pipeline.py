import random
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from helpers import awkward, documents

import corpus_pipeline
from revtide.llm.queries import ORACLE, QUERIES

SF = Path("/root/testdata/sf0.001")


def corpus():
    rng = random.Random(12)

    def prose(n=80):
        return "\n".join(" ".join(f"w{rng.randint(0, 9000)}" for _ in range(10)) for _ in range(n // 10))

    question = "which of the following rivers flows through the old capital of the northern province today"
    rows = [(i, prose(), "en", f"s{i % 3}") for i in range(60)]
    copied = prose(200)
    rows += [(100 + i, copied, "en", "s0") for i in range(5)]
    rows += [(200, f"{prose()} {question} {prose()}", "en", "s1"), (300, "too short", "en", "s2"), (301, None, None, None)]
    return rows, question


def test_stages(spark, tmp_path):
    rows, question = corpus()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, question)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    ids = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        ids[name] = Counter(r.doc_id for r in docs.collect())
        if name != "sharding":
            assert docs.columns == columns
    assert set(ids["quality_rules"]) == {*range(60), *range(100, 105), 200}
    assert set(ids["near_dedup"]) == {*range(60), 100, 200}
    assert set(ids["benchmark_decontamination"]) == {*range(60), 100}
    assert set(ids["temperature_mixing"]) <= {*range(60), 100}
    assert ids["sharding"] == ids["temperature_mixing"]
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == ids["sharding"]


def test_awkward_rows(spark, tmp_path):
    items = spark.createDataFrame([], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (awkward(spark), awkward(spark).limit(0)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        docs.collect()


def test_every_operator_is_registered():
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES)
    assert numbers == sorted(set(numbers)) and set(range(1, 11)) <= set(numbers) and set(ORACLE) <= set(QUERIES)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.skipif(not SF.exists(), reason="sample tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_against_sql(spark, name):
    tables = duckdb.connect()
    for file in SF.glob("*.parquet"):
        tables.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = tables.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    got = QUERIES[name](spark, str(SF)).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(result.fetchall(), key=repr)


def test_column_names_with_dots_and_quotes(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, corpus()[0][:8]).selectExpr("*", "1 AS `a.b`", "2 AS `c``d`")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.drop("shard", "slot").columns == columns and docs.count()
