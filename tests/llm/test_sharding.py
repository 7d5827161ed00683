import zlib
from collections import Counter

import pytest
from helpers import awkward, documents
from pyspark.sql import functions as F

from revtide.llm import sharding
from revtide.llm.queries import QUERIES


def slow_fisher_yates(n, numbers):
    order = list(range(n))
    for last in range(n - 1, 0, -1):
        other = numbers[last] % (last + 1)
        order[last], order[other] = order[other], order[last]
    return order


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_fisher_yates(spark, n):
    seeds = spark.range(1, n + 1).select("id", F.xxhash64(F.lit(5), F.lit(9).cast("long"), F.col("id").cast("int")).alias("h"))
    numbers = dict(seeds.collect())
    row = spark.range(1).select(sharding.fisher_yates(F.lit(n), F.lit(5), F.lit(9).cast("long")).alias("o")).first()
    assert row.o == slow_fisher_yates(n, numbers)


@pytest.mark.parametrize("n, shards", [(0, 16), (5, 16), (1000, 16), (1003, 7)])
def test_shards_are_even_and_slots_gapless(spark, n, shards):
    frame = documents(spark, [(i, f"text {i}") for i in range(n)])
    got = sharding.shuffled(frame, shards=shards, bucket_rows=40)
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == list(range(n))
    sizes = Counter(r.shard for r in rows)
    if n:
        counts = [sizes[s] for s in range(shards)]
        assert max(counts) - min(counts) <= 1 and sum(counts) == n
    for shard in sizes:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))
    again = sharding.shuffled(frame.repartition(5), shards=shards, bucket_rows=40)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_order_is_random(spark):
    rows = sharding.shuffled(documents(spark, [(i, "t") for i in range(4000)]), bucket_rows=64).collect()
    place = {r.doc_id: r.shard for r in rows}
    neighbours = sum(place[i] == place[i + 1] for i in range(3999)) / 3999
    assert 0.03 < neighbours < 0.1  # 1/16 by chance
    halves = Counter((r.doc_id < 2000, r.shard) for r in rows)
    assert all(90 < n < 160 for n in halves.values())


def test_repeated_rows_spread(spark):
    frame = documents(spark, [(1, "same")] * 600 + [(i, "t") for i in range(2, 600)])
    rows = sharding.shuffled(frame, bucket_rows=32).collect()
    hot = Counter(r.shard for r in rows if r.doc_id == 1)
    assert sum(hot.values()) == 600 and len(hot) == 16 and max(hot.values()) < 70
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in frame.collect())


def test_digests_and_query(spark, tmp_path):
    frame = awkward(spark)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op7_two_pass_sharding"](spark, str(tmp_path)).collect()
    assert len(rows) == frame.count()
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in frame.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_written_shards(spark, tmp_path):
    frame = documents(spark, [(i, f"text {i}") for i in range(500)])
    sharding.write_shards(frame, f"{tmp_path}/out", shards=4, bucket_rows=50)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.doc_id for r in back.collect()) == list(range(500))
    assert {r.shard for r in back.collect()} == {0, 1, 2, 3}


def test_query_takes_digests_from_written_shards(spark, tmp_path, monkeypatch):
    frame = documents(spark, [(i, f"text {i} " * 50) for i in range(300)])
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    paths, write = [], sharding.write_shards

    def noted(records, path, **options):
        paths.append(path)
        write(records, path, **options)

    monkeypatch.setattr(sharding, "write_shards", noted)
    rows = QUERIES["op7_two_pass_sharding"](spark, str(tmp_path)).collect()
    back = spark.read.parquet(paths[0])
    assert set(back.columns) == {*frame.columns, "shard", "slot"}
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in frame.collect()}
    place = {r.doc_id: (r.shard, r.slot) for r in back.collect()}
    assert {r.doc_id: (r.shard, r.slot) for r in rows} == place
    write(frame.limit(0), f"{tmp_path}/empty")
    assert sharding.read_shards(frame, f"{tmp_path}/empty").count() == 0


def test_long_records_make_more_buckets(spark, monkeypatch):
    sizes, orders = [], sharding._bucket_orders
    monkeypatch.setattr(sharding, "_bucket_orders", lambda s, seed: sizes.append(s.count()) or orders(s, seed))
    frame = documents(spark, [(i, "long " * 2000) for i in range(200)])
    assert sharding.shuffled(frame, bucket_bytes=100_000).count() == 200
    assert sharding.shuffled(frame).count() == 200
    assert 15 <= sizes[0] <= 21 and sizes[1] == 1


def test_awkward_rows(spark):
    frame = awkward(spark)
    got = sharding.shuffled(frame)
    assert got.count() == frame.count() and set(got.columns) == {*frame.columns, "slot"}
    assert sharding.shuffled(frame.limit(0)).count() == 0
