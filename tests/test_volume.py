"""What a refresh shuffles and writes."""

import datetime as dt
import re
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from catalogue.queries import QUERIES
from revtide import testbed as tb
from revtide.operators import dedup
from revtide.operators.dedup import keep_first, keep_first_unmoved
from revtide.sources.landing import read_landing
from revtide.sources.selection import children_among, children_of, children_without, orphan_keys


@pytest.fixture
def sample(spark, tmp_path):
    """Orders of two customers; every item is delivered twice, the later copy first."""
    day = dt.datetime(1996, 5, 1)
    tables = {
        "customer": ("c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double",
                     [(n, f"Customer#{n}", "BUILDING", 10.0) for n in (1, 2)]),
        "part": ("p_partkey bigint, p_type string, p_retailprice double, p_size int, p_brand string",
                 [(7, "STEEL", 12.5, 9, "Brand#1")]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
                   "o_orderpriority string", [(k, 1 + k % 2, "O", day, "5-LOW") for k in range(1, 401)]),
        "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, "
                     "l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(k, n, part, 3, 10.0 * n, 2.0, "N", "O", day + dt.timedelta(days=late))
                      for late in (1, 0) for k in range(1, 401) for n in (1, 2) for part in (7,)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_landing_files_are_compressed_and_hold_every_line(spark, sample, tmp_path):
    paths = tb.write_landing(spark, sample, str(tmp_path / "landing"))
    for entity, path in paths.items():
        lines = tb.LINES[entity](spark, sample).select("value")
        assert sorted(spark.read.text(path).collect()) == sorted(lines.collect())
    stored = sum(f.stat().st_size for f in Path(paths["invoices"]).glob("part-*"))
    text = sum(len(r.value) for r in spark.read.text(paths["invoices"]).collect())
    assert stored < text / 4


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_copies_of_an_invoice_follow_each_other(spark, sample, tmp_path, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plan = tb.delivered_invoice_lines(spark, sample)._jdf.queryExecution().executedPlan().toString()
        # Items and orders are dealt by order; no text is.
        assert plan.count("Exchange hashpartitioning") == (2 if broadcast == "-1" else 1)
        assert "rangepartitioning" not in plan
        path = tb.write_landing(spark, sample, str(tmp_path / "landing"))["invoices"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rows = read_landing(spark, "invoices", path).orderBy("_arrival").select("id", "created").collect()
    assert len(rows) == 1600
    for first, second in zip(rows[::2], rows[1::2], strict=True):
        assert first.id == second.id and first.created < second.created


@pytest.mark.parametrize("slabs", [dedup.BROADCAST_SLABS, 0])
def test_first_rows_are_kept_where_they_lie(spark, tmp_path, monkeypatch, slabs):
    monkeypatch.setattr(dedup, "BROADCAST_SLABS", slabs)
    # Two files of lines in several slabs, one far away; ids come again within and across files, null among them.
    lines = spark.range(0, 140_000, 1, 3).select(
        F.when(F.col("id") % 1000 != 7, F.concat(F.lit("k"), (F.col("id") * 7919 % 50_021).cast("string"))).alias("key"),
        F.struct(
            (F.col("id") % 2).alias("file"), F.lit(3).alias("path_hash"),
            (F.floor(F.col("id") / 2) + F.when(F.col("id") > 100_000, F.lit(1 << 33)).otherwise(F.lit(0))).alias("line"),
        ).alias("_arrival"),
        F.col("id").cast("string").alias("payload"),
    )
    lines.write.parquet(str(tmp_path / "lines"))
    rows = spark.read.parquet(str(tmp_path / "lines"))
    kept = keep_first_unmoved(rows, "key", "_arrival", str(tmp_path / "bits"))
    wanted = keep_first(rows, "key", ["_arrival"])
    assert kept.columns == rows.columns
    assert kept.count() == wanted.count() and not kept.exceptAll(wanted).count()
    # The rows themselves are not shuffled where their bits can be broadcast.
    assert ("hashpartitioning" in kept._jdf.queryExecution().executedPlan().toString()) <= (not slabs)


def test_first_rows_of_several_keys_that_are_not_known(spark, tmp_path):
    lines = spark.range(0, 4000, 1, 3).selectExpr(
        "id % 700 AS a", "IF(id % 11 = 0, NULL, id % 3) AS b", "named_struct('load', id % 2, 'line', id) AS turn", "id"
    )
    lines.write.parquet(str(tmp_path / "lines"))
    rows, known = spark.read.parquet(str(tmp_path / "lines")), spark.range(0, 100).selectExpr("id AS a", "1L AS b")
    kept = keep_first_unmoved(rows, ("a", "b"), "turn", str(tmp_path / "bits"), known)
    wanted = keep_first(rows, ("a", "b"), ["turn"]).filter("NOT (a < 100 AND b <=> 1)")
    assert kept.count() == wanted.count() > 1000 and not kept.exceptAll(wanted).count()


def test_a_broken_delivery_takes_the_place_of_the_first(spark, sample, monkeypatch):
    """Files that a broken delivery replaces are gone before it is loaded."""
    from revtide.plans import refresh

    shared, seen = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")), []
    load = refresh.full_refresh

    def watched(spark, sources, *args, **options):
        seen.append({p.parent.name for p in shared.glob("broken-*/landing/*/*.gz")})
        return load(spark, sources, *args, **options)

    monkeypatch.setattr(refresh, "full_refresh", watched)
    rows = QUERIES["failed_refresh_keeps_all_tables"](spark, sample).collect()
    assert {r.outcome for r in rows} == {"failed"} and len(rows) == 7
    assert seen[0] - seen[1] == {"invoices", "customers"}


def test_texts_of_a_part_are_made_once(spark, sample, tmp_path, monkeypatch):
    """A condition on the text does not make it again, and only items of delivered orders are looked at."""
    from pyspark.sql import DataFrameWriter

    frames, text = {}, DataFrameWriter.text
    monkeypatch.setattr(
        DataFrameWriter, "text", lambda self, path, *a, **k: (frames.update({Path(path).name: self._df}), text(self, path, *a, **k))
    )
    key = F.regexp_extract("value", '"id":"[a-z]+_([0-9]+)', 1).cast("bigint")

    def part(name, lines):
        return lines.filter(key % 3 != 0) if name in ("subscriptions", "invoices") else None

    paths = tb.write_landing(spark, sample, str(tmp_path / "part"), part, "key % 3 <> 0")
    for entity in ("subscriptions", "invoices"):
        plan = frames[entity]._jdf.queryExecution().optimizedPlan()
        made = re.findall(r"StructsToJson|to_json\(", plan.toString())
        assert len(made) == 1, plan.toString()
        whole = tb.LINES[entity](spark, sample).select("value").filter(key % 3 != 0)
        assert sorted(spark.read.text(paths[entity]).collect()) == sorted(whole.collect())
    assert tb.first_items(spark, sample, "key % 3 <> 0").count() == 400 - 133


def test_buckets_are_dealt_out_in_one_pass(spark, tmp_path, monkeypatch):
    """A range would make the rows once more, for its sample."""
    from revtide import schemas
    from revtide.sinks import versions

    stamp = dt.datetime(2021, 1, 1)
    monkeypatch.setitem(schemas.UNIQUE_KEYS, "products", "product_id")
    made = spark.sparkContext.accumulator(0)

    def seen(part):
        for row in part:
            made.add(1)
            yield row

    rows = spark.createDataFrame([(f"p{n}", "n", None, True, stamp, None, stamp) for n in range(50)], schemas.PRODUCTS)
    watched = spark.createDataFrame(rows.rdd.mapPartitions(seen), schemas.PRODUCTS)
    stored = versions.write_version(watched, str(tmp_path), "products", buckets=4)
    assert made.value == 50 and set(stored.buckets) == {0, 1, 2, 3}
    more = spark.createDataFrame(rows.rdd.mapPartitions(seen), schemas.PRODUCTS).withColumn("product_id", F.concat(F.lit("q"), "product_id"))
    both = versions.write_version(more, str(tmp_path), "products", buckets=4, settled=versions.read_stored(spark, str(tmp_path), "products", stored))
    assert made.value == 100 and versions.read_stored(spark, str(tmp_path), "products", both).count() == 100
    for bucket in range(4):
        found = versions.read_stored(spark, str(tmp_path), "products", both, [bucket])
        assert found.filter(versions.bucket_of("product_id", 4) != bucket).isEmpty()


def test_broken_deliveries_and_landing_files_are_written_at_the_fastest_level(spark, tmp_path):
    lines = spark.range(0, 50_000, 1, 1).selectExpr("to_json(named_struct('id', id, 'mail', concat('billing@', id % 7919, '.com'))) AS value")
    lines.write.option("compression", "gzip").text(str(tmp_path / "default"))
    tb.write_lines(lines, str(tmp_path / "fast"))
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / name).glob("part-*.gz"))
    assert size("default") < size("fast") and sorted(spark.read.text(str(tmp_path / "fast")).collect()) == sorted(lines.collect())


def test_a_load_shuffles_keys_and_not_rows(spark, sample, tmp_path, monkeypatch):
    from revtide.plans import refresh

    plans = {}

    def watched(rows, warehouse, name, **layout):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return write(rows, warehouse, name, **layout)

    write = refresh.versions.write_version
    monkeypatch.setattr(refresh.versions, "write_version", watched)
    paths = tb.write_landing(spark, sample, str(tmp_path / "landing"))
    refresh.full_refresh(spark, paths, str(tmp_path / "tables"), tb.AS_OF, tb.EXTRACTED_AT)
    assert all("Exchange hashpartitioning" not in plans[name] for name in ("subscriptions", "invoices"))


def test_orphans_are_what_children_of_leaves_out(spark, tmp_path):
    children = spark.createDataFrame(
        [("i1", "a"), ("i2", "x"), ("i3", None), ("i4", "a"), ("i4", "a"), ("i5", "b")], "id string, customer string"
    )
    parents = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "customer string")
    orphans = orphan_keys(children, parents, "customer", str(tmp_path / "orphans"))
    kept = children_without(children, orphans, "customer")
    left = children_among(children, orphans, "customer")
    names = lambda rows: sorted(r.id for r in rows.collect())
    assert names(kept) == names(children_of(children, parents, "customer")) == ["i1", "i4", "i4", "i5"]
    assert names(left) == ["i2", "i3"]
    # The children themselves are not shuffled where the orphans are few.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize(
    "name", ["stored_invoices", "catalog_roundtrip", "failed_refresh_keeps_all_tables", "incremental_invoices",
             "subscriptions_from_references"],
)
def test_no_landing_file_stays(spark, sample, name):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.rglob("*"))
    QUERIES[name](spark, sample).collect()
    left = {p for p in shared.rglob("*") if p not in before}
    assert not [p for p in left if p.suffix == ".gz" or ".txt" in p.suffixes]
