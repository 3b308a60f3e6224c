"""Plans: what is read, what is shuffled, and what happens to a hot key."""

import pytest
from pyspark.sql import functions as F

from packetmill.operators import gold, manifest, nested, verify
from packetmill.operators.joins import join_summary
from packetmill.operators.pages import with_scope
from packetmill.plans.fixtures import RAW_PREFIX, table
from packetmill.sources.readers import done_loads


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def large_data(spark):
    """Settings under which small test data behaves as data too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_documents(spark, n=40_000):
    """A third of all documents belong to load 7."""
    return spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "7").otherwise(F.col("id").cast("string")).alias("load_id"),
        (F.col("id") + 1).cast("int").alias("doc_seq"), F.lit("1").alias("page_range"),
        F.sha2(F.col("id").cast("string"), 256).alias("load_number"),
    )


def test_hot_load_is_split_when_joined_to_its_summary(spark, large_data):
    docs = hot_documents(spark)
    summary = docs.groupBy("load_id").agg(F.count("*").alias("n"))
    joined = join_summary(docs, summary, ["load_id"])
    assert "skew=true" in executed(joined)
    # A plain join reuses the grouping's partitions and leaves the hot load in one task.
    assert "skew=true" not in executed(docs.join(summary, "load_id", "left"))
    assert joined.filter("load_id = '7'").agg(F.max("n"), F.count("*")).first()[:] == (13335, 13335)  # ids 0, 3, 6 ... and id 7 itself


def test_hot_load_is_split_in_scoring(spark, large_data):
    pages = spark.range(0, 40_000, 1, 8).select(
        F.col("id").cast("string").alias("load_id"), F.lit(1).alias("page_no"), F.lit("x").alias("page_text"), F.lit(0.5).alias("page_conf")
    )
    assert "skew=true" in executed(with_scope(hot_documents(spark), pages))


def test_page_join_spreads_a_hot_packet(spark, large_data):
    """One packet owns a third of all pages: its pages lie in many partitions, keyed by page number."""
    pages = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "7").otherwise(F.concat(F.lit("L"), F.col("id").cast("string"))).alias("load_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") / 3 + 1).otherwise(1).cast("int").alias("page_no"),
        F.concat(F.lit("page "), F.col("id").cast("string")).alias("page_text"), F.lit(0.5).alias("page_conf"),
    )
    docs = spark.createDataFrame([("7", 1, "x", "page29997"), ("7", 2, "2-9000", "page 0"), ("L1", 1, "1", "page1")],
                                 "load_id string, doc_seq int, page_range string, load_number string")
    spread = pages.repartition(8, "load_id", "page_no").filter("load_id = '7'").groupBy(F.spark_partition_id()).count()
    assert spread.agg(F.max("count")).first()[0] < 2000
    got = verify.check_documents(docs, pages)
    rows = {(r.load_id, r.doc_seq): (r.unverified_fields, r.ocr_confidence) for r in got.collect()}
    # Pages 2 to 9000 hold "page 3" to "page 26997"; only page 1 starts "page 0".
    assert rows == {("7", 1): ("", 0.5), ("7", 2): ("load_number", 0.5), ("L1", 1): ("", 0.5)}


def test_text_is_shuffled_once(spark, large_data, sf_dir):
    docs, pages = table(spark, sf_dir, "packet_documents"), table(spark, sf_dir, "ocr_pages")
    plan = executed(verify.check_documents(docs, pages))
    text_exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(load_id" in line and "page_no" in line]
    # One for the pages, one for the documents' list of pages.
    assert len(text_exchanges) == 2, plan


def test_worklist_needs_one_grouping(spark, sf_dir):
    files = manifest.scan_manifest(table(spark, sf_dir, "manifest"), RAW_PREFIX)
    plan = files.transform(lambda f: manifest.worklist(f, f.select("load_id").limit(0)))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line]
    # Lengths and page counts are not read.
    assert all("l_quantity" not in line for line in scans)


def test_done_loads_reads_one_column(spark, sf_dir, tmp_path):
    table(spark, sf_dir, "silver_documents").write.parquet(str(tmp_path / "silver"))
    plan = done_loads(spark.read.parquet(str(tmp_path / "silver")))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<load_id:string>" in plan


def test_gold_tables_prune_and_push_down(spark, sf_dir, tmp_path):
    gold.documents_classified(table(spark, sf_dir, "silver_documents")).write.parquet(str(tmp_path / "gold"))
    plan = gold.bills_of_lading(spark.read.parquet(str(tmp_path / "gold")))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_type), EqualTo(doc_type,bill_of_lading)]" in plan
    assert "rate_total" not in plan


def test_limit_is_a_top_k(spark, sf_dir):
    files = manifest.scan_manifest(table(spark, sf_dir, "manifest"), RAW_PREFIX)
    plan = manifest.limited_worklist(files.select("load_id", "path", "sort_key"), 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_nested_columns_are_pruned(spark, sf_dir, tmp_path):
    from packetmill.plans import silver

    silver.packets(spark, sf_dir).write.parquet(str(tmp_path / "packets"))
    plan = nested.explode_stops(spark.read.parquet(str(tmp_path / "packets")))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "broker_name" not in scan.split("ReadSchema")[1]
