"""Listing, triage and selection of files."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetmill.functions import ids
from packetmill.functions.imaging import page_tiles, page_zoom
from packetmill.functions.triage import is_transient
from packetmill.operators import manifest
from packetmill.plans.fixtures import OUTPUT_PREFIX, RAW_PREFIX, VIEW, base, over_views, table, with_tables
from packetmill.plans.registry import query
from packetmill.session import scratch_dir
from packetmill.sources import listing, writers

PDFS = """pdfs AS (
  SELECT *, regexp_extract(path, '^raw/loads/([^/]*)', 1) AS load_id FROM manifest WHERE path ILIKE 'raw/loads/%.pdf'
), keyed AS (
  SELECT *, CASE WHEN regexp_full_match(load_id, '[0-9]+') THEN cast(load_id AS BIGINT) ELSE -1 END AS sort_key FROM pdfs
), done AS (
  SELECT DISTINCT replace(replace(path, 'json/v1/', ''), '.json', '') AS load_id FROM outputs
  WHERE path LIKE 'json/v1/%' AND path LIKE '%.json'
), multi AS (SELECT load_id, count(*) AS doc_count FROM pdfs GROUP BY load_id HAVING count(*) > 1),
work AS (
  SELECT load_id, path, sort_key FROM keyed
  WHERE load_id NOT IN (SELECT load_id FROM multi) AND load_id NOT IN (SELECT load_id FROM done)
)"""


def _oracle(select: str) -> str:
    return with_tables(f"WITH {PDFS}\n{select}", "manifest", "outputs")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.scan_manifest(table(spark, sf_dir, "manifest"), RAW_PREFIX)


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.done_from_listing(table(spark, sf_dir, "outputs"), OUTPUT_PREFIX)


@query(_oracle("SELECT path, length FROM pdfs"))
def a1_scan_manifest(spark, sf_dir):
    return _files(spark, sf_dir).select("path", "length")


@query("""SELECT cast(s_suppkey AS VARCHAR) AS load_id, s_name || CASE WHEN s_suppkey % 2 = 0 THEN '.pdf' ELSE '.PDF' END AS name,
  cast(s_suppkey % 7 * 10 AS BIGINT) AS length FROM supplier""")
def a1_list_folder(spark, sf_dir):
    """A file per supplier, every seventh of them empty, listed from its folder."""
    root = scratch_dir(spark, "a1")

    def make(batches):
        files, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for row in batch.to_pylist():
                files.create_dir(f"{base}/{row['load_id']}", recursive=True)
                for name, n in ((row["name"], row["length"]), ("note.txt", 1)):
                    with files.open_output_stream(f"{base}/{row['load_id']}/{name}") as out:
                        out.write(b"x" * n)
            yield batch

    ending = F.when(F.col("s_suppkey") % 2 == 0, ".pdf").otherwise(".PDF")
    rows = base(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("load_id"), F.concat("s_name", ending).alias("name"), (F.col("s_suppkey") % 7 * 10).cast("bigint").alias("length"))
    rows.mapInArrow(make, rows.schema).write.format("noop").mode("overwrite").save()
    files = manifest.scan_manifest(listing.list_files(spark, root), f"{root}/")
    return files.select("load_id", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


@query(_oracle("SELECT load_id FROM done"))
def a4_done_loads(spark, sf_dir):
    return _done(spark, sf_dir)


@query(with_tables("SELECT path, split_part(path, '/', 3) AS load_id FROM manifest", "manifest"))
def c1_load_id(spark, sf_dir):
    return table(spark, sf_dir, "manifest").select("path", ids.load_id(F.col("path"), RAW_PREFIX).alias("load_id"))


@query(_oracle("SELECT DISTINCT load_id, cast(sort_key AS VARCHAR) AS sort_key FROM keyed"))
def c2_load_sort_key(spark, sf_dir):
    loads = _files(spark, sf_dir).select("load_id").distinct()
    return loads.select("load_id", ids.load_sort_key(F.col("load_id")).cast("string").alias("sort_key"))


@query(_oracle("""SELECT path,
       CASE WHEN length > 0 AND openable AND NOT needs_pass AND page_count <> 0 THEN 'ok' ELSE 'invalid' END AS status,
       coalesce(list_filter([CASE WHEN length = 0 THEN 'empty file (0 bytes)' END,
         CASE WHEN NOT openable THEN 'cannot open as PDF' END, CASE WHEN needs_pass THEN 'password-protected PDF' END,
         CASE WHEN page_count = 0 THEN 'PDF has 0 pages' END], lambda r: r IS NOT NULL)[1], '') AS reason
FROM pdfs"""))
def c3_triage(spark, sf_dir):
    return manifest.with_triage(_files(spark, sf_dir)).select("path", "status", F.coalesce("reason", F.lit("")).alias("reason"))


@query(_oracle("""SELECT path, cast(c AS BIGINT) AS chunk_no, cast(c * 30 AS BIGINT) AS start_page,
       cast(CASE WHEN (c + 1) * 30 > page_count THEN page_count ELSE (c + 1) * 30 END - 1 AS BIGINT) AS end_page
FROM (SELECT path, page_count, unnest(range((page_count + 29) // 30)) AS c FROM pdfs WHERE page_count > 0)"""))
def c9_page_chunks(spark, sf_dir):
    return manifest.page_chunks(_files(spark, sf_dir)).select("path", "chunk_no", "start_page", "end_page")


IMAGE_SIZES = """SELECT p_partkey AS page_key,
  cast(CASE WHEN p_partkey % 50 = 0 THEN 9000 ELSE p_size * 37 END AS double) AS width,
  cast(CASE WHEN p_partkey % 50 = 0 THEN 2 WHEN p_partkey % 7 = 0 THEN p_size ELSE p_size * 41 END AS double) AS height
FROM part"""


@query(f"""WITH s AS ({IMAGE_SIZES}), z AS (
  SELECT *, list_min([1536.0::DOUBLE / list_max([width, height]), 4.0]) AS fit, list_min([width, height]) AS short FROM s
), y AS (SELECT *, CASE WHEN short * fit >= 1 THEN fit ELSE list_max([fit, 1.0::DOUBLE / list_max([short, 0.01])]) END AS zoom FROM z)
SELECT page_key, round(zoom, 6) AS zoom, cast(ceil(width * zoom / 768) AS BIGINT) * cast(ceil(height * zoom / 768) AS BIGINT) AS tiles
FROM y""")
def c12_page_image_plan(spark, sf_dir):
    base(spark, sf_dir, "part").createOrReplaceTempView(f"{VIEW}part")
    w, h = F.col("width"), F.col("height")
    return spark.sql(over_views(IMAGE_SIZES, ["part"])).select(
        "page_key", F.round(page_zoom(w, h), 6).alias("zoom"), page_tiles(w, h).alias("tiles")
    )


@query(with_tables("""SELECT load_id, error_class, coalesce(code, 0) AS code,
  CASE error_class WHEN 'ClientError' THEN coalesce(code, 0) = 429 ELSE error_class NOT IN ('ValueError', 'PermissionDenied') END AS transient
FROM failure_log""", "failure_log"))
def c13_classify_error(spark, sf_dir):
    return table(spark, sf_dir, "failure_log").select(
        "load_id", "error_class", F.coalesce("code", F.lit(0)).alias("code"),
        is_transient(F.col("error_class"), F.col("code")).alias("transient"),
    )


@query(_oracle("SELECT load_id, path FROM work"))
def d1_worklist(spark, sf_dir):
    return manifest.worklist(_files(spark, sf_dir), _done(spark, sf_dir)).select("load_id", "path")


@query(_oracle("SELECT load_id, count(*) AS doc_count, count(*) > 1 AS is_multi FROM pdfs GROUP BY load_id"))
def e1_files_per_load(spark, sf_dir):
    return manifest.files_per_load(_files(spark, sf_dir)).withColumn("is_multi", F.col("doc_count") > 1)


@query(_oracle("SELECT load_id, path, cast(sort_key AS VARCHAR) AS sort_key FROM work"))
def g1_ordered_worklist(spark, sf_dir):
    work = manifest.worklist(_files(spark, sf_dir), _done(spark, sf_dir))
    return manifest.ordered_worklist(work, newest_first=True).withColumn("sort_key", F.col("sort_key").cast("string"))


@query(_oracle("""SELECT load_id, path, row_number() OVER (ORDER BY sort_key DESC, path) AS position FROM work"""))
def g1_worklist_positions(spark, sf_dir):
    work = manifest.worklist(_files(spark, sf_dir), _done(spark, sf_dir))
    return manifest.positioned_worklist(work, newest_first=True).select("load_id", "path", "position")


@query(_oracle("SELECT load_id, path FROM work ORDER BY sort_key, path LIMIT 100"))
def g2_limited_worklist(spark, sf_dir):
    work = manifest.worklist(_files(spark, sf_dir), _done(spark, sf_dir))
    return manifest.limited_worklist(work, 100).select("load_id", "path")


@query(_oracle("""SELECT CASE WHEN d.load_id IS NOT NULL THEN 'done' WHEN m.load_id IS NOT NULL THEN 'multi' ELSE 'todo' END AS outcome,
  count(DISTINCT p.load_id) AS loads, count(*) AS files
FROM pdfs p LEFT JOIN done d USING (load_id) LEFT JOIN multi m USING (load_id) GROUP BY 1"""))
def g3_skip_report(spark, sf_dir):
    report = manifest.skip_report(_files(spark, sf_dir), _done(spark, sf_dir))
    return report.select("outcome", "loads", F.col("files").cast("bigint").alias("files"))


@query(_oracle("SELECT load_id AS folder, doc_count FROM multi"))
def b4_write_multi_csv(spark, sf_dir):
    out = scratch_dir(spark, "b4")
    writers.write_multi_csv(_files(spark, sf_dir), out)
    return spark.read.option("header", "true").schema("folder string, doc_count bigint").csv(out)


@query(_oracle("""SELECT load_id || ' (' || cast(doc_count AS VARCHAR) || ' PDFs)' AS line FROM multi
UNION ALL SELECT '    ' || path FROM pdfs WHERE load_id IN (SELECT load_id FROM multi)"""))
def b5_multi_manifest_lines(spark, sf_dir):
    out = scratch_dir(spark, "b5")
    writers.write_multi_manifest(_files(spark, sf_dir), out)
    return spark.read.text(out).withColumnRenamed("value", "line")
