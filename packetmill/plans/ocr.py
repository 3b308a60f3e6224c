"""OCR pages: scores, text and cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetmill.functions import page_ranges, text
from packetmill.operators import pages as page_ops
from packetmill.plans.fixtures import table, with_tables
from packetmill.plans.registry import query
from packetmill.session import scratch_dir
from packetmill.sources import readers, writers

_TOKEN = "regexp_replace(t, '^\\s+|\\s+$', '', 'g')"
_A = f"try_cast(regexp_extract({_TOKEN}, '^([0-9]+)\\s*-\\s*([0-9]+)$', 1) AS BIGINT)"
_B = f"try_cast(regexp_extract({_TOKEN}, '^([0-9]+)\\s*-\\s*([0-9]+)$', 2) AS BIGINT)"
# Pages a range names, as a DuckDB list.
RANGE_LIST = f"""flatten(list_transform(string_split(coalesce(page_range, ''), ','), lambda t:
    CASE WHEN {_TOKEN} LIKE '9000000000-%' THEN cast([] AS BIGINT[]) WHEN {_B} IS NOT NULL THEN range({_A}, {_B} + 1)
         WHEN regexp_full_match({_TOKEN}, '[0-9]+') THEN [cast({_TOKEN} AS BIGINT)] ELSE cast([] AS BIGINT[]) END))"""

# Documents with the list of their existing pages and the packet's pages as lists.
SCOPED = f"""packet AS (
  SELECT load_id, list(page_text ORDER BY page_no) AS texts, list(page_conf ORDER BY page_no) AS confs, list(page_no ORDER BY page_no) AS nos
  FROM ocr_pages GROUP BY load_id
), scoped AS (
  SELECT d.*, texts, confs, nos, list_filter({RANGE_LIST}, lambda p: list_contains(nos, p)) AS own
  FROM packet_documents d LEFT JOIN packet USING (load_id)
), joined AS (
  SELECT *, CASE WHEN texts IS NULL THEN '' WHEN len(own) > 0 THEN array_to_string(list_transform(own, lambda p: texts[list_position(nos, p)]), ' ')
                 ELSE array_to_string(texts, ' ') END AS scoped_text,
         round(CASE WHEN len(own) > 0 THEN list_avg(list_transform(own, lambda p: confs[list_position(nos, p)])) ELSE list_avg(confs) END, 3) AS ocr_confidence
  FROM scoped
)"""


def scoped_oracle(select: str) -> str:
    return with_tables(f"WITH {SCOPED}\n{select}", "ocr_pages", "packet_documents")


@query(with_tables(f"""WITH l AS (SELECT load_id, doc_seq, page_range, {RANGE_LIST} AS pages FROM packet_documents)
SELECT load_id, doc_seq, unnest(pages) AS page_no, cast(unnest(range(len(pages))) AS INTEGER) AS place, cast(len(pages) AS VARCHAR) AS named FROM l
UNION ALL SELECT load_id, doc_seq, NULL, NULL, CASE WHEN page_range LIKE '9000000000-%' THEN '9999999999991000000000' ELSE '0' END FROM l WHERE len(pages) = 0""", "packet_documents"))
def c4_parse_page_range(spark, sf_dir):
    """Every named page; a range without any, or with more than any table can list, has its count alone."""
    docs = table(spark, sf_dir, "packet_documents").select("load_id", "doc_seq", "page_range")
    return page_ranges.list_named(docs).select(
        "load_id", "doc_seq", page_ranges.named_pages(F.col("page_range")).cast("string").alias("named"),
        F.col("place").cast("int").alias("place"), "page_no")


@query(with_tables("""WITH v AS (
  SELECT load_id, doc_seq, unnest([load_number, rc_number, carrier_scac, rate_total_evidence, weight_evidence]) AS raw FROM packet_documents
  UNION ALL SELECT load_id, doc_seq, CASE WHEN x = floor(x) THEN cast(cast(x AS BIGINT) AS VARCHAR) ELSE cast(x AS VARCHAR) END
  FROM (SELECT load_id, doc_seq, unnest([rate_total, weight, rate_total / 8, weight * 1000]) AS x FROM packet_documents)
  UNION ALL SELECT cast(doc_id AS VARCHAR), 0, text FROM documents
)
SELECT load_id, doc_seq, array_to_string(regexp_extract_all(lower(raw), '[a-z0-9]+'), '') AS normed FROM v WHERE raw IS NOT NULL""",
                   "packet_documents"))
def c5_norm(spark, sf_dir):
    docs = table(spark, sf_dir, "packet_documents")
    words = [text.norm(F.col(c)) for c in ["load_number", "rc_number", "carrier_scac", "rate_total_evidence", "weight_evidence"]]
    numbers = [text.norm_number(c) for c in [F.col("rate_total"), F.col("weight"), F.col("rate_total") / 8, F.col("weight") * 1000]]
    values = docs.select("load_id", "doc_seq", F.explode(F.array(*words, *numbers)).alias("normed")).filter("normed IS NOT NULL")
    bodies = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("load_id"), F.lit(0).alias("doc_seq"), text.norm(F.col("text")).alias("normed")
    )
    return values.unionByName(bodies)


@query(scoped_oracle("SELECT load_id, doc_seq, cast(0 AS BIGINT) AS part_no, scoped_text FROM joined"))
def c6_page_text_for(spark, sf_dir):
    return page_ops.page_text_for(table(spark, sf_dir, "packet_documents"), table(spark, sf_dir, "ocr_pages"))


@query(with_tables("""SELECT load_id, cast((page_no - 1) // 1024 AS BIGINT) AS part_no,
  CASE WHEN bool_or(regexp_matches(any_text, '\\S')) THEN string_agg('--- PAGE ' || page_no || ' ---' || chr(10) || page_text, chr(10) ORDER BY page_no)
       ELSE string_agg(page_text, chr(10) ORDER BY page_no) END AS marked_text
FROM (SELECT *, string_agg(page_text, '') OVER (PARTITION BY load_id) AS any_text FROM ocr_pages) GROUP BY load_id, part_no""", "ocr_pages"))
def c8_marked_text(spark, sf_dir):
    return page_ops.marked_text(table(spark, sf_dir, "ocr_pages"))


CHUNK_PAGES = 3


def _chunks(pages: DataFrame) -> DataFrame:
    """OCR chunks of three pages with each page's text in two segments, as the service returns them."""
    chunk = F.floor((F.col("page_no") - 1) / CHUNK_PAGES).cast("bigint")
    rows = F.array_sort(F.collect_list(F.struct("page_no", "page_text", "page_conf")))
    grouped = pages.groupBy("load_id", chunk.alias("chunk_no")).agg(rows.alias("p"))
    texts = F.col("p.page_text")
    start = lambda i: F.length(F.array_join(F.slice(texts, 1, i), "")) + i
    segments = F.transform(
        texts,
        lambda t, i: F.array(
            F.struct(start(i).alias("start"), (start(i) + F.floor(F.length(t) / 2)).cast("int").alias("end")),
            F.struct((start(i) + F.floor(F.length(t) / 2)).cast("int").alias("start"), (start(i) + F.length(t)).alias("end")),
        ),
    )
    return grouped.select("load_id", "chunk_no", F.array_join(texts, "\n").alias("chunk_text"), segments.alias("pages"),
        F.col("p.page_conf").alias("page_confs"))


@query(with_tables("""WITH c AS (
  SELECT load_id, (page_no - 1) // 3 AS chunk_no,
    CASE WHEN cast(load_id AS BIGINT) % 4 = 0 AND (page_no - 1) // 3 = 0 THEN '' ELSE string_agg(page_text, chr(10) ORDER BY page_no) END AS t
  FROM ocr_pages GROUP BY load_id, (page_no - 1) // 3
)
SELECT load_id, cast(0 AS BIGINT) AS part_no, ltrim(string_agg(t, chr(10) ORDER BY chunk_no), chr(10)) AS full_text FROM c GROUP BY load_id""", "ocr_pages"))
def c10_stitch_chunks(spark, sf_dir):
    chunks = _chunks(table(spark, sf_dir, "ocr_pages"))
    blank = (F.col("load_id").cast("bigint") % 4 == 0) & (F.col("chunk_no") == 0)
    return page_ops.stitch_chunks(chunks.withColumn("chunk_text", F.when(blank, "").otherwise(F.col("chunk_text"))))


_GAPLESS = """gapless AS (
  SELECT load_id, cast(row_number() OVER (PARTITION BY load_id ORDER BY page_no) AS INTEGER) AS page_no, page_text, page_conf FROM ocr_pages)"""


def _gapless(spark, sf_dir) -> DataFrame:
    """The pages as a service numbers them: without gaps."""
    pages = table(spark, sf_dir, "ocr_pages")
    return pages.withColumn("page_no", F.row_number().over(Window.partitionBy("load_id").orderBy("page_no")))


@query(with_tables(f"WITH {_GAPLESS} SELECT load_id, page_no, page_text, round(page_conf, 9) AS page_conf FROM gapless", "ocr_pages"))
def c11_slice_page_text(spark, sf_dir):
    """Texts and confidences of chunked pages, numbered through the packet again."""
    sliced = page_ops.slice_page_text(_chunks(_gapless(spark, sf_dir)))
    pages = page_ops.stitch_pages(sliced, CHUNK_PAGES)
    return pages.select("load_id", "page_no", "page_text", F.round("page_conf", 9).alias("page_conf"))


@query(with_tables("""SELECT o.load_id, c.n IS NOT NULL AS ocr_cached, coalesce(c.n, 0) AS cached_pages
FROM (SELECT DISTINCT load_id FROM ocr_pages) o LEFT JOIN (SELECT load_id, count(*) AS n FROM ocr_cache_pages GROUP BY load_id) c USING (load_id)""",
                   "ocr_pages", "ocr_cache_pages"))
def d2_ocr_lookup(spark, sf_dir):
    loads = table(spark, sf_dir, "ocr_pages").select("load_id").distinct()
    return page_ops.ocr_lookup(loads, table(spark, sf_dir, "ocr_cache_pages"))


@query(with_tables("SELECT load_id, page_no, page_text, round(page_conf, 9) AS page_conf FROM ocr_cache_pages WHERE cast(load_id AS BIGINT) % 2 = 0",
                   "ocr_cache_pages"))
def d2_cached_pages(spark, sf_dir):
    """The stored pages of the even loads."""
    loads = table(spark, sf_dir, "ocr_pages").select("load_id").filter(F.col("load_id").cast("bigint") % 2 == 0)
    pages = page_ops.cached_pages(loads, table(spark, sf_dir, "ocr_cache_pages"))
    return pages.withColumn("page_conf", F.round("page_conf", 9))


@query(with_tables("SELECT DISTINCT load_id FROM ocr_pages WHERE load_id NOT IN (SELECT load_id FROM ocr_cache_pages)", "ocr_pages", "ocr_cache_pages"))
def d2_cache_misses(spark, sf_dir):
    loads = table(spark, sf_dir, "ocr_pages").select("load_id").distinct()
    return page_ops.cache_misses(loads, table(spark, sf_dir, "ocr_cache_pages"))


@query(scoped_oracle("""SELECT load_id, doc_seq, page_no, page_text, round(page_conf, 9) AS page_conf
FROM (SELECT load_id, doc_seq, unnest(own) AS page_no, unnest(list_transform(own, lambda p: texts[list_position(nos, p)])) AS page_text,
             unnest(list_transform(own, lambda p: confs[list_position(nos, p)])) AS page_conf FROM joined)"""))
def d4_docs_to_pages(spark, sf_dir):
    rows = page_ops.docs_to_pages(table(spark, sf_dir, "packet_documents"), table(spark, sf_dir, "ocr_pages"))
    return rows.select("load_id", "doc_seq", "page_no", "page_text", F.round("page_conf", 9).alias("page_conf"))


@query(with_tables("""SELECT load_id, page_no, coalesce(round(list_avg(list_filter(list(confidence), lambda c: c <> 0)), 3), 0.0) AS page_conf
FROM ocr_tokens GROUP BY load_id, page_no""", "ocr_tokens"))
def e2_page_confidence(spark, sf_dir):
    return page_ops.page_confidence(table(spark, sf_dir, "ocr_tokens"))


@query(scoped_oracle("SELECT load_id, doc_seq, ocr_confidence FROM joined"))
def e3_doc_confidence(spark, sf_dir):
    return page_ops.doc_confidence(table(spark, sf_dir, "packet_documents"), table(spark, sf_dir, "ocr_pages"))


@query(with_tables("SELECT load_id, page_no, page_text, round(page_conf, 9) AS page_conf FROM ocr_cache_pages", "ocr_cache_pages"))
def a3_read_ocr_cache(spark, sf_dir):
    """Beside every entry lies one cut short and one without its page texts; both must read as misses."""
    out = scratch_dir(spark, "a3")
    line = F.to_json(F.struct("load_id", "full_text", "page_text", "page_conf", "page_no"))
    partial = F.to_json(F.struct("load_id", "full_text", "page_conf", "page_no"))
    lines = F.explode(F.array(line, F.left(line, F.length(line) - 3), partial))
    writers.ocr_entries(table(spark, sf_dir, "ocr_cache_pages")).select(lines.alias("value")).write.mode("overwrite").text(out)
    pages = readers.read_ocr_entries(spark, out)
    return pages.withColumn("page_conf", F.round("page_conf", 9))


@query(with_tables("SELECT load_id, page_no, page_text, round(page_conf, 9) AS page_conf FROM ocr_pages", "ocr_pages"))
def b2_write_ocr_cache(spark, sf_dir):
    """Start from a cache of every third load, add all pages; only the misses may be appended."""
    out = scratch_dir(spark, "b2")
    writers.write_ocr_cache(table(spark, sf_dir, "ocr_cache_pages"), None, out)
    writers.write_ocr_cache(table(spark, sf_dir, "ocr_pages"), readers.read_ocr_cache(spark, out), out)
    return readers.read_ocr_cache(spark, out).withColumn("page_conf", F.round("page_conf", 9))
