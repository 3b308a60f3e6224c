"""Freight-shaped tables derived from the benchmark's star schema.

Each statement is plain SQL that Spark and DuckDB read alike; later ones use earlier ones by name.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetmill.operators.joins import join_summary
from packetmill.operators.ranking import with_position
from packetmill.session import INITIAL_PARTITIONS, changed, discarding, freeing, scratch_dir, shares, stored

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

RAW_PREFIX = "raw/loads/"
OUTPUT_PREFIX = "json/v1/"

SQL: dict[str, str] = {}

SQL["manifest"] = """
SELECT concat('raw/loads/', CASE WHEN l_orderkey % 97 = 0 THEN 'X' ELSE '' END, cast(l_orderkey AS string), '/',
              cast(l_linenumber AS string), '_', cast(l_partkey AS string), '_', cast(l_suppkey AS string),
              CASE WHEN l_returnflag = 'R' THEN '.txt' WHEN l_linestatus = 'F' THEN '.PDF' ELSE '.pdf' END) AS path,
       CASE WHEN l_quantity < 3 THEN cast(0 AS bigint) ELSE cast(l_quantity * 1000 AS bigint) END AS length,
       l_linenumber <> 2 AS openable, l_linenumber = 3 AS needs_pass,
       CASE WHEN l_linenumber = 4 THEN 0 ELSE cast(l_quantity AS int) END AS page_count
FROM lineitem
"""

SQL["ocr_tokens"] = """
SELECT cast(l_orderkey AS string) AS load_id, l_linenumber AS page_no,
       cast(round(l_discount * 100) AS int) / cast(11 AS double) AS confidence
FROM lineitem
"""

SQL["ocr_pages"] = """
SELECT cast(conv_id AS string) AS load_id, cast(turn + 1 AS int) AS page_no,
       CASE WHEN conv_id % 17 = 0 THEN '  ' ELSE text END AS page_text,
       ((conv_id * 31 + turn * 17) % 98) / cast(97 AS double) AS page_conf
FROM conversations WHERE conv_id % 19 <> 0 OR turn <> 1
"""

SQL["packet_documents"] = """
SELECT cast(conv_id AS string) AS load_id, cast(turn / 2 + 1 AS int) AS doc_seq,
       CASE cast((conv_id + turn / 2) % 7 AS int) WHEN 0 THEN 'rate_confirmation' WHEN 1 THEN 'bill_of_lading'
            WHEN 2 THEN 'proof_of_delivery' WHEN 3 THEN 'invoice' WHEN 4 THEN 'lumper_receipt'
            WHEN 5 THEN 'packing_list' ELSE 'other' END AS doc_type,
       CASE cast(conv_id % 10 AS int) WHEN 3 THEN CASE WHEN conv_id % 4 = 3 THEN '9000000000-9999999999999999999999' ELSE 'x' END
            WHEN 4 THEN concat(cast(turn + 1 AS string), ', ', cast(turn + 2 AS string))
            WHEN 5 THEN '30-31' WHEN 6 THEN concat(cast(turn + 2 AS string), '-', cast(turn + 1 AS string))
            WHEN 7 THEN '1-2-3' WHEN 8 THEN cast(turn + 1 AS string)
            ELSE concat(cast(turn + 1 AS string), '-', cast(turn + 2 AS string)) END AS page_range,
       conv_id % 4 = 0 AS is_signed_delivery_copy,
       CASE WHEN conv_id % 2 = 0 THEN substr(text, 3, 9) ELSE concat('LN', cast(conv_id * 7919 AS string)) END AS load_number,
       substr(text, 1, 12) AS rc_number,
       CASE WHEN conv_id % 5 = 0 THEN '' ELSE substr(text, 1, 2) END AS carrier_scac,
       conv_id * cast(100 AS double) + cast(0.5 AS double) AS rate_total,
       CASE cast(conv_id % 4 AS int) WHEN 0 THEN substr(text, 5, 14) WHEN 1 THEN '$9,999,999.00'
            WHEN 2 THEN concat(substr(text, 1, 20), repeat('9', 60)) ELSE NULL END AS rate_total_evidence,
       cast(conv_id AS double) AS weight,
       CASE cast(conv_id % 3 AS int) WHEN 0 THEN '$' WHEN 1 THEN '' ELSE NULL END AS weight_evidence
FROM conversations WHERE turn % 2 = 0
"""

# Long packets: the whole texts of a source's documents are its pages, with gaps in their numbers.
SQL["book_pages"] = """
SELECT load_id, cast(n + floor(n / cast(100 AS double)) * 3 AS int) AS page_no, page_text, page_conf
FROM (SELECT coalesce(source, 'none') AS load_id, row_number() OVER (PARTITION BY coalesce(source, 'none') ORDER BY doc_id) AS n,
             text AS page_text, (doc_id % 98) / cast(97 AS double) AS page_conf FROM documents) t
"""

# Documents over one, some or very many of those pages, with all key fields.
SQL["book_documents"] = """
SELECT load_id, page_no AS doc_seq,
       CASE cast(page_no % 20 AS int) WHEN 0 THEN '2-300,302-600' WHEN 5 THEN concat('1-', cast(page_no AS string))
            WHEN 10 THEN concat(cast(page_no AS string), '-', cast(page_no + 150 AS string), ',1-70') ELSE cast(page_no AS string) END AS page_range,
       substr(page_text, 10, 12) AS load_number, substr(page_text, 30, 600) AS pro_number, concat('B', cast(page_no * 7919 AS string)) AS bol_number,
       substr(page_text, 1, 40) AS order_number, CASE WHEN page_no % 10 = 0 THEN '' ELSE substr(page_text, 100, 9) END AS rc_number,
       concat('MC ', substr(page_text, 5, 6)) AS broker_mc, substr(page_text, 50, 8) AS carrier_mc, substr(page_text, 60, 5) AS carrier_dot,
       substr(page_text, 3, 4) AS carrier_scac, page_no + cast(0.5 AS double) AS rate_total, cast(page_no * 1000 AS double) AS line_haul,
       cast(page_no % 7 AS double) AS fuel_surcharge, cast(page_no AS double) AS weight,
       substr(page_text, 20, 30) AS rate_total_evidence, CASE WHEN page_no % 3 = 0 THEN '$' ELSE substr(page_text, 200, 5) END AS weight_evidence
FROM book_pages WHERE page_no % 5 = 0
"""

SQL["freight_documents"] = """
SELECT cast(l_orderkey AS string) AS load_id,
       cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS int) AS doc_seq,
       CASE l_linenumber WHEN 1 THEN 'Rate Confirmation' WHEN 2 THEN 'bill_of_lading' WHEN 3 THEN 'proof_of_delivery'
            WHEN 4 THEN 'Load Sheet' WHEN 5 THEN 'lumper_receipt' WHEN 6 THEN 'packing_list' ELSE 'weird' END AS doc_type_raw,
       CASE WHEN l_linenumber <= 4 AND l_partkey % 3 <> 0 THEN concat('L-', cast(o_orderkey + l_partkey % 2 AS string)) END AS load_number,
       l_extendedprice AS rate_total,
       CASE WHEN l_discount > 0.02 THEN CASE WHEN l_discount > 0.08 THEN l_extendedprice ELSE floor(round(l_extendedprice * 100) * (100 - round(l_discount * 100)) / cast(100 AS double)) / cast(100 AS double) END END AS line_haul,
       CASE WHEN l_discount > 0.04 THEN floor(round(l_extendedprice * 100) * round(l_discount * 100) / cast(100 AS double)) / cast(100 AS double) END AS fuel_surcharge,
       l_quantity * 100 AS weight, CASE WHEN l_tax > 0.06 THEN 'kg' WHEN l_tax > 0.03 THEN 'lb' END AS weight_unit,
       CASE WHEN p_size % 9 = 0 THEN p_size * 40 WHEN p_size % 7 <> 0 THEN p_size END AS pallet_count,
       cast(l_quantity AS int) AS pieces, cast(l_quantity AS int) - cast(l_partkey % 3 AS int) AS pieces_received,
       cast(l_suppkey * 10 AS double) AS miles,
       cast(cast(o_orderdate AS date) AS string) AS pickup_date,
       CASE WHEN l_partkey % 50 = 0 THEN '2020-13-45' ELSE cast(cast(l_shipdate AS date) AS string) END AS delivery_date,
       c_name AS broker_name, concat(' ', upper(s_name), ', LLC.') AS carrier_name,
       CASE WHEN l_suppkey % 2 = 0 THEN concat('MC-', cast(s_suppkey AS string)) END AS carrier_mc,
       sn.n_name AS origin_state, cn.n_name AS destination_state,
       CASE WHEN p_size % 14 = 0 THEN concat(cast(p_size AS string), ' PLTS ', p_name) ELSE p_name END AS commodity,
       CASE cast(p_size % 5 AS int) WHEN 0 THEN concat('53', chr(39), ' Dry Van ', p_type) WHEN 1 THEN 'V' WHEN 2 THEN 'Reefer -10F continuous'
            WHEN 3 THEN '48 FT FLATBED' ELSE 'Step Deck' END AS equipment_type_raw,
       l_returnflag = 'R' AS is_signed_delivery_copy
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN nation cn ON c_nationkey = cn.n_nationkey
"""

SQL["usage_calls"] = """
SELECT event_id AS call_id, cast(user_id AS string) AS load_id, ts,
       CASE WHEN event_type = 'error' THEN NULL ELSE cast(round(value * 100) AS bigint) END AS prompt_tokens,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 997 END AS candidate_tokens,
       CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE event_id % 311 END AS thought_tokens,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 11 = 0 THEN cast(0 AS bigint)
            ELSE cast(round(value * 100) AS bigint) + event_id % 997
               + CASE WHEN event_type = 'view' THEN cast(0 AS bigint) ELSE event_id % 311 END
               + CASE WHEN event_id % 50 = 0 THEN 7 ELSE 0 END END AS total_tokens,
       cast(1 + event_id % 5 AS int) AS ocr_pages, event_id % 3 = 0 AS ocr_cached,
       CASE WHEN event_id % 40 = 0 THEN 'MAX_TOKENS' WHEN event_id % 41 = 0 THEN NULL ELSE 'STOP' END AS finish_reason
FROM events
"""

SQL["failure_log"] = """
SELECT cast(event_id AS string) AS load_id,
       CASE cast(event_id % 8 AS int) WHEN 0 THEN 'TimeoutError' WHEN 1 THEN 'ClientError' WHEN 2 THEN 'ServerError'
            WHEN 3 THEN 'ValueError' WHEN 4 THEN 'ResourceExhausted' WHEN 5 THEN 'PermissionDenied'
            WHEN 6 THEN 'ConnectionError' ELSE 'ClientError' END AS error_class,
       CASE cast(event_id % 8 AS int) WHEN 1 THEN 429 WHEN 7 THEN 400 WHEN 2 THEN 503 ELSE NULL END AS code
FROM events WHERE event_type = 'error'
"""

SQL["stops"] = """
SELECT load_id, cast(floor((doc_seq + 1) / cast(2 AS double)) AS int) AS doc_seq,
       cast(row_number() OVER (PARTITION BY load_id, floor((doc_seq + 1) / cast(2 AS double)) ORDER BY doc_seq, stop_type DESC) AS int) AS sequence,
       stop_type, concat('City of ', state) AS city, state, scheduled_date
FROM (SELECT load_id, doc_seq, 'pickup' AS stop_type, origin_state AS state, pickup_date AS scheduled_date FROM freight_documents
      UNION ALL
      SELECT load_id, doc_seq, 'delivery', destination_state, delivery_date FROM freight_documents) s
"""

SQL["accessorials"] = """
SELECT load_id, doc_seq, 'detention_pickup' AS type, cast(pieces * 10 AS double) AS amount FROM freight_documents WHERE pieces % 7 = 0
UNION ALL
SELECT load_id, doc_seq, 'other', cast(NULL AS double) FROM freight_documents WHERE pieces % 14 = 0
"""

SQL["doc_references"] = """
SELECT load_id, doc_seq, 'po' AS ref_type, concat('PO', cast(pieces * 37 AS string)) AS value FROM freight_documents
UNION ALL
SELECT load_id, doc_seq, 'seal', cast(pieces % 12 AS string) FROM freight_documents
UNION ALL
SELECT load_id, doc_seq, 'customer', concat('PO', cast(pieces * 37 AS string)) FROM freight_documents WHERE pieces % 3 = 0
"""

SQL["ocr_cache_pages"] = """
SELECT load_id, page_no, page_text, page_conf FROM ocr_pages WHERE try_cast(load_id AS int) % 3 = 0
"""

# The files of the loads that have OCR pages, some empty, unreadable or one of two, and some loads
# that OCR found no page in.
SQL["run_files"] = """
SELECT concat('raw/loads/', cast(conv_id AS string), '/', cast(turn AS string), '.pdf') AS path,
       CASE WHEN conv_id % 8 = 5 THEN cast(0 AS bigint) ELSE cast(1000 + turn AS bigint) END AS length,
       conv_id % 9 <> 1 AS openable, false AS needs_pass, 1 AS page_count
FROM conversations WHERE turn = 0 OR (turn = 2 AND conv_id % 7 = 3)
UNION ALL
SELECT concat('raw/loads/', cast(90000000 + c_custkey AS string), '/1.PDF'), cast(1 AS bigint), true, false, 3 FROM customer
"""

SQL["run_done"] = """
SELECT DISTINCT cast(conv_id AS string) AS load_id FROM conversations WHERE conv_id % 5 = 2
"""

# Output objects of loads that were processed before, among others that do not count.
SQL["outputs"] = """
SELECT concat('json/v1/', cast(o_orderkey AS string), CASE WHEN o_orderkey % 4 = 0 THEN '.tmp' ELSE '.json' END) AS path
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT concat('json/v0/', cast(o_orderkey AS string), '.json') FROM orders WHERE o_orderstatus = 'O'
"""

# Triage outcome of every PDF and the failures, with an order in which they were recorded.
SQL["run_results"] = """
SELECT split_part(path, '/', 3) AS load_id,
       CASE WHEN length = 0 OR NOT openable OR needs_pass OR page_count = 0 THEN 'invalid' ELSE 'ok' END AS status,
       CASE WHEN length = 0 THEN 'empty file (0 bytes)' WHEN NOT openable THEN 'cannot open as PDF'
            WHEN needs_pass THEN 'password-protected PDF' WHEN page_count = 0 THEN 'PDF has 0 pages' END AS detail,
       path AS recorded
FROM manifest WHERE lower(path) LIKE '%.pdf'
UNION ALL
SELECT load_id, CASE WHEN error_class <> 'ValueError' THEN 'failed' END, error_class, load_id FROM failure_log
"""

# Children of packet_documents: a document covers two turns, each with at most one stop and charge.
SQL["packet_stops"] = """
SELECT cast(conv_id AS string) AS load_id, cast(floor(turn / 2) + 1 AS int) AS doc_seq,
       cast(turn % 2 + 1 AS int) AS sequence, CASE WHEN turn % 2 = 0 THEN 'pickup' ELSE 'delivery' END AS stop_type
FROM conversations WHERE (conv_id + turn) % 3 <> 0
"""

SQL["packet_accessorials"] = """
SELECT cast(conv_id AS string) AS load_id, cast(floor(turn / 2) + 1 AS int) AS doc_seq, 'lumper' AS type,
       cast(conv_id + turn AS double) AS amount
FROM conversations WHERE conv_id % 5 < 2
"""

# freight_documents with the remaining silver columns.
SQL["silver_documents"] = """
SELECT f.*, concat('raw/loads/', load_id, '/1.pdf') AS source_pdf,
       CASE WHEN pieces % 17 <> 0 THEN concat(cast(doc_seq * 2 - 1 AS string), '-', cast(doc_seq * 2 AS string)) END AS page_range,
       concat(lpad(cast(pieces % 30 AS string), 2, '0'), ':15') AS pickup_appt_start,
       CASE WHEN doc_type_raw IN ('Rate Confirmation', 'Load Sheet') AND pieces % 4 = 0 THEN concat('RC', cast(pieces AS string)) END AS rc_number,
       CASE WHEN doc_type_raw = 'bill_of_lading' AND pieces % 10 <> 0 THEN concat('B', load_id) END AS bol_number,
       CASE WHEN pieces % 5 = 0 THEN concat('USDOT ', cast(pieces * 1000 AS string)) WHEN pieces % 5 = 1 THEN 'none' END AS carrier_dot,
       CASE WHEN pieces % 3 = 0 THEN 'abcd ' END AS carrier_scac,
       broker_name AS shipper_name, carrier_name AS consignee_name,
       CASE WHEN pieces % 8 = 0 THEN '70' END AS freight_class,
       pieces % 9 <> 0 AS delivered, CASE WHEN pieces % 9 <> 0 THEN broker_name END AS received_by,
       is_signed_delivery_copy AS signature_present,
       CASE WHEN is_signed_delivery_copy AND pieces % 2 = 0 THEN pickup_date END AS delivery_signed_date,
       CASE WHEN pieces % 11 = 0 THEN 'damage' END AS osd_code, pieces % 13 = 0 AS illegible,
       CASE WHEN pieces % 6 = 0 THEN 'rate_total,weight' ELSE '' END AS unverified_fields,
       cast(pieces % 97 AS double) / cast(97 AS double) + cast(0.5 AS double) AS ocr_confidence
FROM freight_documents f
"""


# How Spark joins what a statement joins in the order of its words: documents meet the small tables and
# their parts first and their orders last, so that the numbering finds them dealt out by order already.
# Suppliers meet the documents as they are: joined to nations before, they would be estimated by the product
# of both tables and the documents dealt out by supplier for them.
JOINS: dict[str, str] = {}

JOINS["freight_documents"] = """
FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
JOIN (SELECT o_orderkey, o_orderdate, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey) cn ON l_orderkey = o_orderkey
"""


JOINS["book_pages"] = "\nFROM numbered_documents t"


def _numbered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inner rows of book_pages: texts are dealt into sorted ranges and stored once, not sorted per source."""
    rows = base(spark, sf_dir, "documents").select(
        F.coalesce("source", F.lit("none")).alias("load_id"), "doc_id", F.col("text").alias("page_text"),
        F.expr("(doc_id % 98) / cast(97 AS double)").alias("page_conf"))
    placed = with_position(rows, F.col("load_id"), F.col("doc_id"), name="at")
    first = stored(placed.groupBy("load_id").agg(F.min("at").alias("first")), "first")
    return join_summary(placed, first, ["load_id"]).select("load_id", (F.col("at") - F.col("first") + 1).cast("int").alias("n"), "page_text", "page_conf")


# Rows that Spark numbers itself for the statements of JOINS.
BUILT = {"numbered_documents": _numbered_documents}


def spark_sql(name: str) -> str:
    """The statement as Spark runs it: the same rows, joined in another order if one is given."""
    if name not in JOINS:
        return SQL[name]
    head, _, _ = SQL[name].partition("\nFROM ")
    return head + JOINS[name]


def _needs(name: str) -> list[str]:
    """The derived tables a statement reads, dependencies first."""
    found: list[str] = []
    for word in re.findall(r"\w+", SQL[name]):
        if word in SQL and word != name and word not in found:
            found += [w for w in _needs(word) if w not in found] + [word]
    return list(dict.fromkeys(found))


# Folders of derived tables that were written once, by source folder and name.
_stored: dict[tuple[str, str], str] = {}


# Prefix of the temporary views, so that none hides a view of the caller's.
VIEW = "packetmill_"


def over_views(statement: str, names: set[str] | list[str]) -> str:
    """The statement reading the prefixed views of the named tables."""
    known = [n for n in names if n in SQL or n in BASE_TABLES or n in BUILT]
    return re.sub(rf"(?<=FROM )({'|'.join(known)})\b|(?<=JOIN )({'|'.join(known)})\b", lambda m: VIEW + m[0], statement)


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """A derived table as a DataFrame over the given folder, or over tables that are ``given``."""
    if name in (given or {}):
        return given[name]
    if name not in SQL:
        return base(spark, sf_dir, name)
    if (sf_dir, name) in _stored:
        return spark.read.parquet(_stored[(sf_dir, name)])
    words = set(re.findall(r"\w+", spark_sql(name)))
    for t in words:
        if t in BUILT:
            BUILT[t](spark, sf_dir).createOrReplaceTempView(VIEW + t)
        elif t in SQL and t != name:
            table(spark, sf_dir, t, given).createOrReplaceTempView(VIEW + t)
        elif t in BASE_TABLES:
            table(spark, sf_dir, t, given).createOrReplaceTempView(VIEW + t)
    return spark.sql(over_views(spark_sql(name), words))


Made = Callable[[dict[str, DataFrame]], DataFrame]


def _freight_share(spark: SparkSession, sf_dir: str, n: int, i: int) -> DataFrame:
    """The freight documents of one share of the loads; their tables are cut before they are joined."""

    def own(name: str, key: str) -> DataFrame:
        rows = table(spark, sf_dir, name)
        return rows.filter(F.xxhash64(F.col(key).cast("string")).bitwiseAND(F.lit(n - 1)) == i) if n > 1 else rows

    if (sf_dir, "freight_documents") in _stored:
        return own("freight_documents", "load_id")
    given = {"lineitem": own("lineitem", "l_orderkey"), "orders": own("orders", "o_orderkey")}
    return table(spark, sf_dir, "freight_documents", given)


def write_by_loads(spark: SparkSession, sf_dir: str, out: str, make: Made) -> DataFrame:
    """What ``make`` makes of the freight documents, written to ``out`` share by share of the loads, and read there.

    Only for rows that each come from one load. Loads fall into shares by hash; what a share needs on the way is
    deleted when it is written, so that disk holds the result and one share's work.
    """
    n = shares(spark, sf_dir, "lineitem", "orders")
    partitions = int(spark.conf.get(INITIAL_PARTITIONS, None) or 0)
    for i in range(n):
        least = max(-(-partitions // n), int(spark.conf.get("spark.sql.shuffle.partitions")))
        with discarding(spark), freeing(spark), changed(spark, INITIAL_PARTITIONS, str(least)):
            rows = make({"freight_documents": _freight_share(spark, sf_dir, n, i)})
            rows.write.mode("append").parquet(out, compression="zstd")
            schema = rows.schema
    return spark.read.schema(schema).parquet(out)


def by_loads(spark: SparkSession, sf_dir: str, name: str, make: Made) -> DataFrame:
    """``write_by_loads`` to a scratch folder; a single share is not stored."""
    if shares(spark, sf_dir, "lineitem", "orders") == 1:
        return make({})
    return write_by_loads(spark, sf_dir, scratch_dir(spark, name), make)


def with_tables(query: str, *names: str) -> str:
    """Prefix a DuckDB query with the derived tables it reads."""
    order: list[str] = []
    for name in names:
        order += [n for n in [*_needs(name), name] if n not in order]
    ctes = ",\n".join(f"{n} AS ({SQL[n].strip()})" for n in order)
    query = query.strip()
    if query.upper().startswith("WITH "):
        return f"WITH {ctes},\n{query[5:]}"
    return f"WITH {ctes}\n{query}"


def store(spark: SparkSession, sf_dir: str, out: str, names: list[str] | None = None, files: int = 8) -> None:
    """Write derived tables once; ``table`` then reads them instead of deriving them again.

    The source tables are one file each; the written ones have several, as large tables do.
    """
    for name in names or list(SQL):
        path = f"{out}/{name}"
        table(spark, sf_dir, name).repartition(files).write.mode("overwrite").parquet(path)
        _stored[(sf_dir, name)] = path
