"""Gold rules and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetmill.operators import gold
from packetmill.plans.fixtures import by_loads, table, with_tables
from packetmill.plans.registry import ORACLES, query
from packetmill.session import scratch_dir, stored
from packetmill.sources import published, writers

_TYPED = r"""typed AS (
  SELECT * REPLACE (coalesce(pallet_count, try_cast(regexp_extract(commodity, '^([0-9]+) PLTS ', 1) AS INTEGER)) AS pallet_count),
    CASE doc_type_raw WHEN 'Rate Confirmation' THEN 'rate_confirmation' WHEN 'Load Sheet' THEN 'rate_confirmation'
      WHEN 'weird' THEN 'other' ELSE doc_type_raw END AS doc_type,
    coalesce('DOT:' || nullif(array_to_string(regexp_extract_all(carrier_dot, '[0-9]'), ''), ''),
             'MC:' || nullif(array_to_string(regexp_extract_all(carrier_mc, '[0-9]'), ''), ''),
             'SCAC:' || nullif(upper(trim(carrier_scac)), ''),
             'NAME:' || regexp_extract(array_to_string(regexp_extract_all(upper(carrier_name), '[A-Z0-9 ]'), ''), '^ *(.*?)( LLC)? *$', 1)) AS carrier_key
  FROM silver_documents
)"""
_CHECKS = """checks AS (
  SELECT *, CASE WHEN pallet_count IS NOT NULL THEN list_min([list_max([pallet_count, 1]), 60]) END AS pallet_count_clamped, coalesce(pallet_count < 1 OR pallet_count > 60, false) AS pallet_count_impossible,
    try_strptime(pickup_date, '%Y-%m-%d') IS NULL AS pickup_date_bad, try_strptime(delivery_date, '%Y-%m-%d') IS NULL AS delivery_date_bad,
    coalesce(try_strptime(delivery_date, '%Y-%m-%d') < try_strptime(pickup_date, '%Y-%m-%d'), true) AS date_impossible,
    CASE WHEN round(line_haul * 100) <> round(rate_total * 100) THEN line_haul END AS line_haul_clean
  FROM typed
)"""
_SUMS = "sums AS (SELECT load_id, doc_seq, sum(cast(round(amount * 100) AS BIGINT)) AS acc FROM accessorials GROUP BY load_id, doc_seq)"
_RATED = """rated AS (
  SELECT c.*, cast(coalesce(acc, 0) AS BIGINT) AS accessorial_cents, line_haul_clean IS NULL AND fuel_surcharge IS NULL AS rate_is_all_in,
    line_haul_clean IS NOT NULL AND abs(cast(round(rate_total * 100) AS BIGINT) - cast(round(line_haul_clean * 100) AS BIGINT)
      - coalesce(cast(round(fuel_surcharge * 100) AS BIGINT), 0) - coalesce(acc, 0)) > 1 AS rate_breakdown_conflict,
    CASE WHEN weight_unit = 'kg' THEN weight * cast(2.20462262 AS double) ELSE weight END AS weight_lb, weight_unit IS NULL AS weight_unit_assumed,
    CASE WHEN miles <> 0 THEN rate_total / miles END AS rate_per_mile, pieces - pieces_received AS osd_gap,
    coalesce(osd_code, CASE sign(pieces - pieces_received) WHEN 1 THEN 'shortage' WHEN -1 THEN 'overage' ELSE 'clear' END) AS osd_outcome
  FROM checks c LEFT JOIN sums USING (load_id, doc_seq)
)"""
_REVIEWED = """reviewed AS (
  SELECT *, array_to_string(list_filter([CASE WHEN illegible THEN 'illegible' END, CASE WHEN unverified_fields <> '' THEN 'unverified' END,
      CASE WHEN ocr_confidence < 0.8 THEN 'low_confidence' END, CASE WHEN pallet_count_impossible THEN 'pallets' END,
      CASE WHEN date_impossible THEN 'dates' END, CASE WHEN rate_breakdown_conflict THEN 'rate_conflict' END], lambda r: r IS NOT NULL), ',') AS review_reasons
  FROM rated
)"""
_NUMBERS = """ballots AS (
  SELECT load_id, CASE WHEN doc_type = 'rate_confirmation' THEN 1 ELSE 3 END AS pri, load_number AS v FROM typed WHERE load_number IS NOT NULL
  UNION ALL SELECT load_id, 2, rc_number FROM typed WHERE doc_type = 'rate_confirmation' AND rc_number IS NOT NULL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY load_id ORDER BY pri, votes DESC, v) AS rn
  FROM (SELECT load_id, pri, v, count(*) AS votes FROM ballots GROUP BY ALL)
), numbers AS (
  SELECT l.load_id, r.v AS packet_load_number, CASE r.pri WHEN 1 THEN 'rc_load_number' WHEN 2 THEN 'rc_number' WHEN 3 THEN 'majority' END AS source_rule,
    l.n AS n_load_numbers
  FROM (SELECT load_id, count(DISTINCT load_number) AS n FROM typed GROUP BY load_id) l
  LEFT JOIN ranked r ON r.load_id = l.load_id AND r.rn = 1
)"""
_ALL = f"""{_TYPED}, {_CHECKS}, {_SUMS}, {_RATED}, {_REVIEWED}, {_NUMBERS},
classified AS (SELECT r.*, review_reasons <> '' AS needs_review, n.packet_load_number, n.n_load_numbers FROM reviewed r JOIN numbers n USING (load_id)),
pods AS (
  SELECT * REPLACE (coalesce(delivery_signed_date, delivery_date) AS delivery_date),
    CASE WHEN doc_type = 'proof_of_delivery' THEN doc_type ELSE 'signed_copy' END AS pod_source
  FROM classified WHERE doc_type = 'proof_of_delivery' OR is_signed_delivery_copy
)"""


def _oracle(select: str) -> str:
    return with_tables(f"WITH {_ALL}\n{select}", "silver_documents", "accessorials")


def _silver(spark: SparkSession, sf_dir: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    return table(spark, sf_dir, "silver_documents", given)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.with_classification(_silver(spark, sf_dir))


# Columns of the silver documents that the rules read.
RULED = [
    "load_id", "doc_seq", "doc_type_raw", "load_number", "rc_number", "carrier_dot", "carrier_mc", "carrier_scac", "carrier_name",
    "pallet_count", "commodity", "pickup_date", "delivery_date", "rate_total", "line_haul", "fuel_surcharge", "weight", "weight_unit",
    "miles", "pieces", "pieces_received", "osd_code", "illegible", "unverified_fields", "ocr_confidence",
]


def _classified(spark: SparkSession, sf_dir: str, *more: str, of: Column | None = None,
                given: dict[str, DataFrame] | None = None) -> DataFrame:
    """Classified documents with ``more`` columns of theirs. Load numbers, charges and the documents all come
    from the silver documents, which are derived once and stored."""
    silver = stored(_silver(spark, sf_dir, given).select(*RULED, *more), "silver", compression="zstd")
    # A silver document has the keys and pieces of its freight document.
    return gold.documents_classified(silver, table(spark, sf_dir, "accessorials", {"freight_documents": silver}), of=of)


_SOURCE = ["source_pdf", "page_range"]


def _rate_confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = [*_SOURCE, "broker_name", "origin_state", "destination_state"]
    return by_loads(spark, sf_dir, "rate-confirmations", lambda given: gold.rate_confirmations(
        _classified(spark, sf_dir, *more, of=F.col("doc_type") == "rate_confirmation", given=given)))


@query(_oracle("SELECT load_id, doc_seq, doc_type FROM typed"))
def i1_classify_doc_type(spark, sf_dir):
    docs = _silver(spark, sf_dir)
    return docs.select("load_id", "doc_seq", gold.doc_type_of(F.col("doc_type_raw")).alias("doc_type"))


@query(_oracle("SELECT load_id, doc_seq, carrier_key FROM typed"))
def i2_carrier_key(spark, sf_dir):
    key = gold.carrier_key(*(F.col(c) for c in ["carrier_dot", "carrier_mc", "carrier_scac", "carrier_name"]))
    return _silver(spark, sf_dir).select("load_id", "doc_seq", key.alias("carrier_key"))


@query(_oracle("SELECT load_id, doc_seq, pallet_count, pallet_count_clamped, pallet_count_impossible FROM checks"))
def i3_pallet_check(spark, sf_dir):
    rows = gold.with_pallet_check(gold.with_parsed_fields(_silver(spark, sf_dir)))
    return rows.select("load_id", "doc_seq", "pallet_count", "pallet_count_clamped", "pallet_count_impossible")


@query(_oracle("SELECT load_id, doc_seq, pickup_date_bad, delivery_date_bad, date_impossible FROM checks"))
def i4_date_check(spark, sf_dir):
    rows = gold.with_date_check(_silver(spark, sf_dir))
    return rows.select("load_id", "doc_seq", "pickup_date_bad", "delivery_date_bad", "date_impossible")


@query(_oracle("SELECT load_id, doc_seq, line_haul_clean, rate_is_all_in FROM rated"))
def i5_rate_clean(spark, sf_dir):
    rows = gold.with_rate_clean(_silver(spark, sf_dir))
    return rows.select("load_id", "doc_seq", "line_haul_clean", "rate_is_all_in")


@query(_oracle("SELECT load_id, doc_seq, accessorial_cents, rate_breakdown_conflict FROM rated"))
def i6_rate_breakdown_conflict(spark, sf_dir):
    rows = gold.with_breakdown_conflict(gold.with_rate_clean(_silver(spark, sf_dir)), table(spark, sf_dir, "accessorials"))
    return rows.select("load_id", "doc_seq", "accessorial_cents", "rate_breakdown_conflict")


@query(_oracle("SELECT load_id, doc_seq, weight_lb, weight_unit_assumed FROM rated"))
def i7_weight_lb(spark, sf_dir):
    return gold.with_weight_lb(_silver(spark, sf_dir)).select("load_id", "doc_seq", "weight_lb", "weight_unit_assumed")


@query(_oracle("SELECT load_id, doc_seq, rate_per_mile FROM rated"))
def i8_rate_per_mile(spark, sf_dir):
    return gold.with_rate_per_mile(_silver(spark, sf_dir)).select("load_id", "doc_seq", "rate_per_mile")


@query(_oracle("SELECT load_id, doc_seq, osd_gap, osd_outcome FROM rated"))
def i9_osd_gap(spark, sf_dir):
    return gold.with_osd_gap(_silver(spark, sf_dir)).select("load_id", "doc_seq", "osd_gap", "osd_outcome")


@query(_oracle("SELECT load_id, doc_seq, review_reasons, needs_review FROM classified"))
def i10_needs_review(spark, sf_dir):
    checked = gold.with_rate_clean(gold.with_date_check(gold.with_pallet_check(gold.with_parsed_fields(_silver(spark, sf_dir)))))
    rows = gold.with_review(gold.with_breakdown_conflict(checked, table(spark, sf_dir, "accessorials")))
    return rows.select("load_id", "doc_seq", "review_reasons", "needs_review")


@query(_oracle("SELECT load_id, packet_load_number, source_rule FROM numbers"))
def f1_load_reference(spark, sf_dir):
    return gold.load_reference(_typed(spark, sf_dir)).drop("n_load_numbers")


@query(_oracle("SELECT load_id, packet_load_number, n_load_numbers, n_load_numbers > 1 AS has_conflict FROM numbers"))
def i11_load_reference(spark, sf_dir):
    rows = gold.load_reference(_typed(spark, sf_dir)).drop("source_rule")
    return rows.withColumn("has_conflict", F.col("n_load_numbers") > 1)


@query(_oracle("""SELECT load_id, doc_seq, bol_number, count(*) OVER w AS copies,
  row_number() OVER (PARTITION BY load_id, bol_number ORDER BY is_signed_delivery_copy DESC, doc_seq) = 1 AS is_preferred
FROM typed WHERE doc_type = 'bill_of_lading' AND bol_number IS NOT NULL WINDOW w AS (PARTITION BY load_id, bol_number)"""))
def f2_bol_copies(spark, sf_dir):
    return gold.bol_copies(_typed(spark, sf_dir)).select("load_id", "doc_seq", "bol_number", "copies", "is_preferred")


CLASSIFIED = [
    "load_id", "doc_seq", "doc_type", "packet_load_number", "n_load_numbers", "carrier_key", "pallet_count_clamped",
    "pallet_count_impossible", "date_impossible", "line_haul_clean", "rate_is_all_in", "rate_breakdown_conflict",
    "weight_lb", "rate_per_mile", "osd_outcome", "review_reasons", "needs_review",
]


@query(_oracle(f"SELECT {', '.join(CLASSIFIED)} FROM classified"))
def i12_documents_classified(spark, sf_dir):
    return _classified(spark, sf_dir).select(*CLASSIFIED)


_LEAD = "load_id, doc_seq, packet_load_number, load_number, source_pdf, page_range"


@query(_oracle(f"SELECT {_LEAD}, {', '.join(gold.RATE_CONFIRMATION)} FROM classified WHERE doc_type = 'rate_confirmation'"))
def i13_rate_confirmations(spark, sf_dir):
    return _rate_confirmations(spark, sf_dir)


@query(_oracle(f"SELECT {_LEAD}, {', '.join(gold.BILL_OF_LADING)} FROM classified WHERE doc_type = 'bill_of_lading'"))
def i14_bills_of_lading(spark, sf_dir):
    more = [*_SOURCE, "bol_number", "shipper_name", "consignee_name", "freight_class", "is_signed_delivery_copy"]
    return gold.bills_of_lading(_classified(spark, sf_dir, *more, of=F.col("doc_type") == "bill_of_lading"))


@query(_oracle(f"SELECT {_LEAD}, {', '.join(gold.PROOF_OF_DELIVERY)}, delivery_date, pod_source FROM pods"))
def i15_proofs_of_delivery(spark, sf_dir):
    more = [*_SOURCE, "delivered", "received_by", "signature_present", "is_signed_delivery_copy", "delivery_signed_date"]
    return gold.proofs_of_delivery(_classified(spark, sf_dir, *more, of=gold.is_pod()))


@query(_oracle(f"""SELECT {_LEAD}, {', '.join(gold.OTHER)} FROM classified
WHERE doc_type NOT IN ('rate_confirmation', 'bill_of_lading', 'proof_of_delivery')"""))
def i16_other_documents(spark, sf_dir):
    return gold.other_documents(_classified(spark, sf_dir, *_SOURCE))


@query(_oracle("""SELECT count(*) AS loads, cast(sum(a) AS BIGINT) AS loads_by_type, cast(sum(b) AS BIGINT) AS loads_by_role,
  round(sum(a) / cast(count(*) AS double), 6) AS share_before, round(sum(b) / cast(count(*) AS double), 6) AS share_after
FROM (SELECT load_id, max(cast(doc_type = 'proof_of_delivery' AS INTEGER)) AS a,
        max(cast(doc_type = 'proof_of_delivery' OR is_signed_delivery_copy AS INTEGER)) AS b FROM typed GROUP BY load_id)"""))
def i17_pod_coverage(spark, sf_dir):
    return gold.pod_coverage(_typed(spark, sf_dir))


@query(_oracle("""SELECT load_id, max(packet_load_number) AS packet_load_number, count(*) FILTER (WHERE k = 1) AS n_rc, count(*) FILTER (WHERE k = 2) AS n_bol,
  count(*) FILTER (WHERE k = 3) AS n_pod, max(cents) AS rate_cents, cast(sum(pieces) AS BIGINT) AS bol_pieces, max(day) AS last_delivery_date
FROM (
  SELECT load_id, packet_load_number, 1 AS k, cast(round(rate_total * 100) AS BIGINT) AS cents, NULL AS pieces, NULL AS day FROM classified WHERE doc_type = 'rate_confirmation'
  UNION ALL SELECT load_id, packet_load_number, 2, NULL, CASE WHEN bol_number IS NULL OR row_number() OVER (
      PARTITION BY load_id, bol_number ORDER BY is_signed_delivery_copy DESC, doc_seq) = 1 THEN pieces END, NULL
    FROM classified WHERE doc_type = 'bill_of_lading'
  UNION ALL SELECT load_id, packet_load_number, 3, NULL, NULL, delivery_date FROM pods
) GROUP BY load_id"""))
def d5_load_overview(spark, sf_dir):
    more = ["bol_number", "is_signed_delivery_copy", "delivery_signed_date"]
    return by_loads(spark, sf_dir, "overview", lambda given: gold.load_overview(_classified(spark, sf_dir, *more, given=given)))


@query(_oracle(f"SELECT {_LEAD}, {', '.join(gold.RATE_CONFIRMATION)} FROM classified WHERE doc_type = 'rate_confirmation'"))
def b7_publish_ml(spark, sf_dir):
    """Published, replaced by a version of half the rows, and pointed back to the first."""
    out, rows = scratch_dir(spark, "b7-published"), _rate_confirmations(spark, sf_dir)
    whole = published.publish(rows, out)
    published.publish(published.read_published(spark, out).filter("load_id % 2 = 0"), out)
    published.point_to(spark, out, whole)
    return published.read_published(spark, out)


@query(ORACLES["b7_publish_ml"])
def b7_export_ml(spark, sf_dir):
    """Exported to Parquet, that to CSV, and the CSV read back."""
    out = scratch_dir(spark, "b7")
    writers.export_ml(_rate_confirmations(spark, sf_dir), f"{out}/parquet")
    rows = spark.read.parquet(f"{out}/parquet")
    writers.export_ml(rows, f"{out}/csv", "csv")
    return spark.read.option("header", "true").option("escape", '"').schema(rows.schema).csv(f"{out}/csv")
