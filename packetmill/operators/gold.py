"""Gold: classified documents, one load number per load, one table per document type.

``docs`` is the silver table. The rules here are this package's own reading of what the gold
tables promise; every threshold is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetmill import schemas
from packetmill.functions import parsing
from packetmill.operators.conformance import is_date
from packetmill.operators.joins import join_summary
from packetmill.operators.verify import REVIEW_CONFIDENCE

# Titles that mean a rate confirmation or a packing list, after normalising.
TYPE_SYNONYMS = {
    "load_confirmation": "rate_confirmation",
    "carrier_confirmation": "rate_confirmation",
    "load_sheet": "rate_confirmation",
    "packing_slip": "packing_list",
}
# Valid pallet counts, pounds per kilogram, legal forms left out of carrier names.
MIN_PALLETS, MAX_PALLETS = 1, 60
LB_PER_KG = 2.20462262
LEGAL_FORMS = ["LLC", "INC", "CORP", "CO", "LTD"]


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def cents(amount: Column) -> Column:
    """Whole cents, so that sums and comparisons of money are exact."""
    return F.round(amount * 100).cast("bigint")


def doc_type_of(raw: Column) -> Column:
    name = F.regexp_replace(F.regexp_replace(F.lower(raw), "[^a-z0-9]+", "_"), "^_|_$", "")
    chosen = F.when(name.isin(schemas.DOC_TYPES), name)
    for title, kind in TYPE_SYNONYMS.items():
        chosen = chosen.when(name == title, kind)
    return chosen.otherwise("other")


def carrier_key(dot: Column, mc: Column, scac: Column, name: Column) -> Column:
    """The best identity a document gives of its carrier: DOT, MC, SCAC or cleaned name."""
    def digits(prefix: str, value: Column) -> Column:
        return F.when(value.rlike("[0-9]"), F.concat(F.lit(prefix), F.regexp_replace(value, "[^0-9]", "")))

    words = F.trim(F.regexp_replace(F.regexp_replace(F.upper(name), "[^A-Z0-9 ]", ""), " +", " "))
    words = F.regexp_replace(words, f"( ({'|'.join(LEGAL_FORMS)}))+$", "")
    return F.coalesce(
        digits("DOT:", dot),
        digits("MC:", mc),
        F.when(F.trim(scac) != "", F.concat(F.lit("SCAC:"), F.upper(F.trim(scac)))),
        F.when(name.rlike("[A-Za-z0-9]"), F.concat(F.lit("NAME:"), words)),
    )


def with_pallet_check(docs: DataFrame, low: int = MIN_PALLETS, high: int = MAX_PALLETS) -> DataFrame:
    count = F.col("pallet_count")
    return docs.withColumns({
        "pallet_count_clamped": F.when(count.isNotNull(), F.least(F.greatest(count, F.lit(low)), F.lit(high))),
        "pallet_count_impossible": F.coalesce(~count.between(low, high), F.lit(False)),
    })


def with_date_check(docs: DataFrame, min_year: int | None = None, max_year: int | None = None) -> DataFrame:
    """Flag texts that are no calendar day and deliveries before their pickup."""
    def bad(c: Column) -> Column:
        wrong = ~is_date(c)
        if min_year is not None:
            wrong = wrong | (F.left(c, F.lit(4)).try_cast("int") < min_year)
        if max_year is not None:
            wrong = wrong | (F.left(c, F.lit(4)).try_cast("int") > max_year)
        return F.coalesce(wrong, F.lit(False))

    pickup, delivery = F.col("pickup_date"), F.col("delivery_date")
    early = F.try_to_date(delivery, "yyyy-MM-dd") < F.try_to_date(pickup, "yyyy-MM-dd")
    return docs.withColumns({
        "pickup_date_bad": bad(pickup), "delivery_date_bad": bad(delivery),
    }).withColumn(
        "date_impossible",
        F.col("pickup_date_bad") | F.col("delivery_date_bad") | F.coalesce(early, F.lit(False)),
    )


def with_rate_clean(docs: DataFrame) -> DataFrame:
    """A line haul that repeats the total is none; ``rate_is_all_in`` follows from what is left."""
    copied = cents(F.col("line_haul")) == cents(F.col("rate_total"))
    clean = F.when(F.coalesce(copied, F.lit(False)), None).otherwise(F.col("line_haul"))
    return docs.withColumn("line_haul_clean", clean).withColumn(
        "rate_is_all_in",
        F.when(F.col("rate_total").isNotNull(), F.col("line_haul_clean").isNull() & F.col("fuel_surcharge").isNull()),
    )


def accessorial_totals(accessorials: DataFrame) -> DataFrame:
    return accessorials.groupBy("load_id", "doc_seq").agg(
        F.coalesce(F.sum(cents(F.col("amount"))), F.lit(0)).alias("accessorial_cents")
    )


def with_breakdown_conflict(docs: DataFrame, accessorials: DataFrame | None, tolerance_cents: int = 1) -> DataFrame:
    """The printed parts do not add up to the total. Without accessorials only haul and fuel count."""
    if accessorials is None:
        rows = docs.withColumn("accessorial_cents", F.lit(0).cast("bigint"))
    else:
        rows = docs.join(accessorial_totals(accessorials), ["load_id", "doc_seq"], "left").na.fill(0, ["accessorial_cents"])
    return rows.withColumn("rate_breakdown_conflict", _conflict(tolerance_cents))


def _conflict(tolerance_cents: int = 1) -> Column:
    total, haul = cents(F.col("rate_total")), cents(F.col("line_haul_clean"))
    fuel = F.coalesce(cents(F.col("fuel_surcharge")), F.lit(0))
    gap = F.abs(total - (haul + fuel + F.col("accessorial_cents")))
    return F.coalesce(gap > tolerance_cents, F.lit(False))


def with_weight_lb(docs: DataFrame) -> DataFrame:
    weight, unit = F.col("weight"), F.col("weight_unit")
    return docs.withColumns({
        "weight_lb": F.when(unit == "kg", weight * LB_PER_KG).otherwise(weight),
        "weight_unit_assumed": weight.isNotNull() & unit.isNull(),
    })


def with_rate_per_mile(docs: DataFrame) -> DataFrame:
    return docs.withColumn("rate_per_mile", F.try_divide("rate_total", "miles"))


def with_osd_gap(docs: DataFrame) -> DataFrame:
    """Shipped less received pieces, and the outcome that follows where none was recorded."""
    gap = F.col("pieces") - F.col("pieces_received")
    derived = F.when(gap > 0, "shortage").when(gap < 0, "overage").when(gap == 0, "clear")
    return docs.withColumns({
        "osd_gap": gap, "osd_outcome": F.coalesce(_column(docs, "osd_code"), derived),
    })


def with_review(docs: DataFrame, threshold: float = REVIEW_CONFIDENCE) -> DataFrame:
    """``needs_review`` and the comma-joined reasons."""
    reasons = F.concat_ws(
        ",",
        F.when(_column(docs, "illegible", "boolean"), "illegible"),
        F.when(_column(docs, "unverified_fields") != "", "unverified"),
        F.when(_column(docs, "ocr_confidence", "double") < threshold, "low_confidence"),
        F.when(F.col("pallet_count_impossible"), "pallets"),
        F.when(F.col("date_impossible"), "dates"),
        F.when(F.col("rate_breakdown_conflict"), "rate_conflict"),
    )
    return docs.withColumn("review_reasons", reasons).withColumn("needs_review", F.col("review_reasons") != "")


def with_classification(docs: DataFrame) -> DataFrame:
    raw = "doc_type_raw" if "doc_type_raw" in docs.columns else "doc_type"
    return docs.withColumn("doc_type", doc_type_of(F.col(raw))).withColumn(
        "carrier_key",
        carrier_key(*(_column(docs, c) for c in ["carrier_dot", "carrier_mc", "carrier_scac", "carrier_name"])),
    )


def load_reference(docs: DataFrame) -> DataFrame:
    """``load_id, packet_load_number, source_rule, n_load_numbers`` for every load.

    The number is the rate confirmation's load number, else its own number, else the load number
    most other documents print; equal votes go to the smallest text. Votes are counted per value
    first, so a load with very many documents arrives as its few distinct numbers.
    """
    rc = F.col("doc_type") == "rate_confirmation"
    load_number = F.nullif(F.trim("load_number"), F.lit(""))
    rc_number = F.nullif(F.trim(_column(docs, "rc_number")), F.lit(""))
    candidates = F.array(
        F.struct(F.when(rc, 1).otherwise(3).alias("priority"), load_number.alias("number")),
        F.struct(F.lit(2).alias("priority"), F.when(rc, rc_number).alias("number")),
    )
    rows = docs.select("load_id", F.explode(candidates).alias("c")).select("load_id", "c.*")
    # The row of priority 2 is kept without a number too, so that no load is lost.
    votes = rows.groupBy("load_id", "number").agg(*[
        F.count_if(F.col("priority") == p).alias(f"votes_{p}") for p in (1, 2, 3)
    ])
    def ballot(p: int) -> Column:
        return F.when(
            F.col("number").isNotNull() & (F.col(f"votes_{p}") > 0),
            F.struct(F.lit(p).alias("priority"), (-F.col(f"votes_{p}")).alias("votes"), F.col("number")),
        )

    best = F.min(F.coalesce(ballot(1), ballot(2), ballot(3)))
    printed = F.col("number").isNotNull() & (F.col("votes_1") + F.col("votes_3") > 0)
    chosen = votes.groupBy("load_id").agg(best.alias("best"), F.count_if(printed).alias("n_load_numbers"))
    rule = F.when(F.col("best.priority") == 1, "rc_load_number").when(
        F.col("best.priority") == 2, "rc_number"
    ).when(F.col("best.priority") == 3, "majority")
    return chosen.select(
        "load_id", F.col("best.number").alias("packet_load_number"), rule.alias("source_rule"), "n_load_numbers"
    )


def bol_copies(docs: DataFrame) -> DataFrame:
    """Bills of lading with their copies counted; the signed, then earliest, copy is preferred."""
    bols = docs.filter((F.col("doc_type") == "bill_of_lading") & F.col("bol_number").isNotNull()).withColumn(
        "signed", F.coalesce(F.col("is_signed_delivery_copy"), F.lit(False))
    )
    best = F.max(F.struct("signed", (-F.col("doc_seq")).alias("k")))
    groups = bols.groupBy("load_id", "bol_number").agg(F.count("*").alias("copies"), (-best["k"]).alias("best_seq"))
    return join_summary(bols, groups, ["load_id", "bol_number"], "inner").withColumn(
        "is_preferred", F.col("doc_seq") == F.col("best_seq")
    ).drop("best_seq")


def with_parsed_fields(docs: DataFrame) -> DataFrame:
    """Fill what the printed text still tells: pallets from the commodity, class, length and
    temperature from the verbatim equipment text. A value that is given stays."""
    raw, commodity = _column(docs, "equipment_type_raw"), _column(docs, "commodity")
    parsed = {
        "pallet_count": (parsing.parse_pallet_text(commodity), "int"),
        "equipment_class": (parsing.equipment_class(raw), "string"),
        "equipment_length_ft": (parsing.equipment_length_ft(raw), "int"),
        "temperature_setpoint_f": (parsing.temperature_setpoint_f(raw), "double"),
        "temperature_mode": (parsing.temperature_mode(raw), "string"),
    }
    return docs.withColumns({c: F.coalesce(_column(docs, c, kind), value) for c, (value, kind) in parsed.items()})


def _facts(docs: DataFrame, numbers: DataFrame, accessorials: DataFrame | None) -> DataFrame:
    """What other rows tell of a document: its load's number and its own charges; one narrow row per key."""
    keys = docs.select("load_id", "doc_seq", F.lit(None).cast("bigint").alias("_cents"))
    if accessorials is not None:
        charges = accessorials.filter(F.col("load_id").isNotNull() & F.col("doc_seq").isNotNull())
        keys = keys.unionByName(charges.select("load_id", "doc_seq", cents(F.col("amount")).alias("_cents")))
    charged = keys.groupBy("load_id", "doc_seq").agg(F.coalesce(F.sum("_cents"), F.lit(0)).alias("accessorial_cents"))
    return join_summary(charged, numbers, ["load_id"])


def documents_classified(docs: DataFrame, accessorials: DataFrame | None = None,
                         threshold: float = REVIEW_CONFIDENCE, of: Column | None = None) -> DataFrame:
    """Every document with its type, carrier key, checks, flags and the load's number.

    ``of`` tells which documents are wanted, by their classified columns; load numbers come from all
    of them. What needs no other row is worked out first, and whole documents travel once, to a
    narrow row of what their load and their charges tell.
    """
    typed = with_parsed_fields(with_classification(docs))
    numbers = load_reference(typed).select("load_id", "packet_load_number", "n_load_numbers")
    wanted = typed if of is None else typed.filter(of)
    own = with_rate_clean(with_date_check(with_pallet_check(wanted)))
    checked = with_osd_gap(with_rate_per_mile(with_weight_lb(own)))
    facts = _facts(wanted, numbers, accessorials).withColumnsRenamed({"load_id": "_load", "doc_seq": "_seq"})
    same = F.col("load_id").eqNullSafe(F.col("_load")) & F.col("doc_seq").eqNullSafe(F.col("_seq"))
    rows = checked.join(facts, same, "left").withColumn("rate_breakdown_conflict", _conflict())
    told = ["packet_load_number", "n_load_numbers"]
    later = [c for c in checked.columns if c not in own.columns]
    rows = rows.select(*typed.columns, *told, *[c for c in own.columns if c not in typed.columns],
                       "accessorial_cents", "rate_breakdown_conflict", *later)
    return with_review(rows, threshold)


# Leading columns of every table per type, then the columns of each type.
LEAD = ["load_id", "packet_load_number", "load_number", "source_pdf", "page_range"]
RATE_CONFIRMATION = [
    "rc_number", "rate_total", "line_haul_clean", "fuel_surcharge", "rate_is_all_in", "rate_breakdown_conflict",
    "rate_per_mile", "broker_name", "carrier_name", "carrier_key", "origin_state", "destination_state",
    "pickup_date", "delivery_date", "pallet_count_clamped", "commodity", "weight_lb", "needs_review",
]
BILL_OF_LADING = [
    "bol_number", "shipper_name", "consignee_name", "weight_lb", "pieces", "freight_class",
    "is_signed_delivery_copy", "needs_review",
]
PROOF_OF_DELIVERY = ["doc_type", "delivered", "received_by", "signature_present", "pieces_received", "osd_outcome"]
OTHER = ["doc_type", "carrier_key", "rate_total", "weight_lb", "needs_review"]


def _table(classified: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    return classified.select(*[c for c in [*LEAD[:1], "doc_seq", *LEAD[1:], *columns] if c in classified.columns], *more)


def rate_confirmations(classified: DataFrame) -> DataFrame:
    return _table(classified.filter(F.col("doc_type") == "rate_confirmation"), RATE_CONFIRMATION)


def bills_of_lading(classified: DataFrame) -> DataFrame:
    return _table(classified.filter(F.col("doc_type") == "bill_of_lading"), BILL_OF_LADING)


def is_pod() -> Column:
    return (F.col("doc_type") == "proof_of_delivery") | F.coalesce(F.col("is_signed_delivery_copy"), F.lit(False))


def proofs_of_delivery(classified: DataFrame) -> DataFrame:
    """Proofs by type and signed delivery copies, which stay in the table of their own type too."""
    source = F.when(F.col("doc_type") == "proof_of_delivery", "proof_of_delivery").otherwise("signed_copy")
    when = F.coalesce(_column(classified, "delivery_signed_date"), F.col("delivery_date"))
    return _table(classified.filter(is_pod()), PROOF_OF_DELIVERY, when.alias("delivery_date"), source.alias("pod_source"))


def other_documents(classified: DataFrame) -> DataFrame:
    own = ["rate_confirmation", "bill_of_lading", "proof_of_delivery"]
    return _table(classified.filter(~F.col("doc_type").isin(own)), OTHER)


def pod_coverage(docs: DataFrame) -> DataFrame:
    """Share of loads with a proof of delivery, by type alone and with signed copies."""
    per_load = docs.groupBy("load_id").agg(
        F.bool_or(F.col("doc_type") == "proof_of_delivery").cast("int").alias("by_type"),
        F.bool_or(is_pod()).cast("int").alias("by_role"),
    )
    return per_load.agg(
        F.count("*").alias("loads"),
        F.sum("by_type").alias("loads_by_type"),
        F.sum("by_role").alias("loads_by_role"),
    ).select(
        "*",
        F.round(F.try_divide("loads_by_type", "loads"), 6).alias("share_before"),
        F.round(F.try_divide("loads_by_role", "loads"), 6).alias("share_after"),
    )


def load_overview(classified: DataFrame) -> DataFrame:
    """One row per load over its rate confirmations, bills of lading and proofs of delivery.

    Copies of one bill count once for the pieces: those of the signed, then earliest, copy; a bill
    without a number is a bill of its own. One grouping by bill and one by load, no join.
    """
    rc, bol, pod = (F.col("doc_type") == t for t in ("rate_confirmation", "bill_of_lading", "proof_of_delivery"))
    number = _column(classified, "bol_number")
    one = F.concat_ws(":", number, F.when(number.isNull(), F.col("doc_seq").cast("string")))
    signed = F.coalesce(F.col("is_signed_delivery_copy"), F.lit(False))
    delivered = F.coalesce(_column(classified, "delivery_signed_date"), F.col("delivery_date"))
    # Documents that are no bill fall into one group per load.
    bills = classified.groupBy("load_id", F.when(bol, F.concat(number.isNull().cast("string"), one)).alias("bill")).agg(
        F.count_if(rc).alias("n_rc"), F.count_if(bol).alias("n_bol"), F.count_if(is_pod()).alias("n_pod"),
        F.max(F.when(rc, cents(F.col("rate_total")))).alias("rate_cents"),
        F.max(F.when(bol, F.struct(signed.alias("signed"), (-F.col("doc_seq")).alias("k"), F.col("pieces"))))["pieces"].alias("pieces"),
        F.max(F.when(is_pod(), delivered)).alias("last_delivery_date"),
        F.max(F.when(rc | bol | is_pod(), F.col("packet_load_number"))).alias("packet_load_number"),
    )
    loads = bills.groupBy("load_id").agg(
        F.max("packet_load_number").alias("packet_load_number"),
        *[F.sum(c).cast("bigint").alias(c) for c in ["n_rc", "n_bol", "n_pod"]],
        F.max("rate_cents").alias("rate_cents"), F.sum("pieces").cast("bigint").alias("bol_pieces"),
        F.max("last_delivery_date").alias("last_delivery_date"),
    )
    return loads.filter(F.col("n_rc") + F.col("n_bol") + F.col("n_pod") > 0)
