"""One line per packet: what it split into, how well it read, what to look at.

``docs`` carries ``load_id, doc_seq, doc_type, page_range, is_signed_delivery_copy,
ocr_confidence, unverified_fields, n_stops, n_accessorials``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetmill import schemas
from packetmill.functions.page_ranges import named_pages


def with_child_counts(docs: DataFrame, stops: DataFrame, accessorials: DataFrame) -> DataFrame:
    """Add ``n_stops`` and ``n_accessorials`` counted from the child tables.

    Both tables are counted in one grouping, so the documents are joined once.
    """
    both = stops.select("load_id", "doc_seq", F.lit(1).alias("stop"), F.lit(0).alias("charge")).unionByName(
        accessorials.select("load_id", "doc_seq", F.lit(0).alias("stop"), F.lit(1).alias("charge"))
    )
    counts = both.groupBy("load_id", "doc_seq").agg(F.sum("stop").alias("n_stops"), F.sum("charge").alias("n_accessorials"))
    return docs.join(counts, ["load_id", "doc_seq"], "left").na.fill(0, ["n_stops", "n_accessorials"])


def _is_pod() -> Column:
    return F.coalesce(F.col("is_signed_delivery_copy"), F.lit(False)) | (F.col("doc_type") == "proof_of_delivery")


def _per_type(docs: DataFrame, *more: Column) -> DataFrame:
    pages = named_pages(F.col("page_range"))
    return docs.groupBy("load_id", "doc_type").agg(
        F.count("*").alias("n_docs"),
        # A sum that cannot be counted is null, and shown so; it must not end the job.
        F.when(F.count_if(pages.isNull()) == 0, F.try_sum(pages)).alias("n_pages"),
        F.bool_or(_is_pod()).alias("pod"),
        *more,
    )


def _mix() -> Column:
    """``type[ xN]:Pp`` by pages, most first, then type, with POD at the end when there is one."""
    copies = F.when(F.col("n_docs") > 1, F.concat(F.lit(" x"), F.col("n_docs").cast("string"))).otherwise(F.lit(""))
    shown = F.coalesce(F.col("n_pages").cast("string"), F.lit("?"))
    entry = F.concat("doc_type", copies, F.lit(":"), shown, F.lit("p"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n_pages")).alias("k"), F.col("doc_type"), entry.alias("entry"))))
    return F.concat_ws(
        " ", F.transform(ordered, lambda e: e["entry"]), F.when(F.bool_or("pod"), F.lit("POD"))
    )


def packet_mix(docs: DataFrame) -> DataFrame:
    """What each packet split into. Groups by type first, so a load ends as a few rows."""
    return _per_type(docs).groupBy("load_id").agg(_mix().alias("mix"))


def worst_confidence(docs: DataFrame) -> DataFrame:
    return docs.groupBy("load_id").agg(F.min("ocr_confidence").alias("worst_confidence"))


def _names_per_group() -> list[Column]:
    """One flag per checkable field: some document of the group reports it."""
    reported = F.split(F.coalesce("unverified_fields", F.lit("")), ",")
    return [F.bool_or(F.array_contains(reported, f)).alias(f"_bad_{f}") for f in schemas.KEY_FIELDS]


def _flagged_list() -> Column:
    return F.concat_ws(",", *[F.when(F.col(f"_bad_{f}"), f) for f in sorted(schemas.KEY_FIELDS)])


def flagged_fields(docs: DataFrame) -> DataFrame:
    """The unverified fields of a load, sorted, each once; ``""`` when all is clean."""
    return docs.groupBy("load_id").agg(*_names_per_group()).select("load_id", _flagged_list().alias("flagged"))


def _stops_of_type() -> list[Column]:
    rc = F.col("doc_type") == "rate_confirmation"
    return [F.max(F.when(rc, F.col("n_stops"))).alias("rc_stops"), F.max("n_stops").alias("any_stops")]


def _stops() -> Column:
    return F.coalesce(F.nullif(F.col("rc_stops"), F.lit(0)), F.col("any_stops"), F.lit(0)).cast("bigint")


def stop_count(docs: DataFrame) -> DataFrame:
    """Stops of the itinerary: the rate confirmation's if it has any, else the longest of all."""
    return docs.groupBy("load_id").agg(*_stops_of_type()).select("load_id", _stops().alias("n_stops"))


def accessorial_count(docs: DataFrame) -> DataFrame:
    return docs.groupBy("load_id").agg(F.sum("n_accessorials").cast("bigint").alias("n_accessorials"))


def packet_detail(docs: DataFrame, calls: DataFrame) -> DataFrame:
    """The summary line of each load, parts joined by ``" | "``, absent parts left out.

    ``calls``: one row per load with ``pages, out_tokens, think_tokens, ocr_cached``. All figures
    come from one grouping by type and one by load.
    """
    typed = _per_type(
        docs,
        F.min("ocr_confidence").alias("conf"),
        *_stops_of_type(),
        F.sum("n_accessorials").alias("acc"),
        *_names_per_group(),
    )
    per_load = typed.groupBy("load_id").agg(
        _mix().alias("mix"),
        F.min("conf").alias("conf"),
        F.max("rc_stops").alias("rc_stops"),
        F.max("any_stops").alias("any_stops"),
        F.sum("acc").alias("acc"),
        *[F.bool_or(f"_bad_{f}").alias(f"_bad_{f}") for f in schemas.KEY_FIELDS],
    ).withColumns({"n_stops": _stops(), "flagged": _flagged_list()})
    line = F.concat_ws(
        " | ",
        F.col("mix"),
        F.concat(F.col("pages").cast("string"), F.lit("p")),
        F.when(F.col("n_stops") > 0, F.concat(F.col("n_stops").cast("string"), F.lit("stop"))),
        F.when(F.col("acc") > 0, F.concat(F.col("acc").cast("string"), F.lit("acc"))),
        F.concat(F.lit("ocr"), F.call_function("format_number", F.col("conf"), F.lit("0.00"))),
        F.concat(F.lit("out"), F.format_number("out_tokens", 0)),
        F.concat(F.lit("think"), F.format_number("think_tokens", 0)),
        F.when(F.col("ocr_cached"), "cached"),
        F.when(F.col("flagged") != "", F.concat(F.lit("!"), F.col("flagged"))),
    )
    figures = calls.select(
        "load_id", "pages", *[F.coalesce(c, F.lit(0)).alias(c) for c in ["out_tokens", "think_tokens"]],
        F.coalesce("ocr_cached", F.lit(False)).alias("ocr_cached"),
    )
    # A load without a call row keeps its line, with no tokens.
    joined = per_load.join(figures, "load_id", "left").na.fill(0, ["out_tokens", "think_tokens"])
    return joined.select("load_id", line.alias("detail"))
