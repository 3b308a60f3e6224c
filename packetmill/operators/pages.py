"""OCR pages and the documents that lie on them.

``pages`` is ``load_id, page_no, page_text, page_conf``, one row per page, numbered from 1.
``docs`` carries ``load_id, doc_seq, page_range``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetmill.functions import page_ranges, text
from packetmill.operators.joins import join_summary
from packetmill.operators.positions import PAGES, running_totals, span_ends
from packetmill.session import stored

# Pages whose text is put into one string; a longer text continues in a further part.
PART = 1024
# Pages beyond which a document counts as wide: it is searched by position instead of page by page.
WIDE = 64
# Pages of a load that one bit mask shows.
MASKED = 64


def page_stats(pages: DataFrame) -> DataFrame:
    """Pages, the last page's number, and confidence totals per load; the text is not read."""
    return pages.groupBy("load_id").agg(
        F.count("*").alias("n_pages"), F.max("page_no").alias("last_page"),
        F.sum("page_conf").alias("conf_sum"), F.count("page_conf").alias("conf_n"),
    )


def load_stats(pages: DataFrame) -> DataFrame:
    """``page_stats`` and the ``mask`` of the pages up to MASKED, one stored row per load."""
    bit = F.when(F.col("page_no").between(1, MASKED), F.expr("shiftleft(1L, page_no - 1)"))
    return stored(pages.groupBy("load_id").agg(
        F.count("*").alias("n_pages"), F.max("page_no").alias("last_page"),
        F.sum("page_conf").alias("conf_sum"), F.count("page_conf").alias("conf_n"), F.bit_or(bit).alias("mask"),
    ), "loads")


def _has_gaps(beyond: int = 0) -> Column:
    """Pages are missing, in a load whose last page lies beyond the given one."""
    return F.coalesce((F.col("n_pages") < F.col("last_page")) & (F.col("last_page") > beyond), F.lit(False))


def page_confidence(tokens: DataFrame) -> DataFrame:
    """Mean of the present, non-zero token confidences per page; 0.0 when there is none."""
    known = F.when(F.col("confidence") != 0, F.col("confidence"))
    return tokens.groupBy("load_id", "page_no").agg(
        F.coalesce(F.round(F.avg(known), 3), F.lit(0.0)).alias("page_conf")
    )


def with_scope(docs: DataFrame, pages: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Add ``spans`` (the document's pages up to the last one), ``fallback`` and the load's totals.

    A range that names no existing page falls back to the whole packet. Where pages are absent, a
    bit mask tells which of the first ones exist; documents of longer packets with gaps ask how many
    pages lie up to each end of their spans.
    """
    stats = load_stats(pages) if stats is None else stats
    # The range is parsed below the join, where filters on the result cannot repeat the work.
    parsed = docs.withColumn("_named", page_ranges.page_spans(F.col("page_range")))
    last = F.coalesce(F.col("last_page"), F.lit(0))
    rows = join_summary(parsed, stats, ["load_id"]).withColumn("_own", page_ranges.clip_spans(F.col("_named"), last))

    def has_page(s: Column) -> Column:
        ones = F.lit(-1).cast("bigint")
        from_first = F.call_function("shiftleft", ones, (s["first"] - 1).cast("int"))
        to_last = F.call_function("shiftrightunsigned", ones, (MASKED - s["last"]).cast("int"))
        return from_first.bitwiseAND(to_last).bitwiseAND(F.col("mask")) != 0

    real = F.when(_has_gaps(), F.exists("_own", has_page)).otherwise(F.size("_own") > 0)
    if not stats.filter(_has_gaps(MASKED)).isEmpty():
        asked = rows.filter(_has_gaps(MASKED)).select("load_id", "doc_seq", F.posexplode("_own").alias("span_no", "span"))
        ranks = running_totals(span_ends(asked), _numbered(pages), ["load_id"], {"n": "bigint"}, PAGES)
        some = ranks.groupBy("load_id", "doc_seq").agg((F.sum(F.col("sign") * F.col("n")) > 0).alias("_some"))
        rows = rows.join(some, ["load_id", "doc_seq"], "left")
        real = F.when(_has_gaps(MASKED), F.coalesce("_some", F.lit(False))).otherwise(real)
        rows = rows.withColumn("_real", real).drop("_some")
    else:
        rows = rows.withColumn("_real", real)
    return rows.withColumns({
        "fallback": ~F.col("_real"), "spans": F.when(F.col("_real"), F.col("_own")).otherwise(page_ranges.whole_packet(last)),
    }).drop("_own", "_named", "_real", "mask")


def _numbered(pages: DataFrame) -> DataFrame:
    """One item per page, numbered as the page, with its confidence as a decimal: sums need no order."""
    conf = F.col("page_conf").cast("decimal(38,18)")
    return pages.select("load_id", F.col("page_no").cast("bigint").alias("no"), F.lit(1).cast("bigint").alias("n"),
                        conf.alias("conf_sum"), conf.isNotNull().cast("bigint").alias("conf_n"))


CONFIDENCES = {"conf_sum": "decimal(38,18)", "conf_n": "bigint"}


def confidence_sums(scoped: DataFrame, pages: DataFrame) -> DataFrame:
    """``load_id, doc_seq, conf_sum, conf_n`` over the pages of each document's ``spans``.

    No document's pages are listed: running totals are read before the first and at the last page
    of every span.
    """
    asked = scoped.select("load_id", "doc_seq", F.posexplode("spans").alias("span_no", "span"))
    rows = running_totals(span_ends(asked), _numbered(pages), ["load_id"], CONFIDENCES, PAGES)

    def total(v: str) -> Column:
        return F.sum((F.col("sign") * F.col(v)).cast(CONFIDENCES[v]))

    return rows.groupBy("load_id", "doc_seq").agg(
        total("conf_sum").cast("double").alias("conf_sum"), total("conf_n").alias("conf_n"))


def list_pages(scoped: DataFrame, pages: DataFrame, stats: DataFrame) -> DataFrame:
    """``scoped`` once per existing page of its ``spans``, with ``span_no``, ``run`` and ``page_no``.

    The pages of a packet without gaps are the numbers of its spans; up to MASKED, numbers of missing
    pages are listed too and find no partner in a join. In longer packets with gaps the places of the
    existing pages are listed, so that the work follows what there is.
    """
    if stats.filter(_has_gaps(MASKED)).isEmpty():
        return page_ranges.list_pages(scoped)
    gappy = stats.filter(_has_gaps(MASKED)).select("load_id")
    plain = page_ranges.list_pages(join_summary(scoped, gappy, ["load_id"], "left_anti"))
    rest = [c for c in scoped.columns if c != "spans"]
    spans = join_summary(scoped, gappy, ["load_id"], "left_semi").select(*rest, F.posexplode("spans").alias("span_no", "span"))
    own = join_summary(pages.select("load_id", "page_no", "page_conf"), gappy, ["load_id"], "left_semi")
    asked = running_totals(span_ends(spans), _numbered(own), ["load_id"], {"n": "bigint"}, PAGES)
    places = asked.groupBy("load_id", "doc_seq", "span_no").agg(F.struct(
        (F.max(F.when(F.col("sign") < 0, F.col("n"))) + 1).alias("first"), F.max(F.when(F.col("sign") > 0, F.col("n"))).alias("last")).alias("place"))
    placed = spans.drop("span").join(places, ["load_id", "doc_seq", "span_no"]).filter("place.first <= place.last")
    listed = page_ranges.list_pages(placed.withColumn("places", F.array("place")).drop("place").withColumnRenamed("span_no", "_span"), "places")
    number = F.col("page_no").cast("bigint")
    ranked = running_totals(own.select("load_id", "page_no", number.alias("at")), _numbered(own), ["load_id"], {"n": "bigint"}, PAGES)
    ranked = ranked.select("load_id", F.col("page_no").cast("bigint").alias("_no"), F.col("n").alias("page_no"))
    found = listed.drop("span_no").join(ranked, ["load_id", "page_no"]).select(
        *rest, F.col("_span").alias("span_no"), "run", F.col("_no").alias("page_no"))
    return plain.unionByName(found)


def docs_to_pages(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Each document's own existing pages, duplicates kept; documents without any drop out.

    The join key holds the page number, so a packet of any size spreads over all tasks.
    """
    stats = load_stats(pages)
    scoped = with_scope(docs.select("load_id", "doc_seq", "page_range"), pages, stats).filter(~F.col("fallback"))
    listed = list_pages(scoped.select("load_id", "doc_seq", "spans"), pages, stats)
    return listed.join(pages, ["load_id", "page_no"])


def doc_confidence(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Mean page confidence over the document's pages, the packet's mean without any, 3 decimals.

    Up to WIDE pages of a document are listed; wider ones are answered from running totals.
    """
    stats = load_stats(pages)
    scoped = with_scope(docs.select("load_id", "doc_seq", "page_range"), pages, stats).select("load_id", "doc_seq", "spans")
    few = page_ranges.span_pages(F.col("spans")) <= WIDE
    wide = not stats.filter(F.col("last_page") > WIDE).isEmpty()
    listed = page_ranges.list_pages(scoped.filter(few) if wide else scoped).select("load_id", "doc_seq", "page_no")
    exact = F.col("page_conf").cast("decimal(38,18)")
    sums = listed.join(pages.select("load_id", "page_no", exact.alias("conf")), ["load_id", "page_no"]).groupBy("load_id", "doc_seq").agg(
        F.sum("conf").cast("double").alias("conf_sum"), F.count("conf").alias("conf_n"))
    if wide:
        sums = sums.unionByName(confidence_sums(scoped.filter(~few), pages))
    conf = F.round(F.col("conf_sum") / F.nullif(F.col("conf_n"), F.lit(0)), 3)
    return docs.select("load_id", "doc_seq").join(sums, ["load_id", "doc_seq"], "left").select(
        "load_id", "doc_seq", conf.alias("ocr_confidence"))


def _joined(order: list[str], value: Column, separator: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(*order, value.alias("_value"))))
    return F.array_join(F.transform(rows, lambda r: r["_value"]), separator)


def page_text_for(docs: DataFrame, pages: DataFrame, separator: str = " ") -> DataFrame:
    """Text of the document's pages in range order, all pages without any, ``""`` without pages.

    One row per document and part; a part covers up to PART page places of a span, and the parts
    in order, joined by the separator, are the whole text.
    """
    stats = load_stats(pages)
    scoped = with_scope(docs.select("load_id", "doc_seq", "page_range"), pages, stats).select("load_id", "doc_seq", "spans")
    # Place of each span's first page in the document's own sequence of pages.
    before = F.transform(
        F.col("spans"),
        lambda s, i: F.struct(
            s["first"].alias("first"),
            s["last"].alias("last"),
            page_ranges.span_pages(F.slice(F.col("spans"), 1, i)).alias("base"),
        ),
    )
    based = scoped.withColumn("bases", F.transform(before, lambda s: s["base"] - s["first"]))
    listed = list_pages(based, pages, stats).withColumn(
        "place", F.col("page_no") + F.get("bases", F.col("span_no"))
    )
    part = F.floor(F.col("place") / PART).cast("bigint")
    texts = (
        listed.select("load_id", "doc_seq", "page_no", "place")
        .join(pages.select("load_id", "page_no", "page_text"), ["load_id", "page_no"])
        .groupBy("load_id", "doc_seq", part.alias("part_no"))
        .agg(_joined(["place"], F.col("page_text"), separator).alias("scoped_text"))
    )
    return docs.select("load_id", "doc_seq").join(texts, ["load_id", "doc_seq"], "left").select(
        "load_id",
        "doc_seq",
        F.coalesce("part_no", F.lit(0).cast("bigint")).alias("part_no"),
        F.coalesce("scoped_text", F.lit("")).alias("scoped_text"),
    )


def marked_pages(pages: DataFrame) -> DataFrame:
    """Each page's text under its ``--- PAGE n ---`` line; unmarked in a load of blank pages only."""
    flags = pages.groupBy("load_id").agg(F.bool_or(~text.is_blank(F.col("page_text"))).alias("has_text"))
    mark = F.concat(F.lit("--- PAGE "), F.col("page_no").cast("string"), F.lit(" ---\n"), F.col("page_text"))
    return join_summary(pages.select("load_id", "page_no", "page_text"), flags, ["load_id"]).select(
        "load_id", "page_no", F.when(F.col("has_text"), mark).otherwise(F.col("page_text")).alias("marked")
    )


def marked_text(pages: DataFrame) -> DataFrame:
    """The marked pages of a load joined by newlines, one row per load and part of PART pages."""
    part = F.floor((F.col("page_no") - 1) / PART).cast("bigint")
    return marked_pages(pages).groupBy("load_id", part.alias("part_no")).agg(
        _joined(["page_no"], F.col("marked"), "\n").alias("marked_text")
    )


def slice_page_text(chunks: DataFrame) -> DataFrame:
    """Cut each page's text out of its chunk: the ``[start, end)`` segments in order, joined.

    ``chunks``: ``load_id, chunk_no, chunk_text, pages array<array<struct<start,end>>>``, the
    segments of each page of the chunk, and optionally ``page_confs``, the pages' confidences.
    """
    chunk_text = F.col("chunk_text")
    cut = F.transform(
        F.col("segments"), lambda s: F.substr(chunk_text, s["start"] + 1, s["end"] - s["start"])
    )
    confs = ["page_confs"] if "page_confs" in chunks.columns else []
    per_page = chunks.select("load_id", "chunk_no", "chunk_text", *confs, F.posexplode("pages").alias("page_pos", "segments"))
    return per_page.select(
        "load_id", "chunk_no", "page_pos", F.array_join(F.coalesce(cut, F.array().cast("array<string>")), "").alias("page_text"),
        *[F.get(c, F.col("page_pos")).alias("page_conf") for c in confs],
    )


def stitch_pages(chunk_pages: DataFrame, limit: int = 30) -> DataFrame:
    """Packet-wide page numbers for the pages of chunks: chunks are full but for the last."""
    number = (F.col("chunk_no") * limit + F.col("page_pos") + 1).cast("int")
    return chunk_pages.withColumn("page_no", number).drop("chunk_no", "page_pos")


def stitch_chunks(chunks: DataFrame, part_chunks: int = PART) -> DataFrame:
    """Chunk texts in order, joined by newlines, empty chunks at the start left out.

    One row per load and part of ``part_chunks`` chunks; a part after the first carries its own
    leading newline where text precedes it, so that the parts in order give the text as they are.
    """
    filled = chunks.filter(F.length("chunk_text") > 0).groupBy("load_id").agg(F.min("chunk_no").alias("first_no"))
    rows = join_summary(chunks.select("load_id", "chunk_no", "chunk_text"), filled, ["load_id"])
    lead = F.when(F.col("chunk_no") > F.col("first_no"), F.lit("\n")).otherwise(F.lit(""))
    part = F.floor(F.col("chunk_no") / part_chunks).cast("bigint")
    return rows.groupBy("load_id", part.alias("part_no")).agg(
        _joined(["chunk_no"], F.concat(lead, F.col("chunk_text")), "").alias("full_text")
    )


def ocr_lookup(loads: DataFrame, cache: DataFrame) -> DataFrame:
    """Mark each load ``ocr_cached`` when the cache holds its pages, and count them."""
    hits = cache.groupBy("load_id").agg(F.count("*").alias("cached_pages"))
    return loads.join(hits, "load_id", "left").select(
        *loads.columns,
        F.col("cached_pages").isNotNull().alias("ocr_cached"),
        F.coalesce("cached_pages", F.lit(0).cast("bigint")).alias("cached_pages"),
    )


def cached_pages(loads: DataFrame, cache: DataFrame) -> DataFrame:
    """The stored pages of the loads that hit the cache."""
    return join_summary(cache, loads.select("load_id").distinct(), ["load_id"], "left_semi")


def cache_misses(loads: DataFrame, cache: DataFrame) -> DataFrame:
    return loads.join(cache.select("load_id").distinct(), "load_id", "left_anti")
