"""Cross-check of extracted values against the text of the document's own pages.

The reference text of a document is the normalised text of its pages put end to end, and a value
may run over a page break. That text is never built: every page is searched where it lies, and
only its edges, one character shorter than the longest value sought, travel on to be put end to
end and searched for values that cross a break. Blanks cannot occur in normalised text, so one
blank stands for what was left out between two edges.

Documents of very many pages are not searched page by page. Their load's text is laid out by
characters once, all sought values are looked up in it by the fingerprints of their windows, and
each of a document's spans asks how often a value starts between two characters. Only the ends of
neighbouring spans, as long as the longest value, are put together for values that cross a seam.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetmill import schemas
from packetmill.functions import page_ranges, text
from packetmill.functions.fingerprints import LONGEST, value_prints
from packetmill.operators.joins import join_summary
from packetmill.operators.pages import CONFIDENCES, WIDE, load_stats, with_scope
from packetmill.operators.positions import PAGES, TEXT, occurrences, running_totals, span_ends, standing, text_between, text_blocks
from packetmill.session import stored

# Evidence longer than this is not trusted, and values shorter than this are not checked.
MAX_EVIDENCE = 64
MIN_LENGTH = 3
# Pages of one document up to which it is searched page by page.
HEAVY = WIDE
# Documents below this confidence go to review.
REVIEW_CONFIDENCE = 0.80


def key_fields(docs: DataFrame) -> list[str]:
    """The fields of the table that are checked, in report order."""
    return [f for f in schemas.KEY_FIELDS if f in docs.columns]


def sought_values(docs: DataFrame) -> Column:
    """The normalised text to look for per key field, null where the field needs no check.

    The numeric fields are the last of the key fields, so words then numbers is report order.
    """
    fields = key_fields(docs)
    words = [f for f in fields if f not in schemas.NUMERIC_KEY_FIELDS]
    numbers = [f for f in fields if f in schemas.NUMERIC_KEY_FIELDS]
    evidence = [schemas.EVIDENCE_FIELDS.get(f) for f in numbers]
    empty = F.array().cast("array<string>")

    def long_enough(own: Column) -> Column:
        return F.when(F.length(own) >= MIN_LENGTH, own)

    def own_or_evidence(v: Column) -> Column:
        # Evidence of punctuation alone normalises to "", which every text contains.
        from_page = F.nullif(text.norm(v["evidence"]), F.lit(""))
        plain = long_enough(text.norm_number(v["value"]))
        chosen = F.when(F.length(v["evidence"]).between(1, MAX_EVIDENCE), from_page).otherwise(plain)
        return F.when(v["value"].isNotNull(), chosen)

    pairs = [
        F.struct(
            F.col(n).cast("double").alias("value"),
            (F.col(e) if e in docs.columns else F.lit(None).cast("string")).alias("evidence"),
        )
        for n, e in zip(numbers, evidence)
    ]
    # An empty word normalises to "" and is too short to be checked, as it should be.
    from_words = F.transform(F.array(*words), lambda w: long_enough(text.norm(w))) if words else empty
    from_numbers = F.transform(F.array(*pairs), own_or_evidence) if pairs else empty
    return F.concat(from_words, from_numbers)


def _found_in(n_fields: int) -> Column:
    """Bit i is set when sought value i occurs in the body."""
    hits = [f"if(contains(body, get(sought, {i})), {1 << i}, 0)" for i in range(n_fields)]
    return F.expr(" | ".join(["0", *hits]))


def _edges(body: Column) -> Column:
    edge = F.col("edge")
    return F.when(
        F.length(body) > 2 * edge + 1, F.concat(F.left(body, edge), F.lit(" "), F.right(body, edge))
    ).otherwise(body)


def _mean(total: str, n: str) -> Column:
    return F.col(total) / F.nullif(F.col(n), F.lit(0))


def _put_together(pieces: DataFrame, keys: list[str], order: list[str], n_fields: int) -> DataFrame:
    """Join neighbouring pieces, search their seams and shorten them to their edges again."""
    parts = F.array_sort(F.collect_list(F.struct(*order, "body")))
    return pieces.groupBy("load_id", "doc_seq", *keys).agg(
        F.array_join(parts["body"], "").alias("body"),
        F.any_value("sought").alias("sought"),
        F.any_value("edge").alias("edge"),
        F.bit_or("found").alias("found"),
        F.sum("conf_sum").alias("conf_sum"),
        F.sum("conf_n").alias("conf_n"),
    ).withColumns({
        "found": F.col("found").bitwiseOR(_found_in(n_fields)),
        "body": _edges(F.col("body")),
    })


def _search_pages(per_page: DataFrame, n_fields: int) -> DataFrame:
    """Search every page for what its document seeks; ``load_id, doc_seq, found, conf``."""
    searched = per_page.withColumns({
        "found": _found_in(n_fields),
        "body": _edges(F.col("body")),
        "conf_sum": F.col("page_conf"),
        "conf_n": F.when(F.col("page_conf").isNotNull(), 1).otherwise(0),
    })
    stretches = _put_together(searched, ["span_no", "run"], ["page_no"], n_fields)
    checked = _put_together(stretches, [], ["span_no", "run"], n_fields)
    return checked.select("load_id", "doc_seq", "found", _mean("conf_sum", "conf_n").alias("conf"))


def _own_pages(scoped: DataFrame, norm_pages: DataFrame) -> DataFrame:
    """The pages of every document."""
    wanted = scoped.select("load_id", "doc_seq", "spans", "sought", "edge")
    return page_ranges.list_pages(wanted).join(norm_pages, ["load_id", "page_no"])


def _value_hits(wide: DataFrame, spans: DataFrame, blocks: DataFrame) -> DataFrame:
    """``load_id, doc_seq, found``: the values that stand within one of the document's spans."""
    values = wide.select("load_id", "doc_seq", F.posexplode("sought").alias("i", "value")).filter("value <> ''")
    values = values.withColumn("size", F.length("value")).withColumn("prints", value_prints("value"))
    # The first characters of a value, as many as the largest power of two in its length.
    power = F.expr("shiftleft(1, length(conv(size, 10, 2)) - 1)")
    lead = F.when(F.size("prints") == 1, F.substr("value", F.lit(1), power))
    values = stored(values.withColumn("lead", F.get(value_prints(lead), F.lit(0))), "values")
    within = spans.select("load_id", "doc_seq", "c0", "c1")
    short = values.filter("size(prints) = 1").select("load_id", "doc_seq", "i", "size", F.get("prints", F.lit(0)).alias("print"), "lead")
    asked = short.join(within, ["load_id", "doc_seq"]).filter("c1 - c0 >= size").select(
        "load_id", "doc_seq", "i", "print", F.col("c0").alias("x"), (F.col("c1") - F.col("size")).alias("y"))
    there = standing(asked.select("load_id", "print", "x", "y"), short.select("load_id", "print", "size", "lead").distinct(), blocks)
    hits = join_summary(asked, there, ["load_id", "print", "x", "y"], "left_semi").select("load_id", "doc_seq", "i")
    long = values.filter("size(prints) > 1").withColumn("key", F.xxhash64("value"))
    if not long.isEmpty():
        hits = hits.unionByName(_long_hits(long, within, blocks))
    return hits.groupBy("load_id", "doc_seq").agg(F.expr("bit_or(shiftleft(1, i))").alias("found"))


def _long_hits(values: DataFrame, spans: DataFrame, blocks: DataFrame) -> DataFrame:
    """``load_id, doc_seq, i``: values of several windows that stand within one of the document's spans."""
    starts = occurrences(values.select("load_id", "value", "prints", "key"), blocks)
    items = starts.select("load_id", F.col("key").cast("string").alias("key"), "no", F.lit(1).cast("bigint").alias("n"))
    sought = values.select("load_id", "doc_seq", "i", F.col("key").cast("string").alias("key"), "size")
    each = sought.join(spans, ["load_id", "doc_seq"]).filter("c1 - c0 >= size")
    ends = F.array(F.struct((F.col("c0") - 1).alias("at"), F.lit(-1).alias("sign")), F.struct((F.col("c1") - F.col("size")).alias("at"), F.lit(1).alias("sign")))
    counted = running_totals(each.select("load_id", "doc_seq", "i", "key", F.inline(ends)), items, ["load_id", "key"], {"n": "bigint"}, TEXT)
    counts = counted.groupBy("load_id", "doc_seq", "i").agg(F.sum(F.col("sign") * F.col("n")).alias("n"))
    return counts.filter("n > 0").select("load_id", "doc_seq", "i")


def _seam_hits(wide: DataFrame, spans: DataFrame, blocks: DataFrame, n_fields: int) -> DataFrame:
    """``load_id, doc_seq, seams``: the values in the ends of the document's spans, put together."""
    several = wide.filter((F.size("spans") > 1) & (F.col("edge") > 0)).select("load_id", "doc_seq", "edge", "sought")
    rows = spans.join(several.drop("sought"), ["load_id", "doc_seq"])
    both = F.array(
        F.struct(F.lit(0).alias("part"), F.col("c0").alias("x"), (F.col("c0") + F.col("edge")).alias("y")),
        F.struct(F.lit(1).alias("part"), (F.col("c1") - F.col("edge")).alias("x"), F.col("c1").alias("y")))
    whole = F.array(F.struct(F.lit(0).alias("part"), F.col("c0").alias("x"), F.col("c1").alias("y")))
    ranges = F.when(F.col("c1") - F.col("c0") <= 2 * F.col("edge") + 1, whole).otherwise(both)
    pieces = text_between(rows.select("load_id", "doc_seq", "span_no", F.inline(ranges)), blocks)
    # A blank stands for what lies between the two ends of one span.
    left_out = (F.col("part") == 1) & (F.col("block") == F.expr(f"x div {TEXT}"))
    pieces = pieces.withColumn("piece", F.when(left_out, F.concat(F.lit(" "), "piece")).otherwise(F.col("piece")))
    ordered = F.array_sort(F.collect_list(F.struct("span_no", "part", "block", "piece")))
    bodies = pieces.groupBy("load_id", "doc_seq").agg(F.array_join(ordered["piece"], "").alias("body"))
    return bodies.join(several, ["load_id", "doc_seq"]).select("load_id", "doc_seq", _found_in(n_fields).alias("seams"))


def _search_by_position(wide: DataFrame, norm_pages: DataFrame, n_fields: int) -> DataFrame:
    """``load_id, doc_seq, found, conf`` of documents of any number of spans, without listing their pages."""
    wide = wide.select("load_id", "doc_seq", "spans", "sought", "edge")
    texts = join_summary(norm_pages, wide.select("load_id").distinct(), ["load_id"], "left_semi")
    conf = F.col("page_conf").cast("decimal(38,18)")
    items = stored(texts.select(
        "load_id", F.col("page_no").cast("bigint").alias("no"), F.coalesce(F.length("body"), F.lit(0)).cast("bigint").alias("chars"),
        conf.alias("conf_sum"), conf.isNotNull().cast("bigint").alias("conf_n")), "page-sizes")
    ends = span_ends(wide.select("load_id", "doc_seq", F.posexplode("spans").alias("span_no", "span")))
    totals = running_totals(ends, items, ["load_id"], {"chars": "bigint", **CONFIDENCES}, PAGES)
    spans = stored(totals.groupBy("load_id", "doc_seq", "span_no").agg(
        F.max(F.when(F.col("sign") < 0, F.col("chars"))).alias("c0"), F.max(F.when(F.col("sign") > 0, F.col("chars"))).alias("c1"),
        *[F.sum((F.col("sign") * F.col(v)).cast(kind)).alias(v) for v, kind in CONFIDENCES.items()]), "spans")
    blocks = stored(text_blocks(texts), "text", compression="zstd")
    scored = spans.groupBy("load_id", "doc_seq").agg(F.sum("conf_sum").cast("double").alias("conf_sum"), F.sum("conf_n").alias("conf_n"))
    found = F.coalesce("found", F.lit(0)).bitwiseOR(F.coalesce("seams", F.lit(0)))
    return scored.join(_value_hits(wide, spans, blocks), ["load_id", "doc_seq"], "left").join(
        _seam_hits(wide, spans, blocks, n_fields), ["load_id", "doc_seq"], "left").select(
        "load_id", "doc_seq", found.alias("found"), _mean("conf_sum", "conf_n").alias("conf"))


def check_documents(docs: DataFrame, pages: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """All columns of ``docs`` plus ``ocr_confidence`` and ``unverified_fields``.

    Documents are searched page by page: the page text crosses the network once, keyed by load and
    page, and everything after that is a few bytes per page. Pages are put together in stretches of
    bounded length first, so that a document of any size stays spread.

    That would explode where very many documents each cover very many pages. Documents of more than
    ``heavy`` pages are searched by position: the work then grows with the text and with the
    documents, not with their product. Both ways give the same result; whether any load has that
    many pages is looked up first.
    """
    fields = key_fields(docs)
    inputs = [*fields, *(e for e in schemas.EVIDENCE_FIELDS.values() if e in docs.columns)]
    sought = sought_values(docs)
    longest = F.coalesce(F.array_max(F.transform("sought", lambda v: F.length(v))), F.lit(0))
    keyed = docs.select("load_id", "doc_seq", "page_range", *inputs).select(
        "load_id", "doc_seq", "page_range", sought.alias("sought")
    )
    stats = load_stats(pages)
    scoped = with_scope(keyed, pages, stats).select(
        "load_id", "doc_seq", "spans", "sought", F.greatest(longest - 1, F.lit(0)).alias("edge"))
    norm_pages = pages.select("load_id", "page_no", text.norm(F.col("page_text")).alias("body"), "page_conf")
    if stats.filter(F.col("last_page") > heavy).isEmpty():
        results = _search_pages(_own_pages(scoped, norm_pages), len(fields))
    else:
        # Several branches read both: ranges are parsed and texts normalised once.
        scoped, norm_pages = stored(scoped, "scoped"), stored(norm_pages, "norm-pages", compression="zstd")
        many = page_ranges.span_pages(F.col("spans")) > heavy
        few = scoped.filter(~many)
        # Few of the pages belong to short documents; the others' texts need not travel.
        wanted = stored(page_ranges.list_pages(few.select("load_id", "doc_seq", "spans")).select("load_id", "page_no").distinct(), "wanted")
        paged = _search_pages(_own_pages(few, join_summary(norm_pages, wanted, ["load_id", "page_no"], "left_semi")), len(fields))
        results = paged.unionByName(_search_by_position(scoped.filter(many), norm_pages, len(fields)))
    return docs.withColumn("sought", sought).join(results, ["load_id", "doc_seq"], "left").select(
        *docs.columns, F.round("conf", 3).alias("ocr_confidence"), _unverified(docs).alias("unverified_fields")
    )


def _unverified(docs: DataFrame) -> Column:
    """Names of the sought fields that no page and no seam contained."""
    names = [
        f"if(get(sought, {i}) IS NOT NULL AND coalesce(found, 0) & {1 << i} = 0, '{f}', NULL)"
        for i, f in enumerate(key_fields(docs))
    ]
    return F.expr(f"concat_ws(',', {', '.join(names)})") if names else F.lit("")


def silver_review(confidence: Column, unverified: Column, illegible: Column | None = None,
                  threshold: float = REVIEW_CONFIDENCE) -> Column:
    """Something on the document needs a human look."""
    flag = (F.coalesce(unverified, F.lit("")) != "") | F.coalesce(confidence < threshold, F.lit(False))
    return flag if illegible is None else flag | F.coalesce(illegible, F.lit(False))


def verify_documents(docs: DataFrame, pages: DataFrame, threshold: float = REVIEW_CONFIDENCE) -> DataFrame:
    """All columns of ``docs`` plus ``ocr_confidence``, ``unverified_fields``, ``needs_review``."""
    illegible = F.col("illegible") if "illegible" in docs.columns else None
    return check_documents(docs, pages).withColumn(
        "needs_review",
        silver_review(F.col("ocr_confidence"), F.col("unverified_fields"), illegible, threshold),
    )
