"""Selection, reports, extraction hook and gold rules."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from packetmill import schemas
from packetmill.operators import extractor, gold, manifest, nested, process, summary, usage
from packetmill.operators import pages as page_ops
from packetmill.plans.fixtures import OUTPUT_PREFIX, RAW_PREFIX, table
from packetmill.plans.verification import _with_children
from packetmill.sources import readers, writers


def test_worklist_avoids_done_and_multi_and_keeps_order(spark, sf_dir):
    files = manifest.scan_manifest(table(spark, sf_dir, "manifest"), RAW_PREFIX)
    done = manifest.done_from_listing(table(spark, sf_dir, "outputs"), OUTPUT_PREFIX)
    work = manifest.worklist(files, done)
    taken = work.select("load_id")
    assert taken.join(done, "load_id").count() == taken.join(manifest.multi_loads(files), "load_id").count() == 0
    for newest in (False, True):
        listed = [(int(r.sort_key), r.path) for r in manifest.ordered_worklist(work, newest).collect()]
        assert listed == sorted(sorted(listed, key=lambda x: x[1]), key=lambda x: -x[0] if newest else x[0])
        first = [(int(r.sort_key), r.path) for r in manifest.limited_worklist(work, 5, newest).collect()]
        assert first == listed[:5]
    assert manifest.limited_worklist(work, 0).count() == 0
    assert manifest.limited_worklist(work, None).count() == work.count()
    report = {r.outcome: r.loads for r in manifest.skip_report(files, done).collect()}
    assert report["todo"] == work.count() and sum(report.values()) == files.select("load_id").distinct().count()


def test_multi_lines_follow_their_heading(spark):
    files = spark.createDataFrame([("p/2/b.pdf",), ("p/2/a.pdf",), ("p/1/x.pdf",), ("p/10/y.PDF",), ("p/10/z.pdf",)], "path string")
    lines = [r.line for r in manifest.multi_manifest_lines(manifest.scan_manifest(files, "p/")).collect()]
    assert lines == ["10 (2 PDFs)", "    p/10/y.PDF", "    p/10/z.pdf", "2 (2 PDFs)", "    p/2/a.pdf", "    p/2/b.pdf"]


def test_tallies_per_load_add_up(spark, sf_dir):
    calls = table(spark, sf_dir, "usage_calls")
    whole = usage.usage_tally(calls).first().asDict()
    per_load = usage.usage_tally(calls, ["load_id"])
    assert per_load.agg(*[F.sum(c).alias(c) for c in whole]).first().asDict() == whole


def test_tally_rules(spark):
    rows = [(None, None, None, None, 3, False, "STOP"), (10, 5, None, 15, 2, True, "stop"), (10, 5, 1, 18, 2, True, "MAX_TOKENS"),
            (10, 5, 1, 17, 2, False, None), (1, 1, 1, 0, 2, False, "")]
    calls = spark.createDataFrame(rows, "prompt_tokens bigint, candidate_tokens bigint, thought_tokens bigint, total_tokens bigint, "
                                        "ocr_pages int, ocr_cached boolean, finish_reason string")
    got = usage.usage_tally(calls).first()
    assert (got.ocr_pages, got.in_tokens, got.out_tokens, got.think_tokens, got.total_tokens) == (7, 31, 16, 3, 50)
    assert (got.ocr_cache_hits, got.no_usage_meta, got.tally_mismatch, got.truncated) == (1, 1, 1, 1)


def test_status_of_an_empty_run(spark):
    empty = spark.createDataFrame([], "status string")
    row = usage.run_status(empty, F.lit(0), 0.0).first()
    assert (row.done, row.per_minute, row.percent, row.eta_seconds) == (0, 0.0, 0.0, 0.0)
    assert usage.cost_summary(usage.usage_tally(spark.createDataFrame(
        [], "prompt_tokens bigint, candidate_tokens bigint, thought_tokens bigint, total_tokens bigint, ocr_pages int, ocr_cached boolean, finish_reason string"
    )), F.lit(0)).first().per_packet is None


def test_detail_line(spark):
    docs = spark.createDataFrame([
        ("1", 1, "rate_confirmation", "1-2", False, 0.9, "rate_total", 3, 1), ("1", 2, "bill_of_lading", "3", True, 0.975, "load_number,rate_total", 5, 0),
        ("1", 3, "bill_of_lading", "4", None, None, "", 0, 0), ("2", 1, "other", "x", False, None, "", 0, 0),
    ], "load_id string, doc_seq int, doc_type string, page_range string, is_signed_delivery_copy boolean, ocr_confidence double, "
       "unverified_fields string, n_stops long, n_accessorials long")
    calls = spark.createDataFrame([("1", 4, 1234, 0, True), ("2", 1, None, None, None)], "load_id string, pages int, out_tokens long, think_tokens long, ocr_cached boolean")
    got = {r.load_id: r.detail for r in summary.packet_detail(docs, calls).collect()}
    assert got == {
        "1": "bill_of_lading x2:2p rate_confirmation:2p POD | 4p | 3stop | 1acc | ocr0.90 | out1,234 | think0 | cached | !load_number,rate_total",
        "2": "other:0p | 1p | out0 | think0",
    }


GOOD = {"packet_summary": "s", "documents": [{"doc_type": "other", "page_range": "1", "pieces": 3.0}]}


def test_extractor_sees_only_valid_rows_and_isolates_failures(spark):
    rows = spark.createDataFrame([("1", True), ("2", True), ("3", False), ("4", True), ("5", True)], "load_id string, valid boolean")

    def extract(row):
        assert row["valid"]
        if row["load_id"] == "2":
            raise RuntimeError("boom " * 1000)
        if row["load_id"] == "4":
            return '{"documents": 5}'
        return {} if row["load_id"] == "5" else {**GOOD, "load_id": "ZZZ"}

    results = extractor.apply_extractor(rows.filter("valid"), extract)
    got = {r.load_id: (r.status, r.detail, r.packet) for r in results.collect()}
    assert set(got) == {"1", "2", "4", "5"}
    assert got["1"][0] == "ok" and got["1"][2].load_id == "1" and got["1"][2].documents[0].pieces == 3
    assert got["2"] == ("failed", "RuntimeError: " + "boom " * 1000, None)
    assert got["4"][1] == "answer does not fit the schema" and got["5"][1] == "packet_summary: required"
    assert results.schema["packet"].dataType.simpleString() == schemas.PACKET.simpleString()


FAULTS = [
    ({"documents": None}, "documents: required"), ({"packet_summary": None}, "packet_summary: required"),
    ({"doc_type": None}, "documents[0].doc_type: required"), ({"page_range": None}, "documents[0].page_range: required"),
    ({"doc_type": "nonsense"}, "documents[0].doc_type: enum"), ({"weight_unit": "stone"}, "documents[0].weight_unit: enum"),
    ({"osd_code": "lost"}, "documents[0].osd_code: enum"), ({"pieces": 3.5}, "documents[0].pieces: whole number"),
    ({"pallet_count": 3e9}, "documents[0].pallet_count: whole number"), ({"stops": [{"stop_type": "pickup"}]}, "documents[0].stops[0].sequence: required"),
    ({"stops": [{"sequence": 1, "stop_type": "pickup"}, {"sequence": 2, "stop_type": "rest"}]}, "documents[0].stops[1].stop_type: enum"),
    ({"stops": [{"sequence": 1, "stop_type": "pickup", "appt_type": "soon"}]}, "documents[0].stops[0].appt_type: enum"),
    ({"accessorials": [{"amount": 5}]}, "documents[0].accessorials[0].type: required"),
    ({"references": [{"ref_type": "po"}]}, "documents[0].references[0].value: required"),
    ({"references": [{"ref_type": "fax", "value": "1"}]}, "documents[0].references[0].ref_type: enum"),
    ({"doc_type": "invoice"}, None), ({"documents": []}, None), ({"stops": [{"sequence": 2.0, "stop_type": "delivery"}]}, None),
]


def test_every_declared_rule_fails_a_packet(spark):
    def extract(row):
        change = FAULTS[int(row["load_id"])][0]
        packet = {**GOOD, "documents": [dict(GOOD["documents"][0])]}
        target = packet if set(change) <= set(packet) else packet["documents"][0]
        target.update(change)
        return packet

    loads = spark.createDataFrame([(str(i),) for i in range(len(FAULTS))], "load_id string")
    got = {int(r.load_id): (r.status, r.detail) for r in extractor.apply_extractor(loads, extract).collect()}
    assert [got[i] for i in range(len(FAULTS))] == [("failed" if f else "ok", f) for _, f in FAULTS]


def test_a_load_of_several_parts_is_one_load(spark):
    pages = spark.range(1, 2101).selectExpr("explode(array('1', '2', '3')) load_id", "cast(id AS int) page_no", "'t' page_text", "0.5D page_conf")

    def extract(row):
        numbers = [line.split()[2] for line in row["marked_text"].splitlines() if line.startswith("--- PAGE")]
        if row["load_id"] == "2" and row["part_no"] == 1:
            raise ValueError("middle part")
        return {"packet_summary": "s", "documents": [{"doc_type": "other", "page_range": n} for n in numbers if int(n) % 700 == 0]}

    results = extractor.apply_extractor(page_ops.marked_text(pages), extract)
    assert sorted(map(tuple, extractor.load_results(results).collect())) == [("1", "ok", None), ("2", "failed", "ValueError: middle part"), ("3", "ok", None)]
    docs = nested.attach_parent(extractor.packets_of(results)).select("load_id", "doc_seq", "doc.page_range").collect()
    assert sorted(map(tuple, docs)) == [(x, i + 1, str(700 * (i + 1))) for x in "13" for i in range(3)]


def test_a_ledger_repeats_one_wave_at_most(spark, tmp_path):
    """A worker that dies in mid-run: what earlier waves paid for is not called again."""
    calls, died = tmp_path / "calls", tmp_path / "died"
    calls.mkdir()

    def extract(row):
        (calls / f"{row['load_id']}-{uuid.uuid4().hex}").write_text(row["text"])
        if row["load_id"] == "37" and not died.exists():
            died.write_text("")
            time.sleep(1)
            os._exit(1)
        if row["load_id"] in ("5", "50"):
            raise ValueError("busy")
        return {**GOOD, "packet_summary": row["text"]}

    def called():
        return [f.name.split("-")[0] for f in calls.iterdir()]

    loads = spark.range(60).selectExpr("cast(id AS string) load_id", "concat('t', id) text")
    ledger = extractor.Ledger(str(tmp_path / "ledger"), wave_rows=15)
    with pytest.raises(Exception, match="(?i)worker|stage failure"):
        extractor.apply_extractor(loads, extract, ledger).collect()
    before = set(called())
    kept = {r.load_id for r in ledger.rows(spark).collect()} if ledger.rows(spark) else set()
    got = {r.load_id: (r.status, r.detail, r.packet) for r in extractor.apply_extractor(loads, extract, ledger).collect()}
    assert {k for k, v in got.items() if v[:2] != ("ok", None)} == {"5", "50"} and len(got) == 60
    assert all(v[2].packet_summary == f"t{k}" for k, v in got.items() if v[2]) and got["5"][1] == "ValueError: busy"
    again = [x for x in called() if called().count(x) > 1]
    assert set(again) - {"5", "50"} <= before - kept and len(set(again) - {"5", "50"}) <= 30
    # A later run calls the failed ones only, and another version starts anew.
    n = len(called())
    assert extractor.apply_extractor(loads, extract, ledger).filter("status = 'ok'").count() == 58
    assert len(called()) == n + 2
    other = extractor.Ledger(str(tmp_path / "ledger"), "v2")
    assert extractor.apply_extractor(loads.limit(3), extract, other).count() == 3
    assert len(called()) == n + 5
    assert extractor.apply_extractor(loads.limit(0), extract, extractor.Ledger(str(tmp_path / "none"))).count() == 0


def test_a_ledger_keeps_parts_apart(spark, tmp_path):
    rows = spark.createDataFrame([("1", 0, "a"), ("1", 1, "b"), ("2", 0, "c")], "load_id string, part_no int, text string")
    ledger = extractor.Ledger(str(tmp_path / "ledger"), wave_rows=1)
    packet = {"packet_summary": "s", "documents": [dict(GOOD["documents"][0])]}
    for _ in range(2):
        results = extractor.apply_extractor(rows, lambda row: packet, ledger)
        docs = nested.attach_parent(extractor.packets_of(results)).select("load_id", "doc_seq").collect()
        assert sorted(map(tuple, docs)) == [("1", 1), ("1", 2), ("2", 1)]
    assert ledger.rows(spark).count() == 3


def test_a_run_of_faulty_loads(spark, tmp_path):
    """Cells that cannot be counted and a second run: neither ends the job nor adds anything."""
    files = manifest.scan_manifest(spark.createDataFrame(
        [("p/1/a.pdf", 9, True, False, 1), ("p/2/a.pdf", 0, True, False, 1), ("p/3/a.pdf", 9, True, True, 1), ("p/4/a.pdf", 9, True, False, 1),
         ("p/5/a.pdf", 9, True, False, 1), ("p/5/b.pdf", 9, True, False, 1), ("p/6/a.pdf", 9, True, False, 1)],
        "path string, length long, openable boolean, needs_pass boolean, page_count int"), "p/")
    pages = spark.createDataFrame([("1", 1, "LN-100 one", 0.5), ("1", 3, "two", 0.9), ("6", 1, "from the service", 0.1)],
                                  "load_id string, page_no int, page_text string, page_conf double")
    cache = spark.createDataFrame([("6", 1, "ln 600 from the cache", 0.8)], pages.schema)

    def extract(row):
        page_range = "1-9999999999,1-99999999999999999999999999999999999999999" if row["load_id"] == "1" else "1"
        return {"packet_summary": "s", "documents": [{"doc_type": "other", "page_range": page_range, "load_number": f"LN{row['load_id']}00"},
                                                    {"doc_type": "invoice", "page_range": "3", "load_number": "LN100"}]}

    done = spark.createDataFrame([], "load_id string")
    run = process.process(files, pages, cache, done, extract, str(tmp_path / "a"))
    assert sorted(map(tuple, run.results.collect())) == [
        ("1", "ok", None), ("2", "invalid", "empty file (0 bytes)"), ("3", "invalid", "password-protected PDF"), ("4", "failed", "no page text"), ("6", "ok", None)]
    docs = nested.flatten_documents(run.bronze).orderBy("load_id", "doc_seq").collect()
    assert [(r.load_id, r.source_pdf, r.ocr_confidence, r.unverified_fields) for r in docs] == [
        ("1", "p/1/a.pdf", 0.7, ""), ("1", "p/1/a.pdf", 0.9, "load_number"), ("6", "p/6/a.pdf", 0.8, ""), ("6", "p/6/a.pdf", 0.8, "load_number")]
    assert sorted(r.load_id for r in run.new_pages.collect()) == ["1", "1"]
    assert summary.packet_mix(nested.flatten_documents(run.bronze)).count() == 2
    writers.write_packets(run.bronze, str(tmp_path / "b"), "v1")
    stored = readers.read_packets(spark, str(tmp_path / "b" / "extract_version=v1"))
    again = process.process(files, pages, cache, readers.done_loads(stored), extract, str(tmp_path / "c"))
    assert again.bronze.count() == 0 and sorted(r.load_id for r in again.quarantine.collect()) == ["2", "3", "4"]


def test_gold_tables_cover_silver(spark, sf_dir):
    docs = table(spark, sf_dir, "silver_documents")
    rows = gold.documents_classified(docs, table(spark, sf_dir, "accessorials"))
    parts = gold.rate_confirmations(rows).count() + gold.bills_of_lading(rows).count() + gold.other_documents(rows).count()
    assert parts + rows.filter("doc_type = 'proof_of_delivery'").count() == docs.count() == rows.count()


def test_load_reference_rules(spark):
    docs = spark.createDataFrame([
        ("1", 1, "rate_confirmation", "B", "R"), ("1", 2, "bill_of_lading", "A", None), ("2", 1, "rate_confirmation", None, "R2"),
        ("2", 2, "bill_of_lading", "A", None), ("3", 1, "bill_of_lading", "B", None), ("3", 2, "other", "A", None), ("3", 3, "other", "B", "x"),
        ("4", 1, "other", "B", None), ("4", 2, "other", "A", None), ("5", 1, "other", None, "R5"), ("6", 1, "rate_confirmation", " ", None),
    ], "load_id string, doc_seq int, doc_type string, load_number string, rc_number string")
    got = {r.load_id: (r.packet_load_number, r.source_rule, r.n_load_numbers) for r in gold.load_reference(docs).collect()}
    assert got == {"1": ("B", "rc_load_number", 2), "2": ("R2", "rc_number", 1), "3": ("B", "majority", 2), "4": ("A", "majority", 2),
                   "5": (None, None, 0), "6": (None, None, 0)}


def test_rate_rules_on_the_worked_examples(spark):
    docs = spark.createDataFrame([("1", 1, 6500.0, 5415.2, 1084.8), ("1", 2, 3500.0, None, None), ("1", 3, 3500.0, 3500.0, None), ("1", 4, None, 10.0, None),
                                  ("1", 5, 100.0, 60.0, 20.0)], "load_id string, doc_seq int, rate_total double, line_haul double, fuel_surcharge double")
    charges = spark.createDataFrame([("1", 5, "lumper", 20.0), ("1", 1, "other", None)], "load_id string, doc_seq int, type string, amount double")
    rows = gold.with_breakdown_conflict(gold.with_rate_clean(docs), charges).orderBy("doc_seq").collect()
    assert [(r.line_haul_clean, r.rate_is_all_in, r.rate_breakdown_conflict) for r in rows] == [
        (5415.2, False, False), (None, True, False), (None, True, False), (10.0, None, False), (60.0, False, False)]
    assert gold.with_breakdown_conflict(gold.with_rate_clean(docs), None).filter("rate_breakdown_conflict").count() == 1


def test_copies_of_one_bill_count_once(spark):
    docs = spark.createDataFrame([
        ("1", 1, "bill_of_lading", "B1", False, 10), ("1", 2, "bill_of_lading", "B1", True, 9), ("1", 3, "bill_of_lading", None, None, 4),
        ("1", 4, "bill_of_lading", None, None, 5), ("2", 1, "rate_confirmation", "B1", None, 7), ("3", 1, "other", None, None, 1)],
        "load_id string, doc_seq int, doc_type string, bol_number string, is_signed_delivery_copy boolean, pieces int")
    docs = docs.selectExpr("*", "'N' packet_load_number", "12.5D rate_total", "'2024-01-02' delivery_date")
    got = {r.load_id: (r.n_rc, r.n_bol, r.n_pod, r.bol_pieces, r.rate_cents) for r in gold.load_overview(docs).collect()}
    assert got == {"1": (0, 4, 1, 18, None), "2": (1, 0, 0, None, 1250)}


def test_loads_without_calls_and_results_without_status(spark):
    docs = spark.createDataFrame([("1", 1, "other", "1", False, 0.5, "", 0, 0)],
        "load_id string, doc_seq int, doc_type string, page_range string, is_signed_delivery_copy boolean, ocr_confidence double, "
        "unverified_fields string, n_stops long, n_accessorials long")
    calls = spark.createDataFrame([], "load_id string, pages int, out_tokens long, think_tokens long, ocr_cached boolean")
    assert [r.detail for r in summary.packet_detail(docs, calls).collect()] == ["other:1p | ocr0.50 | out0 | think0"]
    row = usage.run_status(spark.createDataFrame([("ok",), ("invalid",), (None,), ("odd",)], "status string"), F.lit(4), 60.0).first()
    assert (row.ok, row.invalid, row.failed, row.done) == (1, 1, 2, 4)


def test_children_are_counted_per_document(spark, sf_dir):
    rows = _with_children(spark, sf_dir)
    docs = rows.select("load_id", "doc_seq")
    for child, column in [("packet_stops", "n_stops"), ("packet_accessorials", "n_accessorials")]:
        owned = table(spark, sf_dir, child).join(docs, ["load_id", "doc_seq"], "left_semi").count()
        assert rows.agg(F.sum(column)).first()[0] == owned
