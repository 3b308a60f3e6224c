"""Scalar functions on worked examples and edge cases."""

import pytest
from pyspark.sql import functions as F

from packetmill.functions import ids, imaging, page_ranges, parsing, text, triage
from packetmill.operators import conformance, gold


def evaluate(spark, values, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


RANGES = {
    "1-2": [1, 2], "3": [3], "1,3": [1, 3], "1 - 2": [1, 2], " 2 , 4-5 ": [2, 4, 5], "3-1": [], "-3": [], "1-2-3": [],
    "a-b": [], "x": [], "": [], None: [], "1,1,1-2": [1, 1, 1, 2], "0-2": [0, 1, 2], "2-": [], "1_0-1_2": [10, 11, 12],
    "+1-2": [1, 2], "1.5": [], "007": [7], "\t4\n": [4], "1,,2": [1, 2],
}


def test_page_ranges(spark):
    assert evaluate(spark, list(RANGES), "string", page_ranges.parse_page_range) == list(RANGES.values())


def test_huge_ranges_are_counted_and_clipped_without_listing(spark):
    df = spark.createDataFrame([("1-999999999999", 3), ("2-99999999999999999999", 3), ("99999999999999999999", 3)], "r string, n int")
    spans = page_ranges.page_spans(F.col("r"))
    rows = df.select(page_ranges.named_pages(F.col("r")), page_ranges.clip_spans(spans, F.col("n"))).collect()
    assert [int(r[0]) for r in rows] == [999999999999, 99999999999999999998, 1]
    assert [[tuple(s) for s in r[1]] for r in rows] == [[(1, 3)], [(2, 3)], []]


def test_no_cell_ends_the_job(spark):
    nines = "9" * 36
    cells = [",".join([f"0-{nines}"] * 12), ",".join([f"0-{nines}"] * 300), "1-9999999999", "1-" + "9" * 40, "1-2," * 2000 + "3", "9" * 500]
    assert [None if x is None else int(x) for x in evaluate(spark, cells, "string", page_ranges.named_pages)] == [
        12 * 10**36, None, 9999999999, None, 4001, None]
    listed = evaluate(spark, cells, "string", page_ranges.parse_page_range)
    assert [x is None for x in listed] == [True, True, True, True, False, True] and len(listed[4]) == 4001


def test_list_pages_in_runs(spark, monkeypatch):
    monkeypatch.setattr(page_ranges, "RUN", 3)
    df = spark.createDataFrame([(1, "1-8,2"), (2, "5")], "id int, r string").withColumn("spans", page_ranges.page_spans(F.col("r")))
    rows = page_ranges.list_pages(df.select("id", "spans")).orderBy("id", "span_no", "page_no").collect()
    assert [(r.id, r.span_no, r.run, r.page_no) for r in rows] == [
        (1, 0, 1, 1), (1, 0, 1, 2), (1, 0, 1, 3), (1, 0, 4, 4), (1, 0, 4, 5), (1, 0, 4, 6), (1, 0, 7, 7), (1, 0, 7, 8),
        (1, 1, 2, 2), (2, 0, 5, 5),
    ]


def test_norm(spark):
    given = {"$1,850.00": "185000", "ABC-12 é": "abc12", "": "", None: None, "İx": "ix", "--": ""}
    assert evaluate(spark, list(given), "string", text.norm) == list(given.values())


def test_norm_number_writes_numbers_as_a_person_does(spark):
    values = [6500.0, 5415.2, 0.0, -12.5, 1e7, 12345678.25, 0.1, 0.30000000000000004, 0.001, 0.00012, 0.0001, 1.5e-5, 1e-7,
              2.5e-10, 1e15, 9007199254740992.0, 1600.0, 99999999.99, 3.0e-5, 0.005, -0.25]

    def plain(x):
        shown = str(int(x)) if x.is_integer() else str(x)
        return "".join(c for c in shown.lower() if c.isascii() and c.isalnum())

    assert evaluate(spark, values, "double", text.norm_number) == [plain(v) for v in values]


def test_blank(spark):
    assert evaluate(spark, [" \n\t", "", " ", " a "], "string", text.is_blank) == [True, True, True, False]


def test_ids(spark):
    paths = ["raw/loads/123/a.pdf", "raw/loads/X9/b/c.pdf", "raw/loads/solo"]
    assert evaluate(spark, paths, "string", lambda c: ids.load_id(c, "raw/loads/")) == ["123", "X9", "solo"]
    keys = evaluate(spark, ["123", "X9", "", "-4", "12345678901234567890123"], "string", ids.load_sort_key)
    assert [int(k) for k in keys] == [123, -1, -1, -1, 12345678901234567890123]


def test_triage_order(spark):
    df = spark.createDataFrame([(0, False, True, 0), (5, False, True, 0), (5, True, True, 0), (5, True, False, 0), (5, True, False, 2)],
                               "l long, o boolean, p boolean, n int")
    reasons = [r[0] for r in df.select(triage.triage_reason(F.col("l"), F.col("o"), F.col("p"), F.col("n"))).collect()]
    assert reasons == ["empty file (0 bytes)", "cannot open as PDF", "password-protected PDF", "PDF has 0 pages", None]


def test_transient(spark):
    rows = [("ClientError", 429, True), ("ClientError", 400, False), ("ClientError", None, False), ("ServerError", 503, True),
            ("ResourceExhausted", None, True), ("ValueError", 429, False), (None, 429, False)]
    df = spark.createDataFrame(rows, "c string, code int, want boolean")
    assert df.filter(triage.is_transient(F.col("c"), F.col("code")) != F.col("want")).count() == 0


ZOOMS = {  # width and height -> zoom: the long edge becomes 1536, at most four times its size, and no edge less than one
    (612.0, 792.0): 1536 / 792, (100.0, 90.0): 4.0, (9000.0, 2.0): 0.5, (0.0, 0.0): 100.0, (20000.0, 0.001): 100.0, (1536.0, 1.0): 1.0,
}


def test_page_zoom(spark):
    df = spark.createDataFrame(list(ZOOMS), "w double, h double")
    got = [r[0] for r in df.select(imaging.page_zoom(F.col("w"), F.col("h"))).collect()]
    assert got == pytest.approx(list(ZOOMS.values()))


MONEY = {"$2,045.50": 2045.5, "975": 975.0, "-12.25": -12.25, " $ 80 ": 80.0, "1 200.00": 1200.0, "USD 5": None, "5 to 6": None, "": None, None: None, "$": None}

WEIGHTS = {
    "18,204 LBS": (18204.0, "lb"), "18204": (18204.0, None), "1,204.5 kg": (1204.5, "kg"), "44,000 LBS (19,958 KG)": (44000.0, "lb"),
    "19,958 KG / 44,000 LB": (44000.0, "lb"), "QTY 12 / 18,204 LBS": (18204.0, "lb"), "12 CTN 900 KGS": (900.0, "kg"), "650#": (650.0, "lb"),
    "40 #": (40.0, "lb"), "7 pounds": (7.0, "lb"), "bulbs": (None, None), "12 Kilograms": (12.0, "kg"), "3 kilos": (3.0, "kg"), "GW: 1204KGS": (1204.0, "kg"),
    "2 skids, 900kg net": (900.0, "kg"), "1.5lb": (1.5, "lb"), "": (None, None), None: (None, None), "lbs": (None, None), "12,34 lbs": (12.0, None),
    "PO 4411 weight 8,000 pounds": (8000.0, "lb"), "1,000,000 lb": (1000000.0, "lb"), "5 kgf": (5.0, None), "9 lbm": (9.0, None),
    "TARE 15,000 GROSS 48,000": (15000.0, None), "0 LBS": (0.0, "lb"), "weight tbd": (None, None), "36000LB": (36000.0, "lb"),
    "kg 500": (500.0, None), "20 ft / 21,000 Lbs.": (21000.0, "lb"),
}

PALLETS = {
    "PAPER ROLLS, 7 PLTS": 7, "22 PALLETS": 22, "pallets: 12": 12, "4 Skid": 4, "20plts": 20, "30 CTNS": None, None: None, "": None, "Skids = 6": 6,
    "18 x pallets": 18, "PALLET COUNT 9": 9, "plt# 3": 3, "1,200 PALLETS": None, "26 pallet spaces": 26, "PALLETS": None, "12 CTNS ON 2 PALLETS": 2,
    "2 pallets 5 skids": 2, "0 skids": 0, "pallets 12": None, "palletized 5": None, "5 palletized": None, "3.5 pallets": None, "SKIDS: 14 / 2 PLT": 2,
    "24 PLT STC 480 CASES": 24, "PLTS qty 8": 8, "99999999999 pallets": None, "7\nPALLETS": 7, "08 PLTS": 8, "x16 plts": 16, "(16 plts)": 16,
}

EQUIPMENT = {
    "28' Pup Van": ("dry_van", 28, None, None), "V": ("dry_van", None, None, None), "vans": ("dry_van", None, None, None),
    "REEFER 28F continuous": ("reefer", None, 28.0, "continuous"), "53 feet flat bed": ("flatbed", 53, None, None),
    "45 ft reefer set at -10 C cycle": ("reefer", 45, 14.0, "cycle"), "refrigerated 36 degrees": ("reefer", None, 36.0, None),
    "StepDeck": ("step_deck", None, None, None), "RGN": ("other", None, None, None), None: (None, None, None, None),
    "48' Flatbed w/ tarp temp N/A": ("flatbed", 48, None, None), "53-ft Van": ("dry_van", 53, None, None), "40-foot container": ("container", 40, None, None),
    "temp controlled van": ("reefer", None, None, None), "Van, temporary plates": ("dry_van", None, None, None), "Tanker 6000 gal": ("tanker", None, None, None),
    "thank you": ("other", None, None, None), "power only": ("power_only", None, None, None), "POWER-ONLY": ("power_only", None, None, None),
    "Van or Reefer": ("reefer", None, None, None), "53' VAN 0 deg F": ("dry_van", 53, 0.0, None), "reefer 2.5C": ("reefer", None, 36.5, None),
    "Flat-bed 48ft": ("flatbed", 48, None, None), "step - deck 53’": ("step_deck", 53, None, None), "": ("other", None, None, None),
    "100' crane": ("other", None, None, None), "caravan": ("other", None, None, None), "temp set -5F": ("reefer", None, -5.0, None),
    "Reefer +34F": ("reefer", None, 34.0, None), "container 20 ft": ("container", 20, None, None), "53' DV Cycle-Sentry": ("other", 53, None, "cycle"),
}


def test_money(spark):
    assert dict(zip(MONEY, evaluate(spark, list(MONEY), "string", parsing.parse_money))) == MONEY


def test_weight(spark):
    amounts, units = (evaluate(spark, list(WEIGHTS), "string", f) for f in (parsing.parse_weight, parsing.parse_weight_unit))
    assert dict(zip(WEIGHTS, zip(amounts, units))) == WEIGHTS


def test_pallet_text(spark):
    assert dict(zip(PALLETS, evaluate(spark, list(PALLETS), "string", parsing.parse_pallet_text))) == PALLETS


def test_equipment(spark):
    functions = [parsing.equipment_class, parsing.equipment_length_ft, parsing.temperature_setpoint_f, parsing.temperature_mode]
    got = zip(*[evaluate(spark, list(EQUIPMENT), "string", f) for f in functions])
    assert dict(zip(EQUIPMENT, got)) == EQUIPMENT


def test_doc_type(spark):
    given = {"Rate Confirmation": "rate_confirmation", "LOAD SHEET": "rate_confirmation", "Carrier-Confirmation": "rate_confirmation",
             "packing slip": "packing_list", "Rate Confirmation:": "rate_confirmation", "(Load Sheet)": "rate_confirmation", " - INVOICE - ": "invoice",
             "Bill of Lading #": "bill_of_lading", "Proof-of-Delivery.": "proof_of_delivery", "*": "other", "": "other", "Packing List (2)": "other", "invoice": "invoice", "weird": "other", None: "other"}
    assert evaluate(spark, list(given), "string", gold.doc_type_of) == list(given.values())


def test_carrier_key(spark):
    rows = [("USDOT 12-3", "MC-9", "ABCD", "X", "DOT:123"), ("n/a", "MC-9", "ABCD", "X", "MC:9"), (None, "", " abcd ", "X", "SCAC:ABCD"),
            (None, None, " ", " Big  Rig, Co., Inc. ", "NAME:BIG RIG"), (None, None, None, "--", None)]
    df = spark.createDataFrame(rows, "dot string, mc string, scac string, name string, want string")
    key = gold.carrier_key(*(F.col(c) for c in ["dot", "mc", "scac", "name"]))
    assert df.filter(~key.eqNullSafe(F.col("want"))).count() == 0


@pytest.mark.parametrize("value,good", [("2024-02-29", True), ("2023-02-29", False), ("2020-13-45", False), ("01/08/2020", False),
                                        ("2020-1-8", False), (" 2020-01-08", False)])
def test_is_date(spark, value, good):
    assert evaluate(spark, [value], "string", conformance.is_date) == [good]


def test_long_ranges_are_listed_in_rows(spark):
    """One long range nulls nothing: its cell's pages come as rows, beyond what an array would hold."""
    cells = [(1, "1-3, 5-2000004"), (2, "7"), (3, "x"), (4, None), (5, "3-4,1-99999999999999999999,2,2"), (6, "4-99999999999999999999")]
    df = spark.createDataFrame(cells, "id int, page_range string")
    rows = page_ranges.list_named(df)
    small = rows.filter("id <> 1").select("id", "place", "page_no")
    assert sorted(map(tuple, small.collect()), key=str) == sorted(
        [(2, 0, 7), (3, None, None), (4, None, None), (5, 0, 3), (5, 1, 4), (5, 2, 2), (5, 3, 2), (6, None, None)], key=str)
    long = rows.filter("id = 1").agg(F.count("*"), F.countDistinct("page_no"), F.max("place"), F.min("page_no"), F.max("page_no"),
                                    F.bool_and((F.col("place") < 3) == (F.col("page_no") <= 3))).first()
    assert tuple(long) == (2_000_003, 2_000_003, 2_000_002, 1, 2_000_004, True)
