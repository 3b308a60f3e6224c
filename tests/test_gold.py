"""Gold tables."""

import re

from pyspark.sql import functions as F

from packetmill.operators import gold


def test_whole_documents_travel_once(spark):
    docs = spark.createDataFrame(
        [("1", 1, "Load Sheet", "A", 100.0), ("1", 2, "invoice", "B", 100.0), ("1", None, "invoice", "B", 100.0), (None, 1, "invoice", "C", 100.0),
         ("2", 1, "invoice", None, 100.0), ("2", 1, "Load Sheet", None, 100.0)],
        "load_id string, doc_seq int, doc_type_raw string, load_number string, rate_total double").withColumns({
            "commodity": F.lit("12 PLTS of goods"), "carrier_name": F.lit("X"), "pickup_date": F.lit("2024-01-01"), "delivery_date": F.lit("2024-01-02"),
            "line_haul": F.lit(60.0), "fuel_surcharge": F.lit(None).cast("double"), "weight": F.lit(1.0), "weight_unit": F.lit("kg"),
            "miles": F.lit(2.0), "pieces": F.lit(3), "pieces_received": F.lit(3)})
    charges = spark.createDataFrame([("1", 1, 30.0), ("1", 1, 10.0), ("1", None, 40.0), (None, 1, 40.0), ("2", 1, 39.0), ("9", 1, 1.0)], "load_id string, doc_seq int, amount double")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "1000"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = gold.documents_classified(docs, charges)
        plan = rows._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert len(re.findall(r"\) Exchange\nInput \[\d+\]: [^\n]*doc_type_raw#", plan)) == 1
        got = sorted(map(str, map(tuple, rows.select("load_id", "doc_seq", "packet_load_number", "accessorial_cents", "rate_breakdown_conflict").collect())))
        assert got == sorted(map(str, [
            ("1", 1, "A", 4000, False), ("1", 2, "A", 0, True), ("1", None, "A", 0, True), (None, 1, None, 0, True),
            ("2", 1, None, 3900, True), ("2", 1, None, 3900, True)]))
        only = gold.documents_classified(docs, charges, of=F.col("doc_type") == "rate_confirmation")
        assert rows.columns == only.columns and sorted(map(str, only.collect())) == sorted(map(str, rows.filter("doc_type = 'rate_confirmation'").collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
