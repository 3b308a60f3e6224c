"""Rows that break the declared value sets, required fields and formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from packetmill import schemas

ENUMS = {
    "loads": {},
    "documents": {
        "doc_type": schemas.DOC_TYPES,
        "weight_unit": schemas.WEIGHT_UNITS,
        "equipment_class": schemas.EQUIPMENT_CLASSES,
        "temperature_mode": schemas.TEMPERATURE_MODES,
        "osd_code": schemas.OSD_CODES,
    },
    "stops": {"stop_type": schemas.STOP_TYPES, "appt_type": schemas.APPT_TYPES},
    "accessorials": {"type": schemas.ACCESSORIAL_TYPES},
    "references": {"ref_type": schemas.REF_TYPES},
}
REQUIRED = {
    "packet": ["packet_summary", "documents"],
    "documents": ["doc_type", "page_range"],
    "loads": ["packet_summary"],
    "stops": ["sequence", "stop_type"],
    "accessorials": ["type"],
    "references": ["ref_type", "value"],
}
DATES = {"documents": ["delivery_signed_date", "pickup_date", "delivery_date"], "stops": ["scheduled_date"]}
TIMES = {
    "documents": ["pickup_appt_start", "pickup_appt_end", "delivery_appt_start", "delivery_appt_end"],
    "stops": ["appt_start", "appt_end"],
}
TIME_FORMAT = r"^([01]\d|2[0-3]):[0-5]\d$"
DATE_FORMAT = r"^\d{4}-\d{2}-\d{2}$"


def is_date(text: Column) -> Column:
    """A real calendar day written YYYY-MM-DD."""
    return text.rlike(DATE_FORMAT) & F.try_to_date(text, "yyyy-MM-dd").isNotNull()


def _enum(value: Column, allowed: list[str]) -> Column:
    return value.isNotNull() & ~value.isin(allowed)


def _field_faults(record: Column, kind: str, schema: T.StructType, where: Column) -> list[Column]:
    """Per broken rule of one record a text ``<where><field>: <rule>``, else null."""
    def fault(field: str, rule: str, broken: Column) -> Column:
        return F.when(broken, F.concat(where, F.lit(f"{field}: {rule}")))

    whole = [f.name for f in schema.fields if isinstance(f.dataType, T.IntegerType) and f.name != "doc_seq"]
    limit = 2**31
    return [
        *[fault(f, "required", record[f].isNull()) for f in REQUIRED[kind]],
        *[fault(f, "enum", _enum(record[f], allowed)) for f, allowed in ENUMS[kind].items()],
        *[fault(f, "whole number", record[f].isNotNull() & ((record[f] % 1 != 0) | (F.abs(record[f]) >= limit))) for f in whole],
    ]


def packet_faults(packet: Column) -> Column:
    """All broken rules of a leniently read packet, in the order of its fields.

    These are the rules without which a record is not accepted: required fields of the packet, its
    documents and their children, enumerated values, and whole numbers where these are declared.
    """
    def place(name: str, i: Column) -> Column:
        return F.concat(F.lit(f"{name}["), i.cast("string"), F.lit("]."))

    def of_child(name: str, where: Column):
        return lambda c, j: F.array_compact(F.array(
            F.when(c.isNull(), F.concat(where, place(name, j), F.lit("required"))),
            *_field_faults(c, name, schemas.CHILDREN[name], F.concat(where, place(name, j)))))

    def of_document(d: Column, i: Column) -> Column:
        where = place("documents", i)
        own = F.array_compact(F.array(*_field_faults(d, "documents", schemas.DOCUMENT, where)))
        children = [F.flatten(F.transform(F.coalesce(d[n], F.array()), of_child(n, where))) for n in schemas.CHILDREN]
        return F.concat(own, *children)

    top = F.array_compact(F.array(*[
        F.when(packet[f].isNull(), F.lit(f"{f}: required")) for f in REQUIRED["packet"]]))
    documents = F.flatten(F.transform(F.coalesce(packet["documents"], F.array()), of_document))
    return F.concat(top, documents)


def violations(rows: DataFrame, kind: str = "documents") -> DataFrame:
    """``load_id, doc_seq, field, value, rule``: one row per broken rule.

    ``kind`` says which declaration applies; fields the table lacks are not checked. All rules are
    tested in one pass over the rows. ``loads`` are rows of one load each, without ``doc_seq``.
    """
    if kind == "loads":
        rows = rows.withColumn("doc_seq", F.lit(None).cast("int"))
    def broken(field: str, rule: str, condition: Column) -> Column:
        found = F.struct(
            F.lit(field).alias("field"), F.col(field).cast("string").alias("value"), F.lit(rule).alias("rule")
        )
        return F.when(condition, found)

    checks = [
        broken(f, "enum", F.col(f).isNotNull() & ~F.col(f).isin(allowed))
        for f, allowed in ENUMS[kind].items() if f in rows.columns
    ]
    checks += [broken(f, "required", F.col(f).isNull()) for f in REQUIRED[kind] if f in rows.columns]
    checks += [
        broken(f, "date", F.col(f).isNotNull() & ~is_date(F.col(f)))
        for f in DATES.get(kind, []) if f in rows.columns
    ]
    checks += [
        broken(f, "time", F.col(f).isNotNull() & ~F.col(f).rlike(TIME_FORMAT))
        for f in TIMES.get(kind, []) if f in rows.columns
    ]
    if kind == "loads" and "n_documents" in rows.columns:
        checks.append(broken("n_documents", "required", F.coalesce(F.col("n_documents"), F.lit(0)) == 0))
    found = F.filter(F.array(*checks), lambda v: v.isNotNull())
    return rows.select("load_id", "doc_seq", F.explode(found).alias("v")).select("load_id", "doc_seq", "v.*")
