"""Declared record schemas and value sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The allowed values of each enumerated field.
DOC_TYPES = [
    "rate_confirmation", "bill_of_lading", "proof_of_delivery", "invoice", "lumper_receipt",
    "packing_list", "other",
]
WEIGHT_UNITS = ["lb", "kg"]
EQUIPMENT_CLASSES = [
    "dry_van", "reefer", "flatbed", "step_deck", "power_only", "container", "tanker", "other",
]
TEMPERATURE_MODES = ["continuous", "cycle"]
OSD_CODES = ["clear", "shortage", "overage", "damage", "refused"]
STOP_TYPES = ["pickup", "delivery"]
APPT_TYPES = ["appointment", "fcfs"]
ACCESSORIAL_TYPES = [
    "detention_pickup", "detention_delivery", "layover", "tonu", "lumper", "stop_off",
    "driver_assist", "tarp", "reconsignment", "unloading", "other",
]
REF_TYPES = [
    "po", "pickup", "delivery", "appointment", "customer", "trailer", "container", "seal", "other",
]

# The fields checked against the page text, in report order, and the fields that
# come with the verbatim text they were read from.
KEY_FIELDS = [
    "load_number", "pro_number", "bol_number", "order_number", "rc_number", "broker_mc",
    "carrier_mc", "carrier_dot", "carrier_scac", "rate_total", "line_haul", "fuel_surcharge",
    "weight",
]
NUMERIC_KEY_FIELDS = ["rate_total", "line_haul", "fuel_surcharge", "weight"]
EVIDENCE_FIELDS = {"rate_total": "rate_total_evidence", "weight": "weight_evidence"}


TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
}


def _struct(fields: str) -> T.StructType:
    """Build a struct from whitespace-separated ``name:type`` pairs."""
    pairs = (field.split(":") for field in fields.split())
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Names and types of the bronze record's fields.
STOP = _struct("""
    sequence:int stop_type:string name:string address:string city:string state:string zip:string
    scheduled_date:string appt_start:string appt_end:string appt_type:string
    reference_number:string
""")
ACCESSORIAL = _struct("type:string amount:double notes:string")
REFERENCE = _struct("ref_type:string value:string")
DOCUMENT_SCALARS = _struct("""
    doc_type:string page_range:string illegible:boolean is_signed_delivery_copy:boolean
    delivery_signed_date:string
    load_number:string pro_number:string bol_number:string order_number:string rc_number:string
    broker_name:string broker_mc:string carrier_name:string carrier_mc:string carrier_dot:string
    carrier_scac:string
    shipper_name:string shipper_address:string consignee_name:string consignee_address:string
    origin_city:string origin_state:string origin_zip:string
    destination_city:string destination_state:string destination_zip:string
    pickup_date:string delivery_date:string
    pickup_appt_start:string pickup_appt_end:string
    delivery_appt_start:string delivery_appt_end:string
    rate_total:double line_haul:double fuel_surcharge:double rate_is_all_in:boolean
    currency:string miles:double payment_net_days:int quick_pay_pct:double
    commodity:string weight:double weight_unit:string pieces:int pallet_count:int
    pallet_spaces:int equipment_class:string equipment_length_ft:int is_team:boolean
    equipment_type_raw:string temperature_setpoint_f:double temperature_mode:string
    freight_class:string hazmat:boolean seal_number:string
    delivered:boolean received_by:string signature_present:boolean exceptions_notes:string
    pieces_received:int osd_code:string
    rate_total_evidence:string weight_evidence:string
""")
CHILDREN = {"stops": STOP, "accessorials": ACCESSORIAL, "references": REFERENCE}
DOCUMENT = T.StructType(
    DOCUMENT_SCALARS.fields
    + [T.StructField(name, T.ArrayType(child)) for name, child in CHILDREN.items()]
    + [T.StructField("ocr_confidence", T.DoubleType()), T.StructField("unverified_fields", T.StringType())]
    # The document's number in its load; without it documents count by place.
    + [T.StructField("doc_seq", T.IntegerType())]
    # Of a document that runs over several records: its whole number of children, in the first of
    # its pieces, and the mark of the others, which hold further children only.
    + [T.StructField("n_stops", T.IntegerType()), T.StructField("n_accessorials", T.IntegerType()), T.StructField("continued", T.BooleanType())]
)
PIECE_FIELDS = ["n_stops", "n_accessorials", "continued"]
PACKET = T.StructType([
    T.StructField("load_id", T.StringType()),
    T.StructField("source_pdf", T.StringType()),
    T.StructField("packet_summary", T.StringType()),
    # Part of a packet with more documents than one record holds; 0 or absent otherwise.
    T.StructField("part_no", T.IntegerType()),
    T.StructField("documents", T.ArrayType(DOCUMENT)),
])
OCR_ENTRY = T.StructType([
    T.StructField("load_id", T.StringType()),
    T.StructField("full_text", T.StringType()),
    T.StructField("page_text", T.ArrayType(T.StringType())),
    T.StructField("page_conf", T.ArrayType(T.DoubleType())),
    # The pages' own numbers; absent where pages count by place.
    T.StructField("page_no", T.ArrayType(T.IntegerType())),
])


def as_declared(value: Column, declared: T.DataType) -> Column:
    """Turn leniently read doubles back into the declared whole numbers; fractions become null."""
    if isinstance(declared, T.StructType):
        fields = [as_declared(value[f.name], f.dataType).alias(f.name) for f in declared.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(declared, T.ArrayType):
        return F.transform(value, lambda x: as_declared(x, declared.elementType))
    if isinstance(declared, T.IntegerType):
        return F.when(value % 1 == 0, value.try_cast("int"))
    return value


def lenient(schema: T.DataType) -> T.DataType:
    """The same shape with whole numbers read as doubles, so that ``30.0`` is not lost."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, lenient(f.dataType)) for f in schema.fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(lenient(schema.elementType))
    return T.DoubleType() if isinstance(schema, T.IntegerType) else schema
