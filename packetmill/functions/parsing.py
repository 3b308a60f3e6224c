"""Values read from printed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"


def _group(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def parse_money(text: Column) -> Column:
    """``$ 2,045.50`` -> 2045.5; null when no plain number is left."""
    bare = F.regexp_replace(text, r"[$,\s]", "")
    return F.when(bare.rlike(rf"^{_NUMBER}$"), bare.try_cast("double"))


# A number with or without separators, and the unit words after it.
_AMOUNT = r"((?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?)"
_POUNDS = rf"(?i)(?<![0-9.,]){_AMOUNT}\s*(?:#|(?:lbs?|pounds?)\b)"
_KILOS = rf"(?i)(?<![0-9.,]){_AMOUNT}\s*(?:kgs?|kilos?|kilograms?)\b"


def parse_weight(text: Column) -> Column:
    """The weight as printed: ``GW 1,204 KGS`` -> 1204.0.

    A number with a unit goes before one without, and pounds before kilograms, so number and unit
    (``parse_weight_unit``) are always of one mention.
    """
    amount = F.coalesce(_group(text, _POUNDS), _group(text, _KILOS), _group(text, _AMOUNT))
    return F.regexp_replace(amount, ",", "").try_cast("double")


def parse_weight_unit(text: Column) -> Column:
    """``lb`` or ``kg`` of the mention that ``parse_weight`` reads, else null."""
    return F.when(text.rlike(_POUNDS), "lb").when(text.rlike(_KILOS), "kg")


def parse_pallet_text(text: Column) -> Column:
    """``PAPER ROLLS, 7 PLTS`` -> 7; ``PALLETS: 12`` -> 12."""
    before = _group(text, r"(?i)(?<![0-9.,])([0-9]{1,9})\s*(?:x\s*)?(?:pallets?|plts?|skids?)\b")
    after = _group(text, r"(?i)\b(?:pallets?|plts?|skids?)\s*(?::|=|#|qty|count)\s*([0-9]{1,9})\b")
    return F.coalesce(before, after).try_cast("int")


def equipment_class(raw: Column) -> Column:
    text = F.lower(F.trim(raw))
    return (
        F.when(raw.isNull(), None)
        # Named equipment first; only then words that merely suggest it.
        .when(text.rlike(r"reefer|refrig"), "reefer")
        .when(text.rlike(r"step[ -]*deck"), "step_deck")
        .when(text.rlike(r"flat[ -]*bed"), "flatbed")
        .when(text.rlike(r"power[ -]*only"), "power_only")
        .when(text.rlike(r"container"), "container")
        .when(text.rlike(r"\btank"), "tanker")
        .when(text.rlike(r"\btemp(?:erature)?[ -]*control"), "reefer")
        .when(text.rlike(r"\bvans?\b|^v$"), "dry_van")
        .when(text.rlike(r"\btemp(?:erature)?\b\W*(?:set|at|-?[0-9])"), "reefer")
        .otherwise("other")
    )


def equipment_length_ft(raw: Column) -> Column:
    """``40-foot container`` -> 40, ``28' pup`` -> 28."""
    return _group(raw, r"(?i)(?<![0-9.])([0-9]{2})[\s-]*(?:['’]|ft\b|feet\b|foot\b)").try_cast("int")


def temperature_setpoint_f(raw: Column) -> Column:
    """``+5F`` -> 5.0, ``28 degrees`` -> 28.0; Celsius is converted."""
    marked = r"(?i)((?<![0-9])-?[0-9]+(?:\.[0-9]+)?)\s*(?:(?:°|deg(?:rees?)?)\s*(f|c)?|(f|c))(?:ahrenheit|elsius)?(?![a-z])"
    degrees = _group(raw, marked, 1).try_cast("double")
    unit = F.lower(F.concat(F.regexp_extract(raw, marked, 2), F.regexp_extract(raw, marked, 3)))
    return F.when(unit == "c", degrees * 9 / 5 + 32).otherwise(degrees)


def temperature_mode(raw: Column) -> Column:
    return F.when(raw.rlike("(?i)continuous"), "continuous").when(raw.rlike("(?i)cycle"), "cycle")
