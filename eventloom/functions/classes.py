"""Event classes, labels and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Watts per square metre of class letter times one.
CLASS_SCALE = {"A": 1e-8, "B": 1e-7, "C": 1e-6, "M": 1e-5, "X": 1e-4}
LABEL_FIELDS = "magnitude: string, id: bigint, NOAA_AR: bigint, narn_source: string, verification: string"
NO_LABEL = "None"
LOWEST_CLASS = "A1.0"
VERIFIED = ("Primary", "Secondary")


def class_letter(col: Column, merge: dict[str, str] | None = None) -> Column:
    """First character of a class, with optional merging such as ``{"A": "B", "X": "M"}``."""
    letter = F.substring(col, 1, 1)
    out = letter
    for source, target in (merge or {}).items():
        out = F.when(letter == source, target).otherwise(out)
    return out


def class_to_flux(col: Column) -> Column:
    """``M1.3`` to 1.3e-5; NULL for text that is not a class."""
    letter = F.substring(col, 1, 1)
    scale = F.lit(None).cast("double")
    for name, value in CLASS_SCALE.items():
        scale = F.when(letter == name, F.lit(value)).otherwise(scale)
    return F.substr(col, F.lit(2)).try_cast("double") * scale


def flux_to_class(col: Column) -> Column:
    """Flux to class text with one decimal; below A stays A, above X stays X."""
    text = F.lit(None).cast("string")
    for name, value in CLASS_SCALE.items():
        scaled = F.format_string("%s%.1f", F.lit(name), F.round(col / value, 1))
        text = F.when(col >= value, scaled).otherwise(text) if name != "A" else F.when(col > 0, scaled)
    return text


def class_prefix(col: Column, prefix: str) -> Column:
    """Class starts with ``B``, ``C1`` or ``C2.3``."""
    return F.startswith(col, F.lit(prefix))


def class_compare(col: Column, op: str, threshold: str, order: str = "text") -> Column:
    """Class against a threshold, as text (default) or by flux."""
    left, right = (col, F.lit(threshold)) if order == "text" else (class_to_flux(col), class_to_flux(F.lit(threshold)))
    return {">": left > right, ">=": left >= right, "<": left < right, "<=": left <= right}[op]


def verification_tag(primary: Column, secondary: Column) -> Column:
    """Primary before Secondary before Non-verified."""
    return F.when(primary, "Primary").when(secondary, "Secondary").otherwise("Non-verified")


def build_label(magnitude: Column, event_id: Column, region: Column, source: Column, verification: Column) -> Column:
    """JSON text of one event, missing values written as null."""

    def quoted(value: Column) -> Column:
        return F.coalesce(F.concat(F.lit('"'), value, F.lit('"')), F.lit("null"))

    return F.concat(
        F.lit('{"magnitude": '), quoted(magnitude),
        F.lit(', "id": '), F.coalesce(event_id.cast("string"), F.lit("null")),
        F.lit(', "NOAA_AR": '), F.coalesce(region.cast("string"), F.lit("null")),
        F.lit(', "narn_source": '), quoted(source),
        F.lit(', "verification": '), quoted(verification), F.lit("}"),
    )


def parse_label_max(
    text: Column, with_verification: bool = False, compat_last_verification: bool = False
) -> Column:
    """``mag@id`` or ``mag@id:verification`` of the greatest event in a ``;``-joined label text.

    The first of equal magnitudes wins; ``None`` passes through; NULL when nothing exceeds A1.0.
    """
    joined = F.concat(F.lit("["), F.replace(text, F.lit("};{"), F.lit("},{")), F.lit("]"))
    events = F.from_json(F.when(text != NO_LABEL, joined), f"array<struct<{LABEL_FIELDS}>>")

    def ranked(event: Column, index: Column) -> Column:
        shown = F.concat(event["magnitude"], F.lit("@"), event["id"].cast("string"))
        if with_verification and not compat_last_verification:
            shown = F.concat(shown, F.lit(":"), event["verification"])
        entry = F.struct(event["magnitude"].alias("m"), (-index).alias("i"), shown.alias("label"))
        return F.when(event["magnitude"] > LOWEST_CLASS, entry)

    best = F.array_max(F.transform(events, ranked))["label"]
    if with_verification and compat_last_verification:
        best = F.concat(best, F.lit(":"), F.element_at(events, -1)["verification"])
    return F.when(text == NO_LABEL, NO_LABEL).otherwise(best)


def best_label(magnitude: Column, event_id: Column, verification: Column) -> Column:
    """Sort key and text of an event for the maximum that ``parse_label_max`` would find; NULL up to A1.0."""
    shown = F.concat(magnitude, F.lit("@"), event_id.cast("string"), F.lit(":"), verification)
    return F.when(magnitude > LOWEST_CLASS, F.struct(magnitude.alias("m"), (-event_id).alias("i"), shown.alias("label")))


def is_verified(label: Column) -> Column:
    """Label text ends with a verification that counts."""
    return F.coalesce(F.endswith(label, F.lit(VERIFIED[0])) | F.endswith(label, F.lit(VERIFIED[1])), F.lit(False))


def verified_only(label: Column) -> Column:
    """The label where it is verified, else NULL."""
    return F.when(is_verified(label), label)


def is_flaring(name: Column, marker: str = "_flare_") -> Column:
    """Sample name carries the event marker."""
    return F.contains(name, F.lit(marker))
