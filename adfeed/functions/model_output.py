"""Typed reading of an extractor's JSON answer.

Each field is tested against the type the answer really has before it is cast:
a plain ``from_json`` would turn a wrong type into NULL and keep the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adfeed.functions.binding import let
from adfeed.functions.checks import non_negative

# Texts accepted where a boolean is expected.
TRUE_TEXTS = ["1", "t", "true", "y", "yes", "on"]
FALSE_TEXTS = ["0", "f", "false", "n", "no", "off"]

# field -> (kind, required, value where the field is absent)
FIELDS = {
    "est_une_annonce_valide": ("boolean", True),
    "type_bien": ("string", True),
    "quartier_zone": ("nullable string", False),
    "superficie_m2": ("nullable integer", False),
    "prix_fcfa": ("nullable integer", False),
    "statut_document": ("nullable string", False),
    "contacts_whatsapp": ("string list", False),
    "mots_cles_pertinents": ("string list", False),
    "resume_court": ("string", False),
}
NOT_NEGATIVE = ("superficie_m2", "prix_fcfa")
_OBJECT = r"(?s)^[ \t\r\n]*\{.*\}[ \t\r\n]*$"


def _read(raw: Column, kind: str, required: bool, strict: bool) -> tuple[Column, Column]:
    """(is the field acceptable, its typed value)."""

    def as_type(name: str) -> Column:
        return F.try_variant_get(raw, "$", name)

    found, text, absent = F.schema_of_variant(raw), as_type("string"), raw.isNull()
    is_text, is_bool = found == "STRING", found == "BOOLEAN"
    is_number = found.rlike(r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$")

    if kind == "boolean":
        value = as_type("boolean")
        ok = is_bool
        if not strict:
            number = as_type("double")
            value = (
                F.when(is_bool, value)
                .when(is_number, number == 1)
                .when(is_text, F.lower(text).isin(*TRUE_TEXTS))
            )
            ok = is_bool | (is_number & number.isin(0.0, 1.0)) | (
                is_text & F.lower(text).isin(*TRUE_TEXTS, *FALSE_TEXTS)
            )
    elif kind == "nullable integer":
        # An integral decimal (600.0) counts as an integer, 600.5 does not.
        exact = as_type("decimal(38,10)")
        number = exact.try_cast("bigint")
        value = F.when(is_number, number)
        ok = is_number & number.isNotNull() & (exact == number)
        if not strict:
            digits = F.regexp_extract(text, r"(?U)^\s*([+-]?\d+(?:_\d+)*)(?:\.0+)?\s*$", 1)
            typed = F.replace(digits, F.lit("_"), F.lit("")).try_cast("bigint")
            value = F.when(is_number, number).when(is_bool, text.try_cast("boolean").cast("bigint")).when(is_text, typed)
            ok = ok | is_bool | (is_text & typed.isNotNull())
        ok = ok | (found == "VOID")
    elif kind == "string list":
        items = as_type("array<string>")
        value = F.when(absent, F.array().cast("array<string>")).otherwise(items)
        clean = F.coalesce(~F.exists(items, lambda item: item.isNull()), F.lit(False))
        ok = found.isin("ARRAY<STRING>", "ARRAY<VOID>") & clean
    elif kind == "nullable string":
        value, ok = F.when(is_text, text), is_text | (found == "VOID")
    else:
        value, ok = F.when(absent, F.lit("")).otherwise(text), is_text

    accepted = F.coalesce(ok, F.lit(False))
    return (accepted if required else absent | accepted), value


def validate_output(col: Column, strict: bool = False) -> Column:
    """The typed struct of a JSON answer; NULL where the answer breaks the contract.

    The two first fields are required, the others have defaults, unknown fields
    are ignored and negative numbers become NULL.  With ``strict`` every field
    must have its exact JSON type; otherwise the usual harmless conversions are
    accepted: "12", 12.0 and true for an integer, and 0/1 or "yes"/"no" words
    for a boolean.
    """
    schema = "array<struct<" + ", ".join(f"{name}: VARIANT" for name in FIELDS) + ">>"
    # As the only element of an array: anything after the object makes a second one, or no JSON.
    listed = F.from_json(F.concat(F.lit("["), col, F.lit("]")), schema)
    whole = F.when(col.rlike(_OBJECT), let(listed, lambda found: F.when(F.size(found) == 1, F.element_at(found, 1))))

    def typed(answer: Column) -> Column:
        accepted, fields = answer.isNotNull(), []
        for name, (kind, required) in FIELDS.items():
            ok, value = _read(answer[name], kind, required, strict)
            accepted = accepted & ok
            fields.append((non_negative(value) if name in NOT_NEGATIVE else value).alias(name))
        return F.when(accepted, F.struct(*fields))

    return let(whole, typed)
