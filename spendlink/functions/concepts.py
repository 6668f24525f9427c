"""Readers of concept-service answers: JSON code lists and XML concept groups, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONCEPT_GROUPS = (
    "allRelatedGroup STRUCT<conceptGroup: ARRAY<STRUCT<"
    "tty: ARRAY<STRING>, "
    "conceptProperties: ARRAY<STRUCT<name: ARRAY<STRING>, inferedhuman: ARRAY<STRING>, inferedvet: ARRAY<STRING>>>"
    ">>>, malformed STRING"
)
XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "malformed",
    "ignoreSurroundingSpaces": "false",
}


def first_code(response: Column) -> Column:
    """``code`` of the first element of a JSON array, blank if there is none."""
    return F.coalesce(F.get_json_object(response, "$[0].code"), F.lit(""))


def _values_of(groups: Column, kind: str, field: str) -> Column:
    """All texts of one property field over the groups of one kind, in document order."""
    of_kind = F.filter(groups, lambda g: F.array_contains(g["tty"], kind))
    per_group = F.transform(
        of_kind,
        lambda g: F.flatten(F.transform(g["conceptProperties"], lambda p: F.coalesce(p[field], F.array()))),
    )
    return F.coalesce(F.flatten(F.filter(per_group, lambda a: a.isNotNull())), F.array().cast("array<string>"))


def concept_info(xml: Column) -> Column:
    """Struct of brand names, ingredient names and species tags. A malformed answer gives three empty arrays.

    The parsed answer is bound to a lambda variable: used by name in every field, it would be parsed once per use.
    """
    return F.transform(F.array(F.from_xml(xml, CONCEPT_GROUPS, XML_OPTIONS)), _info)[0]


def _info(parsed: Column) -> Column:
    sound = F.when(parsed["malformed"].isNull(), parsed["allRelatedGroup"]["conceptGroup"])
    groups = F.coalesce(sound, F.array())
    human = F.array_contains(_values_of(groups, "IN", "inferedhuman"), "US")
    animal = F.array_contains(_values_of(groups, "IN", "inferedvet"), "US")
    tags = F.array_compact(
        F.array(F.when(human, F.lit("Human_Drug")), F.when(animal, F.lit("Animal_Drug")))
    )
    return F.struct(
        _values_of(groups, "BN", "name").alias("brand_names"),
        _values_of(groups, "IN", "name").alias("ingredients"),
        F.sort_array(tags).alias("species_tags"),
    )
