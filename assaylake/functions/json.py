"""Reading JSON held in VARIANT columns.

``shape`` pulls the named top-level members of a document as typed columns whose leaves stay
VARIANT, so each member is navigated once and Catalyst prunes members nobody reads. The leaf
functions then apply either the lax rules (scalars coerce, containers give NULL) or the strict
rule (only a JSON string is a string).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

INSTANT_PATTERN = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"
DAY_PATTERN = r"^\d{4}-\d\d-\d\d$"
DECIMAL = "decimal(38,9)"

# Words that mark an Observation category as laboratory, compared in lower case.
LABORATORY_WORDS = ("laboratory", "lab")


def shape(document: Column, members: Mapping[str, str]) -> list[Column]:
    return [F.try_variant_get(document, f"$.{name}", kind).alias(name) for name, kind in members.items()]


def json_path(document: Column, path: str, kind: str = "variant") -> Column:
    """Dotted navigation; members that are reserved words need no quoting."""
    return F.try_variant_get(document, f"$.{path}", kind)


def json_array(document: Column, path: str) -> Column:
    """The array at ``path``, or NULL when something else is there."""
    return json_path(document, path, "array<variant>")


def _is_container(leaf: Column) -> Column:
    return F.substring(F.schema_of_variant(leaf), 1, 5).isin("ARRAY", "OBJEC")


def text(leaf: Column) -> Column:
    """Lax string: numbers and booleans coerce, arrays and objects give NULL."""
    return F.when(~_is_container(leaf), F.try_variant_get(leaf, "$", "string"))


def strict_text(leaf: Column) -> Column:
    """The value only when JSON holds a string."""
    return F.when(F.schema_of_variant(leaf) == "STRING", F.try_variant_get(leaf, "$", "string"))


def number(leaf: Column) -> Column:
    """Lax number as a fixed-point decimal; booleans give NULL."""
    as_double = F.when(
        F.schema_of_variant(leaf) != "BOOLEAN", F.try_variant_get(leaf, "$", "double")
    )
    return as_double.try_cast(DECIMAL)


def boolean(leaf: Column) -> Column:
    return F.try_variant_get(leaf, "$", "boolean")


def parse_instant(value: Column) -> Column:
    """A UTC instant; text without a time and an offset gives NULL."""
    return F.when(value.rlike(INSTANT_PATTERN), value.try_cast("timestamp"))


def parse_day(value: Column) -> Column:
    """A calendar date; partial or impossible dates give NULL."""
    return F.when(value.rlike(DAY_PATTERN), value.try_cast("date"))


def instant(leaf: Column) -> Column:
    return parse_instant(text(leaf))


def day(leaf: Column) -> Column:
    return parse_day(text(leaf))


def first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def code_for_system(codings: Column, system: str) -> Column:
    """First strict ``code`` among codings of one system; NULL when there is none."""
    same_system = F.filter(codings, lambda c: strict_text(c["system"]) == system)
    return strict_text(first(same_system)["code"])


def first_nested_code(groups: Column) -> Column:
    """First code over an array of concepts that each hold a ``coding`` array."""
    occupied = F.filter(groups, lambda g: F.size(g["coding"]) > 0)
    return strict_text(first(first(occupied)["coding"])["code"])


def extension_code(extensions: Column, url: str, accept_single: bool = True) -> Column:
    """Code found in the nested extensions of the extension with this URL.

    ``valueCoding`` is read as an array of codings and, when ``accept_single`` is set,
    also as the single object the US Core profile prescribes.
    """
    matching = F.filter(extensions, lambda e: strict_text(e["url"]) == url)

    def codings(inner: Column) -> Column:
        many = F.try_variant_get(inner["valueCoding"], "$", "array<struct<code:variant>>")
        if not accept_single:
            return F.coalesce(many, F.expr("array()").cast("array<struct<code:variant>>"))
        one = F.try_variant_get(inner["valueCoding"], "$", "struct<code:variant>")
        return F.coalesce(
            many,
            F.when(one.isNotNull(), F.array(one)),
            F.expr("array()").cast("array<struct<code:variant>>"),
        )

    inner_lists = F.transform(
        matching,
        lambda e: F.coalesce(
            e["extension"], F.expr("array()").cast("array<struct<valueCoding:variant>>")
        ),
    )
    found = F.flatten(F.transform(F.flatten(inner_lists), codings))
    return strict_text(first(found)["code"])


def is_laboratory(category: Column) -> Column:
    """TRUE when any category says laboratory by code, display or text; never NULL."""
    no = F.lit(False)

    def says(leaf: Column) -> Column:
        return F.coalesce(F.lower(text(leaf)).isin(*LABORATORY_WORDS), no)

    def category_says(concept: Column) -> Column:
        by_coding = F.exists(concept["coding"], lambda c: says(c["code"]) | says(c["display"]))
        return says(concept["text"]) | F.coalesce(by_coding, no)

    return F.coalesce(F.exists(category, category_says), no)
