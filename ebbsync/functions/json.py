"""Column expressions over JSON text, built on VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space JSON allows around a value.
JSON_BLANKS = " \t\r\n"


def is_blank(text: Column) -> Column:
    return F.trim(text, F.lit(JSON_BLANKS)) == ""


def array_items(doc: Column, path: str = "$") -> Column:
    """Elements of the array at ``path``; NULL for every other kind of value."""
    return F.try_variant_get(doc, path, "array<variant>")


def scalar_text(doc: Column, path: str) -> Column:
    """Text of the scalar at ``path``; NULL if it is missing, null, or nested.

    A plain cast to string would render a nested object as JSON text.
    """
    nested = (
        F.try_variant_get(doc, path, "map<string,variant>").isNotNull()
        | array_items(doc, path).isNotNull()
    )
    return F.when(~nested, F.try_variant_get(doc, path, "string"))


def integer(doc: Column, path: str) -> Column:
    """The number, or text holding an integer, at ``path``; NULL for a boolean."""
    kind = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    return F.when(kind != "BOOLEAN", F.try_variant_get(doc, path, "bigint"))


def strict_document(text: Column) -> Column:
    """VARIANT of ``text`` if it is exactly one JSON value, else NULL.

    The parser stops after the first value and ignores what follows. Text with
    such a tail cannot be both the only item of an array and the only field of
    an object, so both wrappings have to parse.
    """
    items = array_items(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))))
    field = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when((F.size(items) == 1) & field.isNotNull(), F.get(items, F.lit(0)))
