"""Reading message content as it comes over the wire: JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_BLOCKS = ("input_text", "output_text", "text")
_SPACE = " \t\r\n"


def flatten_content(content: Column) -> Column:
    """The plain text of a JSON content value.

    A JSON string is its own text; a list gives the non-empty ``text`` of its text blocks, one per
    line, whatever else it holds; null gives the empty string; any other value is kept as its JSON
    text. Content that is not valid JSON is taken as plain text.
    """
    value = F.try_parse_json(content)
    written = F.btrim(content, F.lit(_SPACE))
    return (
        F.when(content.isNull() | (written == "null"), "")
        .when(written.startswith('"'), F.coalesce(F.try_variant_get(value, "$", "string"), content))
        .when(written.startswith("["), F.coalesce(F.array_join(_texts(value), "\n"), content))
        .otherwise(content)
    )


def _texts(value: Column) -> Column:
    blocks = F.filter(
        F.try_variant_get(value, "$", "array<variant>"),
        lambda b: F.try_variant_get(b, "$.type", "string").isin(*TEXT_BLOCKS),
    )
    texts = F.transform(blocks, lambda b: F.try_variant_get(b, "$.text", "string"))
    return F.filter(texts, lambda t: F.length(t) > 0)
