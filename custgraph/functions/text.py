"""Text and number columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    """Trimmed text, null when nothing is left: the one spelling of 'missing'."""
    text = F.trim(col(value))
    return F.when(text != "", text)


def strip(value: Column | str) -> Column:
    """Text without white space at either end, line breaks included."""
    return F.regexp_replace(col(value), r"^\s+|\s+$", "")


def is_populated(value: Column | str) -> Column:
    c = col(value)
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def safe_float(value: Column | str) -> Column:
    """The value as a double, 0.0 when it is null or no number."""
    return F.coalesce(col(value).try_cast("double"), F.lit(0.0))


def slugify(value: Column | str) -> Column:
    """Lower-case file name: runs of other characters become one underscore."""
    joined = F.regexp_replace(F.lower(F.trim(col(value))), "[^a-z0-9]+", "_")
    return F.regexp_replace(joined, "^_+|_+$", "")


def strip_fences(value: Column | str) -> Column:
    """Text without markdown code-fence lines."""
    opened = F.regexp_replace(col(value), r"(?m)^```(?:html?)?\s*\n?", "")
    return strip(F.regexp_replace(opened, r"(?m)\n?```\s*$", ""))


def preview(value: Column | str, length: int) -> Column:
    c = col(value)
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit("..."))).otherwise(c)


def money(value: Column | str, digits: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(col(value), digits))


def percent(value: Column | str, digits: int = 1) -> Column:
    return F.concat(F.format_number(col(value), digits), F.lit("%"))


def full_name(first: Column | str, last: Column | str) -> Column:
    return F.concat(col(first), F.lit(" "), col(last))


def edge_line(source_label, source_key, rel_type, target_label, target_key, confidence) -> Column:
    """``(Label key) -[TYPE]-> (Label key) [confidence]``"""
    return F.format_string(
        "(%s %s) -[%s]-> (%s %s) [%s]",
        col(source_label), col(source_key), col(rel_type),
        col(target_label), col(target_key), col(confidence),
    )
