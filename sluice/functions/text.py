"""Column functions for the bracketed lists a registry stores as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as blank at either end, all code points up to the space.
_BLANKS = "".join(map(chr, range(0x21)))


def trim_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def strip_brackets(text: Column) -> Column:
    """Drop one leading ``[`` and one trailing ``]``."""
    return F.regexp_replace(text, r"\A\[|\]\z", "")


def unbracket(text: Column) -> Column:
    """Trim, then drop the brackets: ``' [a,b] '`` gives ``'a,b'``."""
    return strip_brackets(trim_blanks(text))


def list_items(text: Column) -> Column:
    """The trimmed, non-empty items of a bracketed or plain comma list; null stays null."""
    items = F.transform(F.split(unbracket(text), ","), trim_blanks)
    return F.filter(items, lambda item: F.length(item) > 0)


def subject_of(topic: Column) -> Column:
    """The schema table's subject for the values of one topic."""
    return F.concat(topic, F.lit("-value"))


def quote_name(name: Column) -> Column:
    return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))


def quote_literal(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.concat(F.lit("'"), escaped, F.lit("'"))
