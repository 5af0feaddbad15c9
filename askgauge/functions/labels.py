"""Small fixed lookups as column expressions."""

from pyspark.sql import Column, functions as F


def lookup(code: Column, mapping: dict, default: Column | None = None) -> Column:
    """Value of ``mapping`` for each code; codes outside it give ``default`` (NULL when omitted)."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), code)
    return found if default is None else F.coalesce(found, default)


def label_or_code(code: Column, mapping: dict) -> Column:
    """Display label of a code, or the code itself when it has none."""
    return lookup(code, mapping, default=code)


def rank_in(code: Column, order) -> Column:
    """Position of a code in a display order; unknown codes come after all known ones."""
    return lookup(code, {value: i for i, value in enumerate(order)}, default=F.lit(len(order)))
