"""Text labels of entities and list membership."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeline.params import STATE_ABBREVIATIONS


def lookup(col: Column, mapping: Mapping[str, str]) -> Column:
    """Value of a small fixed dictionary, NULL for a missing key."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.element_at(F.create_map(*pairs), col)


def abbreviate(col: Column, mapping: Mapping[str, str] = STATE_ABBREVIATIONS) -> Column:
    """Short form of a name, or the name itself where none is known."""
    return F.coalesce(lookup(col, mapping), col)


def footnote_label(city: Column, region: Column, group: Column, starred: str) -> Column:
    """'City,' over 'Region', starred for members of the group."""
    star = F.when(group == starred, "*").otherwise("")
    return F.concat(
        F.coalesce(city, F.lit("NA")), F.lit(",\n"), F.coalesce(region, F.lit("NA")), star
    )


def in_list(col: Column, names: Iterable[str]) -> Column:
    """Membership that is never NULL."""
    return F.coalesce(col.isin(list(names)), F.lit(False))


def in_list_ci(col: Column, names: Iterable[str]) -> Column:
    """Membership ignoring case, never NULL."""
    return in_list(F.lower(col), {n.lower() for n in names})
