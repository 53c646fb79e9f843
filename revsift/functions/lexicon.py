"""Category families and domain-term lookups as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DOMAIN_TERMS, FAMILY_MAP, GENERIC_FAMILY, WHITELIST_COMMON
from .text import contains_any


def category_family(cat: Column) -> Column:
    """First family (in map order) with a key that is a substring of the
    lower-cased category; empty or null category -> ``generic``."""
    low = F.lower(F.coalesce(cat, F.lit("")))
    out = F.lit(GENERIC_FAMILY)
    for fam in reversed(list(FAMILY_MAP)):
        out = F.when(contains_any(low, FAMILY_MAP[fam]), F.lit(fam)).otherwise(out)
    return out


def primary_category(primary: str = "category_primary", fallback: str = "category_all") -> Column:
    """``category_primary or category_all`` (empty string counts as missing)."""
    p = F.col(primary)
    return F.coalesce(F.when(p != "", p), F.col(fallback), F.lit(""))


def is_in(x: Column, terms) -> Column:
    """Membership in a fixed set of strings; above ten terms the optimiser makes it one hash lookup."""
    return x.isin(*terms) if terms else F.lit(False)


def count_in(tokens: Column, terms) -> Column:
    return F.size(F.filter(tokens, lambda x: is_in(x, terms)))


def domain_hits(tokens: Column, family: Column) -> Column:
    """How many tokens (repeats count) are terms of the row's family; 0 for a family without terms.

    One branch per family, of which a row runs one: its tokens are looked up in that family's hash set, whatever the
    number of terms.  No join, and no scan over the terms of a family."""
    out = F.lit(0)
    for fam in reversed(list(DOMAIN_TERMS)):
        terms = list(DOMAIN_TERMS[fam])
        if terms:
            out = F.when(family == fam, count_in(tokens, terms)).otherwise(out)
    return out


def drop_whitelist(tokens: Column) -> Column:
    return F.filter(tokens, lambda x: ~is_in(x, WHITELIST_COMMON))
