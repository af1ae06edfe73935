"""Texts derived from product facts, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions.clean import C, col, pystrip, title_case, unicode_re


def _text(c: C) -> Column:
    return F.coalesce(pystrip(c), F.lit(""))


def _drop(c: Column, pattern: str) -> Column:
    return pystrip(F.regexp_replace(c, unicode_re(pattern), ""))


def product_group(catalog_name: C) -> Column:
    """Short group name of a catalogue: ``Rajtex Ajrak Vol-58`` -> ``Rajtex-A``."""
    bare = _text(catalog_name)
    for pattern in (fv.GROUP_NUMBER_RANGE, fv.GROUP_CODE_RANGE, fv.GROUP_VOLUME,
                    fv.GROUP_TRAILING_NUMBER):
        bare = _drop(bare, pattern)
    words = F.filter(F.split(bare, unicode_re(r"[\s\-_/]+")), lambda w: w != "")
    first = F.get(words, F.lit(0))
    second = F.get(words, F.lit(1))
    third = F.get(words, F.lit(2))
    initial = F.upper(F.substring(second, 1, 1))
    initials = F.when(
        F.lower(second).isin(fv.GROUP_MIDDLE_WORDS) & third.isNotNull(),
        F.concat(initial, F.upper(F.substring(third, 1, 1)))).otherwise(initial)
    short = F.substring(first, 1, 6)
    return (F.when(first.isNull(), F.lit(fv.GROUP_FALLBACK))
            .when(second.isNull(), short)
            .otherwise(F.concat(short, F.lit("-"), initials)))


def fallback_sku(catalog_name: C) -> Column:
    """``Vol-<n>`` of a catalogue title, else its last code-like word."""
    name = col(catalog_name)
    volume = F.nullif(F.regexp_extract(name, unicode_re(fv.SKU_VOLUME), 1), F.lit(""))
    last = F.nullif(F.regexp_extract(pystrip(name), unicode_re(fv.SKU_TRAILING_TOKEN), 1), F.lit(""))
    return F.coalesce(F.concat(F.lit("Vol-"), volume), last)


def _words(c: Column) -> Column:
    return F.size(F.filter(F.split(c, unicode_re(r"\s+")), lambda w: w != ""))


def product_title(catalog_name: C, brand_name: C, fabric: C, work: C, product_type: C) -> Column:
    """Customer title from brand, catalogue, work, fabric and type."""
    brand, fab, work_text = _text(brand_name), _text(fabric), _text(work)
    kind = pystrip(F.coalesce(F.nullif(col(product_type), F.lit("")), F.lit("Saree")))
    cat = _text(catalog_name)
    brand_re = F.concat(F.lit(r"(?iU)\b\Q"), brand, F.lit(r"\E\b"))
    cat = F.when((brand != "") & (cat != ""),
                 pystrip(F.regexp_replace(cat, brand_re, F.lit("")))).otherwise(cat)
    cat = _drop(_drop(cat, fv.GROUP_VOLUME), fv.GROUP_TRAILING_NUMBER)

    low = F.lower(work_text)
    without_print = pystrip(work_text.substr(F.lit(1), F.length(work_text) - F.lit(6)))
    adjective = (F.when(low.endswith(" print"), F.concat(without_print, F.lit(" Printed")))
                 .when(low.endswith(" printed") | low.endswith(" work"), work_text)
                 .when((work_text != "") & (_words(work_text) <= 2), F.concat(work_text, F.lit(" Work")))
                 .otherwise(F.lit("")))
    says_it_all = (adjective != "") & (cat != "") & (
        F.lower(adjective).contains(F.lower(cat))
        | F.lower(adjective).startswith(F.substring(F.lower(cat), 1, 4)))

    def all_upper(c: Column) -> Column:
        return (F.upper(c) == c) & (F.lower(c) != c)

    cat_word = F.when((brand != "") & ~all_upper(brand) & all_upper(cat), title_case(cat)).otherwise(cat)
    parts = F.array(
        brand,
        F.when(says_it_all, adjective).otherwise(cat_word),
        F.when(~says_it_all & (_words(adjective) <= 2), adjective).otherwise(F.lit("")),
        fab, kind)
    title = F.array_join(F.filter(parts, lambda p: p != ""), " ")
    return F.coalesce(F.nullif(title, F.lit("")), F.nullif(col(catalog_name), F.lit("")), F.lit("Product"))


def product_description(description: C, brand_name: C, catalog_name: C, fabric: C, blouse_fabric: C,
                        work: C, occasion: C, product_type: C, price: C) -> Column:
    """Sentences for the facts that exist; a long supplier text is kept."""
    own = _text(description)
    brand, cat, fab = _text(brand_name), _text(catalog_name), _text(fabric)
    blouse, work_text, wear = _text(blouse_fabric), _text(work), _text(occasion)
    kind = pystrip(F.coalesce(F.nullif(col(product_type), F.lit("")), F.lit("Saree")))
    amount = col(price)
    opening = (
        F.when((brand != "") & (fab != "") & (cat != ""),
               F.concat(F.lit("Discover this elegant "), fab, F.lit(" "), kind, F.lit(" from "),
                        brand, F.lit(" ("), cat, F.lit(" Collection).")))
        .when((brand != "") & (fab != ""),
              F.concat(F.lit("Discover this elegant "), fab, F.lit(" "), kind, F.lit(" from "), brand, F.lit(".")))
        .when((brand != "") & (cat != ""),
              F.concat(F.lit("Discover this premium "), kind, F.lit(" from "), brand, F.lit(" ("), cat,
                       F.lit(" Collection).")))
        .when(fab != "", F.concat(F.lit("Designed in premium "), fab, F.lit(" fabric.")))
        .when(cat != "", F.concat(F.lit("Premium quality "), kind, F.lit(" from "), cat, F.lit(" Collection.")))
        .otherwise(F.concat(F.lit("Premium quality "), kind, F.lit("."))))
    amount_shown = F.when(amount == F.floor(amount), F.format_number(amount, 0)).otherwise(F.format_number(amount, 2))
    made = F.concat_ws(
        " ", opening,
        F.when(work_text != "", F.concat(F.lit("Showcases exquisite "), work_text, F.lit("."))),
        F.when((blouse != "") & (F.lower(blouse) != F.lower(fab)),
               F.concat(F.lit("Features a coordinated "), blouse, F.lit(" blouse fabric.")))
        .when(blouse != "", F.lit("Includes a matching coordinated blouse piece.")),
        F.when(wear != "", F.concat(F.lit("An excellent choice for "), wear,
                                    F.lit(", offering elegance, comfort, and timeless appeal."))),
        F.when(amount > 0, F.concat(F.lit("Single piece dropshipping price: ₹"), amount_shown, F.lit("."))))
    return F.when(F.length(own) > 20, own).otherwise(made)
