"""Column helpers for cleaning: defaults, casing, numbers, dates and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts. The first that fits of M/d/yyyy, M-d-yyyy, yyyy-MM-dd and
# dd/MM/yyyy counts; trying only those of the text's own separator keeps that outcome.
SLASHED_DATES = ("M/d/yyyy", "dd/MM/yyyy")
DASHED_DATES = ("M-d-yyyy", "yyyy-MM-dd")
ISO_SHAPE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
UNKNOWN = "Unknown"
NOT_APPLICABLE = "NA"


def parse_date(name: str) -> Column:
    """Text to date under the first layout that fits; null when none does.

    A failed attempt costs an exception inside the parser, so the separator decides which
    layouts are tried at all; no text fits both kinds. ISO text needs no layout.
    """
    slashed, dashed = (
        ", ".join(f"try_to_date(`{name}`, '{layout}')" for layout in layouts)
        for layouts in (SLASHED_DATES, DASHED_DATES)
    )
    return F.expr(
        f"CASE WHEN `{name}` RLIKE '{ISO_SHAPE}' THEN try_cast(`{name}` AS DATE) "
        f"WHEN contains(`{name}`, '/') THEN coalesce({slashed}) ELSE coalesce({dashed}) END"
    )


def whole(name: str) -> Column:
    return F.col(name).try_cast("int")


def magnitude(name: str) -> Column:
    """Unsigned whole number; widened first so the smallest int cannot overflow."""
    return F.abs(whole(name).cast("bigint")).try_cast("int")


def number(name: str) -> Column:
    return F.col(name).try_cast("double")


def money(name: str) -> Column:
    """``$90,000 `` to 90000.0; unreadable text becomes null, never an error."""
    return F.regexp_replace(F.col(name), r"[\$\s,]", "").try_cast("double")


def filled(name: str, default: str = UNKNOWN) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def tidy(name: str, default: str = UNKNOWN) -> Column:
    return F.trim(filled(name, default))


def shout(name: str, default: str = UNKNOWN) -> Column:
    """Upper case, default included: a missing first name reads UNKNOWN."""
    return F.trim(F.upper(filled(name, default)))


def titled(name: str, default: str = UNKNOWN) -> Column:
    """Each word capitalised; blank text stays blank so the rules can see it."""
    return F.trim(F.initcap(filled(name, default)))


def surrogate_key(*parts: tuple[str, str]) -> Column:
    """md5 over ``||``-joined columns, each given as (name, text standing for null)."""
    return F.md5(
        F.concat_ws(
            "||", *[F.coalesce(F.col(n).cast("string"), F.lit(missing)) for n, missing in parts]
        )
    )
