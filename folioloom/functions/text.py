"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings accepted for booleans in a landed asset master.
TRUE_WORDS = ["true", "1", "yes", "y", "t"]
FALSE_WORDS = ["false", "0", "no", "n", "f"]


def _clean(name: str) -> str:
    return f"nullif(trim(cast(`{name}` as string)), '')"


def clean(name: str) -> Column:
    """Text without surrounding spaces; blank becomes NULL."""
    return F.expr(_clean(name))


def clean_upper(name: str) -> Column:
    return F.expr(f"upper({_clean(name)})")


def clean_lower(name: str) -> Column:
    return F.expr(f"lower({_clean(name)})")


def _literal(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _map_of(table: Mapping[str, object]) -> str:
    return "map(" + ", ".join(f"{_literal(k)}, {_literal(v)}" for k, v in table.items()) + ")"


def canonical(name: str, spellings: Iterable[str]) -> Column:
    """Map a case-insensitive match onto the listed spelling; anything else is kept as typed."""
    known = _map_of({s.lower(): s for s in spellings})
    return F.expr(f"coalesce({known}[lower({_clean(name)})], {_clean(name)})")


def lookup(name: str, table: Mapping[str, str]) -> Column:
    """Text of ``table`` for a text column, NULL when absent."""
    return F.expr(f"{_map_of(table)}[`{name}`]")


def yes_no(name: str) -> Column:
    """yes/no text as boolean, NULL for any other word."""
    return F.expr(f"case lower(trim(cast(`{name}` as string))) when 'yes' then true when 'no' then false end")


def parse_flag(col: Column | str) -> Column:
    """Boolean from a landed word; NULL passes, an unknown word fails the job."""
    c = F.col(col) if isinstance(col, str) else col
    raw = c.cast("string")
    word = F.lower(F.regexp_replace(raw, r"^\s+|\s+$", ""))
    unknown = F.raise_error(F.concat(F.lit("unsupported boolean value: "), raw)).cast("boolean")
    return (
        F.when(raw.isNull(), F.lit(None).cast("boolean"))
        .when(word.isin(TRUE_WORDS), True)
        .when(word.isin(FALSE_WORDS), False)
        .otherwise(unknown)
    )


def first_match(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Ordered rules, first true condition wins."""
    out = None
    for cond, value in rules:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default) if default is not None else out
