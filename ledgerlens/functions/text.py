"""Null-aware text helpers (all JVM-side Column expressions)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    """Column by name (names may hold spaces, dots or accents) or the Column itself."""
    return qcol(c) if isinstance(c, str) else c


def qcol(name: str) -> Column:
    """``F.col`` for a plain column name: dots are part of the name, not struct access."""
    if name.startswith("`") or name == "*":
        return F.col(name)
    return F.col("`" + name.replace("`", "``") + "`")


def ref(df, name: str) -> Column:
    """``df[name]`` with the name taken literally (dots included)."""
    return df["`" + name.replace("`", "``") + "`"]


def lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def concat_null_safe(*parts: ColumnOrName | str) -> Column:
    """``CONCAT`` that treats NULL arguments as empty text and never returns NULL.

    Plain ``F.concat`` returns NULL as soon as one part is NULL. String
    arguments are column names; wrap literals in ``F.lit``.
    """
    return F.concat(*[F.coalesce(col(p), F.lit("")) for p in parts])


def join_words(*parts: ColumnOrName, sep: str = " ") -> Column:
    """``CONCAT(a, ' ', b, ' ', c)`` with NULL parts read as empty (separators kept)."""
    items: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            items.append(F.lit(sep))
        items.append(col(p))
    return concat_null_safe(*items)


def is_blank(c: ColumnOrName) -> Column:
    """``x IS NULL OR TRIM(x) = ''`` — always true/false, never NULL."""
    c = col(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def is_empty_or_null(c: ColumnOrName) -> Column:
    """``x = '' OR x IS NULL`` (no trimming)."""
    c = col(c)
    return c.isNull() | (c == F.lit(""))


def blank_to_null(c: ColumnOrName) -> Column:
    """``NULLIF(x, '')``."""
    return F.nullif(col(c), F.lit(""))


def first_nonblank(*cols: ColumnOrName) -> Column:
    """``COALESCE(NULLIF(a,''), NULLIF(b,''), ..., last)`` — the last one is kept as is."""
    cs = [col(c) for c in cols]
    return F.coalesce(*[blank_to_null(c) for c in cs[:-1]], cs[-1])


def party_name(org1: ColumnOrName, org2: ColumnOrName, first: ColumnOrName, last: ColumnOrName) -> Column:
    """Organisation name, else person name.

    ``CASE WHEN CONCAT(org1,' ',org2) = ' ' THEN CONCAT(first,' ',last)
    ELSE CONCAT(org1,' ',org2) END`` with CONCAT skipping NULL (the result
    of that CONCAT is never NULL, so its IS NULL branch never fires).
    """
    org = join_words(org1, org2)
    return F.when(org == F.lit(" "), join_words(first, last)).otherwise(org)


def tax_id_pick(company: ColumnOrName, person: ColumnOrName, variant: str) -> Column:
    """Company tax id, else person tax id — three NULL behaviours.

    ``blank_or_null``: ``company = '' OR company IS NULL`` -> person.
    ``blank_only``:    ``company = ''`` -> person; a NULL company id stays NULL.
    ``nonblank``:      ``company <> ''`` -> company, otherwise (also NULL) person.
    """
    c, p = col(company), col(person)
    if variant == "blank_or_null":
        return F.when(c.isNull() | (c == ""), p).otherwise(c)
    if variant == "blank_only":
        return F.when(c == "", p).otherwise(c)
    if variant == "nonblank":
        return F.when(c != "", c).otherwise(p)
    raise ValueError(f"unknown tax id variant {variant!r}")


def code_map(c: ColumnOrName, mapping: Sequence[tuple] | dict, default=None) -> Column:
    """Simple ``CASE x WHEN k THEN v ... ELSE default END`` generated from pairs.

    A NULL input never matches a key, so it gets ``default``. ``default`` may
    be a literal value or a Column (e.g. ``ELSE x``).
    """
    items = list(mapping.items()) if isinstance(mapping, dict) else list(mapping)
    c = col(c)
    expr = None
    for k, v in items:
        cond = c == F.lit(k)
        expr = F.when(cond, lit_or_col(v)) if expr is None else expr.when(cond, lit_or_col(v))
    if expr is None:
        return lit_or_col(default)
    return expr.otherwise(lit_or_col(default))


def regex_classify(text: ColumnOrName, rules: Iterable[tuple[str, str]], default: ColumnOrName | None = None,
                   case_insensitive: bool = True) -> Column:
    """Ordered ``CASE WHEN text ~* pattern THEN label ... ELSE default END``.

    Patterns are unanchored (``~*`` semantics); the first matching rule
    wins. Case folding is Unicode-aware so accented patterns behave.
    """
    t = col(text)
    flags = "(?iu)" if case_insensitive else ""
    expr = None
    for pattern, label in rules:
        cond = t.rlike(flags + pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    dflt = F.lit(None).cast("string") if default is None else col(default)
    return dflt if expr is None else expr.otherwise(dflt)


def contains(c: ColumnOrName, needle: str) -> Column:
    """``POSITION(needle IN x) > 0``."""
    return F.instr(col(c), needle) > 0


def prefix_in(c: ColumnOrName, n: int, values: Sequence[str]) -> Column:
    """``LEFT(x, n) IN (...)`` on characters."""
    return F.substring(col(c), 1, n).isin(list(values))


def prefix_not_in(c: ColumnOrName, n: int, values: Sequence[str]) -> Column:
    """``LEFT(x, n) <> ALL (ARRAY[...])``; NULL input gives NULL (row dropped by a filter)."""
    return ~prefix_in(c, n, values)
