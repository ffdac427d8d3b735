"""Scalar Column functions: labels, numbers, dates, hashes, JSON and quote maths.

All of them compile to JVM expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_col", "norm_label", "strip", "drop_commas", "to_number", "to_long", "month_number",
    "row_hash", "parse_date", "month_start", "date_key", "month_name",
    "per_unit", "invert_quote", "relative_difference", "not_blank", "NUMBER_PATTERN", "UNIT_SEPARATOR",
]

#: Field separator used inside a row fingerprint (ASCII unit separator, U+001F).
UNIT_SEPARATOR = "\u001f"

#: A plain decimal number with optional sign and exponent, after trimming. Strings such as
#: ``NaN``, ``inf`` or ``1d`` that a bare cast would accept are rejected by this guard.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

_WS = r"(?U)\s+"

# --- fixed values: characters of the Unicode White_Space property (what ``(?U)\s`` matches)
WHITESPACE = ("\t\n\u000b\u000c\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_label(c) -> Column:
    """Null to "", upper case, every whitespace run (Unicode aware) to one space, trimmed."""
    collapsed = F.regexp_replace(F.upper(F.coalesce(as_col(c), F.lit(""))), _WS, " ")
    return F.btrim(collapsed, F.lit(" "))


def strip(c) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs and no-break spaces too).

    A character-set trim: no regular expression is evaluated per row.
    """
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def truncate(c, n: int) -> Column:
    """The first ``n`` characters (code points); null stays null."""
    return F.substring(as_col(c), 1, n)


def drop_commas(c) -> Column:
    return F.replace(as_col(c), F.lit(","), F.lit(""))


def to_number(c, commas: bool = True) -> Column:
    """Tolerant text-to-double parse: anything that is not a plain number becomes null."""
    s = as_col(c)
    if commas:
        s = drop_commas(s)
    s = strip(s)
    # the pattern's match (or "" when it does not match) is the only thing cast, so the
    # input expression is evaluated once
    matched = F.regexp_extract(s, "^(" + NUMBER_PATTERN[1:-1] + ")$", 1)
    return F.nullif(matched, F.lit("")).try_cast("double")


def to_long(c, sentinel: int | None = -1, commas: bool = True) -> Column:
    """Number parse truncated to a long; unparseable becomes ``sentinel`` (or null). The text of an
    integer is read directly: through a double it would be rounded above 2 ** 53."""
    s = F.col(c) if isinstance(c, str) else c
    v = F.coalesce(F.when(strip(drop_commas(s) if commas else s).rlike("^[+-]?[0-9]+$"),
                          strip(drop_commas(s) if commas else s).try_cast("long")),
                   to_number(c, commas).try_cast("long"))
    return v if sentinel is None else F.coalesce(v, F.lit(sentinel).cast("long"))


def month_number(c, names: Sequence[str]) -> Column:
    """Upper-cased, trimmed month name to 1..12 (position in ``names``); unknown -> null."""
    pairs = []
    for i, n in enumerate(names, start=1):
        pairs += [F.lit(n.upper()), F.lit(i)]
    return F.try_element_at(F.create_map(*pairs), strip(F.upper(F.coalesce(as_col(c), F.lit("")))))


def row_hash(cols: Iterable, null_token: str = "") -> Column:
    """sha256 hex of the fields joined by U+001F; null renders as ``null_token``.

    ``concat_ws`` silently skips nulls, which would make ``("a", null, "b")`` and
    ``("a", "b")`` collide, hence the coalesce of every field first.
    """
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(null_token)) for c in cols]
    return F.sha2(F.concat_ws(UNIT_SEPARATOR, *parts), 256)


def parse_date(c, formats: Sequence[str] = ("yyyy-M-d", "d/M/yyyy")) -> Column:
    """First format that parses wins; nothing parses -> null (never an error).

    A format is only tried on strings containing its separator characters, which skips
    the (costly) failed parse attempts for strings of another shape.
    """
    s = as_col(c)
    tries = []
    for f in formats:
        seps = sorted({ch for ch in f if not ch.isalnum() and ch not in "'[]"})
        guard = None
        for ch in seps:
            g = F.instr(s, ch) > 0
            guard = g if guard is None else guard & g
        attempt = F.try_to_date(s, f)
        tries.append(attempt if guard is None else F.when(guard, attempt))
    return F.coalesce(*tries)


def month_start(year, month) -> Column:
    """Date of the first of the month; null when either part is missing or out of range."""
    y, m = as_col(year), as_col(month)
    ok = y.isNotNull() & m.isNotNull() & y.between(1, 9999) & m.between(1, 12)
    return F.when(ok, F.make_date(y.cast("int"), m.cast("int"), F.lit(1)))


def date_key(c) -> Column:
    """``yyyymmdd`` integer surrogate key of a date."""
    d = as_col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(c) -> Column:
    return F.date_format(as_col(c), "MMMM")


def per_unit(rate, units) -> Column:
    return F.try_divide(as_col(rate), as_col(units))


def invert_quote(mean, buy, sell, basis, units, direct: str, inverse: str):
    """Normalise a quote to "home currency per 1 foreign unit".

    Direct quotes are divided by the quoted lot size; inverse quotes are reciprocated,
    and reciprocating swaps the bid and ask sides. Unknown basis gives nulls (CASE with
    no ELSE). Returns ``(mean, buy, sell)`` Columns.
    """
    b = as_col(basis)
    one = F.lit(1.0)

    def pick(direct_value, inverse_value):
        return F.when(b == direct, direct_value).when(b == inverse, inverse_value)

    return (
        pick(per_unit(mean, units), F.try_divide(one, as_col(mean))),
        pick(per_unit(buy, units), F.try_divide(one, as_col(sell))),
        pick(per_unit(sell, units), F.try_divide(one, as_col(buy))),
    )


def relative_difference(a, b) -> Column:
    return F.try_divide(F.abs(as_col(a) - as_col(b)), as_col(b))


def not_blank(c) -> Column:
    s = as_col(c)
    return s.isNotNull() & (strip(s) != "")
