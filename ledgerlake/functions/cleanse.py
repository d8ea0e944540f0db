"""Repair of dirty text: keys, numbers, timestamps, categories and codes.

Everything here is a native column expression. ANSI mode is on by default in Spark 4, so all casts of
dirty text are ``try_cast`` and yield NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as in the regular expression [\s\p{Z}], spelled out so that the JVM-side
# trim/translate (no regex) can be used.
SPACES = (
    " \t\n\x0b\x0c\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Symbols and unit words that may surround a number.
NUMBER_SYMBOLS = "$*#!%"
NUMBER_UNITS = ("USD", "ms", "pts", "deg")

_TRIMMED = r"(?s)^[!-~](?:.*[!-~])?\z"
_GAP = r"[$*#!%\s\p{Z}]*+"
_DIGITS = r"((?:[0-9]{1,3}(?:,[0-9]{3})++|[0-9]++)(?:\.[0-9]*+)?|\.[0-9]++)"
_UNIT = rf"(?:(?:{'|'.join(NUMBER_UNITS)}){_GAP})?"
_USD = rf"(?:USD{_GAP})?"
# either "(number)" with both parentheses, or a sign before or after the symbols or behind the number
_NUMBER = (
    rf"(?i)^{_GAP}{_USD}(?:(\(){_GAP}{_USD}{_DIGITS}{_GAP}{_UNIT}\)"
    rf"|([+-]?){_GAP}{_USD}([+-]?){_DIGITS}{_GAP}{_UNIT}(-?)){_GAP}{_UNIT}$|^[\s\S]*$"
)
_PLAIN = rf"^\$?+(-?+[0-9]++(?:\.[0-9]++)?)(?:%| ?+(?:{'|'.join(NUMBER_UNITS)}))?+\z"
_CODE = r"^[\s\p{Z}]*+([0-9]{1,9})[*!#\s\p{Z}]*+$"

CURRENCY = "decimal(18,2)"
COUNT = "bigint"
MEASURE = "double"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_text(c: Column | str) -> Column:
    """Remove white space of any kind, no-break spaces included, from both ends.

    Trimming compares each end with all of the spaces byte by byte; text between two visible ASCII characters, as most is, need not be. Such
    text is that of ``_TRIMMED``; its ends are compared as text, which takes a fraction of the pattern's time.
    """
    text = _col(c)
    last = F.substring(text, -1, 1)
    visible = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(visible, text).otherwise(F.btrim(text, F.lit(SPACES)))


def _trim_short(text: Column) -> Column:
    """``trim_text`` in less generated code, for expressions that repeat their text or stand behind a filter that is large already."""
    return F.when(text.rlike(_TRIMMED), text).otherwise(F.btrim(text, F.lit(SPACES)))


def norm_key(c: Column | str) -> Column:
    """``UPPER(TRIM(x))`` for primary and foreign keys."""
    return F.upper(_trim_short(_col(c)))


def parse_number(c: Column | str, dtype: str = CURRENCY, accounting: bool = True) -> Column:
    """Number out of dirty text; accounting parentheses negate it.

    Symbols, commas between groups of three digits, units and spaces around the number are dropped; a minus
    may stand before or after the symbols or behind the number. Text that is anything else than one number, such as
    ``12,5`` or ``5)``, becomes NULL. ``accounting=False`` reproduces the mistake of ignoring the
    parentheses. One regular expression per value keeps the generated code of wide projections small
    enough for the JVM to compile. Most values are digits with at most one symbol before and one unit behind them; they are looked for first, by a
    pattern that takes a fraction of the time. What it does not find is empty, so no number, and goes to the full one.
    """
    text = _col(c)
    found = F.regexp_replace(text, _NUMBER, "$1$3$4$6$2$5")
    signed = F.translate(found, "(,", "-") if accounting else F.translate(found, "(,", "")
    return F.coalesce(F.regexp_extract(text, _PLAIN, 1).try_cast(dtype), signed.try_cast(dtype))


class TsFormat(NamedTuple):
    """A timestamp layout. Fixed-width text of ``yyyy MM dd HH mm ss SSS`` fields and literals, or
    ``epoch`` for seconds since 1970."""

    name: str
    layout: str


# Default layouts, in parsing order.
TS_FORMATS: tuple[TsFormat, ...] = (
    TsFormat("iso", "yyyy-MM-dd HH:mm:ss"),
    TsFormat("iso_z", "yyyy-MM-ddTHH:mm:ssZ"),
    TsFormat("us", "MM/dd/yyyy HH:mm:ss"),
    TsFormat("us_minutes", "MM/dd/yyyy HH:mm"),
    TsFormat("epoch", "epoch"),
)
_FIELDS = ("yyyy", "MM", "dd", "HH", "mm", "ss")
_DIGITS_TO_ZERO = ("123456789", "000000000")


def _shape(layout: str) -> str:
    for f in (*_FIELDS, "SSSSSS", "SSS"):
        layout = layout.replace(f, "0" * len(f))
    return layout


def _iso_text(text: Column, layout: str) -> Column:
    """The fields of ``text`` in ISO order."""
    if layout.startswith("yyyy-MM-dd") and layout[11:19] == "HH:mm:ss":
        fraction = layout.find(".S")
        return F.substring(text, 1, 19 if fraction < 0 else len(layout.rstrip("Z")))
    at = {f: F.substring(text, layout.index(f) + 1, len(f)) for f in _FIELDS if f in layout}
    day = [at["yyyy"], F.lit("-"), at["MM"], F.lit("-"), at["dd"]]
    time = [at.get("HH", F.lit("00")), F.lit(":"), at.get("mm", F.lit("00")), F.lit(":"), at.get("ss", F.lit("00"))]
    return F.concat(*day, F.lit(" "), *time)


def _epoch(text: Column, shape: Column) -> Column:
    seconds = F.when(shape.isin("0" * 9, "0" * 10, "0" * 11), text).try_cast("bigint")
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def ts_shape(text: Column) -> Column:
    """Text with every digit as 0."""
    return F.translate(text, *_DIGITS_TO_ZERO)


def _parsed(text: Column, formats: Sequence[TsFormat], shape: Column | None = None) -> list[tuple[list[TsFormat], Column]]:
    """Instants per group of formats. Layouts of different shape exclude each other and share a cast."""
    shape = ts_shape(text) if shape is None else shape
    groups: list[list[TsFormat]] = []
    for f in formats:
        alone = f.layout == "epoch"
        last = groups[-1] if groups else None
        if alone or last is None or last[0].layout == "epoch" or _shape(f.layout) in map(_shape, (g.layout for g in last)):
            groups.append([f])
        else:
            last.append(f)
    out = []
    for group in groups:
        if group[0].layout == "epoch":
            out.append((group, _epoch(text, shape)))
            continue
        iso = F.lit(None).cast("string")
        for f in reversed(group):
            iso = F.when(shape == _shape(f.layout), _iso_text(text, f.layout)).otherwise(iso)
        out.append((group, iso.try_cast("timestamp_ntz")))
    return out


def parse_ts(c: Column | str, formats: Sequence[TsFormat] = TS_FORMATS) -> Column:
    """First layout that yields a valid instant wins; otherwise NULL.

    The result has no time zone, so it does not depend on the session's.
    """
    return parse_trimmed_ts(_trim_short(_col(c)), None, formats)


def parse_trimmed_ts(text: Column, shape: Column | None = None, formats: Sequence[TsFormat] = TS_FORMATS) -> Column:
    """``parse_ts`` of trimmed text, whose ``ts_shape`` may be given: both are looked at once for each layout."""
    return F.coalesce(*[value for _, value in _parsed(text, formats, shape)])


def ts_format_name(c: Column | str, formats: Sequence[TsFormat] = TS_FORMATS) -> Column:
    """Name of the layout ``parse_ts`` uses, ``missing`` or ``unparseable``."""
    text = _trim_short(_col(c))
    shape = ts_shape(text)
    name = F.lit("unparseable")
    for group, value in reversed(_parsed(text, formats)):
        which = F.lit(group[-1].name)
        for f in reversed(group[:-1]):
            which = F.when(shape == _shape(f.layout), F.lit(f.name)).otherwise(which)
        name = F.when(value.isNotNull(), which).otherwise(name)
    return F.when(text.isNull(), F.lit("missing")).otherwise(name)


def norm_category(c: Column | str) -> Column:
    """Category text without outer spaces and trailing footnote marks.

    Trimmed text that ends otherwise has no such marks; U+0085 is no space, but ends a line, before which ``$`` matches too.
    """
    text = trim_text(c)
    marked = F.substring(text, -1, 1).isin("*", "!", "#", "\u0085")
    return F.when(marked, F.regexp_replace(text, r"(?<![*!#\s\p{Z}])[*!#\s\p{Z}]+$", "")).otherwise(text)


def norm_code(c: Column | str, allowed: Sequence[int] = (0, 1, 2)) -> Column:
    """Integer code out of dirty text, NULL unless it is one of ``allowed``."""
    code = F.regexp_extract(_col(c), _CODE, 1).try_cast("int")
    return F.when(code.isin(*allowed), code)


def cast_roles(df: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """Replace dirty columns by typed ones: ``{column: type}`` with the role types above."""
    return df.withColumns({c: parse_number(c, t) for c, t in roles.items()})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Coalesce each named column to its default, keeping the column's type."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()}
    )


def fixed2(c: Column | str) -> Column:
    """Exact text with two decimals."""
    return _col(c).cast("decimal(38,2)").cast("string")
