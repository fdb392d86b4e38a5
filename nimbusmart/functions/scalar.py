"""Scalar Column builders (F1–F12). Each returns a Column expression that stays
inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: compass sectors, clockwise from north, 45 degrees each ----
COMPASS_GLYPHS = ["⬆️", "↗️", "➡️", "↘️", "⬇️", "↙️", "⬅️", "↖️"]
COMPASS_LABELS = ["⬆️ N", "↗️ NE", "➡️ E", "↘️ SE", "⬇️ S", "↙️ SW", "⬅️ W", "↖️ NW"]
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL, so pandas-style "missing" checks become SQL NULL checks."""
    return F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))


def compass_index(deg: Column | str) -> Column:
    """Sector 0..7 of an angle: half-even round of (deg mod 360)/45, mod 8.

    ``bround`` (half-even) matters: 22.5 degrees is sector 0, not 1.
    Missing angles (NULL/NaN) give NULL.
    """
    d = nan_to_null(deg)
    return (F.bround(F.pmod(d, F.lit(360.0)) / 45.0, 0).cast("int") % 8)


def _pick(labels: list[str], idx: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(x) for x in labels]), idx), F.lit(""))


def compass_glyph(deg: Column | str) -> Column:
    """Arrow glyph of an angle; missing -> empty string (F10, symbol only)."""
    return _pick(COMPASS_GLYPHS, compass_index(deg))


def compass_name(deg: Column | str) -> Column:
    """Arrow glyph plus point name, e.g. ``"↗️ NE"``; missing -> empty string."""
    return _pick(COMPASS_LABELS, compass_index(deg))


def composite_id(*parts: Column | str, sep: str = "_") -> Column:
    """``a_b_c`` key; NULL in any part gives NULL, like SQL ``concat`` (F1, F2)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_col(p).cast("string"))
    return F.concat(*cols)


def split_item(c: Column | str, sep: str, index: int) -> Column:
    """Item ``index`` (0-based) of ``c`` split on the literal ``sep``; NULL when
    out of range instead of the ANSI error of ``getItem`` (F3, N3)."""
    return F.get(F.split(_col(c), re.escape(sep)), index)


def array_item(c: Column | str, index: int) -> Column:
    """Array element by 0-based position, NULL when out of range."""
    return F.get(_col(c), index)


def midpoint(lo: Column | str, hi: Column | str) -> Column:
    """``(lo + hi) / 2`` (F8)."""
    return (_col(lo) + _col(hi)) / 2


def try_double(c: Column | str) -> Column:
    """Cast to double; unparseable text becomes NULL rather than failing."""
    return _col(c).try_cast("double")


def tolerant_year(df: DataFrame, name: str) -> Column:
    """``year`` of a date-like column (F6, N4). Of text the leading date counts,
    whatever follows a space or ``T``; text without one gives NULL."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        c = c.try_cast("date")
    return F.year(c).cast("int")
