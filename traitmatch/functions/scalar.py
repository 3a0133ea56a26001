"""Scalar expressions with the exact NULL and text rules the scores rely on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: ColumnOrName) -> Column:
    """Trim and upper-case, the comparison key for themes and categories."""
    return F.upper(F.trim(_c(c)))


def to_double(c: ColumnOrName) -> Column:
    """Cast to double, NULL for text that is not a number (never raises)."""
    return _c(c).try_cast("double")


def null_if_zero(c: ColumnOrName) -> Column:
    return F.nullif(_c(c), F.lit(0.0))


def clamp(c: ColumnOrName, lo: float = 0.0, hi: float = 100.0) -> Column:
    """``GREATEST(lo, LEAST(hi, x))`` that stays NULL for a NULL input.

    Spark's ``greatest``/``least`` skip NULL arguments, so without the guard a
    NULL ratio would become ``hi``.
    """
    x = _c(c)
    return F.when(x.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x)))


def num_to_text(c: ColumnOrName) -> Column:
    """Render a number as text: integer types as they are (no digit lost),
    whole doubles without a fraction (``3``), the rest with the plain double text
    (``3.5``); small and large doubles without an exponent (``0.0005``)."""
    x = _c(c)
    d = x.cast("double")
    whole = (d == F.floor(d)) & (F.abs(d) < F.lit(1e15))
    text = d.cast("string")
    # decimal(38,18) holds every ordinary double printed with an exponent; beyond it the text stays as it is
    plain = F.regexp_replace(d.try_cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    ordinary = text.contains("E") & (F.abs(d) >= F.lit(1e-15)) & (F.abs(d) < F.lit(1e19))
    return (F.when(d.isNull(), F.lit(None).cast("string"))
             .when(F.typeof(x).isin("tinyint", "smallint", "int", "bigint"), x.cast("string"))
             .when(whole, F.floor(d).cast("bigint").cast("string"))
             .when(ordinary, plain)
             .otherwise(text))


def round_numeric(c: ColumnOrName, scale: int = 2) -> Column:
    """``ROUND(CAST(x AS NUMERIC), scale)`` returned as double.

    The cast to ``decimal(38,9)`` first absorbs floating noise below 1e-9, then
    the decimal is rounded half away from zero.
    """
    return F.round(_c(c).cast("decimal(38,9)"), scale).cast("double")


def array_to_json(c: ColumnOrName) -> Column:
    return F.to_json(_c(c))


def json_to_array(c: ColumnOrName) -> Column:
    """JSON text to ``array<string>``; non-JSON text and ``null`` give NULL."""
    return F.from_json(_c(c), "array<string>")


def join_items(arr: ColumnOrName, sep: str = ", ") -> Column:
    """Join array items, skipping NULL items; NULL when nothing is left."""
    a = _c(arr)
    kept = F.filter(a, lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.array_join(kept, sep))


def map_value(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Look a value up in a fixed mapping; unknown values give NULL."""
    pairs = []
    for key, value in mapping.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.create_map(*pairs)[_c(c)]


def display_label(name: ColumnOrName, ident: ColumnOrName) -> Column:
    """``name (id)``; NULL when either part is NULL."""
    return F.concat(_c(name), F.lit(" ("), _c(ident), F.lit(")"))


def label_to_id(c: ColumnOrName) -> Column:
    """Inverse of :func:`display_label`: the text after the last ``(``, without ``)``."""
    last = F.substring_index(_c(c), "(", -1)
    return F.regexp_replace(last, r"\)", "")


def code_prefix(c: ColumnOrName) -> Column:
    """``STO_LIE`` -> ``STO``."""
    return F.substring_index(_c(c), "_", 1)


def as_float(c: ColumnOrName) -> Column:
    return _c(c).cast("double")


def run_date_text(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd")


def array_member(value: ColumnOrName, normalised_list: ColumnOrName) -> Column:
    """``norm(value) IN UNNEST(list)`` for a list already normalised with
    :func:`norm`; NULL value, NULL list, or no match -> False."""
    return F.coalesce(F.array_contains(_c(normalised_list), norm(value)), F.lit(False))


def array_overlap_count(items: ColumnOrName, normalised_targets: ColumnOrName) -> Column:
    """Number of distinct raw ``items`` whose normalised form is in
    ``normalised_targets`` (a per-row semi join of two lists, done with
    higher-order functions); 0 when either list is NULL."""
    hits = F.filter(_c(items), lambda x: array_member(x, normalised_targets))
    return F.coalesce(F.size(F.array_distinct(hits)), F.lit(0))


def first_item(arr: ColumnOrName, field: str | None = None) -> Column:
    """``arr[OFFSET(0)]`` (optionally one struct field of it); NULL for an
    empty or NULL array."""
    item = F.get(_c(arr), 0)
    return item[field] if field else item
