"""CSV loads that detect types and keep the rows that do not fit.

The file is read as text columns, so a value is never lost to a cast.  Types are
chosen from all values in one aggregate; then every row is either loaded with its typed
values or rejected with its reasons, in the same pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# narrowest first; a column without any value stays text
CANDIDATES = ("boolean", "int", "bigint", "double", "date", "timestamp")
BAD_LINE = "_bad_line"
MAX_BAD_SHARE = 0.05          # a type is taken if at most this share of a column's values does not fit it


def read_text_columns(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
                      has_header: bool = True) -> DataFrame:
    """The columns of a CSV as text, and ``_bad_line``: a line with too few or too many fields."""
    fields = ", ".join(f"`{c}` string" for c in columns)
    return (spark.read.option("header", has_header).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .option("columnPruning", False).option("columnNameOfCorruptRecord", BAD_LINE).schema(f"{fields}, `{BAD_LINE}` string").csv(path))


def header(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Column names; only the header line is read."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path).columns


def _typed(name: str, kind: str) -> Column:
    """The value as ``kind``; NULL where it does not fit.  Numbers with a fraction are no integers."""
    text = F.trim(F.col(f"`{name}`"))
    if kind in ("int", "bigint"):
        return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast(kind))
    if kind == "boolean":
        return F.when(F.lower(text).isin("true", "false"), text.try_cast("boolean"))
    if kind == "date":
        return F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), text.try_cast("date"))
    return text.try_cast(kind)


def detect_types(rows: DataFrame, max_bad_share: float = MAX_BAD_SHARE) -> dict[str, str]:
    """Per text column the narrowest type that fits all values but ``max_bad_share`` of them, else ``string``.

    One aggregate over all lines with the right number of fields; the driver receives
    one row of counts.
    """
    names = [c for c in rows.columns if c != BAD_LINE]
    good = rows.where(F.col(BAD_LINE).isNull()) if BAD_LINE in rows.columns else rows
    counts = [F.count(F.col(f"`{n}`")).alias(f"n{i}") for i, n in enumerate(names)]
    counts += [F.count(_typed(n, kind)).alias(f"n{i}_{kind}") for i, n in enumerate(names) for kind in CANDIDATES]
    seen = good.agg(*counts).first()
    out = {}
    for i, n in enumerate(names):
        least = (1 - max_bad_share) * seen[f"n{i}"]
        fits = [k for k in CANDIDATES if seen[f"n{i}"] and seen[f"n{i}_{k}"] >= least]
        out[n] = fits[0] if fits else "string"
    return out


def split_rejects(rows: DataFrame, types: Mapping[str, str], required: Sequence[str] = ()) -> DataFrame:
    """Typed columns, and ``reasons`` (an array of text, empty for a row that fits) and ``line``.

    Reasons are ``fields`` (a line with too few or too many), ``<column>: not <type>`` and
    ``<column>: missing`` for a required column without a value.  Every line gets a row.
    """
    broken = F.col(BAD_LINE).isNotNull()
    text = lambda n: F.col(f"`{n}`")
    found = [F.when(broken, F.lit("fields"))]
    found += [F.when(~broken & text(n).isNotNull() & _typed(n, kind).isNull(), F.lit(f"{n}: not {kind}"))
              for n, kind in types.items() if kind != "string"]
    found += [F.when(~broken & text(n).isNull(), F.lit(f"{n}: missing")) for n in required]
    typed = [(text(n) if kind == "string" else _typed(n, kind)).alias(n) for n, kind in types.items()]
    line = F.coalesce(F.col(BAD_LINE), F.to_csv(F.struct(*[text(n) for n in types])))
    return rows.select(*typed, F.array_compact(F.array(*found)).alias("reasons"), line.alias("line"))


def fitting(split: DataFrame) -> DataFrame:
    return split.where(F.size("reasons") == 0).drop("reasons", "line")


def rejected(split: DataFrame) -> DataFrame:
    """``line, reason``: one row per reason of a line that does not fit."""
    return split.select("line", F.explode("reasons").alias("reason"))


def read_typed(spark: SparkSession, path: str | Sequence[str], types: Mapping[str, str] | None = None,
               required: Sequence[str] = (), max_bad_share: float = MAX_BAD_SHARE,
               columns: Sequence[str] | None = None) -> DataFrame:
    """The split of a CSV into typed rows and rejects; types are detected unless given.

    Without ``types`` the files are read twice (types, then rows), with them once.  Files without a
    header need ``columns``.  An empty file has no rows; an unknown column in ``types`` raises ``ValueError``.
    """
    names = list(columns) if columns else header(spark, path)
    unknown = sorted(set(types or ()) - set(names))
    if unknown:
        raise ValueError(f"no column {unknown} in {names}")
    rows = read_text_columns(spark, path, names, has_header=not columns)
    kinds = dict(types) if types else detect_types(rows, max_bad_share)
    return split_rejects(rows, {n: kinds.get(n, "string") for n in names}, required)

