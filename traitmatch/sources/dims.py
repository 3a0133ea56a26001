"""The ten dimension tables shipped with the source data.

Fixed values: these rows must equal the source CSV files exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values (dimension CSV contents, in file order) -------------------
DIMENSIONS: dict[str, tuple[str, list[tuple]]] = {
    "dim_areas": ("area_id int, name string", [
        (1, "Distribution"), (2, "HQ"), (3, "Plant"), (4, "Store"),
    ]),
    "dim_companies": ("company_id int, name string", [
        (1, "PT Aurora Beauty Indonesia"), (2, "PT VASKA Wellness"),
        (3, "PT Lumo Cosmetics Asia"), (4, "PT Mandala Distribution Center"),
    ]),
    "dim_competency_pillars": ("pillar_code string, pillar_label string", [
        ("GDR", "Growth Drive & Resilience"), ("CEX", "Curiosity & Experimentation"),
        ("IDS", "Insight & Decision Sharpness"), ("QDD", "Quality Delivery Discipline"),
        ("STO", "Synergy & Team Orientation"), ("SEA", "Social Empathy & Awareness"),
        ("VCU", "Value Creation for Users"), ("LIE", "Lead, Inspire & Empower"),
        ("FTC", "Forward Thinking & Clarity"), ("CSI", "Commercial Savvy & Impact"),
    ]),
    "dim_departments": ("department_id int, name string", [
        (1, "Finance"), (2, "HR"), (3, "IT"), (4, "Marketing"), (5, "Operations"), (6, "R&D"),
    ]),
    "dim_directorates": ("directorate_id int, name string", [
        (1, "Commercial"), (2, "HR & Corp Affairs"), (3, "Technology"),
    ]),
    "dim_divisions": ("division_id int, name string", [
        (1, "Digital Marketing"), (2, "Operations"), (3, "Product Dev"), (4, "Sales"),
        (5, "Talent Management"),
    ]),
    "dim_education": ("education_id int, name string", [
        (1, "D3"), (2, "S1"), (3, "S2"), (4, "SMA"),
    ]),
    "dim_grades": ("grade_id int, name string", [
        (1, "III"), (2, "IV"), (3, "V"),
    ]),
    "dim_majors": ("major_id int, name string", [
        (1, "Business"), (2, "Design"), (3, "Economics"), (4, "Engineering"),
        (5, "Psychology"), (6, "Statistics"),
    ]),
    "dim_positions": ("position_id int, name string", [
        (1, "Brand Executive"), (2, "Data Analyst"), (3, "Finance Officer"), (4, "HRBP"),
        (5, "Sales Supervisor"), (6, "Supply Planner"),
    ]),
}
# ---------------------------------------------------------------------------


def dimension_frames(spark: SparkSession) -> dict[str, DataFrame]:
    """Each dimension as a small local DataFrame (a ``LocalRelation``: the
    optimizer knows its exact size and broadcasts it)."""
    from traitmatch.sources.files import constants

    return {name: constants(spark, rows, schema) for name, (schema, rows) in DIMENSIONS.items()}


def dimension_values_sql(name: str) -> str:
    """The same rows as a SQL ``VALUES`` list, for the SQL oracle."""
    schema, rows = DIMENSIONS[name]
    cols = [part.split()[0] for part in schema.split(",")]

    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    types = [part.split()[1] for part in schema.split(",")]
    casts = ", ".join(
        f"CAST({c} AS {'INTEGER' if t == 'int' else 'VARCHAR'}) AS {c}" for c, t in zip(cols, types)
    )
    return f"SELECT {casts} FROM (VALUES {body}) AS t({', '.join(cols)})"
