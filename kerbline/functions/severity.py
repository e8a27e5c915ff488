"""Severity scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Crash-cost weights per preset and class.
EPDO_WEIGHTS = {
    "hsm2010": {"K": 462, "A": 62, "B": 12, "C": 5, "O": 1},
    "vdot2024": {"K": 1032, "A": 53, "B": 16, "C": 10, "O": 1},
    "fhwa2022": {"K": 975, "A": 48, "B": 13, "C": 8, "O": 1},
    "fhwa2025": {"K": 883, "A": 94, "B": 21, "C": 11, "O": 1},
}
CLASSES = ("K", "A", "B", "C", "O")


def epdo(severity: Column, preset: str = "fhwa2025") -> Column:
    """Equivalent property-damage-only score of one crash; unknown classes count as O."""
    w = EPDO_WEIGHTS[preset]
    out = F.lit(w["O"])
    for k in ("C", "B", "A", "K"):
        out = F.when(severity == k, w[k]).otherwise(out)
    return out.cast("long")


def epdo_of_counts(preset: str = "fhwa2025", prefix: str = "") -> Column:
    """The score of columns K, A, B, C, O that hold counts."""
    return sum((F.col(f"{prefix}{k}") * n for k, n in EPDO_WEIGHTS[preset].items()), F.lit(0))


def map_severity(raw: Column) -> Column:
    """Text or code to K, A or O: fatal words to K, injury words to A, everything else to O."""
    t = F.upper(F.trim(F.coalesce(raw, F.lit(""))))
    return F.when(t.isin("F", "K", "FATAL") | t.contains("FATAL CRASH"), "K").when(t.isin("A", "I", "PI", "INJURY") | t.contains("INJURY"), "A").otherwise("O")


def severity_from_counts(k: Column, a: Column, b: Column, c: Column) -> Column:
    """The gravest class with a person in it, else O."""
    out = F.lit("O")
    for name, n in (("C", c), ("B", b), ("A", a), ("K", k)):
        out = F.when(n > 0, name).otherwise(out)
    return out
