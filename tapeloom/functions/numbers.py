"""Numbers: rounding, sizes, durations, costs, confidence."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeloom.shipping import ship


ship(__name__)


def _round2(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if pd.isna(v) else round(v, 2))


def round2(x: Column) -> Column:
    """Two decimals, rounded on the exact binary value, ties to even."""
    return F.pandas_udf(_round2, "double")(x)


def round2_fast(x: Column) -> Column:
    """As ``round2`` but for values whose shortest decimal form is a tie; stays in generated code."""
    return F.bround(x, 2)


def size_mb(n_bytes: Column) -> Column:
    """P3."""
    return n_bytes / F.lit(1048576.0)


def duration_s(ms: Column) -> Column:
    """P4."""
    return ms / F.lit(1000.0)


def cost(seconds: Column, per_minute: float = 0.006) -> Column:
    """P5."""
    return seconds / F.lit(60.0) * F.lit(per_minute)


def cost_message(seconds: Column, per_minute: float = 0.006) -> Column:
    """The estimate as people read it."""
    return F.format_string("Audio duration: %.2f minutes, estimated cost: $%.4f", seconds / F.lit(60.0), cost(seconds, per_minute))


def confidence(x: Column, low: Column, high: Column) -> Column:
    """Place in the range, 0.5 if the range is empty."""
    return F.when(high - low != 0, (x - low) / F.when(high - low != 0, high - low)).otherwise(F.lit(0.5))
