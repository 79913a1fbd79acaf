"""Feature engineering and input hygiene.

The same column expressions serve batches, streams and single rows (F8), so
there is no separate per-row path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C
from ..functions.columns import dlit


def engineer(df: DataFrame, drop: Sequence[str] = (), drop_duplicates: bool = False) -> DataFrame:
    """Add log_amount / hour_of_day / is_night (each only when its source
    column exists), drop the listed columns that exist, optionally dedup."""
    out = df
    if drop_duplicates:
        out = dedup(out)
    cols = {}
    if "Amount" in df.columns:
        cols["log_amount"] = C.log_amount("Amount")
    if "Time" in df.columns:
        cols["hour_of_day"] = C.hour_of_day("Time")
    if cols:
        out = out.withColumns(cols)
    if "hour_of_day" in out.columns:
        out = out.withColumn("is_night", C.is_night("hour_of_day"))
    return drop_columns(out, drop)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """drop only the listed columns that are present."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def dedup(df: DataFrame) -> DataFrame:
    """drop full-row duplicates over all columns (target included)."""
    return df.dropDuplicates()


def x_y(df: DataFrame, target: str = P.TARGET, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """feature frame and int target frame (keyed by ``key`` when given)."""
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found.")
    keys = [key] if key else []
    return df.drop(target), df.select(*keys, F.col(target).cast("int").alias("y"))


def share(df: DataFrame, count_col: str, name: str = "pct", digits: int = 2) -> DataFrame:
    """count -> % of the column total (total from a scalar subquery)."""
    total = df.agg(F.sum(count_col).alias("t")).select("t").scalar()
    return df.withColumn(name, C.rnd(F.try_divide(F.col(count_col).cast("double"), total.cast("double"))
                                     * dlit(100.0), digits))


def parse_payload(df: DataFrame, json_col: str, fields: dict[str, str]) -> DataFrame:
    """JSON payload fields as typed doubles; absent fields give NULL."""
    return df.withColumns({k: F.get_json_object(F.col(json_col), path).try_cast("double")
                           for k, path in fields.items()})


def _num_checks(name: str, raw: Column, required: bool, default: float | None,
                non_negative: bool = False, cap: float | None = None) -> tuple[Column, Column]:
    """(reason, value) for one raw string field, following the ordered checks."""
    present = raw.isNotNull()
    val = raw.try_cast("double")
    value = F.when(present, val).otherwise(dlit(default) if default is not None else F.lit(None).cast("double"))
    finite = ~F.isnan(val) & (F.abs(val) != dlit(float("inf")))
    reason = F.lit(None).cast("string")
    if required:
        reason = F.when(~present, F.lit(f"Missing required field: '{name}'."))
    reason = F.coalesce(reason, F.when(present & val.isNull(),
                                       F.format_string(f"Invalid '{name}': must be numeric, got '%s'.", raw)))
    if name == "Time":
        reason = F.coalesce(reason, F.when(present & val.isNotNull() & (~finite | (val < dlit(0.0))),
                                           F.lit("Invalid 'Time': must be a non-negative finite number.")))
        return reason, value
    reason = F.coalesce(reason, F.when(present & val.isNotNull() & ~finite, F.lit(
        f"Invalid '{name}': must be a finite number. NaN and Infinity values are prohibited.")))
    if non_negative:
        reason = F.coalesce(reason, F.when(present & finite & (val < dlit(0.0)), F.lit(
            f"Invalid '{name}': must be non-negative.")))
    if cap is not None:
        reason = F.coalesce(reason, F.when(present & finite & (val > dlit(cap)), F.lit(
            f"Invalid '{name}': exceeds maximum transaction cap of $10,000,000.")))
    return reason, value


def validate_rows(df: DataFrame, fields: dict[str, str], n_v: int = 28) -> DataFrame:
    """ordered per-row payload checks -> first failing ``reject_reason``
    (NULL when valid) and the cleaned doubles (absent Time / Vk -> 0.0).

    ``fields`` maps logical names ('Amount', 'Time', 'V1'..) to raw string
    columns of ``df``; names without a column count as absent. Split valid /
    quarantine with ``filter(reject_reason IS NULL)``.
    """
    def raw(n):
        return F.col(fields[n]).cast("string") if n in fields else F.lit(None).cast("string")

    checks = [("Amount", _num_checks("Amount", raw("Amount"), True, None, True, P.AMOUNT_CAP)),
              ("Time", _num_checks("Time", raw("Time"), False, 0.0))]
    checks += [(f"V{k}", _num_checks(f"V{k}", raw(f"V{k}"), False, 0.0)) for k in range(1, n_v + 1)]
    reason = F.coalesce(*[r for _, (r, _) in checks])
    return df.select("*", reason.alias("reject_reason"), *[v.alias(f"clean_{n}") for n, (_, v) in checks])
