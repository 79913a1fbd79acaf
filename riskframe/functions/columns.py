"""Column-expression builders. All JVM-side, so they fuse into whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_double(x: float) -> str:
    """SQL text of a double literal that parses back to exactly ``x``
    (``repr`` round-trips; the ``D`` suffix keeps it a double, not a decimal)."""
    x = float(x)
    if x != x:
        return "CAST('NaN' AS DOUBLE)"
    if x == float("inf"):
        return "CAST('Infinity' AS DOUBLE)"
    if x == float("-inf"):
        return "CAST('-Infinity' AS DOUBLE)"
    return f"{x!r}D"


def sql_name(c: str) -> str:
    """Column reference for SQL text with ``F.col`` semantics: dots address
    struct fields (each part back-quoted); an already back-quoted name is
    used as written."""
    if "`" in c:
        return c
    return ".".join("`" + part + "`" for part in c.split("."))


def dlit(x: float) -> Column:
    """Double literal, parsed JVM-side from SQL text in one call (building
    it from ``lit(..).cast(..)`` costs several Python->JVM round trips, which
    dominates plan construction when grids have hundreds of points)."""
    return F.expr(sql_double(x))


# --------------------------------------------------------------------------
# Binning
# --------------------------------------------------------------------------
def darray(values: Sequence[float]) -> Column:
    """array<double> literal from SQL text in one call."""
    return F.expr("array(" + ", ".join(sql_double(v) for v in values) + ")")


def count_edges_le(c: str | Column, edges: Sequence[float]) -> Column:
    """Number of ``edges`` that are <= c, as a balanced CASE tree.

    Equals ``Σ (c >= e_i)`` for sorted edges (duplicates allowed) with only
    ``log2(n)`` comparisons per row; NaN counts as larger than every edge, NULL
    stays NULL.
    """
    es = sorted(float(e) for e in edges)
    if isinstance(c, str):
        # a column name: the whole tree is SQL text parsed in one call
        x = f"CAST({sql_name(c)} AS DOUBLE)"

        def build_sql(lo: int, hi: int) -> str:
            if lo == hi:
                return str(lo)
            mid = (lo + hi) // 2
            return f"CASE WHEN {x} >= {sql_double(es[mid])} THEN {build_sql(mid + 1, hi)} ELSE {build_sql(lo, mid)} END"

        return F.expr(f"CASE WHEN {x} IS NULL THEN CAST(NULL AS INT) ELSE {build_sql(0, len(es))} END")
    xc = col_(c)

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(xc >= dlit(es[mid]), build(mid + 1, hi)).otherwise(build(lo, mid))

    return F.when(xc.isNull(), F.lit(None).cast("int")).otherwise(build(0, len(es)))


def histogram_bin(c: str | Column, edges: Sequence[float]) -> Column:
    """numpy.histogram bin index for sorted edges: bins are [e_i, e_i+1), last closed.

    Values outside [e_0, e_n] give NULL. With repeated edges numpy puts a value
    equal to the repeated edge into the last bin starting there, which interior
    edge counting reproduces.
    """
    x = F.col(c).cast("double") if isinstance(c, str) else c
    es = sorted(float(e) for e in edges)
    n_bins = len(es) - 1
    inner = count_edges_le(c, es[1:-1])
    return (F.when(x.isNull() | F.isnan(x), F.lit(None).cast("int"))
            .when((x < dlit(es[0])) | (x > dlit(es[-1])), F.lit(None).cast("int"))
            .otherwise(F.least(inner, F.lit(n_bins - 1))))


# --------------------------------------------------------------------------
# Engineered features
# --------------------------------------------------------------------------
def log_amount(amount: str | Column = "Amount") -> Column:
    a = F.coalesce(col_(amount).cast("double"), dlit(0.0))
    return F.log1p(F.greatest(F.nanvl(a, dlit(0.0)), dlit(0.0)))


def hour_of_day(time: str | Column = "Time") -> Column:
    t = F.coalesce(col_(time).cast("double"), dlit(0.0))
    t = F.greatest(F.nanvl(t, dlit(0.0)), dlit(0.0))
    return (t % dlit(86400.0)) / dlit(3600.0)


def is_night(hour: str | Column = "hour_of_day") -> Column:
    return (col_(hour) < dlit(6.0)).cast("int")


# --------------------------------------------------------------------------
# Risk (R1-R6)
# --------------------------------------------------------------------------
def clamp01(p: str | Column) -> Column:
    """p limited to [0, 1]; NULL and NaN give NULL (``least`` would skip them)."""
    x = col_(p).cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x), F.greatest(dlit(0.0), F.least(dlit(1.0), x)))


def risk_score(p: str | Column) -> Column:
    """int(floor(clamp(p) * 100 + 0.5)); NULL/NaN stay NULL (quarantined upstream)."""
    x = col_(p).cast("double")
    return (F.when(x.isNull() | F.isnan(x), F.lit(None).cast("int"))
            .otherwise(F.floor(clamp01(x) * dlit(100.0) + dlit(0.5)).cast("int")))


def _by_score(score: Column, low_max: int, medium_max: int, values: Sequence[str]) -> Column:
    return (F.when(score <= F.lit(low_max), F.lit(values[0]))
            .when(score <= F.lit(medium_max), F.lit(values[1]))
            .when(score.isNotNull(), F.lit(values[2])))


def risk_category(score: str | Column, policy: P.RiskPolicy = P.RiskPolicy()) -> Column:
    return _by_score(col_(score), policy.low_max, policy.medium_max, P.CATEGORY_LABELS)


def risk_color(score: str | Column, policy: P.RiskPolicy = P.RiskPolicy()) -> Column:
    return _by_score(col_(score), policy.low_max, policy.medium_max, P.CATEGORY_COLORS)


def risk_description(score: str | Column, policy: P.RiskPolicy = P.RiskPolicy()) -> Column:
    return _by_score(col_(score), policy.low_max, policy.medium_max, P.CATEGORY_DESCRIPTIONS)


def flagged(p: str | Column, threshold: float | Column) -> Column:
    t = threshold if isinstance(threshold, Column) else dlit(threshold)
    return clamp01(p) >= t


def by_flag(flag: Column, yes: str, no: str) -> Column:
    """NULL stays NULL: without a probability there is no decision."""
    return F.when(flag, F.lit(yes)).when(~flag, F.lit(no))


def decision(p: str | Column, threshold: float | Column) -> Column:
    return by_flag(flagged(p, threshold), P.DECISION_REVIEW, P.DECISION_ACCEPT)


def status_label(p: str | Column, threshold: float | Column) -> Column:
    return by_flag(flagged(p, threshold), P.STATUS_FLAGGED, P.STATUS_CLEARED)


def canonical_category(c: str | Column) -> Column:
    """LOW == LOW RISK etc.: upper-case, drop ' RISK', trim."""
    return F.trim(F.replace(F.upper(col_(c)), F.lit(" RISK"), F.lit("")))


def canonical_decision(c: str | Column) -> Column:
    """ACCEPT == ALLOW; REVIEW == MONITOR == FLAGGED FOR INVESTIGATION."""
    u = F.trim(F.upper(col_(c)))
    return (F.when(u.isin("ACCEPT", "ALLOW"), F.lit("ACCEPT"))
            .when(u.isin("REVIEW", "MONITOR", "FLAGGED FOR INVESTIGATION"), F.lit("REVIEW"))
            .otherwise(u))



# --------------------------------------------------------------------------
# Investigation priority (K1-K2)
# --------------------------------------------------------------------------
def exposure_factor(amount: str | Column) -> Column:
    amt = F.greatest(dlit(0.0), col_(amount).cast("double"))
    return dlit(1.0) + F.log10(F.greatest(amt, dlit(1.0)))


def priority_score(score: str | Column, amount: str | Column, is_flagged: str | Column) -> Column:
    s = F.greatest(F.lit(0), F.least(F.lit(100), col_(score).cast("int")))
    urgency = F.when(col_(is_flagged), dlit(1.25)).otherwise(dlit(1.0))
    return F.rint(s.cast("double") * exposure_factor(amount) * urgency).cast("int")


def _tier_index(score: str | Column, amount: str | Column, prio: Column) -> Column:
    s = F.greatest(F.lit(0), F.least(F.lit(100), col_(score).cast("int")))
    amt = F.greatest(dlit(0.0), col_(amount).cast("double"))
    return (F.when((prio >= 350) | ((s >= 80) & (amt >= dlit(250.0))), F.lit(0))
            .when((prio >= 200) | (s >= 70), F.lit(1))
            .when((prio >= 100) | (s >= 35), F.lit(2))
            .otherwise(F.lit(3)))


def priority_fields(score: str | Column, amount: str | Column, prio: Column) -> dict[str, Column]:
    idx = _tier_index(score, amount, prio)

    def pick(k: int, cast: str = "string") -> Column:
        arr = F.array(*[F.lit(t[k]) for t in P.PRIORITY_TIERS])
        return F.element_at(arr, idx + 1).cast(cast)

    return {
        "priority_tier": pick(0),
        "badge_class": pick(1),
        "priority_color": pick(2),
        "sla": pick(3),
        "sla_minutes": pick(4, "int"),
    }


# --------------------------------------------------------------------------
# Text (F11-F12)
# --------------------------------------------------------------------------
def escape_html(c: str | Column) -> Column:
    """html.escape(quote=True): & first, then < > " '."""
    x = col_(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def sanitise_notes(c: str | Column, max_chars: int = P.NOTES_MAX_CHARS) -> Column:
    return escape_html(F.substring(F.coalesce(col_(c), F.lit("")), 1, max_chars))


def normalise_status(c: str | Column) -> Column:
    return F.upper(F.trim(F.coalesce(col_(c), F.lit(P.DEFAULT_ACTION_STATUS))))


# --------------------------------------------------------------------------
# Deterministic pseudo-randomness (splits, samples, dummy model)
# --------------------------------------------------------------------------
def hash_key60(key: str | Column, seed: int) -> Column:
    """First 60 bits of md5(key|seed) as a non-negative bigint: a uniform sort key."""
    h = F.md5(F.concat(col_(key).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def hash_uniform(key: str | Column, seed: int) -> Column:
    """Uniform [0,1) from the first 32 bits of md5(key|seed)."""
    h = F.md5(F.concat(col_(key).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / dlit(4294967296.0)


# --------------------------------------------------------------------------
# Drift status (D3)
# --------------------------------------------------------------------------
def psi_status(psi: str | Column, labels: Sequence[str] = P.PSI_STATUS) -> Column:
    x = col_(psi)
    return (F.when(x < dlit(0.10), F.lit(labels[0]))
            .when(x < dlit(0.25), F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def psi_color(psi: str | Column) -> Column:
    return psi_status(psi, P.PSI_COLORS)


def safe_div(a: Column, b: Column, default: float = 0.0) -> Column:
    """a/b, or ``default`` when b is 0 or NULL (zero_division=default)."""
    return F.coalesce(F.try_divide(a.cast("double"), F.when(b != 0, b.cast("double"))), dlit(default))


def rnd(c: str | Column, digits: int) -> Column:
    """Report rounding floor(x * 10^d + 0.5) / 10^d: plain IEEE double maths, so
    every engine gives the same bits (engine ``round`` functions differ on
    values such as 1.005)."""
    scale = float(10 ** digits)
    if isinstance(c, str):
        # same expression as below, parsed from SQL text in one JVM call
        x, sc = f"CAST({sql_name(c)} AS DOUBLE)", sql_double(scale)
        return F.expr(f"CASE WHEN abs({x}) * {sc} < {sql_double(9e15)} "
                      f"THEN floor({x} * {sc} + 0.5D) / {sc} ELSE {x} END")
    x = col_(c).cast("double")
    return F.when(F.abs(x) * dlit(scale) < dlit(9e15),
                  F.floor(x * dlit(scale) + dlit(0.5)) / dlit(scale)).otherwise(x)


def sig(c: str | Column, digits: int = 9) -> Column:
    """Round to ``digits`` significant digits with exact powers of ten only
    (statistics summed in different orders agree to ~1e-15 relative, so
    comparing them needs significant-digit rounding, not decimal places)."""
    if isinstance(c, str):
        # same expression as below, parsed from SQL text in one JVM call
        x = f"CAST({sql_name(c)} AS DOUBLE)"
        k = f"({digits - 1} - floor(log10(abs({x}))))"
        up = f"pow(10.0D, CAST({k} AS DOUBLE))"
        down = f"pow(10.0D, CAST((- {k}) AS DOUBLE))"
        return F.expr(f"CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 OR abs({x}) = CAST('Infinity' AS DOUBLE) "
                      f"THEN {x} WHEN {k} >= 0 THEN floor({x} * {up} + 0.5D) / {up} "
                      f"ELSE floor({x} / {down} + 0.5D) * {down} END")
    x = col_(c).cast("double")
    e = F.floor(F.log10(F.abs(x)))
    k = F.lit(digits - 1) - e
    up = F.pow(dlit(10.0), k.cast("double"))
    down = F.pow(dlit(10.0), (-k).cast("double"))
    return (F.when(x.isNull() | F.isnan(x) | (x == 0) | (F.abs(x) == dlit(float("inf"))), x)
            .when(k >= 0, F.floor(x * up + dlit(0.5)) / up)
            .otherwise(F.floor(x / down + dlit(0.5)) * down))
