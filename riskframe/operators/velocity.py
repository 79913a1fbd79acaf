"""Entity velocity features (W1-W6) that stay exact when one entity is hot.

Frames [t - W, t] of an entity lie within two time blocks as long as the longest window. So each
event is sent to (entity, its block) and, without its other columns, to (entity, the next
block): two rows an event, whatever the number of windows. There the block's events, in order
of time, are summed once, and a frame is the difference of two prefix sums found by
binary search (whole numbers of millionths, so differences and moments are exact). A
task reads its groups one after the other and holds one at a time.

An entity with more than ``HOT_ROWS`` events in a block would make that group too large. Its
events take another way (:func:`_spread_stats`): range-frame sums as differences of
per-entity prefix sums,

    sum over [t - W, t] = S(events <= t) - S(events < t - W)

where each event emits a probe at ``t`` (after its peers) and one probe per window at
``t - W``, and the prefix sums come from :func:`ordered.running_sums`, which
range-buckets an entity by time and so spreads it over many tasks. Both ways give the
same numbers. The previous event (W4) is an equi-join on (entity, rank - 1) - unique
keys, hence no skew. A NULL entity is a group of its own, as in ``PARTITION BY``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import dlit
from ..session import materialize
from .ordered import running_sums

DEC = "decimal(30,6)"
#: Squares of whole millionths (of values below 10^12): without places, sums lose none.
DEC_SQ, DEC_ROOT = "decimal(38,0)", "decimal(18,0)"


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


#: Events of an entity in a block of the longest window that one task may hold.
HOT_ROWS = 1_000_000
#: Values are whole millionths, in two numbers: units = hi * LIMB + lo.
UNIT, LIMB = 1_000_000, 1 << 32


def sliding_stats(df: DataFrame, entity: str, ts: str, key: str, value: str | None, windows: dict[str, int],
                  moments: bool = False, hot_rows: int | None = None) -> DataFrame:
    """Per event and window name: ``{name}_count`` and ``{name}_sum`` of ``value`` over events
    of the same entity with time in [t - W, t] (W in seconds; peers at t included, as a
    RANGE frame). ``moments`` adds ``{name}_mean`` and ``{name}_std`` (population) of the
    frame without the event itself, NULL where nothing is left. A missing value counts as 0;
    events without a time are each other's peers."""
    v = F.coalesce(F.col(value).cast(DEC), F.lit(0).cast(DEC)) if value else F.lit(0).cast(DEC)
    units = (v * F.lit(UNIT)).cast("decimal(38,0)")
    longest = max(int(w) for w in windows.values()) * 1_000_000
    hi = F.floor(units / F.lit(LIMB)).cast("long")
    ev = df.withColumns({"_e": F.col(entity), "_t": _micros(ts), "_hi": hi})
    ev = ev.withColumns({"_b": F.floor(F.col("_t") / F.lit(longest)), "_lo": (units - F.col("_hi").cast("decimal(38,0)") * F.lit(LIMB)).cast("long")})
    limit = HOT_ROWS if hot_rows is None else hot_rows
    hot = materialize(ev.groupBy("_e", "_b").count().where(F.col("count") > F.lit(limit)).select(F.col("_e").alias("_hot")).distinct(),
                      "hot-entities")
    if hot.isEmpty():
        return _block_stats(ev, df, windows, longest, moments)
    is_hot = F.col("_e").eqNullSafe(F.col("_hot"))
    some = _block_stats(ev.join(hot, is_hot, "left_anti"), df, windows, longest, moments)
    rest = df.join(hot, F.col(entity).eqNullSafe(F.col("_hot")), "left_semi")
    return some.unionByName(_spread_moments(rest, entity, ts, key, value, windows) if moments
                            else _plain(_spread_stats(rest, entity, ts, key, value, windows), df, windows))


def _plain(out: DataFrame, df: DataFrame, windows: dict[str, int]) -> DataFrame:
    return out.select(*df.columns, *[c for n in windows for c in (
        f"{n}_count", F.col(f"{n}_sum").cast("decimal(38,6)").alias(f"{n}_sum"))])


def _block_stats(ev: DataFrame, df: DataFrame, windows: dict[str, int], longest: int, moments: bool) -> DataFrame:
    """Two rows an event: in its block, and in the next one as history."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    at = F.explode(F.when(F.col("_t").isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("_ahead")
    both = ev.select("_e", "_b", "_t", "_hi", "_lo", row.alias("_row"), at)
    both = both.select("_e", (F.col("_b") + F.col("_ahead")).alias("_b"), "_t", "_hi", "_lo",
                       F.when(F.col("_ahead") == 0, F.col("_row")).alias("_row"), (F.col("_ahead") == 0).alias("_own"))
    both = both.repartition("_e", "_b").sortWithinPartitions("_e", "_b", "_t")
    fields = [T.StructField("_row", both.schema["_row"].dataType)]
    for n in windows:
        fields += [T.StructField(f"{n}_count", T.LongType()), T.StructField(f"{n}_hi", T.LongType()), T.StructField(f"{n}_lo", T.LongType())]
        if moments:
            fields += [T.StructField(f"{n}_mean", T.DoubleType()), T.StructField(f"{n}_std", T.DoubleType())]
    spans = [int(w) * 1_000_000 for w in windows.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, ("_e", "_b")):
            yield from frames(groups, spans, longest, moments).to_batches(max_chunksize=10_000)

    out = both.mapInArrow(run, T.StructType(fields))
    cols = [F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    for n in windows:
        total = F.col(f"{n}_hi").cast("decimal(20,0)") * F.lit(LIMB).cast("decimal(12,0)") + F.col(f"{n}_lo")
        cols += [F.col(f"{n}_count"), (total.cast("decimal(31,0)") / F.lit(UNIT)).cast("decimal(38,6)").alias(f"{n}_sum")]
        cols += [F.col(f"{n}_{m}") for m in ("mean", "std")] if moments else []
    return out.select(*cols)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Sorted rows as tables that hold whole groups, with the group's number in ``_g``."""

    def starts(b: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(max(0, b.num_rows - 1), bool)
        for k in keys:
            x = b.column(k)
            differ = pc.fill_null(pc.not_equal(x[1:], x[:-1]), False)
            new |= pc.or_(differ, pc.xor(pc.is_null(x[1:]), pc.is_null(x[:-1]))).to_numpy(zero_copy_only=False)
        return np.flatnonzero(new) + 1

    def numbered(held: list[pa.RecordBatch]) -> pa.Table:
        b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        g = np.zeros(b.num_rows, np.int64)
        g[starts(b)] = 1
        return pa.Table.from_batches([b]).append_column("_g", pa.array(np.cumsum(g)))

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        edge = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), b.slice(0, 1)]).combine_chunks().to_batches()[0] if held else None
        at = starts(b)
        cut = int(at[-1]) if len(at) else 0 if edge is not None and len(starts(edge)) else None
        if cut is None:
            held.append(b)
            continue
        if held or cut:
            yield numbered([*held, b.slice(0, cut)] if cut else held)
        held = [b.slice(cut)]
    if held:
        yield numbered(held)


def frames(rows: pa.Table, spans: list[int], longest: int, moments: bool) -> pa.Table:
    """Counts and sums of the frames of the own rows of whole groups, each sorted by time."""
    rows = rows.combine_chunks()
    filled = {c: pc.fill_null(rows.column(c), 0).to_numpy() for c in ("_b", "_t", "_hi", "_lo")}
    own = np.flatnonzero(rows.column("_own").to_numpy())
    # history is at [0, longest) of the group's stretch, its own rows at [longest, 2 * longest)
    place = rows.column("_g").to_numpy() * (4 * longest) + filled["_t"] - (filled["_b"] - 1) * longest
    if pc.any(pc.is_null(rows.column("_t"))).as_py():
        place = np.where(rows.column("_t").is_null().to_numpy(), rows.column("_g").to_numpy() * (4 * longest) + longest, place)
    until = np.searchsorted(place, place[own], side="right")
    hi, lo = (np.concatenate([[0], np.cumsum(filled[c])]) for c in ("_hi", "_lo"))
    if moments:
        x = filled["_hi"].astype(object) * LIMB + filled["_lo"]  # whole numbers of any size
        s, q = (np.concatenate([np.array([0], object), np.cumsum(y)]) for y in (x, x * x))
    out = [rows.column("_row").take(pa.array(own))]
    names = ["_row"]
    for i, span in enumerate(spans):
        since = np.searchsorted(place, place[own] - span, side="left")
        out += [pa.array(y) for y in (until - since, hi[until] - hi[since], lo[until] - lo[since])]
        if moments:
            n = (until - since - 1).astype(object)
            left, sq = s[until] - s[since] - x[own], q[until] - q[since] - x[own] * x[own]
            mean = [a / (k * UNIT) if k else None for a, k in zip(left, n, strict=True)]
            std = [math.sqrt((k * b - a * a) / (k * UNIT) ** 2) if k else None for a, b, k in zip(left, sq, n, strict=True)]
            out += [pa.array(mean, pa.float64()), pa.array(std, pa.float64())]
        names += [f"{k}{i}" for k in (("c", "h", "l", "m", "d") if moments else ("c", "h", "l"))]
    return pa.table(out, names=names)


def _spread_stats(df: DataFrame, entity: str, ts: str, key: str, value: str | None,
                  windows: dict[str, int], n_buckets: int | None = None,
                  with_sumsq: bool = False) -> DataFrame:
    """:func:`sliding_stats` for hot entities. Per event and window name: ``{name}_count``, ``{name}_sum`` and (with
    ``with_sumsq``) ``{name}_sumsq`` of ``value`` over events of the same
    entity with time in [t - W, t] (W in seconds; peers at t included, as a
    RANGE frame). Without ``with_sumsq`` the wide-decimal square column is
    never built, shuffled or summed."""
    v = F.col(value).cast(DEC) if value else F.lit(0).cast(DEC)
    # an event is told apart by key, entity, time and value, so that a resubmitted
    # key keeps its own windows; equal rows have equal windows
    ident = {"_k": F.col(key), "_e": F.col(entity), "_t": _micros(ts), "_v": v}
    ev = df.select(*[c.alias(n) for n, c in ident.items()])
    names = list(windows)
    zero = [F.lit(0).cast("bigint").alias("c"), F.lit(0).cast(DEC).alias("s")]
    own = [F.lit(1).cast("bigint").alias("c"), F.col("_v").alias("s")]
    if with_sumsq:
        zero.append(F.lit(0).cast(DEC_SQ).alias("q"))
        root = (F.col("_v") * F.lit(UNIT)).cast(DEC_ROOT)
        own.append((root * root).cast(DEC_SQ).alias("q"))
    stats = "csq" if with_sumsq else "cs"

    def row(kind: int, w: int, at: Column, values: list) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(w).alias("w"), at.alias("m"), *values)

    # the event, a probe after its peers, and one probe per window: one scan
    rows = [row(1, -1, F.col("_t"), own), row(2, -1, F.col("_t"), zero)]
    rows += [row(0, i, F.col("_t") - F.lit(int(windows[n]) * 1_000_000), zero) for i, n in enumerate(names)]
    allr = ev.select(*ident, F.explode(F.array(*rows)).alias("x")).select(
        *ident, F.col("x.kind").alias("_kind"), F.col("x.w").alias("_w"), F.col("x.m").alias("_m"),
        *[F.col(f"x.{c}").alias(f"_{c}") for c in stats])
    rs = running_sums(allr, ["_m", "_kind", "_k", "_w"], {x: f"_{x}" for x in stats},
                      partition_cols=["_e"], n_buckets=n_buckets)
    rs = rs.filter(F.col("_kind") != 1)
    aggs = [F.max(F.when(F.col("_kind") == 2, F.col(f"cum_{x}"))).alias(f"hi_{x}") for x in stats]
    for i, n in enumerate(names):
        aggs += [F.max(F.when((F.col("_kind") == 0) & (F.col("_w") == i), F.col(f"cum_{x}"))).alias(f"lo{i}_{x}")
                 for x in stats]
    per = rs.groupBy(*ident).agg(*aggs)
    suffix = {"c": "count", "s": "sum", "q": "sumsq"}
    cols = [F.col(n).alias(f"_p{n}") for n in ident]
    for i, n in enumerate(names):
        cols += [(F.col(f"hi_{x}") - F.coalesce(F.col(f"lo{i}_{x}"), F.lit(0))).alias(f"{n}_{suffix[x]}")
                 for x in stats]
    return _join_events(df.withColumns(ident), per.select(*cols), list(ident)).drop(*ident)


def _spread_moments(df: DataFrame, entity: str, ts: str, key: str, value: str, windows: dict[str, int]) -> DataFrame:
    """Mean and deviation for hot entities: sums of differences from the entity's mean, so that
    squares stay small next to the spread."""
    mid = materialize(df.groupBy(F.col(entity).alias("_me")).agg(F.avg(F.col(value).cast("double")).cast(DEC).alias("_mid")), "hot-means")
    off = df.join(mid, F.col(entity).eqNullSafe(F.col("_me"))).withColumn(
        "_off", F.coalesce(F.col(value).cast(DEC), F.lit(0).cast(DEC)) - F.col("_mid")).drop("_me")
    st = _spread_stats(off, entity, ts, key, "_off", windows, with_sumsq=True)
    cols = [F.col(f"`{c}`") for c in df.columns]
    for name in windows:
        n = F.nullif(F.col(f"{name}_count") - 1, F.lit(0))
        k = n.cast("double")
        d, held = ((F.col(c) * F.lit(UNIT)).cast(DEC_ROOT) for c in ("_off", f"{name}_sum"))
        rest = (held - d).cast(DEC_ROOT)
        shift = rest.cast("double") / k
        # squares around the whole part of the mean, exactly; what the mean has beyond it is tiny
        mid = F.floor(shift).cast(DEC_ROOT)
        inner = (mid * n.cast("decimal(10,0)")).cast("decimal(19,0)") - (rest + rest)
        about = (F.col(f"{name}_sumsq") - (d * d) + (mid * inner.cast("decimal(19,0)"))).cast(DEC_SQ)
        var = about.cast("double") / k - F.pow(shift - mid.cast("double"), 2)
        total = F.col(f"{name}_sum") + F.col("_mid") * F.col(f"{name}_count")
        cols += [F.col(f"{name}_count"), total.cast("decimal(38,6)").alias(f"{name}_sum"),
                 (F.col("_mid").cast("double") + shift / F.lit(UNIT)).alias(f"{name}_mean"),
                 (F.sqrt(F.greatest(var, dlit(0.0) * k)) / F.lit(UNIT)).alias(f"{name}_std")]
    return st.select(*cols)


def _join_events(df: DataFrame, per: DataFrame, ident: list[str]) -> DataFrame:
    """Null-safe join on the event's identity (columns ``_p...`` of ``per``)."""
    match = F.lit(True)
    for n in ident:
        match = match & F.col(n).eqNullSafe(F.col(f"_p{n}"))
    return df.join(per, match, "inner").drop(*[f"_p{n}" for n in ident])


def sliding_features(df: DataFrame, entity: str = "entity", ts: str = "ts", key: str = "id",
                     amount: str = "Amount", windows: dict[str, int] | None = None) -> DataFrame:
    """W1+W2: event counts and amount sums per window (default 5m ... 7d)."""
    windows = windows or {"w5m": 300, "w30m": 1800, "w1h": 3600, "w24h": 86400, "w7d": 604800}
    out = sliding_stats(df, entity, ts, key, amount, windows)
    return out.withColumns({f"{n}_sum": F.col(f"{n}_sum").cast("double") for n in windows})


def velocity_ratio(df: DataFrame, entity: str = "entity", ts: str = "ts", key: str = "id",
                   amount: str = "Amount", window_seconds: int = 30 * 86400, eps: float = 1e-9) -> DataFrame:
    """(amount - mean) / (std + eps) over the entity's previous ``window``
    of history (the current row excluded; population std; NULL without history)."""
    st = sliding_stats(df, entity, ts, key, amount, {"h": window_seconds}, moments=True)
    ratio = (F.col(amount).cast("double") - F.col("h_mean")) / (F.col("h_std") + dlit(eps))
    return st.select(*df.columns, (F.col("h_count") - 1).alias("history_count"), F.col("h_mean").alias("history_mean"),
                     F.col("h_std").alias("history_std"), ratio.alias("velocity_ratio"))


def previous_event(df: DataFrame, entity: str = "entity", ts: str = "ts", key: str = "id",
                   burst_seconds: float = 15.0, n_buckets: int | None = None) -> DataFrame:
    """Seconds since the entity's previous event (order ts, id) and the
    burst flag (< 15 s). Rank by distributed prefix count, then an equi-join
    on (entity, rank - 1)."""
    rk = running_sums(df.withColumn("_m", _micros(ts)), ["_m", key], {"r": F.lit(1).cast("bigint")},
                      partition_cols=[entity], n_buckets=n_buckets)
    prev = rk.select(F.col(entity).alias("_pe"), F.col("_m").alias("_pm"), (F.col("cum_r") + 1).alias("_pr"))
    j = rk.join(prev, F.col(entity).eqNullSafe(F.col("_pe")) & (F.col("cum_r") == F.col("_pr")), "left")
    gap = (F.col("_m") - F.col("_pm")) / dlit(1e6)
    return j.select(*df.columns, gap.alias("seconds_since_prev"),
                    F.coalesce(gap < dlit(burst_seconds), F.lit(False)).alias("is_burst"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    r = dlit(6371.0088)
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dl = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return dlit(2.0) * r * F.asin(F.sqrt(a))


def travel_speed(df: DataFrame, entity: str, ts: str, key: str, lat: str, lon: str,
                 max_kmh: float = 900.0, n_buckets: int | None = None) -> DataFrame:
    """km/h between consecutive events of an entity (haversine); above
    ``max_kmh`` is impossible travel and escalates to P1."""
    here = {"_m": _micros(ts), "_la": F.col(lat).cast("double"), "_lo": F.col(lon).cast("double")}
    rk = running_sums(df.withColumns(here), ["_m", key], {"r": F.lit(1).cast("bigint")}, partition_cols=[entity],
                      n_buckets=n_buckets)
    prev = rk.select(F.col(entity).alias("_pe"), F.col("_m").alias("_pm"), F.col("_la").alias("_pla"),
                     F.col("_lo").alias("_plo"), (F.col("cum_r") + 1).alias("_pr"))
    j = rk.join(prev, F.col(entity).eqNullSafe(F.col("_pe")) & (F.col("cum_r") == F.col("_pr")), "left")
    km = haversine_km(F.col("_pla"), F.col("_plo"), F.col("_la"), F.col("_lo"))
    hours = (F.col("_m") - F.col("_pm")) / dlit(3.6e9)
    speed = F.when(hours > 0, km / hours).when(km > 0, dlit(math.inf)).otherwise(dlit(0.0))
    return j.select(*df.columns, km.alias("km_from_prev"), speed.alias("kmh_from_prev"),
                    F.coalesce(speed > dlit(max_kmh), F.lit(False)).alias("impossible_travel"))


def named_windows(df: DataFrame, card: str, merchant: str, ts: str = "ts", key: str = "id",
                  amount: str = "Amount", label: str = "y") -> DataFrame:
    """Card count over 10 minutes, card amount over 1 hour, merchant fraud
    rate over 24 hours excluding the current row (NULL without history)."""
    c = sliding_stats(df, card, ts, key, amount, {"c10m": 600, "a1h": 3600})
    c = c.select(*df.columns, F.col("c10m_count").alias("card_count_10m"), F.col("a1h_sum").cast("double").alias("card_amount_1h"))
    m = sliding_stats(c, merchant, ts, key, label, {"m24h": 86400})
    rate = (F.col("m24h_sum") - F.col(label).cast(DEC)).cast("double") / (F.col("m24h_count") - 1).cast("double")
    return m.select(*c.columns, F.when(F.col("m24h_count") > 1, rate).alias("merchant_fraud_rate_24h"))
