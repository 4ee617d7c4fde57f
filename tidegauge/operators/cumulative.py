"""Exact ordered statistics without ever sorting a whole group in one task.

Values are first reduced to counts per distinct value. A sketch of the value
distribution (taken once, a few hundred numbers per feature) cuts the value axis
into buckets of similar size; running sums are formed inside each bucket and
shifted by the totals of the buckets before it. The sketch only balances the work:
any cut points give the same, exact answer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidegauge.functions.clean import finite, long_numeric, quoted, with_buckets
from tidegauge.operators.joins import keyed_join
from tidegauge.session import small_rows

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 1024
SKETCH_ACCURACY = 10_000


def sketch_features(
    df: DataFrame,
    features: Sequence[str],
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> dict[str, tuple[int, Cuts]]:
    """Per numeric column: finite count and the cut points that balance its buckets.

    One map-side-combined aggregate; the result is one row.
    """
    return sketch_with(df, features, (), rows_per_bucket=rows_per_bucket)[0]


def sketch_with(
    df: DataFrame, features: Sequence[str], extra: Sequence[Column], *, rows_per_bucket: int = ROWS_PER_BUCKET
) -> tuple[dict[str, tuple[int, Cuts]], Row | None]:
    """The sketch together with other aggregates of the same pass."""
    names = [f for f in features if f in df.columns]
    if not names and not extra:
        return {}, None
    points = ", ".join(f"{i / MAX_BUCKETS!r}D" for i in range(MAX_BUCKETS + 1))
    aggs = list(extra)
    columns = {f"__v{i}": finite(quoted(f)) for i, f in enumerate(names)}
    for i, _ in enumerate(names):
        aggs += [
            F.count(f"__v{i}").alias(f"n{i}"),
            F.expr(f"approx_percentile(__v{i}, array({points}), {SKETCH_ACCURACY})").alias(f"p{i}"),
        ]
    row = df.withColumns(columns).agg(*aggs).first()
    out = {}
    for i, f in enumerate(names):
        n, grid = row[f"n{i}"], row[f"p{i}"] or []
        cuts = thin(sorted(set(grid)), n, rows_per_bucket)
        if cuts.sub > 1:
            cuts = refined(df.select(columns[f"__v{i}"].alias("x")), sorted(set(grid)), rows_per_bucket)
        cuts.grid = grid
        out[f] = (n, cuts)
    return out, row


def refined(values: DataFrame, grid: Sequence[float], rows_per_bucket: int) -> Cuts:
    """Cut points for more buckets than one sketch can tell apart: a sketch within each of its ranges.

    Ranges are halved by counts, not by widths, so that a long tail makes no heavy
    bucket; each gets as many parts as its own count calls for. One more pass, which
    returns a row per range; a value that repeats is never divided.
    """
    placed = with_buckets(values.where("x is not null"), {"x": grid})
    per_range = placed.groupBy("x__b").agg(F.count(F.lit(1)).alias("n"))
    most = per_range.agg(F.max("n")).first()[0] or 0
    parts = max(2, -(-most // rows_per_bucket))
    points = ", ".join(f"{k / parts!r}D" for k in range(1, parts))
    sketched = placed.groupBy("x__b").agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_percentile(x, array({points}), {max(SKETCH_ACCURACY, 10 * parts)})").alias("p"))
    found = set(grid)
    for row in small_rows(sketched, MAX_BUCKETS + 2):
        own = -(-row["n"] // rows_per_bucket)  # parts of this range
        found |= {row["p"][min(parts - 2, max(0, round(k * parts / own) - 1))] for k in range(1, own)}
    return Cuts(sorted(found))


class Cuts(list):
    """Sorted cut points; ``sub`` equal-width parts between neighbours when many buckets are needed."""

    sub = 1
    # the sketch's evenly spaced quantiles the points were thinned from
    grid: Sequence[float] = ()


def thin(grid: Sequence[float], n: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> Cuts:
    """Keep as many cut points as the row count calls for, or say into how many parts each range is to be cut."""
    wanted = -(-n // rows_per_bucket)
    if wanted <= 1 or not grid:
        return Cuts()
    if wanted - 1 >= len(grid):
        out = Cuts(grid)
        out.sub = max(1, -(-wanted // len(grid))) if wanted > MAX_BUCKETS else 1
        return out
    step = len(grid) / (wanted - 1)
    return Cuts(sorted({grid[min(len(grid) - 1, int((k + 0.5) * step))] for k in range(wanted - 1)}))


def merge_splits(*sources: dict[str, tuple[int, Cuts]]) -> dict[str, Cuts]:
    """Union of the cut points of several tables, per feature."""
    out: dict[str, Cuts] = {}
    for source in sources:
        for f, (_, cuts) in source.items():
            merged = Cuts(sorted({*out.get(f, ()), *cuts}))
            merged.sub = max(getattr(out.get(f), "sub", 1), getattr(cuts, "sub", 1))
            out[f] = merged
    return out


def cumulate(
    counts: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], *, bucketed: bool
) -> DataFrame:
    """Add ``<s>_before``, ``<s>_upto`` and ``<s>_all`` for each summed column.

    ``counts`` holds one row per (by, order); with ``bucketed`` it carries the
    monotone ``bucket`` column. Without buckets (a size check said the groups are
    small) one window does it all.
    """
    by = list(by)
    if not bucketed:
        ordered = Window.partitionBy(*by).orderBy(order)
        out = counts
        for s in sums:
            out = out.withColumn(f"{s}_upto", F.sum(s).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        for s in sums:
            out = out.withColumn(
                f"{s}_all",
                F.sum(s).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            )
        return out.select("*", *[(F.col(f"{s}_upto") - F.col(s)).alias(f"{s}_before") for s in sums])

    totals = counts.groupBy(*by, "bucket").agg(*[F.sum(s).alias(s) for s in sums])
    across = Window.partitionBy(*by).orderBy("bucket")
    offsets = totals.select(
        *by,
        "bucket",
        *[
            F.coalesce(F.sum(s).over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"{s}_off")
            for s in sums
        ],
        *[
            F.sum(s).over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"{s}_all")
            for s in sums
        ],
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = counts
    for s in sums:
        local = local.withColumn(f"{s}_in", F.sum(s).over(inside))
    joined = keyed_join(local, offsets, [*by, "bucket"])
    kept = [c for c in counts.columns]
    return joined.select(
        *kept,
        *[(F.col(f"{s}_off") + F.col(f"{s}_in")).alias(f"{s}_upto") for s in sums],
        *[F.col(f"{s}_all") for s in sums],
        *[(F.col(f"{s}_off") + F.col(f"{s}_in") - F.col(s)).alias(f"{s}_before") for s in sums],
    )


def pick_positions(
    cumulated: DataFrame,
    by: Sequence[str],
    value: str,
    *,
    count: int,
    position: str,
    start: float,
    step: float,
    scale: str,
    weight: str = "n",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows standing at ``count`` evenly spaced positions of each group's order.

    ``position`` is SQL for the position in terms of ``i`` (0..count-1) and the
    group columns; it must equal ``(start + i*step) * scale`` up to rounding, which
    is only used to propose the few ``i`` that a row can hold. Returns
    ``by, i, frac, lo, hi`` and, for each carried column, its ``_lo``/``_hi``
    values (the rows holding the floor and the ceiling of the position).
    """
    before, upto = f"{weight}_before", f"{weight}_upto"
    first = f"greatest(0, cast(floor(({before} - 1) / nullif({scale}, 0) / {step!r}D - {start / step!r}D) as int) - 1)"
    last = (
        f"least({count - 1}, coalesce(cast(ceil({upto} / nullif({scale}, 0) / {step!r}D - {start / step!r}D) as int), "
        f"{count}) + 1)"
    )
    candidates = cumulated.select(
        *by,
        F.col(value).alias("v"),
        *dict.fromkeys([before, upto, f"{weight}_all", *carry]),
        F.explode(F.expr(f"CASE WHEN coalesce({first}, 0) <= {last} THEN sequence(coalesce({first}, 0), {last}) ELSE array() END")).alias("i"),
    )
    placed = candidates.withColumn("pos", F.expr(position))
    holds_lo = (F.floor("pos") >= F.col(before)) & (F.floor("pos") < F.col(upto))
    holds_hi = (F.ceil("pos") >= F.col(before)) & (F.ceil("pos") < F.col(upto))
    picked = placed.where(holds_lo | holds_hi)

    def at(flag, name):
        return F.max(F.when(flag, F.col(name)))

    return picked.groupBy(*by, "i").agg(
        F.max(F.col("pos") - F.floor("pos")).alias("frac"),
        at(holds_lo, "v").alias("lo"),
        at(holds_hi, "v").alias("hi"),
        *[at(holds_lo, c).alias(f"{c}_lo") for c in carry],
        *[at(holds_hi, c).alias(f"{c}_hi") for c in carry],
    )


def interpolated(lo: str = "lo", hi: str = "hi", frac: str = "frac"):
    """Linear interpolation between the two picked rows, exact when they agree."""
    return F.when(F.col(lo) == F.col(hi), F.col(lo)).otherwise(
        F.col(lo) + (F.col(hi) - F.col(lo)) * F.col(frac)
    )


def quantile_edges(
    counts: DataFrame, by: Sequence[str], *, bins: int, bucketed: bool, weight: str = "n", also: Sequence[str] = ()
) -> DataFrame:
    """``by, edges, below, <weight>_all``: sorted distinct linear quantiles at 0, 1/bins, ..., 1.

    ``below`` counts the values under each edge, which also gives the histogram on
    the edges. The group totals of the columns in ``also`` come along.
    """
    extra = [f"{c}_all" for c in also]
    before = f"{weight}_before"
    cum = cumulate(counts, by, "value", [weight, *also], bucketed=bucketed)
    picked = pick_positions(
        cum, by, "value", count=bins + 1, start=0.0, step=1.0 / bins,
        scale=f"({weight}_all - 1)", position=f"least(i * {1.0 / bins!r}D, 1.0D) * ({weight}_all - 1)", weight=weight,
        carry=[before, f"{weight}_all", *extra],
    ).withColumn("edge", interpolated())
    below = F.when(F.col("edge") == F.col("lo"), F.col(f"{before}_lo")).otherwise(F.col(f"{before}_hi"))
    marks = F.array_sort(F.collect_set(F.struct("edge", below.alias("below"))))
    return picked.groupBy(*by).agg(
        marks.alias("marks"), *[F.max(f"{c}_lo").alias(c) for c in (f"{weight}_all", *extra)]
    ).select(
        *by, F.col("marks.edge").alias("edges"), F.col("marks.below").alias("below"), f"{weight}_all", *extra
    )


def bracket_cuts(grid: Sequence[float], n: int, bins: int, buckets: int) -> Cuts:
    """Narrow value ranges that hold the wanted quantiles, as alternating start and end cuts.

    The sketch is off by less than one of its own steps, so one step to either side
    is enough; the caller checks that every quantile was really inside.
    """
    last = len(grid) - 1
    spans: list[list[float]] = []
    for j in range(bins + 1):
        lo = grid[max(0, math.floor(j * last / bins) - 1)]
        hi = math.nextafter(grid[min(last, math.ceil(j * last / bins) + 1)], math.inf)
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi)
        else:
            spans.append([lo, hi])
    cuts = Cuts(x for span in spans for x in span)
    # a bracket holds a few steps of the sketch, shared out like the other buckets
    cuts.sub = max(1, -(-4 * buckets // last))
    return cuts


def edge_rows(values: DataFrame, *, bins: int, bucketed: bool) -> list[Row]:
    """One row of quantile edges per feature from ``feature, bucket, value`` rows."""
    counts = values.groupBy("feature", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))
    return small_rows(quantile_edges(counts, ["feature"], bins=bins, bucketed=bucketed))


def reference_edges(
    df: DataFrame,
    features: Sequence[str],
    *,
    bins: int,
    sizes: dict[str, tuple[int, Cuts]],
) -> dict[str, tuple[list[float], list[int]]]:
    """Quantile edges and bin counts per column of one table (bins+1 numbers each).

    Of a large column only the values near a quantile are shuffled; the rest is
    counted. A column whose quantiles escape their brackets is done in full.
    """
    names = [f for f in features if f in sizes]
    if not names:
        return {}
    found: dict[str, Row] = {}
    large = [f for f in names if sizes[f][1] and sizes[f][1].grid]
    if large:
        brackets = {f: bracket_cuts(sizes[f][1].grid, sizes[f][0], bins, len(sizes[f][1]) * sizes[f][1].sub) for f in large}
        located = long_numeric(df, large, splits=brackets).where(F.abs("value") < float("inf"))
        part = F.col("bucket")
        for f, c in brackets.items():
            if c.sub > 1:
                part = F.when(F.col("feature") == f, F.floor(F.col("bucket") / c.sub)).otherwise(part)
        # values between brackets only count; odd parts are inside a bracket
        kept = located.withColumn("value", F.when(part % 2 == 1, F.col("value")))
        for r in edge_rows(kept, bins=bins, bucketed=True):
            if None not in r["edges"]:
                found[r["feature"]] = r
    rest = [f for f in names if f not in found]
    if rest:
        splits = {f: sizes[f][1] for f in rest}
        values = long_numeric(df, rest, splits=splits).where(F.abs("value") < float("inf"))
        found |= {r["feature"]: r for r in edge_rows(values, bins=bins, bucketed=any(splits.values()))}
    out: dict[str, tuple[list[float], list[int]]] = {f: ([], []) for f in names}
    for r in found.values():
        # outer bins are open-ended
        marks = [0, *r["below"][1:-1], r["n_all"]]
        counts_per_bin = [b - a for a, b in zip(marks, marks[1:])] if len(r["edges"]) > 1 else []
        out[r["feature"]] = (list(r["edges"]), counts_per_bin)
    return out
