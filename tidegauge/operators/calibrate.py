"""Noise floors, split calibration and the homogeneity index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import stats
from tidegauge.functions.clean import finite, literal, number, quoted, with_buckets
from tidegauge.functions.special import chi2_ppf
from tidegauge.operators.cumulative import (
    ROWS_PER_BUCKET,
    Cuts,
    cumulate,
    pick_positions,
    reference_edges,
    sketch_features,
    sketch_with,
    thin,
)
from tidegauge.operators.distance import paired_effects, paired_psi
from tidegauge.operators.splits import split_effects
from tidegauge.session import metadata_table, small_rows
from tidegauge.types import MIN_VALUES, MonitorSpec

Sizes = dict[str, tuple[int, Cuts]]

HOMOGENEOUS, SUSPECT, CONTAMINATED = "homogeneous", "suspect", "CONTAMINATED"


def homogeneity_verdict(h: Column | str) -> Column:
    h = stats.col(h)
    return F.when(h < 2, HOMOGENEOUS).when(h < 5, SUSPECT).when(h >= 5, CONTAMINATED)


def finite_cuts(sizes: Sizes) -> dict[str, Cuts]:
    return {f: cuts for f, (_, cuts) in sizes.items()}


def snap_to_grid(df: DataFrame, features: Sequence[str], cells: int) -> DataFrame:
    """Replace each numeric value by a cut point of its column's ``cells``-cell grid.

    Keeps distances between distributions to within one cell while the counts that
    are shuffled stay bounded by repetitions x columns x cells.
    """
    grids = {f: thin(cuts, cells, 1) for f, (_, cuts) in sketch_features(df, features, rows_per_bucket=1).items()}
    grids = {f: Cuts(g) for f, g in grids.items() if g}
    placed = with_buckets(df.withColumns({f: finite(quoted(f)) for f in grids}), grids)
    # the largest cut point not above the value; a mark below the first one for the rest
    marks = {f: ", ".join(f"{float(v)!r}D" for v in (g[0] - 1.0, *g)) for f, g in grids.items()}
    snapped = {f: F.expr(f"CASE WHEN {quoted(f)} IS NOT NULL THEN array({m})[{quoted(f + '__b')}] END") for f, m in marks.items()}
    return placed.withColumns(snapped).select(*df.columns)


# ---------------------------------------------------------------------------
# random split: the floor of the instrument
# ---------------------------------------------------------------------------
def random_split_effects(
    reference: DataFrame,
    spec: MonitorSpec,
    key: str,
    *,
    repetitions: int = 40,
    fraction: float = 0.5,
    seed: int = 0,
    cells: int | None = None,
    sizes: Sizes | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``rep, feature, kind, n0, n1, effect`` for every repetition in one job.

    All repetitions are counted together, one row per distinct value (``splits.py``).
    Sides come from an integer hash of (key, rep), so halves are near-equal rather than
    exactly equal. With ``cells`` the values are first snapped to a grid: counts are then
    bounded by columns x cells, which is the mode for very large references.
    """
    rows = reference
    if cells:
        rows = snap_to_grid(rows, spec.num, cells)
        splits = {f: Cuts() for f in spec.num}
    else:
        splits = finite_cuts(sizes or sketch_features(reference, spec.num, rows_per_bucket=rows_per_bucket))
    return split_effects(
        rows, spec.num, spec.cat, key, repetitions=repetitions, fraction=fraction, seed=seed, bins=spec.bins, splits=splits
    )


def random_floor(effects: DataFrame, *, quantile: float = 0.95) -> DataFrame:
    """One row: quantile, median, maximum and count of the per-repetition maxima."""
    per_rep = effects.groupBy("rep").agg(F.max("effect").alias("effect_max")).where("effect_max is not null")
    return per_rep.agg(
        F.percentile("effect_max", quantile).alias("aa_floor"),
        F.percentile("effect_max", 0.5).alias("aa_median"),
        F.max("effect_max").alias("aa_max"),
        F.count("effect_max").alias("n_repetitions"),
    )


# ---------------------------------------------------------------------------
# block split: the diagnosis of the reference
# ---------------------------------------------------------------------------
def _axis_number(df: DataFrame, axis: str) -> Column:
    kind = df.schema[axis].dataType.typeName()
    c = F.col(quoted(axis))
    if kind == "timestamp_ntz":
        c = c.cast("timestamp")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    return number(c)


# Where rows without an axis value stand: behind all others. Larger than any time or
# position, and far enough from the largest number to be calculated with.
LAST = 1e300


def _axis_place(df: DataFrame, axis: str) -> Column:
    return F.coalesce(_axis_number(df, axis), F.lit(LAST))


def block_bounds(
    df: DataFrame,
    axis: str,
    tie: str,
    blocks: int,
    features: Sequence[str] | None = None,
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> dict[str, tuple[int, list[tuple[float, float]]]]:
    """First row ``(axis, tie)`` of blocks 1, 2, ... (and of the remainder) per feature.

    Order positions are found by counting, first along the axis, then along the
    unique tie-breaker inside the few axis values where a block begins; the rows are
    never numbered. Rows without an axis value come last. ``features=None`` orders all rows, otherwise each feature orders
    the rows where it is finite. Returns row count and at most ``blocks`` bounds.
    """
    every = "__rows"
    a, t = _axis_place(df, axis), number(quoted(tie))
    base = df.select(a.alias("a"), t.alias("t"), *[finite(quoted(f)).alias(f"x{i}") for i, f in enumerate(features or [])])
    if features is None:
        long = base.select(F.lit(every).alias("feature"), "a", "t")
    else:
        present = F.array(*[F.when(F.col(f"x{i}").isNotNull(), F.lit(f)) for i, f in enumerate(features)])
        long = base.select(F.explode(F.array_compact(present)).alias("feature"), "a", "t")

    def located(rows: DataFrame, by: list[str], order: str, position: str, count: int, scale: str, start: float):
        size = sketch_features(rows, [order], rows_per_bucket=rows_per_bucket)[order]
        counts = (
            with_buckets(rows, {order: size[1]}).withColumnRenamed(f"{order}__b", "bucket")
            .groupBy(*by, "bucket", order)
            .agg(F.count(F.lit(1)).alias("n"))
        )
        cum = cumulate(counts, by, order, ["n"], bucketed=bool(size[1]))
        return pick_positions(
            cum, by, order, count=count, position=position, start=start, step=1.0, scale=scale,
            carry=["n_before", "n_all"],
        )

    size_sql = f"(n_all div {blocks})"
    rows = small_rows(
        located(long, ["feature"], "a", f"cast((i + 1) * {size_sql} as double)", blocks, size_sql, 1.0)
    )
    out: dict[str, tuple[int, list[tuple[float, float]]]] = {}
    wanted = {}
    for r in rows:
        if r["lo"] is None:
            continue
        n = r["n_all_lo"]
        offset = (r["i"] + 1) * (n // blocks) - r["n_before_lo"]
        wanted[(r["feature"], r["i"])] = (n, r["lo"], offset)
    inside = {k: v for k, v in wanted.items() if v[2] > 0}
    ties = {}
    if inside:
        # rows of the axis values in which a block begins part-way
        marks = sorted({(f, v[1]) for (f, _), v in inside.items()})
        condition = " or ".join(f"(feature = {literal(f)} and a = {x!r}D)" for f, x in marks)
        begun = long.where(condition)
        offsets = sorted({(f, v[1], v[2]) for (f, _), v in inside.items()})
        size = sketch_features(begun, ["t"], rows_per_bucket=rows_per_bucket)["t"]
        counts = (
            with_buckets(begun, {"t": size[1]}).withColumnRenamed("t__b", "bucket")
            .groupBy("feature", "a", "bucket", "t")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        cum = cumulate(counts, ["feature", "a"], "t", ["n"], bucketed=bool(size[1]))
        hit = " or ".join(
            f"(feature = {literal(f)} and a = {x!r}D and n_before <= {o} and n_upto > {o})" for f, x, o in offsets
        )
        for r in small_rows(cum.where(hit).select("feature", "a", "t", "n_before", "n_upto")):
            for f, x, o in offsets:
                if r["feature"] == f and r["a"] == x and r["n_before"] <= o < r["n_upto"]:
                    ties[(f, x, o)] = r["t"]
    for (f, i), (n, x, o) in sorted(wanted.items()):
        bound = (x, float("-inf") if o == 0 else ties[(f, x, o)])
        out.setdefault(f, (n, []))[1].append(bound)
    return out


def block_number_sql(bounds: Sequence[tuple[float, float]], a: str = "a", t: str = "t") -> str:
    """SQL for the block a row falls into."""
    parts = []
    for x, y in bounds:
        if y == float("-inf"):
            parts.append(f"CASE WHEN {a} >= {x!r}D THEN 1 ELSE 0 END")
        else:
            parts.append(f"CASE WHEN {a} > {x!r}D OR ({a} = {x!r}D AND {t} >= {y!r}D) THEN 1 ELSE 0 END")
    return " + ".join(parts) if parts else "0"


def block_split_effects(
    reference: DataFrame,
    spec: MonitorSpec,
    axis: str,
    tie: str,
    *,
    blocks: int = 2,
    sizes: Sizes | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``pair, feature, kind, n0, n1, effect`` of each block against the next one.

    Blocks are consecutive in (axis, tie); the remainder is dropped. ``tie`` must be
    unique, since the order of a distributed table is not a property of its rows.
    """
    blocks = max(blocks, 2)
    bounds = block_bounds(reference, axis, tie, blocks, rows_per_bucket=rows_per_bucket)["__rows"][1]
    splits = finite_cuts(sizes or sketch_features(reference, spec.num, rows_per_bucket=rows_per_bucket))
    rows = (
        reference.withColumn("__a", _axis_place(reference, axis))
        .withColumn("__t", number(quoted(tie)))
        .withColumn("block", F.expr(block_number_sql(bounds, "__a", "__t")))
        .where(F.col("block") < blocks)
    )
    # a row is side 0 of its own pair and side 1 of the pair before
    roles = F.array(
        F.struct(F.col("block").alias("pair"), F.lit(0).alias("side")),
        F.struct((F.col("block") - 1).alias("pair"), F.lit(1).alias("side")),
    )
    samples = rows.select(*spec.num, *spec.cat, F.inline(roles)).where(
        (F.col("pair") >= 0) & (F.col("pair") < blocks - 1)
    )
    return paired_effects(samples, ["pair"], spec.num, spec.cat, bins=spec.bins, splits=splits)


def block_floor(effects: DataFrame) -> DataFrame:
    """One row: largest effect between neighbouring blocks and the pair it occurs in."""
    per_pair = effects.groupBy("pair").agg(F.max("effect").alias("effect_max")).where("effect_max is not null")
    best = F.min(F.struct((-F.col("effect_max")).alias("k"), F.col("pair").alias("p")))
    return per_pair.agg(best.alias("b")).select(
        (-F.col("b.k")).alias("block_floor"),
        F.concat(F.col("b.p").cast("string"), F.lit("->"), (F.col("b.p") + 1).cast("string")).alias("worst_pair"),
    )


def measurable_numeric(reference: DataFrame, spec: MonitorSpec, sizes: Sizes | None = None) -> int:
    """Numeric features that can be measured against themselves, at least 1."""
    sizes = sizes or sketch_features(reference, spec.num)
    edges = reference_edges(reference, spec.num, bins=spec.bins, sizes=sizes)
    k = sum(1 for f in spec.num if sizes[f][0] >= MIN_VALUES and len(edges[f][0]) >= 3)
    return max(k, 1)


def calibrate(
    reference: DataFrame,
    spec: MonitorSpec,
    *,
    key: str,
    axis: str | None = None,
    mode: str = "both",
    repetitions: int = 40,
    blocks: int = 2,
    fraction: float = 0.5,
    quantile: float = 0.95,
    seed: int = 0,
    cells: int | None = None,
) -> DataFrame:
    """The whole calibration as one row: floors, H, verdict, suggested threshold.

    ``key`` is a unique integral row key; block mode needs ``axis`` as well.
    """
    if mode not in ("random", "block", "both"):
        raise ValueError("mode is random, block or both")
    if mode != "random" and axis is None:
        raise ValueError("block calibration needs an axis: rows have no order of their own")
    blocks = max(blocks, 2)
    sizes, row = sketch_with(reference, spec.num, [F.count(F.lit(1)).alias("n_rows")])
    n = row["n_rows"]
    k = measurable_numeric(reference, spec, sizes)
    half = n // 2
    pieces = []
    if mode != "block":
        pieces.append(
            random_floor(
                random_split_effects(
                    reference, spec, key, repetitions=repetitions, fraction=fraction, seed=seed, cells=cells,
                    sizes=sizes,
                ),
                quantile=quantile,
            )
        )
    if mode != "random":
        pieces.append(block_floor(block_split_effects(reference, spec, axis, key, blocks=blocks, sizes=sizes)))
    merged = pieces[0]
    for p in pieces[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    for name, kind in (
        ("aa_floor", "double"), ("aa_median", "double"), ("aa_max", "double"), ("n_repetitions", "long"),
        ("block_floor", "double"), ("worst_pair", "string"),
    ):
        if name not in merged.columns:
            merged = merged.withColumn(name, F.lit(None).cast(kind))
    merged = merged.agg(*[F.max(c).alias(c) for c in (
        "aa_floor", "aa_median", "aa_max", "n_repetitions", "block_floor", "worst_pair")])
    return assemble_calibration(merged, n=n, half=half, k=k, bins=spec.bins, blocks=blocks, quantile=quantile)


def assemble_calibration(
    measured: DataFrame, *, n: int, half: int, k: int, bins: int, blocks: int, quantile: float
) -> DataFrame:
    """Floors against their closed form; rounding as in the published record."""
    # the H ratio uses unrounded floors
    expected = stats.analytic_floor(F.lit(half), F.lit(n - half), bins=bins, k_features=k, quantile=quantile)
    size = n // blocks
    expected_block = stats.analytic_floor(F.lit(size), F.lit(size), bins=bins, k_features=k, quantile=quantile)
    with_null = measured.select(
        "*", expected.alias("expected"), (F.col("block_floor") / expected_block).alias("h")
    )
    base = F.greatest("aa_floor", "expected")
    return with_null.select(
        F.lit(n).cast("long").alias("n_reference"),
        F.lit(k).alias("k_features"),
        F.lit(bins).alias("bins"),
        F.round("aa_floor", 6).alias("aa_floor"),
        F.round("aa_median", 6).alias("aa_median"),
        F.round("aa_max", 6).alias("aa_max"),
        "n_repetitions",
        F.round("block_floor", 6).alias("block_floor"),
        "worst_pair",
        F.round("expected", 6).alias("analytic_floor"),
        F.round(F.col("aa_floor") / F.col("expected"), 2).alias("aa_ratio"),
        F.round("h", 2).alias("homogeneity"),
        homogeneity_verdict("h").alias("verdict"),
        F.round(base * 3.0, 6).alias("suggested_threshold"),
        F.coalesce(F.col("h") >= 5, F.lit(False)).alias("contaminated"),
    )


# ---------------------------------------------------------------------------
# homogeneity per feature
# ---------------------------------------------------------------------------
def homogeneity_by_feature(
    df: DataFrame,
    features: Sequence[str],
    *,
    key: str,
    axis: str | None = None,
    bins: int = 10,
    mode: str = "block",
    repetitions: int = 150,
    quantile: float = 0.95,
    seed: int = 0,
    min_values: int = 200,
    cells: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``feature, n, h, verdict``: first half against second half of each feature's
    finite values in axis order, or random halves."""
    sizes = sketch_features(df, features, rows_per_bucket=rows_per_bucket)
    kept = [f for f in features if sizes[f][0] >= min_values]
    if not kept:
        return metadata_table(df.sparkSession, [], "feature string, n bigint, h double, verdict string")
    splits = {f: sizes[f][1] for f in kept}
    spec = MonitorSpec(num=tuple(kept), bins=bins)
    if mode == "block":
        if axis is None:
            raise ValueError("block halves need an axis")
        bounds = block_bounds(df, axis, key, 2, kept, rows_per_bucket=rows_per_bucket)
        base = df.withColumn("__a", _axis_place(df, axis)).withColumn("__t", number(quoted(key)))
        slots = {f: f"__x{i}" for i, f in enumerate(kept)}
        base = base.select("__a", "__t", *[finite(quoted(f)).alias(s) for f, s in slots.items()])
        base = with_buckets(base, {s: splits[f] for f, s in slots.items()})
        # every feature has its own half-way point
        sides = ", ".join(
            f"named_struct('feature', {literal(f)}, 'value', {slots[f]}, 'bucket', {slots[f]}__b, 'side', {block_number_sql(bounds[f][1][:1], '__a', '__t')})"
            for f in kept
        )
        long = base.select(F.expr(f"inline(array({sides}))")).where("value is not null")
        counts = long.groupBy("feature", "bucket", "value").agg(
            F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1")
        )
        measured = paired_psi(counts, ["feature"], bins=bins, bucketed=any(splits.values()))
        measured = measured.select("feature", (F.col("n0") + F.col("n1")).alias("n"), "psi")
    else:
        effects = random_split_effects(
            df, spec, key, repetitions=repetitions, seed=seed, cells=cells, sizes={f: sizes[f] for f in kept},
            rows_per_bucket=rows_per_bucket,
        )
        measured = effects.groupBy("feature").agg(
            F.max(F.col("n0") + F.col("n1")).alias("n"), F.percentile("effect", quantile).alias("psi")
        )
    half = F.floor(F.col("n") / 2)
    floor = F.lit(chi2_ppf(quantile, bins - 1)) * (1.0 / half + 1.0 / (F.col("n") - half))
    scored = measured.select("feature", "n", (F.col("psi") / floor).alias("h")).where("h is not null")
    return scored.select("feature", "n", F.round("h", 2).alias("h"), homogeneity_verdict("h").alias("verdict"))


def homogeneity_audit(
    df: DataFrame,
    *,
    axis: str,
    key: str,
    features: Sequence[str],
    bins: int = 10,
    min_values: int = 501,
    repetitions: int = 150,
    cells: int | None = None,
) -> DataFrame:
    """Block H beside random H for each numeric column with more than 500 values."""
    sizes = sketch_features(df, features)
    usable = [f for f in features if f != axis and sizes[f][0] >= min_values]
    block = homogeneity_by_feature(df, usable, key=key, axis=axis, bins=bins)
    random = homogeneity_by_feature(
        df, usable, key=key, bins=bins, mode="random", repetitions=repetitions, cells=cells
    )
    return block.select("feature", "n", F.col("h").alias("h_block"), "verdict").join(
        random.select("feature", F.col("h").alias("h_random")), "feature"
    )


def audit_summary(audit: DataFrame, *, bins: int = 10, threshold: float = 0.1) -> DataFrame:
    """Share of contaminated features, medians, and how loose the common threshold is."""
    q = chi2_ppf(0.95, bins - 1)
    summary = audit.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(F.col("h_block") > 5).alias("n_contaminated"),
        F.percentile("h_block", 0.5).alias("h_block_median"),
        F.percentile("h_random", 0.5).alias("h_random_median"),
        F.max("n").alias("n"),
    )
    floor = F.lit(q) * 2.0 / F.floor(F.col("n") / 2)
    return summary.select("*", floor.alias("floor"), (F.lit(threshold) / floor).alias("slack"))


# ---------------------------------------------------------------------------
# floors in operation
# ---------------------------------------------------------------------------
def threshold_slack(
    counts: DataFrame, n_ref: Column | str, n_window: Column | str, *, threshold: float, bins: Sequence[int]
) -> DataFrame:
    """Per row of window counts and number of bins: floor, equivalent n, slack of a threshold."""
    out = counts.withColumn("bins", F.explode(F.array(*[F.lit(int(b)) for b in bins])))
    floor = equivalent = mean_n = F.lit(None).cast("double")
    for b in bins:
        here = F.col("bins") == b
        floor = F.when(here, stats.analytic_floor(n_ref, n_window, bins=b)).otherwise(floor)
        equivalent = F.when(here, stats.equivalent_n(threshold, bins=b)).otherwise(equivalent)
        mean_n = F.when(here, F.lit((b - 1) * 2.0 / threshold)).otherwise(mean_n)
    return out.select("*", floor.alias("floor"), equivalent.alias("n_p95"), mean_n.alias("n_mean")).withColumn(
        "slack", F.lit(threshold) / F.col("floor")
    )


def operational_floor(
    window_counts: DataFrame, *, n_ref: int, k_features: int, bins: int = 10, aa_ratio: float | None = None
) -> DataFrame:
    """Floor at (reference, median window) size; the threshold is three times it."""
    ratio = aa_ratio if aa_ratio and aa_ratio > 0 else 1.0
    median = window_counts.agg(F.percentile("n", 0.5).cast("long").alias("n_window"))
    floor = stats.analytic_floor(F.lit(n_ref), "n_window", bins=bins, k_features=k_features) * ratio
    return median.select(
        F.lit(n_ref).cast("long").alias("n_ref"), "n_window", floor.alias("floor"), (floor * 3.0).alias("threshold")
    )


def regime_verdict(slack: Column | str) -> Column:
    s = stats.col(slack)
    return (
        F.when(s.isNull(), "not assessable")
        .when(s > 10, "blind")
        .when(s > 3, "conservative")
        .when(s > 1, "transfers")
        .otherwise("perpetual alarm")
    )


def compare_regimes(first: DataFrame, second: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The threshold of one calibration in floors of another.

    Inputs are calibration rows; ``keys`` pairs several at once.
    """
    pair = list(keys) or ["__pair"]
    if not keys:
        first, second = first.withColumn("__pair", F.lit(0)), second.withColumn("__pair", F.lit(0))
    pick = ("n_reference", "analytic_floor", "suggested_threshold", "verdict")
    a = first.select(*pair, *[F.col(c).alias(f"{c}_1") for c in pick])
    b = second.select(*pair, *[F.col(c).alias(f"{c}_2") for c in pick])
    slack = F.when(F.col("analytic_floor_2") > 0, F.col("suggested_threshold_1") / F.col("analytic_floor_2"))
    ratio = F.when(F.col("analytic_floor_1") > 0, F.col("analytic_floor_2") / F.col("analytic_floor_1"))
    return a.join(b, pair).select(
        *keys,
        F.round(slack, 1).alias("threshold_in_floors"),
        F.round(ratio, 3).alias("floor_ratio"),
        stats.equivalent_n("suggested_threshold_1").alias("calibrated_for_n"),
        regime_verdict(slack).alias("regime"),
        ((F.col("verdict_1") == CONTAMINATED) | (F.col("verdict_2") == CONTAMINATED)).alias("contaminated"),
    )


def contract_violations(contracts: DataFrame, key: str) -> DataFrame:
    """One row per broken rule of each contract; empty when all are valid."""
    rules = F.array(
        F.when(F.col("threshold").isNull() | F.col("alpha").isNull() | F.col("min_obs").isNull() | F.col("floor").isNull(),
               "missing threshold"),
        F.when(F.col("threshold") <= F.col("floor"), "threshold inside the floor"),
        F.when((F.col("suite_total") > 0) & (F.col("suite_pass") < F.col("suite_total")), "suite has failures"),
    )
    return contracts.select(key, F.explode(F.array_compact(rules)).alias("violation"))
