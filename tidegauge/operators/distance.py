"""Two-sample statistics of many windows against one frozen reference.

A window never pulls in a copy of the reference. Parts of a sum that concern only
reference bins or categories missing from the window have closed forms, and the
reference distribution function is read at the window's own values by one ordered
pass over both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.clean import long_categorical, long_numeric, with_buckets
from tidegauge.operators.cumulative import (
    ROWS_PER_BUCKET,
    Cuts,
    cumulate,
    merge_splits,
    quantile_edges,
    sketch_features,
)
from tidegauge.operators.joins import keyed_join
from tidegauge.operators.profile import ReferenceProfile
from tidegauge.operators.windows import assign_windows
from tidegauge.types import CATEGORY_SCALE, MIN_VALUES, PSI_EPS, SlidingWindow

CONST = "__all"


def psi_term(cur: Column, ref: Column) -> Column:
    """One bin's contribution; both shares floored, not renormalised."""
    c, r = F.greatest(cur, F.lit(PSI_EPS)), F.greatest(ref, F.lit(PSI_EPS))
    return (c - r) * F.ln(c / r)


def unit_counts(
    long: DataFrame, by: Sequence[str], keys: Sequence[str], window: SlidingWindow | None
) -> DataFrame:
    """Counts per group and key; per axis unit first when windows overlap."""
    units = [window.axis] if window else []
    counts = long.groupBy(*by, *units, *keys).agg(F.count(F.lit(1)).alias("n"))
    return assign_windows(counts, window) if window else counts


def bin_counts(
    cur: DataFrame, profile: ReferenceProfile, by: Sequence[str], window: SlidingWindow | None = None
) -> DataFrame:
    """``by, feature, bin, n``: window histograms on the reference edges."""
    keep = [*by, *([window.axis] if window else [])]
    out_by = [*by, *(["window"] if window else [])]
    long = long_numeric(cur, profile.spec.num, keep, edges=profile.edges).where("bin is not null")
    counts = unit_counts(long, by, ["feature", "bin"], window)
    return counts.groupBy(*out_by, "feature", "bin").agg(F.sum("n").alias("n")) if window else counts


def psi_from_bins(bins: DataFrame, profile: ReferenceProfile, by: Sequence[str]) -> DataFrame:
    """``by, feature, n_cur_finite, psi`` from window histograms."""
    spark = bins.sparkSession
    totals = bins.withColumn(
        "n_cur_finite", F.sum("n").over(Window.partitionBy(*by, "feature"))
    )
    placed = totals.join(F.broadcast(profile.bin_table(spark)), ["feature", "bin"])
    term = psi_term(F.col("n") / F.col("n_cur_finite"), F.col("n_ref_bin") / F.col("n_ref_finite_bin"))
    grouped = placed.groupBy(*by, "feature").agg(
        F.max("n_cur_finite").alias("n_cur_finite"),
        F.max("n_ref_finite_bin").alias("n_ref_finite"),
        F.sum(term - F.col("absent_bin")).alias("present"),
    )
    absent = profile.feature_table(spark).where("kind = 'num' and usable").select("feature", "absent")
    return grouped.join(F.broadcast(absent), "feature").select(
        *by,
        "feature",
        "n_cur_finite",
        F.when(
            (F.col("n_cur_finite") >= MIN_VALUES) & (F.col("n_ref_finite") >= MIN_VALUES),
            F.col("present") + F.col("absent"),
        ).alias("psi"),
    )


def _with_bucket(df: DataFrame, splits: dict[str, Cuts]) -> DataFrame:
    """Bucket number of already-reduced (feature, value) rows."""
    used = {f: c for f, c in splits.items() if c}
    if not used:
        return df.withColumn("bucket", F.lit(0))
    own = {f"__x{i}": F.when(F.col("feature") == f, F.col("value")) for i, f in enumerate(used)}
    cut = {f"__x{i}": c for i, c in enumerate(used.values())}
    placed = with_buckets(df.withColumns(own), cut)
    number = F.lit(0)
    for i, f in enumerate(used):
        number = F.when(F.col("feature") == f, F.col(f"__x{i}__b")).otherwise(number)
    return placed.select(*df.columns, number.alias("bucket"))


def _running_per_bucket(parts: Sequence[DataFrame], sums: Sequence[str]) -> DataFrame:
    """``feature, bucket, <s>_off``: what lies in earlier buckets, for every bucket in use.

    One row per feature and bucket.
    """
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    totals = merged.groupBy("feature", "bucket").agg(*[F.sum(s).alias(s) for s in sums])
    before = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "feature", "bucket", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_off") for s in sums]
    )


def numeric_statistics(
    cur: DataFrame,
    profile: ReferenceProfile,
    by: Sequence[str],
    window: SlidingWindow | None = None,
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``by, feature, n_cur_valid, n_cur_finite, psi, ks`` exactly, for every group at once."""
    spec, spark = profile.spec, cur.sparkSession
    out_by = [*by, *(["window"] if window else [])]
    keep = [*by, *([window.axis] if window else [])]
    splits = merge_splits(
        profile.sizes, sketch_features(cur, spec.num, rows_per_bucket=rows_per_bucket)
    )
    bucketed = any(splits.values())
    long = long_numeric(cur, spec.num, keep, edges=profile.edges, splits=splits)
    rows = unit_counts(long, by, ["feature", "bucket", "bin", "value"], window)

    # size of each window's sample, and how much of it lies below each bucket
    groups = Window.partitionBy(*out_by, "feature")
    if bucketed:
        totals = rows.groupBy(*out_by, "feature", "bucket").agg(F.sum("n").alias("n"))
        before = groups.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            *out_by, "feature", "bucket",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cur_off"),
            F.sum("n").over(groups).alias("n_cur_valid"),
        )
        rows = keyed_join(rows, offsets, [*out_by, "feature", "bucket"])
    else:
        rows = rows.withColumn("cur_off", F.lit(0).cast("long")).withColumn("n_cur_valid", F.lit(None).cast("long"))

    reference = _with_bucket(profile.value_counts, splits).select("feature", "bucket", "value", "n_ref")
    both = rows.unionByName(reference, allowMissingColumns=True)
    # reference distribution at each window value: peers included, then before it
    ordered = Window.partitionBy("feature", "bucket").orderBy("value")
    located = both.withColumn(
        "ref_upto", F.coalesce(F.sum("n_ref").over(ordered.rangeBetween(Window.unboundedPreceding, 0)), F.lit(0))
    ).withColumn("ref_at", F.coalesce(F.sum("n_ref").over(ordered.rangeBetween(0, 0)), F.lit(0))).where("n is not null")
    own = Window.partitionBy("feature", "bucket", *out_by).orderBy("value")
    located = located.withColumn(
        "cur_upto", F.sum("n").over(own.rangeBetween(Window.unboundedPreceding, 0))
    ).withColumn("cur_at", F.sum("n").over(own.rangeBetween(0, 0)))

    if bucketed:
        in_use = [
            reference.groupBy("feature", "bucket").agg(F.sum("n_ref").alias("ref")),
            totals.groupBy("feature", "bucket").agg(F.lit(0).cast("long").alias("ref")),
        ]
        located = located.join(_running_per_bucket(in_use, ["ref"]), ["feature", "bucket"])
    else:
        whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        located = located.withColumn("ref_off", F.lit(0)).withColumn("n_cur_valid", F.max("cur_upto").over(whole))
    sizes = profile.feature_table(spark).where("kind = 'num'").select("feature", "n_ref_valid")
    located = located.join(F.broadcast(sizes), "feature")
    f_ref = (F.col("ref_off") + F.col("ref_upto")) / F.col("n_ref_valid")
    f_cur = (F.col("cur_off") + F.col("cur_upto")) / F.col("n_cur_valid")
    g_ref = (F.col("ref_off") + F.col("ref_upto") - F.col("ref_at")) / F.col("n_ref_valid")
    g_cur = (F.col("cur_off") + F.col("cur_upto") - F.col("cur_at")) / F.col("n_cur_valid")
    by_bin = located.groupBy(*out_by, "feature", "bin").agg(
        F.max("n_cur_valid").alias("n_cur_valid"),
        F.sum("n").alias("n"),
        F.max(F.greatest(F.abs(f_ref - f_cur), F.abs(g_ref - g_cur))).alias("ks"),
    )
    # at most bins+1 rows per group from here on; a NULL bin holds the infinities
    sized = by_bin.withColumn(
        "n_cur_finite", F.sum(F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(0)).over(groups)
    )
    placed = sized.join(F.broadcast(profile.bin_table(spark)), ["feature", "bin"], "left")
    term = psi_term(F.col("n") / F.col("n_cur_finite"), F.col("n_ref_bin") / F.col("n_ref_finite_bin"))
    merged = placed.groupBy(*out_by, "feature").agg(
        F.max("n_cur_valid").alias("n_cur_valid"),
        F.max("n_cur_finite").alias("n_cur_finite"),
        F.max("n_ref_finite_bin").alias("n_ref_finite"),
        F.max("ks").alias("ks"),
        F.sum(term - F.col("absent_bin")).alias("present"),
    )
    absent = profile.feature_table(spark).where("kind = 'num'").select("feature", "absent")
    measurable = (F.col("n_cur_finite") >= MIN_VALUES) & (F.col("n_ref_finite") >= MIN_VALUES)
    return merged.join(F.broadcast(absent), "feature").select(
        *out_by, "feature", "n_cur_valid", "n_cur_finite", "ks",
        F.when(measurable, F.col("present") + F.col("absent")).alias("psi"),
    )


def categorical_statistics(
    cur: DataFrame, profile: ReferenceProfile, by: Sequence[str], window: SlidingWindow | None = None
) -> DataFrame:
    """``by, feature, n_cur_valid, js, chi2, dof`` over the union of categories."""
    spark = cur.sparkSession
    out_by = [*by, *(["window"] if window else [])]
    keep = [*by, *([window.axis] if window else [])]
    counts = unit_counts(
        long_categorical(cur, profile.spec.cat, keep), by, ["feature", "category"], window
    )
    if window:
        counts = counts.groupBy(*out_by, "feature", "category").agg(F.sum("n").alias("n"))
    totals = counts.groupBy(*out_by, "feature").agg(F.sum("n").alias("n_cur_valid"))
    sizes = profile.feature_table(spark).where("kind = 'cat'").select(
        "feature", F.col("n_ref_valid").alias("n_ref_all"), "support"
    )
    cells = keyed_join(
        counts.join(profile.category_counts, ["feature", "category"], "left"), totals, [*out_by, "feature"]
    ).join(F.broadcast(sizes), "feature")
    n_ref, n_cur = F.coalesce(F.col("n_ref"), F.lit(0)), F.col("n")
    big_n, big_m = F.col("n_ref_all").cast("double"), F.col("n_cur_valid").cast("double")
    p, q = n_ref / big_n, n_cur / big_m
    m = F.greatest((p + q) * 0.5, F.lit(1e-12))
    js = F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)
    total = big_n + big_m
    e_ref, e_cur = (n_ref + n_cur) * big_n / total, (n_ref + n_cur) * big_m / total
    gap = F.abs(n_cur - e_cur)
    shrunk = gap - F.least(F.lit(0.5), gap)
    grouped = cells.groupBy(*out_by, "feature").agg(
        F.first("n_ref_all").alias("n_ref_all"),
        F.first("n_cur_valid").alias("n_cur_valid"),
        F.first("support").alias("support"),
        F.sum(n_ref).alias("seen_ref"),
        F.sum(F.when(F.col("n_ref").isNull(), 1).otherwise(0)).alias("only_cur"),
        F.sum(F.when(F.col("n_ref").isNotNull(), 1).otherwise(0)).alias("shared"),
        F.sum(js).alias("js"),
        F.sum(gap * gap * (1 / e_ref + 1 / e_cur)).alias("chi2"),
        F.sum(shrunk * shrunk * (1 / e_ref + 1 / e_cur)).alias("chi2_yates"),
    )
    # categories the window lacks: the JS term is the share itself, the
    # chi-squared cells of a lone missing category sum to r*M/N
    unseen = F.col("n_ref_all") - F.col("seen_ref")
    categories = F.col("support") + F.col("only_cur")
    share = F.when(F.col("n_ref_all") > 0, unseen / F.col("n_ref_all")).otherwise(0.0)
    missing_gap = unseen * F.col("n_cur_valid") / (F.col("n_ref_all") + F.col("n_cur_valid"))
    missing_shrunk = missing_gap - F.least(F.lit(0.5), missing_gap)
    missing_e_ref = unseen * F.col("n_ref_all") / (F.col("n_ref_all") + F.col("n_cur_valid"))
    yates = F.col("chi2_yates") + F.when(
        unseen > 0, missing_shrunk * missing_shrunk * (1 / missing_e_ref + 1 / missing_gap)
    ).otherwise(0.0)
    plain = F.col("chi2") + F.when(F.col("n_ref_all") > 0, unseen * F.col("n_cur_valid") / F.col("n_ref_all")).otherwise(0.0)
    return grouped.select(
        *out_by,
        "feature",
        "n_cur_valid",
        F.least(F.greatest(F.lit(0.5) * (F.col("js") + share), F.lit(0.0)), F.lit(1.0)).alias("js"),
        F.when(categories >= 2, F.when(categories == 2, yates).otherwise(plain)).alias("chi2"),
        F.when(categories >= 2, categories - 1).alias("dof"),
    )


def wasserstein_statistics(
    cur: DataFrame,
    profile: ReferenceProfile,
    by: Sequence[str],
    window: SlidingWindow | None = None,
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``by, feature, wasserstein``: area between the two distribution functions.

    Works on the quantile side, so that each window value is met by two look-ups in
    the reference and the reference is never repeated per window. A value ``c`` that
    spans ranks (a, b] contributes the integral of |Q_ref(u) - c| over them; with
    ``S(u)`` the running integral of Q_ref and ``w`` the reference share at ``c``
    clamped into [a, b], that is ``c*(w-a) - (S(w)-S(a)) + (S(b)-S(w)) - c*(b-w)``.
    """
    spec, spark = profile.spec, cur.sparkSession
    out_by = [*by, *(["window"] if window else [])]
    keep = [*by, *([window.axis] if window else [])]
    splits = merge_splits(profile.sizes, sketch_features(cur, spec.num, rows_per_bucket=rows_per_bucket))
    bucketed = any(splits.values())
    long = long_numeric(cur, spec.num, keep, splits=splits).where(F.abs("value") < float("inf"))
    rows = unit_counts(long, by, ["feature", "bucket", "value"], window)
    if window:
        rows = rows.groupBy(*out_by, "feature", "bucket", "value").agg(F.sum("n").alias("n"))

    reference = _with_bucket(
        profile.value_counts.where(F.abs("value") < float("inf")), splits
    ).select("feature", "bucket", "value", F.col("n_ref").alias("n"), (F.col("value") * F.col("n_ref")).alias("s"))
    ref = cumulate(reference, ["feature"], "value", ["n", "s"], bucketed=bucketed).select(
        "feature", "bucket", "value",
        (F.col("n_before") / F.col("n_all")).alias("a"), (F.col("n_upto") / F.col("n_all")).alias("b"),
        (F.col("s_before") / F.col("n_all")).alias("sa"), (F.col("s_upto") / F.col("n_all")).alias("sb"),
    )
    cumulative_shares = ref.select("feature", "bucket", (F.col("b") - F.col("a")).alias("share"), (F.col("sb") - F.col("sa")).alias("part"))
    win = cumulate(rows, [*out_by, "feature"], "value", ["n"], bucketed=bucketed).select(
        *out_by, "feature", "bucket", "value", F.col("n_all").alias("n_cur_finite"),
        (F.col("n_before") / F.col("n_all")).alias("a"), (F.col("n_upto") / F.col("n_all")).alias("b"),
    )

    # look-up 1, along the value axis: reference share and integral up to c
    nul = F.lit(None).cast("double")
    null_by = [F.lit(None).cast(win.schema[b].dataType).alias(b) for b in out_by]
    along_value = win.select(
        *out_by, "feature", "bucket", "value", "n_cur_finite", "a", "b", nul.alias("rb"), nul.alias("rs")
    ).unionByName(
        ref.select(
            *null_by, "feature", "bucket", "value", F.lit(None).cast("long").alias("n_cur_finite"),
            nul.alias("a"), nul.alias("b"), F.col("b").alias("rb"), F.col("sb").alias("rs"),
        )
    )
    ordered = Window.partitionBy("feature", "bucket").orderBy("value").rangeBetween(Window.unboundedPreceding, 0)
    shares = cumulative_shares.groupBy("feature", "bucket").agg(F.sum("share").alias("b0"), F.sum("part").alias("s0"))
    others = win.groupBy("feature", "bucket").agg(F.lit(0.0).alias("b0"), F.lit(0.0).alias("s0"))
    carry = _running_per_bucket([shares, others], ["b0", "s0"])
    at_value = (
        along_value.withColumn("wb", F.max("rb").over(ordered))
        .withColumn("ws", F.last("rs", ignorenulls=True).over(ordered))
        .where("n_cur_finite is not null")
        .join(carry, ["feature", "bucket"])
        .withColumn("ws", F.coalesce("ws", "s0_off"))
        .withColumn("wb", F.coalesce("wb", "b0_off"))
        .select(*out_by, "feature", "value", "n_cur_finite", "a", "b", "wb", "ws")
    )

    # look-up 2, along the rank axis: the running integral at each rank boundary
    slots = max((len(c) * c.sub for c in splits.values()), default=0) + 1
    slot = lambda u: F.least(F.floor(u * slots), F.lit(slots - 1)).cast("int")
    levels = win.select(*out_by, "feature", F.col("b").alias("u")).withColumn("slot", slot(F.col("u")))
    # a reference value covers every slot its ranks touch; a heavy value is repeated
    # once per slot at most
    steps = ref.select("feature", "value", "a", "b", "sa").withColumn(
        "slot", F.explode(F.sequence(slot(F.col("a")), slot(F.col("b"))))
    )
    along_rank = levels.select(
        *out_by, "feature", "slot", "u", F.lit(0).alias("is_step"), nul.alias("value"), nul.alias("sa"),
    ).unionByName(
        steps.select(
            *null_by, "feature", "slot", F.col("a").alias("u"), F.lit(1).alias("is_step"), "value", "sa",
        )
    )
    # a level on a boundary belongs to the step that ends there; both give the same integral
    by_rank = Window.partitionBy("feature", "slot").orderBy("u", F.col("is_step").desc()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    last_step = F.last(F.when(F.col("is_step") == 1, F.struct("u", "value", "sa")), ignorenulls=True).over(by_rank)
    at_rank = (
        along_rank.withColumn("step", last_step)
        .where("is_step = 0")
        .select(*out_by, "feature", "u", (F.col("step.sa") + (F.col("u") - F.col("step.u")) * F.col("step.value")).alias("S"))
    )
    # S(a) of a value is S(b) of the window value before it: sum by parts instead of looking back
    piece = F.when(F.col("wb") <= F.col("a"), 0).when(F.col("wb") >= F.col("b"), 2).otherwise(1)
    c, a, b, w, sw = (F.col(x) for x in ("value", "a", "b", "wb", "ws"))
    direct = (
        F.when(piece == 0, -c * (b - a))
        .when(piece == 2, c * (b - a))
        .otherwise(c * (w - a) - c * (b - w) - 2 * sw)
    )
    # coefficient of S(a) and S(b) in each case
    ca = F.when(piece == 0, -1.0).otherwise(1.0)
    cb = F.when(piece == 2, -1.0).otherwise(1.0)
    terms = at_value.select(*out_by, "feature", "n_cur_finite", a.alias("a"), b.alias("b"), direct.alias("direct"), ca.alias("ca"), cb.alias("cb"))
    coefficients = terms.select(*out_by, "feature", F.col("a").alias("u"), F.col("ca").alias("k")).where("u > 0").unionByName(
        terms.select(*out_by, "feature", F.col("b").alias("u"), F.col("cb").alias("k"))
    ).groupBy(*out_by, "feature", "u").agg(F.sum("k").alias("k")).where("k <> 0")
    integral = keyed_join(coefficients, at_rank, [*out_by, "feature", "u"]).groupBy(*out_by, "feature").agg(
        F.sum(F.col("k") * F.col("S")).alias("from_levels")
    )
    base = terms.groupBy(*out_by, "feature").agg(
        F.sum("direct").alias("direct"), F.max("n_cur_finite").alias("n_cur_finite")
    )
    sizes = profile.feature_table(spark).where("kind = 'num'").select("feature", "n_ref_finite")
    return (
        keyed_join(base, integral, [*out_by, "feature"], "left")
        .join(F.broadcast(sizes), "feature")
        .select(
            *out_by, "feature",
            F.when(
                (F.col("n_cur_finite") >= MIN_VALUES) & (F.col("n_ref_finite") >= MIN_VALUES),
                F.greatest(F.col("direct") + F.coalesce("from_levels", F.lit(0.0)), F.lit(0.0)),
            ).alias("wasserstein"),
        )
    )


# ---------------------------------------------------------------------------
# both sides vary by group (calibration splits)
# ---------------------------------------------------------------------------
def paired_psi(
    counts: DataFrame, by: Sequence[str], *, bins: int, bucketed: bool
) -> DataFrame:
    """PSI per group from ``by, bucket, value, n0, n1`` counts; edges come from side 0."""
    by = list(by)
    finite_counts = counts.where(F.abs("value") < float("inf"))
    groups = quantile_edges(
        finite_counts, by, bins=bins, bucketed=bucketed, weight="n0", also=["n1"]
    ).select(
        *by, "n0_all", "n1_all", F.size("edges").alias("n_edges"),
        F.expr("slice(edges, 2, greatest(size(edges) - 2, 0))").alias("inner"),
    )
    placed = finite_counts.join(groups, by).withColumn(
        "bin", F.size(F.filter("inner", lambda e: e <= F.col("value")))
    )
    binned = placed.groupBy(*by, "bin").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"),
        *[F.first(c).alias(c) for c in ("n0_all", "n1_all", "n_edges")],
    )
    term = psi_term(F.col("n1") / F.col("n1_all"), F.col("n0") / F.col("n0_all"))
    return binned.groupBy(*by).agg(
        F.first("n0_all").alias("n0"), F.first("n1_all").alias("n1"), F.first("n_edges").alias("n_edges"),
        F.sum(term).alias("psi"),
    ).select(
        *by, "n0", "n1",
        F.when((F.col("n0") >= MIN_VALUES) & (F.col("n1") >= MIN_VALUES) & (F.col("n_edges") >= 3), F.col("psi")).alias("psi"),
    )


def paired_js(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Scaled Jensen-Shannon effect per group from ``by, category, n0, n1`` counts."""
    by = list(by)
    totals = counts.groupBy(*by).agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    cells = keyed_join(counts, totals, by)
    p, q = F.col("n0") / F.col("t0"), F.col("n1") / F.col("t1")
    m = F.greatest((p + q) * 0.5, F.lit(1e-12))
    js = F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)
    return cells.groupBy(*by).agg(
        F.first("t0").alias("n0"), F.first("t1").alias("n1"), F.sum(js * 0.5).alias("js")
    ).select(
        *by, "n0", "n1",
        F.when(
            (F.col("n0") >= MIN_VALUES) & (F.col("n1") >= MIN_VALUES),
            F.least(F.greatest(F.col("js"), F.lit(0.0)), F.lit(1.0)),
        ).alias("js"),
    )


def paired_effects(
    samples: DataFrame,
    by: Sequence[str],
    num: Sequence[str],
    cat: Sequence[str],
    *,
    bins: int,
    splits: dict[str, Cuts],
    side: str = "side",
) -> DataFrame:
    """``by, feature, kind, n0, n1, effect`` comparing side 1 with side 0 in every group."""
    by = list(by)

    def sided(long: DataFrame, keys: Sequence[str]) -> DataFrame:
        return long.groupBy(*by, *keys).agg(
            F.count_if(F.col(side) == 0).alias("n0"), F.count_if(F.col(side) == 1).alias("n1")
        )

    parts = []
    if num:
        counts = sided(
            long_numeric(samples, num, [*by, side], splits=splits), ["feature", "bucket", "value"]
        )
        psi = paired_psi(counts, [*by, "feature"], bins=bins, bucketed=any(splits.values()))
        parts.append(psi.select(*by, "feature", F.lit("num").alias("kind"), "n0", "n1", F.col("psi").alias("effect")))
    if cat:
        counts = sided(long_categorical(samples, cat, [*by, side]), ["feature", "category"])
        js = paired_js(counts, [*by, "feature"])
        parts.append(
            js.select(*by, "feature", F.lit("cat").alias("kind"), "n0", "n1", (F.col("js") * CATEGORY_SCALE).alias("effect"))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
