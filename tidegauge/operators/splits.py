"""Effects between the random halves of very many repetitions, from one count of the values.

Which half a row falls into is a bit, and the bits of all repetitions are a word. Rows
are counted once per distinct value: how many there are, and for every repetition how
many of them have its bit. What is shuffled is one row per distinct value with a vector
of counts, not one row per value and repetition; repetitions come apart again behind
that shuffle, where only hits on a quantile and sums per bin go on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import stats
from tidegauge.functions.clean import long_categorical, long_numeric, quoted
from tidegauge.operators.cumulative import Cuts, interpolated, pick_positions
from tidegauge.operators.distance import paired_js, psi_term
from tidegauge.operators.joins import keyed_join
from tidegauge.types import CATEGORY_SCALE, MIN_VALUES

WORD = 62  # repetitions in one word
TOGETHER = 8  # repetitions whose hashes are worked out in one step
BROADCAST_NUMBERS = 4_000_000  # quantiles of all features and repetitions that are sent to every task


def with_side_words(df: DataFrame, key: str, repetitions: int, fraction: float, seed: int) -> tuple[DataFrame, list[str]]:
    """Add words whose bit r says that the row is on side 0 in repetition r; their names.

    The hash of ``stats.split_hash``, step by step: a step's number is squared in the
    next one, so each is a column of its own, a few repetitions at a time, which stays
    within what the JVM compiles.
    """
    m, cut = stats.HASH_MODULUS, int(stats.HASH_MODULUS * fraction)
    own = [quoted(c) for c in df.columns]
    words = [f"__w{w}" for w in range(-(-repetitions // WORD))]
    out = df.selectExpr(*own, f"pmod(cast({quoted(key)} as bigint), {m}) * {stats.HASH_KEY_STEP} AS __k", *[f"0L AS {w}" for w in words])
    for first in range(0, repetitions, TOGETHER):
        reps = range(first, min(first + TOGETHER, repetitions))
        out = out.selectExpr("*", *[f"(__k + {(r + seed + 1) * stats.HASH_REP_STEP}L) % {m} AS __x{r}" for r in reps])
        out = out.selectExpr(*own, "__k", *words, *[f"(__x{r} * __x{r} + {(r + seed) * stats.HASH_ROUND + 1}L) % {m} AS __y{r}" for r in reps])
        bits = {w: [r for r in reps if r // WORD == w] for w in range(len(words))}
        new = [
            " | ".join([word, *[f"CASE WHEN (__y{r} * __y{r} + {stats.HASH_ROUND}) % {m} < {cut} THEN {1 << (r % WORD)}L ELSE 0L END" for r in bits[w]]])
            + f" AS {word}"
            for w, word in enumerate(words)
        ]
        out = out.selectExpr(*own, "__k", *new)
    return out.drop("__k"), words


# The expressions below are SQL texts: with a dozen or more repetitions, building them
# call by call would take longer than running them.


def vector_counts(long: DataFrame, keys: Sequence[str], repetitions: int) -> DataFrame:
    """``keys, n, c0, c1, ...``: rows of each key and how many of them are on side 0, by repetition."""
    bits = ", ".join(f"sum((shiftright(__w{r // WORD}, {r % WORD}) & 1)) AS c{r}" for r in range(repetitions))
    names = ", ".join(keys)
    return long.sparkSession.sql(f"SELECT {names}, count(1) AS n, {bits} FROM {{rows}} GROUP BY {names}", rows=long)


def running(counts: DataFrame, sums: Sequence[str], bucketed: bool) -> DataFrame:
    """``<s>_upto`` and ``<s>_all`` of all sums along each feature's values, in one ordered pass."""
    all_rows = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    if not bucketed:
        along = "OVER (PARTITION BY feature ORDER BY value"
        return counts.selectExpr(
            "*", *[f"sum({s}) {along} {upto}) AS {s}_upto" for s in sums], *[f"sum({s}) {along} {all_rows}) AS {s}_all" for s in sums]
        )
    across = "OVER (PARTITION BY feature ORDER BY bucket"
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    totals = counts.groupBy("feature", "bucket").agg(*[F.expr(f"sum({s}) AS {s}") for s in sums]).selectExpr(
        "feature", "bucket", *[f"coalesce(sum({s}) {across} {before}), 0) AS {s}_off" for s in sums], *[f"sum({s}) {across} {all_rows}) AS {s}_all" for s in sums]
    )
    local = counts.selectExpr("*", *[f"sum({s}) OVER (PARTITION BY feature, bucket ORDER BY value {upto}) AS {s}_in" for s in sums])
    joined = keyed_join(local, totals, ["feature", "bucket"])
    return joined.selectExpr(*counts.columns, *[f"{s}_off + {s}_in AS {s}_upto" for s in sums], *[f"{s}_all" for s in sums])


def hits(repetitions: int, bins: int) -> str:
    """Array of the repetitions in which one of the half's quantiles may stand at a value, with its counts there.

    A value that a half lacks is at none of its quantiles.
    """

    def hit(r: int) -> str:
        step = f"greatest((c{r}_all - 1) / {float(bins)!r}D, 1e-3D)"
        return (
            f"CASE WHEN c{r} > 0 AND floor(c{r}_upto / {step} + 1e-6D) >= ceil((c{r}_upto - c{r} - 1) / {step} - 1e-6D) THEN "
            f"named_struct('rep', {r}, 'n0', c{r}, 'n0_before', c{r}_upto - c{r}, 'n0_upto', c{r}_upto, 'n0_all', c{r}_all, 'n1_all', n_all - c{r}_all) END"
        )

    return f"inline(array_compact(array({', '.join(map(hit, range(repetitions)))})))"


def split_psi(counts: DataFrame, features: int, repetitions: int, *, bins: int, bucketed: bool) -> DataFrame:
    """``rep, feature, n0, n1, psi`` from ``feature, bucket, value, n, c0, ...``; edges come from side 0."""
    sums = ["n", *[f"c{r}" for r in range(repetitions)]]
    standing = running(counts, sums, bucketed).selectExpr("feature", "value", hits(repetitions, bins))
    edge = pick_positions(
        standing, ["rep", "feature"], "value", count=bins + 1, start=0.0, step=1.0 / bins, scale="(n0_all - 1)",
        position=f"least(i * {1.0 / bins!r}D, 1.0D) * (n0_all - 1)", weight="n0", carry=["n0_all", "n1_all"],
    ).select("rep", "feature", interpolated().alias("edge"), "n0_all_lo", "n1_all_lo")
    groups = edge.groupBy("rep", "feature").agg(
        F.array_sort(F.collect_set("edge")).alias("edges"), F.max("n0_all_lo").alias("n0_all"), F.max("n1_all_lo").alias("n1_all")
    ).selectExpr("rep", "feature", "n0_all", "n1_all", "size(edges) AS n_edges", "slice(edges, 2, greatest(size(edges) - 2, 0)) AS inner_edges")
    # one row per feature: all repetitions' inner edges
    edges = groups.groupBy("feature").agg(F.expr("collect_list(struct(rep, inner_edges)) AS halves"))
    if features * repetitions * bins <= BROADCAST_NUMBERS:
        edges = F.broadcast(edges)
    vector = f"array({', '.join(sums[1:])}) AS c"
    placed = counts.selectExpr("feature", "value", "n", vector).join(edges, "feature").selectExpr(
        "feature",
        "inline(transform(halves, h -> named_struct('rep', h.rep, 'bin', size(filter(h.inner_edges, e -> e <= value)), 'n0', c[h.rep], 'n1', n - c[h.rep])))",
    )
    binned = placed.groupBy("rep", "feature", "bin").agg(F.expr("sum(n0) AS n0"), F.expr("sum(n1) AS n1"))
    term = psi_term(F.col("n1") / F.col("n1_all"), F.col("n0") / F.col("n0_all"))
    measurable = (F.col("n0") >= MIN_VALUES) & (F.col("n1") >= MIN_VALUES) & (F.col("n_edges") >= 3)
    return binned.join(groups.drop("inner_edges"), ["rep", "feature"]).groupBy("rep", "feature").agg(
        F.first("n0_all").alias("n0"), F.first("n1_all").alias("n1"), F.first("n_edges").alias("n_edges"), F.sum(term).alias("psi")
    ).select("rep", "feature", "n0", "n1", F.when(measurable, F.col("psi")).alias("psi"))


def split_effects(
    rows: DataFrame,
    num: Sequence[str],
    cat: Sequence[str],
    key: str,
    *,
    repetitions: int,
    fraction: float,
    seed: int,
    bins: int,
    splits: dict[str, Cuts],
) -> DataFrame:
    """``rep, feature, kind, n0, n1, effect`` of side 1 against side 0 in every repetition."""
    needed = [quoted(c) for c in rows.columns if c == key or c in num or c in cat]
    marked, words = with_side_words(rows.select(*needed), key, repetitions, fraction, seed)
    parts = []
    if num:
        long = long_numeric(marked, num, words, splits=splits).where(F.abs("value") < float("inf"))
        counts = vector_counts(long, ["feature", "bucket", "value"], repetitions)
        psi = split_psi(counts, len(num), repetitions, bins=bins, bucketed=any(splits.values()))
        parts.append(psi.select("rep", "feature", F.lit("num").alias("kind"), "n0", "n1", F.col("psi").alias("effect")))
    if cat:
        counts = vector_counts(long_categorical(marked, cat, words), ["feature", "category"], repetitions)
        halves = ", ".join(f"named_struct('rep', {r}, 'n0', c{r}, 'n1', n - c{r})" for r in range(repetitions))
        js = paired_js(counts.selectExpr("feature", "category", f"inline(array({halves}))"), ["rep", "feature"])
        parts.append(js.select("rep", "feature", F.lit("cat").alias("kind"), "n0", "n1", (F.col("js") * CATEGORY_SCALE).alias("effect")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
