"""Mixing sources to target weights by entropy balancing.

Wanted is a rate (expected copies) for every document, as close as possible to one
in relative entropy, such that each source yields its target of words and no
document more than ``cap`` copies. The dual of that convex problem has one
multiplier per source, and its solution is an exponential tilt of the document's
size: ``rate = min(cap, exp(multiplier * size / mean size))``. Among all mixes with
these word counts it spreads the budget over the most documents.

The dual is solved by Newton's method. Its gradient and curvature are sums over
documents that depend on source and size alone, so documents are counted per
(source, size) once, and every iteration is one aggregation of those counts. Sums
are decimals: they do not depend on the order of partial sums, and reruns agree.

Rates become copies on the counts too. A running sum over a source's sizes, from
the largest down, rounds each size's total so that errors cancel; what is still
missing or too much is repaired on the largest size that fits into the rest. Only
then the documents of one size are told apart, by hash order in parts of bounded
size, so a source, or a size, that holds a third of all rows is never gathered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import count_words, materialise, spare
from tidegauge.session import metadata_table

CAP = 3
WEIGHTS = (5.0, 2.0, 1.0)
TOLERANCE = 1e-9
ITERATIONS = 60
REPAIRS = 4
PART = 256  # documents of one source and size that are put in order together, about


def targets(sizes: Sequence[float], weights: Sequence[float], cap: float = CAP) -> list[float]:
    """Share the sum of all sizes by weight; none above ``cap`` times its size, the excess reshared."""
    out = [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0]
    left = float(sum(sizes))
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * unit > cap * sizes[i]]
        if not full:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = float(cap * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in set(full)]
    return out


def multipliers(cells: DataFrame, means: Sequence[float], wanted: Sequence[float], totals: Sequence[int], cap: float) -> list[float]:
    """Newton iterations on the dual, one aggregation of ``cells`` (sid, size, count) each.

    The step is taken on the logarithm of the yield, and kept inside the interval
    that the signs seen so far leave; outside of it the interval is halved (or, while
    it is still open, widened). A source at its cap, or without words, needs none.
    """
    solved = [w <= 0 or w >= cap * t * (1 - 1e-12) for w, t in zip(wanted, totals)]
    found = [0.0 if w <= 0 or not done else math.inf for w, done in zip(wanted, solved)]
    low, high = [-math.inf] * len(wanted), [math.inf] * len(wanted)
    spark = cells.sparkSession
    for _ in range(ITERATIONS):
        active = [i for i, done in enumerate(solved) if not done]
        if not active:
            break
        state = metadata_table(spark, [(i, found[i], means[i]) for i in active], "sid int, tilt double, mean double")
        scaled = F.col("size") / F.col("mean")
        rate = F.exp(F.col("tilt") * scaled)
        words = F.col("count") * F.col("size")
        exact = "decimal(38,6)"
        sums = (
            cells.where("size > 0")
            .join(state, "sid")
            .groupBy("sid")
            .agg(
                F.sum((words * F.least(rate, F.lit(float(cap)))).cast(exact)).alias("yield"),
                F.sum(F.when(rate < cap, words * scaled * rate).otherwise(0.0).cast(exact)).alias("slope"),
            )
        )
        for row in sums.collect():  # one row per source
            i, got, slope = row["sid"], float(row["yield"]), float(row["slope"])
            if abs(got - wanted[i]) <= TOLERANCE * wanted[i]:
                solved[i] = True
                continue
            if got > wanted[i]:
                high[i] = found[i]
            else:
                low[i] = found[i]
            step = math.log(max(got, 1e-300) / wanted[i]) * got / slope if slope > 0 and got > 0 else math.inf
            guess = found[i] - step
            if not low[i] < guess < high[i]:
                if math.isinf(low[i]):
                    guess = 2 * high[i] - 1
                elif math.isinf(high[i]):
                    guess = 2 * low[i] + 1
                else:
                    guess = (low[i] + high[i]) / 2
            if guess == found[i]:
                solved[i] = True
            found[i] = guess
    return found


def cell_copies(cells: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """Copies of each (sid, size): rounded rates, then repaired towards the target.

    A source has at most as many cells as there are different sizes.
    """
    rate = F.least(F.exp(F.col("tilt") * F.col("size") / F.col("mean")), F.lit(float(cap)))
    rate = F.when(F.col("target") <= 0, 0.0).when(F.col("tilt") == float("inf"), float(cap)).otherwise(rate)
    down = Window.partitionBy("sid").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    all_cells = Window.partitionBy("sid")
    out = (
        cells.join(sources, "sid")
        .withColumn("wanted", F.col("count") * rate)
        .withColumn("running", F.sum("wanted").over(down))
        .withColumn("copies", (F.floor(F.col("running") + 0.5) - F.floor(F.col("running") - F.col("wanted") + 0.5)).cast("long"))
        .withColumn("copies", F.least(F.greatest("copies", F.lit(0)), F.col("count") * cap))
    )
    for _ in range(REPAIRS):
        missing = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(all_cells)
        out = out.withColumn("missing", missing)
        spare = F.when(F.col("missing") > 0, F.col("count") * cap - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("missing")) & (spare > 0)
        out = out.withColumn("chosen", F.max(F.when(fits, F.col("size"))).over(all_cells))
        change = F.least(spare, F.floor(F.abs("missing") / F.col("size")).cast("long"))
        signed = F.when(F.col("missing") > 0, change).otherwise(-change)
        out = out.withColumn("copies", F.when(F.col("chosen") == F.col("size"), F.col("copies") + signed).otherwise(F.col("copies")))
    return out.select("sid", "size", "count", "copies")


def mix(documents: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP, key: str = "doc_id", group: str = "source", size: Column | None = None) -> DataFrame:
    """One row per document: key, group, size, group_size, target, copies, taken.

    Groups in code-point order, NULL last, take ``weights`` in turn, repeating; all
    sizes together are shared out by weight, at most ``cap`` times its own size to a
    group. Empty and NULL texts have size 0 and take no words; repeated rows are
    documents of their own; an empty table gives an empty result. ``size`` defaults
    to the number of words in ``text``; columns besides key, group and text are not read.
    """
    spark = documents.sparkSession
    sized = materialise(
        documents.select(F.col(key).alias("key"), F.col(group).alias("group"), (count_words(F.col("text")) if size is None else size.cast("long")).alias("size"))
    )
    by_group = sized.groupBy("group", "size").agg(F.count(F.lit(1)).alias("count"))
    totals = by_group.groupBy("group").agg(F.sum(F.col("size") * F.col("count")).alias("words"), F.sum("count").alias("n")).collect()  # one row per source
    totals.sort(key=lambda r: (r["group"] is None, (r["group"] or "").encode()))
    words = [int(r["words"]) for r in totals]
    wanted = targets(words, [weights[i % len(weights)] for i in range(len(totals))], cap)
    means = [max(1.0, r["words"] / r["n"]) for r in totals]
    names = metadata_table(spark, [(r["group"], i) for i, r in enumerate(totals)], "group string, sid int")
    named = F.col("a.group").eqNullSafe(F.col("b.group"))
    cells = materialise(by_group.alias("a").join(names.alias("b"), named).select("sid", "size", "count"))
    tilts = multipliers(cells, means, wanted, words, cap)
    sources = metadata_table(
        spark, list(zip(range(len(totals)), words, wanted, tilts, means)), "sid int, group_size bigint, target double, tilt double, mean double"
    )
    dealt = cell_copies(cells, sources.drop("group_size"), cap)

    rows = sized.alias("a").join(names.alias("b"), named).select("a.key", "a.group", "a.size", "b.sid")
    rows = rows.join(dealt, ["sid", "size"])
    # documents of one size in parts of about PART, put in order by hash; each part
    # starts the count of extra copies at its own place, a lone part at none
    parts = F.ceil(F.col("count") / PART)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), parts))
    first = F.when(parts > 1, F.pmod(F.xxhash64("sid", "size", "part"), F.col("count"))).otherwise(0)
    turn = Window.partitionBy("sid", "size", "part").orderBy(F.xxhash64("key"), "key")
    extra = F.col("copies") % F.col("count")
    at = F.row_number().over(turn).cast("long")
    # dealt by part: else the join's partitioning would do for the window, with a common size in one task
    rows = rows.repartition("sid", "size", "part").withColumn("at", at).withColumn("first", first)
    passed = F.floor((F.col("at") * extra + F.col("first")) / F.col("count")) - F.floor(((F.col("at") - 1) * extra + F.col("first")) / F.col("count"))
    rows = rows.withColumn("copies", (F.floor(F.col("copies") / F.col("count")) + passed).cast("long"))
    return rows.join(sources.select("sid", "group_size", "target"), "sid").select(
        F.col("key").alias(key), F.col("group").alias(group), "size", "group_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(documents: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mixed corpus: every document as often as it was taken, all its columns kept.

    Documents that share a ``doc_id`` share its copies, the earlier texts first.
    """
    copies, n = spare(documents, "copies"), spare(documents, "rows")
    taken = mix(documents, weights, cap).groupBy("doc_id").agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(n))
    rows = documents.alias("a").join(taken.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))).select("a.*", f"b.{copies}", f"b.{n}")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.length("text"), "text"))
    own = F.floor(F.col(copies) / F.col(n)) + F.when(nth <= F.col(copies) % F.col(n), 1).otherwise(0)
    each = rows.withColumn(n, own.cast("int")).where(F.col(n) > 0)
    return each.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*documents.columns)
