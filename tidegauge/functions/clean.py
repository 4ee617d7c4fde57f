"""Entry cleaning and the long (one row per value) form of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(column: Column | str) -> Column:
    """Coerce to double; unparsable text and NaN become NULL, infinities stay."""
    x = (F.col(column) if isinstance(column, str) else column).try_cast("double")
    return F.when(~F.isnan(x), x)


def finite(column: Column | str) -> Column:
    """Like :func:`number`, with infinities dropped as well."""
    x = number(column)
    return F.when(F.abs(x) < float("inf"), x)


def infer_features(schema: T.StructType, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns of a schema; booleans count as categories."""
    num = [f.name for f in schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    cat = [
        f.name
        for f in schema
        if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude
    ]
    return num, cat


def bisect_sql(x: str, cuts: Sequence[float]) -> str:
    """SQL for the number of sorted ``cuts`` that are <= ``x``.

    A balanced CASE tree: log2(n) comparisons inside generated code.
    """

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {x} < {float(cuts[mid])!r}D THEN {tree(lo, mid)} ELSE {tree(mid + 1, hi)} END"

    return tree(0, len(cuts))


# beyond this many cut points a CASE tree outgrows what the JVM compiles well
MAX_TREE = 64


def with_buckets(df: DataFrame, cuts: Mapping[str, Sequence[float]], suffix: str = "__b") -> DataFrame:
    """Add ``<column><suffix>``: a bucket number that never falls as the value rises."""
    large = {c: list(x) for c, x in cuts.items() if len(x) > MAX_TREE}
    if large:
        infinity = float("inf")
        df = Bucketizer(
            splitsArray=[[-infinity, *x, infinity] for x in large.values()],
            inputCols=list(large),
            outputCols=[c + suffix for c in large],
            handleInvalid="keep",
        ).transform(df)
    numbers = {}
    for c, x in cuts.items():
        index = f"cast({quoted(c + suffix)} as int)" if c in large else bisect_sql(quoted(c), x)
        sub = getattr(x, "sub", 1)
        if sub > 1 and len(x) > 1:
            # equal-width parts between neighbouring cut points
            low = ", ".join(f"{float(v)!r}D" for v in x[:-1])
            rate = ", ".join(f"{min(sub / (b - a), 1e300)!r}D" for a, b in zip(x, x[1:]))
            part = f"least({sub - 1}, cast(({quoted(c)} - array({low})[{index} - 1]) * array({rate})[{index} - 1] as int))"
            index = f"({index}) * {sub} + CASE WHEN {index} BETWEEN 1 AND {len(x) - 1} THEN {part} ELSE 0 END"
        numbers[c + suffix] = F.expr(f"cast({index} as int)")
    return df.withColumns(numbers)


def long_numeric(
    df: DataFrame,
    features: Sequence[str],
    keep: Sequence[str | Column] = (),
    *,
    edges: Mapping[str, Sequence[float]] | None = None,
    splits: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """``keep..., feature, value[, bin][, bucket]`` with missing values removed.

    ``bin`` numbers the reference bins (half-open, NULL for infinities), ``bucket``
    the ranges that spread ordered work over tasks. Both compare with literals, so
    the whole step is narrow. A feature that the table lacks contributes no rows.
    """
    names = [f for f in features if f in df.columns]
    keep_names = [k if isinstance(k, str) else None for k in keep]
    if any(k is None for k in keep_names):
        raise TypeError("keep takes column names")
    schema = "feature string, value double"
    extra = []
    if edges is not None:
        schema += ", bin int"
        extra.append("bin")
    if splits is not None:
        schema += ", bucket int"
        extra.append("bucket")
    if not names:
        return df.select(*map(quoted, keep), F.lit(None).cast("string").alias("feature"),
                         F.lit(None).cast("double").alias("value"),
                         *[F.lit(None).cast("int").alias(e) for e in extra]).where(F.lit(False))
    slots = {f: f"__v{i}" for i, f in enumerate(names)}
    wide = df.select(*map(quoted, keep), *[number(quoted(f)).alias(s) for f, s in slots.items()])
    if splits is not None:
        wide = with_buckets(wide, {s: splits.get(f, ()) for f, s in slots.items()})
    structs = []
    for f, s in slots.items():
        fields = [f"'feature', {literal(f)}", f"'value', {s}"]
        if edges is not None:
            inner = list(edges.get(f, ()))[1:-1]
            fields.append(f"'bin', CASE WHEN abs({s}) < double('Infinity') THEN {bisect_sql(s, inner)} END")
        if splits is not None:
            fields.append(f"'bucket', {s}__b")
        structs.append(f"named_struct({', '.join(fields)})")
    return wide.select(
        *map(quoted, keep), F.expr(f"inline(array({', '.join(structs)}))")
    ).where(F.col("value").isNotNull())


def long_categorical(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep..., feature, category`` with categories as strings, missing removed."""
    names = [f for f in features if f in df.columns]
    if not names:
        return df.select(*map(quoted, keep), F.lit(None).cast("string").alias("feature"),
                         F.lit(None).cast("string").alias("category")).where(F.lit(False))
    structs = [
        f"named_struct('feature', {literal(f)}, 'category', cast({quoted(f)} as string))" for f in names
    ]
    return df.select(
        *map(quoted, keep), F.expr(f"inline(array({', '.join(structs)}))")
    ).where(F.col("category").isNotNull())
