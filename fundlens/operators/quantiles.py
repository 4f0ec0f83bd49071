"""Exact quantiles (linear interpolation) and descriptive statistics.

``percentile`` keeps every distinct value of a group in one aggregation
buffer and ``summary()`` is approximate. ``exact_quantiles`` selects by radix
instead: one histogram of all columns over logarithmic buckets serves all wanted
ranks; buckets that hold a rank and many rows are divided again; then the distinct values of
the buckets that hold a rank are counted and ranked. Every pass is one map-side combined count
over all columns, so no row is shuffled, and a value repeated on a third of the rows costs nothing.

Interpolation is done in DECIMAL, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.functions.exact import round_ratio
from fundlens.session import written

VALUE = T.DecimalType(24, 6)


def unpivot_values(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """``(coluna, valor, *ids)`` rows, one per non-NULL value of each column."""
    entries = [F.struct(F.lit(c).alias("coluna"), F.col(c).cast(VALUE).alias("valor")) for c in cols]
    return (df.select(*ids, F.explode(F.array(*entries)).alias("_e"))
              .select("_e.coluna", "_e.valor", *ids)
              .filter(F.col("valor").isNotNull()))


#: Buckets per unit of the logarithm in the first histogram, and parts of a bucket in each further one.
BUCKETS, FAN = 256, 4096
#: A bucket of at most this many rows is read; the finest level is read whatever it holds.
SMALL_BUCKET, FINEST = 10_000, 3


def _bucket(col: str, level: int) -> Column:
    """The value's bucket: a step function of it that never falls, finer with each level. Logarithms keep the number
    of buckets bounded (about 30 * BUCKETS a column at level 0) however the values are spread."""
    return F.col(f"_bucket_{col}") if level == 0 else _step(F.col(col).cast("double"), level)


def _step(x: Column, level: int) -> Column:
    return (F.signum(x) * F.floor(F.log1p(F.abs(x)) * float(BUCKETS * FAN ** level))).cast("long")


def _histogram(values: DataFrame, paths: Sequence[tuple]) -> dict[tuple, list[tuple[int, int]]]:
    """Per path ``(column, bucket at level 0, bucket at level 1, ...)`` the ascending (bucket, rows) one level below it,
    all in one map-side combined count."""
    def entry(i: int, path: tuple) -> Column:
        col, *above = path
        inside = F.col(col).isNotNull()
        for level, b in enumerate(above):
            inside = inside & (_bucket(col, level) == b)
        return F.when(inside, F.struct(F.lit(i).alias("i"), _bucket(col, len(above)).alias("b")))

    found = values.select(F.explode(F.array(*[entry(i, p) for i, p in enumerate(paths)])).alias("e")) \
        .filter("e IS NOT NULL").groupBy("e.i", "e.b").agg(F.count(F.lit(1)).alias("n")).collect()
    out: dict[tuple, list[tuple[int, int]]] = {p: [] for p in paths}
    for r in sorted(found, key=lambda r: (r["i"], r["b"])):
        out[paths[r["i"]]].append((r["b"], r["n"]))
    return out


def _distinct(values: DataFrame, paths: Sequence[tuple]) -> dict[tuple, list[tuple[Decimal, int]]]:
    """Per path the ascending (value, rows) in its bucket: each distinct value once."""
    def entry(i: int, path: tuple) -> Column:
        col, *above = path
        inside = F.col(col).isNotNull()
        for level, b in enumerate(above):
            inside = inside & (_bucket(col, level) == b)
        return F.when(inside, F.struct(F.lit(i).alias("i"), F.col(col).cast(VALUE).alias("v")))

    found = values.select(F.explode(F.array(*[entry(i, p) for i, p in enumerate(paths)])).alias("e")) \
        .filter("e IS NOT NULL").groupBy("e.i", "e.v").agg(F.count(F.lit(1)).alias("n")).collect()
    out: dict[tuple, list[tuple[Decimal, int]]] = {p: [] for p in paths}
    for r in sorted(found, key=lambda r: (r["i"], r["v"])):
        out[paths[r["i"]]].append((r["v"], r["n"]))
    return out


def _holding(parts: Sequence[tuple], rank: int) -> tuple:
    """(part, rows before it, its rows) of the part that holds the row of this rank."""
    below = 0
    for part, n in parts:
        if rank < below + n:
            return part, below, n
        below += n
    raise ValueError("the counts do not reach the rank")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75),
                    small: int = SMALL_BUCKET) -> DataFrame:
    """``(coluna, p, valor)``: the linear-interpolation quantile of each column.

    ``df`` is read two times or, where one of the first buckets holds many rows, a few times more: give a scan
    or a written table. Columns without values give no rows. The driver gets bucket counts,
    whose number is bounded, and the values of the buckets that hold a wanted rank.
    """
    # The first level's bucket is a column, computed once a value and pass: every wanted rank compares it.
    values = df.select(*cols, *[_step(F.col(c).cast("double"), 0).alias(f"_bucket_{c}") for c in cols])
    first = _histogram(values, [(c,) for c in cols])
    wanted, ranks = [], {}
    for c in cols:
        rows = sum(n for _, n in first[c,])
        for p in probs if rows else ():
            at = (rows - 1) * Decimal(str(p))
            low = int(at)
            both = (low, min(low + 1, rows - 1))
            wanted.append((c, p, at - low, both))
            for k in both:
                b, below, n = _holding(first[c,], k)
                ranks[c, k] = ((c, b), k - below, n)
    for level in range(1, FINEST + 1):
        wide = sorted({path for path, _, n in ranks.values() if n > small and len(path) == level + 1})
        if not wide:
            break
        finer = _histogram(values, wide)
        for key, (path, rank, _) in list(ranks.items()):
            if path in finer:
                b, below, n = _holding(finer[path], rank)
                ranks[key] = ((*path, b), rank - below, n)
    read = _distinct(values, sorted({path for path, _, _ in ranks.values()}, key=repr)) if ranks else {}
    pick = {key: _holding(read[path], rank)[0] for key, (path, rank, _) in ranks.items()}
    out = [(c, float(p), pick[c, a] + (pick[c, z] - pick[c, a]) * part) for c, p, part, (a, z) in wanted]
    return df.sparkSession.createDataFrame(
        [(c, p, v.quantize(Decimal(10) ** -12)) for c, p, v in out], "coluna string, p double, valor decimal(38,12)")


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75),
                     accuracy: int = 100_000) -> DataFrame:
    """``(coluna, p, valor)`` from mergeable sketches: one map-side combined aggregate,
    relative rank error ``1 / accuracy``."""
    long = unpivot_values(df, cols)
    q = long.groupBy("coluna").agg(F.percentile_approx("valor", list(probs), accuracy).alias("_q"))
    entries = [F.struct(F.lit(float(p)).alias("p"), F.col("_q")[i].alias("valor")) for i, p in enumerate(probs)]
    return q.select("coluna", F.explode(F.array(*entries)).alias("_e")).select("coluna", "_e.p", "_e.valor")


def describe(df: DataFrame, cols: Sequence[str], scale: int = 2, approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, 25%, 50%, 75%, max per column, rounded HALF_UP to ``scale``.

    Runs when it is called: the columns are written once, and the moments of all of them are observed on that
    write; quartiles come from :func:`exact_quantiles` of the written columns, or from
    :func:`approx_quantiles` (one pass) when ``approx``.
    """
    out_t, spark = T.DecimalType(38, scale), df.sparkSession
    seen = Observation("moments")
    values = written(df.select(*cols).observe(seen, *[x for c in cols for x in (
        F.count(c).alias(f"{c}_count"), F.sum(c).cast("decimal(38,6)").alias(f"{c}_sum"),
        F.stddev_samp(F.col(c).cast("double")).alias(f"{c}_std"),
        F.min(c).cast(VALUE).alias(f"{c}_min"), F.max(c).cast(VALUE).alias(f"{c}_max"))]), "describe")
    found = seen.get
    moments = spark.createDataFrame([(c, *[found[f"{c}_{k}"] for k in ("count", "sum", "std", "min", "max")]) for c in cols
                                     if found.get(f"{c}_count")],
                                    "coluna string, count long, _sum decimal(38,6), _std double, _min decimal(24,6), _max decimal(24,6)")
    q = approx_quantiles(values, cols) if approx else exact_quantiles(values, cols)
    qw = q.groupBy("coluna").agg(*[
        F.max(F.when(F.col("p") == p, F.col("valor"))).alias(name)
        for p, name in ((0.25, "_q25"), (0.5, "_q50"), (0.75, "_q75"))])
    return moments.join(F.broadcast(qw), "coluna").select(  # a row per column
        "coluna", "count",
        round_ratio(F.col("_sum"), F.col("count"), scale).alias("mean"),
        F.round(F.col("_std"), scale).cast(out_t).alias("std"),
        F.round("_min", scale).cast(out_t).alias("min"),
        F.round("_q25", scale).cast(out_t).alias("p25"),
        F.round("_q50", scale).cast(out_t).alias("p50"),
        F.round("_q75", scale).cast(out_t).alias("p75"),
        F.round("_max", scale).cast(out_t).alias("max"))
