"""Exact discrete quantiles (``percentile_disc`` semantics), computed distributed.

``percentile_disc`` keeps a map of every distinct value of a group in one
task.  For text lengths that map is small, but for a continuous column at
scale it is unbounded.  This operator narrows down instead:

1. One aggregation gives each group its weight, its number of rows and, from
   a sketch of fixed size, cut values of about equal ranges.
2. While a range that holds wanted ranks has more than ``range_rows`` rows,
   rows are counted per part of it (a map-side combine, so a few numbers per task),
   once for all ranks in it; the parts that hold ranks become the new search
   ranges, and a sketch of the rows inside -- of no others -- gives their cuts.
   A cut value is a part of its own, so a value held by many rows is found
   at once and never sorted.
3. The rows of the last ranges -- and only they -- are summed by value and one
   running sum a range finds all its ranks.

The rows inside the search ranges are stored after each round, so all rows are read
three times at most, whatever the number of rounds.

Nothing is capped: more rows take more rounds (each divides a range by about
``RANGES``), and no task sorts more than about ``range_rows`` values.  The
sketch only decides how the work is cut; the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopy.operators._lineage import durable, release

RANGES = 256
RANGE_ROWS = 2_000_000  # rows one task may have to sort in the last step


def bucket_of(value: Column, bounds: list[float] | Column, n_bounds: int | None = None) -> Column:
    """Range index of ``value``: the number of bounds strictly below it.

    A balanced tree of comparisons -- a plain ``CASE`` expression, ``log2(n)``
    comparisons per row, compiled by whole-stage codegen.
    """
    v = value.cast("double")
    if isinstance(bounds, Column):
        if n_bounds is None:
            raise ValueError("n_bounds is needed with an array column of bounds")
        count = n_bounds

        def at(i):
            return F.element_at(bounds, i + 1)
    else:
        count = len(bounds)
        literals = [F.lit(float(b)) for b in bounds]

        def at(i):
            return literals[i]

    def first_not_below(lo: int, hi: int) -> Column:
        # number of bounds < v, knowing it lies in [lo, hi] (bounds ascending)
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(v > at(mid), first_not_below(mid + 1, hi)).otherwise(first_not_below(lo, mid))

    return first_not_below(0, count)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    by: Sequence[str] = (),
    weight: str | Column | None = None,
    ranges: int = RANGES,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per group of ``by`` with one column per probability.

    Value = smallest ``v`` whose cumulative count reaches ``ceil(p·n)``
    (``percentile_disc``); nulls and NaN are ignored; groups without values do
    not appear; a null in ``by`` is a group of its own.  ``weight`` (a
    non-negative integer column) lets pre-aggregated input count each row that
    many times.
    """
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    by = list(by)
    w = F.lit(1) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    group = F.struct(*by) if by else F.lit("")  # one non-null key for any number of columns
    src = df.select(*by, group.alias("_g"), F.col(value).cast("double").alias("_v"), w.cast("bigint").alias("_w"))
    src = src.where(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.col("_w") > 0))
    cut = F.percentile_approx("_v", [i / ranges for i in range(1, ranges)], 10 * ranges).alias("_cuts")
    size = [F.sum("_w").alias("_n"), F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), cut]

    ranks = F.array(*[
        F.struct(F.lit(i).alias("pi"), F.greatest(F.ceil(F.lit(float(p)) * F.col("_n")), F.lit(1)).cast("bigint").alias("k"))
        for i, p in enumerate(probs)
    ])
    # one row a search range, with all ranks wanted in it
    search, _ = durable(
        src.groupBy(*by, "_g")
        .agg(*size)
        .select(*by, "_g", ranks.alias("_ranks"), F.lit(0).cast("bigint").alias("_start"), "_lo", "_hi", "_rows", "_cuts")
    )
    narrow = src.select("_g", "_v", "_w")
    while (search.agg(F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_rows")))).first()[0] or 0) > range_rows:
        found, inside = _narrowed(narrow, search, ranges, cut)
        last, search = search, durable(found)[0]
        release(last, narrow)
        narrow = inside

    # a search range of one value is the answer; in the others a running sum serves all ranks
    open_ = search.where(F.col("_lo") < F.col("_hi")).select("_g", "_ranks", "_start", "_lo", "_hi")
    freq = _in_ranges(narrow, open_).groupBy("_g", "_lo", "_v").agg(F.sum("_w").alias("_w"))
    upto = Window.partitionBy("_g", "_lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = freq.withColumn("_sum", F.sum("_w").over(upto)).join(open_.select("_g", "_lo", "_ranks", "_start"), ["_g", "_lo"])
    end = F.col("_start") + F.col("_sum")
    met = F.filter("_ranks", lambda r: (r["k"] <= end) & (r["k"] > end - F.col("_w")))
    found = summed.select("_g", "_v", F.explode(met).alias("_r")).select("_g", F.col("_r.pi").alias("_pi"), F.col("_v").alias("_found"))
    state = search.select(*by, "_g", "_lo", F.explode("_ranks").alias("_r")).select(*by, "_g", "_lo", F.col("_r.pi").alias("_pi"))
    answers = state.join(found, ["_g", "_pi"], "left").withColumn("_a", F.coalesce("_found", "_lo"))
    picked = [F.min(F.when(F.col("_pi") == i, F.col("_a"))).alias(n) for i, n in enumerate(names)]
    out = answers.groupBy(*by, "_g").agg(*picked)
    return out.select(*by, *names)


def _in_ranges(narrow: DataFrame, open_: DataFrame) -> DataFrame:
    """The rows inside a search range (ranges of a group don't overlap), with the range's columns."""
    rows = narrow.join(open_, "_g")
    return rows.where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))


def _with_bucket(rows: DataFrame, value: str, bounds: str, n_bounds: int, name: str) -> DataFrame:
    """``rows`` with ``bucket_of`` the value among an array column of bounds.

    A binary search, one projection a step: ``log2(n)`` comparisons of code as well, where a
    tree of comparisons has ``n`` and outgrows what is compiled.
    """
    step = 1 << max(n_bounds.bit_length() - 1, 0)
    rows = rows.withColumn(name, F.lit(0))
    while step:
        # beyond the last bound: null, which is not below
        above = F.col(value) > F.get(bounds, F.col(name) + (step - 1))
        rows = rows.withColumn(name, F.when(above, F.col(name) + step).otherwise(F.col(name)))
        step >>= 1
    return rows


def _narrowed(narrow: DataFrame, search: DataFrame, ranges: int, cut: Column) -> tuple[DataFrame, DataFrame]:
    """The search table after one round, each open range replaced by its parts that hold ranks; the rows in them, stored.

    Parts are only counted; a sketch is made of those that hold a rank.
    """
    done = search.where(F.col("_lo") >= F.col("_hi"))
    open_ = search.where(F.col("_lo") < F.col("_hi"))
    rows = _in_ranges(narrow, open_.select("_g", "_lo", "_hi", "_cuts"))
    rows = _with_bucket(rows, "_v", "_cuts", ranges - 1, "_below")
    equal = F.coalesce(F.get("_cuts", F.col("_below")) == F.col("_v"), F.lit(False))
    rows = rows.withColumn("_part", 2 * F.col("_below") + equal.cast("int"))  # a cut value is a part of its own
    parts = rows.groupBy("_g", "_lo", "_part").agg(
        F.sum("_w").alias("_n"), F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    upto = Window.partitionBy("_g", "_lo").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("_sum", F.sum("_n").over(upto))
    keep = [c for c in search.columns if c not in ("_hi", "_rows", "_cuts")]
    held = parts.join(open_.select(*keep), ["_g", "_lo"])
    end = F.col("_start") + F.col("_sum")
    held = held.withColumn("_ranks", F.filter("_ranks", lambda r: (r["k"] <= end) & (r["k"] > end - F.col("_n"))))
    held = held.where(F.size("_ranks") > 0).withColumn("_start", end - F.col("_n"))
    held = held.drop("_lo").withColumnsRenamed({"_low": "_lo", "_high": "_hi"})
    held, _ = durable(held.select(*[c for c in search.columns if c != "_cuts"]))
    wide = held.where(F.col("_lo") < F.col("_hi")).select("_g", "_lo", "_hi")
    inside, _ = durable(_in_ranges(narrow, wide).select(*narrow.columns))
    cuts = _in_ranges(inside, wide).groupBy("_g", "_lo").agg(cut)
    return done.unionByName(held.join(cuts, ["_g", "_lo"], "left").select(*search.columns)), inside
