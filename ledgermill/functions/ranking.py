"""Exact ranks and quantiles of groups that may be far larger than one task.

Values are counted first, so ties cost one row. A fixed, order-preserving grid then cuts every group into
slots, and a slot with too many distinct values is cut further at values drawn from it, however close they lie.
Ranks inside a piece and the totals of the pieces below add up to the exact rank. No window ever spans a whole
group of values: one runs over the pieces of a group, one over the distinct values of a single piece.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS_PER_E_FOLD = 1000
SCALE = 1000.0
MOST_VALUES = 200_000  # distinct values of a slot beyond which it is cut further
DRAWN = 16             # values drawn for each further piece, on average


def slot_of(value: Column) -> Column:
    """A non-decreasing integer function of the value: logarithmic in both directions, fine near zero."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value) * SCALE) * SLOTS_PER_E_FOLD)


def place_among(bounds: str, value: str, top: int = 24) -> str:
    """SQL for how many of the ascending ``bounds`` (fewer than 2**(top + 1)) ``value`` reaches, by bisection."""
    step = "at + shiftleft(1, bit)"
    return (f"aggregate(sequence({top}, 0, -1), 0, (at, bit) -> if({step} <= size({bounds}) "
            f"AND {bounds}[least({step}, size({bounds})) - 1] <= {value}, {step}, at))")


def in_pieces(counts: DataFrame, keys: Sequence[str], value: str, most: int = MOST_VALUES) -> DataFrame:
    """Distinct values with ``_slot`` and ``_piece``: ascending, and bounded in distinct values.

    A slot with more than ``most`` values gives about ``DRAWN`` of them for each ``most`` by a hash, and every
    ``DRAWN``-th in order begins a new piece. Values are distinct here, so any concentration can be cut.
    """
    slotted = counts.withColumn("_slot", slot_of(F.col(value)))
    slot = [*keys, "_slot"]
    full = slotted.groupBy(*slot).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).drop("_n")
    drawn = slotted.join(full, slot).where(F.pmod(F.xxhash64(value, F.lit(17)), F.lit(most)) < DRAWN)
    nth = F.row_number().over(Window.partitionBy(*slot).orderBy(value))
    cuts = (drawn.select(*slot, value, nth.alias("_nth")).where(F.col("_nth") % DRAWN == 0)
            .groupBy(*slot).agg(F.array_sort(F.collect_list(value)).alias("_cuts")))
    piece = F.expr(f"if(_cuts IS NULL, 0, {place_among('_cuts', f'`{value}`')})")
    return slotted.join(cuts, slot, "left").withColumn("_piece", piece).drop("_cuts")


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, most: int = MOST_VALUES) -> DataFrame:
    """One row per key and distinct value: ``n_equal``, ``n_below`` (strictly lower) and ``n_group``."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n_equal"))
    piece = [*keys, "_slot", "_piece"]
    # dealt by piece, or the pieces of a slot would stay together
    values = in_pieces(counts, keys, value, most).repartition(*piece)
    by_group = Window.partitionBy(*keys)
    earlier = by_group.orderBy("_slot", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (values.groupBy(*piece).agg(F.sum("n_equal").alias("_n"))
              .select(*piece, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_below"),
                      F.sum("_n").over(by_group).alias("n_group")))
    inside = Window.partitionBy(*piece).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (values.join(pieces, piece)
            .withColumn("n_below", F.col("_below") + F.coalesce(F.sum("n_equal").over(inside), F.lit(0)))
            .select(*keys, value, "n_equal", "n_below", "n_group"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Interpolated quantiles per key, one column per name in ``probs``, and the count ``n_group``."""
    ranks = value_ranks(df, keys, value)
    low_edge, high_edge = F.col("n_below"), F.col("n_below") + F.col("n_equal")

    def at(position: Column) -> Column:
        return F.max(F.when((low_edge <= position) & (position < high_edge), F.col(value)))

    picks = []
    for name, p in probs.items():
        exact = F.lit(float(p)) * (F.col("n_group") - 1)
        picks += [at(F.floor(exact)).alias(f"_{name}_lo"), at(F.ceil(exact)).alias(f"_{name}_hi")]
    found = ranks.groupBy(*keys).agg(F.max("n_group").alias("n_group"), *picks)
    out = []
    for name, p in probs.items():
        exact = F.lit(float(p)) * (F.col("n_group") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (hi - lo) * (exact - F.floor(exact))).alias(name))
    return found.select(*keys, "n_group", *out)
