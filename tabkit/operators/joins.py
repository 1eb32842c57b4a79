"""Equality and band joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.columns import ref
from tabkit.runtime import settle

WHOLE = 9_999  # the level of one interval that holds all numbers
FINEST = 1_000  # intervals are between 2^-1000 and 2^1000 wide
FEW_BANDS = 32  # bands that a row rather tests than is looked up once more
MOST_LEVELS = 12
ROWS_PER_SLICE = 250_000
WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def join_full_outer(left: DataFrame, right: DataFrame, lcol: str, rcol: str) -> DataFrame:
    """All rows of both sides, both key columns kept; the sides share no column name.

    Written as a left join plus the right rows whose key never occurs on the left. A full outer join always
    shuffles both sides and cannot split a hot key; a left join broadcasts a small right side or splits hot keys
    of the left, and the keys that occur are reduced to one each before they move. The left side is read twice: store
    it first if it is expensive.
    """
    matched = left.join(right, ref(lcol) == ref(rcol), "left")
    occurring = left.select(ref(lcol).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    alone = right.join(occurring, ref(rcol) == F.col("_key"), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def join_by_row_key(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Put the columns of two tables side by side by a row key."""
    return df.join(other, key, "inner")


def _cell(value: Column, level: int) -> Column:
    """Number of the interval of width 2^level in which a value lies; of the level above all, 0. NULL for NULL and NaN."""
    x = value.cast("double")
    return F.when(~F.isnan(x), F.lit(0).cast("bigint") if level == WHOLE else F.floor(x * F.lit(2.0 ** -level)))


def _level(lo: Column, hi: Column) -> Column:
    """The least level whose intervals are as wide as a band, and no finer than the numbers around it can tell apart."""
    apart = lambda x: F.ceil(F.log2(F.greatest(x, F.lit(2.0 ** -FINEST))))
    own = F.greatest(apart(hi - lo), apart(F.greatest(F.abs(lo), F.abs(hi))) - 50)
    return F.when(hi - lo < F.lit(2.0 ** FINEST), own).otherwise(F.lit(WHOLE)).cast("int")


def _levels_kept(counts: dict[int, int]) -> list[int]:
    """Levels under which bands are listed, in rising order. The bands of the others move up to the next.

    A row is looked up once per level, so a level with few bands is not worth one: rows rather test these bands too.
    """
    kept, waiting = [], 0
    for level in sorted(counts):
        waiting += counts[level]
        if waiting > FEW_BANDS:
            kept.append([level, waiting])
            waiting = 0
    if waiting or not kept:
        kept.append([max(counts, default=WHOLE), waiting])
    while len(kept) > MOST_LEVELS:
        least = min(range(len(kept) - 1), key=lambda i: kept[i][1])
        kept[least + 1][1] += kept.pop(least)[1]
    return [level for level, _ in kept]


def _holds_some(lo: Column, hi: Column) -> Column:
    """Whether a band is one: it has a lower end, no end is NaN, and the upper one is not below the lower."""
    return lo.isNotNull() & ~F.isnan(lo.cast("double")) & ~F.coalesce(F.isnan(hi.cast("double")), F.lit(False)) & (hi.isNull() | (hi >= lo))


def _band_totals(df: DataFrame, bands: DataFrame, col: str, lo: str, hi: str, totals: Sequence[str]) -> DataFrame:
    """Every row in a band, with ``hits`` and the sums of the columns ``totals`` over its bands.

    In one order of rows and ends of bands, a band counts from its lower end on and is taken off behind its upper one, so the running sums at a row
    are those of its bands: the work grows with rows and bands, not with the pairs that meet. Running sums are taken inside ranges of the order, to
    which the sums of the earlier ranges are added; equal values may lie in several ranges. Ranges are stored, because a range computed anew could begin elsewhere.
    """
    odd = [c for c in totals if not isinstance(bands.schema[c].dataType, WHOLE_NUMBERS)]
    if odd or "hits" in df.columns:
        raise ValueError(f"totals are of whole numbers, not of {odd}" if odd else "df has a column hits")
    sums = {"_n": F.lit(1)} | {f"_sum_{i}": F.coalesce(ref(c), F.lit(0)) for i, c in enumerate(totals)} | {f"_some_{i}": ref(c).isNotNull().cast("int") for i, c in enumerate(totals)}
    end = lambda at, kind, sign: F.struct(ref(at).alias("_at"), F.lit(kind).alias("_kind"), *[(v.cast("bigint") * sign).alias(k) for k, v in sums.items()])
    valid = bands.where(_holds_some(ref(lo), ref(hi)))
    ends = valid.select(end(lo, 0, 1).alias("_end")).unionByName(valid.where(ref(hi).isNotNull()).select(end(hi, 2, -1).alias("_end"))).select("_end.*")
    rows = df.where(ref(col).isNotNull() & ~F.isnan(ref(col).cast("double"))).withColumns({"_at": ref(col), "_kind": F.lit(1)})
    placed = rows.unionByName(ends, allowMissingColumns=True).withColumn("_id", F.monotonically_increasing_id())
    slices = (df.count() + 2 * bands.count()) // ROWS_PER_SLICE + 1
    ranged = settle(placed.repartitionByRange(slices, "_at", "_kind", "_id").withColumn("_slice", F.spark_partition_id()), "bands")
    by_slice = ranged.where("_kind <> 1").groupBy("_slice").agg(*[F.sum(k).alias(k) for k in sums])
    earlier = ranged.select("_slice").distinct().join(by_slice, "_slice", "left").select(
        F.col("_slice").alias("_of"), *[F.sum(k).over(W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)).alias(f"{k}_earlier") for k in sums])  # one row per range
    upto = W.partitionBy("_slice").orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = ranged.withColumns({k: F.sum(k).over(upto) for k in sums}).where("_kind = 1").join(earlier, F.col("_slice") == F.col("_of"))
    both = lambda k: F.coalesce(F.col(k), F.lit(0).cast("bigint")) + F.coalesce(F.col(f"{k}_earlier"), F.lit(0).cast("bigint"))
    found = [F.when(both(f"_some_{i}") > 0, both(f"_sum_{i}")).alias(c) for i, c in enumerate(totals)]
    return inside.where(both("_n") > 0).select(*[ref(c) for c in df.columns], both("_n").alias("hits"), *found)


def join_band(df: DataFrame, bands: DataFrame, col: str, how: str = "left",
              eq: tuple[str, str] | None = None, lo: str = "lo", hi: str = "hi", totals: Sequence[str] | None = None) -> DataFrame:
    """Attach the bands with lo <= col <= hi; a NULL hi is open-ended. ``eq`` = (df column, band column).

    With ``totals``, for an inner join without ``eq``, every row that lies in a band comes once, with ``hits``, the number of its bands, and the
    sums of these band columns, whole numbers, under their names. Hits are not listed then: see ``_band_totals``.

    Bands lie on a ladder of levels; an interval of level k is 2^k wide. A band is listed once, at the least level whose intervals are as
    wide as itself, under the one or two intervals it touches; a row is looked up under its interval of every level that occurs. So
    the join is an equality join on (level, interval, ``eq``) with the exact range test behind it, a row and a band meet at
    most once, and at a level at least a quarter of the places under which a band is listed are its own. Far, tiny and endless bands have their own
    levels and cost the others nothing. The driver sees one count per level. Spark broadcasts bands by their size or splits
    intervals that hold very many rows.

    Where rows without a band are kept and there are several levels, the bands of every different value are looked up first and joined
    to the rows by the value: ``df`` is read twice then, so store it first if it is expensive. A band whose hi is below its lo, or an end of
    which is NaN, holds nothing. The sides share no column name.
    """
    clash = sorted(set(c.lower() for c in df.columns) & set(c.lower() for c in bands.columns))
    if clash:
        raise ValueError(f"both sides have the columns {clash}")
    if how not in ("inner", "left"):
        raise ValueError(f"{how} is neither inner nor left")
    if totals is not None:
        if how != "inner" or eq is not None:
            raise ValueError("totals are those of an inner join without eq")
        return _band_totals(df, bands, col, lo, hi, totals)
    own = {c: f"_band_{i}" for i, c in enumerate(bands.columns)}
    b_lo, b_hi = F.col(own[lo]), F.col(own[hi])
    first, last = b_lo.cast("double"), F.coalesce(b_hi.cast("double"), F.lit(float("inf")))
    named = bands.withColumnsRenamed(own).where(_holds_some(b_lo, b_hi))
    counts = named.groupBy(_level(first, last).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    levels = _levels_kept({r["level"]: r["n"] for r in counts.collect()})  # a row per power of two
    at = F.array_min(F.filter(F.array(*map(F.lit, levels)), lambda x: x >= _level(first, last)))
    listed = named.withColumn("_band_level", at)
    touched = F.when(F.col("_band_level") == WHOLE, F.sequence(*[F.lit(0).cast("bigint")] * 2))
    for level in levels:
        if level != WHOLE:
            touched = touched.when(F.col("_band_level") == level, F.sequence(_cell(first, level), _cell(last, level)))
    listed = listed.withColumn("_band_cell", F.explode(touched))

    def looked_up(rows: DataFrame, value: Column, kind: str) -> DataFrame:
        if len(levels) == 1:
            keyed = rows.withColumns({"_level": F.lit(levels[0]), "_cell": _cell(value, levels[0])})
        else:
            places = F.array(*[F.struct(F.lit(x).alias("_level"), _cell(value, x).alias("_cell")) for x in levels])
            keyed = rows.withColumn("_place", F.explode(places)).select("*", "_place.*").drop("_place")
        condition = (F.col("_level") == F.col("_band_level")) & (F.col("_cell") == F.col("_band_cell")) & (value >= b_lo) & (b_hi.isNull() | (value <= b_hi))
        if eq is not None:
            condition = condition & (ref(eq[0]) == F.col(own[eq[1]]))
        return keyed.join(listed, condition, kind).drop("_level", "_cell", "_band_level", "_band_cell")

    if how == "inner" or len(levels) == 1:
        found = looked_up(df, ref(col), how)
    else:
        values = df.select(*dict.fromkeys([col, *([eq[0]] if eq else [])])).where(ref(col).isNotNull()).distinct()
        hits = looked_up(values, ref(col), "inner").select(ref(col).alias("_looked_up"), *own.values())
        condition = ref(col) == F.col("_looked_up")
        if eq is not None:
            condition = condition & (ref(eq[0]) == F.col(own[eq[1]]))
        found = df.join(hits, condition, "left").drop("_looked_up")
    return found.withColumnsRenamed({new: old for old, new in own.items()})


def bands_overlap(bands: DataFrame, by: str | None = None, lo: str = "lo", hi: str = "hi") -> bool:
    """Whether two bands of one group share a value. Bands whose hi is below their lo hold nothing and are ignored.

    In the order of their lower ends, bands overlap if and only if some neighbours do. Neighbours are compared inside ranges of the order,
    and the ends of the ranges with each other.
    """
    group = ref(by) if by else F.lit(0)
    own = bands.select(group.alias("by"), ref(lo).cast("double").alias("lo"), F.coalesce(ref(hi).cast("double"), F.lit(float("inf"))).alias("hi")).where(
        "by IS NOT NULL AND lo IS NOT NULL AND hi >= lo AND NOT isnan(lo) AND NOT isnan(hi)")
    order = ["by", "lo", "hi"]
    # the partition is that of one and the same run, so what it holds need not be the same again
    ranged = own.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    before = lambda w: F.lag(F.struct("by", "hi")).over(w)
    meets = F.coalesce((F.col("last.by") == F.col("by")) & (F.col("lo") <= F.col("last.hi")), F.lit(False))
    inside = ranged.withColumn("last", before(W.partitionBy("range").orderBy(*order))).groupBy("range").agg(
        F.max(meets).alias("meets"), F.min(F.struct(*order)).alias("first"), F.max(F.struct(*order)).alias("final"))
    across = F.lag("final").over(W.orderBy("range"))  # one row per range
    found = inside.withColumn("last", across).select(
        (F.col("meets") | F.coalesce((F.col("last.by") == F.col("first.by")) & (F.col("first.lo") <= F.col("last.hi")), F.lit(False))).alias("meets"))
    return bool(found.agg(F.max("meets")).first()[0])
