"""Latest row per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW = "__row"
_FILE = "__file"
_INDEX = "__index"
_TIED = "__tied"
_POSITION = "__position"


def latest_by(
    df: DataFrame,
    keys: list[str | Column],
    order: list[Column],
    tiebreak: list[Column],
) -> DataFrame:
    """Keep the first row per key in ``order``; ``tiebreak`` must make the order total.

    The filter on ``row_number() = 1`` lets Spark keep one row per key already
    before the shuffle, so that a key with very many versions stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*order, *tiebreak)
    return df.withColumn(_ROW, F.row_number().over(window)).where(F.col(_ROW) == 1).drop(_ROW)


def _located(rows: DataFrame) -> DataFrame | None:
    """Rows with their file and their place in it, if they are those of a Parquet table."""
    try:
        # from 1 on, as bitmaps count
        index = (F.col("_metadata.row_index") + 1).alias(_INDEX)
        return rows.select("*", F.col("_metadata.file_path").alias(_FILE), index)
    except AnalysisException:
        return None


def _marked(position: Column) -> Column:
    """Is the bit at a position of ``__bits`` set?"""
    byte = F.conv(F.hex(F.substr("__bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def latest_of_wide(
    rows: DataFrame, keys: list[str], newest: Column, tiebreak: list[Column]
) -> DataFrame:
    """:func:`latest_by` with the highest ``newest`` first, for a stored table of wide rows:
    only keys, ``newest`` and the place of a row in its file are shuffled and sorted.

    The places found come back as one bit per row of the table, broadcast, and each file gives
    its own rows. Rows that share the highest ``newest`` of a key are told apart by ``tiebreak``,
    for which they alone are shuffled whole.
    """
    located = _located(rows)
    if located is None:
        return latest_by(rows, keys, [newest.desc()], tiebreak)
    by_key = Window.partitionBy(*keys)
    first = (
        located.select(*keys, newest.alias("__newest"), _FILE, _INDEX)
        .withColumn(_ROW, F.rank().over(by_key.orderBy(F.col("__newest").desc())))
        .where(F.col(_ROW) == 1)
        .withColumn(_TIED, F.count(F.lit(1)).over(by_key) > 1)
    )

    def rows_at(places: DataFrame) -> DataFrame:
        bucket, position = F.bitmap_bucket_number(_INDEX), F.bitmap_bit_position(_INDEX)
        # by file first: grouped where they are, every task would make a bitmap of every file
        of_file = places.select(_FILE, _INDEX).repartition(_FILE)
        bitmaps = of_file.groupBy(F.col(_FILE).alias("__of"), bucket.alias("__bucket")).agg(
            F.bitmap_construct_agg(position).alias("__bits")
        )
        found = (F.col(_FILE) == F.col("__of")) & (bucket == F.col("__bucket"))
        return located.join(F.broadcast(bitmaps), found & _marked(position)).select(*rows.columns)

    alone, tied = rows_at(first.where(~F.col(_TIED))), rows_at(first.where(_TIED))
    return alone.unionByName(latest_by(tied, keys, [newest.desc()], tiebreak))


# a bitmap holds so many bits; elements from ``_FAR`` on have bitmaps of fewer rows and more positions
_BITS = 32_768
_FAR = 64


def latest_of_elements(
    rows: DataFrame,
    array: str,
    out: str,
    identify: Callable[[DataFrame], DataFrame],
    describe: Callable[[DataFrame], DataFrame],
    keys: list[str],
    order: list[Column],
    tiebreak: list[Column],
) -> DataFrame:
    """:func:`latest_by` over the elements ``out`` of an array of a stored table: only ``keys``, the
    columns of ``order`` and the place of an element are shuffled and sorted, no element is.

    ``identify`` adds ``keys`` to the elements, ``order`` names columns of ``rows`` alone, and ``describe`` adds
    what ``tiebreak`` names. The places found come back as bits, broadcast: for each of the first 64 positions one per row of
    the table, and each file gives its own elements. Elements that share the best
    ``order`` of a key are told apart by ``tiebreak``, for which they alone are shuffled whole.
    """
    names = [name for name in rows.columns if name != array]
    located = _located(rows)
    if located is None:
        elements = rows.select(*names, F.explode(array).alias(out))
        return latest_by(describe(elements), keys, [*order, *tiebreak], []).select(*names, out)
    elements = located.select(*names, _FILE, _INDEX, F.posexplode(array).alias(_POSITION, out))
    far = F.col(_POSITION) >= _FAR
    row = F.col(_INDEX) - 1
    places = {
        "__slot": F.when(far, F.floor(F.col(_POSITION) / _FAR) + _FAR).otherwise(F.col(_POSITION).cast("bigint")),
        "__block": F.floor(row / F.when(far, F.lit(_BITS // _FAR)).otherwise(F.lit(_BITS))),
    }
    bit = F.when(far, row % (_BITS // _FAR) * _FAR + F.col(_POSITION) % _FAR).otherwise(row % _BITS)
    by_key = Window.partitionBy(*keys)
    first = (
        identify(elements)
        .withColumn(_ROW, F.rank().over(by_key.orderBy(*order)))
        .where(F.col(_ROW) == 1)
        .withColumn(_TIED, F.count(F.lit(1)).over(by_key) > 1)
    )

    def elements_at(found: DataFrame) -> DataFrame:
        # by file first: grouped where they are, every task would make a bitmap of every file
        of_file = found.select(_FILE, _INDEX, _POSITION).repartition(_FILE)
        bitmaps = of_file.groupBy(F.col(_FILE).alias("__of"), *[place.alias(f"{name}_of") for name, place in places.items()]).agg(
            F.bitmap_construct_agg(bit).alias("__bits")
        )
        here = F.col(_FILE) == F.col("__of")
        for name, place in places.items():
            here = here & (place == F.col(f"{name}_of"))
        return elements.join(F.broadcast(bitmaps), here & _marked(bit)).select(*names, out)

    alone, tied = elements_at(first.where(~F.col(_TIED))), elements_at(first.where(_TIED))
    return alone.unionByName(latest_by(describe(tied), keys, [*order, *tiebreak], []).select(*names, out))
