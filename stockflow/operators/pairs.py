"""Pairs of a sender and a receiver of the same item along permitted lanes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.config import OPEN, Lane

_LANE = "__lane"


def lane_group(name: Column, lanes: tuple[Lane, ...]) -> Column:
    """The group whose lanes a location uses: its own name, or OPEN.

    NULL for a NULL name: such a location fails every rule and takes no lane.
    """
    named = sorted({end for lane in lanes for end in (lane.sender, lane.receiver)} - {OPEN})
    return F.when(name.isin(named), name).when(name.isNotNull(), F.lit(OPEN))


def _lanes_of(group: Column, lanes: tuple[Lane, ...]) -> Column:
    """Array of the lanes that start at a group, each with its conditions."""

    def entry(lane: Lane) -> Column:
        return F.struct(
            F.lit(lane.receiver).alias("to_group"),
            F.lit(lane.least_sender_units).alias("least_units"),
            F.lit(lane.receiver_must_be_empty).alias("only_empty"),
            F.lit(lane.needs_higher_demand).alias("only_higher_demand"),
            F.lit(lane.denim_or_classics_only).alias("only_denim_classics"),
        )

    chain = None
    for sender in dict.fromkeys(lane.sender for lane in lanes):
        starts_here = F.array(*[entry(lane) for lane in lanes if lane.sender == sender])
        chain = (F if chain is None else chain).when(group == sender, starts_here)
    return chain


def pair_within(
    rows: DataFrame, on: str, sends: Column, receives: Column, lanes: tuple[Lane, ...], rules: list[Column]
) -> DataFrame:
    """Pair the rows of an item that send with those that receive, from one table.

    One shuffle by the item serves both sides: a window gathers the receivers of an item,
    and its senders are unfolded over them along the lanes. For items whose rows are bounded,
    such as the stock levels of a variant by the number of locations. The result has ``on``,
    by which it is still partitioned, and the two rows as structs ``s`` and ``r``.
    """
    every = F.struct(*rows.columns)
    gathered = F.collect_list(F.when(receives, every)).over(Window.partitionBy(on))
    outgoing = rows.where(F.col(on).isNotNull()).withColumn("__receivers", gathered).where(sends)
    unfolded = outgoing.withColumn(
        _LANE, F.explode(_lanes_of(lane_group(F.col("location_name"), lanes), lanes))
    ).select(on, F.struct(*rows.columns, _LANE).alias("s"), F.explode("__receivers").alias("r"))
    condition = (lane_group(F.col("r.location_name"), lanes) == F.col(f"s.{_LANE}.to_group")) & (
        F.col("r.location_id") != F.col("s.location_id")
    )
    for rule in rules:
        condition = condition & rule
    return unfolded.where(condition)


def lane_condition(field: str) -> Column:
    """A condition flag or number of the lane a pair uses."""
    return F.col(f"s.{_LANE}.{field}")
