"""Where revenue comes from: item types and top spenders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.filters import PlayerFilter
from playpulse.functions.numbers import exact_sum, sum_of_parts, sum_parts
from playpulse.plans.rollups import KEY, joined_to, purchases_in_range
from playpulse.schema import Tables


def item_revenue(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Purchases and revenue per item type, highest revenue first.

    Each purchase is shuffled once, by player, and folded by item type map-side after the
    join; both join inputs come straight from their shuffle, so AQE can split a hot player.
    """
    bought = purchases_in_range(tables, flt).select(KEY, "item_type", "price_usd")
    return (
        joined_to(bought, tables, flt)
        .groupBy("item_type")
        .agg(
            F.count("*").alias("purchases"),
            exact_sum(bought, "price_usd").alias("revenue"),
        )
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("item_type"))
    )


def top_spenders(tables: Tables, flt: PlayerFilter, n: int = 10) -> DataFrame:
    """Players with the highest spending; ties go by player key, then platform."""
    purchases = purchases_in_range(tables, flt)
    spent = purchases.groupBy(KEY).agg(
        F.count("purchase_id").alias("purchases"),
        *sum_parts(purchases, "price_usd", "spent"),
    )
    players = tables.players.filter(flt.on_platform()).select(KEY, "platform")
    return (
        spent.join(players, KEY)
        .groupBy(KEY, "platform")
        .agg(
            F.sum("purchases").alias("purchases"),
            sum_of_parts("spent").alias("total_spent"),
        )
        .orderBy(
            F.desc_nulls_last("total_spent"), F.asc_nulls_last(KEY), F.asc_nulls_last("platform")
        )
        .limit(n)
    )
