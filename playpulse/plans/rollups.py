"""Shared plan pieces: facts folded to one row per player before they are joined.

Joining raw facts to the players would send every session of a busy player to
one task. Folding first needs the same shuffle key, but Spark combines each
player's rows map-side, so a player holding a third of all sessions arrives as
one short row per map task, and the join that follows meets each key once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.filters import PlayerFilter
from playpulse.functions import id_filter
from playpulse.functions.numbers import sum_parts
from playpulse.schema import Tables

KEY = "player_id"
#: An id of a session that may have others of the same id; null in rows of whole players.
REPEATED_ID = "repeated_id"


def sessions_in_range(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Sessions of the range that can match a player; NULL keys never do."""
    return tables.sessions.filter(flt.in_range("session_date") & F.col(KEY).isNotNull())


def purchases_in_range(tables: Tables, flt: PlayerFilter) -> DataFrame:
    return tables.purchases.filter(flt.in_range("purchase_date") & F.col(KEY).isNotNull())


def audience(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Keys of the players on the chosen platforms."""
    return tables.players.filter(flt.on_platform()).select(KEY)


def seen_by(rollup: DataFrame, tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Rollup rows of those players, each once, for counting distinct players."""
    return rollup.join(audience(tables, flt), KEY, "left_semi")


def joined_to(rollup: DataFrame, tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Rollup rows of those players, for sums.

    Nothing enforces that a player occurs once. Where one does not, its row
    comes as often as an inner join would repeat each of its facts.
    """
    return rollup.join(audience(tables, flt), KEY)


def per_player(rollup: DataFrame, tables: Tables, flt: PlayerFilter) -> DataFrame:
    """The same folded back to one row per player, for sums and distinct counts together.

    The join has left the rows partitioned by player: no further shuffle.
    """
    figures = [name for name in rollup.columns if name != KEY]
    joined = joined_to(rollup, tables, flt)
    return joined.groupBy(KEY).agg(*[F.sum(name).alias(name) for name in figures])


def purchase_rollup(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Per player: rows, priced rows and the parts of their sum."""
    purchases = purchases_in_range(tables, flt)
    return purchases.groupBy(KEY).agg(
        F.count("*").alias("purchases"),
        F.count("price_usd").alias("priced"),
        *sum_parts(purchases, "price_usd", "revenue"),
    )


def _session_rows(tables: Tables, flt: PlayerFilter, by_repeated_id: bool) -> DataFrame:
    """Sessions with is_session; with ids told apart if asked.

    Then is_id marks a session whose id occurs once. A session whose id may repeat has a second
    row, which holds only the player and the id.
    """
    sessions = sessions_in_range(tables, flt)
    if not by_repeated_id:
        return sessions.withColumn("is_session", F.lit(1))
    named = sessions.where(F.col("session_id").isNotNull()).groupBy("session_id")
    again = named.agg(F.count("*").alias("n")).where(F.col("n") > 1)
    marked = id_filter.marked(sessions, "session_id", id_filter.cells(again, "session_id"), "repeats")
    own = F.when(F.col("repeats"), F.array(F.lit(None), F.col("session_id")))
    no_id = F.array(F.lit(None).cast(sessions.schema["session_id"].dataType))
    rows = marked.select("*", F.explode(F.coalesce(own, no_id)).alias(REPEATED_ID))
    whole = F.col(REPEATED_ID).isNull()
    return rows.withColumns(
        {
            "is_session": F.when(whole, 1),
            "is_id": F.when(whole & ~F.col("repeats") & F.col("session_id").isNotNull(), 1),
            "duration_minutes": F.when(whole, F.col("duration_minutes")),
        }
    )


def activity_rollup(
    tables: Tables,
    flt: PlayerFilter,
    *,
    minutes: bool = True,
    purchases: bool = True,
    by_repeated_id: bool = False,
) -> DataFrame:
    """Both facts of the range folded together, one row per player with any activity.

    The facts are stacked and grouped once, so they share one shuffle and need
    one join to the players instead of two. ``minutes`` and ``purchases`` can be left out.
    ``by_repeated_id`` adds ``ids``, the sessions whose id occurs once, and further rows for
    each player and id that may repeat, with nothing but these two.
    """
    keys = [KEY, REPEATED_ID] if by_repeated_id else [KEY]
    timed = [F.col("duration_minutes").alias("minutes")] if minutes else []
    counted = ["is_id"] if by_repeated_id else []
    rows = _session_rows(tables, flt, by_repeated_id)
    activity = rows.select(*keys, "is_session", *counted, *timed)
    if purchases:
        bought = purchases_in_range(tables, flt).select(
            KEY, F.lit(1).alias("is_purchase"), F.col("price_usd").alias("price")
        )
        activity = activity.unionByName(bought, allowMissingColumns=True)
    figures = [F.count("is_session").alias("sessions")]
    if minutes:
        figures += [*sum_parts(activity, "minutes", "minutes"), F.count("minutes").alias("timed")]
    if purchases:
        figures += [
            F.count("is_purchase").alias("purchases"),
            *sum_parts(activity, "price", "revenue"),
            F.count("price").alias("priced"),
        ]
    if by_repeated_id:
        figures.append(F.count("is_id").alias("ids"))
    return activity.groupBy(*keys).agg(*figures)
