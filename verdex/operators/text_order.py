"""The order of texts, without moving whole texts.

Texts are ordered by a short prefix first; only texts that tie are looked at again, by their next and
longer piece, until nothing ties. A text travels as a digest and one piece of itself, and what it
gains is a number, its place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.runtime import cut, discard

#: Characters of the first piece; each later piece is `GROWTH` times as long.
PIECE, GROWTH = 256, 16
#: Tied texts up to which their keys are broadcast.
BROADCAST_KEYS = 200_000


def _ranked(ties: DataFrame) -> DataFrame:
    """(_key, _place, _n) of (_key, _place, _piece): equal places are told apart by the piece.

    Texts that tie at place p hold the places from p on, as many as they are; those whose pieces are
    equal, too, tie at the first of theirs. `_n` counts them. One global sort gives every row its
    number; no window holds a group of ties.
    """
    order = cut(ties.orderBy("_place", "_piece").withColumn("_id", F.monotonically_increasing_id()))
    sizes = order.groupBy(F.shiftright("_id", 33).alias("task")).count().orderBy("task").collect()
    begins, total = [], 0  # one number per task of the sort
    for r in sizes:
        begins.append((r.task, total - (r.task << 33)))
        total += r["count"]
    offsets = F.broadcast(ties.sparkSession.createDataFrame(begins, "_task long, _offset long"))
    numbered = order.withColumn("_task", F.shiftright("_id", 33)).join(offsets, "_task")
    numbered = numbered.select("_key", "_place", "_piece", (F.col("_id") + F.col("_offset")).alias("_number"))
    same = numbered.groupBy("_place", "_piece").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n"))
    base = same.groupBy("_place").agg(F.min("_first").alias("_base"))
    found = same.join(base, "_place").withColumn("_new", F.col("_place") + F.col("_first") - F.col("_base"))
    ranked = cut(numbered.join(found, ["_place", "_piece"]).select("_key", F.col("_new").alias("_place"), "_n"))
    discard(order)
    return ranked


def text_places(rows: DataFrame, keys: DataFrame, piece: int = PIECE) -> DataFrame:
    """(_key, _place) of the texts in `keys`: places rise with the text (by code point), from 0.

    `rows`: (_key, _text), any number of rows for a text; `keys`: (_key, _prefix), one row per text,
    with the first `piece` characters of it. A key stands for one text. Empty tables give no rows.
    """
    ranked = _ranked(keys.select("_key", F.lit(0).cast("long").alias("_place"), F.col("_prefix").alias("_piece")))
    done, start = [ranked.where("_n = 1").select("_key", "_place")], piece
    while True:
        tied = ranked.where("_n > 1").select("_key", "_place")
        n = tied.limit(BROADCAST_KEYS + 1).count()
        if not n:
            break
        piece *= GROWTH
        # beyond the bound rows meet by key, and carry this piece of their text only
        pieces = rows.select("_key", F.substring("_text", start + 1, piece).alias("_piece"))
        met = pieces.join(F.broadcast(tied) if n <= BROADCAST_KEYS else tied, "_key")
        ranked = _ranked(met.groupBy("_key", "_place").agg(F.min("_piece").alias("_piece")))
        done.append(ranked.where("_n = 1").select("_key", "_place"))
        start += piece
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
