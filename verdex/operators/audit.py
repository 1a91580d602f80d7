"""Missing, extra and duplicated documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.functions.text import truncate_text
from verdex.operators.text_order import PIECE, text_places
from verdex.runtime import cut

# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are never more than
# HOT_SHARE hot keys and their table is always small enough to broadcast.
HOT_SHARE = 2000


def missing_ids(have: DataFrame, against: DataFrame, key: str) -> DataFrame:
    """Distinct keys of `have` that `against` lacks, sorted.

    Both sides are reduced to distinct keys first (partial aggregation), so no key is hot in the
    join, and the join reuses that partitioning.
    """
    left = have.select(key).dropna().distinct()
    return left.join(against.select(key).dropna().distinct(), key, "left_anti").orderBy(key)


def text_key(col: str) -> F.Column:
    """256-bit digest that stands for the text, so that texts do not travel in shuffles.

    Null has the empty digest: a key that cannot be null spares a null test in joins, for which
    Spark would compute the digest twice.
    """
    return F.coalesce(F.unhex(F.sha2(F.col(col), 256)), F.lit(bytearray()))


def duplicate_stats(df: DataFrame, col: str) -> DataFrame:
    """Total, distinct and surplus values; null counts as one value."""
    groups = df.groupBy(text_key(col).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_values")
    ).withColumn("duplicates", F.col("total") - F.col("distinct_values"))


def duplicate_rows(df: DataFrame, key: str, col: str, preview: int = 100) -> DataFrame:
    """(key, preview, copies) of every row whose text occurs more than once.

    Rows are in text order, copies by key: the copied texts are ordered piece by piece
    (`text_order`), and their place travels to the members instead of the text. No row's whole text
    is shuffled. Rows of hot texts are spread over as many salts as the text needs to stay under
    1/HOT_SHARE of all rows per salt.
    """
    valued = df.where(F.col(col).isNotNull())
    rows = valued.select(
        key, truncate_text(F.col(col), preview).alias("preview"), text_key(col).alias("_key")
    )
    prefix = F.substring(col, 1, PIECE)
    groups = valued.groupBy(text_key(col).alias("_key")).agg(
        F.count(F.lit(1)).alias("copies"), F.min(prefix).alias("_prefix")
    )
    total = groups.agg(F.sum("copies")).scalar()
    salts = F.ceil(F.col("copies") * HOT_SHARE / total).cast("int")
    copied = cut(groups.where("copies > 1").withColumn("_salts", salts))
    hot = copied.where("_salts > 1").select("_key", "_salts")
    salted = rows.join(F.broadcast(hot), "_key", "left").withColumn(
        "_salt", F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(key), F.col("_salts"))).otherwise(0).cast("int")
    ).drop("_salts")
    texts = valued.select(text_key(col).alias("_key"), F.col(col).alias("_text"))
    places = text_places(texts, copied.select("_key", "_prefix"))
    copied = copied.join(places, "_key")
    spread_keys = copied.select(
        "_key", "copies", "_place", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt")
    )
    listed = salted.join(spread_keys, ["_key", "_salt"])
    return listed.orderBy("_place", key).select(key, "preview", "copies")
