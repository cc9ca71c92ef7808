"""First-wins and last-wins deduplication over an explicit row order.

``order`` names columns that order the whole input without ties, such as
(file, position).  Every rule keeps one row per key and map task before the
shuffle, so a key that holds a third of the rows does not reach one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adfeed.session import cut_lineage


def position(order: Sequence[str]) -> Column:
    """A row's place as one value; a single column stays plain, which aggregates faster."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rang", F.row_number().over(window)).filter("_rang = 1").drop("_rang")


def dedup_last(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of every key, standing where the key first appeared.

    The order columns of the result hold the first position, so sorting by them
    gives the order a keyed dictionary would have after the same inserts.
    """
    order = [c for c in order if c != key]
    values = [c for c in df.columns if c != key and c not in order]
    if not order:  # the key alone orders nothing: the largest row, whatever the input's order
        return df.groupBy(key).agg(F.max(F.struct(*values)).alias("_valeurs")).select(key, "_valeurs.*").select(*df.columns)
    position = F.struct(*order)
    grouped = df.groupBy(key).agg(
        F.max_by(F.struct(*values), position).alias("_valeurs"), F.min(position).alias("_place")
    )
    return grouped.select(key, "_valeurs.*", "_place.*").select(*df.columns)


def text_key(text: str) -> Column:
    """Exact-text key: a 256-bit hash, so that long texts need not be shuffled."""
    return F.sha2(F.col(text), 256)


def dedup_text(df: DataFrame, order: Sequence[str], text: str = "texte_nettoye") -> DataFrame:
    """The first row of every exact text; rows with an empty text are all kept.

    Texts travel as 256-bit hashes.  An empty text gets its own position as key,
    so the empty rows spread over all tasks.
    """
    blank = F.coalesce(F.col(text), F.lit("")) == ""
    keyed = df.withColumn("_cle", F.when(~blank, text_key(text))).withColumn(
        "_vide", F.when(blank, position(order))
    )
    return dedup_first(keyed, ["_cle", "_vide"], order).drop("_cle", "_vide")


def text_duplicates(
    df: DataFrame, order: Sequence[str], id_col: str = "id", text: str = "texte_nettoye"
) -> DataFrame:
    """The rows dedup_text drops: (id, id of the row that was kept instead).

    The texts are reduced to hashes and positions once, and written.  The kept
    side has one row per text, so a hot text makes the other side skewed and AQE
    splits it.
    """
    narrow = cut_lineage(
        df.filter(F.coalesce(F.col(text), F.lit("")) != "").select(
            F.col(id_col).alias(id_col), text_key(text).alias("_cle"), position(order).alias("_ordre")
        )
    )
    firsts = narrow.groupBy("_cle").agg(
        F.min(F.struct("_ordre", F.col(id_col).alias("id_garde"))).alias("_garde"), F.count("*").alias("_n")
    )
    repeated = firsts.filter("_n > 1").select("_cle", "_garde")
    return (
        narrow.join(repeated, "_cle")
        .filter(F.col("_ordre") != F.col("_garde._ordre"))
        .select(id_col, F.col("_garde.id_garde").alias("id_garde"))
    )
