"""Rule filtering: one tagged table, split into candidates and rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adfeed.functions.rules import LAND_RULES, RuleSet, reject_reason
from adfeed.functions.text import clean_text
from adfeed.operators.dedup import dedup_text, position, text_key
from adfeed.session import spread, with_computed


def tag_posts(posts: DataFrame, rules: RuleSet = LAND_RULES) -> DataFrame:
    """Add the cleaned text and the reject reason (NULL for a candidate).

    Map-only, but for an input too small to fill the cores.  Write the result once before
    branching, or every branch runs the patterns again.
    """
    cleaned = with_computed(spread(posts), "texte_nettoye", clean_text(F.col("texte")))
    return with_computed(cleaned, "motif_rejet", reject_reason(F.col("texte_nettoye"), rules))


def candidates(tagged: DataFrame, order: Sequence[str]) -> DataFrame:
    """Accepted posts, exact text copies removed."""
    return dedup_text(tagged.filter("motif_rejet IS NULL").drop("motif_rejet"), order)


def rejects(tagged: DataFrame) -> DataFrame:
    """Rejected posts with their reason."""
    return tagged.filter("motif_rejet IS NOT NULL")


def reject_breakdown(rejected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of rejects per reason (and per group)."""
    return rejected.groupBy("motif_rejet", *by).agg(F.count("*").alias("nb_rejetes"))


def funnel(
    tagged: DataFrame, by: Sequence[str], order: Sequence[str], valid: DataFrame | None = None
) -> DataFrame:
    """Counts per group: raw, rejected, candidates after text dedup, copies, valid.

    raw = candidates + rejects + copies holds in every total.  One pass over the
    posts: they are counted per (text, group) before the shuffle, and the group
    with the first copy of a text is the one it counts for.  Rejects have no
    text key and are counted per group from the start.
    """
    accepted_key = F.when(F.col("motif_rejet").isNull(), text_key("texte_nettoye"))
    per_text = (
        tagged.select(*by, accepted_key.alias("_cle"), position(order).alias("_ordre"), "motif_rejet")
        .groupBy("_cle", *by)
        .agg(F.count("*").alias("nb_bruts"), F.count("motif_rejet").alias("nb_rejetes"), F.min("_ordre").alias("_premier"))
    )
    no_text = F.when(F.col("_cle").isNull(), position(by))
    first = F.row_number().over(Window.partitionBy("_cle", no_text).orderBy("_premier")) == 1
    counted = per_text.withColumn("_garde", F.col("_cle").isNotNull() & first).groupBy(*by).agg(
        F.sum("nb_bruts").alias("nb_bruts"), F.sum("nb_rejetes").alias("nb_rejetes"),
        F.count_if("_garde").alias("nb_candidats"),
    )
    if valid is None:
        counted = counted.withColumn("nb_valides", F.lit(0).cast("bigint"))
    else:
        counted = counted.join(valid.groupBy(*by).agg(F.count("*").alias("nb_valides")), list(by), "left")
    return counted.select(
        *by, "nb_bruts", "nb_rejetes", "nb_candidats",
        (F.col("nb_bruts") - F.col("nb_rejetes") - F.col("nb_candidats")).alias("nb_doublons"),
        F.coalesce("nb_valides", F.lit(0)).alias("nb_valides"),
        (100 * F.col("nb_candidats") / F.greatest("nb_bruts", F.lit(1))).alias("pct_candidats"),
    )
