"""What is new in an ordered capture log, and how it stands to the marker and the window."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.operators.seen import unseen
from adfeed.session import cut_lineage


@dataclass(frozen=True)
class Catchup:
    posts: DataFrame   # groupe_id, id, step, pos, date_publication, featured, apres_repere, hors_fenetre
    groups: DataFrame  # groupe_id, nb_posts, plus_ancien, etape_repere, post_id (the marker to keep)


def new_posts(captures: DataFrame, seen: DataFrame, markers: DataFrame, cutoff: Column | datetime) -> Catchup:
    """Every captured post that is not in ``seen``, at its first place in its group.

    ``captures``: groupe_id, step, pos (any value that orders a step), id,
    date_publication, featured.  Featured posts come first.  Nothing is dropped: that a
    post lies behind the step which shows the group's marker, or before the cutoff, is
    said in ``apres_repere`` and ``hors_fenetre``.  The marker to keep is the group's
    newest unseen post, else the old one.
    """
    limit = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    place = F.struct((~F.col("featured")).alias("fil"), "step", "pos", "date_publication")
    known = markers.select("groupe_id", F.col("post_id").alias("id"))
    shown = captures.filter("NOT featured").join(known, ["groupe_id", "id"], "left_semi")
    at_marker = shown.groupBy("groupe_id").agg(F.min("step").alias("etape_repere"))
    # One row per (group, id), combined before the shuffle; read by both results.
    first = cut_lineage(unseen(captures.groupBy("groupe_id", "id").agg(F.min(place).alias("_p")), seen).join(at_marker, "groupe_id", "left"))
    posts = first.select(
        "groupe_id", "id", "_p.step", "_p.pos", "_p.date_publication", (~F.col("_p.fil")).alias("featured"),
        F.coalesce(F.col("_p.fil") & (F.col("_p.step") > F.col("etape_repere")), F.lit(False)).alias("apres_repere"),
        F.coalesce(F.col("_p.date_publication") < limit, F.lit(False)).alias("hors_fenetre"),
    )
    counted = first.groupBy("groupe_id").agg(
        F.count("*").alias("nb_posts"), F.min(F.when(F.col("_p.fil"), F.col("_p.date_publication"))).alias("plus_ancien"),
        F.min(F.when(F.col("_p.fil"), F.struct("_p.step", "_p.pos", "id"))).alias("_premier"),
    )
    groups = (
        captures.select("groupe_id").distinct().join(counted, "groupe_id", "left").join(at_marker, "groupe_id", "left")
        .join(markers, "groupe_id", "left")
        .select(
            "groupe_id", F.coalesce("nb_posts", F.lit(0)).alias("nb_posts"), "plus_ancien", "etape_repere",
            F.coalesce("_premier.id", "post_id").alias("post_id"),
        )
    )
    return Catchup(posts, groups)
