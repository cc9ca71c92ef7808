"""The two kinds of processing run and the collection step before them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeed.functions.capture import OK, capture_status
from adfeed.functions.extract import rule_extract
from adfeed.functions.rules import LAND_RULES, RuleSet
from adfeed.functions.text import iso_text
from adfeed.operators.catchup import Catchup, new_posts
from adfeed.operators.dedup import text_duplicates
from adfeed.operators.filtering import candidates, rejects, tag_posts
from adfeed.operators.records import body_records, page_records, with_group
from adfeed.operators.runs import check_drift, run_row, run_summary
from adfeed.operators.structure import Extractor, invalid_posts, route, structure_once, valid_ads
from adfeed.session import cut_lineage
from adfeed.sinks.exports import export_ads, export_candidates, export_master, write_rejects
from adfeed.sinks.tables import append_raw, log_run, save_markers, save_seen, upsert_master
from adfeed.sources.state import load_markers, load_master, load_runs, load_seen


def _written(df: DataFrame, path: str) -> DataFrame:
    """Write a step once and go on from the file: no step is computed twice."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _held(one_row: DataFrame) -> DataFrame:
    """A result of one row, computed now and held by the driver."""
    return one_row.sparkSession.createDataFrame(one_row.collect(), one_row.schema)


def rules_only_run(
    posts: DataFrame, out: str, order: Sequence[str], rules: RuleSet = LAND_RULES, contacts: str = "masked"
) -> DataFrame:
    """Filter, export the candidates, return them. No structuring, no run row, no upsert."""
    found = candidates(tag_posts(posts, rules), order)
    export_candidates(found, f"{out}/candidats_sans_llm", contacts=contacts)
    return found


@dataclass(frozen=True)
class Places:
    """Folders of a run. ``out`` belongs to one run, the others live on."""

    master: str
    runs: str
    out: str
    consult: str


def full_run(
    spark: SparkSession,
    posts: DataFrame,
    places: Places,
    now: datetime,
    order: Sequence[str],
    mode: str = "daily",
    extractor: Extractor | None = None,
    rules: RuleSet = LAND_RULES,
    contacts: str = "masked",
    strict: bool = False,
    issues: DataFrame | None = None,
    **calls,
) -> DataFrame:
    """Filter, structure, upsert, export, watch the volume; returns the one-row summary.

    Rejects, text copies (``doublons``) and, given as ``issues``, what the reader could
    not read (``illisibles``) are listed beside the exports.

    Without an extractor the rule-based one fills the fields.  The two steps that
    have several readers, tagged posts and routed answers, are written.  The extractor's
    answers are kept in ``out``: a run started again with the same places does not ask twice.
    """
    if not places.master:
        raise ValueError("the master folder must be set before any paid call")
    tagged = _written(tag_posts(posts, rules), f"{places.out}/etiquetes")
    chosen = candidates(tagged, order)
    if extractor is None:
        answered = chosen.withColumn("sortie_modele", rule_extract(F.col("texte_nettoye"), rules))
    else:
        answered = structure_once(chosen, extractor, f"{places.out}/appels", **calls)
    routed = _written(route(answered, strict=strict), f"{places.out}/champs")
    valid = valid_ads(routed)
    counts = _held(_counts(tagged, routed))
    drift = _held(check_drift(load_runs(spark, places.runs), counts.first()["nb_valides"], mode))

    upsert_master(valid, places.master, now, order)
    export_master(load_master(spark, places.master), places.consult, contacts=contacts)
    export_ads(valid, f"{places.out}/annonces", contacts=contacts)
    write_rejects(rejects(tagged), invalid_posts(routed), f"{places.out}/rejetes", contacts=contacts)
    text_duplicates(tagged.filter("motif_rejet IS NULL"), order).write.mode("overwrite").json(f"{places.out}/doublons")
    if issues is not None:
        issues.write.mode("overwrite").json(f"{places.out}/illisibles")
    log_run(run_row(counts, now, mode), places.runs)
    return run_summary(counts, drift, places.master)


def _counts(tagged: DataFrame, routed: DataFrame) -> DataFrame:
    """The funnel of a run in one row, from the two stored steps: no text is compared again."""
    answered = routed.agg(F.count("*").alias("n"), F.count_if(F.col("motif_rejet").isNull()).alias("v"))
    return tagged.agg(F.count("*").alias("nb_bruts"), F.count("motif_rejet").alias("nb_rejetes")).select(
        "nb_bruts", "nb_rejetes", answered.select("n").scalar().alias("nb_candidats"), answered.select("v").scalar().alias("nb_valides")
    ).withColumn("nb_doublons", F.col("nb_bruts") - F.col("nb_rejetes") - F.col("nb_candidats"))


def captures_of(pages: DataFrame, responses: DataFrame, now: datetime) -> tuple[DataFrame, DataFrame]:
    """Post records of stored captures with their place in the feed, and the captures left out.

    ``pages``: groupe_id, url, html, the first page of each group.  ``responses``:
    groupe_id, step, response_pos, body.  Bad pages are listed with their status.
    Records are written once; ``pos`` is an array of positions, from coarse to fine.
    """
    judged = pages.withColumn("statut", capture_status(F.col("url"), F.col("html")))
    fields = ["id", "url", "texte", "date_publication", "date_incertaine", "scrape_le"]

    def positions(*names: str):
        return F.array(*[F.col(n).cast("bigint") for n in names]).alias("pos")

    featured = page_records(judged.filter(F.col("statut") == OK).select("groupe_id", "html"), ["groupe_id"], now).select(
        "groupe_id", F.lit(None).cast("bigint").alias("step"), positions("blob_pos", "rec_pos"), F.lit(True).alias("featured"), *fields
    )
    scrolled = body_records(responses, ["groupe_id", "step", "response_pos"], now).select(
        "groupe_id", F.col("step").cast("bigint").alias("step"), positions("response_pos", "doc_pos", "rec_pos"), F.lit(False).alias("featured"), *fields
    )
    return cut_lineage(featured.unionByName(scrolled)), judged.filter(F.col("statut") != OK).select("groupe_id", "url", "statut")


def collect_posts(
    pages: DataFrame, responses: DataFrame, groups: DataFrame, seen_path: str, marker_path: str, raw_path: str,
    cutoff: datetime, now: datetime, audit_path: str | None = None,
) -> Catchup:
    """From stored captures to new raw posts: find records, keep every unseen post, keep state.

    Appends the new posts to ``raw_path`` and pages that were left out to ``audit_path``,
    and returns what was collected; the raw posts are written before the state, so a
    failure in between loses nothing.
    """
    captures, left_out = captures_of(pages, responses, now)
    spark = captures.sparkSession
    result = new_posts(captures, load_seen(spark, seen_path, captures), load_markers(spark, marker_path), cutoff)
    chosen = cut_lineage(result.posts.select("groupe_id", "id", F.col("step").alias("_etape"), F.col("pos").alias("_place"), "featured"))
    same = [captures["groupe_id"] == chosen["groupe_id"], captures["id"] == chosen["id"], captures["featured"] == chosen["featured"],
            captures["step"].eqNullSafe(chosen["_etape"]), captures["pos"] == chosen["_place"]]
    posts = with_group(captures.join(chosen, same, "left_semi"), groups)
    step = F.array(F.when(F.col("featured"), F.lit(-1)).otherwise(F.col("step")).cast("bigint"))
    raw = posts.select(
        "id", "groupe_id", "groupe_nom", "url", "texte", iso_text(F.col("date_publication")).alias("date_publication"),
        "date_incertaine", "scrape_le", F.concat(step, "pos").alias("_pos"),
    )
    append_raw(raw, raw_path, now.strftime("%Y%m%dT%H%M%SZ"))
    if audit_path:
        left_out.withColumn("releve_le", F.lit(now)).write.mode("append").parquet(audit_path)
    markers = cut_lineage(result.groups.select("groupe_id", "post_id"))
    save_seen(chosen.select("id", F.lit(now.isoformat()).alias("scrape_le")), seen_path, now)
    save_markers(markers, marker_path)
    return result
