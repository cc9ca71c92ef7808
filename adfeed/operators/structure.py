"""Structuring: an injected extractor turns each candidate text into a JSON answer."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.functions.checks import unknown_value
from adfeed.functions.model_output import validate_output
from adfeed.functions.vocab import DOCUMENT_STATUSES, ZONES, canonicalise
from adfeed.operators.dedup import text_key
from adfeed.schemas import STRUCTURED
from adfeed.session import with_computed
from adfeed.sources.tables import path_exists

# Call settings and reject reasons.
IN_FLIGHT = 5
MAX_TRIES = 3
BACKOFF_S = 2.0
FAILED = "echec_api_ou_validation"
JUDGED_INVALID = "llm_juge_invalide"

Extractor = Callable[[str], "str | None"]


class RateLimited(Exception):
    """Raised by an extractor that was told to slow down; tried again after a jittered wait."""


class Transient(Exception):
    """Raised by an extractor on a passing fault; tried again."""


class Permanent(Exception):
    """Raised by an extractor that cannot answer this text; not tried again."""


def call_extractor(
    text: str, extractor: Extractor, max_tries: int = MAX_TRIES, backoff_s: float = BACKOFF_S,
    sleep: Callable[[float], None] = time.sleep,
) -> str | None:
    """The answer for one text, or None once the tries are used up."""
    for attempt in range(max_tries):
        try:
            return extractor(text) or None
        except Permanent:
            return None
        except (RateLimited, Transient) as fault:
            if attempt + 1 < max_tries:
                jitter = random.uniform(0, 1) if isinstance(fault, RateLimited) else 0.0
                sleep(backoff_s * 2**attempt + jitter)
    return None


def structure(
    candidates: DataFrame, extractor: Extractor, text: str = "texte_nettoye", answer: str = "sortie_modele",
    in_flight: int = IN_FLIGHT, max_tries: int = MAX_TRIES, backoff_s: float = BACKOFF_S,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Add the extractor's raw answer (NULL on failure) to every candidate.

    ``in_flight`` bounds the calls of the whole job: tasks that can run at once
    times threads per task.  Only the text crosses to Python.  Write the result
    to a table before branching on it; a second action would call again, and a
    retried task repeats the calls of its partition.
    """
    slots = candidates.sparkSession.sparkContext.defaultParallelism
    if in_flight < slots:
        candidates, threads = candidates.repartition(in_flight), 1
    else:
        threads = in_flight // slots

    @F.pandas_udf("string")
    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with ThreadPoolExecutor(threads) as pool:
            for texts in batches:
                found = pool.map(lambda t: call_extractor(t, extractor, max_tries, backoff_s, sleep), texts)
                yield pd.Series(list(found), dtype=object)

    return candidates.withColumn(answer, answers.asNondeterministic()(F.col(text)))


def structure_once(
    candidates: DataFrame, extractor: Extractor, answers_path: str, text: str = "texte_nettoye",
    answer: str = "sortie_modele", **calls,
) -> DataFrame:
    """The same, asking only for texts without a stored answer and storing the new ones.

    Answers are kept by text hash, so a run that is started again after a failure
    pays only for what is missing.  Failures are not stored.
    """
    spark = candidates.sparkSession
    schema = f"_cle STRING, {answer} STRING"

    def stored() -> DataFrame:
        if not path_exists(spark, answers_path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(answers_path).dropDuplicates(["_cle"])

    keyed = candidates.withColumn("_cle", text_key(text))
    asked = keyed.select("_cle", text).dropDuplicates(["_cle"]).join(stored(), "_cle", "left_anti")
    answered = structure(asked, extractor, text, answer, **calls)
    answered.select("_cle", answer).filter(F.col(answer).isNotNull()).write.mode("append").parquet(answers_path)
    return keyed.join(stored(), "_cle", "left").drop("_cle")


def route(
    answered: DataFrame, answer: str | Column = "sortie_modele", strict: bool = False,
    zones: Sequence[str] = tuple(ZONES), statuses: Sequence[str] = tuple(DOCUMENT_STATUSES),
) -> DataFrame:
    """Typed fields and ``motif_rejet`` (NULL for a valid ad) from the raw answers.

    Fields of the answer replace fields of the post; ``type_bien_inconnu`` flags a type
    outside the closed list.  Zone and status are canonicalised on valid ads only; an ad judged invalid keeps its fields as
    answered, a failed one has none.
    """
    raw = F.col(answer) if isinstance(answer, str) else answer
    read = with_computed(answered, "_s", validate_output(raw, strict))
    valid = F.col("_s.est_une_annonce_valide")
    names = STRUCTURED.fieldNames()

    def field(name: str) -> Column:
        value = F.col(f"_s.{name}")
        vocab = {"quartier_zone": zones, "statut_document": statuses}.get(name)
        return F.when(valid, canonicalise(value, vocab)).otherwise(value) if vocab else value

    kept = [c for c in answered.columns if c not in names and c != answer]
    reason = F.when(F.col("_s").isNull(), FAILED).when(~valid, JUDGED_INVALID)
    kept = [c for c in kept if c != "type_bien_inconnu"]
    unknown = F.when(F.col("_s").isNotNull(), unknown_value(F.col("_s.type_bien"))).alias("type_bien_inconnu")
    return read.select(*kept, *[field(n).alias(n) for n in names], unknown, reason.alias("motif_rejet"))


def valid_ads(routed: DataFrame) -> DataFrame:
    return routed.filter("motif_rejet IS NULL").drop("motif_rejet")


def invalid_posts(routed: DataFrame) -> DataFrame:
    return routed.filter("motif_rejet IS NOT NULL")
