"""Finding post records inside undocumented nested JSON.

Key order matters (the first match in document order wins), which rules out a
VARIANT walk: it sorts the keys of an object.  So each JSON text is walked in a
Python worker, Arrow batch by Arrow batch; finding the texts, exploding,
deduplication and all typing stay native.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from json.decoder import scanstring
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeed.functions.dates import epoch_ts
from adfeed.functions.text import body_documents, html_json_blobs, iso_text
from adfeed.operators.dedup import dedup_first
from adfeed.schemas import RECORD
from adfeed.session import spread, with_computed


@dataclass(frozen=True)
class RecordSpec:
    """How a record and its fields look. The defaults are fixed values."""

    id_key: str = "id"
    required_keys: tuple[str, ...] = ("id", "comet_sections")
    text_path: tuple[str, str] = ("message", "text")
    url_key: str = "url"
    url_parts: tuple[str, ...] = ("/posts/", "/permalink/")
    time_key: str = "creation_time"
    min_time: int = 1_000_000_000
    max_depth: int | None = None  # levels below a record that are searched for its fields


def _children(node: Any) -> list:
    if isinstance(node, dict):
        return list(node.values())
    return node if isinstance(node, list) else []


def _is_record(node: Any, spec: RecordSpec) -> bool:
    return (
        isinstance(node, dict)
        and isinstance(node.get(spec.id_key), str)
        and all(key in node for key in spec.required_keys)
    )


def _fields(record: dict, spec: RecordSpec) -> tuple[str | None, str | None, Any]:
    """(text, url, time) nearest to the record, searched level by level."""
    text = url = time = None
    level = [record]
    for depth in itertools.count():
        for node in level:
            if not isinstance(node, dict):
                continue
            if text is None:
                holder = node.get(spec.text_path[0])
                value = holder.get(spec.text_path[1]) if isinstance(holder, dict) else None
                if isinstance(value, str) and value.strip():
                    text = value
            if url is None:
                value = node.get(spec.url_key)
                if isinstance(value, str) and any(part in value for part in spec.url_parts):
                    url = value
            if time is None:
                value = node.get(spec.time_key)
                if isinstance(value, (int, float)) and not isinstance(value, bool) and value > spec.min_time:
                    time = value
        level = [child for node in level for child in _children(node)]
        if not level or None not in (text, url, time) or depth == spec.max_depth:
            break
    return text, url, time


def _plain(value: str | None) -> str | None:
    """Text that can be stored: a lone surrogate becomes U+FFFD."""
    return value and value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?")
_WORDS = {"null": None, "true": True, "false": False, "NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}


def _integer(digits: str) -> int | str:
    """A whole number; one with more digits than the interpreter converts stays text."""
    try:
        return int(digits)
    except ValueError:
        return digits


def parse_deep(text: str) -> Any:
    """A JSON text of any depth; open lists and objects stand on a list instead of the call stack.

    Raises ValueError like ``json.loads``, which is faster but ends at some depth.
    """
    root: list = []
    open_nodes: list[tuple[Any, str | None]] = [(root, None)]  # node, key that waits for its value
    at, size, need_value = _SPACE.match(text).end(), len(text), True
    while True:
        node, key = open_nodes[-1]
        if need_value:
            char = text[at : at + 1]
            if char and char in "]}" and not node and len(open_nodes) > 1 and key is None:
                need_value = False  # an empty list or object ends here
                continue
            if isinstance(node, dict) and key is None:
                if char != '"':
                    raise ValueError(f"key expected at {at}")
                name, at = scanstring(text, at + 1, True)
                at = _SPACE.match(text, at).end()
                if text[at : at + 1] != ":":
                    raise ValueError(f"colon expected at {at}")
                open_nodes[-1] = (node, name)
                at = _SPACE.match(text, at + 1).end()
                continue
            number = _NUMBER.match(text, at)
            word = next((w for w in _WORDS if text.startswith(w, at)), None)
            opened = None
            if char == '"':
                value, at = scanstring(text, at + 1, True)
            elif char and char in "[{":
                value = opened = [] if char == "[" else {}
                at += 1
            elif word:
                value, at = _WORDS[word], at + len(word)
            elif number:
                value = float(number[0]) if number[1] or number[2] else _integer(number[0])
                at = number.end()
            else:
                raise ValueError(f"value expected at {at}")
            if isinstance(node, dict):
                node[key] = value
                open_nodes[-1] = (node, None)
            else:
                node.append(value)
            at = _SPACE.match(text, at).end()
            if opened is not None:
                open_nodes.append((opened, None))
                continue
            need_value = False
        elif len(open_nodes) == 1:
            if at < size:
                raise ValueError(f"text after the value at {at}")
            return root[0]
        elif text[at : at + 1] == ",":
            at, need_value = _SPACE.match(text, at + 1).end(), True
            if text[at : at + 1] in ("]", "}"):
                raise ValueError(f"value expected at {at}")
        elif text[at : at + 1] == ("}" if isinstance(node, dict) else "]"):
            open_nodes.pop()
            at = _SPACE.match(text, at + 1).end()
        else:
            raise ValueError(f"comma or end expected at {at}")


def parse_json(text: str) -> Any:
    """A JSON text of any depth, with numbers of any length; ValueError for other text."""
    try:
        return json.loads(text)
    except RecursionError:
        return parse_deep(text)
    except json.JSONDecodeError:
        raise
    except ValueError:  # a number that is too long; found seldom, so read again with a slower rule for numbers
        try:
            return json.loads(text, parse_int=_integer)
        except RecursionError:
            return parse_deep(text)


def find_records(payload: Any, spec: RecordSpec = RecordSpec()) -> list[dict]:
    """Records of a parsed JSON value in document order, each id once.

    A record with a text is taken whole; one without is searched for inner
    records.  The walk keeps its own stack, so depth is no limit; fields are searched to
    any depth too, unless the spec says otherwise.
    """
    found, known, stack = [], set(), [payload]
    while stack:
        node = stack.pop()
        if _is_record(node, spec) and node[spec.id_key] not in known:
            text, url, time = _fields(node, spec)
            if text is not None:
                known.add(node[spec.id_key])
                try:
                    seconds = None if time is None else float(time)
                except OverflowError:
                    seconds = None
                found.append(
                    {"id": _plain(node[spec.id_key]), "url": _plain(url), "texte": _plain(text), "creation_time": seconds}
                )
                continue
        stack.extend(reversed(_children(node)))
    return found


# Rows and bytes of one Arrow batch: a worker holds the texts of a batch and all their records.
BATCH_ROWS, BATCH_BYTES = "1000", str(8 << 20)


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def records_column(col: Column, spec: RecordSpec = RecordSpec()) -> Column:
    """Array of the records in a JSON text; NULL for text that is not JSON."""

    @F.pandas_udf(T.ArrayType(RECORD))
    def walk(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[dict] | None:
            try:
                return None if text is None else find_records(parse_json(text), spec)
            except ValueError:
                return None

        return texts.map(one)

    return walk(col)


def extract_records(
    documents: DataFrame, json_col: str, keep: Sequence[str], scraped_at: Column | datetime,
    spec: RecordSpec = RecordSpec(),
) -> DataFrame:
    """One row per record: the ``keep`` columns, rec_pos and the raw-post fields."""
    _small_batches(documents.sparkSession)
    at = scraped_at if isinstance(scraped_at, Column) else F.lit(scraped_at)
    found = documents.select(*keep, F.posexplode(records_column(F.col(json_col), spec)).alias("rec_pos", "_r"))
    published = epoch_ts(F.col("_r.creation_time"))
    return found.select(
        *keep, "rec_pos", F.col("_r.id").alias("id"), F.col("_r.url").alias("url"),
        F.col("_r.texte").alias("texte"), published.alias("date_publication"),
        published.isNull().alias("date_incertaine"), iso_text(at).alias("scrape_le"),
    )


def html_blobs(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """One row per embedded JSON script of a page, with its position."""
    return spread(pages).select(*keep, F.posexplode(html_json_blobs(F.col(html))).alias("blob_pos", "json"))


def _readable(col: Column, spec: RecordSpec) -> Column:
    return records_column(col, spec).isNotNull()


def unread_blobs(pages: DataFrame, page_key: Sequence[str], html: str = "html", spec: RecordSpec = RecordSpec()) -> DataFrame:
    """The embedded scripts of pages that are no JSON: page key, blob_pos, json."""
    _small_batches(pages.sparkSession)
    return html_blobs(pages, page_key, html).filter(~_readable(F.col("json"), spec))


def unread_bodies(responses: DataFrame, keep: Sequence[str], body: str = "body", spec: RecordSpec = RecordSpec()) -> DataFrame:
    """What of response bodies gives no record: keep, doc_pos, json.

    Of a body that is one JSON text nothing is unread; of another one, each line that is no JSON.
    """
    _small_batches(responses.sparkSession)
    documents = responses.select(*keep, F.posexplode(body_documents(F.col(body))).alias("doc_pos", "json"))
    judged = with_computed(documents, "_lisible", _readable(F.col("json"), spec))
    # The whole body stands first; a body of one line has no other candidate.
    lines = Window.partitionBy(*keep)
    counted = judged.withColumn("_documents", F.count("*").over(lines)).withColumn("_entier", F.max(F.when(F.col("doc_pos") == 0, F.col("_lisible"))).over(lines))
    return counted.filter(~F.col("_entier") & ~F.col("_lisible") & ((F.col("doc_pos") > 0) | (F.col("_documents") == 1))).select(*keep, "doc_pos", "json")


def page_records(
    pages: DataFrame, page_key: Sequence[str], scraped_at: Column | datetime, keep: Sequence[str] = (),
    spec: RecordSpec = RecordSpec(),
) -> DataFrame:
    """Records of stored pages, the first of each id per page."""
    carried = [*page_key, *keep]
    found = extract_records(html_blobs(pages, carried), "json", [*carried, "blob_pos"], scraped_at, spec)
    return dedup_first(found, [*page_key, "id"], ["blob_pos", "rec_pos"])


def body_records(
    responses: DataFrame, keep: Sequence[str], scraped_at: Column | datetime, body: str = "body",
    spec: RecordSpec = RecordSpec(),
) -> DataFrame:
    """Records of response bodies that may hold several JSON documents."""
    documents = spread(responses).select(*keep, F.posexplode(body_documents(F.col(body))).alias("doc_pos", "json"))
    return extract_records(documents, "json", [*keep, "doc_pos"], scraped_at, spec)


def with_group(records: DataFrame, groups: DataFrame) -> DataFrame:
    """Add the group's name."""
    return records.join(groups.select(F.col("id").alias("groupe_id"), F.col("nom").alias("groupe_nom")), "groupe_id", "left")
