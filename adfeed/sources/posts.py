"""Raw post files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeed.operators.dedup import dedup_last
from adfeed.schemas import RAW_POST
from adfeed.session import cut_lineage, with_computed

# A post's place in its input: files by name, then position.
ORDER = ["_file", "_pos"]


def _file_order() -> Column:
    """Files by name; equal names in several folders by their path."""
    return F.concat_ws(" ", "_metadata.file_name", "_metadata.file_path").alias("_file")


def _with_posts(files: DataFrame) -> DataFrame:
    """Add the parsed array; NULL for a value that is not one whole JSON array of objects."""
    text = F.btrim("value", F.lit(" \t\r\n"))
    # from_json alone would take a bare object for an array of one.
    array = F.when(text.startswith("[") & text.endswith("]"), F.from_json("value", T.ArrayType(RAW_POST)))
    return with_computed(files, "_posts", array)


def parse_post_files(files: DataFrame) -> DataFrame:
    """Posts of (_file, value) rows whose value is a JSON array of posts.

    A value that is not one whole JSON array gives no rows, and an element
    without id is left out; see file_issues.
    """
    posts = _with_posts(files).select("_file", F.posexplode("_posts").alias("_pos", "_p"))
    return posts.select("_p.*", "_file", F.col("_pos").cast("bigint").alias("_pos")).filter("id IS NOT NULL")


def file_issues(files: DataFrame) -> DataFrame:
    """What parse_post_files leaves out: (_file, readable, sans_id)."""
    without_id = F.size(F.filter("_posts", lambda post: post.id.isNull()))
    read = _with_posts(files).select(
        "_file", F.col("_posts").isNotNull().alias("lisible"),
        F.when(F.col("_posts").isNotNull(), without_id).otherwise(0).alias("sans_id"),
    )
    return read.filter("NOT lisible OR sans_id > 0")


# Files of up to so many bytes are read whole, each by one task; larger ones block by block.
WHOLE_BYTES = 8 << 20


def load_raw_posts(spark: SparkSession, *paths: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """All posts of JSON-array files, one row per id: last value, first position.

    A file larger than ``whole_bytes`` doesn't go through one task; it is read as by ``load_large_posts``.
    """
    size = F.col("_metadata.file_size")
    files = spark.read.text(list(paths), wholetext=True).filter(size <= whole_bytes).select(_file_order(), "value")
    posts = parse_post_files(files)
    listed = spark.read.format("binaryFile").load(list(paths)).select("length")  # contents are not read
    if not listed.filter(F.col("length") > whole_bytes).isEmpty():
        posts = posts.unionByName(_large_posts(spark, list(paths), whole_bytes))
    return merge_posts(posts)


_BLOCK = ["_file", "_bloc"]


def _sum_before(pieces: DataFrame, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all pieces of the file before each one: within its block, and over the blocks before."""
    within = Window.partitionBy(*_BLOCK).orderBy("_rang").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("_file").orderBy("_bloc").rowsBetween(Window.unboundedPreceding, -1)  # one row for each block
    blocks = pieces.groupBy(*_BLOCK).agg(F.sum(value).alias("_somme"))
    starts = blocks.select(*_BLOCK, F.coalesce(F.sum("_somme").over(ahead), F.lit(0)).alias("_avant"))
    summed = pieces.withColumn("_ici", F.coalesce(F.sum(value).over(within), F.lit(0))).join(starts, _BLOCK)
    return summed.withColumn(name, F.col("_ici") + F.col("_avant")).drop("_ici", "_avant")


def _amount(text: Column, *chars: str) -> Column:
    """How often some characters stand in a text."""
    return sum(F.length(text) - F.length(F.replace(text, F.lit(c))) for c in chars)


def _structure(piece: Column, inside: Column) -> Column:
    """A piece of JSON, escapes taken out, without what stands in strings; ``inside``: it starts in one."""
    begun = F.when(inside, F.regexp_replace(piece, r'(?s)^[^"]*("|$)', "")).otherwise(piece)
    return F.regexp_replace(begun, r'(?s)"[^"]*("|$)', "")


def _elements(spark: SparkSession, paths: list[str], larger_than: int) -> DataFrame:
    """(_file, _pos, _reste, value, _bon): the elements of array files, and what follows the last one of each."""
    read = spark.read.option("lineSep", "}").text(paths).filter(F.col("_metadata.file_size") > larger_than)
    pieces = cut_lineage(read.select(
        _file_order(), F.col("_metadata.file_block_start").alias("_bloc"), F.monotonically_increasing_id().alias("_rang"), F.col("value").alias("_bout")
    ))
    # What the sums need of a piece are a few numbers, for either start; its text stays where it is.
    bare = with_computed(pieces, "_nu", F.regexp_replace("_bout", r"(?s)\\.", ""))
    for name, inside in (("_dehors", False), ("_dedans", True)):
        bare = with_computed(bare, f"{name}_signes", _structure(F.col("_nu"), F.lit(inside)))

    def slope(signs: Column) -> Column:
        return _amount(signs, "[", "{") - _amount(signs, "]", "}")

    narrow = cut_lineage(bare.select(
        *_BLOCK, "_rang", (_amount(F.col("_nu"), '"') % 2).alias("_guillemets"),
        slope(F.col("_dehors_signes")).alias("_dehors"), slope(F.col("_dedans_signes")).alias("_dedans"),
    ))
    quoted = _sum_before(narrow, "_guillemets", "_q")
    # The brace after a piece counts outside of strings. Only the last piece of a file has none.
    place = F.struct("_bloc", "_rang")
    ends = narrow.groupBy("_file").agg(F.max(place).alias("_fin"))
    marked = quoted.join(ends, "_file").withColumn("_dernier", place == F.col("_fin"))
    braced = ~F.col("_dernier") & ((F.col("_q") + F.col("_guillemets")) % 2 == 0)
    change = F.when(F.col("_q") % 2 == 1, F.col("_dedans")).otherwise(F.col("_dehors")) - F.when(braced, 1).otherwise(0)
    sloped = cut_lineage(marked.select(*_BLOCK, "_rang", "_dernier", braced.alias("_ferme"), change.alias("_pente")))
    deep = _sum_before(sloped, "_pente", "_niveau").withColumn("_niveau", F.col("_niveau") + F.col("_pente"))
    closing = (F.col("_ferme") & (F.col("_niveau") == 1)).cast("int")
    closed = cut_lineage(deep.select(*_BLOCK, "_rang", "_dernier", "_niveau", closing.alias("_clos")))
    numbered = _sum_before(closed, "_clos", "_pos").drop("_clos")
    # The pieces of one element, and what follows the last one.
    parts = F.sort_array(F.collect_list(F.struct("_bloc", "_rang", "_bout")))
    whole = pieces.join(numbered, [*_BLOCK, "_rang"]).groupBy("_file", "_pos").agg(
        F.array_join(F.transform(parts, lambda p: p["_bout"]), "}").alias("_texte"), F.max("_dernier").alias("_reste"), F.max(F.when(F.col("_dernier"), F.col("_niveau"))).alias("_profondeur")
    )
    blank = " \t\r\n"
    lead = F.when(F.col("_pos") == 0, "[").otherwise(",")
    text = F.btrim("_texte", F.lit(blank))
    inner = F.when(text.startswith(lead), F.btrim(F.expr("substring(btrim(_texte, ' \t\r\n'), 2)"), F.lit(blank)))
    tail = F.when(F.col("_pos") == 0, text.rlike(r"^\[[ \t\r\n]*\]$")).otherwise(text == "]")
    sound = F.when(F.col("_reste"), tail & (F.col("_profondeur") == 0)).otherwise(F.coalesce(inner.startswith("{"), F.lit(False)))
    return whole.select("_file", F.col("_pos").cast("bigint").alias("_pos"), "_reste", F.concat(inner, F.lit("}")).alias("value"), sound.alias("_bon"))


def split_array_files(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """The elements of JSON-array files, each file read by as many tasks as it has blocks.

    Returns (_file, _pos, value) for each element, and (_file, lisible) for each file. A file is
    read in pieces that end at a closing brace, wherever that stands. The quotes of the pieces
    before a piece tell whether it starts inside a string, and then its brackets tell how it
    changes the depth; both are sums, taken within each block and over the blocks before, so
    no task needs more than its block. An element ends at a brace that brings the depth back to
    one. A file that does not open and close as one array of objects is not readable.
    """
    judged = cut_lineage(_elements(spark, list(paths), -1))
    files = judged.groupBy("_file").agg(F.bool_and("_bon").alias("lisible"))
    elements = judged.filter(~F.col("_reste")).join(files.filter("lisible"), "_file", "left_semi")
    return elements.select("_file", "_pos", "value"), files


def _large_posts(spark: SparkSession, paths: list[str], larger_than: int = -1) -> DataFrame:
    """Posts of the array files above a size, read block by block. Texts are stored twice: as pieces and as posts."""
    found = _elements(spark, paths, larger_than)
    array = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), T.ArrayType(RAW_POST))  # NULL for one that cannot be read
    parsed = with_computed(found, "_posts", F.when(F.col("_bon") & ~F.col("_reste"), array))
    sound = F.col("_bon") & (F.col("_reste") | F.col("_posts").isNotNull())
    stored = cut_lineage(parsed.select("_file", "_pos", F.col("_posts")[0].alias("_p"), sound.alias("_bon")))
    broken = stored.groupBy("_file").agg(F.bool_and("_bon").alias("_bon")).filter("NOT _bon").select("_file")
    posts = stored.join(broken, "_file", "left_anti")
    return posts.filter("_p.id IS NOT NULL").select("_p.*", "_file", "_pos")


def load_large_posts(spark: SparkSession, *paths: str) -> DataFrame:
    """As ``load_raw_posts``, every file block by block, so that none is too large for one task."""
    return merge_posts(_large_posts(spark, list(paths)))


def _lines(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    """Lines of the files with their post (NULL if a line is no JSON object) and their block."""
    read = spark.read.text(list(paths)).filter(F.btrim("value", F.lit(" \t\r")) != "")
    placed = read.select("value", _file_order(), F.col("_metadata.file_block_start").alias("_bloc"))
    schema = T.StructType([*RAW_POST.fields, T.StructField("_pos", T.LongType())])
    whole = F.btrim("value", F.lit(" \t\r")).rlike(r"(?s)^\{.*\}$")
    post = F.when(whole, F.element_at(F.from_json(F.concat(F.lit("["), "value", F.lit("]")), T.ArrayType(schema)), 1))
    return with_computed(placed, "_p", post)


def load_raw_post_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """The same for files with one JSON post per line, which can be split and may be large.

    A line may say its place in a field ``_pos``. Without it, lines count from the start
    of their block, which one task reads from start to end.
    """
    lines = _lines(spark, paths).filter("_p.id IS NOT NULL")
    read = F.coalesce("_p._pos", F.monotonically_increasing_id()).alias("_pos")
    placed = lines.select(*[F.col(f"_p.{f.name}") for f in RAW_POST.fields], "_file", "_bloc", read)
    return dedup_last(placed, "id", ["_file", "_bloc", "_pos"])


def line_issues(spark: SparkSession, *paths: str) -> DataFrame:
    """What load_raw_post_lines leaves out: (_file, _bloc, value, lisible); readable lines have no id."""
    lines = _lines(spark, paths)
    return lines.filter("_p.id IS NULL").select("_file", "_bloc", "value", F.col("_p").isNotNull().alias("lisible"))


def load_raw_table(spark: SparkSession, path: str) -> DataFrame:
    """Posts appended by sinks.append_raw, one row per id."""
    fields = [*RAW_POST.fields, T.StructField("run_ts", T.StringType()), T.StructField("_pos", T.ArrayType(T.LongType()))]
    stored = spark.read.schema(T.StructType(fields)).parquet(path)
    placed = stored.withColumnRenamed("run_ts", "_file").withColumn("_groupe", F.col("groupe_id"))
    return dedup_last(placed, "id", ["_file", "_groupe", "_pos"]).drop("_groupe")


def merge_posts(posts: DataFrame) -> DataFrame:
    return dedup_last(posts, "id", ORDER)
