"""Near duplicates among embeddings by iterative quantisation.

A rotation learned on a bounded sample turns each vector into 64 or more balanced bits
(principal directions, then alternating between nearest corner of the cube and best
rotation). Codes are looked up in tables, one for each stretch of 21 or 22 bits, where
both sides also stand under every key with one (or two) bits flipped: codes meet that
differ in up to two (or four) bits of a stretch.

How many bits, and flips, the data decide: pairs at exactly the threshold are made from the
sample, half of them towards differences that the sample holds and half in any direction, and
the cheapest tables are taken in which RECALL of both kinds meet. Where vectors share a common
direction, what is left of them differs more at the same cosine, and takes more tables. Codes
further apart than any made pair are not compared. The vectors behind two codes are compared
in blocks, in double precision. Every link returned is exact; recall is measured in the tests.

Equal vectors (up to a factor) become one item first, vectors with the same code one
class. Blocks report link counts and one edge per vector, never their pairs, so large
groups cost arithmetic and no rows. A class of any size is split into blocks.

Defined results. Vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own component. Vectors of different
lengths never link. Null ids do not count in component_id. Repeated rows are vectors
of their own and link with each other. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.llm.common import components, task, written

BITS = 64  # of a word of a code
TABLES = ((0, 22), (22, 21), (43, 21))  # first bit and width, in each word
LAYOUTS = ((1, 1), (1, 2), (2, 1), (2, 2), (4, 2), (6, 2))  # words and flips, the cheapest first
RECALL = 0.98
PAIRS = 4000  # made to choose a layout
SAMPLE = 20_000
ROUNDS = 30
BLOCK = 1024

CODES = pa.schema([("item", pa.int64()), ("dim", pa.int32()), ("code", pa.list_(pa.int64())), ("vector", pa.binary())])
FOUND = pa.schema([("item", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def learned_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, directions): bit i of a unit vector x says whether (x - mean) @ directions[:, i] > 0.

    Fewer dimensions than bits take several rotations.
    """
    dim = sample.shape[1]
    draw = np.random.default_rng(seed)
    mean = sample.mean(0) if len(sample) else np.zeros(dim)
    centred = sample - mean
    _, vectors = np.linalg.eigh(centred.T @ centred) if len(sample) else (None, np.eye(dim))
    width = min(bits, dim)
    principal = vectors[:, ::-1][:, :width]
    columns: list[np.ndarray] = []
    while sum(c.shape[1] for c in columns) < bits:
        rotation = np.linalg.qr(draw.normal(size=(width, width)))[0]
        flat = centred @ principal
        for _ in range(rounds if len(sample) else 0):
            corners = np.where(flat @ rotation > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(corners.T @ flat)
            rotation = (left @ right).T
        columns.append(principal @ rotation)
    return mean, np.hstack(columns)[:, :bits]


def codes_of(vectors: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    mean, directions = model
    bits = (unit - mean) @ directions > 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def made_pairs(sample: np.ndarray, least: float, count: int = PAIRS, seed: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors of the sample with others at the cosine ``least``: towards differences of the sample, and in any direction."""
    draw = np.random.default_rng(seed)
    own = sample[draw.integers(0, len(sample), count)]
    apart = sample[draw.integers(0, len(sample), count)] - sample[draw.integers(0, len(sample), count)]
    out = []
    for aside in (apart, draw.normal(size=own.shape)):
        aside = aside - (aside * own).sum(1, keepdims=True) * own
        length = np.linalg.norm(aside, axis=1)
        some = length > 1e-9
        out.append((own[some], least * own[some] + np.sqrt(max(0.0, 1 - least * least)) * aside[some] / length[some, None]))
    return out


def chosen_layout(sample: np.ndarray, least: float) -> tuple[tuple[np.ndarray, np.ndarray], int, int]:
    """(model, flips, largest distance of codes that are compared) of the cheapest layout with enough recall."""
    for words, flips in LAYOUTS:
        model = learned_rotation(sample, BITS * words)
        recall, farthest = 1.0, 0
        for a, b in made_pairs(sample, least):
            if len(a):
                differ = (codes_of(a, model) ^ codes_of(b, model)).view(np.uint64)
                parts = [(differ >> np.uint64(first)) & np.uint64((1 << width) - 1) for first, width in TABLES]
                recall = min(recall, (np.bitwise_count(np.stack(parts)).min((0, 2)) <= 2 * flips).mean())
                farthest = max(farthest, int(np.bitwise_count(differ).sum(1).max()))
        if recall >= RECALL:
            break
    return model, flips, farthest + 2


def _coded(models: dict[int, tuple[np.ndarray, np.ndarray]]):
    def run(batches):
        own = dict(models)
        for batch in batches:
            items = np.array(batch.column("item"))
            rows = [np.array(v.values, np.float64) for v in batch.column("vector")]
            sizes = np.array([len(r) for r in rows])
            for dim in np.unique(sizes).tolist():
                if dim not in own:  # a length that the sample missed: an untrained rotation
                    own[dim] = learned_rotation(np.empty((0, dim)), BITS * LAYOUTS[-1][0])
                at = np.flatnonzero(sizes == dim)
                vectors = np.stack([rows[i] for i in at])
                columns = [items[at], np.full(len(at), dim), list(codes_of(vectors, own[dim])), [v.tobytes() for v in vectors]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CODES)], schema=CODES)

    return run


def block_links(left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Whether the cosine reaches ``least``, for rows of ``left`` against rows of ``right``."""
    norms = np.linalg.norm(left, axis=1)[:, None] * np.linalg.norm(right, axis=1)[None, :]
    return (left @ right.T) / norms >= least


def _compared(least: float):
    """Over pairs of blocks: (item, number of linked vectors, smallest item connected within the two blocks)."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                same = row["block_a"] == row["block_b"] and row["code_a"] == row["code_b"]
                ids = [np.array([m["item"] for m in row[s]], np.int64) for s in ("members_a", "members_b")]
                weights = [np.array([m["weight"] for m in row[s]], np.int64) for s in ("members_a", "members_b")]
                vectors = [np.stack([np.frombuffer(m["vector"], np.float64) for m in row[s]]) for s in ("members_a", "members_b")]
                links = block_links(vectors[0], vectors[1], least)
                if same:
                    np.fill_diagonal(links, False)
                if not links.any():
                    continue
                labels = [ids[0].copy(), ids[0].copy() if same else ids[1].copy()]
                biggest = np.iinfo(np.int64).max
                while True:
                    first = np.minimum(labels[0], np.where(links, labels[1][None, :], biggest).min(1))
                    second = first if same else np.minimum(labels[1], np.where(links, first[:, None], biggest).min(0))
                    if (first == labels[0]).all() and (second == labels[1]).all():
                        break
                    labels = [first, second]
                counts = [(links * weights[1][None, :]).sum(1), (links * weights[0][:, None]).sum(0)]
                for side in (0,) if same else (0, 1):
                    at = np.flatnonzero(counts[side])
                    columns = [ids[side][at], counts[side][at], labels[side][at]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)

    return run


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def flip_masks(width: int, flips: int) -> list[int]:
    return [sum(1 << i for i in some) for n in range(flips + 1) for some in itertools.combinations(range(width), n)]


def code_pairs(classes: DataFrame, flips: int = 1, farthest: int | None = None) -> DataFrame:
    """dim, code_a, code_b: codes that meet in a table; code_a is the smaller one."""
    words = classes.select("dim", "code", F.posexplode("code").alias("word", "bits"))
    tables = None
    for first, width in TABLES:
        chunk = F.expr(f"shiftrightunsigned(bits, {first}) & {(1 << width) - 1}L")
        masks = F.array(*[F.lit(m).cast("long") for m in flip_masks(width, flips)])
        rows = words.select("dim", "code", (F.col("word") * BITS + first).alias("part"), chunk.alias("chunk"), F.explode(masks).alias("flip"))
        tables = rows if tables is None else tables.union(rows)
    tables = tables.select("dim", "part", F.expr("chunk ^ flip").alias("key"), "code", "flip")
    a = tables.withColumnsRenamed({"code": "code_a", "flip": "flip_a"})
    b = tables.withColumnsRenamed({"code": "code_b", "flip": "flip_b"})
    # Each pair under one key of a table: the smaller code flips the lower half of the differing bits, the other one the rest.
    once = F.expr(
        "code_a < code_b AND flip_a & flip_b = 0 AND bit_count(flip_a) - bit_count(flip_b) BETWEEN 0 AND 1"
        " AND (flip_b = 0 OR flip_a < (flip_b & -flip_b))"
    )
    met = a.join(b, ["dim", "part", "key"]).where(once)
    if farthest is not None:
        apart = F.aggregate(F.zip_with("code_a", "code_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
        met = met.where(apart <= farthest)
    return met.select("dim", "code_a", "code_b").distinct()


def near_vectors(table: DataFrame, least: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    spark = table.sparkSession
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    usable_rows = rows.where(usable(F.col("vector")))
    largest = F.aggregate("vector", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x)))
    scaled = usable_rows.withColumn("largest", largest).withColumn("vector", F.transform("vector", lambda x: x / F.col("largest"))).drop("largest")
    items = scaled.groupBy("vector").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least_id"))
    items = written(items.withColumn("item", F.monotonically_increasing_id()), "vectors")

    chosen = items.orderBy(F.xxhash64("vector"), "item").limit(SAMPLE).select("vector")
    sample: dict[int, list] = {}
    for row in chosen.toLocalIterator():  # SAMPLE rows at most
        vector = np.array(row["vector"])
        sample.setdefault(len(vector), []).append(vector / np.linalg.norm(vector))
    layouts = {dim: chosen_layout(np.array(vectors), least) for dim, vectors in sample.items()}

    models = {dim: model for dim, (model, _, _) in layouts.items()}
    coded = items.select("item", "vector").mapInArrow(task(_coded(models)), "item long, dim int, code array<long>, vector binary")
    coded = written(coded.join(items.select("item", "weight"), "item"), "codes")
    sizes = coded.groupBy("dim", "code").agg(F.count("*").alias("n"))
    parts = coded.join(sizes, ["dim", "code"]).withColumn("block", F.pmod(F.xxhash64("item"), F.ceil(F.col("n") / BLOCK)))
    member = F.struct("item", "weight", "vector")
    blocks = written(parts.groupBy("dim", "code", "block").agg(F.collect_list(member).alias("members")), "blocks")

    own = sizes.select("dim", F.col("code").alias("code_a"), F.col("code").alias("code_b"))
    # Lengths that the sample missed take the most flips, and any distance.
    kinds: dict[tuple[int, int | None], list[int]] = {}
    for dim, (_, flips, farthest) in layouts.items():
        kinds.setdefault((flips, farthest), []).append(dim)
    pairs = own
    for (flips, farthest), dims in kinds.items():
        pairs = pairs.union(code_pairs(sizes.where(F.col("dim").isin(dims)).select("dim", "code"), flips, farthest))
    pairs = pairs.union(code_pairs(sizes.where(~F.col("dim").isin(list(layouts))).select("dim", "code"), LAYOUTS[-1][1]))
    a = blocks.select("dim", F.col("code").alias("code_a"), F.col("block").alias("block_a"), F.col("members").alias("members_a"))
    b = blocks.select("dim", F.col("code").alias("code_b"), F.col("block").alias("block_b"), F.col("members").alias("members_b"))
    compared = pairs.join(a, ["dim", "code_a"]).join(b, ["dim", "code_b"]).where("code_a <> code_b OR block_a <= block_b")
    alone = F.expr("code_a = code_b AND block_a = block_b AND size(members_a) = 1")
    compared = compared.where(~alone).select("code_a", "block_a", "members_a", "code_b", "block_b", "members_b")
    found = written(compared.mapInArrow(task(_compared(least)), "item long, links long, other long"), "links")

    counts = found.groupBy("item").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("item").alias("a"), F.col("other").alias("b")))
    known = items.select("item", "vector", "weight", "least_id").join(counts, "item", "left").join(groups, items["item"] == groups["node"], "left")
    known = known.select("vector", "weight", "least_id", "links", F.coalesce("component", "item").alias("component"))
    least_ids = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    answers = known.join(least_ids, "component").select("vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    linked = scaled.join(answers, "vector").select("vec_id", "n_links", "component_id")
    rest = rows.where(~F.coalesce(usable(F.col("vector")), F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
