"""Files of id planes: exact round trips, against the tokenizer itself, odd rows."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adfeed.llm import queries
from adfeed.llm.common import ready, shared_path
from adfeed.llm.idfiles import IdFile, IdWriter, ids_of, planes_of, read_ids, write_ids

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=70), st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(values, kind):
    ids = np.array(values, np.uint32)
    planes = planes_of(ids, kind)
    width = max(1, max(values).bit_length())
    assert len(planes) == (width if kind == "bit" else -(-width // 8))
    assert ids_of([p.tobytes() for p in planes], len(ids), kind).tolist() == values


def test_bit_planes_hold_one_bit_each():
    first, second = planes_of(np.array([1, 2, 3, 0], np.uint32), "bit")
    assert first.tolist() == [0b0101] and second.tolist() == [0b0110]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.integers(0, 40)), max_size=30), st.sampled_from(["bit", "byte"]))
def test_a_file_gives_back_documents_and_any_stretch(docs, kind):
    draw, sink = np.random.default_rng(1), io.BytesIO()
    writer, whole = IdWriter(sink, kind, chunk=16), []
    for name, n in docs:
        whole.append(draw.integers(0, 70_000, n).astype(np.uint32))
        writer.add(name, whole[-1])
    writer.close()
    file = IdFile(pa.BufferReader(sink.getvalue()))
    found = [(name, n, [i for p in pieces for i in p.tolist()]) for name, n, pieces in file.parts()]
    assert found == [(name, n, ids.tolist()) for (name, n), ids in zip(docs, whole)]
    assert all(n == 16 for _, n, _ in file.chunks[:-1])
    joined = np.concatenate([*whole, np.empty(0, np.uint32)])
    for start in range(0, len(joined), 7):
        assert file.stretch(start, 20).tolist() == joined[start : start + 20].tolist() if start + 20 <= len(joined) else True


def test_cut_off_file_is_refused():
    sink = io.BytesIO()
    writer = IdWriter(sink, "byte")
    writer.add(1, np.arange(9, dtype=np.uint32))
    writer.close()
    for data in (b"", sink.getvalue()[:-3]):
        with pytest.raises(ValueError):
            IdFile(pa.BufferReader(data))


def expected(rows):
    """Brute force: doc_id, start, n_tokens, crc32 in ascending doc_id order."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("kind,file_bytes", [("byte", 300), ("bit", 1 << 20)])
def test_documents_come_back_from_the_files(spark, kind, file_bytes):
    ready(spark)
    draw = random.Random(5)
    words = ["the", "éthique", "12", "日本", "<|endoftext|>", "x" * 30, "it's", "\n\n", " "]
    rows = [(i, " ".join(draw.choices(words, k=draw.choice([0, 1, 5, 40])))) for i in draw.sample(range(-50, 900), 90)] + [(5000, "long " * 30_000), (None, None)]
    docs = spark.createDataFrame([(t, i, 7) for i, t in rows], "text string, doc_id long, start int").repartition(5)
    path = shared_path(spark, "ids")
    files = write_ids(docs, path, kind=kind, file_bytes=file_bytes).collect()
    assert sum(f["n_docs"] for f in files) == len(rows) and (len(files) > 5) == (file_bytes == 300)
    out = read_ids(spark, path, with_ids=True).collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in sorted(out, key=lambda r: r["start"])] == expected(rows)
    assert all(r["ids"][-1] == 0 and len(r["ids"]) == r["n_tokens"] for r in out)


def test_repeated_rows_and_empty_tables(spark):
    ready(spark)
    rows = [(3, "same text")] * 40 + [(3, "other")] * 2 + [(1, ""), (2, None), (None, "a b")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = shared_path(spark, "ids")
    files = write_ids(docs, path, file_bytes=60)
    assert files.where("n_docs > 40").count() == 0  # the copies of one row lie in several files
    out = sorted(read_ids(spark, path).collect(), key=lambda r: r["start"])
    want = expected(rows)
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in out) == sorted((d or 0, n, c) for d, _, n, c in want)
    assert [r["doc_id"] for r in out] == [w[0] for w in want]
    assert [r["start"] for r in out] == np.cumsum([0, *[r["n_tokens"] for r in out]])[:-1].tolist()
    empty = shared_path(spark, "ids")
    assert write_ids(docs.limit(0), empty).count() == 0 and read_ids(spark, empty).count() == 0


def test_query_meets_its_contract(spark):
    out = queries.QUERIES["op11_id_planes"](spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = sorted((tuple(r) for r in out.collect()), key=lambda r: r[1])
    assert found == expected([tuple(r) for r in docs])
