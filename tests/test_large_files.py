"""Array files read block by block give what a plain parse of the whole file gives."""

import json
import random

import pytest

from adfeed.schemas import RAW_POST
from adfeed.sources import posts as sources
from adfeed.sources.posts import load_large_posts, load_raw_posts, split_array_files


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def posts(draw, n):
    pieces = ["}", "{", '"', "\\", "\\\\", '\\"', "]", "[", ",", "é", "日本", "\n", "texte", "} ,{", '"}', " "]
    for i in range(n):
        more = {"x": [{"y": "}" * draw.randint(0, 3)}, [], {}, {"z": {"}": '"'}}]} if i % 3 == 0 else {}
        yield {"id": f"p{draw.randrange(40)}", "texte": "".join(draw.choices(pieces, k=draw.randint(0, 30))), **more}


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "200b", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_blocks_cut_inside_strings_and_escapes(spark, folder, small_blocks):
    draw = random.Random(5)
    for i, (indent, ascii) in enumerate([(None, True), (2, False), (None, False)]):
        write(f"{folder}/{i}.json", json.dumps(list(posts(draw, 40)), indent=indent, ensure_ascii=ascii) + "\n" * i)
    write(f"{folder}/empty.json", " [ ]\n")
    write(f"{folder}/noid.json", '[{"texte": "sans id"}, {"id": "seul", "texte": "}"}]')
    elements, files = split_array_files(spark, f"{folder}/*.json")
    assert spark.read.option("lineSep", "}").text(f"{folder}/0.json").rdd.getNumPartitions() > 5
    assert files.filter("lisible").count() == 5 and elements.count() == 122
    for name in "012":
        want = json.load(open(f"{folder}/{name}.json", encoding="utf-8"))
        found = elements.filter(f"_file LIKE '{name}.json%'").orderBy("_pos").collect()
        assert [json.loads(r["value"]) for r in found] == want and [r["_pos"] for r in found] == list(range(len(want)))
    fields = RAW_POST.fieldNames()
    plain, large = (sorted((tuple(r) for r in f(spark, f"{folder}/*.json").select(*fields, "_pos").collect()), key=str) for f in (load_raw_posts, load_large_posts))
    assert large == plain and len(plain) > 30


def test_unreadable_files_give_nothing(spark, folder, small_blocks):
    good = json.dumps([{"id": "a", "texte": "{}"}])
    bad = [good[:-1], good + "]", "{" + good + "}", good + good, '{"id": "d"}', "", "[1]", '[1, {"id": "b"}]', '[{"id": "c"} {"id": "d"}]', '[{"id": "e"},]', '[{"id": "f"}', '[{"id": ]}]', '["}"]', '[[{"id": "g"}]]']
    for i, text in enumerate([good, *bad]):
        write(f"{folder}/{i:02d}.json", text)
    assert [r["id"] for r in load_large_posts(spark, f"{folder}/*.json").collect()] == ["a"] == [r["id"] for r in load_raw_posts(spark, f"{folder}/*.json").collect()]


def test_raw_posts_do_not_read_large_files_whole(spark, folder, small_blocks):
    draw = random.Random(7)
    for name, n in (("klein", 3), ("gross", 200)):
        write(f"{folder}/{name}.json", json.dumps(list(posts(draw, n))))
    write(f"{folder}/unreadable.json", json.dumps(list(posts(draw, 200)))[:-1])
    whole = load_raw_posts(spark, folder)
    parts = load_raw_posts(spark, folder, whole_bytes=1000)
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect())) and whole.count() > 30
    # The large file comes in many blocks, and the reader of whole files leaves it out.
    assert "file_size" in parts._jdf.queryExecution().optimizedPlan().toString()
    huge = load_raw_posts(spark, f"{folder}/gross.json", whole_bytes=1000)
    assert spark.read.text(f"{folder}/gross.json", wholetext=True).filter("_metadata.file_size <= 1000").rdd.getNumPartitions() == 0
    assert huge.count() == len({p["id"] for p in json.load(open(f"{folder}/gross.json"))})


def test_texts_of_large_files_are_shuffled_once_to_join_their_pieces(spark, folder, small_blocks):
    """The sums that tell where elements end are taken over numbers; pieces and elements are the only stored texts."""
    write(f"{folder}/a.json", json.dumps(list(posts(random.Random(3), 60))))
    stored = []
    before = sources.cut_lineage
    sources.cut_lineage = lambda df: stored.append(df.columns) or before(df)
    try:
        load_large_posts(spark, f"{folder}/a.json").collect()
    finally:
        sources.cut_lineage = before
    texts = [c for c in stored if {"_bout", "_nu", "value", "_posts", "_p"} & set(c)]
    assert len(stored) > 3 and len(texts) == 2
