import hashlib
import random
import zlib

from starglean.llm import histosort

DOCS = "doc_id bigint, text string, shard string, key string, row string, size int"


def number(text):
    return int(hashlib.md5((text or "").encode()).hexdigest()[:15], 16)


def size_of(text):
    return len((text or "").encode()) + histosort.ROW_BYTES


def brute(rows, shards, tolerance):
    """Shard and slot by one sort and exact fractions."""
    order = sorted(rows, key=lambda r: (number(r[1]), r[0] is not None, r[0] or 0))
    total = sum(size_of(t) for _, t in order)
    held = {}
    for _, t in order:
        held[number(t)] = held.get(number(t), 0) + size_of(t)
    out, before, start, last, slots = [], 0, 0, None, {}
    for doc, text in order:
        if number(text) != last:
            last, start = number(text), before
        whole = held[last]
        middle = 2 * start + whole if whole * shards <= tolerance * total else 2 * before + size_of(text)
        shard = middle * shards // (2 * total)
        slot = slots[shard] = slots.get(shard, -1) + 1
        out.append((doc, size_of(text), zlib.crc32((text or "").encode()), "bytes", shard, slot, None))
        before += size_of(text)
    return out


def check(spark, rows, shards=7, tolerance=0.05, parts=5):
    docs = spark.createDataFrame([(d, t, "x", "y", "z", 1) for d, t in rows], DOCS).repartition(parts)
    got = [tuple(r) for r in histosort.shard_digest(docs, shards, tolerance).collect()]
    order = lambda r: (r[4], r[5])
    # Repeated rows may swap places among each other.
    assert sorted(got, key=order) == sorted(brute(rows, shards, tolerance), key=order)
    return got


def test_random_texts_and_hot_group(spark):
    draw = random.Random(11)
    rows = [(i, "w" * draw.randint(0, 60) + str(draw.randint(0, 150))) for i in range(300)]
    rows += [(i, "the same text in a third of all rows") for i in range(1000, 1150)]
    rows += [(5000, "é" * 4000)]
    draw.shuffle(rows)
    got = check(spark, rows)
    assert len({r[4] for r in got}) == 7


def test_odd_rows(spark):
    rows = [(None, None), (None, None), (None, ""), (3, None), (3, ""), (-5, "a"), (2**62, "a"), (-(2**62), "a"), (-5, "a"), (7, "ß" * 30000)] + [(1, "again")] * 40
    check(spark, rows)
    check(spark, rows, shards=100)
    check(spark, rows, tolerance=0.0)
    check(spark, [(1, "only")])
    check(spark, [(1, "same")] * 30, shards=3)


def test_whole_groups_within_tolerance(spark):
    rows = [(i, f"text {i % 200}") for i in range(1000)]
    got = check(spark, rows, shards=4, tolerance=0.5)
    place = {r[0]: r[4] for r in got}
    assert all(len({place[i] for i in range(t, 1000, 200)}) == 1 for t in range(200))


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([], DOCS)
    assert histosort.shard_digest(docs).collect() == []
    docs = spark.createDataFrame([(i, f"t{i}", "x", "y", "z", 9) for i in range(20)], DOCS)
    got = histosort.shard_documents(docs, shards=4)
    assert sorted(got.columns) == sorted(docs.columns + ["slot"])
    assert {(r.key, r.row, r["size"]) for r in got.collect()} == {("y", "z", 9)}


def test_tasks_do_not_change_the_result(spark):
    docs = spark.createDataFrame([(i, "w" * (i % 37)) for i in range(500)], "doc_id bigint, text string")
    some = [sorted(map(tuple, histosort.shard_documents(docs, 5, pieces=p).collect())) for p in (1, 2, 9)]
    assert some[0] == some[1] == some[2]


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "w" * (i % 37)) for i in range(300)], "doc_id bigint, text string")
    histosort.write_shards(docs, f"{tmp_path}/shards", shards=6)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(back.select("doc_id", "text", "shard", "slot").collect()) == sorted(
        histosort.shard_documents(docs, 6).select("doc_id", "text", "shard", "slot").collect())


def test_only_dataframe_operations(spark, sf):
    from starglean.llm.queries import QUERIES

    plan = QUERIES["op11_histogram_sort"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan
    assert plan.count("Exchange shuffle") == 1
