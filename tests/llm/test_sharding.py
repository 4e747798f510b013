import zlib
from collections import defaultdict

from statlab.llm.histogram_sort import histogram_sort, sharding, write_shards


def check_law(rows, shards=8, tolerance=0.02):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return {s: sum(r["size"] for r in own) for s, own in by.items()}


def test_digest_of_odd_documents(odd, odd_rows):
    rows = sharding(odd).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(x[0]), len((x[1] or "").encode()) + 1, zlib.crc32((x[1] or "").encode())) for x in odd_rows)
    check_law(rows)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_bytes_are_near_equal_with_a_hot_text(spark):
    rows = [(i, "hot text " * 3) for i in range(900)] + [(i, f"text {i} " * (i % 40 + 1)) for i in range(900, 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = histogram_sort(docs).collect()
    sizes = check_law(found)
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - mean) < 0.02 * mean for s in sizes.values())
    again = histogram_sort(docs.repartition(7)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_equal_texts_share_a_shard(spark):
    rows = [(i, f"text {i // 4} " * 9) for i in range(8000)]
    found = histogram_sort(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    shards = defaultdict(set)
    for r in found:
        shards[r["text"]].add(r["shard"])
    assert max(map(len, shards.values())) == 1


def test_empty_table_and_files(spark, odd, none, tmp_path):
    assert sharding(none).collect() == []
    write_shards(histogram_sort(odd), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == odd.count()


def test_bytes_are_near_equal_where_rows_repeat(spark):
    for key in (7, None):
        rows = [(key, "one row, again and again")] * 800 + [(i, f"text {i} of its own, no. {i}") for i in range(1200)]
        found = histogram_sort(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
        sizes = check_law(found)
        mean = sum(sizes.values()) / 8
        assert len(found) == 2000 and len(sizes) == 8 and all(abs(s - mean) < 0.02 * mean for s in sizes.values())
