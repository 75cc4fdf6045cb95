import zlib

import pytest

from tessera.llm import sharding as S


def check(rows, shards, slack):
    sizes, slots = {}, {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(sizes) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if len(rows) >= 20 * shards:
        mean = sum(sizes.values()) / shards
        assert all(abs(sizes.get(k, 0) - mean) <= slack * mean + max(r["size"] for r in rows) for k in range(shards))


@pytest.mark.parametrize("shards", [1, 3, 7, 24])
def test_sizes_are_near_equal_with_hot_values(spark, shards):
    rows = [(k, "abc" * (k % 17), "en", "hot" if k % 3 else f"s{k % 40}") for k in range(3000)]
    rows += [(5000, "same", "en", "hot")] * 1000  # a third of them equal in every column
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = S.shard_report(docs, shards).collect()
    assert len(got) == 4000
    check(got, shards, 0.02)


def test_columns_follow_the_definition(spark, messy):
    got = S.shard_report(messy).collect()
    texts = {r["doc_id"]: r["text"] for r in messy.collect()}
    assert len(got) == messy.count()
    check(got, 24, 1)
    for r in got:
        if r["doc_id"] is not None:
            data = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "bytes", None)


def test_empty_and_tiny_tables(spark, no_docs):
    assert S.shard_report(no_docs).count() == 0
    one = spark.createDataFrame([(1, "x")], "doc_id long, text string")  # dimensions may be missing
    assert [(r["slot"], r["size"]) for r in S.shard_report(one).collect()] == [(0, 9)]


def test_slots_are_piecewise(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE_ROWS", 10)
    docs = spark.createDataFrame([(k, "t" * (k % 5)) for k in range(500)], "doc_id long, text string")
    check(S.shard_report(docs, 4).collect(), 4, 0.05)


def test_written_shards_hold_every_row(spark, messy, tmp_base):
    S.write_shards(messy, tmp_base, 3)
    back = spark.read.parquet(tmp_base)
    assert back.count() == messy.count() and set(messy.columns) <= set(back.columns)
