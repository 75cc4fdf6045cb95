import base64
import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from tessera.llm import warc as W

BIG = 2 ** 53 + 1
PAGES = [(1, "http://a/", "aé"), (None, "u\n2", "aé"), (BIG, None, "aé"), (5, "x", None), (6, "x", ""), (7, "x", "y" * 300_000),
         (7, "x", "y" * 300_000), (8, "z", "q\r\n\r\nWARC/1.1\r\n\r\n"), (9, "z", "only")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "'f' AS frame", "0 AS record_type")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark, pages, tmp_base):
    index = W.write_archive(pages, tmp_base)
    rows = W.read_records(index, tmp_base).collect()
    html = {p: h for p, _, h in PAGES}
    assert len(rows) == len(PAGES)
    for r in rows:
        want = html[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len((want or "").encode()), digest(want))
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        assert r["payload"] is None or bytes(r["payload"]) == (want or "").encode()
    refers = sorted(((r["page_id"], r["refers_to"]) for r in rows if r["record_type"] == "revisit"), key=str)
    assert refers == sorted([(1, BIG), (None, BIG), (5, 6)], key=str)
    assert [bytes(r["payload"]) for r in W.fetch(spark, tmp_base, [8]).collect()] == [PAGES[7][2].encode()]


def test_bundles_are_seekable(spark, pages, tmp_base, monkeypatch):
    monkeypatch.setattr(W, "FRAME_BYTES", 200)
    W.write_archive(pages.coalesce(1), tmp_base)  # workers import the module anew; the table is what counts
    names = [r[0] for r in spark.read.parquet(f"{tmp_base}/index").select("bundle").distinct().collect()]
    for name in names:
        path = f"{tmp_base}/{name}"
        with open(path, "rb") as f:
            data = f.read()
            table = W.seek_table(f, len(data))
        plain = b"".join(zstandard.ZstdDecompressor().decompress(data[s:s + p]) for s, p, _ in table)
        assert len(plain) == sum(n for _, _, n in table)
        # The whole file is one valid Zstandard stream, as the seek table is a skippable frame.
        stream = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert stream == plain and plain.startswith(b"WARC/1.1\r\n")


def test_small_payloads_may_stay_responses(pages):
    kinds = {(r["page_id"], r["record_type"]) for r in W.decide(pages.select("page_id", "url", "html"), least=3).collect()}
    assert (5, "response") in kinds and (1, "revisit") in kinds


def test_damage_is_noticed(spark, tmp_base):
    record = W.record_bytes(1, "u", b"payload", digest("other"), "response", None, 7)
    assert W.parse_record(record)["payload"] == b"payload"
    writer = W.BundleWriter(W.folder_store(spark, tmp_base))
    writer.add(1, record)
    index = spark.createDataFrame(writer.close(), W.INDEX)
    with pytest.raises(Exception, match="damaged record"):
        W.read_records(index, tmp_base).collect()


def test_empty_table(spark, pages):
    assert W.archive_report(pages.limit(0)).count() == 0


def test_report_equals_its_sql(spark, pages):
    import duckdb
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url", "html").filter(F.col("page_id").isNotNull()).toPandas())
    got = W.archive_report(pages.filter("page_id IS NOT NULL"))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({W.ORACLE})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())


def test_unique_payloads_are_not_shuffled_and_hot_ones_are_split(spark, tmp_base):
    spark.range(4000).selectExpr("id AS page_id", "'u' AS url", "CASE WHEN id % 3 = 0 THEN 'x' || id ELSE repeat('same ', 20) END AS html").repartition(8).write.parquet(f"{tmp_base}/p")
    decided = W.decide(spark.read.parquet(f"{tmp_base}/p"))
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    from tessera.session import scoped_conf
    with scoped_conf(spark, small):
        assert decided.filter("record_type = 'revisit'").count() == 2666 - 1
        decided = W.decide(spark.read.parquet(f"{tmp_base}/p"))
        decided.collect()
        plan = decided._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    # One branch of the union reaches the end without an exchange.
    alone = plan.split("Union")[1].split("SortMergeJoin")[0]
    assert "Exchange hashpartitioning" not in alone


def test_frames_are_dealt_out_to_tasks(spark, tmp_base, monkeypatch):
    pages = spark.range(60).selectExpr("id AS page_id", "'u' AS url", "repeat(md5(CAST(id AS string)), 20) || id AS html").repartition(6)
    index = W.write_archive(pages, tmp_base)
    monkeypatch.setattr(W, "READ_BYTES", 500)
    assert W.read_records(index, tmp_base).rdd.getNumPartitions() > 3
    assert W.read_records(index, tmp_base).count() == 60


def test_paths_that_only_spark_knows(spark, pages, tmp_base):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.warc.link./in", f"file://{tmp_base.removeprefix('file:')}")
    import os
    os.makedirs(f"{tmp_base.removeprefix('file:')}/a")
    assert W.archive_report(pages, "viewfs://warc/in/a").count() == len(PAGES)
