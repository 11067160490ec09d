import base64
import gzip
import hashlib

import pytest
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from rinkstat.llm import queries, warc
from rinkstat.session import scratch_dir

SCHEMA = "page_id long, url string, html string"


def brute(rows, least_bytes=0):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == data]
        last = max((k for k in same if k is not None), default=None)
        revisit = len(same) > 1 and len(data) >= least_bytes and key != last
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), digest, "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def pages():
    rows = [(i, f"http://h/{i}\r\nx", "<p>é" * (i % 7) + "\r\n\r\n") for i in range(40)]
    rows += [(100, None, None), (101, "", ""), (102, "u", "big " * 700_000), (103, "u", "big " * 700_000), (None, "n", "<p>é\r\n\r\n")]
    return rows


def round_trip(spark, rows, least_bytes=0, chunk_bytes=1 << 20, with_data=True):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("refers_to", F.lit("clash"))
    folder = scratch_dir(spark, "warc-test")
    manifest = warc.write_archives(warc.with_revisits(df, least_bytes=least_bytes), folder)
    return manifest, warc.read_chunks(manifest, folder, chunk_bytes, with_data)


def summary(chunks):
    out = []
    for r in warc.records_of(chunks).collect():
        here = r.record_type == "response"
        key = None if r.record_id is None else int(r.record_id)
        refers = None if r.refers_to is None else int(r.refers_to)
        assert not here or (r.stored_bytes, r.stored_digest) == (r.declared_bytes, r.declared_digest)
        out.append((key, r.declared_bytes, r.declared_digest, r.record_type, refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("least_bytes", [0, 10])
def test_round_trip_equals_brute_force(spark, least_bytes):
    _, chunks = round_trip(spark, pages(), least_bytes)
    assert summary(chunks) == brute(pages(), least_bytes)


def test_chunks_hold_the_payload(spark):
    rows = pages()
    _, chunks = round_trip(spark, rows, chunk_bytes=1000)
    texts, seen = {r[0]: (r[2] or "").encode() for r in rows}, {}
    for r in chunks.filter("record_type = 'response'").orderBy("record", "chunk_no").collect():
        assert len(r.data) <= 1000
        data = seen[r.record_id] = seen.get(r.record_id, b"") + r.data
        assert (r.bytes_so_far, r.digest_so_far) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert r.is_last == (data == texts[int(r.record_id)])


def test_archives_are_warc_files(spark):
    manifest, _ = round_trip(spark, pages())
    for r in manifest.collect():
        with pafs.LocalFileSystem().open_input_file(r.path) as f:
            f.seek(r.begin)
            plain = gzip.decompress(f.read(r.end - r.begin))
        assert plain.startswith(b"WARC/1.1\r\nWARC-Type: ") and plain.endswith(b"\r\n\r\n")
        assert plain.count(b"WARC/1.1\r\n") == r.n_records


def test_small_files_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    manifest, chunks = round_trip(spark, pages())
    assert manifest.select("path").distinct().count() > 4
    assert summary(chunks) == brute(pages())


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (0, "v", "a")]
    _, chunks = round_trip(spark, rows)
    assert [r[3:] for r in summary(chunks)] == [("revisit", 1), ("response", None), ("response", None)]
    _, chunks = round_trip(spark, [])
    assert chunks.count() == 0


def test_query_checks_the_data_of_every_chunk(spark, tmp_path, monkeypatch):
    pages_of = spark.createDataFrame([(i, f"u{i}", "big " * 700_000 + str(i)) for i in range(3)], SCHEMA)
    pages_of.write.parquet(f"{tmp_path}/pages.parquet")
    query, read = queries.QUERIES["op3_chunked_warc"], warc.read_chunks
    assert {r.payload_bytes for r in query(spark, str(tmp_path)).collect()} == {2_800_001}
    short = F.when((F.col("chunk_no") == 1) & (F.col("record_id") == "2"), F.expr("substring(data, 2)")).otherwise(F.col("data"))
    monkeypatch.setattr(warc, "read_chunks", lambda *args, **named: read(*args, **named).withColumn("data", short))
    with pytest.raises(Exception, match="payload bytes missing in .* chunk 1"):
        query(spark, str(tmp_path)).collect()


def test_archives_are_read_in_several_tasks(spark, tmp_path, monkeypatch):
    """AQE doesn't merge the blocks of a small manifest into one task."""
    monkeypatch.setattr(warc, "BLOCK_BYTES", 1)
    pages = spark.createDataFrame([(i, "u", f"page {i}") for i in range(40)], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.with_revisits(pages), str(tmp_path / "warc"))
    chunks = warc.read_chunks(manifest, str(tmp_path / "warc"))
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert chunks.select(F.spark_partition_id().alias("p")).distinct().count() > 1
