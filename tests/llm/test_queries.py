"""The registered queries against SQL, archives, shared helpers and the pipeline."""

from __future__ import annotations

import base64
import hashlib

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from weftgraph.llm import exact, minhash, mixing, warc
from weftgraph.llm.queries import ORACLE, QUERIES
from weftgraph.llm.runs import name_runs, running_total
from weftgraph.llm.store import new_folder


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, small, con, name):
    assert compare(QUERIES[name](spark, small), con, ORACLE[name]) == ""


def test_thirteen_operators_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pages(spark):
    rows = [
        (5, "http://a", "<p>é</p>"), (3, "http://b", "<p>é</p>"), (9, "http://c", "<p>é</p>"), (1, None, None), (2, "u", ""),
        (7, "http://x y", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (7, "http://x", "other"), (8, "z", "x" * 300_000),
        (10, "z", "twice"), (10, "z", "twice"), (11, "", "a" * 10),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).repartition(3), rows


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archives_round_trip(spark, compression):
    df, rows = pages(spark)
    folder = new_folder(spark, "test-warc")
    warc.write_pages(df, folder, compression)
    got = warc.read_archives(spark, folder)
    assert got.filter("record_type = 'warcinfo'").count() >= 1
    found = got.filter(F.col("record_type").isin("response", "revisit")).collect()
    first = {}
    for i, _, h in rows:
        first[h or ""] = min(i, first.get(h or "", i))
    want = sorted((i, len((h or "").encode()), sha1((h or "").encode())) for i, _, h in rows)
    page = lambda x: int(x.split(":")[2].rstrip(">").split(".")[0])
    assert sorted((page(r.record_id), r.payload_bytes, r.payload_digest[5:]) for r in found) == want
    for r in found:
        if r.record_type == "response":
            assert sha1(r.payload) == r.payload_digest[5:]
        else:
            assert r.payload is None and page(r.refers_to) == next(first[h or ""] for i, _, h in rows if i == page(r.record_id))
    assert sum(r.record_type == "response" for r in found) == len(first)
    assert len({r.record_id for r in found}) == len(rows)


def test_archive_predicates_are_pushed(spark):
    df, _ = pages(spark)
    folder = new_folder(spark, "test-warc")
    warc.write_pages(df, folder)
    got = warc.read_archives(spark, folder)
    hit = got.filter("record_type = 'response' AND target_uri LIKE 'http%' AND payload_bytes > 3")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith" not in plan.split("BatchScan")[0] and "payload_bytes" in plan.split("BatchScan")[0]
    assert sorted(r.target_uri for r in hit.collect()) == ["http://b", "http://x", "http://x%20y"]
    reader = warc.WarcReader(folder, False)
    reader.tests = [("in", "record_type", {"revisit"})]
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == 4 and all(r["payload"] is None for r in rows)  # 5, 9, the empty 2, the second 10
    without = warc.read_archives(spark, folder, payload=False).filter("record_type = 'response'")
    assert without.filter("payload IS NOT NULL OR payload_bytes IS NULL").count() == 0


def test_archives_of_small_payloads_and_of_nothing(spark):
    df, rows = pages(spark)
    small = warc.page_records(df, least_bytes=6)
    assert small.filter("record_type = 'revisit' AND payload_bytes < 6").count() == 0
    assert warc.page_records(df.limit(0)).count() == 0


def test_damaged_archive_is_an_error(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\n\r\nhi"
    good = warc.warc_record(
        [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1>"), ("WARC-Payload-Digest", "sha1:" + sha1(b"ho")),
         ("Content-Type", "application/http; msgtype=response")], body,
    )
    (tmp_path / "x.warc").write_bytes(good)
    reader = warc.WarcReader(str(tmp_path), True)
    with pytest.raises(ValueError, match="digest"):
        list(reader.read(reader.partitions()[0]))
    (tmp_path / "x.warc").write_bytes(good[:-20])
    with pytest.raises(ValueError):
        list(reader.read(reader.partitions()[0]))


def test_names_and_totals_across_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, 7 if i % 3 else i, i % 2, 1 + i % 5) for i in range(3000)]
        df = spark.createDataFrame(rows, "row long, key long, grp long, n long").repartition(5)
        got = name_runs(df, ["key"], ["row"], ["row", "key"], lead="row").collect()
        assert len(got) == 3000 and len({r.name for r in got}) == len({r[1] for r in rows}) == len({(r.name, r.key) for r in got})
        first, times = {}, {}
        for i, k, *_ in rows:
            first[k], times[k] = min(i, first.get(k, i)), times.get(k, 0) + 1
        assert all(r.lead == first[r.key] and r.repeated == (times[r.key] > 1) for r in got)
        few = name_runs(df, ["key"], ["row"], ["row", "key"], lead="row", hash_col="key", only_repeated=True).filter("repeated")
        assert few.count() == sum(t for t in times.values() if t > 1)
        total = {r.row: r for r in running_total(df, "grp", ["row"], ["n"]).collect()}
        sums = [0, 0]
        for i, _, g, n in rows:
            assert total[i].before_n == sums[g]
            sums[g] += n
            assert total[i].upto_n == sums[g]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_pipeline_against_brute_force(spark, small):
    import corpus_pipeline

    from test_text_operators import brute_near, brute_rules

    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    from weftgraph.llm import compression

    verdict = {r.doc_id: r.in_band for r in compression.quality(docs).collect()}
    left = []
    for i, r in rows.items():
        s = brute_rules(r.text)
        if s[0] >= 50 and 100 * s[4] <= 50 * s[0] and verdict[i]:
            left.append(i)
    last = {rows[i].text: max(j for j in left if rows[j].text == rows[i].text) for i in left}
    left = sorted(last.values())
    left = sorted(i for i, _, c in brute_near([(i, rows[i].text) for i in left]) if i == c)
    mixed = {r.doc_id: r.copies for r in mixing.fair_mix(docs.filter(F.col("doc_id").isin(left))).collect()}
    got = corpus_pipeline.run(spark, small).collect()
    want = sorted(i for i, n in mixed.items() for _ in range(n))
    assert sorted(r.doc_id for r in got) == want
    assert all(r.text == rows[r.doc_id].text and r.source == rows[r.doc_id].source for r in got)
    from tokenizers import Tokenizer

    from weftgraph.llm.queries import tokenizer_file

    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    import struct

    for r in got:
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert r.ids == struct.pack(f"<{len(ids)}I", *ids)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "tokens"]
    assert exact.drop_exact_copies(docs).columns == minhash.drop_near_copies(docs).columns == docs.columns


def test_pipeline_stages_on_awkward_rows(spark, docs, none):
    """Null, empty and very long texts, repeated rows, clashing names and no rows at all, through every stage."""
    import corpus_pipeline

    from weftgraph.llm.store import store

    clash = docs.withColumns({c: F.lit(1) for c in ("ids", "row_number_", "copies_", "again_", "file_path_", "in_group", "text_sha256")})
    for table in (clash, clash.limit(0)):
        now = store(table, "test-stage")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, "")
            if name == "tokens":
                assert out.columns == [*clash.columns, "ids_"]
            else:
                assert out.columns == clash.columns
            now = store(out, "test-stage")
        left = [r.doc_id for r in now.collect()]
        assert (left == []) if table is not clash else set(left) <= {1, 2, 7, 8, 9, 13, 14, None} and left
