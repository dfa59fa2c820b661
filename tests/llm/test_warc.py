from shelfline.llm import registry, warc

SCHEMA = "page_id long, url string, html string, sha string, n int"


def test_segments_marks_repeats_and_nulls_come_back(spark, tmp_path):
    long = "WARC/1.1\r\nWARC-Type: response\r\n\r\né" * 300
    pages = [(1, "http://a b\r\nX: y", long), (2, None, long), (3, "u", None), (4, "u", ""), (5, "u", "x"), (5, "u", "x"), (None, "u", "x"), (None, "u", "y")]
    df = spark.createDataFrame([(*p, "s", 1) for p in pages], SCHEMA)
    path = str(tmp_path / "archive")
    warc.write(df, path, segment=500)

    read = warc.payloads(spark, path).collect()
    assert all(r["complete"] for r in read)
    texts = sorted(bytes(r["payload"]).decode() for r in read if r["type"] == "response")
    assert texts == sorted([long, "", "x", "x", "y"])
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.pages_read(spark, path).collect()), key=str)
    n = len(long.encode())
    assert got == sorted([(1, n, "response", None), (2, n, "revisit", 1), (3, 0, "response", None), (4, 0, "revisit", 3), (5, 1, "response", None),
                          (5, 1, "response", None), (None, 1, "revisit", 5), (None, 1, "response", None)], key=str)


def test_a_missing_segment_is_told(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "word " * 500, "", 0)], SCHEMA)
    path = str(tmp_path / "archive")
    warc.write(df, path, segment=400)
    lines = spark.read.option("lineSep", warc.MARK).text(path).filter("value not like '%Segment-Number: 3%' and value <> ''")
    kept = [r[0] for r in lines.collect()]
    (tmp_path / "cut").write_bytes("".join(warc.MARK + r for r in kept).encode())
    assert [r["complete"] for r in warc.records(spark, str(tmp_path / "cut")).collect()] == [False]


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write(spark.createDataFrame([], SCHEMA), path)
    assert warc.pages_read(spark, path).count() == 0


def test_the_query_writes_continuation_records(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(warc, "shared_folder", lambda _: written.append(str(tmp_path / "archive")) or written[-1])
    pages = spark.createDataFrame([(1, "u", "long " * 20_000, "", 0), (2, "u", "short", "", 0)], "page_id long, url string, html string, sha string, n int")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    found = {r["page_id"]: r for r in registry.op6_warc_segments(spark, str(tmp_path)).collect()}
    assert found[1]["payload_bytes"] == 100_000 and found[1]["complete"]
    kinds = [r[0].split("\r\n")[0] for r in spark.read.option("lineSep", warc.MARK).text(written[0]).filter("value <> ''").collect()]
    assert kinds.count("WARC-Type: continuation") == 6


def test_broken_framing_is_told():
    whole = warc.framed(b"x" * 100, 30)
    assert warc.unframed(whole) == b"x" * 100
    for broken in (whole[:-5], whole[:40], b"zz\r\nabc", b"", whole.replace(b"1e\r\n", b"1f\r\n", 1)):
        assert warc.unframed(broken) is None


def test_a_long_payload(spark, tmp_path):
    html = "".join(f"<p>{i}</p>" for i in range(300_000))
    path = str(tmp_path / "archive")
    warc.write(spark.createDataFrame([(1, "u", html, "", 0)], SCHEMA), path, segment=100_000)
    read = warc.payloads(spark, path).collect()
    assert [bytes(r["payload"]).decode() == html and r["complete"] for r in read] == [True]
