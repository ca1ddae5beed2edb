"""Files, download, publication, pipeline and streams."""

import contextlib
import io
import json
from argparse import Namespace
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.operators import profile
from leasemill.plans import pipeline
from leasemill.schema import CONTRACTS
from leasemill.sources import contracts as C
from leasemill.sources import fetch, publish
from leasemill.streaming import ingest

HEADER = ",".join(CONTRACTS.names)


def line(**kw):
    return ",".join(str(kw.get(c, "")) for c in CONTRACTS.names)


CSV = "\n".join(
    [
        HEADER,
        line(contract_id="C1", contract_start_date="01-03-2024", annual_amount="50000", actual_area="100.5", property_usage_en="Residential", line_number="1"),
        line(contract_id="C2", contract_start_date="2024-03-01", annual_amount="abc", actual_area="NULL", property_usage_en="null", line_number="1.5"),
        line(contract_id="C3", contract_start_date="29-02-2023", annual_amount="NaN", property_usage_en='"Commercial, ""x"""'),
    ]
)


def test_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(CSV.encode() + b"\nbad\xff" + b"," * (len(CONTRACTS) - 1))
    rows = C.read_csv(spark, str(tmp_path / "x.csv")).collect()
    a, b, c, d = rows
    assert (a.contract_start_date, a.annual_amount, a.actual_area, a.line_number) == (date(2024, 3, 1), 50000, 100.5, 1)
    assert (b.contract_start_date, b.annual_amount, b.actual_area, b.property_usage_en, b.line_number) == (None, None, None, None, None)
    assert c.contract_start_date is None and c.annual_amount is None and c.property_usage_en == 'Commercial, "x"'
    assert d.contract_id == "bad�"


@pytest.mark.parametrize("value", ["a\nb", "a\r\nb", "a\rb", 'a\n\n"b",\n', "\n"])
def test_line_breaks_in_values_come_back(spark, tmp_path, value):
    rows = [tuple({"contract_id": f"C{i}", "area_name_en": value, CONTRACTS.names[-1]: value if isinstance(CONTRACTS[-1].dataType, T.StringType) else None}.get(c) for c in CONTRACTS.names) for i in range(3)]
    df = spark.createDataFrame(rows, CONTRACTS)
    C.write_csv(df, str(tmp_path / "x"))
    assert sorted(C.read_csv(spark, str(tmp_path / "x")).collect()) == sorted(df.collect())
    streamed = ingest.ingest_new_files(spark, str(tmp_path / "x"), str(tmp_path / "out"), str(tmp_path / "progress"))
    streamed.awaitTermination()
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(df.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_ends_are_no_part_of_a_value(spark, tmp_path, end):
    (tmp_path / "x.csv").write_bytes(CSV.replace("\n", end).encode())
    (tmp_path / "y.csv").write_bytes(CSV.encode())
    assert C.read_csv(spark, str(tmp_path / "x.csv")).collect() == C.read_csv(spark, str(tmp_path / "y.csv")).collect()


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("annual_amount,other,contract_id\n5000,x,C1\n")
    out = C.read_csv(spark, str(tmp_path / "x.csv"))
    assert out.columns == ["contract_id", "annual_amount"] and tuple(out.first()) == ("C1", 5000.0)
    (tmp_path / "y.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no known column"):
        C.read_csv(spark, str(tmp_path / "y.csv"))
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "1.csv").write_text("annual_amount,contract_id\n5000,C1\n")
    (tmp_path / "z" / "2.csv").write_text("contract_id,annual_amount\nC2,6000\n")
    with pytest.raises(Exception, match="(?i)header"):
        C.read_csv(spark, str(tmp_path / "z")).collect()
    assert C.read_csv(spark, str(tmp_path / "z" / "2.csv"), line_breaks=False).first().annual_amount == 6000


def test_csv_to_parquet(spark, tmp_path):
    (tmp_path / "x.csv").write_text(CSV)
    seen = []
    assert C.csv_to_parquet(spark, str(tmp_path / "x.csv"), str(tmp_path / "t"), report=seen.append)
    assert [f.simpleString() for f in spark.read.parquet(str(tmp_path / "t")).schema] == [f.simpleString() for f in CONTRACTS] and seen[0].warnings
    assert not C.csv_to_parquet(spark, str(tmp_path / "none.csv"), str(tmp_path / "u"))
    import pyarrow.parquet as pq

    part = next((tmp_path / "t").glob("*.parquet"))
    assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"


class Reply(io.BytesIO):
    pass


def opener(pages, fail=0):
    left = [fail]

    def open_(url, timeout):
        if left[0]:
            left[0] -= 1
            raise OSError("down")
        return Reply(pages[url])

    return open_


PAGE = b'<a class="x" href="no"></a><a class="action-icon-anchor" href="f.csv">get</a>'


PAGES = [
    PAGE.decode(),
    "<a href='x'>",
    "",
    '<a data-href="x.csv" href="y.csv" class="action-icon-anchor">',
    '<a class="action-icon-anchor-old" href="x">',
    "<a class=action-icon-anchor href=f.csv>",
    '<A CLASS="big\n action-icon-anchor" HREF = "a.csv?x=1&amp;y=2">',
    '<!-- <a class="action-icon-anchor" href="no"> --><a href=\'b\' class=\'action-icon-anchor\'/>',
    '<abbr class="action-icon-anchor" href="no"><a title="1 > 0" class="action-icon-anchor" href="c">',
    '<a class="action-icon-anchor"></a><a class="action-icon-anchor" href="d">',
    '<a title=" class=action-icon-anchor " href="no">',
    '<a class="action-icon-anchor" href="">',
    '<a href="1" href="2" class="action-icon-anchor" class="x">',
    '<script>"<a class=\'action-icon-anchor\' href=\'no\'>"</script><p>',
]


def test_links(spark):
    wanted = ["f.csv", None, None, "y.csv", None, "f.csv", "a.csv?x=1&y=2", "b", "c", None, None, None, "1", None]
    assert [fetch.find_link(p) for p in PAGES] == wanted and fetch.find_link(b"") is None
    df = spark.createDataFrame([(i, p) for i, p in enumerate([*PAGES, None])], "i int, html string")
    assert [r.href for r in df.select("i", fetch.link_column(F.col("html")).alias("href")).orderBy("i").collect()] == [*wanted, None]


@pytest.mark.parametrize("fail,ok", [(0, True), (2, True), (6, False)])
def test_download(tmp_path, fail, ok):
    waits = []
    target = tmp_path / "d" / "f.csv"
    pages = {"http://h/p/": PAGE, "http://h/p/f.csv": b"x" * 20000}
    assert fetch.download_contracts("http://h/p/", str(target), opener(pages, fail), waits.append) is ok
    assert target.exists() is ok and waits == [1, 2][: min(fail, 2)]
    if ok:
        assert target.stat().st_size == 20000
        assert fetch.download_contracts("http://h/p/", str(target), opener({}, 9), waits.append)  # there already


def test_download_without_link(tmp_path):
    assert not fetch.download_contracts("http://h/", str(tmp_path / "f"), opener({"http://h/": b"<p>"}), lambda s: None)


def test_folder_publisher(tmp_path):
    f = tmp_path / "a.csv"
    f.write_text("1")
    p = publish.FolderPublisher(str(tmp_path / "out"))
    assert publish.publish_existing(p, "v1", [str(f), str(tmp_path / "none")]) and p.exists("v1")
    assert publish.publish_existing(p, "v1", [str(f)]) is None and publish.publish_existing(None, "v2", [str(f)]) is None


def test_release_publisher(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_text("1"), b.write_text("2")
    calls = []

    def http(method, url, headers, body):
        calls.append((method, url))
        if method == "GET":
            return (404 if "new" in url else 500), b""
        if url.endswith("/releases"):
            return 201, json.dumps({"id": 7}).encode()
        return (500 if url.endswith("name=a") else 201), b"{}"

    p = publish.ReleasePublisher("http://api", "http://up", "o/r", "t", http)
    assert p.exists("new") is False and p.exists("odd") is None
    assert p.publish("new", [str(a), str(b)]) == "7" and p.upload(7, [str(a), str(b)]) == ["b"]


def test_deposit_publisher(tmp_path):
    a = tmp_path / "a"
    a.write_text("1")
    calls = []

    def http(method, url, headers, body):
        calls.append((method, url))
        if method == "GET":
            return 200, json.dumps([{"title": "old"}] if url.endswith("depositions") else {"submitted": url.endswith("4")}).encode()
        return 201, json.dumps({"id": 3, "links": {"bucket": "http://b"}}).encode()

    p = publish.DepositPublisher("http://api", "t", http)
    assert p.exists("old") and p.publish("new", [str(a)]) == "3" and ("PUT", "http://b/a") in calls
    p.delete(3)
    with pytest.raises(OSError, match="published"):
        p.delete(4)
    assert ("DELETE", "http://api/deposit/depositions/3") in calls and ("DELETE", "http://api/deposit/depositions/4") not in calls
    with pytest.raises(OSError):
        publish.DepositPublisher("http://api", "t", lambda *x: (500, b"")).list()


def test_pipeline(spark, tmp_path, monkeypatch):
    def download(url, target):
        open(target, "w").write(CSV)
        return True

    monkeypatch.setattr(pipeline, "download_contracts", download)
    out = publish.FolderPublisher(str(tmp_path / "pub"))
    assert pipeline.run(spark, "http://x", str(tmp_path), date(2025, 1, 2), out)
    assert (tmp_path / "pub" / "release-2025-01-02" / "property_usage_2025-01-02").is_dir()
    assert not pipeline.run(spark, None, str(tmp_path), date(2025, 1, 2))
    monkeypatch.setattr(pipeline, "download_contracts", lambda *a: False)
    assert not pipeline.run(spark, "http://x", str(tmp_path), date(2025, 1, 3))
    assert not pipeline.report_comparison(spark, "none", "none", str(tmp_path / "r"), date(2025, 1, 1))


@pytest.mark.parametrize("kind", ["release", "deposit"])
@pytest.mark.parametrize("fails", [False, True])
def test_pipeline_publishes_folders(spark, tmp_path, monkeypatch, kind, fails):
    sent, calls = {}, []

    def http(method, url, headers, body):
        calls.append((method, url))
        if method == "GET":
            return (404, b"") if kind == "release" else (200, b"[]" if url.endswith("depositions") else b"{}")
        if headers.get("Content-Type") == "application/octet-stream":
            if fails and "property_usage" in url:
                return 500, b""
            sent[url.rsplit("=" if kind == "release" else "/", 1)[1]] = body.read_bytes()
        return 201, json.dumps({"id": 7, "links": {"bucket": "http://b"}}).encode()

    def download(url, target):
        open(target, "w").write(CSV)
        return True

    monkeypatch.setattr(pipeline, "download_contracts", download)
    p = publish.ReleasePublisher("http://api", "http://up", "o/r", "t", http) if kind == "release" else publish.DepositPublisher("http://api", "t", http)
    assert pipeline.run(spark, "http://x", str(tmp_path), date(2025, 1, 2), p) is not fails
    folders = ["rent_contracts_2025-01-02.parquet"] + ["property_usage_2025-01-02"] * (not fails)
    assert sent == {f"{f}-{x.name}": x.read_bytes() for f in folders for x in (tmp_path / f).glob("part-*")} and len(sent) >= len(folders)
    if kind == "deposit":
        assert (("DELETE", "http://api/deposit/depositions/7") in calls) is fails
        assert (("POST", "http://api/deposit/depositions/7/actions/publish") in calls) is not fails


def test_files_are_streamed(tmp_path, monkeypatch):
    (tmp_path / "a").write_bytes(b"x" * 100_000)
    seen = []

    def urlopen(request, timeout):
        seen.append((request.data.read(), request.headers["Content-length"]))
        return contextlib.nullcontext(Namespace(status=201, read=lambda: b"{}"))

    monkeypatch.setattr(publish.urllib.request, "urlopen", urlopen)
    assert publish.send("PUT", "http://b/a", {}, tmp_path / "a") == (201, b"{}") and seen == [(b"x" * 100_000, "100000")]


def test_nothing_uploaded_is_an_error(tmp_path):
    (tmp_path / "a").write_text("1")
    p = publish.from_token("t", "http://api", "http://up", "o/r", lambda m, url, h, body: (201, b'{"id": 1}') if url.endswith("releases") else (500, b""))
    with pytest.raises(OSError, match="nothing was uploaded"):
        p.publish("v", [str(tmp_path / "a")])
    assert publish.from_token("", "http://api") is None and publish.from_token(None, "http://api", repository="o/r") is None
    assert isinstance(publish.from_token("t", "http://api"), publish.DepositPublisher)


def test_command_line(monkeypatch, tmp_path):
    from leasemill import __main__ as command

    seen = []
    monkeypatch.setattr(command, "build_session", lambda *a: None)
    monkeypatch.setattr(command.pipeline, "run", lambda spark, *a: seen.append(a) or len(seen) == 1)
    monkeypatch.setenv("T", "secret")
    words = ["--url", "http://p", "--root", str(tmp_path), "--day", "2025-01-02", "--api", "http://api", "--token-variable", "T"]
    assert command.main(words) == 0 and command.main(words[:6]) == 1
    assert seen[0][:3] == ("http://p", str(tmp_path), date(2025, 1, 2)) and isinstance(seen[0][3], publish.DepositPublisher) and seen[1][3] is None


def test_folders_are_sent_whole_or_not_at_all(tmp_path):
    (tmp_path / "t" / "k=1").mkdir(parents=True), (tmp_path / "t" / "k=2").mkdir()
    for x in ("t/k=1/part-0", "t/k=2/part-0", "t/_SUCCESS", "t/k=1/.part-0.crc"):
        (tmp_path / x).write_text(x)
    assert [n for n, _ in publish.pieces([str(tmp_path / "t")])] == ["t-k=1-part-0", "t-k=2-part-0"]
    (tmp_path / "empty").mkdir(), (tmp_path / "t-k=1-part-0").write_text("x")
    for files in (["empty"], ["t", "t-k=1-part-0"]):
        with pytest.raises(OSError):
            publish.pieces([str(tmp_path / f) for f in files])


def test_stream_ingest_takes_each_file_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text(CSV)
    ingest.ingest_new_files(spark, source, target, progress).awaitTermination()
    assert spark.read.parquet(target).count() == 3
    (tmp_path / "in" / "2.csv").write_text(CSV)
    ingest.ingest_new_files(spark, source, target, progress).awaitTermination()
    assert spark.read.parquet(target).count() == 6


def test_stream_keeps_profile(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.csv").write_text(CSV)
    rules = [profile.ColumnRule("annual_amount", 10000, 5000000), profile.ColumnRule("property_usage_en", labels=("Residential",))]
    store = profile.CountStore(spark)
    stream = ingest.contracts_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    ingest.keep_profile(stream, store, rules, F.lit(0), str(tmp_path / "progress")).awaitTermination()
    p = {r.column_name: r for r in profile.profile(store.read(), rules).collect()}
    assert (p["annual_amount"].n_rows, p["annual_amount"].n_null, store.version) == (9, 6, 3)
    assert p["property_usage_en"].n_bad == 3


def test_late_rows_are_dropped(spark, tmp_path):
    schema = T.StructType([T.StructField("at", T.TimestampType()), CONTRACTS["property_usage_en"], CONTRACTS["annual_amount"]])
    for i, d in enumerate(["2024-01-01", "2024-12-01", "2024-12-02", "2024-01-02"]):
        spark.sql(f"SELECT timestamp'{d} 00:00:00' AS at, 'R' AS property_usage_en, 1.0D AS annual_amount").coalesce(1).write.parquet(str(tmp_path / "in" / f"p={i}"))
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path / "in" / "*"))
    out = ingest.usage_counts(rows, "at")
    q = out.writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT sum(n) AS n FROM late").first().n == 1
