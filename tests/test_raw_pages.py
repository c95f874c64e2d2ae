"""Raw landed pages: charsets, folders, batch and stream."""

import hashlib
import re
from pathlib import Path

import pytest

from newsbeam.sources.raw import read_raw_pages

PAGES = {
    "plain.html": ("café €".encode(), "café €", "utf-8"),
    "mark.html": (b"\xef\xbb\xbf" + "<meta charset=latin1>é".encode(), "<meta charset=latin1>é", "utf-8"),
    "wide.html": (b"\xff\xfe" + "é \U0001f600".encode("utf-16-le"), "é \U0001f600", "utf-16-le"),
    "big.html": (b"\xfe\xff" + "é\n".encode("utf-16-be"), "é\n", "utf-16-be"),
    "odd.html": (b"\xff\xfe" + "ab".encode("utf-16-le") + b"c", "ab�", "utf-16-le"),
    "west.html": ("<META http-equiv=x content='text/html; charset=ISO-8859-1'>".encode() + b"\x80 \xe9 \x81", "<META http-equiv=x content='text/html; charset=ISO-8859-1'>€ é \x81", "windows-1252"),
    "japan.html": ("<meta charset='shift_jis'>日本".encode("shift_jis"), "<meta charset='shift_jis'>日本", "shift_jis"),
    "unknown.html": (b'<meta charset="none-such">\xc3\xa9', '<meta charset="none-such">é', "none-such"),
    "binary.html": (b'<meta charset="base64">ab', '<meta charset="base64">ab', "base64"),
    "claims.html": (b'<meta charset="utf-16">\xc3\xa9', '<meta charset="utf-16">é', "utf-8"),
    "broken.html": (b"a\xffb", "a�b", "utf-8"),
    "late.html": (b" " * 2000 + b"<meta charset=latin1>" + "é".encode(), " " * 2000 + "<meta charset=latin1>é", "utf-8"),
}


@pytest.fixture
def landing(tmp_path):
    for n, (name, (raw, _, _)) in enumerate(PAGES.items()):
        folder = tmp_path / f"feed={'AB'[n % 2]}" / ("symbol=BTC" if n % 3 else "symbol=007")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(raw)
    (folder / "notes.txt").write_bytes(b"no page")
    (folder / "empty.html").write_bytes(b"")  # no row
    return str(tmp_path)


def _check(rows):
    got = {r.url.rsplit("/", 1)[1]: r for r in rows}
    assert set(got) == set(PAGES) and len(rows) == len(PAGES)
    for n, (name, (_, html, charset)) in enumerate(PAGES.items()):
        r = got[name]
        assert (r.html, r.charset) == (html, charset), name
        assert r.feed == "AB"[n % 2] and r.symbol == ("BTC" if n % 3 else "007") and r.landed_at is not None


def test_pages_are_decoded_by_their_own_charset(spark, landing):
    _check(read_raw_pages(spark, landing).collect())


def test_new_files_are_a_stream(spark, landing, tmp_path_factory):
    out, chk = (str(tmp_path_factory.mktemp(x)) for x in ("out", "chk"))
    for _ in range(2):  # the second run finds nothing new
        q = (read_raw_pages(spark, landing, stream=True).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", chk).trigger(availableNow=True).start())
        q.awaitTermination()
    _check(spark.read.parquet(out).collect())


def test_job_reads_raw_pages(spark, tmp_path):
    from newsbeam import jobs
    folder = tmp_path / "landing" / "feed=A" / "symbol=BTC"
    folder.mkdir(parents=True)
    item = '<div class="uikit-row"><div class="uikit-col-md-8"><h5>{}</h5></div><span>{}</span></div>'
    (folder / "one.html").write_bytes(("<meta charset=iso-8859-1>" + item.format("caf\xe9", "5 minutes ago")).encode("latin-1"))
    feed = jobs.Feed("A", "h5", "span", "strict30")
    import datetime as dt
    jobs.ingest(spark, jobs.landed(spark, str(tmp_path / "landing"), "html"), str(tmp_path / "store"), dt.datetime(2024, 1, 2, 12), (feed,))
    assert [(r.symbol, r.headline) for r in spark.read.parquet(str(tmp_path / "store")).collect()] == [("BTC", "caf\xe9")]


def _landings(spark):
    from newsbeam.session import ensure_checkpoint_dir
    runs = Path(re.sub("^file:/+", "/", ensure_checkpoint_dir(spark))) / "runs"
    return set(runs.glob("raw-pages-*"))


def test_pages_land_without_a_folder_each(spark, tmp_path):
    """a file per page in the folder of its feed and symbol, read by few tasks; odd rows come back as they were landed."""
    import __spark_entry__ as E
    at, before = str(tmp_path), _landings(spark)
    html = '<meta charset="utf-8">caf\xe9 {}\nb'
    rows = [(i, "http://a.example.com/x", html.format(i)) for i in range(300)]
    odd = [(1000, None, "x"), (1001, "http://[::1]/x", None), (None, "no url", "y"), (-4, "http://a.example.com/", ""),
           (1002, "http://b.example.com/", "one"), (1002, "http://b.example.com/", "one")]
    spark.createDataFrame(rows + odd, "page_id long, url string, html string").coalesce(1).write.parquet(f"{at}/pages.parquet")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    result = E.queries()["read_raw_pages"](spark, at)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost
    got = {(r.page_id, r.feed, r.symbol, r.charset, r.n_chars, r.html_md5) for r in result.collect()}

    def want(page_id, symbol, text):
        west = page_id is not None and page_id % 2 == 0
        text = text.replace('charset="utf-8"', 'charset="windows-1252"') if west else text
        charset = "windows-1252" if west and "charset" in text else "utf-8"
        return page_id, "A" if west else "B", symbol, charset, len(text), hashlib.md5(text.encode()).hexdigest()
    assert got == {want(i, "a.example.com", h) for i, _, h in rows} | {
        want(1000, None, "x"), want(1001, "[::1]", ""), want(None, None, "y"), want(-4, "a.example.com", ""),
        want(1002, "b.example.com", "one\none")}  # rows of one task under one id share a file, as in Spark's sinks
    landing, = _landings(spark) - before
    files = [f for f in landing.rglob("*.txt") if not f.name.startswith(".")]
    assert len(files) == len(got)
    assert len({f.parent for f in files}) == 6
    assert result.rdd.getNumPartitions() <= 8
