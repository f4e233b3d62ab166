"""Lexicon operators against DuckDB, plain Python and their own round trips."""

import gzip
import hashlib
import io
import json
import os
import struct
import tracemalloc

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexforge.functions.text import example_lines, html_escape, word_prefix
from lexforge.operators import inflect, senses as S
from lexforge.plans import packages as P
from lexforge.plans.queries import ORACLES, QUERIES
from lexforge.sources import html_table as H, lexicon as L

SF = "/root/testdata/sf0.001"
PAGE = """<table id="englishResultsTable"><tr><th class="c0">#</th><th class="c1">Kategori</th><th class="c2">İngilizce</th><th class="c3">Türkçe</th></tr>
<tr><td>1</td><td>Genel</td><td><a>lamp</a> <i>i.</i></td><td><a>lamba</a></td></tr>
<tr class="example-sentences-row"><td class="example-sentences">A <b>lamp</b>.<br/>Bir lamba.<a>x</a></td></tr>
<tr class="mobile-category-row"><td colspan="4">Teknik</td></tr>
<tr><td>2</td><td></td><td><a>skip</a></td><td>y</td></tr>
<tr class="example-sentences-row"><td class="example-sentences">orphan<br>yetim</td></tr>
<tr><td>3</td><td>Teknik</td><td><a>lamp post [old]</a></td><td>direk</td></tr></table>"""


@pytest.mark.parametrize("name", ["top_senses", "merge_senses", "idx_offsets", "lemma_first", "html_rows", "lexicon_stats", "discover_fixpoint", "bucket_entries", "reader_entries"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).fetchdf()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda d: sorted(map(repr, d[cols].astype(object).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def test_html_tables(spark):
    broken = PAGE.replace("</td>", "").replace("</tr>", "").replace("</table>", "")
    pages = spark.createDataFrame([(1, PAGE), (2, broken), (3, ""), (4, None), (5, "<p>no table")], "page_id long, html string")
    rows = H.raw_rows(pages)
    forward = {(r.page_id, r.en, r.tr, r.pos, r.pos_en, r.example_en, r.example_tr) for r in S.single_words(H.forward_rows(rows)).collect()}
    assert forward == {(i, "lamp", "lamba", "i.", "noun", "A lamp.", "Bir lamba.") for i in (1, 2)}
    assert {(r.page_id, r.en) for r in H.reverse_headwords(rows).collect()} == {(i, w) for i in (1, 2) for w in ("lamp", "skip")}


def test_merge_is_idempotent_and_null_safe(spark):
    shape = "en string, tr string, pos string, sense_ord int"
    old = spark.createDataFrame([("a", "x", None, 1)], shape)
    new = spark.createDataFrame([("a", "x", None, 5), ("a", "X", None, 6), ("a", "X", None, 7), (None, "q", None, 8)], shape)
    once = S.merge(old, new)
    assert sorted(map(str, once.collect())) == sorted(map(str, S.merge(once, new).collect()))
    assert once.count() == 3


def test_scalars(spark):
    rows = spark.createDataFrame([("Run",), ("a",), (" ",), ("дом",), ("3d",), ("o'k",), ("İz",)], "w string").select(word_prefix(F.col("w")).alias("p")).collect()
    assert [r.p for r in rows][:6] == ["ru", "aa", "11", "до", "11", "11"]
    df = spark.createDataFrame([("a<b>&\"'", "<a>q</a> x <br/> <i>y</i> z<BR>")], "t string, c string")
    r = df.select(html_escape(F.col("t")).alias("e"), example_lines(F.col("c")).alias("l")).first()
    assert r.e == "a&lt;b&gt;&amp;&quot;&#x27;" and r.l == ["x", "y z"]


def test_inflection(spark):
    df = spark.createDataFrame([("run", ["verb"]), ("city", ["noun"]), ("box", []), ("big", ["adjective"]), ("x", None)], "w string, pos array<string>")
    got = {r.w: r.v for r in df.select("w", inflect.variants(F.col("w"), F.col("pos")).alias("v")).collect()}
    assert got["run"] == ["ran", "running", "runs"] and got["city"] == ["cities"] and got["big"] == ["bigger", "biggest"] and "boxes" in got["box"]


@pytest.fixture()
def words(spark):
    rows = [("run", 0, "<p>koş & süs</p>", ["ran", "running", "runs"]), ("ran", 1, "<p>x</p>", []), ("ağ", 2, "<p>net</p>", ["ağs"]), ("go", 3, "<p>g</p>", ["went"])]
    return spark.createDataFrame(rows, "w string, word_ord int, body string, variants array<string>")


def test_star_package_round_trip(words):
    out = io.BytesIO()
    P.write_star(words, "t", out)
    files = P.unpack(out.getvalue())
    want, data, got, order = {r.w: r.body for r in words.collect()}, files["t.idx"], {}, []
    while data:
        w, rest = data.split(b"\0", 1)
        start, size = struct.unpack(">II", rest[:8])
        got[w.decode()], data = files["t.dict"][start : start + size].decode(), rest[8:]
        order.append(w.decode())
    assert got == want and order == sorted(want)
    syn, data = {}, files["t.syn"]
    while data:
        v, rest = data.split(b"\0", 1)
        syn[v.decode()], data = order[struct.unpack(">I", rest[:4])[0]], rest[4:]
    assert syn == {"running": "run", "runs": "run", "ağs": "ağ", "went": "go"}
    assert b"wordcount=4\nsynwordcount=4" in files["t.ifo"]


def test_bucket_and_reader_packages(words, spark):
    out = io.BytesIO()
    P.write_buckets(words, out)
    files = P.unpack(out.getvalue())
    assert files["words"].decode().split() == sorted({"run", "ran", "ağ", "go", "running", "runs", "ağs", "went"})
    assert b"<a name=\"went\" />" in gzip.decompress(files["we.html"]) and "kök: <b>run</b>".encode() in gzip.decompress(files["ra.html"])
    assert gzip.decompress(files["we.html"]).startswith(b'<?xml version="1.0" encoding="utf-8"?><html>\n<w>') and gzip.decompress(files["we.html"]).endswith(b"</w></html>")
    with pytest.raises(ValueError):
        P.write_reader(words, "t", io.BytesIO())  # a bare & is no XML
    fine = words.withColumn("body", F.replace("body", F.lit("&"), F.lit("&amp;")))
    out = io.BytesIO()
    P.write_reader(fine, "t", out, 3)
    files = P.unpack(out.getvalue())
    assert {"content.opf", "content0.html", "content1.html"} == set(files)
    assert b"<DictionaryInLanguage>en</DictionaryInLanguage>" in files["content.opf"] and b'<a id="w0"></a>' in files["content0.html"]


def test_keys_of_words_without_body(spark):
    rows = [("a", 0, "", ["as"]), ("b", 1, "<p>x</p>", ["bs"])]
    w = spark.createDataFrame(rows, "w string, word_ord int, body string, variants array<string>")
    assert sorted(r.key for r in P.index_keys(w).collect()) == ["b", "bs"]


def test_files(spark, tmp_path):
    db = {"run": [{"tr": "koşmak", "pos": "f."}, {"tr": "akış"}], "empty": [], " Padded ": [{"tr": "x", "pos": ""}]}
    (tmp_path / "db.json").write_text(json.dumps(db))
    d = L.read_dictionary(spark, str(tmp_path / "db.json"))
    assert [(r.en, r.tr) for r in d.orderBy("word_ord", "sense_ord").collect()] == [("run", "koşmak"), ("run", "akış"), ("empty", None), (" Padded ", "x")]
    assert L.read_words(spark, str(tmp_path / "none.json"), required=False).count() == 0
    L.append_journal(d.where("tr IS NOT NULL"), str(tmp_path / "journal"))
    assert L.read_journal(spark, str(tmp_path / "journal")).count() == 3
    L.snapshot(d, str(tmp_path / "t"))
    L.snapshot(d.limit(1), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_stream_merge(spark, tmp_path):
    from lexforge.streaming.merge import merge_stream

    shape = "en string, tr string, pos string, sense_ord int"
    src = str(tmp_path / "in")
    for i in range(2):
        spark.createDataFrame([("a", "x", None, i), ("b", str(i), "n", i)], shape).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(src)
    merge_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted((r.en, r.tr) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", "x"), ("b", "0"), ("b", "1")]


def test_examples_follow_the_page(spark):
    """An example belongs to the row right before it, header rows count as rows, and only marked cells are read."""
    row = lambda n: f"<tr><td>{n}</td><td>Genel</td><td><a>w{n}</a></td><td><a>t</a></td></tr>"
    example = lambda cell: f'<tr class="example-sentences-row">{cell}</tr>'
    mark = '<td class="example-sentences">'
    page = f'<table id="englishResultsTable">{row(1)}<tr><th>h</th></tr>{example(mark + "a<br>b</td>")}{row(2)}{example("<td>a<br>b</td>")}{row(3)}{example(mark + "one &lt;q&gt; <b>two</b> &amp; x<br/>three</td>")}</table>'
    rows = H.forward_rows(H.raw_rows(spark.createDataFrame([(1, page)], "page_id long, html string")))
    assert {(r.en, r.example_en, r.example_tr) for r in rows.collect()} == {("w1", None, None), ("w2", None, None), ("w3", "one &lt;q&gt; two &amp; x", "three")}


def test_snapshot_survives_a_break(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "t"), L._renamed
    L.snapshot(spark.range(3), path)

    def broken(session, old, new):
        if old.endswith(".staging"):
            raise OSError("lost")
        seen(session, old, new)

    monkeypatch.setattr(L, "_renamed", broken)
    with pytest.raises(OSError):
        L.snapshot(spark.range(9), path)
    monkeypatch.undo()
    assert not os.path.exists(path) and L.recovered(spark, path) and spark.read.parquet(path).count() == 3


def test_journal_is_applied(spark, tmp_path):
    table, journal = str(tmp_path / "t"), str(tmp_path / "journal")
    shape = "en string, tr string, pos string, pos_en string, category string, example_en string, example_tr string"
    senses = spark.createDataFrame([("b", "x", "n", None, "c", None, None), ("a", "y", None, None, "c", None, None), ("b", "x", "n", None, "d", None, None)], shape)
    for _ in range(2):
        L.append_journal(senses, journal)
        L.apply_journal(spark, table, journal)
        assert not os.path.exists(journal) and os.path.exists(journal + ".applied")
        assert sorted((r.en, r.tr, r.category) for r in spark.read.parquet(table).collect()) == [("a", "y", "c"), ("b", "x", "c")]
        os.rename(journal + ".applied", journal + ".before") if not os.path.exists(journal + ".before") else None


def test_bucket_entries_in_one_pass(spark, tmp_path):
    """Documents are read for the bodies and for the roots only; a blank translation gives a headword no place among the roots."""
    texts = ["fly,\nflie x\nfly y\nflies z", "the a,b\nthe a\n\nfly <q> & one two three four five six seven eight nine ten eleven"]
    docs = spark.createDataFrame([(i, t, "en", f"src{i}", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = QUERIES["bucket_entries"](spark, str(tmp_path))
    want = con.execute(f"SELECT prefix, entries, html FROM ({ORACLES['bucket_entries']})").fetchall()
    assert sorted((r.prefix, r.entries, r.html) for r in got.collect()) == sorted(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def test_bucket_digests_equal_texts(words):
    want = {(r.prefix, r.entries, hashlib.md5(r.html.encode()).hexdigest()) for r in P.buckets(words).collect()}
    assert {tuple(r) for r in P.bucket_digests(words).collect()} == want and len(want) == 5


def test_pages_in_pieces(monkeypatch):
    """Wherever a page is cut, its rows are the same; one that can't be parsed has none, however late that shows."""
    page = PAGE.replace("lamba", "l&amp;m&#98;a").replace("</table>", "<tr><td>x<!-- <td> --></td></tr></table>") + '<script>"<td>"</script>'

    def rows(text, size):
        p = H._Page(7, pa.int64())
        for at in range(0, len(text), size):
            p.feed(text[at : at + size])
        return [r for b in p.end() for r in b.to_pylist()]

    whole = rows(page, len(page))
    assert len(whole) == 8 and whole[1]["tds"][3]["a"] == "l&mba"
    monkeypatch.setattr(H, "FEED", 1)
    monkeypatch.setattr(H, "BATCH", 2)
    for size in (1, 2, 3, 5, 8, 13, 100):
        assert rows(page, size) == whole
        assert rows(page + "<![odd[", size) == []


def test_memory_does_not_follow_a_page():
    """A page of 30,000 rows takes a few MB of Python."""
    row = "<tr><td>{}</td><td>Genel</td><td><a>lamp</a> <i>i.</i></td><td><a>lamba</a></td></tr>"
    page, n = H._Page("x", pa.string()), 0
    tracemalloc.start()
    page.feed(f'<table id="{H.TABLE}">')
    for i in range(30_000):
        page.feed(row.format(i))
    for batch in page.end():
        n += batch.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 30_000 and peak < 10e6


def test_memory_does_not_follow_the_width_of_rows():
    """Fewer rows than a batch takes, but long: their cells, and the header that each row repeats, stay within a few MB of Python."""
    row = "<tr><td>{}</td><td>Genel</td><td><a>{}</a></td><td><a>lamba</a></td></tr>"
    pa.array(["x"])  # imports pandas
    for head, word in (("h", "lamp " * 4000), ("h" * 100_000, "lamp")):
        page, rows = H._Page("x", pa.string()), []
        tracemalloc.start()
        page.feed(f'<table id="{H.TABLE}"><tr><th class="c2">{head}</th></tr>')
        for i in range(1_500):
            page.feed(row.format(i, word))
        for batch in page.end():
            rows += [(n, h == head, tds[2]["a"] == word) for n, h, tds in zip(*(batch[k].to_pylist() for k in ("row_ord", "head", "tds"))) if n]
            assert batch.nbytes < 10e6
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == [(n, True, True) for n in range(1, 1_501)] and peak < 10e6


def test_a_batch_that_cannot_be_kept_fails(monkeypatch):
    """It is not taken for a page that can't be parsed, whose rows go."""

    def broken(self, rows):
        raise pa.ArrowInvalid("no room")

    monkeypatch.setattr(H._Page, "_batch", broken)
    monkeypatch.setattr(H, "BATCH", 2)
    page = H._Page(1, pa.int64())
    with pytest.raises(RuntimeError):
        page.feed(PAGE)
        list(page.end())
