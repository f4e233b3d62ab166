"""Lookup packages: tables in Spark, thin packers on the driver."""

from __future__ import annotations

import gzip
import hashlib
import io
import zipfile
from collections.abc import Iterator
from datetime import date
from html import escape
from xml.dom import minidom
from xml.parsers.expat import ExpatError

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from pyspark.sql.window import Window

from lexforge.functions.text import capitalized, normal_word, u32be, word_prefix
from lexforge.operators.inflect import first_lemma, with_roots
from lexforge.operators.render import bucket_entry, reader_entry
from lexforge.plans.discover import kept


def numbered(df: DataFrame, by: str, size: Column | None = None) -> DataFrame:
    """Adds position (0, 1, ... in the order of `by`) and, with size, the sum of sizes before.

    Rows are dealt into ranges of `by` (quantiles) and kept; ranges are numbered on their own, and a table with one row of
    totals a range gives each its start. Nothing but that table meets in one task.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = size if size is not None else F.lit(0)
    keyed = df.withColumn("_s", F.coalesce(size, F.lit(0)).cast("long"))
    keyed = kept(keyed.repartitionByRange(parts, by).withColumn("_r", F.spark_partition_id()))
    totals = keyed.groupBy("_r").agg(F.count("*").alias("_n"), F.sum("_s").alias("_t"))
    upto = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_r", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_t").over(upto), F.lit(0)).alias("_t0"))
    own = Window.partitionBy("_r").orderBy(by)
    before = F.coalesce(F.sum("_s").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = keyed.withColumn("_k", F.row_number().over(own) - 1).withColumn("_b", before).join(starts, "_r")
    return out.withColumn("position", (F.col("_n0") + F.col("_k")).cast("long")).withColumn("start", (F.col("_t0") + F.col("_b")).cast("long")).drop("_s", "_r", "_n0", "_t0", "_k", "_b")


def last_of_each(words: DataFrame) -> DataFrame:
    """words: en, word_ord, body. By normalised headword the last body that is not empty, at the first one's place."""
    w = words.withColumn("w", normal_word(F.col("en"))).where("w <> '' AND body <> ''")
    return w.groupBy("w").agg(F.max_by("body", "word_ord").alias("body"), F.min("word_ord").alias("word_ord"))


def case_fallback(keys: DataFrame, words: DataFrame) -> DataFrame:
    """keys: w. The entry under the key itself, else under its capitalised form, else none."""
    a, b = words.select(F.col("en").alias("w"), F.col("body").alias("a")), words.select(F.col("en").alias("_c"), F.col("body").alias("b"))
    out = keys.join(a, "w", "left").withColumn("_c", capitalized(F.col("w"))).join(b, "_c", "left")
    return out.select("w", F.coalesce("a", "b").alias("body")).where("body IS NOT NULL")


def star_index(words: DataFrame) -> DataFrame:
    """words: w, body. w, position, start, size, entry (bytes of the index)."""
    n = numbered(words, "w", F.octet_length("body")).withColumn("size", F.octet_length("body").cast("long"))
    return n.withColumn("entry", F.concat(F.encode("w", "utf-8"), F.unhex(F.lit("00")), u32be(F.col("start")), u32be(F.col("size"))))


def star_synonyms(words: DataFrame, index: DataFrame) -> DataFrame:
    """words: w, word_ord, variants. variant, position, entry: forms that are no headword, with their first lemma's place."""
    s = first_lemma(words).join(index.select("w", "position"), "w").select("variant", "position")
    return s.withColumn("entry", F.concat(F.encode("variant", "utf-8"), F.unhex(F.lit("00")), u32be(F.col("position"))))


def star_header(index: DataFrame, synonyms: DataFrame, name: str, day: str | None = None) -> str:
    a = index.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("entry")), F.lit(0)).alias("size")).first()
    lines = ["StarDict's dict ifo file", "version=2.4.2", f"wordcount={a.n}", f"synwordcount={synonyms.count()}", f"idxfilesize={a['size']}", f"bookname={name}", f"date={day or date.today().isoformat()}", "sametypesequence=h"]
    return "\n".join(lines) + "\n"


def write_star(words: DataFrame, name: str, target) -> None:
    """words: w, word_ord, body, variants. A zip with the four files; rows stream to the driver in order."""
    index = star_index(words).cache()
    syn = star_synonyms(words, index).orderBy("variant").cache()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(f"{name}.ifo", star_header(index, syn, name))
        for suffix, rows, column in (("idx", index.orderBy("position"), "entry"), ("dict", index.orderBy("position").select(F.encode("body", "utf-8").alias("b")), "b"), ("syn", syn, "entry")):
            if suffix != "syn" or not syn.isEmpty():
                with z.open(f"{name}.{suffix}", "w", force_zip64=True) as f:
                    for row in rows.select(column).toLocalIterator():
                        f.write(bytes(row[0]))


def bucket_rows(words: DataFrame, forms: DataFrame | None = None) -> DataFrame:
    """words: w, word_ord, body, variants; forms as in with_roots(). prefix, n, anchor, word_ord, kind, html: the entries of all buckets; a form whose prefix differs gets a copy."""
    r = with_roots(words.where("body <> ''"), words.drop("body") if forms is None else forms).withColumn("_p", word_prefix(F.col("w")))

    def entry(anchor: Column, kind: int, roots: Column | None = None) -> Column:
        html = bucket_entry(anchor, F.col("w"), F.col("variants"), F.col("body"), roots)
        return F.struct(word_prefix(anchor).alias("prefix"), F.length(anchor).alias("n"), anchor.alias("anchor"), "word_ord", F.lit(kind).alias("kind"), html.alias("html"))

    copies = F.transform(F.filter("variants", lambda v: word_prefix(v) != F.col("_p")), lambda v: entry(v, 1))
    return r.select(F.explode(F.concat(F.array(entry(F.col("w"), 0, F.col("roots"))), copies)).alias("e")).select("e.*")


def buckets(words: DataFrame, forms: DataFrame | None = None) -> DataFrame:
    """prefix, entries, html: the entries of a bucket by length and word, as one text."""
    s = F.array_sort(F.collect_list(F.struct("n", "anchor", "word_ord", "kind", "html")))
    return bucket_rows(words, forms).groupBy("prefix").agg(F.count("*").alias("entries"), F.array_join(F.transform(s, lambda x: x["html"]), "").alias("html"))


def bucket_digests(words: DataFrame, forms: DataFrame | None = None) -> DataFrame:
    """prefix, entries, html: the MD5 of a bucket's text in hex. Sorted entries pass by; no bucket is held as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, n, digest = None, 0, hashlib.md5()
        done = lambda: pa.RecordBatch.from_arrays([pa.array([prefix]), pa.array([n]), pa.array([digest.hexdigest()])], ["prefix", "entries", "html"])
        for batch in batches:
            for p, first, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if p != prefix:
                    if n:
                        yield done()
                    prefix, n, digest = p, 0, hashlib.md5()
                n += first == 0
                digest.update(html.as_buffer())
        if n:
            yield done()

    rows = bucket_rows(words, forms).repartition("prefix").sortWithinPartitions("prefix", "n", "anchor", "word_ord", "kind", "html")
    # An Arrow batch has 10,000 rows: long entries come in pieces, so that it stays near 80 MB whatever their size.
    pieces = F.when(F.octet_length("html") <= 8192, F.array("html")).otherwise(F.regexp_extract_all("html", F.lit("(?s).{1,1024}"), F.lit(0)))
    cut = rows.select("prefix", F.posexplode(pieces).alias("at", "piece"))
    return cut.select("prefix", "at", F.encode("piece", "utf-8").alias("piece")).mapInArrow(run, "prefix string, entries long, html string")


def index_keys(words: DataFrame) -> DataFrame:
    """Distinct headwords and forms of words with a body, if there is one; the sorted key table (a trie packer may take it further)."""
    words = words.where("body <> ''") if "body" in words.columns else words
    return words.select(F.col("w").alias("key")).union(words.select(F.explode("variants"))).distinct()


#: What stands around the entries of a bucket's member (fixed values).
MEMBER = ('<?xml version="1.0" encoding="utf-8"?><html>\n', "</html>")


@F.pandas_udf(BinaryType())
def zipped(html: pd.Series) -> pd.Series:
    return html.map(lambda x: gzip.compress(f"{MEMBER[0]}{x}{MEMBER[1]}".encode(), mtime=0))


def write_buckets(words: DataFrame, target) -> None:
    """A stored zip: `words` (sorted keys) and one gzip member per prefix, in prefix order."""
    with zipfile.ZipFile(target, "w", zipfile.ZIP_STORED) as z:
        with z.open("words", "w", force_zip64=True) as f:
            for row in index_keys(words).orderBy("key").toLocalIterator():
                f.write(row.key.encode() + b"\n")
        for row in buckets(words).orderBy("prefix").select("prefix", zipped("html").alias("z")).toLocalIterator():
            z.writestr(f"{row.prefix}.html", bytes(row.z))


def chunks(words: DataFrame, per_chunk: int = 20_000) -> DataFrame:
    """words: w, body (null or empty: dropped, yet it keeps its number). w, entry_id, chunk."""
    ids = numbered(words, "w").withColumnRenamed("position", "entry_id").drop("start")
    kept = numbered(ids.where("body <> ''"), "w").withColumn("chunk", F.floor(F.col("position") / per_chunk).cast("long"))
    return kept.drop("position", "start")


#: Namespaces of the reader format's chunk files (fixed values).
GUIDELINES = "https://kindlegen.s3.amazonaws.com/AmazonKindlePublishingGuidelines.pdf"
NAMESPACES = {
    "math": "http://exslt.org/math", "svg": "http://www.w3.org/2000/svg", "tl": GUIDELINES, "saxon": "http://saxon.sf.net/", "xs": "http://www.w3.org/2001/XMLSchema",
    "xsi": "http://www.w3.org/2001/XMLSchema-instance", "cx": GUIDELINES, "idx": GUIDELINES, "mbp": GUIDELINES, "mbname": GUIDELINES, "xlink": "http://www.w3.org/1999/xlink",
}


def chunk_files(rows: DataFrame, title: str) -> DataFrame:
    """rows: w, body, variants, entry_id, chunk. chunk, xhtml."""
    e = rows.withColumn("e", reader_entry(F.col("entry_id"), F.col("w"), F.col("body"), F.col("variants")))
    s = F.array_sort(F.collect_list(F.struct("entry_id", "e")))
    spaces = " ".join(f'xmlns:{name}="{uri}"' for name, uri in NAMESPACES.items())
    head = f'<?xml version="1.0" encoding="utf-8"?>\n<html {spaces}>\n<head><meta http-equiv="Content-Type" content="text/html; charset=utf-8"/><title>{escape(title)}</title></head>\n<body><mbp:frameset>'
    return e.groupBy("chunk").agg(F.concat(F.lit(head), F.array_join(F.transform(s, lambda x: x["e"]), ""), F.lit("</mbp:frameset></body></html>")).alias("xhtml"))


def well_formed(files: DataFrame) -> DataFrame:
    """chunk, ok: whether each file parses as XML."""

    def run(frames):
        for f in frames:
            yield pd.DataFrame({"chunk": f["chunk"], "ok": [_parses(x) for x in f["xhtml"]]})

    return files.mapInPandas(run, "chunk long, ok boolean")


def _parses(text: str) -> bool:
    try:
        minidom.parseString(text.encode())
        return True
    except ExpatError:
        return False


def manifest(chunk_ids: list[int], title: str, identifier: str = "lexforge-en-tr", source: str = "en", target: str = "tr") -> str:
    """The package file of a dictionary: its languages and index, items and reading order."""
    items = "".join(f'<item id="content{i}" href="content{i}.html" media-type="application/xhtml+xml"/>\n' for i in chunk_ids)
    spine = "".join(f'<itemref idref="content{i}"/>\n' for i in chunk_ids)
    book = f'<dc:Title>{escape(title)}</dc:Title>\n<dc:Language>{target}</dc:Language>\n<dc:Identifier id="uid">{escape(identifier)}</dc:Identifier>'
    names = 'xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:oebpackage="http://openebook.org/namespaces/oeb-package/1.0/"'
    index = f"<DictionaryInLanguage>{source}</DictionaryInLanguage>\n<DictionaryOutLanguage>{target}</DictionaryOutLanguage>\n<DefaultLookupIndex>default</DefaultLookupIndex>"
    meta = f"<metadata>\n<dc-metadata {names}>\n{book}\n</dc-metadata>\n<x-metadata>\n{index}\n</x-metadata>\n</metadata>"
    return f'<?xml version="1.0" encoding="utf-8"?>\n<package unique-identifier="uid" xmlns:idx="{GUIDELINES}">\n{meta}\n<manifest>\n{items}</manifest>\n<spine>\n{spine}</spine>\n<guide></guide>\n</package>\n'


def write_reader(words: DataFrame, title: str, target, per_chunk: int = 20_000) -> None:
    """words: w, body, variants. A zip of chunk files and manifest; fails if a chunk is not well-formed."""
    files = chunk_files(chunks(words, per_chunk), title).cache()
    if not well_formed(files).where("NOT ok").isEmpty():
        raise ValueError("a chunk is not well-formed")
    ids = [r.chunk for r in files.select("chunk").orderBy("chunk").toLocalIterator()]
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("content.opf", manifest(ids, title))
        for r in files.orderBy("chunk").toLocalIterator():
            z.writestr(f"content{r.chunk}.html", r.xhtml)


def unpack(data: bytes) -> dict[str, bytes]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return {n: z.read(n) for n in z.namelist()}
