"""Result tables of dictionary pages: parser events to raw rows; all selection stays in Catalyst."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexforge.functions.text import example_pair, normal_word, strip_u, without_notes

#: The result table's id (fixed value).
TABLE = "englishResultsTable"
ROWS = "table_ord int, row_ord int, cls string, head string, tds array<struct<cls:string,txt:string,a:string,i:string,raw:string>>"


class _Tables(HTMLParser):
    """Cells of every result table; a missing end tag of a cell or row is supplied. full() takes the rows away once they make a batch."""

    def __init__(self, full: Callable[[], None]):
        super().__init__(convert_charrefs=True)
        self.full, self.size = full, 0
        self.rows, self.table, self.depth, self.row, self.cell, self.head = [], -1, 0, None, None, ""

    def end_row(self):
        self.end_cell()
        if self.row is not None:  # rows of header cells count as well when the next row is looked for
            self.rows.append((self.table, self.row["n"], self.row["cls"], self.head, self.row["tds"]))
            self.size += len(self.row["cls"]) + len(self.head) + sum(len(x) for c in self.row["tds"] for x in c.values() if x)
            if len(self.rows) >= BATCH or self.size >= WIDE:
                self.full()
        self.row = None

    def end_cell(self):
        if self.cell and self.row is not None:
            c = self.cell
            text = lambda k: "".join(c[k]) if c[k] is not None else None
            if c["tag"] == "td":
                self.row["tds"].append({k: text(k) if k != "cls" else c[k] for k in CELL})
            elif "c2" in c["cls"]:
                self.head = text("txt").strip()
        self.cell = None

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        if tag == "table":
            if self.depth or at.get("id") == TABLE:
                self.depth += 1
            if self.depth == 1:
                self.table, self.count, self.head = self.table + 1, 0, ""
        elif self.depth == 1 and tag == "tr":
            self.end_row()
            self.row = {"n": self.count, "cls": at.get("class") or "", "tds": []}
            self.count += 1
        elif self.depth == 1 and tag in ("td", "th") and self.row is not None:
            self.end_cell()
            self.cell = {"tag": tag, "cls": at.get("class") or "", "txt": [], "a": None, "i": None, "raw": [], "in": []}
        elif self.cell:
            c = self.cell
            if tag in ("a", "i") and not c["in"] and c[tag] is None:
                c[tag] = []
            if tag == "br":
                c["raw"].append("<br>")
            else:
                c["in"].append(tag)

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.end_row()
        elif self.depth == 1 and tag == "tr":
            self.end_row()
        elif tag in ("td", "th"):
            self.end_cell()
        elif self.cell and tag in self.cell["in"]:
            while self.cell["in"].pop() != tag:
                pass

    def handle_data(self, data):
        if c := self.cell:
            c["txt"].append(data)
            for tag in ("a", "i"):
                if c["in"][:1] == [tag] and c[tag] is not None:
                    c[tag].append(data)
            if "a" not in c["in"]:
                c["raw"].append(escape(data, quote=False))  # as in the page: only real tags are stripped later


#: Characters of a piece of a page (a batch of 10,000 pieces stays near 10 MB), characters given to the parser at once, rows in a batch that comes back.
PIECE, FEED, BATCH = 1 << 10, 1 << 16, 1 << 11
#: Characters that end a batch of fewer rows.
WIDE = 1 << 20
CELL = ("cls", "txt", "a", "i", "raw")


class _Page:
    """The rows of one page that comes in pieces. Full batches wait in a file until the page has ended: one that can't be parsed has no rows."""

    def __init__(self, key, kind: pa.DataType):
        self.key, self.kind, self.parser = key, kind, _Tables(self._full)
        self.pieces, self.size, self.broken = [], 0, False
        self.file = self.writer = None

    def feed(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)
        # What the parser could not end yet is read again each time; so it gets at least as much anew.
        if "<" in piece and self.size >= max(FEED, len(self.parser.rawdata)) and not self.broken:
            text = "".join(self.pieces)
            at = text.rindex("<")  # text and its character references stay whole
            self.pieces, self.size = [text[at:]], len(text) - at
            self._parse(text[:at])

    def _parse(self, text: str, last: bool = False) -> None:
        try:
            self.parser.feed(text)
            if last:
                self.parser.close()
        except (AssertionError, ValueError):
            self.broken = True
            return
        if last:
            self.parser.end_row()

    def _full(self) -> None:
        try:
            batch = self._batch(self.parser.rows)
            self.parser.rows, self.parser.size = [], 0
            if self.writer is None:
                self.file = tempfile.TemporaryFile()
                self.writer = pa.ipc.new_stream(self.file, batch.schema)
            self.writer.write_batch(batch)
        except ValueError as e:  # Arrow's errors are such; the page is not to pass for one that can't be parsed
            raise RuntimeError("a batch of rows could not be kept") from e

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        tables, places, classes, heads, tds = zip(*rows)
        ends = [0]
        for t in tds:
            ends.append(ends[-1] + len(t))
        cells = pa.StructArray.from_arrays([pa.array([c[k] for t in tds for c in t], pa.string()) for k in CELL], CELL)
        columns = [pa.array([self.key] * len(rows), self.kind), pa.array(tables, pa.int32()), pa.array(places, pa.int32()), pa.array(classes, pa.string()), pa.array(heads, pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)], ["key", "table_ord", "row_ord", "cls", "head", "tds"])

    def end(self) -> Iterator[pa.RecordBatch]:
        if not self.broken:
            self._parse("".join(self.pieces), last=True)
        self.parser.full = None  # so that the page goes as soon as it has been read
        if self.writer is not None:
            self.writer.close()
            if not self.broken:
                self.file.seek(0)
                yield from pa.ipc.open_stream(self.file)
            self.file.close()
        if self.parser.rows and not self.broken:
            yield self._batch(self.parser.rows)


def raw_rows(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per table row of each page (Arrow batches); header cells give `head`, the title of the class c2 column.

    Pages go to Python in pieces and come back in batches of rows and characters, so Python's memory follows neither a page's
    size nor their number; of their parts only a single row, or a text between two tags, is held whole.
    """
    kind = pages.schema[key].dataType.simpleString()
    pieces = F.regexp_extract_all("html", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    cut = pages.where("html <> ''").select(key, F.posexplode(pieces).alias("n", "piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, names = None, [key, "table_ord", "row_ord", "cls", "head", "tds"]
        for batch in batches:
            for k, n, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if n == 0:
                    if page:
                        yield from (b.rename_columns(names) for b in page.end())
                    page = _Page(k, batch.schema.types[0])
                page.feed(piece)
        if page:
            yield from (b.rename_columns(names) for b in page.end())

    return cut.mapInArrow(run, f"{key} {kind}, {ROWS}")


#: Part-of-speech marks (fixed values).
POS_MAP = {"i.": "noun", "f.": "verb", "s.": "adjective", "zf.": "adverb", "ünl.": "interjection", "edat": "preposition", "bağ.": "conjunction", "zm.": "pronoun"}


def pos_name(pos):
    """The English name of a part-of-speech mark; null for unknown ones."""
    pairs = [F.lit(x) for kv in POS_MAP.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), pos)


def _text(cell):
    return strip_u(F.coalesce(cell["a"], cell["txt"]))


def forward_rows(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """Senses of the first table: an example row belongs to the row right before it; then short, marked and unnamed rows go."""
    order = Window.partitionBy(key).orderBy("row_ord")
    r = rows.where("table_ord = 0").withColumn("next_cls", F.lead("cls").over(order)).withColumn("next_tds", F.lead("tds").over(order))
    example = F.filter("next_tds", lambda t: F.contains(t["cls"], F.lit("example-sentences")))
    cell = F.when(F.contains("next_cls", F.lit("example-sentences-row")), F.try_element_at(example, F.lit(1))["raw"])
    r = r.withColumn("ex", example_pair(F.coalesce(cell, F.lit(""))))
    skip = F.contains("cls", F.lit("example-sentences-row")) | F.contains("cls", F.lit("mobile-category-row"))
    td = lambda i: F.try_element_at("tds", F.lit(i + 1))
    r = r.where(~skip & (F.size("tds") >= 4)).withColumn("category", strip_u(td(1)["txt"])).where("category <> ''")
    pos = strip_u(td(2)["i"])
    return r.select(key, "row_ord", _text(td(2)).alias("en"), _text(td(3)).alias("tr"), "category", pos.alias("pos"), pos_name(pos).alias("pos_en"), "ex.example_en", "ex.example_tr")


def reverse_headwords(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """Distinct headwords per page, from the column that the header says is English, in every table."""
    column = F.when(F.contains("head", F.lit("ngilizce")), 2).when(F.contains("head", F.lit("ürkçe")), 3)
    r = rows.withColumn("col", column).where("col IS NOT NULL AND size(tds) >= 4")
    en = normal_word(without_notes(_text(F.try_element_at("tds", F.col("col") + 1))))
    return r.select(key, en.alias("en")).where(F.col("en").rlike(r"^[a-z][a-z\-']*$") & F.length("en").between(2, 25)).distinct()
