"""Entries as markup; one implementation with a style, columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexforge.functions.text import html_escape, or_empty, strip_u

#: Categories that get no label (fixed values).
NOISE = ("yaygın kullanım", "genel", "")


#: Shades of labels, examples and their translations; quote marks and arrow of examples (fixed values).
LABEL, EXAMPLE, FAINT = "#555", "#666", "#888"
OPEN, CLOSE, ARROW = "&#8220;", "&#8221;", "&#8594; "


def shown(senses: DataFrame) -> DataFrame:
    """Senses to render: blank translations and repeats of (part of speech, category, translation) go; `label` marks the first of a category."""
    s = senses.repartition("en").withColumn("tr", strip_u(or_empty(F.col("tr")))).where("tr <> ''")
    s = s.withColumn("p", strip_u(F.coalesce(F.nullif("pos_en", F.lit("")), F.nullif("pos", F.lit("")), F.lit("")))).withColumn("cat", strip_u(or_empty(F.col("category"))))
    s = s.withColumn("_c", F.lower("cat")).withColumn("_t", F.lower("tr"))
    # One sort serves both windows: the category is the first part of the other's key after the headword.
    first = Window.partitionBy("en", "_c", "p", "_t").orderBy("sense_ord")
    s = s.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    own = F.struct("sense_ord", "p", "_t")
    return s.withColumn("label", (own == F.min(own).over(Window.partitionBy("en", "_c"))) & ~F.col("_c").isin(*NOISE)).drop("_c", "_t")


def paragraph(style: str = "rich", examples: bool = True) -> Column:
    """One sense. style `rich` has grey spans, `plain` has none."""
    grey = lambda c, shade: F.concat(F.lit(f'<span style="color:{shade}">'), c, F.lit("</span>")) if style == "rich" else c
    ex, tr = strip_u(or_empty(F.col("example_en"))), strip_u(or_empty(F.col("example_tr")))
    parts = [
        F.when(F.col("p") != "", F.concat(F.lit("<i>"), html_escape(F.col("p")), F.lit("</i>"))),
        F.when(F.col("label"), grey(F.concat(F.lit("["), html_escape(F.col("cat")), F.lit("]")), LABEL)),
        F.concat(F.lit("<b>"), html_escape(F.col("tr")), F.lit("</b>")),
    ]
    if examples:
        parts += [F.when(ex != "", F.concat(F.lit("<br/>"), grey(F.concat(F.lit(OPEN), html_escape(ex), F.lit(CLOSE)), EXAMPLE)))]
        parts += [F.when((ex != "") & (tr != ""), F.concat(F.lit("<br/>"), grey(F.concat(F.lit(ARROW), html_escape(tr)), FAINT)))]
    return F.concat(F.lit("<p>"), F.concat_ws(" ", *parts), F.lit("</p>"))


def bodies(senses: DataFrame, style: str = "rich", examples: bool = True) -> DataFrame:
    """en, body: the paragraphs of a headword in sense order; word_ord: its first sense rendered."""
    p = shown(senses).withColumn("html", paragraph(style, examples))
    s = F.array_sort(F.collect_list(F.struct("sense_ord", "html")))
    return p.groupBy("en").agg(F.array_join(F.transform(s, lambda x: x["html"]), "").alias("body"), F.min("sense_ord").alias("word_ord"))


def places(senses: DataFrame) -> DataFrame:
    """en, word_ord of bodies() without rendering: a sense that is not blank is shown or repeats an earlier one."""
    return senses.where(strip_u(or_empty(F.col("tr"))) != "").groupBy("en").agg(F.min("sense_ord").alias("word_ord"))


def bucket_entry(anchor: Column, main: Column, forms: Column, defs: Column, roots: Column | None = None) -> Column:
    """An entry of the bucketed package; empty definitions give an empty entry."""
    name = F.when(anchor == main, html_escape(main)).otherwise(F.concat(html_escape(main), F.lit(", "), html_escape(anchor)))
    var = F.array_join(F.transform(F.sort_array(forms), lambda v: F.concat(F.lit('<variant name="'), html_escape(v), F.lit('"/>'))), "")
    line = F.lit("")
    if roots is not None:
        line = F.when((anchor == main) & (F.size(roots) > 0), F.concat(F.lit(f'<p><span style="color:{FAINT}">kök: '), F.array_join(F.transform(roots, lambda r: F.concat(F.lit("<b>"), html_escape(r), F.lit("</b>"))), ", "), F.lit("</span></p>"))).otherwise("")
    out = F.concat(F.lit('<w><a name="'), html_escape(anchor), F.lit('" /><div><b>'), name, F.lit("</b><var>"), var, F.lit("</var><br/>"), line, defs, F.lit("</div></w>"))
    return F.when(or_empty(defs) == "", "").otherwise(out)


def reader_entry(number: Column, word: Column, defs: Column, forms: Column) -> Column:
    """An entry of the reader package with its inflection group."""
    forms_ = F.array_join(F.transform(F.sort_array(forms), lambda v: F.concat(F.lit('<idx:iform value="'), html_escape(v), F.lit('"/>'))), "")
    group = F.when(F.size(forms) > 0, F.concat(F.lit("<idx:infl>"), forms_, F.lit("</idx:infl>"))).otherwise("")
    head = F.concat(F.lit('<idx:orth value="'), html_escape(word), F.lit('"><b>'), html_escape(word), F.lit("</b>"), group, F.lit("</idx:orth>"))
    return F.concat(F.lit('<idx:entry name="default" scriptable="yes" spell="yes"><idx:short><a id="w'), number.cast("string"), F.lit('"></a>'), head, defs, F.lit("</idx:short></idx:entry><hr/>"))
