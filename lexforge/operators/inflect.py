"""Inflected forms by rule, and maps from forms to lemmas.

Own rules for regular forms and a small table of irregular ones (fixed values); no claim of equality with any library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts of speech to tags, and the tags of words without any (fixed values).
TAGS = {"noun": ("NNS",), "verb": ("VBD", "VBG", "VBZ", "VBN"), "adjective": ("JJR", "JJS"), "adverb": ("RBR", "RBS")}
FALLBACK = ("NNS", "VBD", "VBG", "VBZ", "VBN")
#: lemma, tag -> form
IRREGULAR = {
    ("run", "VBD"): "ran", ("run", "VBN"): "run", ("go", "VBD"): "went", ("go", "VBN"): "gone", ("be", "VBD"): "was", ("be", "VBN"): "been", ("be", "VBZ"): "is",
    ("have", "VBD"): "had", ("have", "VBN"): "had", ("have", "VBZ"): "has", ("do", "VBD"): "did", ("do", "VBN"): "done", ("say", "VBD"): "said", ("say", "VBN"): "said",
    ("make", "VBD"): "made", ("make", "VBN"): "made", ("take", "VBD"): "took", ("take", "VBN"): "taken", ("see", "VBD"): "saw", ("see", "VBN"): "seen", ("get", "VBD"): "got", ("get", "VBN"): "got",
    ("man", "NNS"): "men", ("woman", "NNS"): "women", ("child", "NNS"): "children", ("foot", "NNS"): "feet", ("tooth", "NNS"): "teeth", ("mouse", "NNS"): "mice", ("goose", "NNS"): "geese",
    ("good", "JJR"): "better", ("good", "JJS"): "best", ("bad", "JJR"): "worse", ("bad", "JJS"): "worst", ("well", "RBR"): "better", ("well", "RBS"): "best",
}


def tags_of(pos: Column) -> Column:
    """Array of part-of-speech names to inflection tags; those of nouns and verbs when none applies."""
    pairs = [x for k, v in TAGS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    found = F.array_distinct(F.flatten(F.filter(F.transform(F.coalesce(pos, F.array().cast("array<string>")), lambda p: F.try_element_at(F.create_map(*pairs), p)), lambda a: a.isNotNull())))
    return F.when(F.size(found) > 0, found).otherwise(F.array(*map(F.lit, FALLBACK)))


def regular(word: Column, tag: Column) -> Column:
    sibilant, cy, e = word.rlike("(s|x|z|ch|sh)$"), word.rlike("[^aeiou]y$"), word.endswith("e")
    stem = F.substring(word, F.lit(1), F.length(word) - 1)
    double = word.rlike("^[^aeiou]*[aeiou][bdgmnprt]$")
    base = F.when(double, F.concat(word, F.substring(word, -1, 1))).otherwise(word)
    s = F.when(sibilant, F.concat(word, F.lit("es"))).when(cy, F.concat(stem, F.lit("ies"))).otherwise(F.concat(word, F.lit("s")))
    add = lambda end: F.when(e, F.concat(stem, F.lit(end))).when(cy, F.concat(stem, F.lit("i" + end))).otherwise(F.concat(base, F.lit(end)))
    ing = F.when(e & ~word.rlike("(ee|oe|ye)$"), F.concat(stem, F.lit("ing"))).otherwise(F.concat(base, F.lit("ing")))
    return F.when(tag.isin("NNS", "VBZ"), s).when(tag.isin("VBD", "VBN"), add("ed")).when(tag == "VBG", ing).when(tag.isin("JJR", "RBR"), add("er")).otherwise(add("est"))


def variants(word: Column, pos: Column) -> Column:
    """Distinct lower-case forms longer than one letter that differ from the word."""
    odd = F.create_map(*[x for (w, t), f in IRREGULAR.items() for x in (F.lit(f"{w}/{t}"), F.lit(f))])
    forms = F.transform(tags_of(pos), lambda t: F.lower(F.coalesce(F.try_element_at(odd, F.concat(word, F.lit("/"), t)), regular(word, t))))
    return F.sort_array(F.array_distinct(F.filter(forms, lambda f: (F.length(f) > 1) & (f != word))))


def lemma_lists(words: DataFrame) -> DataFrame:
    """words: w, word_ord, variants. variant, lemmas: all lemmas of a form, in headword order."""
    v = words.select("w", "word_ord", F.explode("variants").alias("variant"))
    s = F.array_sort(F.collect_list(F.struct("word_ord", "w")))
    return v.groupBy("variant").agg(F.transform(s, lambda x: x["w"]).alias("lemmas"))


def first_lemma(words: DataFrame) -> DataFrame:
    """variant, w: the first lemma in headword order, for forms that are no headword themselves."""
    v = words.select("w", "word_ord", F.explode("variants").alias("variant"))
    return v.groupBy("variant").agg(F.min_by("w", "word_ord").alias("w")).join(words.select(F.col("w").alias("variant")), "variant", "left_anti")


def with_roots(words: DataFrame, forms: DataFrame | None = None) -> DataFrame:
    """Headwords that are forms of others get those as roots. forms: w, word_ord, variants of the same words, where that is cheaper to make."""
    forms = words if forms is None else forms
    return words.join(lemma_lists(forms).select(F.col("variant").alias("w"), F.col("lemmas").alias("roots")), "w", "left")
