"""Rules on whole texts, and the divergence of a text from its language.

Of each text the shares of seven character classes, and of the common words of
its language among all words, are compared with the shares over all texts of
that language that pass the rules, by the Jensen-Shannon distance (base 2, 0 to
1).  Texts too short for such a share to mean something are not compared.

Defined results: a null or empty text has no words and fails the base rules;
texts of a language without enough references, null included, are not compared;
repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, free_name, saved, text_digest

WORD = r"[^\x20\x09-\x0D]+"
#: Common words by language.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "that", "is", "as", "on", "are"],
    "fr": ["de", "la", "le", "les", "et", "des", "en", "un", "du", "que"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "ist", "sich"],
}
#: Character classes removed one after the other; what is left are symbols.
CLASSES = {"lower": "[a-z]+", "space": r"[\x20\x09-\x0D]+", "wide": r"[^\x00-\x7F]+", "upper": "[A-Z]+", "digit": "[0-9]+", "point": r"""[.,;:'"()?!-]+"""}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Guards and limits of the comparison.
MIN_CHARS_COMPARED, MIN_WORDS_COMPARED, MIN_REFERENCE_WORDS = 200, 100, 2000
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.32, 0.25


def paired(a: Column, b: Column) -> Column:
    """One hash of two."""
    return F.xxhash64(a, b)


def repeated_words(words: Column, trigrams: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    ``trigrams`` are the hashes of the windows in order.  Sorted with their
    places, equal windows are neighbours, which is confirmed on the words; a
    text in which two different windows share a hash is sorted by the words
    themselves.  Each marked window then adds the words that the next marked one
    does not cover.
    """
    none = F.array().cast("array<bigint>")

    def equal_neighbours(s: Column) -> Column:
        """Places of both ends of each pair of equal neighbours."""
        pairs = F.arrays_zip(F.slice(s, 1, F.size(s) - 1).alias("a"), F.slice(s, 2, F.size(s)).alias("b"))
        equal = F.filter(pairs, lambda e: e["a"]["h"] == e["b"]["h"])
        return F.transform(equal, lambda e: F.struct(e["a"]["i"].alias("a"), e["b"]["i"].alias("b")))

    def same(p: Column, q: Column) -> Column:
        return (words[p] == words[q]) & (words[p + 1] == words[q + 1]) & (words[p + 2] == words[q + 2])

    def marked(pairs: Column) -> Column:
        return F.sort_array(F.array_distinct(F.flatten(F.transform(pairs, lambda e: F.array(e["a"], e["b"])))))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)

    # Arrays of one: each value is computed once.
    once = lambda value, body: F.transform(F.array(value), body)[0]
    hashed = F.sort_array(F.transform(trigrams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    spelled = F.sort_array(F.transform(trigrams, lambda h, i: F.struct(F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i"))))
    exact = lambda pairs: F.when(F.forall(pairs, lambda e: same(e["a"], e["b"])), marked(pairs)).otherwise(marked(once(spelled, equal_neighbours)))
    found = once(once(once(hashed, equal_neighbours), exact), covered)
    return F.when(F.size(F.array_distinct(F.coalesce(trigrams, none))) == F.size(trigrams), 0).otherwise(found)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, lang, the base measures, ``classes`` and ``common``: counts by character class and by common word (the last: all else)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), text.alias("t"))
    df = df.withColumn("words", F.regexp_extract_all("t", F.lit(WORD), F.lit(0))).withColumn("n_words", F.size("words").cast("long"))
    n, words = F.size("words"), F.col("words")
    df = df.withColumn("hashes", F.transform(words, lambda w: F.xxhash64(w)))
    upto = F.greatest(n - 2, F.lit(0))
    nth = lambda i: F.slice("hashes", i, upto)
    grams = F.zip_with(F.zip_with(nth(1), nth(2), paired), nth(3), paired)
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD))
    listed = F.when(F.lit(False), F.array().cast("array<string>"))
    for lang, known in COMMON.items():
        listed = listed.when(F.col("lang") == lang, F.array(*map(F.lit, known)))
    df = df.withColumn("grams", grams).withColumn("lines", lines).withColumn("known", listed)
    df = df.withColumn("n_repeat_words", repeated_words(words, F.col("grams")).cast("long"))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    every = sorted(set().union(*COMMON.values()))
    df = df.withColumn("hits", F.filter("words", lambda w: w.isin(every)))
    counts = F.transform("known", lambda k: (F.size("hits") - F.size(F.array_remove("hits", k))).cast("long"))
    df = df.withColumn("counts", F.when(F.col("known").isNotNull(), counts))
    listed_words = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn("common", F.when(F.col("known").isNotNull(), F.concat("counts", F.array(F.col("n_words") - listed_words))))
    rest, sizes = "t", []
    for name, pattern in CLASSES.items():
        df = df.withColumn(f"r_{name}", F.regexp_replace(rest, pattern, ""))
        sizes.append((F.char_length(rest) - F.char_length(f"r_{name}")).cast("long"))
        rest = f"r_{name}"
    symbols = F.char_length("r_digit") - F.char_length(F.regexp_replace("r_digit", r"[#*$%&|<>]+", ""))
    return df.select(
        "doc_id", "lang", "n_words", (F.char_length("t") - sizes[1]).cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
        "n_dup_lines", "n_repeat_words", F.array(*sizes, F.char_length(rest).cast("long")).alias("classes"), "common",
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(F.array(total), lambda n: F.transform(counts, lambda x: F.when(n > 0, x / F.greatest(n, F.lit(1))).otherwise(F.lit(0.0))))[0]


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    side = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    parts = F.zip_with(p, q, lambda x, y: side(x, (x + y) / 2) + side(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2))


def references(measured: DataFrame) -> DataFrame:
    """(lang, ref_words, ref_classes, ref_common) over all texts that pass the base rules: one row a language."""
    sums = lambda c, n: F.array(*(F.sum(F.get(F.col(c), F.lit(i))) for i in range(n)))
    width = max(map(len, COMMON.values())) + 1
    total = measured.filter(~base_failed()).groupBy("lang").agg(
        F.sum("n_words").alias("ref_words"), sums("classes", len(CLASSES) + 1).alias("c"), sums("common", width).alias("w")
    )
    return total.select("lang", "ref_words", shares(F.col("c")).alias("ref_classes"), shares(F.filter("w", lambda x: x.isNotNull())).alias("ref_common"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", with_lang: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, base_failed, kept, class_distance and word_distance (null where not compared); lang if asked for."""
    measured = saved(measures(docs, id_col, text_col, lang_col), "measures")
    refs = broadcast_if_small(references(measured).withColumnRenamed("lang", "ref_lang"))
    both = measured.join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    enough = F.col("ref_words") >= MIN_REFERENCE_WORDS
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    both = both.withColumn("class_distance", F.when(enough & (chars >= MIN_CHARS_COMPARED), distance(shares(F.col("classes")), F.col("ref_classes"))))
    both = both.withColumn(
        "word_distance",
        F.when(enough & (F.col("n_words") >= MIN_WORDS_COMPARED) & F.col("common").isNotNull(), distance(shares(F.col("common")), F.col("ref_common"))),
    )
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    return both.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & ~far).alias("kept"), "class_distance", "word_distance", *(["lang"] if with_lang else []),
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass.  The verdict depends on text and language only, so rows are told by these, not by their id."""
    key, lang = free_name(docs, "gl_id"), free_name(docs, "gl_lang")
    told = docs.select(text_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    bad = quality_rules(told, "digest", "text", "lang", with_lang=True).filter("not kept").select(F.col("doc_id").alias(key), F.col("lang").alias(lang)).distinct()
    same = (text_digest(docs[text_col]) == F.col(key)) & docs[lang_col].eqNullSafe(F.col(lang))
    return docs.join(broadcast_if_small(saved(bad, "bad")), same, "left_anti")
