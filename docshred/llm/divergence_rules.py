"""Quality rules by distribution divergence (DataFrame functions only).

Every language has two reference distributions, taken from all its documents:
the shares of character classes, and the shares of its common words (words that
make up at least ``common_share`` of the language's words, so there are at most
1/share of them, whatever their length) with one bucket for all other words.  A document whose own distribution is farther from its language's
reference than a limit (Jensen-Shannon distance, base 2, 0 to 1) is rejected.  A
document shorter than a distribution's least length is not judged by it.

Every language with at least ``min_reference_chars`` code points of text has a
reference of its own, whatever its share of the documents.  Documents of a
language with less text, or of none (null), are not judged by divergence.  Null
text has no words.  Repeated rows are judged alike; a null id stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import BROADCAST_KEYS, stored

# Separators, symbols and the character classes, each counted in
# what the classes before it have left.
SEPARATOR = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
CLASSES = (("lower", "[a-z]+"), ("space", SEPARATOR), ("letter", r"[\p{L}\p{M}&&[^A-Z]]+"), ("upper", "[A-Z]+"),
           ("stop", r"[.,;:!?'\"()-]+"), ("digit", r"\p{N}+"))
WINDOW = 5
# End of fixed values.


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SEPARATOR), lambda w: w != "")


def _with_classes(rows: DataFrame) -> DataFrame:
    """``_words``, ``_joined`` (all words as one text), ``_marks`` (what of it is no lower
    letter) and ``_classes`` (code points of each class, and of no class) beside ``_text``.

    Separators are what the joined words lack of the text; the other classes are taken
    from what the class before has left."""
    rows = rows.withColumn("_words", _words(F.col("_text"))).withColumn("_joined", F.array_join("_words", ""))
    (lower, pattern), others = CLASSES[0], [c for c in CLASSES[1:] if c[0] != "space"]
    rows = rows.withColumn("_marks", F.regexp_replace("_joined", pattern, ""))
    counts = {lower: F.length("_joined") - F.length("_marks"), "space": F.length("_text") - F.length("_joined")}
    left = F.col("_marks")
    for name, pattern in others:
        rest = F.regexp_replace(left, pattern, "")
        counts[name] = F.length(left) - F.length(rest)
        left = rest
    return rows.withColumn("_classes", F.array(*(counts[name].cast("double") for name, _ in CLASSES),
                                               F.length(left).cast("double")))


def _repeat_windows(words: Column) -> Column:
    """Hash of every window of five words, by place."""
    m = F.size(words) - (WINDOW - 1)
    return F.when(m < 1, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.slice(words, 1, m), lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WINDOW)))))


def _covered(windows: Column) -> Column:
    """Sum over the repeated windows' positions of the words each adds."""
    m = F.size(windows)
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    both = F.zip_with(F.slice(ordered, 1, m - 1), F.slice(ordered, 2, m - 1),
                      lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    at = F.sort_array(F.array_distinct(F.flatten(both)))
    start = F.struct(F.lit(-WINDOW).alias("end"), F.lit(0).cast("bigint").alias("n"))
    total = F.aggregate(at, start, lambda s, i: F.struct(
        i.alias("end"), (s["n"] + F.least(F.lit(WINDOW), i - s["end"])).alias("n")), lambda s: s["n"])
    return F.when(F.size(F.array_distinct(windows)) == m, F.lit(0).cast("bigint")).otherwise(total)


def base_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The base counts of every document, with its words and class counts for
    the divergence (narrow, one pass)."""
    t = F.col("_text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                       F.col(lang_col).alias("_lang"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = _with_classes(rows).select(
        "doc_id", "_lang", "_words", lines.alias("_lines"), "_classes", F.length("_joined").cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("_marks", SYMBOLS, "")).cast("bigint").alias("n_symbols"))  # no symbol is a lower letter
    rows = rows.withColumns({"n_words": F.size("_words").cast("bigint"),
                             "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
                             "_windows": _repeat_windows(F.col("_words"))})
    rows = rows.withColumn("n_repeat_words", _covered(F.col("_windows")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.drop("_windows", "_lines").withColumn("base_failed", failed)


def language_references(docs: DataFrame, min_reference_chars: int, common_share: float,
                        text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per language with enough text (key, common words, their shares,
    class counts), each of at most 1/common_share words; marked for broadcast
    while there are few, else Spark chooses the join by size."""
    rows = docs.select(F.col(lang_col).alias("_key"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).where(
        F.col("_key").isNotNull())
    classes = [f"c{k}" for k in range(len(CLASSES) + 1)]
    sizes = _with_classes(rows).select("_key", F.col("_classes").alias("c"), F.size("_words").alias("w")).groupBy("_key").agg(
        F.sum("w").alias("w"), *(F.sum(F.col("c")[k]).alias(name) for k, name in enumerate(classes)))
    sizes = stored(sizes.where(sum(map(F.col, classes)) >= min_reference_chars).select(
        "_key", "w", F.array(*classes).alias("c")), "languages")
    few = F.broadcast if sizes.count() <= BROADCAST_KEYS else (lambda df: df)
    words = rows.select("_key", F.explode(_words(F.col("_text"))).alias("word")).groupBy("_key", "word").agg(
        F.count("*").alias("n"))
    common = words.join(few(sizes.select("_key", "w")), "_key").where(F.col("n") >= common_share * F.col("w"))
    common = common.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct(
        "word", (F.col("n") / F.col("w")).alias("share")))).alias("common"))
    return few(sizes.join(common, "_key", "left").select(
        "_key", F.coalesce(F.col("common.word"), F.array().cast("array<string>")).alias("_common"),
        F.coalesce(F.col("common.share"), F.array().cast("array<double>")).alias("_shares"),
        F.col("c").alias("_class_total")))


def _normalised(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.transform(counts, lambda x: x / F.greatest(total, F.lit(1.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares of equal length."""
    def part(a, m):
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def judge(docs: DataFrame, class_limit: float = 0.3, word_limit: float = 0.35, min_chars: int = 200,
          min_words: int = 60, min_reference_chars: int = 10_000, common_share: float = 0.01,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, both distances (null below the least length, or without a
    reference) and the verdict."""
    refs = language_references(docs, min_reference_chars, common_share, text_col, lang_col)
    rows = base_measures(docs, id_col, text_col, lang_col).withColumnRenamed("_lang", "_key")
    rows = rows.join(refs, "_key", "left")
    hits = F.transform("_common", lambda c: (F.size("_words") - F.size(F.array_remove(F.col("_words"), c))).cast("double"))
    rows = rows.withColumn("_hits", hits)
    known = F.aggregate("_hits", F.lit(0.0), lambda s, x: s + x)
    mine = F.transform(F.concat("_hits", F.array(F.col("n_words") - known)),
                       lambda x: x / F.greatest(F.col("n_words"), F.lit(1)))
    theirs = F.concat("_shares", F.array(1 - F.aggregate("_shares", F.lit(0.0), lambda s, x: s + x)))
    chars = F.aggregate("_classes", F.lit(0.0), lambda s, x: s + x)
    rows = rows.withColumns({
        "class_distance": F.when((chars >= min_chars) & F.col("_class_total").isNotNull(), js_distance(
            _normalised(F.col("_classes")), _normalised(F.col("_class_total")))),
        "word_distance": F.when((F.col("n_words") >= min_words) & (F.size("_common") > 0), js_distance(mine, theirs))})
    near = (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= class_limit) & \
           (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= word_limit)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & near).alias("kept"), "class_distance", "word_distance")
