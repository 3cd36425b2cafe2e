"""Quality rules: repetition counts, and distance of a text's histograms from those of its language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit import scale
from panelkit.llm.common import written

#: Frequent words of English, German, French and Spanish prose.
COMMON_WORDS = """the of and to in a is that it for was on are as with be by this from at have not but they his or
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er
le la les de des du et un une en que qui dans pour par sur au avec est pas plus ce il sont ne se
el los las del y con por una su para lo como más pero sus o sin sobre este ya entre cuando todo""".split()
_WORD_SET = list(dict.fromkeys(COMMON_WORDS))
#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: The white space that parts words.
BREAKS = r"[\x20\x09-\x0D]+"
#: Character classes in the order of the histograms; what is left over is the class of other characters.
CLASSES = {"lower": "[^a-z]+", "upper": "[^A-Z]+", "digit": "[^0-9]+", "accented": r"[^\p{L}&&[^a-zA-Z]]+"}
N_CLASSES = len(CLASSES) + 3

#: A reference needs as many words; a smaller language has no distance.
MIN_REFERENCE_WORDS = 2_000
#: A text needs as many words for the character distance, and as many common words for the word distance.
MIN_WORDS = 50
MIN_COMMON = 20
#: Jensen-Shannon distances (0 to 1) above which a text is rejected.
MAX_CLASS_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.75


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def measures(docs: DataFrame) -> DataFrame:
    """Counts and histograms of every whole text, one row per document, without a shuffle.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes (counts in the order of
    CLASSES, then white space, symbols, other) and commons (word, count). Null text counts as empty.
    """
    t = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", "lang", t.alias("text")).select(
        "doc_id", "lang", "text",
        F.filter(F.split("text", BREAKS), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.length(_without(x, " \t\n\x0b\f\r")) > 0).alias("lines"))
    text = F.col("text")
    spaceless, symbols = F.length(_without(text, " \t\n\x0b\f\r")), F.length(text) - F.length(_without(text, SYMBOLS))
    counted = [F.length(F.regexp_replace(text, F.lit(p), F.lit(""))).cast("long") for p in CLASSES.values()]
    # every 3-word window as (hash, place), sorted, so that equal windows stand together
    windows = F.when(F.size("words") >= 3, F.sort_array(F.transform(
        F.slice("words", 1, F.size("words") - 2),
        lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("h"),
                              i.alias("i"))))).otherwise(F.array())
    is_common = F.filter(F.transform("words", lambda w: F.lower(w)), lambda w: w.isin(_WORD_SET))
    base = base.select(
        "doc_id", "lang", "words", F.size("words").cast("long").alias("n_words"),
        spaceless.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length("text").cast("long").alias("_chars"), F.array(*counted).alias("_counted"),
        windows.alias("_windows"), F.sort_array(is_common).alias("_commons"))

    def same(a: Column, b: Column) -> Column:
        """Two sorted windows hold the same words: equal hashes, then the words themselves."""
        words = [F.get("words", a["i"] + k).eqNullSafe(F.get("words", b["i"] + k)) for k in range(3)]
        return (a["h"] == b["h"]) & words[0] & words[1] & words[2]

    n_win = F.size("_windows")
    twice = F.filter("_windows", lambda x, j: F.when(j > 0, same(x, F.get("_windows", j - 1))).otherwise(False)
                     | F.when(j + 1 < n_win, same(x, F.get("_windows", j + 1))).otherwise(False))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    ends = F.filter(F.transform("_commons", lambda w, j: F.struct(w.alias("w"), j.alias("j"))),
                    lambda x: ~x["w"].eqNullSafe(F.get("_commons", x["j"] + 1)))
    base = base.select("*", places.alias("_places"), ends.alias("_ends"))
    covered = F.aggregate(
        F.transform("_places", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_places", j + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda s, x: s + x)
    commons = F.transform("_ends", lambda e, j: F.struct(
        e["w"].alias("word"), (e["j"] - F.coalesce(F.get("_ends", j - 1)["j"], F.lit(-1))).cast("long").alias("n")))
    known = F.aggregate("_counted", F.lit(0).cast("long"), lambda s, x: s + x)
    blank = F.col("_chars") - F.col("word_chars")
    classes = F.concat("_counted", F.array(blank, F.col("n_symbols"),
                                           F.col("_chars") - known - blank - F.col("n_symbols")))
    return base.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       covered.alias("n_repeat_words"), classes.alias("classes"), commons.alias("commons"))


def references(measured: DataFrame, min_words: int = MIN_REFERENCE_WORDS) -> DataFrame:
    """Histograms of each language over all its documents: lang (null: the pooled one), p_class, p_word.

    One row for each language of at least ``min_words`` words, however many there are. Documents are summed
    inside each task first; a task sends one row per language and common word.
    """
    # per language first (few rows), then the pool is the sum of the languages
    sums = measured.groupBy("lang").agg(
        F.sum("n_words").alias("n"), *[F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(N_CLASSES)])
    counts = (measured.select("lang", F.explode("commons").alias("e")).groupBy("lang", F.col("e.word").alias("word"))
              .agg(F.sum("e.n").alias("n")))
    large = sums.where(F.col("lang").isNotNull() & (F.col("n") >= min_words))
    pooled = sums.agg(*[F.sum(c).alias(c) for c in sums.columns[1:]]).select(F.lit(None).cast("string").alias("lang"), "*")
    total = sum((F.col(f"c{k}") for k in range(1, N_CLASSES)), F.col("c0"))
    shares = F.array(*[F.coalesce(F.col(f"c{k}") / F.nullif(total, F.lit(0)), F.lit(0.0)) for k in range(N_CLASSES)])
    classes = large.unionByName(pooled).select("lang", shares.alias("p_class"))
    by_word = counts.join(large.select("lang"), "lang").unionByName(
        counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "word", "n"))
    shares = by_word.groupBy("lang").agg(F.sum("n").alias("_all"), F.collect_list(F.struct("word", "n")).alias("_w"))
    shares = shares.select("lang", F.map_from_entries(F.transform(
        "_w", lambda e: F.struct(e["word"], e["n"] / F.col("_all")))).alias("p_word"))
    return classes.join(shares, classes["lang"].eqNullSafe(shares["lang"]), "left").select(
        classes["lang"], "p_class", F.coalesce("p_word", F.expr("cast(map() as map<string,double>)")).alias("p_word"))


def _half(p: Column, q: Column) -> Column:
    """p log2(2p / (p + q)), 0 where p is 0."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + x)


def judge(measured: DataFrame, reference: DataFrame, min_words: int = MIN_WORDS, min_common: int = MIN_COMMON,
          max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Adds class_distance, word_distance (null below the minimum lengths), base_failed and kept."""
    own = reference.where("lang is not null").select("lang", F.col("p_class").alias("_pc"), F.col("p_word").alias("_pw"))
    pool = reference.where("lang is null").agg(F.first(F.struct("p_class", "p_word")))  # one row, a scalar for all
    d = scale.lookup_join(measured, own, ["lang"]).withColumn("_pool", pool.scalar())
    # only texts of unknown language are held against the pool; a known one without a reference has no distance
    unknown = F.col("lang").isNull()
    d = d.select("*", F.when(unknown, F.col("_pool.p_class")).otherwise(F.col("_pc")).alias("_rc"),
                 F.when(unknown, F.col("_pool.p_word")).otherwise(F.col("_pw")).alias("_rw"),
                 _all(F.col("classes")).alias("_n"), F.aggregate("commons", F.lit(0).cast("long"),
                                                                 lambda s, e: s + e["n"]).alias("_m"))
    pairs = F.arrays_zip(F.transform("classes", lambda c: c / F.col("_n")).alias("p"), F.col("_rc").alias("q"))
    by_class = _sum(F.transform(pairs, lambda x: (_half(x["p"], x["q"]) + _half(x["q"], x["p"])) / 2))
    # words the text lacks add q / 2 each: half of 1 minus the reference share of the words it has
    zipped = F.transform("commons", lambda e: F.struct(
        (e["n"] / F.col("_m")).alias("p"), F.coalesce(F.col("_rw")[e["word"]], F.lit(0.0)).alias("q")))
    by_word = (_sum(F.transform(zipped, lambda x: (_half(x["p"], x["q"]) + _half(x["q"], x["p"])) / 2))
               + (1 - _sum(F.transform(zipped, lambda x: x["q"]))) / 2)
    root = lambda x: F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))
    d = d.select(
        *measured.columns,
        F.when(F.col("_rc").isNotNull() & (F.col("n_words") >= min_words) & (F.col("_n") > 0), root(by_class)).alias("class_distance"),
        F.when(F.col("_rw").isNotNull() & (F.col("n_words") >= min_words) & (F.col("_m") >= min_common), root(by_word)).alias("word_distance"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = (F.coalesce(F.col("class_distance") > max_class, F.lit(False))
           | F.coalesce(F.col("word_distance") > max_word, F.lit(False)))
    return d.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)


def _all(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)


def quality(docs: DataFrame, **limits) -> DataFrame:
    """Quality measures and verdict of every document (needs doc_id, text, lang).

    One pass over the texts writes the counts; the language references are sums of those counts over all
    documents, and each text is compared with its language's by the Jensen-Shannon distance (root of the
    divergence, base 2) of character classes and of common words. Rows of null language are compared
    with the pooled reference; a language with too few words for a reference gives no distance. Null and empty texts have no words and fail the base rule;
    repeated rows are judged each; ties do not arise; an empty table gives no rows; extra columns are
    left out. All of it is column functions.
    """
    measured = written(measures(docs))
    return judge(measured, references(measured), **limits)
