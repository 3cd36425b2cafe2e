"""URL filters: fixed host and path rules, then association rules mined from the URLs those rules label."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit import scale
from panelkit.llm.common import sized, written

#: Fixed rules: verdict, host, path. A rule fits its host and all subdomains below its path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))

#: Share of all URLs a token combination must reach.
MIN_SUPPORT = 0.005
#: Share of the URLs with a combination that must carry the label.
MIN_CONFIDENCE = 0.7

#: Marks the item that stands for a row's verdict.
VERDICT = "\x00"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null; equal lengths go to the rule listed first."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = out.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels, path segments and query keys; digits stand for any number."""
    plain = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    tagged = lambda tag, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(tag), plain(x)))
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda kv: F.regexp_extract(kv, "(?s)^([^=]*)", 1))
    scheme = F.array(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    return F.array_distinct(F.concat(tagged("s:", scheme), tagged("h:", F.split(host, "[.]")),
                                     tagged("p:", F.split(path, "/")), tagged("q:", keys)))


@dataclass(frozen=True)
class Mined:
    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: float


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) from rows (tokens, verdict or null), a table.

    Spark's FP-growth mines the frequent sets of whole baskets: all tokens of a row that are frequent under a
    verdict, and its verdict as one more item. Support and confidence are shares of all rows, labelled or not, so a
    token common outside the labelled rows cannot carry a verdict. A rule is dropped when one with fewer of its tokens is as
    confident. Tokens that stand in exactly the same rows would make every set of them frequent; they are mined as one
    and put back into the rules afterwards.
    """
    spark = labelled.sparkSession
    rows = written(labelled.select(F.monotonically_increasing_id().alias("id"), "verdict", F.array_distinct("tokens").alias("tokens")))
    n = rows.count()
    empty = spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double")
    least = max(1, math.ceil(min_support * n))
    each = rows.select("id", "verdict", F.explode("tokens").alias("t"))
    frequent = written(each.where("verdict is not null").groupBy("t", "verdict").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") >= least).select("t").distinct())
    if frequent.isEmpty():
        return empty
    held = each.join(sized(frequent), "t")
    # equal sums of two hashes over the rows of a token: the same rows
    marks = held.groupBy("t").agg(*[F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"h{i}") for i in range(2)], F.count(F.lit(1)).alias("n"))
    alike = written(marks.groupBy("h0", "h1", "n").agg(F.array_sort(F.collect_list("t")).alias("members")).select(
        F.col("members")[0].alias("t"), "members"))
    baskets = written(held.join(sized(alike.select("t")), "t").groupBy("id", "verdict").agg(F.collect_list("t").alias("items")).select(
        F.when(F.col("verdict").isNull(), F.col("items")).otherwise(F.concat("items", F.array(F.concat(F.lit(VERDICT), "verdict")))).alias("items")))
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / baskets.count())).fit(baskets).freqItemsets
    tag = F.filter("items", lambda x: F.startswith(x, F.lit(VERDICT)))
    sets = written(found.select(F.array_sort(F.filter("items", lambda x: ~F.startswith(x, F.lit(VERDICT)))).alias("set"),
                                F.substring(F.get(tag, 0), len(VERDICT) + 1, 1 << 20).alias("verdict"), "freq").where(F.size("set") > 0))
    counted = sets.where("verdict is not null").join(sets.where("verdict is null").select("set", F.col("freq").alias("n")), "set")
    sure = written(counted.select("set", "verdict", F.col("freq").alias("c"), (F.col("freq") / F.col("n")).alias("sure")))
    # the most confident part of each set, from one length to the next; every part of a frequent set is frequent
    best = written(sure.where(F.size("set") == 1).withColumn("best", F.lit(-1.0)))
    kept, size = [best], 1
    while not best.isEmpty():
        size += 1
        below = best.select(F.col("set").alias("sub"), "verdict", F.greatest("sure", "best").alias("b"))
        parts = sure.where(F.size("set") == size).select("*", F.explode(F.transform("set", lambda t: F.array_remove("set", t))).alias("sub"))
        best = written(parts.join(below, ["sub", "verdict"]).groupBy("set", "verdict").agg(
            F.first("c").alias("c"), F.first("sure").alias("sure"), F.max("b").alias("best")))
        kept.append(best)
    rules = kept[0]
    for more in kept[1:]:
        rules = rules.unionByName(more)
    rules = written(rules.where((F.col("sure") >= min_confidence) & (F.col("sure") > F.col("best"))).select(
        F.col("set").alias("tokens"), "verdict", F.col("sure").alias("confidence"), (F.col("c") / n).alias("support")))
    several = sized(alike.where(F.size("members") > 1).select(F.col("t").alias("_t"), "members"))
    for i in range(max(0, size - 1) if not alike.where(F.size("members") > 1).isEmpty() else 0):
        token = F.try_element_at("tokens", F.lit(i + 1))
        options = F.explode(F.coalesce("members", F.array(token)))
        rules = rules.withColumn("_t", token).join(several, "_t", "left").select("*", options.alias("_o")).select(
            F.when(F.col("_t").isNull(), F.col("tokens")).otherwise(
                F.transform("tokens", lambda x, at: F.when(at == i, F.col("_o")).otherwise(x))).alias("tokens"), "verdict", "confidence", "support")
    return rules.withColumn("tokens", F.array_sort("tokens"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> list[Mined]:
    """The rules of ``mined_rules`` as a list in the driver, for small tables."""
    found = mined_rules(labelled, min_support, min_confidence).collect()
    return [Mined(tuple(r["tokens"]), r["verdict"], r["confidence"], r["support"]) for r in found]


def match(rows: DataFrame, mined: list[Mined] | DataFrame, default: str = "allow") -> DataFrame:
    """Adds ``mined`` and ``mined_verdict``: the most confident rule whose tokens the row all has.

    An inverted index holds each rule under one of its tokens; a row looks its tokens up and checks the rest
    of the rules it meets. Ties go to more tokens, then to block, then to the smaller token list. Without a
    match the verdict is ``default``. ``rows`` needs ``tokens``.
    """
    if not isinstance(mined, DataFrame):
        mined = rows.sparkSession.createDataFrame([(list(m.tokens), m.verdict, m.confidence) for m in mined],
                                                  "tokens array<string>, verdict string, confidence double")
    index = written(mined.select(F.monotonically_increasing_id().alias("id"), F.col("tokens").alias("needs"),
                                 F.col("verdict").alias("found"), "confidence"))
    each = index.select("id", F.explode("needs").alias("t"))
    rarest = each.join(each.groupBy("t").agg(F.count(F.lit(1)).alias("k")), "t").groupBy("id").agg(F.min(F.struct("k", "t")).alias("m"))
    index = index.join(rarest, "id").select(F.col("m.t").alias("lead"), "needs", "found", "confidence")
    keys = [c for c in rows.columns if c != "tokens"]
    # a row number parts equal rows; the rows of one number are neighbours, so sums inside the task shrink them to one
    seen = rows.withColumn("_row", F.monotonically_increasing_id()).select(
        "*", F.explode(F.concat(F.col("tokens"), F.array(F.lit("")))).alias("lead"))
    # a small index is sent to all, a large one is joined by lead with hot tokens dealt apart; the row's own entry has no rule
    hits = scale.lookup_join(seen, index, ["lead"]).where(
        (F.col("lead") == "") | (F.size(F.array_except("needs", "tokens")) == 0)).select(
        "_row", *keys, F.coalesce("needs", F.array().cast("array<string>")).alias("needs"),
        F.coalesce("found", F.lit(default)).alias("found"), F.coalesce("confidence", F.lit(-1.0)).alias("confidence"))
    best = F.max(F.struct("confidence", F.size("needs").alias("k"), (F.col("found") == "block").alias("b"),
                          F.concat_ws(" ", "needs").alias("mined"), F.col("found").alias("v")))
    return (hits.groupBy("_row", *keys).agg(best.alias("_b"))
            .select(*keys, F.nullif(F.col("_b.mined"), F.lit("")).alias("mined"), F.col("_b.v").alias("mined_verdict")))


def judge(pages: DataFrame, rules=RULES, **mining) -> DataFrame:
    """Host, path, fitting fixed rule and verdict of every page (needs page_id, url).

    URLs with a fixed rule are the labelled ones; FP-growth mines token combinations from all URLs with
    those labels, and URLs without a rule get the verdict of the best mined rule they match, or allow. Null
    URLs and URLs without ``://`` have empty host and path and no tokens, so they are allowed. Repeated
    rows are judged each. An empty table gives no rows; extra columns are left out.
    """
    url = F.col("url")
    rows = pages.select("page_id", "url", host(url).alias("host"), path(url).alias("path"))
    rows = rows.withColumn("_f", fixed_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("_f.rule").alias("rule"), F.col("_f.verdict").alias("_fixed"),
        tokens(url, F.col("host"), F.col("path")).alias("tokens"))
    mined = mined_rules(rows.select("tokens", F.col("_fixed").alias("verdict")), **mining)
    return match(rows, mined).select("page_id", "host", "path", "rule",
                                     F.coalesce("_fixed", "mined_verdict").alias("verdict"),
                                     F.when(F.col("rule").isNull(), F.col("mined")).alias("mined"))
