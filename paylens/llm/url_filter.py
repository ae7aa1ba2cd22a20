"""URL filter: rules first, then a character language-model ratio
(DataFrame functions only).

Rules name a host and a path prefix.  The urls they allow and block train two
variable-order Markov models over characters: counts of up to ``ORDER``
characters of context, smoothed by interpolation with the next shorter
context (Witten-Bell), down to a uniform alphabet.  A url's score is the
difference of its log-likelihoods per character.  The threshold is the score
that parts the allowed from the blocked urls best (largest difference of their
cumulative shares); urls that no rule fits are allowed from it on.

Counts are by page, over every page.  Defined results: a null url, or one
without "://", has an empty host and path and is scored as an empty string;
without allowed or without blocked pages the threshold is 0; repeated rows are
judged alike and count as often as they stand; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylens.llm.common import saved

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))
ORDER = 4
ALPHABET = 256.0
START, END = "\x02", "\x03"
BINS = 200  # per unit of score


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first "://" up to "/", "?" or "#", lower-cased; then up to "?" or "#"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def fits(rule: str, host: Column, path: Column) -> Column:
    """Whether the rule's host is the url's or a parent of it, and its path leads the url's."""
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def ruled(urls: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """``urls`` with host, path, rule (the longest that fits) and said (its verdict)."""
    host, path = url_parts(F.col("url"))
    rows = urls.withColumns({"host": host, "path": path})
    longest = sorted(rules, key=lambda r: -len(r[0]))
    pick = [F.when(fits(rule, F.col("host"), F.col("path")), F.struct(F.lit(rule).alias("rule"), F.lit(v).alias("said")))
            for rule, v in longest]
    none = F.lit(None).cast("struct<rule:string,said:string>")
    return rows.withColumn("_rule", F.coalesce(*pick, none)).select(*rows.columns, "_rule.rule", "_rule.said")


def grams(order: int = ORDER) -> Column:
    """Every character of host and path with the ``order`` before it."""
    chars = F.split(F.concat(F.lit(START * order), F.col("host"), F.col("path"), F.lit(END)), "")
    chars = F.array_remove(chars, "")
    cut = F.transform(F.array(chars), lambda c: F.transform(
        F.sequence(F.lit(1), F.size(c) - order), lambda i: F.array_join(F.slice(c, i, order + 1), "")))
    return cut[0]


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, ratio: log of its last character's probability after the others,
    allowed over blocked.  counts: gram, allow, block."""
    lower = None
    for k in range(order + 1):
        level = (counts.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("gram"))
                 .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
        # at most one row per character of the alphabet stands in a context
        context = Window.partitionBy(F.substring("gram", 1, k)) if k else Window.partitionBy()
        kinds = ("allow", "block")
        level = level.withColumns({f"{c}_{what}": F.sum(value).over(context) for c in kinds for what, value in (
            ("all", F.col(c)), ("kinds", (F.col(c) > 0).cast("long")))})
        level = level.withColumn("back", F.substring("gram", 2, k))
        if lower is None:
            level = level.withColumns({f"p_{c}": F.lit(1 / ALPHABET) for c in kinds})
        else:
            level = level.join(lower.withColumnRenamed("gram", "back"), "back")
        level = level.select("gram", *[
            F.when(F.col(f"{c}_all") == 0, F.col(f"p_{c}")).otherwise(
                (F.col(c) + F.col(f"{c}_kinds") * F.col(f"p_{c}")) / (F.col(f"{c}_all") + F.col(f"{c}_kinds"))).alias(f"p_{c}")
            for c in kinds])
        lower = level
    return lower.select("gram", (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The score that parts allowed from blocked best.  The scores go into bins
    (the range of a log-ratio per character bounds their number)."""
    bins = (scored.filter("said is not null").groupBy(F.floor(F.col("score") * BINS).alias("bin"))
            .agg(*[F.sum(F.when(F.col("said") == c, F.col("pages")).otherwise(0)).alias(c) for c in ("allow", "block")]))
    every = Window.partitionBy()
    below = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)

    def share(c: str) -> Column:
        return F.coalesce(F.sum(c).over(below), F.lit(0)) / F.sum(c).over(every)

    cut = bins.select("bin", (share("block") - share("allow")).alias("gain")).filter("gain is not null")
    best = cut.orderBy(F.desc("gain"), F.abs("bin"), "bin").first()  # a row
    return best["bin"] / BINS if best else 0.0


def url_filter(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page."""
    urls = pages.groupBy("url").agg(F.count("*").alias("pages"))
    urls = saved(ruled(urls, rules), "urls")
    pieces = urls.select("url", "pages", "said", F.explode(grams(order)).alias("gram"))
    counts = pieces.groupBy("gram").agg(*[
        F.sum(F.when(F.col("said") == c, F.col("pages")).otherwise(0)).alias(c) for c in ("allow", "block")])
    ratios = saved(log_ratios(saved(counts, "grams"), order), "ratios")
    lines = urls.select(F.xxhash64("host", "path").alias("key"), F.explode(grams(order)).alias("gram"))
    # urls with the same host and path share a key and a score: a mean over all their characters
    # a merge join: Spark would take the exploded rows for as small as the urls' file and broadcast them
    scores = lines.join(ratios.hint("merge"), "gram").groupBy("key").agg(F.avg("ratio").alias("score"))
    scored = saved(urls.withColumn("key", F.xxhash64("host", "path")).join(scores, "key"), "scored")
    limit = threshold(scored)
    verdict = F.coalesce(F.col("said"), F.when(F.col("score") >= limit, "allow").otherwise("block"))
    judged = scored.select(F.col("url").alias("_url"), "host", "path", "rule", verdict.alias("verdict"), "score")
    rows = pages.select("page_id", "url")
    return rows.join(judged, F.col("url").eqNullSafe(F.col("_url"))).select(
        "page_id", "host", "path", "rule", "verdict", "score")
