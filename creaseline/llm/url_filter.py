"""URL filter: rules first, then the ratio of two character language models.

Rules fit a host with its subdomains and the beginning of a path; the longest decides. The
addresses that rules accept and those that they reject train a Markov model of variable
order each: the chance of a character after up to four others is its count there, smoothed
by the chance after one character less, down to an even chance. An address without a rule
is accepted if its log-likelihood difference per character reaches a threshold. This is
calibrated on the addresses that rules decide: it is the one at which the shares of right
decisions among accepted and rejected ones add up to the most.

All counts are taken over all rows. Everything is a join or an aggregate over distinct
addresses and character sequences.

Nulls and addresses without ``://`` have an empty host and path, and so no rule; the models
judge them like any other text. Without examples of both kinds every difference is 0 and
the threshold too, so that addresses are accepted. Repeated rows count as often as they
occur and get equal verdicts. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.sources.workspace import settled

# The rules of the contract (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 4
SMOOTHING = 2.0
START, END = "\u0002", "\u0003"
BINS_PER_UNIT = 100
CLIP = 10.0


def with_site(pages: DataFrame) -> DataFrame:
    """Add host (A-Z in lower case) and path."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.substr("url", at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumn("host", F.coalesce(lower, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest fitting rule as a struct (verdict, rule), or null."""
    longest_first = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    named = lambda v, h, p: F.struct(F.lit(v).alias("verdict"), F.lit(h + p).alias("rule"))
    return F.coalesce(*(F.when(fits(h, p), named(v, h, p)) for v, h, p in longest_first))


def sequences(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """id, gram: each character of an address, and its end, with the characters before it."""
    padded = F.concat(F.lit(START * order), F.coalesce("url", F.lit("")), F.lit(END))
    places = F.sequence(F.lit(1), F.length(padded) - order)
    grams = F.transform(places, lambda i: F.substr(padded, i, F.lit(order + 1)))
    return urls.withColumn("gram", F.explode(grams))


def language_models(grams: DataFrame, order: int = ORDER, smoothing: float = SMOOTHING) -> DataFrame:
    """gram, gain: log-likelihood difference of its last character after the others.

    ``grams`` has each distinct gram with its count under either model, 0 included.
    """
    counts = [grams]
    for length in range(order, 0, -1):
        shorter = F.substr(F.col("gram"), F.length("gram") - length + 1)
        counts.append(counts[-1].groupBy(shorter.alias("gram")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    counts.reverse()  # by length of the gram, from 1
    totals = counts[0].agg(F.sum("good").alias("good_all"), F.sum("bad").alias("bad_all"), F.count("*").alias("chars"))
    chance = lambda n, all_, lower: (F.col(n) + smoothing * lower) / (F.col(all_) + smoothing)
    even = 1.0 / (F.col("chars") + 1)
    level = counts[0].crossJoin(F.broadcast(totals)).select(  # one row
        "gram", chance("good", "good_all", even).alias("p_good"), chance("bad", "bad_all", even).alias("p_bad")
    )
    for table in counts[1:]:
        table = table.withColumn("context", F.substr(F.col("gram"), F.lit(1), F.length("gram") - 1))
        table = table.withColumn("shorter", F.substr(F.col("gram"), F.lit(2)))
        contexts = table.groupBy("context").agg(F.sum("good").alias("good_all"), F.sum("bad").alias("bad_all"))
        level = level.withColumnRenamed("gram", "shorter")
        level = table.join(contexts, "context").join(level, "shorter").select(
            "gram",
            chance("good", "good_all", F.col("p_good")).alias("p_good"),
            chance("bad", "bad_all", F.col("p_bad")).alias("p_bad"),
        )
    return level.select("gram", (F.log("p_good") - F.log("p_bad")).alias("gain"))


def threshold(scored: DataFrame) -> float:
    """The difference from which on to accept, by the decided addresses."""
    place = F.round(F.greatest(F.least("score", F.lit(CLIP)), F.lit(-CLIP)) * BINS_PER_UNIT).cast("int")
    bins = scored.where("decided is not null").groupBy(place.alias("bin")).agg(
        F.sum(F.when(F.col("decided") == "allow", F.col("times")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("decided") == "block", F.col("times")).otherwise(0)).alias("bad"),
    )
    rows = sorted(tuple(r) for r in bins.collect())  # at most 2 * CLIP * BINS_PER_UNIT + 1
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return 0.0
    best, right, over, under = 0.0, -1.0, good, 0
    for at, (bin_, g, b) in enumerate(rows):
        if over / good + under / bad > right:
            before = rows[at - 1][0] if at else bin_ - 1
            best, right = (before + bin_) / 2 / BINS_PER_UNIT, over / good + under / bad
        over, under = over - g, under + b
    return best


def judged(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and score (null where the models were not asked)."""
    urls = pages.groupBy("url").agg(F.count("*").alias("times"))
    urls = with_site(urls).withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    urls = urls.select("url", "host", "path", "times", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("decided"))
    urls = settled(urls.withColumn("id", F.xxhash64("url")), "urls")

    times = lambda verdict: F.sum(F.when(F.col("decided") == verdict, F.col("times")).otherwise(0))
    grams = sequences(urls.select("id", "url", "decided", "times"))
    counts = settled(grams.groupBy("gram").agg(times("allow").alias("good"), times("block").alias("bad")), "url-grams")
    gains = settled(language_models(counts), "url-gains")
    both = counts.agg(F.sum("good") * F.sum("bad")).first()[0]
    gain = F.col("gain") if both else F.lit(0.0)
    scores = grams.select("id", "gram").join(gains, "gram").groupBy("id").agg(F.avg(gain).alias("score"))
    scored = settled(urls.join(scores, "id"), "url-scores")
    least = threshold(scored)

    verdict = F.coalesce("decided", F.when(F.col("score") >= least, F.lit("allow")).otherwise(F.lit("block")))
    scored = scored.select(F.col("url").alias("_url"), "host", "path", "rule", verdict.alias("verdict"), "score")
    table = pages.select("page_id", "url")
    return table.join(scored, table["url"].eqNullSafe(scored["_url"])).select(
        "page_id", "host", "path", "rule", "verdict", F.when(F.col("rule").isNull(), F.col("score")).alias("score")
    )

