"""Quality classifier by hierarchical empirical Bayes.

A document's own evidence is a sum of log-likelihood ratios over a few binned traits of
its text (symbols, capitals, repeated words and lines, word length, vocabulary), counted
over all labelled documents. Its chance of being good under the global prior is then summed
per host and per path by grouped aggregation. Variances within and between sites set how
much a host is shrunk toward the global rate, and a path toward its host: a site with few
documents says little. A document is judged by its evidence together with the rate of its
path, the document itself left out of it.

In ``documents`` the source stands for the host and the language for the path below it.

Nulls: null text is empty; null hosts and paths are sites of their own; labels without an
id or without a quality are not used, and an id with several labels counts with each.
Repeated rows are documents of their own. Without labels of both kinds the evidence is 0,
and without any label the rates are 1/2: such documents are kept. Empty tables give no
rows. Further columns are carried along by ``kept_documents`` and else not read.
"""

from __future__ import annotations

import math
from operator import eq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.mixing import same
from creaseline.sources.workspace import settled

# Traits with the upper bounds of their bins; the last bin is open.
BINS = {
    "symbols": (0.005, 0.01, 0.02, 0.03, 0.045, 0.06, 0.08, 0.12, 0.2, 0.3),
    "capitals": (0.001, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6),
    "echoes": (0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "lines": (0.1, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9, 0.99),
    "word_bytes": (3, 4, 4.5, 5, 5.5, 6, 6.5, 7, 8, 9, 12),
    "variety": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8),
}
ADDED = 1.0  # to each bin's count
MOST_GAIN = 4.0  # of one trait, either way
EDGE = 0.02  # rates stay so far from 0 and 1
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'\"-")
CAPITALS = bytes(range(65, 91))
ORDINARY_WORDS = 1000
ORDINARY_BYTES = 5.5
ADDED_WORDS = 10
ADDED_LINES = 3


def traits_of(text: str | None) -> tuple[float, ...]:
    """The traits in the order of BINS; 0, but 1 for shares of distinct things, without words."""
    raw = (text or "").encode("utf8", "surrogatepass")
    words = raw.split()
    if not words:
        return 0.0, 0.0, 0.0, 1.0, 0.0, 1.0
    filled = sum(map(len, words))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    echoes = sum(map(eq, words, words[1:]))
    lines = [line for line in raw.split(b"\n") if line]
    # The vocabulary of long texts repeats itself: it is compared with what stretches of equal length hold.
    stretches = [words[at : at + ORDINARY_WORDS] for at in range(0, len(words), ORDINARY_WORDS)]
    variety = sum(len(set(s)) for s in stretches)
    # A few ordinary words and lines more keep short texts from looking odd.
    n = len(words) + ADDED_WORDS
    line_share = (len(set(lines)) + ADDED_LINES) / (len(lines) + ADDED_LINES)
    word_bytes = (filled + ADDED_WORDS * ORDINARY_BYTES) / n
    return symbols / filled, capitals / filled, echoes / n, line_share, word_bytes, (variety + ADDED_WORDS) / n


TRAITS_SCHEMA = ", ".join(f"{name} double" for name in BINS)


def traits(text: str) -> Column:
    @F.pandas_udf(TRAITS_SCHEMA)
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([traits_of(t) for t in texts], columns=list(BINS), dtype=float)

    return measured(text)


def bin_of(name: str) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, BINS[name])).cast("array<double>"), lambda x: x <= F.col(f"_traits.{name}")))


def gain_tables(marked: DataFrame) -> dict[str, list[float]]:
    """Log-likelihood ratio of good against bad of every bin; ``marked`` has _traits and quality."""
    marked = marked.where("quality in (0, 1)")
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("trait"), bin_of(n).alias("bin")) for n in BINS)))
    counts = marked.select("quality", pairs.alias("x")).groupBy("x.trait", "x.bin").agg(
        F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")
    )
    found = {(r[0], r[1]): (r[2], r[3]) for r in counts.collect()}  # one row per bin
    tables = {}
    for name, bounds in BINS.items():
        rows = [found.get((name, k), (0, 0)) for k in range(len(bounds) + 1)]
        good, bad = sum(r[0] for r in rows), sum(r[1] for r in rows)
        even = ADDED * len(rows)
        gain = lambda g, b: math.log((g + ADDED) / (good + even)) - math.log((b + ADDED) / (bad + even))  # noqa: B023, E731
        tables[name] = [max(-MOST_GAIN, min(MOST_GAIN, gain(g, b))) if good and bad else 0.0 for g, b in rows]
    return tables


def evidence_of(tables: dict[str, list[float]]) -> Column:
    parts = [F.element_at(F.array(*map(F.lit, gains)), bin_of(name) + 1) for name, gains in tables.items()]
    return sum(parts[1:], parts[0])


def logit(rate: Column) -> Column:
    inside = F.greatest(F.lit(EDGE), F.least(F.lit(1 - EDGE), rate))
    return F.log(inside / (1 - inside))


def chance(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def shrinkage(groups: DataFrame, n: str, s: str, ss: str, centre: Column) -> Column | float:
    """Documents that the prior of a level is worth: variance within over variance between its groups."""
    row = groups.agg(
        F.count("*"), F.sum(n), F.sum(F.col(n) * F.col(n) * 1.0),
        F.sum(F.col(ss) - F.col(s) * F.col(s) / F.col(n)), F.sum(F.col(n) * (F.col(s) / F.col(n) - centre) ** 2),
    ).first()
    count, total, squares, inside, between = (float(x or 0) for x in row)
    if total <= count or count < 2:
        return 1.0
    within = max(inside / (total - count), 1e-6)
    spread = (between - (count - 1) * within) / max(total - squares / total, 1.0)
    return min(1e6, within / spread) if spread > 0 else 1e6


def site_rates(scored: DataFrame, host: str, path: str) -> tuple[DataFrame, float]:
    """host, path, host_rate, path_rate, _n, _s, and the strength of a path's prior.

    ``scored`` has the chance of each document under the global prior in column _p.
    """
    sums = (F.count("*").alias("_n"), F.sum("_p").alias("_s"), F.sum(F.col("_p") * F.col("_p")).alias("_ss"))
    paths = settled(scored.groupBy(host, path).agg(*sums), "quality-paths")
    hosts = paths.groupBy(host).agg(*(F.sum(c).alias(f"{c}h") for c in ("_n", "_s", "_ss")))
    total = hosts.agg(F.sum("_sh"), F.sum("_nh")).first()
    centre = (total[0] or 0.0) / total[1] if total[1] else 0.5
    host_weight = shrinkage(hosts, "_nh", "_sh", "_ssh", F.lit(centre))
    host_rate = (F.lit(host_weight * centre) + F.col("_sh")) / (F.lit(host_weight) + F.col("_nh"))
    sites = same(paths, hosts.select(host, host_rate.alias("host_rate")), [host])
    path_weight = shrinkage(sites, "_n", "_s", "_ss", F.col("host_rate"))
    path_rate = (path_weight * F.col("host_rate") + F.col("_s")) / (path_weight + F.col("_n"))
    return settled(sites.withColumn("path_rate", path_rate), "quality-sites"), path_weight


def judged(rows: DataFrame, tables: dict, sites: DataFrame, path_weight: float, prior: float, host: str, path: str) -> DataFrame:
    """Add evidence, host_rate, path_rate, quality and kept to rows that have _traits."""
    rows = rows.withColumn("evidence", evidence_of(tables))
    own = chance(F.col("evidence") + F.lit(prior))
    rows = same(rows, sites.select(host, path, "host_rate", "path_rate", "_n", "_s"), [host, path])
    others = (path_weight * F.col("host_rate") + F.col("_s") - own) / (path_weight + F.col("_n") - 1)
    rows = rows.withColumn("quality", chance(F.col("evidence") + logit(others)))
    return rows.withColumn("kept", F.col("quality") >= 0.5).drop("_n", "_s", "_traits")


def fitted(docs: DataFrame, labels: DataFrame, host: str, path: str):
    """What ``judged`` needs, and the documents with their traits but without their texts."""
    table = settled(docs.select("doc_id", host, path, traits("text").alias("_traits")), "quality-traits")
    marks = labels.where("doc_id is not null").select("doc_id", "quality")
    marked = table.join(marks, "doc_id")
    tables = gain_tables(marked)
    rate = marks.where("quality in (0, 1)").agg(F.avg("quality")).first()[0]
    rate = 0.5 if rate is None else min(1 - EDGE, max(EDGE, rate))
    prior = math.log(rate / (1 - rate))
    scored = table.withColumn("_p", chance(evidence_of(tables) + F.lit(prior)))
    sites, path_weight = site_rates(scored, host, path)
    return table, (tables, sites, path_weight, prior, host, path)


def quality_scores(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """doc_id, host, path, evidence, host_rate, path_rate, quality (chance) and kept."""
    table, model = fitted(docs, labels, host, path)
    return judged(table, *model)


def kept_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The documents that are kept, each row judged by its own text."""
    _, model = fitted(docs, labels, host, path)
    names = [c for c in docs.columns if c not in ("text", host, path)]
    plain = docs.select(*(F.col(c).alias(f"_in_{c}") for c in names), "text", host, path)
    rows = judged(plain.withColumn("_traits", traits("text")), *model).where("kept")
    return rows.select(*(F.col(f"_in_{c}" if c in names else c).alias(c) for c in docs.columns))
