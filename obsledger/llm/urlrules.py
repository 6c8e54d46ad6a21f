"""URL filtering by given rules and by association rules mined from labels.

Spark's FP-growth mines token combinations of labelled URLs that hold the label; rules under the support or the
confidence are pruned, and so are those that a shorter rule implies. URLs meet rules through an inverted index: a rule
stands under its rarest token only, and who meets it there is checked for all its tokens. Explicit rules come
first; the longest one that fits wins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.llm.common import fresh
from obsledger.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "verdict=block"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest of the (verdict, ``host/path``) rules that fits, and its verdict; both null if none does.

    A rule fits its host and all subdomains of it, if the path starts with the rule's path.
    """
    named, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for judged, rule in sorted(rules, key=lambda r: len(r[1])):  # the last that fits wins
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        named, verdict = F.when(fits, rule).otherwise(named), F.when(fits, judged).otherwise(verdict)
    return named, verdict


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url: scheme, host labels with their distance from the end, words of the path, names of query fields."""
    labels = F.reverse(F.split(host, r"\."))
    by_label = F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit("="), x))
    words = F.filter(F.split(path, r"[/._\-]+"), lambda x: x != "")
    # numbers in a path tell pages apart, not kinds of pages
    by_word = F.transform(words, lambda x: F.concat(F.lit("p="), F.regexp_replace(x, "[0-9]+", "#")))
    fields = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit("[?&]([^=&#]*)"), F.lit(1))
    scheme = F.array(F.concat(F.lit("s="), F.substring_index(F.coalesce(url, F.lit("")), "://", 1)))
    scheme = F.when(F.instr(url, "://") > 0, scheme).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(scheme, F.filter(by_label, lambda x: ~F.endswith(x, F.lit("="))), by_word,
                                     F.transform(fields, lambda x: F.concat(F.lit("q="), x))))


def mine(labelled: DataFrame, support: float = 0.002, confidence: float = 0.5, most: int = 4, sure: float = 4.0,
         token: str = "tokens", bad: str = "bad") -> DataFrame:
    """(rule_id, tokens, rule_support, rule_confidence) of pruned rules "tokens imply bad".

    ``labelled`` holds token arrays and a 0/1 label. A combination must hold in ``support`` of all labelled rows together
    with the label, its rows be bad in ``confidence`` of the cases and more often than a rule with fewer of its tokens
    tells; and the lower bound of that share (Wilson, ``sure`` standard deviations) must lie above the share of bad rows
    among all, so that chance makes no rules. FP-growth runs on the bad rows (combinations that are rare there cannot reach the support), and one join counts the
    combinations in all rows, so the label is no item of its own. Without labelled or bad rows there are no rules.
    """
    from pyspark.ml.fpm import FPGrowth
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "rule_id long, tokens array<string>, rule_support double, rule_confidence double")
    rows = cut_lineage(labelled.select(F.monotonically_increasing_id().alias("row"), F.col(token).alias("items"), F.col(bad).alias("bad"))
                       .where(F.col("bad").isNotNull() & (F.size("items") > 0)))
    n, n_bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    if not n or not n_bad:
        return empty
    least = max(2, math.ceil(support * n))
    if n_bad < least:
        return empty
    grown = FPGrowth(itemsCol="items", minSupport=least / n_bad, minConfidence=0.0).fit(rows.where("bad = 1").select("items"))
    sets = grown.freqItemsets.where(F.size("items") <= most).select(
        F.array_sort("items").alias("tokens"), F.col("freq").alias("with_bad"))
    sets = cut_lineage(sets.withColumn("rule_id", F.monotonically_increasing_id()))
    counted = matches(rows.select("row", "items"), sets, "items").groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))
    p, m, z2 = F.col("with_bad") / F.col("n"), F.col("n"), sure * sure
    wilson = (p + z2 / (2 * m) - sure * F.sqrt(p * (1 - p) / m + z2 / (4 * m * m))) / (1 + z2 / m)
    rules = cut_lineage(sets.join(counted, "rule_id").withColumn("rule_confidence", p)
                        .where((F.col("rule_confidence") >= confidence) & (wilson > n_bad / n)))
    # a rule that a shorter one implies with as much confidence says nothing new
    shorter = rules.select(F.col("tokens").alias("less"), F.col("rule_confidence").alias("c"))
    parts = rules.select("rule_id", "rule_confidence", F.explode(F.transform(
        "tokens", lambda x: F.array_remove(F.col("tokens"), x))).alias("less"))
    implied = parts.join(shorter, "less").where("c >= rule_confidence").select("rule_id").distinct()
    return rules.join(implied, "rule_id", "left_anti").select(
        "rule_id", "tokens", (F.col("with_bad") / n).alias("rule_support"), "rule_confidence")


def matches(rows: DataFrame, rules: DataFrame, token: str) -> DataFrame:
    """(row, rule_id) for every rule (rule_id, tokens) whose tokens all are among the row's array ``token``."""
    counts = rows.select(F.explode(token).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("c"))
    rarest = rules.select("rule_id", "tokens", F.explode("tokens").alias("t")).join(counts, "t", "left").groupBy("rule_id").agg(
        F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), F.col("t").alias("t")))["t"].alias("t"), F.first("tokens").alias("wanted"))
    # rows with the same tokens are checked once; rules are few, and the join is left to Spark's own size check
    kinds = rows.select(F.array_sort(token).alias("kind")).distinct()
    held = kinds.select("kind", F.explode("kind").alias("t")).join(rarest, "t").where(
        F.size(F.array_except("wanted", "kind")) == 0).groupBy("kind").agg(F.collect_list("rule_id").alias("ids"))
    return rows.withColumn("kind", F.array_sort(token)).join(held, "kind").select("row", F.explode("ids").alias("rule_id"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], support: float = 0.002, confidence: float = 0.5,
          page_id: str = "page_id", url: str = "url", label_id: str = "doc_id") -> DataFrame:
    """(page_id, host, path, rule, verdict, n_mined) of every row of ``pages``.

    A page is labelled bad if a label of its id says toxic 1 or quality 0 (labels without an id, or without both values, are
    ignored). rule is the longest explicit rule that fits and gives the verdict; else a page is blocked if a mined
    rule matches (n_mined of them do), and allowed if none does. Null urls and urls without ``://`` have an empty host and path, no
    tokens and the verdict allow. Repeated rows get equal results. No rows give no rows.
    """
    address = pages[url].cast("string")
    host, path = host_path(address)
    base = cut_lineage(pages.select(pages[page_id].alias("page_id"), address.alias("url"), host.alias("host"), path.alias("path"))
                       .withColumn("tokens", tokens(F.col("host"), F.col("path"), F.col("url")))
                       .withColumn("row", F.monotonically_increasing_id()))
    said = labels.where(labels[label_id].isNotNull() & (F.col("toxic").isNotNull() | F.col("quality").isNotNull())).groupBy(
        labels[label_id].alias("i")).agg(F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)).alias("bad"))
    mined = mine(base.join(said, base["page_id"] == said["i"]).select("tokens", "bad"), support, confidence)
    found = matches(base.select("row", "tokens"), mined, "tokens").groupBy("row").agg(F.count(F.lit(1)).alias("n_mined"))
    named, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = base.join(found, "row", "left").withColumn("n_mined", F.coalesce("n_mined", F.lit(0)).cast("long"))
    return judged.select("page_id", "host", "path", named.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("n_mined") > 0, "block").otherwise("allow")).alias("verdict"), "n_mined")
