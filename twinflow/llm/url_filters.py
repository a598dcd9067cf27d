"""URL filters by association rules.

Tokens of labelled URLs are the items of baskets; FP-growth finds sets that go
along with a bad label, pruned by support and confidence. Rules are matched by
an inverted index: a page's tokens join the rules' tokens, and a rule fires
when all of its tokens are there.

An explicit list of host and path rules goes before the mined ones. Null URLs
and URLs without ``://`` have an empty host and path and no tokens: they fit
no rule and are allowed. Repeated pages with one id are judged once per row of
the page table, as long as ids differ; equal ids with different URLs share the
union of their hits. Empty labels give no rules, and all is allowed.
"""

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow.llm.common import ascii_lower

# fixed values: the explicit list, (verdict, host, path)
LISTED = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BAD = "label=bad"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host labels, their parts, path parts and query names."""
    host, path = host_of(url), path_of(url)
    query = F.coalesce(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), F.lit(""))
    labels = F.split(host, r"\.")
    tokens = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.transform(F.flatten(F.transform(labels, lambda x: F.split(x, "-"))), lambda x: F.concat(F.lit("w:"), x)),
        F.transform(F.split(ascii_lower(path), r"[/._\-]+"), lambda x: F.concat(F.lit("p:"), x)),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1))),
    )
    return F.array_distinct(F.filter(tokens, lambda x: F.length(x) > 2))


def mine_rules(
    pages: DataFrame,
    labels: DataFrame,
    support: float = 0.002,
    confidence: float = 0.8,
    most_tokens: int = 4,
    least_rows: int = 10,
) -> DataFrame:
    """Rules ``rule_id, tokens, n_tokens, confidence`` that point at a bad label.

    ``labels`` has ``page_id`` and boolean ``bad``. A set of tokens is kept
    when the bad pages that hold it are at least ``support`` of all labelled
    ones and ``least_rows``, and ``confidence`` of those with the set. Rules that contain
    another rule add nothing and go; so do sets over ``most_tokens``.
    """
    known = labels.where("bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    rows = pages.select("page_id", tokens_of(F.col("url")).alias("tokens")).where("size(tokens) > 0")
    rows = rows.join(known, "page_id")
    items = F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens"))
    support = max(support, least_rows / max(1, rows.count()))
    if support > 1:  # fewer labelled pages than a rule needs
        support = 1.0
        items = F.array(F.lit("none"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(rows.select(items.alias("items")))
    found = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD))
    found = found.where((F.size("antecedent") <= most_tokens) & (F.size("antecedent") > 0))
    found = found.select(
        F.array_join(F.array_sort("antecedent"), " ").alias("rule_id"),
        F.array_sort("antecedent").alias("tokens"),
        F.size("antecedent").alias("n_tokens"),
        "confidence",
    )
    # a shorter rule inside a longer one shares a token with it
    index = found.select("rule_id", "tokens", "n_tokens", F.explode("tokens").alias("token"))
    wider = index.alias("a").join(index.alias("b"), "token").where("b.n_tokens < a.n_tokens")
    wider = wider.where(F.size(F.array_intersect("a.tokens", "b.tokens")) == F.col("b.n_tokens"))
    return found.join(wider.select(F.col("a.rule_id").alias("rule_id")).distinct(), "rule_id", "left_anti")


def listed(host: Column, path: Column, rules=LISTED) -> Column:
    """Struct ``rule, verdict`` of the longest listed rule that fits, else null."""
    fits = [
        (
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    first, *rest = fits
    return reduce(lambda out, x: out.when(*x), rest, F.when(*first))


def judge(pages: DataFrame, labels: DataFrame, rules=LISTED, **mining) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined``: one row per page row."""
    mined = mine_rules(pages, labels, **mining).select("rule_id", "n_tokens", F.explode("tokens").alias("token"))
    own = pages.select("page_id", tokens_of(F.col("url")).alias("tokens"))
    hits = own.select("page_id", F.explode("tokens").alias("token")).distinct().join(mined, "token")
    hits = hits.groupBy("page_id", "rule_id").agg(F.count("*").alias("n"), F.first("n_tokens").alias("of"))
    hits = hits.where("n = of").groupBy("page_id").agg(F.min("rule_id").alias("mined"))
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("_l", listed(F.col("host"), F.col("path"), rules)).join(hits, "page_id", "left")
    by_rules = F.when(F.col("mined").isNotNull(), "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", F.col("_l.rule").alias("rule"),
        F.coalesce(F.col("_l.verdict"), by_rules).alias("verdict"), "mined",
    )
