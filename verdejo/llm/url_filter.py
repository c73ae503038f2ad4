"""URL filter: host and path rules first, boosted trees on lexical features for the rest.

Defined cases: a null url, or one without ``://``, has an empty host and path, no rule and the
lexical features of an empty text. Repeated rows give repeated results; null ids are kept. When
the labelled urls show one class only, or there are none, the method answers ``allow``.
Only the two named columns are read, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kit import Scratch

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed rules: (allow or block, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

LEXICAL = ("length", "host_length", "path_length", "depth", "labels", "digit_rate", "hyphens", "entropy", "parameters",
           "has_fragment", "has_extension", "top_rate", "domain_rate")


@dataclass(frozen=True)
class Learning:
    """The trees are fitted on at most about ``rows`` labelled urls, chosen by a hash; suffix statistics use all of them."""
    rows: int = 50_000
    trees: int = 16
    depth: int = 4
    seed: int = 5


def parts(df: DataFrame) -> DataFrame:
    """Adds host, path and the tail after the path (query and fragment)."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    df = df.withColumn("_rest", rest)
    host = F.regexp_extract("_rest", r"^[^/?#]*", 0)
    df = df.withColumn("_host", host).withColumn("_after", F.substring(F.col("_rest"), F.length("_host") + 1, F.length("_rest")))
    path = F.regexp_extract("_after", r"^[^?#]*", 0)
    return (df.withColumn("host", F.translate("_host", CAPITALS, SMALL)).withColumn("path", path)
            .withColumn("_tail", F.substring(F.col("_after"), F.length("path") + 1, F.length("_after"))).drop("_rest", "_host", "_after"))


def decided(rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none fits. Rules become one CASE WHEN, so keep the list short."""
    rule = answer = None
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        answer = F.when(fits, verdict) if answer is None else answer.when(fits, verdict)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule.otherwise(F.lit(None).cast("string")), answer.otherwise(F.lit(None).cast("string"))


def lexical(df: DataFrame) -> DataFrame:
    """Features of the url text, and its two suffixes: the last host label and the last two."""
    url = F.coalesce(F.col("url"), F.lit(""))
    labels = F.split("host", r"\.")
    letters = F.filter(F.split(url, ""), lambda c: c != "")
    n = F.greatest(F.length(url), F.lit(1))
    shares = F.transform(F.array_distinct(letters), lambda c: F.size(F.array_remove(letters, c)))
    entropy = F.aggregate(shares, F.lit(0.0), lambda a, without: a - (n - without) / n * F.log2((n - without) / n))
    return df.select(
        "*", F.length(url).alias("length"), F.length("host").alias("host_length"), F.length("path").alias("path_length"),
        F.size(F.filter(F.split("path", "/"), lambda x: x != "")).alias("depth"), F.size(labels).alias("labels"),
        (F.regexp_count(url, F.lit(r"[0-9]")) / n).alias("digit_rate"), F.regexp_count(F.col("host"), F.lit(r"[-_]")).alias("hyphens"),
        entropy.alias("entropy"),
        F.when(F.col("_tail").startswith("?"), F.size(F.split(F.regexp_extract("_tail", r"^\?([^#]*)", 1), "&"))).otherwise(0).alias("parameters"),
        F.col("_tail").contains("#").cast("int").alias("has_fragment"), F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int").alias("has_extension"),
        F.element_at(labels, -1).alias("_top"), F.substring_index("host", ".", -2).alias("_domain"))


def _with_suffix_rates(df: DataFrame, labelled: DataFrame) -> DataFrame:
    """Smoothed share of blocked urls among those labelled, for each suffix; an unseen suffix gets one half."""
    for suffix, rate in (("_top", "top_rate"), ("_domain", "domain_rate")):
        seen = labelled.groupBy(suffix).agg(((F.sum("label") + 1) / (F.count("label") + 2)).alias(rate))
        df = df.join(seen, suffix, "left").withColumn(rate, F.coalesce(rate, F.lit(0.5)))
    return df


def judged(pages: DataFrame, ws: Scratch, rules: Sequence[tuple[str, str, str]] = RULES, how: Learning = Learning()) -> DataFrame:
    """page_id, host, path, rule, verdict and ``score`` (the trees' probability of block) for every row."""
    rule, answer = decided(rules)
    urls = lexical(parts(pages.select("page_id", "url"))).withColumn("rule", rule).withColumn("_by_rule", answer)
    urls = ws.keep("urls", urls.withColumn("label", F.when(F.col("_by_rule") == "block", 1.0).when(F.col("_by_rule") == "allow", 0.0)))
    labelled = urls.where("label is not null")
    totals = labelled.agg(F.count("label").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).first()
    rated = _with_suffix_rates(urls, labelled)
    if totals.n == 0 or totals.lo == totals.hi:
        out = rated.withColumn("score", F.lit(0.0))
    else:
        share = min(1.0, how.rows / totals.n)
        vectors = VectorAssembler(inputCols=list(LEXICAL), outputCol="features").transform(rated)
        sample = vectors.where("label is not null").where(F.pmod(F.xxhash64("url", "page_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        model = GBTClassifier(maxIter=how.trees, maxDepth=how.depth, seed=how.seed).fit(sample.select("label", "features"))
        out = model.transform(vectors).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    verdict = F.coalesce("_by_rule", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")

