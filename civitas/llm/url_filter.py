"""URL filter: allow and block rules, and boosted trees for the rest.

A rule fits its host and all subdomains of it where the url's path starts
with the rule's path; the longest fitting rule decides. Urls that rules
decide are the labelled urls: gradient-boosted trees on lexical features
(lengths, depth, digit shares, entropy, parameter counts, statistics of the
host's suffix) learn from them and judge the urls that no rule fits.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .components import stored
from .sampling import hash_sample

#: (action, host, path); the queries' rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Most labelled urls that the trees are fitted on, in the order of a hash.
SAMPLE = 20_000
TREES, DEPTH = 10, 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, action) of the longest rule that fits, else null; of
    rules of one length the first. A rule is its host and path in one."""
    found = []
    for action, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        found.append(F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,action:string>")


def _share(text: Column, pattern: str) -> Column:
    """Share of a text's signs that match; 0 for an empty text."""
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.regexp_replace(text, pattern, ""))) / n).otherwise(F.lit(0.0))


def _entropy(text: Column) -> Column:
    """Shannon entropy of a text's signs in bits."""
    signs = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.greatest(F.size(signs), F.lit(1))
    shares = F.transform(F.array_distinct(signs), lambda c: F.size(F.filter(signs, lambda d: d == c)) / n)
    return F.aggregate(shares, F.lit(0.0), lambda total, p: total - p * F.log2(p))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "labels": F.size(F.split(host, r"\.")).cast("double"),
        "depth": (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double"),
        "digits": _share(url, "[0-9]"),
        "host_digits": _share(host, "[0-9]"),
        "hyphens": (F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))).cast("double"),
        "entropy": _entropy(host),
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
    }


def judge_urls(pages: DataFrame, rules=RULES, sample: int = SAMPLE, url_column: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict (allow or block).

    A null url, or one without ``://``, has an empty host and path, so no
    rule fits it and the trees judge it. With labelled urls of one class
    only, the rest get that class; without any, allow. Repeated rows are
    judged alike; an empty table gives no rows; columns of these four names
    are replaced, all others kept. ``rules`` is a list in the plan: some
    hundreds at most."""
    named = pages.select(F.struct("*").alias("__row"), F.col(url_column).alias("__url"))
    named = named.withColumn("__host", host_of(F.col("__url"))).withColumn("__path", path_of(F.col("__url")))
    named = named.withColumn("__found", fitting_rule(F.col("__host"), F.col("__path"), rules))
    features = lexical_features(F.col("__url"), F.col("__host"), F.col("__path"))
    suffix = F.substring_index("__host", ".", -1)

    known = (named.where("__found is not null").select("__url", "__host", "__path", (F.col("__found.action") == "block").cast("double").alias("label")))
    folder = scratch_dir(pages.sparkSession, "urls")
    known = hash_sample(known, "__url", sample, folder)
    known = stored(known.withColumns(features).withColumn("__suffix", suffix).drop("__url", "__path", "__host"), f"{folder}/known")
    mean, n = known.agg(F.avg("label"), F.count("*")).first()
    if not n or mean in (0.0, 1.0):
        verdict = F.lit("block" if n and mean == 1.0 else "allow")
        judged = named.withColumn("__guess", verdict)
    else:
        # block share by last label of the host, drawn towards the mean where rows are few; one row per suffix of the sample
        shares = known.groupBy("__suffix").agg(((F.sum("label") + 5 * mean) / (F.count("*") + 5)).alias("suffix_share"))
        assembler = VectorAssembler(inputCols=[*features, "suffix_share"], outputCol="__features")
        model = GBTClassifier(featuresCol="__features", labelCol="label", predictionCol="__prediction", maxIter=TREES,
                              maxDepth=DEPTH, seed=7).fit(assembler.transform(known.join(F.broadcast(shares), "__suffix")))
        rest = named.withColumns(features).withColumn("__suffix", suffix).join(F.broadcast(shares), "__suffix", "left")
        judged = model.transform(assembler.transform(rest.fillna(mean, ["suffix_share"])))
        judged = judged.withColumn("__guess", F.when(F.col("__prediction") == 1.0, "block").otherwise("allow"))
    own = {"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__found.rule"),
           "verdict": F.coalesce(F.col("__found.action"), F.col("__guess"))}
    return judged.select(*[F.col("__row")[c].alias(c) for c in pages.columns if c not in own],
                         *[c.alias(name) for name, c in own.items()])
