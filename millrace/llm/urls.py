"""URL filter: allow and block rules, and gradient-boosted trees on lexical features for all other URLs.

Rules: a rule `host/path` fits its host and all its subdomains where the URL's path starts with the
rule's; the longest fitting rule decides. The trees learn from labelled URLs (by default those that a
rule decides) on length, depth, digit ratio, character entropy, parameter counts and statistics of the
host's suffixes. Suffix statistics count all labelled URLs, map-side combined; a training row's own
label is taken out of its statistics. The trees are fitted on at most about `sample_rows` labelled
URLs, chosen by a hash, so the fit's cost does not grow with the crawl; every URL is then scored.

Everything is DataFrame functions and Spark's own trees: no Python runs on the executors.

Defined results: a null URL, or one without `://`, has an empty host and path and is judged by the
trees; repeated rows and null ids get a row each; with labels of one class only, that class is the
verdict, with none at all it is allow; an empty table gives no rows; other columns are not read.
"""

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import lower_ascii
from millrace.session import cut_lineage

SAMPLE_ROWS = 10_000
PRIOR_ROWS = 20.0
LEXICAL = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters",
           "longest_label", "hyphens", "has_fragment", "secure")
FEATURES = (*LEXICAL, "rate_1", "rate_2", "seen_2")


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    rule: str

    @property
    def host(self):
        return self.rule.split("/", 1)[0]

    @property
    def path(self):
        return "/" + self.rule.split("/", 1)[1]


def host_of(url) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def path_of(url) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules) -> Column:
    """The index of the longest fitting rule, null if none fits. Rules are a short list, not a table."""
    found = F.lit(None).cast("int")
    for number, rule in sorted(enumerate(rules), key=lambda pair: len(pair[1].rule)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(number)).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits per character; 0 for an empty text."""
    n = F.length(text)
    shares = F.transform(F.array_sort(F.array_distinct(F.split(text, ""))), lambda c: F.when(
        c == "", F.lit(0.0)).otherwise((n - F.length(F.replace(text, c, F.lit("")))) / n))
    return F.aggregate(shares, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def lexical(df: DataFrame, url_col: str) -> DataFrame:
    """Add host, path and the lexical features."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    parsed = df.withColumns({"host": host_of(url), "path": path_of(url),
                             "_url": url, "_query": F.regexp_extract(url, r"\?([^#]*)", 1)})
    names = F.split("host", r"\.")
    n = F.length("_url")
    return parsed.withColumns({
        "url_length": n.cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda part: part != "")).cast("double"),
        "labels": F.size(names).cast("double"),
        "digit_ratio": F.when(n > 0, F.regexp_count("_url", F.lit("[0-9]")) / n).otherwise(0.0),
        "entropy": entropy(F.col("_url")),
        "parameters": F.size(F.filter(F.split("_query", "&"), lambda part: part != "")).cast("double"),
        "longest_label": F.array_max(F.transform(names, lambda part: F.length(part))).cast("double"),
        "hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "has_fragment": F.contains("_url", F.lit("#")).cast("double"),
        "secure": F.lower("_url").startswith("https:").cast("double"),
        "suffix_1": F.element_at(names, -1),
        "suffix_2": F.array_join(F.slice(names, F.greatest(F.size(names) - 1, F.lit(1)), 2), "."),
    }).drop("_url", "_query")


def suffix_statistics(labelled: DataFrame, suffix: str) -> DataFrame:
    """(suffix, n, blocked) over all labelled URLs, each counted `copies` times."""
    return labelled.groupBy(suffix).agg(F.sum("copies").alias(f"n_{suffix}"),
                                        F.sum(F.col("label") * F.col("copies")).alias(f"b_{suffix}"))


def with_rates(df: DataFrame, statistics, base: float, own: Column) -> DataFrame:
    """Add the smoothed block rate of both suffixes; `own` is 1 where the row's own label is to be left out."""
    for suffix, counts in statistics.items():
        df = df.join(counts, suffix, "left")
    label = F.coalesce("label", F.lit(0.0))

    def rate(suffix):
        n = F.coalesce(f"n_{suffix}", F.lit(0)) - own
        return (F.coalesce(f"b_{suffix}", F.lit(0.0)) - own * label + PRIOR_ROWS * base) / (n + PRIOR_ROWS)

    return df.withColumns({
        "rate_1": rate("suffix_1"), "rate_2": rate("suffix_2"),
        "seen_2": F.log1p((F.coalesce("n_suffix_2", F.lit(0)) - own).cast("double"))})


class UrlModel:
    """Trees and suffix statistics fitted on labelled URLs: (url, label 1 = block)."""

    def __init__(self, labelled: DataFrame, url_col="url", label_col="label", sample_rows=SAMPLE_ROWS, trees=20,
                 depth=4, seed=7):
        known = labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("label")).filter(
            F.col("label").isNotNull())
        known = known.groupBy("url", "label").agg(F.count(F.lit(1)).alias("copies"))
        known = cut_lineage(lexical(known, "url"), "url-labels")
        distinct, rows, blocked = known.agg(
            F.count(F.lit(1)), *[F.coalesce(F.sum(x), F.lit(0.0)) for x in (
                F.col("copies").cast("double"), F.col("label") * F.col("copies"))]).first()  # three numbers
        self.statistics = {s: cut_lineage(suffix_statistics(known, s), s) for s in ("suffix_1", "suffix_2")}
        self.base = blocked / rows if rows else 0.0
        self.trees = None
        if 0 < blocked < rows:
            chosen = F.pmod(F.xxhash64(F.lit(seed), "url"), F.lit(1 << 32)) < int(min(1.0, sample_rows / distinct) * (1 << 32))
            sample = with_rates(known.filter(chosen), self.statistics, self.base, F.lit(1))
            sample = self._vectors(sample).select("features", "label", "url", F.col("copies").cast("double").alias("copies"))
            sample = cut_lineage(sample.repartition(4, "url").sortWithinPartitions("url", "label"), "url-sample")
            if sample.select("label").distinct().count() == 2:
                self.trees = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, maxMemoryInMB=64,
                                           weightCol="copies").fit(sample)

    @staticmethod
    def _vectors(df):
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)

    def score(self, df: DataFrame, url_col="url") -> DataFrame:
        """`df` with host, path and block_score, the probability that a URL is to be blocked."""
        columns = df.columns
        named = lexical(df.select(F.struct("*").alias("row"), F.col(url_col).alias("url")), "url")
        rated = with_rates(named.withColumn("label", F.lit(0.0)), self.statistics, self.base, F.lit(0))
        if self.trees is None:
            scored = rated.withColumn("block_score", F.lit(float(round(self.base))))
        else:
            scored = self.trees.transform(self._vectors(rated)).withColumn(
                "block_score", vector_to_array("probability")[1])
        return scored.select(*[F.col("row")[c].alias(c) for c in columns if c not in ("host", "path", "block_score")],
                             "host", "path", "block_score")


def judge(pages: DataFrame, rules, labelled: DataFrame | None = None, id_col="page_id", url_col="url",
          **options) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) for every row of `pages`."""
    rules = list(rules)
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).withColumn(
        "rule_no", rule_for(host_of(F.col("url")), path_of(F.col("url")), rules))
    verdicts, names = (F.array(*[F.lit(getattr(r, f)) for r in rules]) for f in ("verdict", "rule"))
    narrow = narrow.withColumns({"rule": F.get(names, "rule_no"), "ruled": F.get(verdicts, "rule_no")})
    if labelled is None:
        labelled = narrow.filter("rule_no is not null").select("url", (F.col("ruled") == "block").cast("double").alias("label"))
    scored = UrlModel(labelled, **options).score(narrow)
    by_trees = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_trees).alias("verdict"), "block_score")
