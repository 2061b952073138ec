"""URL filters: rules on hosts and paths, and boosted trees for what no rule decides.

The trees see lexical features alone: lengths, depth, shares of digits and other
signs, entropy, numbers of parameters, and how often and how labelled the host's
suffixes occur among the labelled URLs. Everything is DataFrame expressions and
Spark's own boosted trees.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.folders import written

#: Distinct labelled URLs of each kind that the trees are fitted on: those with the smallest hashes.
FIT_ROWS = 10_000
#: The trees see statistics of a labelled URL's suffixes without the labels of its own fold.
FOLDS = 10
TREES, DEPTH = 15, 4
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """A verdict on a host, its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str


#: Fixed by the contract of op4.
RULES = (
    Rule(ALLOW, "com", "/"), Rule(BLOCK, "example.com", "/en/"), Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"), Rule(BLOCK, "net", "/fr/"),
)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as ``(name, verdict)``, or null. Rules come with the plan: some thousands at most."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    # later cases win: the longest rule comes last
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def _share(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits for each character of a text."""
    size = F.greatest(F.length(text), F.lit(1))
    each = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    part = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size / F.length(c)
    return F.aggregate(F.transform(each, part), F.lit(0.0), lambda total, p: total - p * F.log2(p))


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features by name."""
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    return {
        "url_length": F.length(text), "host_length": F.length(host), "path_length": F.length(path), "query_length": F.length(query),
        "host_depth": F.size(labels), "path_depth": F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
        "digits": _share(text, "[0-9]"), "host_digits": _share(host, "[0-9]"), "hyphens": _share(host, "-"),
        "signs": _share(text, "[A-Za-z0-9./:]"), "entropy": _entropy(text), "host_entropy": _entropy(host),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))),
        "fragment": text.contains("#").cast("int"), "secure": text.startswith("https:").cast("int"),
        "longest_label": F.array_max(F.transform(labels, F.length)),
    }


def _suffixes(host: Column, path: Column) -> dict[str, Column]:
    """The last label of a host, its last two, the whole host, and the end of the path's name."""
    labels = F.split(host, r"\.")
    return {
        "last": F.element_at(labels, -1), "last_two": F.array_join(F.slice(F.reverse(labels), 1, 2), "."), "host": host,
        "first_folder": F.regexp_extract(path, "^/([^/]*)/", 1), "extension": F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1),
    }


class UrlFilter:
    """Boosted trees and suffix statistics, fitted on labelled URLs."""

    def __init__(self, model, statistics: dict[str, DataFrame], names: list[str], base: float):
        self.model, self.statistics, self.names, self.base = model, statistics, names, base

    @classmethod
    def fit(cls, labelled: DataFrame, url: str = "url", label: str = "blocked", rows: int = FIT_ROWS) -> UrlFilter:
        """Fit on ``label`` 1 (blocked) or 0 of URLs. Suffix statistics count all of them; the trees
        see up to ``rows`` distinct URLs of each. Null labels and URLs teach nothing; labels of one
        kind, or none, give that kind's share as score."""
        known = labelled.select(F.col(url).alias("url"), F.col(label).cast("int").alias("label")).where("url is not null and label is not null")
        counted = known.groupBy("url", "label").agg(F.count("*").alias("n")).withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
        counted = written(_with_suffixes(counted).withColumn("h", F.xxhash64("url")).withColumn("fold", F.pmod("h", F.lit(FOLDS))), "urls")
        counts = counted.agg(F.sum("n"), F.sum(F.col("label") * F.col("n"))).first()
        base = float(counts[1] or 0) / counts[0] if counts[0] else 0.0
        folds = {name: written(_counts(counted, f"suffix_{name}", "fold"), "folds") for name in _suffixes(F.lit(""), F.lit(""))}
        totals = {name: written(_totals(table, f"suffix_{name}"), "suffixes") for name, table in folds.items()}
        out = cls(None, {name: _statistic(table, name, base) for name, table in totals.items()}, [], base)
        if 0 < base < 1:
            sample = written(counted.where("label = 1").orderBy("h", "url").limit(rows).unionByName(
                counted.where("label <> 1").orderBy("h", "url").limit(rows)), "sample")
            ready, out.names = out._ready(sample, {name: _statistic(_other_folds(table, totals[name], name), name, base, "fold") for name, table in folds.items()})
            trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=5, stepSize=0.2)
            # the sample is bounded: a few tasks each round are enough
            ready = written(ready.select("features", F.col("label").cast("double").alias("label")), "ready")
            out.model = trees.fit(ready.coalesce(4))
        return out

    def _ready(self, urls: DataFrame, of_folds: dict[str, DataFrame] | None = None) -> tuple[DataFrame, list[str]]:
        """Rows with ``url``, ``host``, ``path`` and suffixes get their features; with ``of_folds``, by ``fold`` too."""
        names = list(features(F.lit(""), F.lit(""), F.lit("")))
        for name, table in (of_folds or self.statistics).items():
            same = F.col(f"suffix_{name}") == F.col(f"of_{name}")
            if of_folds:
                table = table.withColumnRenamed("fold", f"fold_{name}")
                same &= F.col("fold") == F.col(f"fold_{name}")
            urls = urls.join(table.withColumnRenamed("suffix", f"of_{name}"), same, "left").drop(f"of_{name}", f"fold_{name}")
            names += [f"{name}_blocked", f"{name}_seen"]
        urls = urls.withColumns({k: v.cast("double") for k, v in features(F.col("url"), F.col("host"), F.col("path")).items()})
        urls = urls.fillna({c: self.base for c in names if c.endswith("_blocked")} | {c: 0.0 for c in names if c.endswith("_seen")})
        return VectorAssembler(inputCols=names, outputCol="features").transform(urls), names

    def score(self, urls: DataFrame) -> DataFrame:
        """``urls`` with ``(url, host, path)`` and other columns get a ``score`` from 0 to 1 that they are to be blocked."""
        if self.model is None:
            return urls.withColumn("score", F.lit(self.base))
        kept = [c for c in urls.columns if c != "score"]
        ready, _ = self._ready(_with_suffixes(urls))
        return self.model.transform(ready).select(*kept, F.element_at(vector_to_array("probability"), 2).alias("score"))


def _with_suffixes(urls: DataFrame) -> DataFrame:
    return urls.withColumns({f"suffix_{k}": v for k, v in _suffixes(F.col("host"), F.col("path")).items()})


def _counts(counted: DataFrame, suffix: str, *more: str) -> DataFrame:
    """``(suffix, blocked, seen)`` of all labelled URLs, copies included."""
    return counted.groupBy(suffix, *more).agg(F.sum(F.col("label") * F.col("n")).alias("blocked"), F.sum("n").alias("seen"))


def _totals(folds: DataFrame, suffix: str) -> DataFrame:
    return folds.groupBy(suffix).agg(F.sum("blocked").alias("blocked"), F.sum("seen").alias("seen"))


def _other_folds(folds: DataFrame, totals: DataFrame, name: str) -> DataFrame:
    """What all folds but each one count."""
    suffix = f"suffix_{name}"
    whole = totals.withColumnsRenamed({"blocked": "all_blocked", "seen": "all_seen"})
    return folds.join(whole, suffix).select(
        suffix, "fold", (F.col("all_blocked") - F.col("blocked")).alias("blocked"), (F.col("all_seen") - F.col("seen")).alias("seen"))


def _statistic(counts: DataFrame, name: str, base: float, *more: str) -> DataFrame:
    """Share blocked, for which 10 labelled URLs weigh as much as the share of all, and number seen."""
    return counts.select(
        F.col(f"suffix_{name}").alias("suffix"), *more, ((F.col("blocked") + 10 * F.lit(base)) / (F.col("seen") + 10)).alias(f"{name}_blocked"),
        F.log1p("seen").alias(f"{name}_seen"))


def judge(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` of each URL.

    The verdict is that of the longest rule that fits. URLs that rules decide are the
    labels from which the trees learn; a URL without a rule is blocked if its score is
    0.5 or more. A null URL has an empty host and path and no rule; its score is that of
    an empty text. Repeated rows get a row each; other columns are ignored.
    """
    url = F.col(url_column).cast("string")
    source = pages.select(F.col(id_column).alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    source = source.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    labelled = source.where("rule is not null").select("url", (F.col("rule.verdict") == BLOCK).cast("int").alias("blocked"))
    scored = UrlFilter.fit(labelled).score(source)
    verdict = F.coalesce(F.col("rule.verdict"), F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW))
    return scored.select("id", "host", "path", F.col("rule.name").alias("rule"), verdict.alias("verdict"), "score")
