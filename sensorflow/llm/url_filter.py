"""URL rules, and gradient-boosted trees on lexical features for the URLs that no rule fits. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.tasks import written

# The rules to apply.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
TRAIN_ROWS = 20_000
SUFFIX_BUCKETS = 1024
FEATURES = ("n_chars", "n_host", "n_path", "depth", "labels", "digits", "dashes", "entropy", "parameters", "escapes", "suffix_share")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self) -> Column:
        """The host or a subdomain of it, and a path that starts with the rule's."""
        return F.concat(F.lit("."), "host").endswith("." + self.host) & F.col("path").startswith(self.path)


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds host and path. The host follows the first `://` up to `/`, `?`, `#` or the end; the path goes on up to `?` or `#`."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substr("url", at + 3, F.length("url"))).otherwise("")
    return pages.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumns({
        "host": F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0), _UPPER, _UPPER.lower()),
        "path": F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1),
    }).drop("_rest")


def with_rule(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds the longest rule that fits and its verdict; of equally long ones the first in the list. The list is one expression."""
    ordered = sorted(rules, key=lambda r: -len(r.text))
    rule = reduce(lambda c, r: c.when(r.fits(), r.text), ordered, F.when(F.lit(False), ""))
    ruled = reduce(lambda c, r: c.when(r.fits(), r.verdict), ordered, F.when(F.lit(False), ""))
    return pages.withColumns({"rule": rule, "ruled": ruled})


def _count(text: str, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def with_features(pages: DataFrame) -> DataFrame:
    """Adds the lexical features of the url but for `suffix_share`; all are 0 for an empty or null url."""
    url = F.coalesce(F.col("url"), F.lit(""))
    made = pages.withColumn("_url", url)
    size = F.greatest(F.length("_url"), F.lit(1))
    letters = F.array_distinct(F.split("_url", ""))
    share = F.transform(F.filter(letters, lambda c: c != ""), lambda c: F.length("_url") - F.length(F.replace("_url", c, F.lit(""))))
    query = F.regexp_extract("_url", r"\?([^#]*)", 1)
    return made.withColumns({
        "n_chars": F.length("_url"), "n_host": F.length("host"), "n_path": F.length("path"), "depth": _count("path", "/"),
        "labels": F.when(F.col("host") == "", 0).otherwise(_count("host", ".") + 1),
        "digits": _count("_url", "0123456789") / size, "dashes": _count("host", "-_"),
        "entropy": F.aggregate(share, F.lit(0.0), lambda total, n: total - n / size * F.log2(n / size)),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))),
        "escapes": _count("_url", "%"), "_suffix": _suffix_bucket(),
    }).withColumns({f: F.col(f).cast("double") for f in FEATURES if f != "suffix_share"}).drop("_url")


def _suffix_bucket() -> Column:
    """The last label of the host in one of a fixed number of buckets, so the statistics have a bounded size."""
    return F.pmod(F.xxhash64(F.substring_index("host", ".", -1)), F.lit(SUFFIX_BUCKETS)).cast("int")


def suffix_shares(labelled: DataFrame) -> DataFrame:
    """Smoothed share of blocked urls by suffix bucket: at most SUFFIX_BUCKETS rows."""
    blocked = F.sum((F.col("ruled") == "block").cast("double"))
    return labelled.groupBy("_suffix").agg(((blocked + 1) / (F.count("*") + 2)).alias("suffix_share"))


def with_shares(rows: DataFrame, shares: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(shares), "_suffix", "left").withColumn("suffix_share", F.coalesce("suffix_share", F.lit(0.5)))


def sampled(labelled: DataFrame, total: int, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """About `train_rows` distinct labelled urls, as many of each label, picked by a hash of the url.

    `weight` is the share of the `total` labelled rows that a url stands for: its own copies, over the chance to be picked.
    """
    slots = 1 << 30
    sizes = labelled.groupBy("ruled").agg(F.approx_count_distinct("url").alias("urls")).collect()  # one row for each label
    limit = reduce(lambda c, r: c.when(F.col("ruled") == r.ruled, min(slots, slots * train_rows // (len(sizes) * max(r.urls, 1)) + 1)),
                   sizes, F.when(F.lit(False), 0))
    picked = labelled.withColumn("_limit", limit).filter(F.pmod(F.xxhash64(F.lit("train"), "url"), F.lit(slots)) < F.col("_limit"))
    urls = picked.groupBy("url", "ruled", "_limit").agg(*(F.first(f).alias(f) for f in FEATURES), F.count("*").alias("_copies"))
    return urls.select(*FEATURES, (F.col("ruled") == "block").cast("double").alias("blocked"),
                       (F.col("_copies") * slots / F.col("_limit") / max(total, 1)).alias("weight"))


def trained(labelled: DataFrame, total: int, train_rows: int = TRAIN_ROWS) -> PipelineModel | None:
    """Trees fitted on a sample of labelled urls; None if it is empty or has one label."""
    sample = written(sampled(labelled, total, train_rows), "urls")  # trees read their rows again and again; the table is read once
    if sample.select("blocked").distinct().count() < 2:
        return None
    trees = GBTClassifier(labelCol="blocked", featuresCol="_features", weightCol="weight", maxIter=10, maxDepth=3, stepSize=0.3, seed=7,
                          predictionCol="_blocked")
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="_features"), trees]).fit(sample)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, url, host, path, rule, verdict and method (`rule`, `trees` or `default`) for every row of `pages`.

    The longest fitting rule decides. Urls that rules decide are the labelled ones: trees learn from a bounded sample of
    them, with suffix shares counted over all, and judge the others. Where the labels are all equal, or there are none,
    nothing can be learned: the others get that one verdict, or `allow`, also where the sample lacks a label. A null url, or one without `://`, has an empty
    host and path and is judged by its features. Repeated rows and null page_ids are kept; extra columns are ignored.
    """
    rows = with_rule(with_parts(pages.select("page_id", "url")), [Rule(*r) for r in rules])
    rows = with_features(rows)
    labelled = rows.filter("ruled IS NOT NULL")
    counts = labelled.agg(F.count("*").alias("n"), F.count_if(F.col("ruled") == "block").alias("blocked")).first()
    columns = ["page_id", "url", "host", "path", "rule"]

    def by_default(usual: str) -> DataFrame:
        return rows.select(*columns, F.coalesce("ruled", F.lit(usual)).alias("verdict"),
                           F.when(F.col("rule").isNotNull(), "rule").otherwise("default").alias("method"))

    if counts.blocked in (0, counts.n):
        return by_default("block" if counts.blocked else "allow")
    shares = written(suffix_shares(labelled), "suffixes")
    model = trained(with_shares(labelled, shares), counts.n, train_rows)
    if model is None:
        return by_default("allow")
    judged_rows = model.transform(with_shares(rows, shares))
    guess = F.when(F.col("_blocked") > 0.5, "block").otherwise("allow")
    return judged_rows.select(*columns, F.coalesce("ruled", guess).alias("verdict"),
                              F.when(F.col("rule").isNotNull(), "rule").otherwise("trees").alias("method"))
