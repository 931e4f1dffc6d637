"""Url verdicts by rules, and by gradient-boosted trees on lexical features elsewhere.

A rule allows or blocks a host with its subdomains below a path; the longest fitting rule
decides. Urls that a rule decides are the labelled ones: a bounded sample of them trains the
trees that judge the rest.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.boosted import Calibrated
from candlemill.llm.common import settled, table

# Fixed values: (rule, verdict); a rule is a host followed by a path.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
SAMPLE = 20_000  # labelled urls that are fitted, at most
SUFFIXES = 2_000  # suffixes with statistics, at most; a suffix has at most three labels
BLOCK = 0.5
SMOOTH = 5.0
_FEATURES = 18


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, null if none does; of equally long ones the first by name."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        at = rule.index("/")
        there = (host == rule[:at]) | F.endswith(host, F.lit(f".{rule[:at]}"))
        out = F.when(there & F.startswith(path, F.lit(rule[at:])), F.lit(rule)).otherwise(out)
    return out


def suffixes(host: str) -> list[str]:
    """The last label of a host, its last two and its last three."""
    labels = host.split(".")
    return [".".join(labels[-k:]) for k in (1, 2, 3) if len(labels) >= k]


def entropy(text: str) -> float:
    counts = Counter(text).values()
    return -sum(c / len(text) * math.log2(c / len(text)) for c in counts) if text else 0.0


def features(url: str, host: str, path: str, rates: dict[str, float], prior: float) -> list[float]:
    n = max(1, len(url))
    query = url.partition("?")[2].partition("#")[0]
    parts = [p for p in path.split("/") if p]
    known = [rates.get(s, prior) for s in suffixes(host)] + [prior] * 3
    return [
        len(url), len(host), len(path), len(parts), host.count(".") + 1, sum(c.isdigit() for c in url) / n,
        sum(c.isdigit() for c in host) / max(1, len(host)), entropy(url), entropy(host),
        len([p for p in query.split("&") if p]), len(query), url.count("-") + url.count("_"),
        sum(not c.isalnum() for c in url) / n, max(map(len, parts), default=0), float(url[:8].lower() == "https://"),
        *known[:3],
    ]


def _features(rates: dict[str, float], prior: float, passed: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, hosts, paths = (batch.column(c).to_pylist() for c in ("url", "host", "path"))
            rows = [features(u, h, p, rates, prior) for u, h, p in zip(urls, hosts, paths)]
            kept = [batch.column(c) for c in passed]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.list_(pa.float64()))], names=[*passed, "features"])

    return run


def fit(urls: DataFrame, rules: Sequence[tuple[str, str]], sample: int = SAMPLE) -> tuple[dict[str, float], float, Calibrated]:
    """Suffix rates and the calibrated trees, from at most ``sample`` distinct urls with a rule."""
    blocked = [rule for rule, verdict in rules if verdict == "block"]
    known = (
        urls.filter("rule IS NOT NULL").select("url", "host", "path", F.col("rule").isin(blocked).cast("int").alias("label"))
        .distinct().orderBy(F.xxhash64("url"), "url").limit(sample)
    )
    known = settled(known.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "url"), F.lit(10))), "url-sample")
    first = known.filter("part < 4")
    prior = 0.5  # both verdicts weigh the same, however many urls the rules give to each
    n, ones = first.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    odds = max(1, n - ones) / max(1, ones)
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.least(F.lit(3), F.size(labels))), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    counts = (
        first.select("label", F.explode(ends).alias("suffix")).groupBy("suffix")
        .agg(F.count("*").alias("n"), F.sum("label").alias("ones")).orderBy(F.desc("n"), "suffix").limit(SUFFIXES)
    )
    rates = {r["suffix"]: (r["ones"] * odds + SMOOTH * prior) / (r["ones"] * odds + r["n"] - r["ones"] + SMOOTH) for r in counts.collect()}
    rest = known.filter("part >= 4").withColumn("fold", F.when(F.col("part") < 8, 0).otherwise(1))
    made = rest.mapInArrow(_features(rates, prior, ["label", "fold"]), "label int, fold int, features array<double>")
    return rates, prior, Calibrated(made, balanced=True)


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, sample: int = SAMPLE, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per row: page_id, host, path, rule, verdict, score.

    ``score`` is the trees' probability of "block", null where a rule decides. A null url, or
    one without ``://``, has an empty host and path, fits no rule and is judged by the trees
    on what it is (null: empty). Where no url fits a rule, or all rules that fit agree, the
    score is the share of blocked ones (0.5 without any). Repeated rows are judged alike. An
    empty table gives an empty result.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(url, F.lit("")).alias("url"),
        host_of(url).alias("host"), path_of(url).alias("path"),
    ).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    rates, prior, model = fit(rows, rules, sample)
    kept = ["page_id", "host", "path", "rule"]
    made = rows.mapInArrow(_features(rates, prior, kept), "page_id long, host string, path string, rule string, features array<double>")
    scored = model.score(made)
    verdicts = F.create_map(*(F.lit(x) for rule in rules for x in rule)) if rules else F.lit(None)
    own = F.when(F.col("score") >= BLOCK, "block").otherwise("allow")
    verdict = F.when(F.col("rule").isNotNull(), F.try_element_at(verdicts, F.col("rule"))).otherwise(own) if rules else own
    return scored.select(
        *kept, verdict.alias("verdict"), F.when(F.col("rule").isNull(), F.col("score")).alias("score")
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
