"""URL filter: a fixed host/path list, and association rules mined by FP-growth for the rest.

1. A url becomes a set of tokens: its host's labels, top domain, path words, query keys and fragment.
2. Labelled urls are those whose path names a labelled document (``/lang/<doc_id>``); they are ``bad`` if the
   document's quality is 0 or it is toxic. The list's verdicts are no labels: they would only be mined back, and a language that
   the list blocks on one domain would be blocked on all.
3. Spark's FP-growth mines the token combinations that at least ``MIN_PAGES`` bad urls hold, however many urls there
   are, and those in all labelled urls are counted by the index of step 4. Tokens that stand in the same labelled urls
   are one token there (two of them in a rule would say no more than one), and are told apart again in the rules. A combination is a rule if its confidence reaches its limit, and
   no combination inside it is as confident.
4. A url that the list doesn't judge is blocked if all tokens of a rule are in its set. Rules are found by an inverted
   index from each rule's rarest token, shared with the tasks in blocks of at most ``BLOCK_RULES`` rules.

Edge cases: a null url, or one without ``://``, has an empty host and path, no tokens and the verdict allow; without labels
there are no rules; repeated rows each get their row; a label without quality and toxicity is not bad; extra columns are ignored; empty
tables give an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import broadcast_if_few, cut, read_table, share

# (verdict, rule): a rule names a host, all its subdomains, and the beginning of a path.
LIST = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MIN_SUPPORT = 0.0       # share of the labelled urls that a rule's bad ones must be besides
MIN_PAGES = 10          # bad urls of a rule at least
MIN_CONFIDENCE = 0.6
MAX_TOKENS = 64         # of a rule; no limit, as the parts of so long a combination would be 2^64 others
BLOCK_RULES = 50_000

_PARTS = re.compile(r"[^a-z0-9]+")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", ""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", ""))
    return F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def list_rule(host: Column, path: Column, rules=LIST) -> tuple[Column, Column]:
    """(rule, verdict) of the longest list rule that fits; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, name in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        domain, _, rest = name.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: str | None, host: str, path: str) -> list[str]:
    """Distinct tokens of a url, sorted. Numbers are left out: they name one page, not a kind of page."""
    if not host:
        return []
    labels = host.split(".")
    found = {f"tld:{labels[-1]}"} | {f"host:{x}" for x in labels[:-1] if x}
    found |= {f"path:{x}" for x in _PARTS.split(path.lower()) if x and not x.isdigit()}
    tail = (url or "").partition("://")[2][len(host) + len(path):]
    query, _, fragment = tail.partition("#")
    found |= {f"query:{x.partition('=')[0].lower()}" for x in query.lstrip("?").split("&") if x}
    if fragment:
        found.add(f"fragment:{fragment.lower()}")
    return sorted(found)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _tokens(urls: pd.Series, hosts: pd.Series, paths: pd.Series) -> pd.Series:
    return pd.Series([url_tokens(u, h, p) for u, h, p in zip(urls, hosts, paths)])


def tokenized(pages: DataFrame, rules=LIST) -> DataFrame:
    """page_id, url, host, path, rule, listed (the list's verdict) and tokens of every row."""
    df = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    df = df.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    rule, verdict = list_rule(F.col("host"), F.col("path"), rules)
    df = df.withColumn("rule", rule).withColumn("listed", verdict)
    return df.withColumn("tokens", _tokens("url", "host", "path"))


def mine(urls: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_pages: int = MIN_PAGES, max_tokens: int = MAX_TOKENS, block_rules: int = BLOCK_RULES) -> DataFrame:
    """(tokens, confidence): the pruned rules whose consequent is ``bad``.

    Bad urls that share k tokens add at most 2^k combinations, tokens of the same labelled urls counted once; of good
    urls none are listed.
    """
    named = F.try_to_number(F.regexp_extract("path", r"\A/[^/]+/([0-9]{1,18})", 1), F.lit("9" * 18)).cast("long")
    known = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("named"))
             .agg(F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False)).cast("int")).alias("bad")))
    baskets = cut(urls.where(F.size("tokens") > 0).withColumn("named", named).join(known, "named")
                  .select(F.monotonically_increasing_id().alias("at"), "tokens", "bad"))
    bad = baskets.where("bad = 1")
    n_bad, least = bad.count(), max(min_pages, min_support * baskets.count())
    if not n_bad or n_bad < least:
        return cut(baskets.limit(0).select("tokens", F.lit(0.0).alias("confidence")))
    alike = cut(same_urls(baskets, least))
    named_alike = broadcast_if_few(alike.select(F.get("members", F.lit(0)).alias("token")))
    kept = (bad.select("at", F.explode("tokens").alias("token")).join(named_alike, "token")
            .groupBy("at").agg(F.collect_list("token").alias("tokens")))
    kept = cut(kept)
    n_kept = kept.count()
    if not n_kept:
        return cut(baskets.limit(0).select("tokens", F.lit(0.0).alias("confidence")))
    # half a page less, so that the limit is the count itself whatever the division rounds to
    model = FPGrowth(itemsCol="tokens", minSupport=max(least - 0.5, 0.5) / n_kept).fit(kept)
    often = cut(model.freqItemsets.where(F.size("items") <= max_tokens).select(F.array_sort("items").alias("tokens"), "freq"))
    found = often.join(totals(often.select("tokens"), baskets, block_rules), "tokens")
    found = cut(found.select("tokens", (F.col("freq") / F.col("total")).alias("confidence"))
                .where(F.col("confidence") >= min_confidence))
    # a rule goes if a shorter one inside it is as confident: compared along shared tokens only
    shorter = found.select(F.col("tokens").alias("inner"), F.col("confidence").alias("inner_confidence"))
    keyed = found.select("tokens", "confidence", F.explode("tokens").alias("key"))
    inner = shorter.select("inner", "inner_confidence", F.get("inner", F.lit(0)).alias("key"))
    beaten = (keyed.join(inner, "key").where(
        (F.size("inner") < F.size("tokens")) & (F.col("inner_confidence") >= F.col("confidence"))
        & (F.size(F.array_except("inner", "tokens")) == 0)).select("tokens").distinct())
    return told_apart(found.join(beaten, "tokens", "left_anti"), alike)


def same_urls(baskets: DataFrame, least: float) -> DataFrame:
    """``members``: the tokens of at least ``least`` bad baskets, those that stand in the same baskets together, sorted.

    The set of baskets is told by its size and two 64-bit sums of its hashed numbers. Its tokens stand together in one url, so
    that a row is no longer than a url.
    """
    mark = lambda salt: F.bit_xor(F.xxhash64("at", F.lit(salt)))
    sets = (baskets.select("at", "bad", F.explode("tokens").alias("token")).groupBy("token")
            .agg(F.sum("bad").alias("bad"), F.count("*").alias("n"), mark(0).alias("one"), mark(1).alias("two"))
            .where(F.col("bad") >= least))
    return sets.groupBy("n", "one", "two").agg(F.array_sort(F.collect_list("token")).alias("members")).select("members")


def told_apart(rules: DataFrame, alike: DataFrame) -> DataFrame:
    """The rules in which a token stands for its ``members``, once for every choice of one member each."""
    several = alike.where(F.size("members") > 1).select(F.get("members", F.lit(0)).alias("token"), "members")
    lists = (rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(broadcast_if_few(cut(several)), "token", "left")
             .groupBy("tokens", "confidence").agg(F.collect_list(F.coalesce("members", F.array("token"))).alias("choices")))
    none = F.array(F.array().cast("array<string>"))
    choose = lambda done, members: F.flatten(F.transform(done, lambda d: F.transform(members, lambda m: F.array_append(d, m))))
    each = F.explode(F.aggregate("choices", none, choose)).alias("tokens")
    return lists.select(each, "confidence").select(F.array_sort("tokens").alias("tokens"), "confidence")


def rule_blocks(rules: DataFrame, urls: DataFrame, block_rules: int = BLOCK_RULES) -> Iterator[dict[str, list[frozenset]]]:
    """Inverted indexes (rarest token of a rule -> its rules), each of at most ``block_rules`` rules."""
    counts = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    used = rules.select(F.explode("tokens").alias("token")).distinct()
    often = broadcast_if_few(cut(counts.join(used, "token")))
    rarest = (rules.select("tokens", F.explode("tokens").alias("token")).join(often, "token")
              .groupBy("tokens").agg(F.min(F.struct("n", "token")).alias("rare")))
    index, size = defaultdict(list), 0
    for r in rarest.select("tokens", "rare.token").orderBy("token", "tokens").toLocalIterator():
        index[r.token].append(frozenset(r.tokens))
        size += 1
        if size == block_rules:
            yield dict(index)
            index, size = defaultdict(list), 0
    if size:
        yield dict(index)


def matches(tokens: list[str], index: dict[str, list[frozenset]]) -> bool:
    have = set(tokens)
    return any(rule <= have for t in have for rule in index.get(t, ()))


def totals(rules: DataFrame, urls: DataFrame, block_rules: int = BLOCK_RULES) -> DataFrame:
    """(tokens, total): how many urls hold each combination; one pass over the distinct token sets per block."""
    distinct = cut(urls.groupBy("tokens").agg(F.count("*").alias("n")))

    def count(index: dict[str, list[frozenset]]) -> DataFrame:
        sent = share(urls.sparkSession, index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, found = sent(), defaultdict(int)
            for b in batches:
                for tokens, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    have = set(tokens)
                    for t in have:
                        for rule in own.get(t, ()):
                            if rule <= have:
                                found[rule] += n
            yield pa.RecordBatch.from_arrays([pa.array([sorted(r) for r in found], pa.list_(pa.string())),
                                              pa.array(list(found.values()), pa.int64())], names=["tokens", "n"])

        return distinct.mapInArrow(run, "tokens array<string>, n long").groupBy("tokens").agg(F.sum("n").alias("total"))

    parts = [cut(count(index)) for index in rule_blocks(rules, distinct, block_rules)]
    return reduce(DataFrame.unionByName, parts) if parts else rules.select("tokens", F.lit(0).cast("long").alias("total"))


def _matches_udf(spark: SparkSession, index: dict[str, list[frozenset]]) -> Callable:
    sent = share(spark, index)

    @F.pandas_udf(T.BooleanType())
    def hit(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = sent()
        for tokens in parts:
            yield pd.Series([matches(list(t), own) for t in tokens], dtype=bool)

    return hit


def filter_urls(pages: DataFrame, labels: DataFrame, rules=LIST, min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE, min_pages: int = MIN_PAGES,
                block_rules: int = BLOCK_RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row; ``mined`` tells whether a mined rule fits."""
    urls = tokenized(pages, rules)
    mined = F.lit(False)
    found = cut(mine(urls, labels, min_support, min_confidence, min_pages, block_rules=block_rules))
    for index in rule_blocks(found, urls, block_rules):
        mined = mined | _matches_udf(pages.sparkSession, index)("tokens")
    df = urls.withColumn("mined", mined)
    verdict = F.coalesce(F.col("listed"), F.when(F.col("mined"), F.lit("block")).otherwise(F.lit("allow")))
    return df.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "mined")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
