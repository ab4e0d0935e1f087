"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share
``TOTAL_SHARE`` of all words; a target stops at ``MAX_EPOCHS`` times its source's size and the excess is
shared again by weight until no source is above (water filling over the source table).

Sample: a source first takes its complete epochs; of what is left of its target, documents are taken
in the order of exponential keys ``-ln(u) / weight``, u from the document id and weight from the
document's quality, until the words are used up; the document on the edge gives only the words still asked.

The running sum is split: a source's keys fall into ``buckets`` ranges (as many as its rows need), only
the bucket that holds the edge is summed row by row, and the result per source is one cut key. Every
document is then judged by itself against its source's cut, so a source with a third of all rows neither
meets in one task nor is shuffled with its text. Documents with equal keys (repeated ids) are one unit: the
words asked of a unit on the edge are shared in proportion to size.

Edge cases: a null text has size 0 and takes 0; a null source is a source of its own; a null ``doc_id`` has one
key for all such rows; extra columns are ignored; a source of size 0 has target 0; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_few, count_words, cut, fresh, read_table, text_or_empty

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
ROWS_PER_BUCKET = 2_000
SEED = "mix-1"
#: Quality weight: LOW_WEIGHT for a text of symbols only, 1 for one without any.
LOW_WEIGHT = 0.1


def quality_weight(text: Column) -> Column:
    """1 less the share of symbols among the characters, LOW_WEIGHT at least (ten decimals)."""
    size = F.length(text)
    symbols = size - F.length(F.regexp_replace(text, r"[#*$%&|<>]++", ""))
    return F.when(size > 0, F.greatest(F.lit(LOW_WEIGHT), F.round(1 - symbols / size, 10))).otherwise(F.lit(1.0))


def _key(doc_id: Column, weight: Column, seed: str) -> Column:
    """Exponential key; u is 48 bits of an MD5, never 0."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``target`` for every row of (source, source_size).

    In order of size per weight, the sources that reach their cap come first: with level t the words
    per weight, a source gets min(cap, weight * t). One ordered prefix over the source table gives t.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
    s = sizes.withColumn("w", w).withColumn("cap", max_epochs * F.col("source_size").cast("double"))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    s = (s.withColumn("place", F.row_number().over(filling))
         .withColumn("budget", F.lit(total_share) * F.sum("source_size").over(everything))
         .withColumn("level", (F.col("budget") - F.coalesce(
             F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("w").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("full", F.col("cap") <= F.col("w") * F.col("level")))
    # the level that holds is that of the first source that does not reach its cap
    first = F.min(F.when(~F.col("full"), F.struct("place", "level"))).over(everything)
    return s.withColumn("first", first).select("source", "source_size", F.round(
        F.when(F.col("full") | F.col("first").isNull(), F.col("cap"))
        .otherwise(F.least(F.col("cap"), F.col("w") * F.col("first.level"))), 6).alias("target"))


def cuts(sized: DataFrame, goals: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Per source: whole epochs, the key of the unit on the edge, that unit's size and the words asked of it.

    ``sized`` has source, size, key; ``goals`` has source, source_size, target and n_rows.
    """
    rest = (goals.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                             .otherwise(F.lit(0)).cast("long"))
            .withColumn("rest", F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size"))
            .withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("n_rows") / rows_per_bucket))))
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("name")  # a key that is never null
    rest = rest.withColumn("name", name)
    rows = sized.withColumn("name", name).join(broadcast_if_few(rest.select("name", "buckets")), "name")
    bucket = F.least(F.floor((1 - F.exp(-F.col("key"))) * F.col("buckets")), F.col("buckets") - 1)
    units = rows.groupBy("name", bucket.alias("bucket"), "key").agg(F.sum("size").alias("size"))
    units = cut(units)
    totals = units.groupBy("name", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = (totals.withColumn("before", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
            .join(rest.select("name", "rest"), "name")
            .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
            .select("name", "bucket", "before", "rest"))
    within = Window.partitionBy("name", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    at = (units.join(edge, ["name", "bucket"])
          .withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
          .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("size")))
          .select("name", F.col("key").alias("cut_key"), F.col("size").alias("unit"),
                  (F.col("rest") - F.col("before")).alias("asked")))
    # no edge: the words left are exactly all of the source's (or it has none)
    return rest.join(at, "name", "left").select("name", "source_size", "target", "epochs", "rest", "cut_key", "unit", "asked")


def mix(docs: DataFrame, carry: tuple[str, ...] = (), weights=WEIGHTS, total_share: float = TOTAL_SHARE,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row, and the columns ``carry``."""
    text = text_or_empty()
    sized = docs.select(*carry, F.col("doc_id"), F.col("source").cast("string").alias("source"),
                        count_words(text).alias("size"), _key(F.col("doc_id"), quality_weight(text), seed).alias("key"))
    small = cut(sized.select("source", "size", "key"))
    per_source = cut(small.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")))
    goals = targets(per_source, weights, total_share, max_epochs).join(
        per_source.select(F.col("source").alias("s2"), "n_rows"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    edges = cut(cuts(small, goals, rows_per_bucket))
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    part = (F.when(F.col("cut_key").isNull(), F.when(F.col("rest") > 0, F.col("size")).otherwise(F.lit(0)))
            .when(F.col("key") < F.col("cut_key"), F.col("size"))
            .when((F.col("key") == F.col("cut_key")) & (F.col("unit") > 0),
                  F.floor(F.col("size").cast("double") * F.col("asked") / F.col("unit")).cast("long"))
            .otherwise(F.lit(0)))
    return (sized.withColumn("name", name).join(broadcast_if_few(edges), "name")
            .withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long"))
            .select(*carry, "doc_id", "source", "size", "source_size", "target", "taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes words of: their columns, then size, source_size, target and taken
    (an input column of one of these names gives way)."""
    added = ("size", "source_size", "target", "taken")
    whole = fresh("row")
    rows = mix(docs.withColumn(whole, F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added])), carry=(whole,), **options)
    return rows.where("taken > 0").select(f"{whole}.*", *added)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).drop("source")


# The same by its definitions: an iterated reshare and a plain running sum.
OP9_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         greatest({LOW_WEIGHT}, CASE WHEN length(coalesce(text, '')) = 0 THEN 1.0 ELSE round(1 - (length(text)
           - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::DOUBLE / length(text), 10) END) AS weight,
         (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5)
           / 281474976710656.0 AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS w
      FROM d GROUP BY source),
r(round, source, source_size, w, target, capped) AS (
  SELECT 0, source, source_size, w, 0::DOUBLE, false FROM s
  UNION ALL
  SELECT round + 1, source, source_size, w, t, t >= 2.0::DOUBLE * source_size FROM (
    SELECT *, CASE WHEN capped THEN 2.0::DOUBLE * source_size ELSE least(2.0::DOUBLE * source_size, w * (
        1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(CASE WHEN capped THEN 2.0::DOUBLE * source_size END) OVER (), 0))
        / sum(CASE WHEN NOT capped THEN w END) OVER ()) END AS t
    FROM r WHERE round < 60) q),
goal AS (SELECT source, source_size, round(target, 6) AS target FROM r WHERE round = 60),
k AS (
  SELECT d.doc_id, d.source, d.size, g.source_size, g.target, -ln(u) / weight AS k,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS epochs
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
p AS (SELECT *, floor(target) - epochs * source_size
             - (sum(size) OVER (PARTITION BY source ORDER BY k) - size) AS room FROM k)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken
FROM p
"""
