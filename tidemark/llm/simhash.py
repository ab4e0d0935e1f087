"""SimHash near-duplicate groups by tiled exact comparison.

1. Fingerprint of every text: XXH64 of its word shingles, one majority vote per bit.
2. Equal fingerprints collapse to one row, so a group of copies of any size is one node.
3. Two fingerprints at most ``radius`` bits apart agree in at least one of ``radius + 1`` bands
   of the 64 bits. Each fingerprint therefore goes to one bucket per band. A bucket is cut
   into tiles of at most ``tile_rows`` fingerprints in order of their population count, and a pair
   of tiles is compared (numpy exclusive-or and bit counts) only if their population counts come within
   the radius of each other. A bucket of any size is thus many bounded tasks, and no link is lost.
4. A tile pair returns a spanning forest of its links, not every pair.
5. Groups are the connected components of the links, by alternating large-star / small-star
   rounds over the edge table, each round cut by ``checkpoint()``.

Edge cases: a null text is empty; a text without words has fingerprint zero and links like any other; a
null ``doc_id`` takes part but never names a group unless the whole group has none (then
``component_id`` is null); repeated rows each get their row; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, fresh, read_table, text_or_empty

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
TILE_ROWS = 4096
_BLOCK = 1 << 16  # shingles whose bits are unpacked at once


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of one text (A-Z lowered, ASCII white space splits words)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[s:e], SEED) for s, e in zip(starts[:n - shingle_words + 1].tolist(),
                                                       ends[shingle_words - 1:].tolist())),
            np.uint64, n - shingle_words + 1)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[at:at + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, digest: bool = False) -> DataFrame:
    """(doc_id, fp) for every row, and the text's SHA-256 as ``digest`` if asked; ``fp`` holds the 64 bits in a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle_words) for t in b.column(1).to_pylist()), np.uint64, len(b))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", "digest"][:len(b.columns)])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *([_digest().alias("digest")] if digest else []))
    return src.mapInArrow(run, "doc_id long, fp long" + (", digest string" if digest else ""))


def _digest() -> Column:
    return F.sha2(text_or_empty(), 256)


def _bands(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of ``radius + 1`` bands covering 64 bits."""
    edges = np.linspace(0, 64, radius + 2).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:])]


def _forest(fps: np.ndarray, other: np.ndarray | None, radius: int) -> np.ndarray:
    """Spanning links among ``fps`` (``other`` None) or between ``fps`` and ``other``."""
    rows = fps if other is None else np.concatenate([fps, other])
    right, base = (fps, 0) if other is None else (other, len(fps))
    parent = list(range(len(rows)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    for at in range(0, len(fps), 256):
        near = np.bitwise_count(fps[at:at + 256, None] ^ right[None, :]) <= radius
        for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
            a, b = find(at + i), find(base + j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((at + i, base + j))
    at = np.array(found, dtype=np.int64).reshape(-1, 2)
    return rows[at]


def _small(fps: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """All links inside groups of consecutive rows, every row against the d-th after it."""
    found = [np.empty((0, 2), np.uint64)]
    d = 1
    while d < len(fps) and (same := group[d:] == group[:-d]).any():
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(fps[at] ^ fps[at + d]) <= radius]
        found.append(np.column_stack([fps[at], fps[at + d]]))
        d += 1
    return np.concatenate(found)


def _compare(radius: int):
    """mapInArrow body over rows sorted by tile pair: columns fp, pair, low_side, paired."""
    def flush(fp: np.ndarray, group: np.ndarray, low: np.ndarray, paired: np.ndarray) -> list[np.ndarray]:
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        counts = np.diff(np.append(starts, len(fp)))
        small = np.repeat((counts <= 64) & ~paired[starts], counts)
        out = [_small(fp[small], group[small], radius)]
        for s, n in zip(starts[~small[starts]].tolist(), counts[~small[starts]].tolist()):
            rows, side = fp[s:s + n], low[s:s + n]
            out.append(_forest(rows[side], rows[~side], radius) if paired[s] else _forest(rows, None, radius))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                cols = [np.asarray(b.column(i).to_numpy(zero_copy_only=False)) for i in range(4)]
                cols[0] = cols[0].astype(np.int64).view(np.uint64)
                kept = cols if kept is None else [np.concatenate(x) for x in zip(kept, cols)]
                group = kept[1]
                end = int(np.searchsorted(group, group[-1])) if len(group) and group[0] != group[-1] else 0
                done, kept = [x[:end] for x in kept], [x[end:] for x in kept]
            else:
                done, kept = kept or [np.empty(0)], None
            if len(done[0]):
                out = np.concatenate(flush(*done)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

    return run


def links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints of ``fps`` within ``radius`` bits."""
    bands = F.array(*[F.struct(F.lit(k).alias("band"),
                               F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)).alias("value"))
                      for k, (s, w) in enumerate(_bands(radius))])
    member = (fps.select("fp").distinct()
              .select("fp", F.bit_count("fp").alias("pop"), F.explode(bands).alias("b"))
              .select("fp", "pop", "b.band", "b.value"))
    # population counts of a bucket (65 at most): how many tiles each needs; alone, a row has no partner
    sizes = member.groupBy("band", "value", "pop").agg(F.count("*").alias("n"))
    tiles = (sizes.groupBy("band", "value")
             .agg(F.sum("n").alias("rows"), F.collect_list(F.struct(
                 "pop", F.ceil(F.col("n") / F.lit(tile_rows)).cast("int").alias("tiles"))).alias("pops"))
             .where("rows > 1"))
    own = F.element_at(F.filter("pops", lambda p: p.pop == F.col("pop")), 1).tiles
    whole = F.col("rows") <= tile_rows  # the bucket is one tile
    tile = lambda pop, n: F.struct(pop.cast("int").alias("pop"), n.cast("int").alias("tile"))
    at = (member.join(tiles, ["band", "value"])
          .withColumn("me", F.when(whole, tile(F.lit(-1), F.lit(0))).otherwise(
              tile(F.col("pop"), F.pmod(F.xxhash64("fp"), own)))))
    # A fingerprint meets the tiles whose population count is within the radius of its own;
    # a pair of tiles is one group, named by its lower and its upper tile.
    near = F.filter("pops", lambda p: F.abs(p.pop - F.col("pop")) <= radius)
    meets = F.flatten(F.transform(near, lambda p: F.transform(
        F.sequence(F.lit(0), p.tiles - 1), lambda t: tile(p.pop, t))))
    at = at.select("band", "value", "fp", "me", F.explode(F.when(whole, F.array("me")).otherwise(meets)).alias("it"))
    at = at.select("fp", F.xxhash64("band", "value", F.least("me", "it"), F.greatest("me", "it")).alias("pair"),
                   (F.col("me") <= F.col("it")).alias("low_side"), (F.col("me") != F.col("it")).alias("paired"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (at.repartition(n, "pair").sortWithinPartitions("pair")
            .select("fp", "pair", "low_side", "paired").mapInArrow(_compare(radius), "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components of ``edges`` (a, b); root is the smallest node.

    Alternating large-star / small-star: every node links its larger neighbours to its smallest one,
    then its smaller neighbours and itself; a few rounds leave only stars. Only minima are
    grouped, never neighbour lists, so a hub of any degree is pre-aggregated.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        small = cut(small)
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            return small.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = small


def _named(fps: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """(fp, group): of each distinct fingerprint of ``fps`` one fingerprint that its group shares."""
    comp = components(links(fps, radius, tile_rows))
    # linked fingerprints only: a small part of all, and one row each
    linked = (comp.select(F.col("node").alias("fp"), "root")
              .unionByName(comp.select(F.col("root").alias("fp"), "root").distinct()))
    return fps.select("fp").distinct().join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("group"))


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                   tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    fps = cut(fingerprints(docs, shingle_words))
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = first.join(_named(fps, radius, tile_rows), "fp")
    group = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = named.join(group, "group").select("fp", "component_id")
    return (fps.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one_per_group(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                       tile_rows: int = TILE_ROWS) -> DataFrame:
    """``docs`` without near-duplicates: of each group the document with the smallest id stays (without an id: last).

    A document is an id and a text, never an id alone: rows that share a ``doc_id`` but not their text are two documents, and each
    is judged by its own group. Rows that share both are one (any one of them stays). Of equal ids in a group the text with the
    smaller digest stays.
    """
    fps = cut(fingerprints(docs, shingle_words, digest=True))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("none")), "digest")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest"))
    first = fps.groupBy("fp").agg(least.alias("least"))
    best = first.join(_named(fps, radius, tile_rows), "fp").groupBy("group").agg(F.min("least").alias("best")).select("best.*")
    at, digest = fresh("name"), fresh("digest")
    kept = cut(best.select(name.alias(at)))
    whole = docs.withColumn(digest, _digest())
    whole = whole.withColumn(at, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("none")), digest))
    return whole.drop(digest).dropDuplicates([at]).join(kept, at, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents"))


