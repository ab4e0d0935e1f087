"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. The corpus is read once to count in how many documents each n-gram of the benchmark occurs.
2. Every stretch of ``SEED_STRETCH`` n-grams of an item keeps its ``SEEDS_PER_STRETCH`` rarest as seeds, so
   each part of an item has some, however often the item itself was copied.
3. The corpus is read again: a seed in a document proposes the stretch of the document that the item would
   cover, and a local alignment of the item's words with that stretch (match, mismatch and gap scores
   below) decides. A document leaks an item if the best alignment of any of its stretches reaches ``MIN_SHARE`` of
   the item's full score, or if any alignment there, best or not, holds ``MIN_RUN`` matching words or more
   at ``MIN_IDENTITY``: an exact search by the number of columns that don't match (``run``).

The benchmark goes to the tasks in blocks of items, each of at most ``BLOCK_WORDS`` words, so what is broadcast is
bounded; every block meets every document. Documents are neither shuffled nor grouped.

Words are runs of letters and digits, lower-cased: case and punctuation don't hide a copy.

An item of fewer than ``SEED_WORDS`` words can't be seeded, and its words stand in many clean texts: it leaks only in a
document that has these words and no others.

Edge cases: null or wordless texts and items leak nothing; repeated items are each reported; repeated rows each get theirs; a null ``doc_id`` is
reported as null; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, read_table, share, text_or_empty

SEED_WORDS = 3
SEED_STRETCH = 6
SEEDS_PER_STRETCH = 3
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SHARE = 0.5
MIN_RUN = 13
MIN_IDENTITY = 0.8
BLOCK_WORDS = 1_000_000
PROPOSALS = 1 << 18  # (place in a text, item) pairs that are laid out at once


def _least_matches(misses: int) -> int:
    """Fewest matches, and at least MIN_RUN, that hold MIN_IDENTITY with so many other columns."""
    return next(m for m in itertools.count(MIN_RUN) if m >= MIN_IDENTITY * (m + misses))


# Of an alignment with 2 * MIN_RUN matches or more, one half passes too, so that fewer matches are enough to look for.
RUN_MATCHES = tuple(itertools.takewhile(lambda m: m < 2 * MIN_RUN, map(_least_matches, itertools.count())))
# Its other columns cut an alignment into exact runs, the longest of which has so many words.
RUN_WORDS = min(-(-m // (x + 1)) for x, m in enumerate(RUN_MATCHES))

_WORD = re.compile(r"[^\W_]+")
Item = tuple[int, list[str]]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Index:
    """One block of items: word numbers, and the n-grams as sorted keys with the places they stand at."""

    def __init__(self, items: list[Item]):
        self.short: dict[tuple[str, ...], list[int]] = {}
        for item_id, words in items:
            if len(words) < SEED_WORDS:
                self.short.setdefault(tuple(words), []).append(item_id)
        self.items = items = [(i, words) for i, words in items if len(words) >= SEED_WORDS]
        self.number: dict[str, int] = {}
        for _, words in items:
            for w in words:
                self.number.setdefault(w, len(self.number) + 1)
        self.coded = [np.array([self.number[w] for w in words], np.int64) for _, words in items]
        self.lengths = np.array([len(c) for c in self.coded], np.int64)
        self.base = len(self.number) + 1
        keys, item, at = [], [], []
        for k, code in enumerate(self.coded):
            grams = self.grams(code)
            keys.append(grams)
            item.append(np.full(len(grams), k))
            at.append(np.arange(len(grams)))
        self.key = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        self.item = np.concatenate(item) if item else np.empty(0, np.int64)
        self.at = np.concatenate(at) if at else np.empty(0, np.int64)
        self._sort()

    def _sort(self) -> None:
        order = np.argsort(self.key, kind="stable")
        self.key, self.item, self.at = self.key[order], self.item[order], self.at[order]
        self.until = self.at
        self.distinct = np.unique(self.key)

    def _join_places(self) -> None:
        """One entry per n-gram and item, with its first and last place there: less than the item's length apart, so the
        stretches that they propose around one place of a document overlap and are one stretch."""
        order = np.lexsort((self.at, self.item, self.key))
        key, item, at = self.key[order], self.item[order], self.at[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (item[1:] != item[:-1])
        last = np.append(first[1:], True)[:len(key)]
        self.key, self.item, self.at, self.until = key[first], item[first], at[first], at[last]

    def grams(self, code: np.ndarray, size: int = SEED_WORDS) -> np.ndarray:
        """Key of the n-gram at every place, 0 where it holds a word that no item has.

        Keys are exact below 2^64 / base^n words; past that, a clash only proposes one more alignment.
        """
        n = len(code) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        key = np.zeros(n, np.uint64)
        known = np.ones(n, bool)
        for i in range(size):
            part = code[i:i + n]
            key = key * np.uint64(self.base) + part.astype(np.uint64)
            known &= part > 0
        return np.where(known, key, np.uint64(0))

    def code(self, words: list[str]) -> np.ndarray:
        get = self.number.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def hits(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``code`` whose n-gram is in the index, and the n-grams' keys."""
        grams = self.grams(code)
        if not len(grams) or not len(self.distinct):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        near = np.minimum(np.searchsorted(self.distinct, grams), len(self.distinct) - 1)
        places = np.flatnonzero((self.distinct[near] == grams) & (grams > 0))
        return places, grams[places]

    def keep_rare(self, frequency: dict[int, int]) -> None:
        """Keep, in every stretch of an item's n-grams, those that the fewest documents hold."""
        df = np.array([frequency.get(int(k), 0) for k in self.key], np.int64)
        stretch = self.at // SEED_STRETCH
        order = np.lexsort((self.at, df, stretch, self.item))
        first = np.ones(len(order), bool)
        first[1:] = (self.item[order][1:] != self.item[order][:-1]) | (stretch[order][1:] != stretch[order][:-1])
        start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        kept = order[np.arange(len(order)) - start < SEEDS_PER_STRETCH]
        self.key, self.item, self.at = self.key[kept], self.item[kept], self.at[kept]
        self._join_places()
        self.distinct = np.unique(self.key)

    def proposals(self, code: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Per item: the stretches (start, end) of the document that its seeds propose, overlapping ones merged.

        At most ``PROPOSALS`` pairs of a place and an item (or the items of one place) are laid out at once; what stays of them is merged."""
        places, keys = self.hits(code)
        if not len(places):
            return {}
        lo, hi = np.searchsorted(self.key, keys), np.searchsorted(self.key, keys, side="right")
        upto = np.cumsum(hi - lo)
        merged = np.empty((0, 3), np.int64)  # item, start, end
        begin = 0
        while begin < len(places):
            done = upto[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(upto, done + PROPOSALS, side="right")))
            merged = _merge(np.concatenate([merged, self._stretches(places[begin:stop], lo[begin:stop], hi[begin:stop], len(code))]))
            begin = stop
        found: dict[int, list[tuple[int, int]]] = {}
        for k, s, e in merged.tolist():
            found.setdefault(k, []).append((s, e))
        return found

    def _stretches(self, places: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
        n = hi - lo
        at = np.repeat(places, n)
        ref = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        items = self.item[ref]
        length = self.lengths[items]
        slack = length // 4 + 2
        start = np.maximum(at - self.until[ref] - slack, 0)
        end = np.minimum(at - self.at[ref] + length + slack, size)
        return np.stack([items, start, end], axis=1)


def _merge(stretches: np.ndarray) -> np.ndarray:
    """(item, start, end) rows in order, those of an item that overlap or touch as one."""
    item, start, end = stretches[np.lexsort((stretches[:, 1], stretches[:, 0]))].T
    # the furthest end so far, per item: items are lifted above each other
    lift = (item - item.min()) * (end.max() + 2)
    reach = np.maximum.accumulate(end + lift)
    first = np.ones(len(item), bool)
    first[1:] = start[1:] + lift[1:] > reach[:-1]
    last = np.append(first[1:], True)
    return np.stack([item[first], start[first], reach[last] - lift[last]], axis=1)


def align(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment (score, matches, columns, end in ``part``) of two word-number arrays.

    One numpy row per item word; a gap along the row is a running maximum, as its price is linear.
    The counts ride in the score's lower digits, so they follow the path that wins.
    """
    unit, one = 1 << 40, 1 << 20  # score * unit + matches * one - columns: the best score, then most matches, then the shortest
    steps = np.arange(len(part) + 1, dtype=np.int64)
    gap = -(-GAP * unit + 1)
    row = np.zeros(len(part) + 1, np.int64)
    best, end = 0, 0
    for w in item:
        same = part == w
        new = np.zeros_like(row)
        step = np.where(same, MATCH * unit + one - 1, MISMATCH * unit - 1)
        new[1:] = np.maximum(row[:-1] + step, row[1:] + gap)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new - gap * steps) + gap * steps
        np.maximum(new, 0, out=new)
        row = new
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    score = (best + unit // 2) // unit
    rest = best - score * unit
    matches = -(-rest // one)
    return score, matches, matches * one - rest, end


def run(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int, int] | None:
    """(score, matches, start, end in ``part``) of the best alignment that passes the run test; None if none does.

    Layer x of a row holds, per end in ``part``, the most matches of an alignment with at most x other columns, and in
    the lower digits its start (the latest one).
    """
    one = 1 << 32
    least = np.array(RUN_MATCHES, np.int64) * one
    empty = np.arange(len(part) + 1, dtype=np.int64)
    row = np.tile(empty, (len(least), 1))
    best = None
    for w in item:
        same = part == w
        new = np.tile(empty, (len(least), 1))
        new[1:, 1:] = np.maximum(new[1:, 1:], np.maximum(row[:-1, :-1], row[:-1, 1:]))
        new[:, 1:] = np.where(same, np.maximum(new[:, 1:], row[:, :-1] + one), new[:, 1:])
        for x in range(1, len(least)):
            np.maximum(new[x, 1:], new[x - 1, :-1], out=new[x, 1:])
        row = new
        for x in np.flatnonzero(row.max(axis=1) >= least).tolist():
            end = int(row[x].argmax())
            matches, start = divmod(int(row[x, end]), one)
            score = MATCH * matches + MISMATCH * x
            if best is None or score > best[0]:
                best = (score, matches, start, end)
    return best


def leaks(index: Index, words: list[str]) -> list[tuple[int, float, int, int, int]]:
    """(item_id, share, matches, start, end) of every item that a document holds; the place in words."""
    if words and len(words) < SEED_WORDS:
        ids = sorted(index.short.get(tuple(words), ()), key=lambda i: (i is None, i or 0))
        return [(i, 1.0, len(words), 0, len(words)) for i in ids]
    code = index.code(words)
    out = []
    for k, parts in index.proposals(code).items():
        item_id, item = index.items[k][0], index.coded[k]
        full, best = MATCH * len(item), None
        runs = index.grams(item, RUN_WORDS)
        for s, e in parts:
            # a long run of merged proposals is read in pieces that overlap by twice the item
            for at in range(s, max(s + 1, e - 2 * len(item)), 2 * len(item)):
                part = code[at:min(e, at + 4 * len(item))]
                score, matches, columns, end = align(item, part)
                start = end - columns
                if score < MIN_SHARE * full and (matches < MIN_RUN or matches < MIN_IDENTITY * columns):
                    # not as a whole, but it or another alignment may hold a run
                    shared = len(item) >= MIN_RUN and np.isin(index.grams(part, RUN_WORDS), runs[runs > 0]).any()
                    passing = run(item, part) if shared else None
                    if passing is None:
                        continue
                    score, matches, start, end = passing
                found = (score / full, matches, at + start, at + end)
                best = found if best is None else max(best, found)
        if best is not None:
            share, matches, start, end = best
            out.append((item_id, share, matches, max(start, 0), end))
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0))


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[Item]]:
    """The benchmark's items in id order, in lists of at most ``block_words`` words (a longer item alone)."""
    rows = benchmark.select(F.col("item_id"), text_or_empty().alias("text")).orderBy("item_id", "text")
    block, size = [], 0
    for r in rows.toLocalIterator():
        words = words_of(r.text)
        if not words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((r.item_id, words))
        size += len(words)
    if block:
        yield block


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_or_empty().alias("text"))


def document_frequency(docs: DataFrame, index: Index) -> dict[int, int]:
    """Number of documents that hold each n-gram of the block (at most one entry per n-gram of the block)."""
    shared = share(docs.sparkSession, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, total = shared(), Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                total.update(np.unique(idx.hits(idx.code(words_of(text)))[1]).tolist())
        keys = np.array(list(total), np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(list(total.values()), pa.int64())], names=["k", "n"])

    rows = _texts(docs).mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    return {r.k % (1 << 64): r.n for r in rows}


LEAK = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("share", T.DoubleType()),
    T.StructField("matches", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with one more column ``leaks``: the items each text holds, by item_id."""
    name = "leaks"
    parts = []
    for block in blocks(benchmark, block_words):
        index = Index(block)
        index.keep_rare(document_frequency(docs, index))
        docs = docs.withColumn(part := fresh("leaks"), _leaks_udf(docs.sparkSession, index)(text_or_empty()))
        parts.append(part)
    found = F.concat(*parts) if parts else F.array().cast(LEAK)
    return docs.withColumn(name, found).drop(*parts)


def _leaks_udf(spark: SparkSession, index: Index) -> Callable:
    shared = share(spark, index)
    names = ("item_id", "share", "matches", "start", "end")

    @F.pandas_udf(LEAK)
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        idx = shared()
        for texts in parts:
            yield pd.Series([[dict(zip(names, x)) for x in leaks(idx, words_of(t))] for t in texts])

    return found


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and item that it leaks."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = find_leaks(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id", F.explode("leaks").alias("leak"))
    return rows.select("doc_id", "leak.item_id", F.round("leak.share", 6).alias("share"), "leak.matches", "leak.start", "leak.end")


def drop_leaking(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns."""
    whole = fresh("row")
    rows = docs.select(F.struct("*").alias(whole), text_or_empty().alias("text"))
    return find_leaks(rows, benchmark, **options).where(F.size("leaks") == 0).select(f"{whole}.*")
