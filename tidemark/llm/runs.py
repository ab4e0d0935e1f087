"""Periodic runs of words by an online sparse diagonal table.

A run with smallest period q is a stretch of words, each equal to the one q before it, of max(``MIN_WORDS``, ``MIN_REPEATS`` * q)
words or more that can't be made longer. Words are read once, in order. The table holds the diagonals that are alive: for a
lag, the place since which every word equals the one that lag before it (so its match length). A word's earlier occurrences
begin diagonals or carry them on; a diagonal that a word doesn't carry on ends there and is emitted at once if it is long
enough. Of diagonals over the same stretch the smallest lag is its period.

What keeps the table sparse, with the same result:

* Five matches in a row are the least that any run has. So the symbols compared are windows of five words, named by the first one;
  words whose window occurs once take part in nothing.
* Inside a run of period p that is long enough already, no lag above p is begun: a longer period that agrees with the run over
  its own length and p words is a multiple of a shorter one, so it is no smallest period. A lag that outlives the run is found at the next word
  outside and carried back to its first match.
* A lag above a quarter of the text can't make a run. Of many earlier occurrences only those begin a diagonal whose prefix sums
  agree over as many windows as a run of that lag still needs; the table decides about those, word by word.

A text of one repeated word or phrase is thus linear; the worst case is the square of how often one five-word window
recurs outside runs, in numpy steps.

Edge cases: a null text is empty; a text under six words has no run; white space around words goes and one space joins the kept words;
repeated rows each get their row; a null ``doc_id`` stays null (and the query leaves its text undamaged); extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WS_CLASS, fresh, read_table, text_or_empty

MIN_WORDS = 6
MIN_REPEATS = 4
WINDOW = 5  # matches in a row that any run has: max(6 - 1, 8 - 2, ...) from a period of 1 on
MANY = 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _windows(words: list[bytes]) -> np.ndarray | None:
    """A number per window of five words, equal for equal windows; None if no window occurs twice."""
    known: dict[bytes, int] = {}
    w = np.fromiter((known.setdefault(x, len(known)) for x in words), np.int64, len(words))
    if len(known) == len(words):
        return None
    n = len(w) - WINDOW + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(WINDOW):  # unequal sums are unequal windows
        mixed = mixed * _ODD + w[k:k + n].astype(np.uint64)
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():
        return None
    pair = np.unique(w[:-1] * len(known) + w[1:], return_inverse=True)[1]
    four = np.unique(pair[:-2] * len(w) + pair[2:], return_inverse=True)[1]
    return np.unique(four[:n] * len(known) + w[WINDOW - 1:], return_inverse=True)[1]


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    total = len(words)
    if total < MIN_WORDS or (numbers := _windows(words)) is None:
        return []
    order = np.argsort(numbers, kind="stable")
    ranked = numbers[order]
    first = np.searchsorted(ranked, ranked)  # of each sorted place: where its window's occurrences begin
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    begin = np.empty_like(order)
    begin[order] = first
    recurs = np.bincount(numbers)[numbers] > 1
    g, place, begin, occurrences = numbers.tolist(), place.tolist(), begin.tolist(), order.tolist()
    longest_lag = total // MIN_REPEATS
    alive: dict[int, int] = {}  # lag -> first window that matches the one lag before it
    found: dict[tuple[int, int], int] = {}  # (start, end) -> period

    def enough(lag: int, since: int, to: int) -> bool:
        return to - since + WINDOW - 1 + lag >= max(MIN_WORDS, MIN_REPEATS * lag)

    def end(lag: int, to: int) -> None:
        since = alive.pop(lag)
        if enough(lag, since, to):
            stretch = (since - lag, to + WINDOW - 1)
            found[stretch] = min(lag, found.get(stretch, lag))

    def lasting(i: int, lags: np.ndarray, slack: int) -> np.ndarray:
        """The lags whose match may last as long as a run asks. Runs of periods up to ``slack`` that end at ``i`` can have
        hidden at most slack + lag words of it."""
        asked = np.maximum((3 if not slack else 2) * lags - (WINDOW - 1) - slack, 1)
        lags, asked = lags[i + asked <= len(g)], asked[i + asked <= len(g)]
        ahead, behind = sums[i + asked] - sums[i], sums[i + asked - lags] - sums[i - lags]
        return lags[ahead == behind * powers[lags]]

    # Prefix sums of window numbers times powers: unequal sums are unequal stretches.
    powers = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(len(g), _ODD), dtype=np.uint64)))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((numbers.astype(np.uint64) + np.uint64(1)) * _ODD * powers[:-1], dtype=np.uint64)))
    before, cover, slack = -2, 0, 0
    for i in np.flatnonzero(recurs).tolist():
        if i != before + 1:
            for lag in list(alive):
                end(lag, before + 1)
            cover = slack = 0
        before, now = i, g[i]
        if alive:
            for lag in [q for q in alive if g[i - q] != now]:
                end(lag, i)
            cover = min((q for q, since in alive.items() if enough(q, since, i)), default=0)
            slack = max(slack, cover)
        reach = cover or longest_lag
        lo, hi = begin[i], place[i]
        if hi - lo > MANY:
            lo = bisect.bisect_left(occurrences, i - reach, lo, hi)
        lags = [i - j for j in occurrences[lo:hi]] if hi - lo <= MANY else lasting(i, i - order[lo:hi], slack).tolist()
        for lag in lags:
            if lag <= reach and lag not in alive:
                since = i
                while since > lag and g[since - 1] == g[since - 1 - lag]:
                    since -= 1
                alive[lag] = since
    for lag in list(alive):
        end(lag, before + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [w for w, out in zip(words, np.cumsum(steps).tolist()) if not out]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, ``runs`` (array of start, length, period; by start, then period) and ``collapsed`` (the kept words)."""
    schema = pa.schema([("doc_id", pa.int64()),
                        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                        ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                runs, kept = [], []
                for text in part.column(1).to_pylist():
                    words = text.encode("utf-8", "surrogatepass").split()  # at ASCII white space
                    found = find_runs(words)
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    kept.append(b" ".join(collapse(words, found) if found else words).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(runs, schema.field(1).type), pa.array(kept, pa.string())],
                                                 schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"))


def repeated_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, by the id's checksum, repeat a stretch of their words from some place to their end."""
    text, words, n, at = (fresh(x) for x in ("text", "words", "n", "at"))
    h = F.crc32(F.col("doc_id").cast("string"))
    g = _whole(h, F.lit(10))
    df = docs.select("doc_id", text_or_empty().alias(text))
    df = df.withColumn(words, F.when(F.col("doc_id").isNotNull() & (h % 10 == 0), F.regexp_extract_all(
        text, F.lit(f"([^{WS_CLASS}]+)"), F.lit(1))))
    df = df.withColumn(n, F.size(words).cast("long"))
    df = df.withColumn(at, g % F.greatest(F.col(n), F.lit(1)))
    period = 1 + _whole(F.col(n) - F.col(at), 3 + g % 8)
    tail = F.transform(F.sequence(F.col(at), F.col(n) - 1),
                       lambda i: F.get(F.col(words), (F.col(at) + (i - F.col(at)) % F.col("period")).cast("int")))
    again = F.concat_ws(" ", F.slice(F.col(words), F.lit(1), F.col(at).cast("int")), tail)
    return df.withColumn("period", period).select(
        "doc_id", F.when(F.col(words).isNull(), F.col(text)).when(F.col(n) > 0, again).otherwise("").alias("text"))


def _whole(a: Column, b: Column) -> Column:
    """a div b of whole numbers, a not negative."""
    return ((a - a % b) / b).cast("long")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(repeated_texts(read_table(spark, sf_dir, "documents")))
    runs = F.col("runs")
    best = F.element_at(F.array_sort(F.transform(runs, lambda r: F.struct(
        (-r.length).alias("by"), r.start.alias("start"), r.period.alias("period"), r.length.alias("length")))), 1)
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    some = F.size(runs) > 0
    return (found.withColumn("best", F.when(some, best))
            .select("doc_id", F.size(runs).cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("(1000 * best.length) div best.period").cast("long").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
