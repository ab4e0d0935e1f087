"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five transducers rewrite the words of a clause into tags:

- insult: a trie of words and word beginnings with weights, learned from labelled documents;
- threat, target, negation, reported speech: small fixed word lists.

``compose`` makes one transducer of the five: it reads the tags of one clause from left to right, its state
remembers what stands before (a negation, a reporting verb, a target) or guesses what comes (a target), and every insult
or threat emits its weight times the arc's factor. A clause scores what its best path to a final state emits. A document's score is a
logistic function of its clause scores (strongest clause, sum, matched clauses, share of words matched), fitted on
the same labelled documents.

Labels are learned from rows whose crc32(doc_id as text) mod 3 is not 1, from at most ``TRAIN_DOCUMENTS`` labels
(those with the smallest hash of their id) and as many different texts, each with the number of its rows; scoring reads only the text.

Edge cases: null and empty texts score like any text without a match; a document without words is scored; repeated
rows each get their row; a document labelled twice counts as toxic if one label is; null labels are left out;
without usable labels of both kinds every score is 0; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, read_table, share, text_or_empty

TRAIN_DOCUMENTS = 20_000
MIN_TOXIC_SHARE = 0.01     # an insult stands in this share of the toxic sample at least
MIN_TOXIC_DOCUMENTS = 5
MIN_PURITY = 0.85          # of the documents it stands in, this share is toxic
PREFIXES = (4, 5, 6, 7)    # lengths of word beginnings that are learned
THRESHOLD = 0.7
FOLDS = 3

# Closed word lists of the four context transducers (en, de, fr, es).
THREAT = {"kill", "hurt", "destroy", "shoot", "stab", "strangle", "murder", "beat", "umbringen", "töten", "schlagen",
          "tuer", "frapper", "matar", "golpear", "destruir"}
TARGET = {"you", "your", "you're", "u", "he", "she", "they", "them", "him", "her", "their", "this", "these", "those",
          "du", "dich", "dein", "ihr", "euch", "er", "sie", "tu", "toi", "ton", "vous", "votre", "il", "elle", "ils",
          "tú", "te", "usted", "ustedes", "él", "ella", "ellos"}
NEGATION = {"not", "no", "never", "isn't", "aren't", "wasn't", "don't", "nicht", "kein", "keine", "nie", "niemals",
            "ne", "jamais", "aucun", "nunca", "jamás", "ningún", "tampoco"}
REPORTED = {"said", "says", "told", "wrote", "quoted", "reported", "claimed", "called", "sagte", "schrieb", "nannte",
            "erklärte", "dit", "écrit", "déclaré", "dijo", "escribió", "llamó", "declaró"}

# Tags of words, and the five transducers over them. A transducer passes every tag on and prices it by a factor; where it has no
# arc it stays and leaves the price as it is.
WORD, INSULT, MENACE, AIM, NOT, SAID = range(6)


@dataclass(frozen=True)
class Transducer:
    """``arcs``: (state, tag) -> ((next state, factor), ...). A path runs from any start to any final state."""
    starts: tuple
    finals: frozenset
    arcs: dict

    def step(self, state, tag: int) -> tuple:
        return self.arcs.get((state, tag), ((state, 1.0),))


INSULTS = Transducer((0,), frozenset({0}), {(0, INSULT): ((0, 1.0),)})
THREATS = Transducer((0,), frozenset({0}), {(0, MENACE): ((0, 0.5),)})
# "ahead" guesses at the clause's start that a target comes later; without one no path that guessed is final
TARGETS = Transducer(("none", "ahead"), frozenset({"none", "seen"}), {
    ("none", AIM): (("seen", 1.0),), ("ahead", AIM): (("seen", 1.0),),
    ("ahead", INSULT): (("ahead", 1.25),), ("ahead", MENACE): (("ahead", 2.0),),
    ("seen", INSULT): (("seen", 1.25),), ("seen", MENACE): (("seen", 2.0),)})
# a negation reaches the next insult or threat; a second one undoes it
NEGATIONS = Transducer(("plain",), frozenset({"plain", "negated"}), {
    ("plain", NOT): (("negated", 1.0),), ("negated", NOT): (("plain", 1.0),),
    ("negated", INSULT): (("plain", 0.5),), ("negated", MENACE): (("plain", 0.4),)})
REPORTS = Transducer(("own",), frozenset({"own", "reported"}), {
    ("own", SAID): (("reported", 1.0),), ("reported", INSULT): (("reported", 0.6),), ("reported", MENACE): (("reported", 0.6),)})


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Both at once, over the pairs of states that a start reaches: a tag's price is the product of their prices."""
    starts = tuple((x, y) for x in a.starts for y in b.starts)
    arcs, seen, todo = {}, set(starts), list(starts)
    while todo:
        x, y = todo.pop()
        for tag in range(WORD, SAID + 1):
            out = tuple(((p, q), f * g) for p, f in a.step(x, tag) for q, g in b.step(y, tag))
            arcs[(x, y), tag] = out
            for state, _ in out:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
    return Transducer(starts, frozenset(s for s in seen if s[0] in a.finals and s[1] in b.finals), arcs)


GRAMMAR = reduce(compose, (INSULTS, THREATS, TARGETS, NEGATIONS, REPORTS))
MENACE_WEIGHT = 1.0

_CLAUSE = re.compile(r"[.,;:!?\n|()]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
FEATURES = ("strongest", "total", "clauses", "share")


def insult_weight(word: str, terms: dict[str, float]) -> float:
    """Weight of the longest learned entry that accepts the word: itself, or a beginning (marked ``*``)."""
    if word in terms:
        return terms[word]
    for n in reversed(PREFIXES):
        if len(word) >= n and (w := terms.get(word[:n] + "*")) is not None:
            return w
    return 0.0


def tag(word: str, terms: dict[str, float]) -> tuple[int, float]:
    if w := insult_weight(word, terms):
        return INSULT, w
    for words, name in ((THREAT, MENACE), (TARGET, AIM), (NEGATION, NOT), (REPORTED, SAID)):
        if word in words:
            return name, MENACE_WEIGHT if name == MENACE else 0.0
    return WORD, 0.0


# The composed states by number, and per tag the arcs (from, to, factor) that price or move anything.
_NUMBER = {state: i for i, state in enumerate(dict.fromkeys([*GRAMMAR.starts, *(s for s, _ in GRAMMAR.arcs)]))}
_STEPS = {tag: [(_NUMBER[s], _NUMBER[t], f) for (s, g), out in GRAMMAR.arcs.items() if g == tag for t, f in out] for tag in range(INSULT, SAID + 1)}
_BEGIN = [0.0 if s in GRAMMAR.starts else -math.inf for s in _NUMBER]
_FINAL = [_NUMBER[s] for s in GRAMMAR.finals]


def clause_score(words: list[str], tags: dict[str, tuple[int, float]]) -> tuple[float, int]:
    """What the best path emits over one clause, and how many words emit."""
    read = [t for t in map(tags.__getitem__, words) if t[0] != WORD]
    hits = sum(name in (INSULT, MENACE) for name, _ in read)
    if not hits:
        return 0.0, 0
    best = _BEGIN
    for name, weight in read:
        new = [-math.inf] * len(best)
        for s, t, factor in _STEPS[name]:
            score = best[s] + weight * factor
            if score > new[t]:
                new[t] = score
        best = new
    return max(best[i] for i in _FINAL), hits


class Grammar:
    """The transducers with a memory of the tags of the words met so far (emptied when it grows large)."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.tags: dict[str, tuple[int, float]] = {}

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        if len(self.tags) > 500_000:
            self.tags.clear()
        tags, terms = self.tags, self.terms
        text = (text or "").lower()
        words = _WORD.findall(text)
        emitting = False
        for w in set(words):
            if w not in tags:
                tags[w] = tag(w, terms)
            emitting |= tags[w][0] in (INSULT, MENACE)
        if not emitting:
            return 0.0, 0.0, 0.0, 0.0
        strongest, total, matched, hits = 0.0, 0.0, 0, 0
        for clause in _CLAUSE.split(text):
            inside = _WORD.findall(clause)
            for w in inside:  # a clause edge may cut a word the text had whole
                if w not in tags:
                    tags[w] = tag(w, terms)
            score, n = clause_score(inside, tags)
            strongest, total, matched, hits = max(strongest, score), total + score, matched + (score > 0), hits + n
        return strongest, math.log1p(total), math.log1p(matched), hits / max(1, len(words))


def training_documents(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS) -> DataFrame:
    """(text, toxic, n) of at most ``limit`` different labelled texts outside the held-out third: ``n`` rows hold the text with this label."""
    known = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) != 1)
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    known = known.select(F.col("doc_id").alias("labelled"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    rows = (docs.select("doc_id", text_or_empty().alias("text"))
            .join(F.broadcast(known), F.col("doc_id") == F.col("labelled")).groupBy("text", "toxic").agg(F.count("*").alias("n")))
    rows = cut(rows)
    if rows.count() <= limit:
        return rows
    # an id stands before many texts: those with the smallest hashes stay, and only hashes are ordered
    hashed = rows.withColumn("h", F.xxhash64("text"))
    first = hashed.select("h").distinct().orderBy("h").limit(limit)
    return cut(hashed.join(F.broadcast(first), "h", "left_semi").drop("h"))


def _candidates(words: set[str]) -> set[str]:
    return words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}


def learn_terms(sample: DataFrame) -> dict[str, float]:
    """The insult transducer: entries and weights (log-odds of a toxic document)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean, toxic = Counter(), Counter()
            for text, label, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                counts = toxic if label else clean
                for term in _candidates(set(_WORD.findall(text.lower()))):
                    counts[term] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(toxic) + list(clean), pa.string()),
                 pa.array(list(toxic.values()) + [0] * len(clean), pa.int64()),
                 pa.array([0] * len(toxic) + list(clean.values()), pa.int64())], names=["term", "toxic", "clean"])

    size = {r.toxic > 0: r.n for r in sample.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    if len(size) < 2:
        return {}
    least = max(MIN_TOXIC_DOCUMENTS, MIN_TOXIC_SHARE * size[True] / 4)
    odds = F.log((F.col("toxic") + 0.5) / (size[True] + 1.0)) - F.log((F.col("clean") + 0.5) / (size[False] + 1.0))
    rows = (sample.select("text", "toxic", "n").mapInArrow(count, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where((F.col("toxic") >= least) & (F.col("toxic") >= MIN_PURITY * (F.col("toxic") + F.col("clean"))))
            .select("term", odds.alias("weight")).collect())  # words of several documents of the bounded sample
    return {r.term: r.weight for r in rows}


def fit(sample: DataFrame, terms: dict[str, float]) -> tuple[list[float], float]:
    """Logistic weights over FEATURES: ridge Newton steps on the sample's sufficient sums.

    The sample has at most TRAIN_DOCUMENTS rows of six numbers; these come to the driver.
    """
    sent = share(sample.sparkSession, terms)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(sent())
        for b in batches:
            x = np.array([grammar.features(t) for t in b.column(0).to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(len(FEATURES))]
                                             + [b.column(i).cast(pa.float64()) for i in (1, 2)], names=[*FEATURES, "toxic", "n"])

    rows = sample.select("text", "toxic", "n").mapInArrow(
        measure, ", ".join(f"{f} double" for f in (*FEATURES, "toxic", "n"))).collect()
    rows = np.array(sorted(tuple(r) for r in rows), float).reshape(-1, len(FEATURES) + 2)
    if not len(rows):
        return [0.0] * len(FEATURES), 0.0
    x, y, n = np.column_stack([rows[:, :-2], np.ones(len(rows))]), (rows[:, -2] > 0).astype(float), rows[:, -1]
    beta, ridge = np.zeros(x.shape[1]), np.diag([1.0] * len(FEATURES) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta += np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (n * (y - p)) - ridge @ beta)
    return beta[:-1].tolist(), float(beta[-1])


def score_documents(docs: DataFrame, labels: DataFrame, train_documents: int = TRAIN_DOCUMENTS,
                    threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and matched_clauses of every row."""
    sample = training_documents(docs, labels, train_documents)
    terms = learn_terms(sample)
    weights, bias = fit(sample, terms) if terms else ([0.0] * len(FEATURES), -math.inf)
    sent = share(docs.sparkSession, terms)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(sent())
        for b in batches:
            x = np.array([grammar.features(t) for t in b.column(1).to_pylist()], float).reshape(-1, len(FEATURES))
            z = np.clip(x @ np.array(weights) + bias, -700, 700)
            p = 1 / (1 + np.exp(-z)) if terms else np.zeros(len(z))
            ids = b.column(0)
            held = [i is not None and zlib.crc32(str(i).encode()) % FOLDS == 1 for i in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(held), pa.array(p), pa.array((p >= threshold).astype(np.int32)),
                 pa.array(np.rint(np.expm1(x[:, FEATURES.index("clauses")])).astype(np.int64))],
                names=["doc_id", "held_out", "score", "predicted", "matched_clauses"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, matched_clauses long")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
