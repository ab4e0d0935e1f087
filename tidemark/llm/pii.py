"""Personal data by candidate generation and gradient-boosted trees.

1. Generators of high recall propose overlapping spans: the four base kinds as their patterns find them, valid
   or not, and looser kinds (``LOOSE``): obfuscated addresses, national phone numbers, short card numbers, account
   and social-security numbers, IPv6.
2. Every candidate becomes numbers: its format (lengths, separators, groups, check digits) and its context
   (neighbouring characters, cue words before it).
3. Spark's gradient-boosted trees learn from weak labels on the candidates of at most ``TRAIN_DOCUMENTS`` documents
   (those with the smallest hash of their text): a candidate that passes its kind's own check is
   positive, one that fails it negative, and every positive one also gives a spoiled twin (digits changed,
   glued to a word) as a negative.
4. The candidates of all texts, and the twins, are scored and counted in ``BINS`` score bins per kind; a kind's threshold
   is the lowest bin down to which the precision reaches ``PRECISION``. A kind that no threshold makes so precise, or
   that had no positive candidate to learn from, is decided by its own check instead: no kind is turned off.
5. Base spans that pass their check always stand. Any other candidate is redacted if its score reaches its kind's
   threshold and it doesn't overlap a base span or a better candidate.

Documents are scored where they are read: no text is shuffled, and all candidates of a document are seen together.

Edge cases: a null text is empty; a text without candidates has no spans; without candidates of both classes in the
sample there are no trees, and every loose kind is decided by its own check; repeated rows each get their row; extra columns are ignored; an empty table gives
an empty result; no pattern is quadratic in the length of a text.
"""

from __future__ import annotations

import bisect
import ipaddress
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, share, text_or_empty

TRAIN_DOCUMENTS = 4_000
TRAIN_CANDIDATES = 40_000
TREES, DEPTH = 12, 4
PRECISION = 0.9
BINS = 1024  # a power of two: bin edges are exact
BASE = ("email", "ip", "card", "phone")
LOOSE = ("email_spelled", "phone_national", "card_short", "iban", "ssn", "ipv6")
KINDS = BASE + LOOSE
REDACTED = "[{}]"

# Base patterns (fixed). The e-mail pattern is run from its "@", which finds the same matches without trying every letter.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Looser patterns of the added kinds.
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[({]\x20?at\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}"
                      r"(?:(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\.)[A-Za-z0-9-]{1,63})+", re.I)
_NATIONAL = re.compile(r"(?<![\w+.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![\w-])")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
_SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_IPV6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:])")
# Cue words before a span, by the kinds they speak for.
CUES = {
    "email": ("mail", "contact", "write"), "email_spelled": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "addr"),
    "ipv6": ("ip", "host", "server", "addr"), "card": ("card", "visa", "credit", "pay", "karte", "tarjeta", "carte"),
    "card_short": ("card", "visa", "credit", "pay", "amex", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "fax", "mobile"), "phone_national": ("phone", "tel", "call", "fax", "mobile"),
    "iban": ("iban", "account", "konto", "cuenta", "compte"), "ssn": ("ssn", "social", "security"),
}
FEATURES = ("kind", "length", "digits", "letters", "separators", "kinds_of_separators", "groups", "longest_group",
            "distinct_digits", "check_digits", "octets", "plus", "brackets", "before_word", "after_word", "cue", "last_label")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def mod_97(text: str) -> bool:
    joined = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in joined[4:] + joined[:4])) % 97 == 1


def octets(text: str) -> bool:
    return all(int(p[-12:]) <= 255 and not p[:-12].strip("0") for p in text.split("."))


def passes(kind: str, text: str) -> bool:
    """The kind's own check: what a candidate is by its format alone."""
    digits = _digits(text)
    if kind == "email":
        return True
    if kind == "ip":
        return octets(text)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "email_spelled":
        return True
    if kind == "phone_national":
        return 9 <= len(digits) <= 12
    if kind == "card_short":
        return 13 <= len(digits) <= 15 and luhn(digits) and digits[0] in "3456"
    if kind == "iban":
        return 15 <= len(text.replace(" ", "")) <= 34 and mod_97(text)
    if kind == "ssn":
        return text[:3] not in ("000", "666") and text[0] != "9" and text[4:6] != "00" and text[7:] != "0000"
    try:
        return ipaddress.ip_address(text).version == 6
    except ValueError:
        return False


def candidates(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of everything the generators propose."""
    found: list[tuple[str, int, int]] = [("email", s, e) for s, e in _emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE), ("phone_national", _NATIONAL), ("ssn", _SSN)):
        found += [(kind, *m.span()) for m in pattern.finditer(text)]
    found += [("card_short", s, e) for kind, s, e in found if kind == "card" and 13 <= len(_digits(text[s:e])) <= 15]
    low = text.lower()
    if "at)" in low or "at]" in low or "at }" in low or "at}" in low or "at )" in low or "at ]" in low:
        found += [("email_spelled", *m.span()) for m in _SPELLED.finditer(text)]
    found += [("iban", *m.span()) for m in _IBAN.finditer(text)]
    if ":" in text:
        found += [("ipv6", *m.span()) for m in _IPV6.finditer(text)]
    # short digit runs are no candidates for a card
    return [(k, s, e) for k, s, e in found if k != "card" or e - s >= 12]


def features(kind: str, text: str, before: str, after: str) -> list[float]:
    digits = _digits(text)
    groups = re.findall("[0-9]+", text)
    separators = [c for c in text if not c.isalnum()]
    return [float(KINDS.index(kind)), len(text), len(digits), sum(c.isalpha() for c in text), len(separators),
            len(set(separators)), len(groups), max(map(len, groups), default=0), len(set(digits)),
            float(mod_97(text) if kind == "iban" else bool(digits) and luhn(digits)), float(text.count(".") == 3 and octets(text) if kind == "ip" else 0),
            float(text[:1] == "+"), float("(" in text), float(before[-1:].isalnum()), float(after[:1].isalnum()),
            float(any(c in before.lower() for c in CUES[kind])), len(text.rpartition(".")[2])]


def _row(kind: str, text: str, start: int, end: int) -> list[float]:
    return features(kind, text[start:end], text[max(0, start - 32):start], text[end:end + 1])


def _spoiled(kind: str, text: str, before: str) -> list[float]:
    """Features of a candidate's twin that is none: its digits moved on by one or more, glued to a word."""
    moved = "".join(chr(48 + (ord(c) - 48 + 1 + i % 3) % 10) if "0" <= c <= "9" else c for i, c in enumerate(text))
    if kind == "ip":
        moved = re.sub(r"[0-9]+$", "999", moved)
    if kind in ("email", "email_spelled"):
        moved = re.sub(r"\.[^.]*$", ".x", moved)
    if kind in ("phone", "phone_national", "ssn"):
        moved = moved.lstrip("+") + "12345678"
    return features(kind, moved, (before.rstrip() + "x"), "x")


def training_rows(docs: DataFrame, limit: int = TRAIN_DOCUMENTS, rows: int = TRAIN_CANDIDATES) -> list:
    """(label, held back, kind, features) of the sample's candidates and their twins: at most ``rows``."""
    text = text_or_empty()
    picked = (docs.select(F.xxhash64(text).alias("h")).distinct().orderBy("h").limit(limit).select(F.col("h").alias("picked")))
    sample = docs.select(text.alias("text"), F.xxhash64(text).alias("h")).join(
        F.broadcast(picked), F.col("h") == F.col("picked")).select("text", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for kind, s, e in candidates(text):
                    good = passes(kind, text[s:e])
                    out.append((float(good), h % 3 == 0, KINDS.index(kind), _row(kind, text, s, e)))
                    if good:
                        out.append((0.0, h % 3 == 0, KINDS.index(kind), _spoiled(kind, text[s:e], text[max(0, s - 32):s])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["label", "held", "kind", "x"])

    found = sample.mapInArrow(run, "label double, held boolean, kind long, x array<double>").distinct()
    return found.orderBy(F.xxhash64("label", "kind", "x"), "kind", "x").limit(rows).collect()


class Trees:
    """A boosted ensemble as flat arrays, scored by numpy."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]], weights: list[float]):
        self.trees, self.weights = trees, weights

    @classmethod
    def of(cls, model: GBTClassificationModel) -> Trees:
        trees = []
        for tree in model.trees:
            nodes: list[list[float]] = []  # feature (-1: leaf), threshold, left, right, value

            def walk(node) -> int:
                at = len(nodes)
                nodes.append([-1, 0.0, 0, 0, node.prediction()])
                if node.getClass().getSimpleName() == "InternalNode":
                    split = node.split()
                    nodes[at][0], nodes[at][1] = split.featureIndex(), split.threshold()
                    nodes[at][2] = walk(node.leftChild())
                    nodes[at][3] = walk(node.rightChild())
                return at

            walk(tree._java_obj.rootNode() if hasattr(tree, "_java_obj") else tree._call_java("rootNode"))
            n = np.array(nodes, float)
            trees.append((n[:, 0].astype(int), n[:, 1], n[:, 2].astype(int), n[:, 3].astype(int), n[:, 4]))
        return cls(trees, list(model.treeWeights))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of every row."""
        margin = np.zeros(len(x))
        for (feature, threshold, left, right, value), w in zip(self.trees, self.weights):
            at = np.zeros(len(x), int)
            while (inner := feature[at] >= 0).any():
                rows = np.flatnonzero(inner)
                node = at[rows]
                at[rows] = np.where(x[rows, feature[node]] <= threshold[node], left[node], right[node])
            margin += w * value[at]
        return 1 / (1 + np.exp(-2 * margin))


def train(docs: DataFrame, limit: int = TRAIN_DOCUMENTS, precision: float = PRECISION) -> tuple[Trees | None, dict[str, float | None]]:
    """The trees (None without examples of both classes) and each loose kind's threshold (None: its own check decides)."""
    rows = training_rows(docs, limit)
    learn = [r for r in rows if not r.held] or rows
    if len({r.label for r in learn}) < 2:
        return None, dict.fromkeys(LOOSE)
    spark = docs.sparkSession
    data = spark.createDataFrame([(r.label, Vectors.dense(r.x)) for r in learn], ["label", "features"]).coalesce(1)
    trees = Trees.of(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=64).fit(data))
    learnt = {KINDS[r.kind] for r in learn if r.label}
    found = thresholds_of(histogram(docs, trees), precision)
    return trees, {k: found.get(k) if k in learnt else None for k in LOOSE}


def histogram(docs: DataFrame, trees: Trees) -> DataFrame:
    """kind, bin, good and bad: the loose candidates of all texts, and the positive ones' twins, by score."""
    sent = share(docs.sparkSession, trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent()
        for b in batches:
            keys, x = [], []
            for text in b.column(0).to_pylist():
                for kind, s, e in candidates(text):
                    if kind in LOOSE:
                        good = passes(kind, text[s:e])
                        keys.append((kind, good))
                        x.append(_row(kind, text, s, e))
                        if good:
                            keys.append((kind, False))
                            x.append(_spoiled(kind, text[s:e], text[max(0, s - 32):s]))
            if keys:
                counts = Counter((*k, n) for k, n in zip(keys, bins(model.score(np.array(x, float))).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _, _ in counts]), pa.array([n for _, _, n in counts], pa.int64()),
                     pa.array([c * good for (_, good, _), c in counts.items()], pa.int64()),
                     pa.array([c * (not good) for (_, good, _), c in counts.items()], pa.int64())],
                    names=["kind", "bin", "good", "bad"])

    found = docs.select(text_or_empty().alias("text")).mapInArrow(run, "kind string, bin long, good long, bad long")
    return found.groupBy("kind", "bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def bins(scores: np.ndarray) -> np.ndarray:
    return np.minimum((scores * BINS).astype(int), BINS - 1)


def thresholds_of(counts: DataFrame, precision: float) -> dict[str, float]:
    """The lowest threshold of every kind that has one with this precision (at most ``BINS`` rows a kind are read)."""
    by_kind: dict[str, list] = {}
    for r in counts.collect():
        by_kind.setdefault(r.kind, []).append((r.bin, r.good, r.bad))
    thresholds = {}
    for kind, rows in by_kind.items():
        good = bad = 0
        for n, g, b in sorted(rows, reverse=True):
            good, bad = good + g, bad + b
            if good >= precision * (good + bad):
                thresholds[kind] = n / BINS
    return thresholds


def select(texts: list[str], model: tuple[Trees | None, dict[str, float | None]] | None) -> list[tuple[list, list]]:
    """Per text: base spans (kind, start, end), and the added spans, both by kind and start."""
    found = [candidates(t) for t in texts]
    loose = [(i, k, s, e) for i, spans in enumerate(found) for k, s, e in spans if k in LOOSE]
    scores = np.ones(len(loose) if model else 0)
    if model and model[0] and loose:
        scores = model[0].score(np.array([_row(k, texts[i], s, e) for i, k, s, e in loose], float))
    added: dict[int, list] = {}
    for (i, k, s, e), p in zip(loose, scores):
        least = model[1][k]
        if least is None:  # decided by its check, which trees that never saw one can't rank
            p, least = float(passes(k, texts[i][s:e])), 1.0
        if p >= least:
            added.setdefault(i, []).append((-p, s, e, k))
    out = []
    for i, spans in enumerate(found):
        base = sorted(((k, s, e) for k, s, e in spans if k in BASE and passes(k, texts[i][s:e])),
                      key=lambda x: (BASE.index(x[0]), x[1]))
        more = []
        if i in added:
            starts, ends = _disjoint(base)
            for _, s, e, k in sorted(added[i]):
                at = bisect.bisect_right(ends, s)  # the first taken stretch that ends behind the candidate's start
                if at == len(starts) or e <= starts[at]:
                    starts.insert(at, s)
                    ends.insert(at, e)
                    more.append((k, s, e))
        out.append((base, sorted(more, key=lambda x: (KINDS.index(x[0]), x[1]))))
    return out


def _disjoint(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover, in order and without overlap."""
    starts, ends = [], []
    for _, s, e in sorted(spans, key=lambda x: x[1:]):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def find_pii(docs: DataFrame, limit: int = TRAIN_DOCUMENTS, precision: float = PRECISION, texts: bool = True) -> DataFrame:
    """doc_id, ``spans`` (kind, start, end; by kind and start, the base kinds first) and, with ``texts``, the redacted text of
    every row."""
    sent = share(docs.sparkSession, train(docs, limit, precision))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent()
        for b in batches:
            given = b.column(1).to_pylist()
            spans, clean = [], []
            for text, (base, more) in zip(given, select(given, model)):
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in base + more])
                if texts:
                    clean.append(redact(text, base + more))
            columns = [b.column(0), pa.array(spans, pa.list_(span)), *([pa.array(clean, pa.string())] if texts else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans", "redacted"][:len(columns)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>" + ", redacted string" * texts)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with ``[KIND]`` in place of every span; of overlapping spans the first one's kind is written."""
    parts, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            parts += (text[at:s], REDACTED.format(kind.upper()))
        at = max(at, e)
    return "".join(parts) + text[at:]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read_table(spark, sf_dir, "documents"), texts=False)
    base = F.filter("spans", lambda x: x.kind.isin(list(BASE)))
    joined = lambda a: F.concat_ws(",", F.transform(a, lambda x: F.concat_ws(":", x.kind, x.start, x.end)))
    return found.select("doc_id", *[F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in BASE],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _is(kind: str):
    return lambda x: x.kind == kind
