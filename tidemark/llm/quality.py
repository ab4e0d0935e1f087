"""Quality rules by distribution divergence, in DataFrame functions only.

Two histograms of every whole text, over character classes and over common words, are
compared with language references by Jensen-Shannon distance. The references are averages over
the whole corpus: one per language of ``COMMON_WORDS`` (documents that declare it) and one over all
documents, so their number is fixed and joining them is a broadcast of at most ``len(COMMON_WORDS) + 1`` rows. A
document is held against its nearest reference, so a wrong or missing ``lang`` does no harm.

A document goes when it has fewer than ``MIN_WORDS`` words, when more than
``MAX_REPEATED_SHARE`` of its words lie in repeated 3-word windows, or when a distance exceeds its
limit; distances are asked of documents with at least ``MIN_WORDS`` words (character classes) or
``MIN_WORDS_FOR_WORDS`` (common words): short texts diverge by chance.

Edge cases: a null text is empty and fails for its length; repeated rows each get their row; a null
``doc_id`` or ``lang`` is kept as it is (its row adds to the reference over all documents only); extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WS_CHARS, WS_CLASS, fresh, keep_where, opaque, read_table, stored, text_or_empty

MIN_WORDS = 50
MAX_REPEATED_SHARE = 0.5
MIN_WORDS_FOR_WORDS = 100
MAX_CLASS_DISTANCE = 0.26
MAX_WORD_DISTANCE = 0.315
WINDOW = 3

# Frequent function words.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on",
           "this", "are", "or", "from"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im",
           "dem", "nicht", "ein", "eine", "als"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans",
           "par", "sur", "au", "pas", "avec"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "una", "su",
           "para", "es", "al", "lo"],
}
CLASSES = ("lower", "upper", "other_letter", "digit", "space", "mark", "symbol", "other")
HISTOGRAMS = {"h_class": "n_chars_seen", "h_word": "n_words"}  # and the column that holds the sum of their counts
_HIGH = -(1 << 31)  # upper 33 bits: window hash; lower 31 bits: its position


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{WS_CLASS}]+"), "")


def _gone(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def _repeat_words(df: DataFrame, words: str, n_words: str) -> DataFrame:
    """Adds ``n_repeat_words``: words inside 3-word windows that occur twice or more in the text.

    A window's hash and position share a long, so one primitive sort brings equal windows together.
    Neighbours that agree in the hash bits are only candidates: their windows are compared
    as text. No step is quadratic in the length of a text.
    """
    keys, near, exact, at = (fresh(x) for x in ("keys", "near", "exact", "at"))
    w = F.col(words)
    window_hash = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    starts = F.when(F.col(n_words) >= WINDOW, F.sequence(F.lit(0), F.col(n_words).cast("int") - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    df = df.withColumn(keys, F.sort_array(F.transform(
        starts, lambda i: window_hash(i).bitwiseAND(F.lit(_HIGH)).bitwiseOR(i.cast("long")))))
    k = F.col(keys)
    high = lambda x: x.bitwiseAND(F.lit(_HIGH))
    df = df.withColumn(near, F.filter(k, lambda x, i: (high(x) == high(F.get(k, i - 1)))
                                      | (high(x) == high(F.get(k, i + 1)))))

    def spelled(x: Column) -> Column:
        i = x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
        return F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("text"), i.alias("at"))

    df = df.withColumn(exact, F.sort_array(F.transform(F.col(near), spelled)))
    e = F.col(exact)
    df = df.withColumn(at, F.sort_array(F.transform(
        F.filter(e, lambda x, i: (x.text == F.get(e, i - 1).text) | (x.text == F.get(e, i + 1).text)),
        lambda x: x["at"])))
    p = F.col(at)
    return df.withColumn("n_repeat_words", F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)).drop(keys, near, exact, at)


def measures(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``carry``, doc_id, lang, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the histograms
    ``h_class`` and ``h_word`` (counts) of every row."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    df = docs.select(*carry, "doc_id", lang.alias("lang"), text_or_empty().alias("text"))
    df = df.withColumn("words", _words(F.col("text"))).withColumn("n_words", F.size("words").cast("long"))
    # each class is taken out of what the one before it left, so only the first pass reads the whole text
    df = df.withColumn("left", _gone(F.col("text"), "[a-z]++"))
    left, rest = [F.col("left")], df
    for name, pattern in zip(CLASSES, (r"\p{Ll}++", r"\p{Lu}++", r"\p{L}++", r"[0-9]++", rf"[{WS_CLASS}]++",
                                       r"""[.,;:!?'"()-]++""", r"[#*$%&|<>]++")):
        rest = rest.withColumn(f"left_{name}", _gone(left[-1], pattern))
        left.append(F.col(f"left_{name}"))
    sizes = [F.length(a) - F.length(b) for a, b in zip(left, left[1:])] + [F.length(left[-1])]
    sizes[0] += F.length("text") - F.length("left")
    df = (rest.withColumn("h_class", F.array(*[s.cast("long") for s in sizes]))
          .withColumn("n_symbols", F.get("h_class", CLASSES.index("symbol")))
          .withColumn("n_chars_seen", F.length("text").cast("long"))
          .withColumn("word_chars", F.col("n_chars_seen") - F.get("h_class", CLASSES.index("space"))))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(x, F.lit(WS_CHARS))) > 0)
    df = df.withColumn("lines", lines).withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    df = _repeat_words(df, "words", "n_words")
    # the common words alone, in any spelling, each between two blanks
    vocabulary = _vocabulary()
    spellings = _spellings(tuple(vocabulary))
    common = F.lower(F.concat_ws("  ", F.filter("words", lambda w: w.isin(spellings))))
    df = df.withColumn("common", F.concat(F.lit(" "), common, F.lit(" ")))
    df = df.withColumn("h_word", _word_counts(F.col("common"), vocabulary))
    df = df.withColumn("h_word", F.array_append("h_word", F.col("n_words") - F.aggregate(
        "h_word", F.lit(0).cast("long"), lambda a, x: a + x)))
    return df.withColumn("word_chars", F.col("word_chars").cast("long")).drop(
        "words", "lines", "common", "left", *[f"left_{c}" for c in CLASSES[:-1]])


def _word_counts(common: Column, vocabulary: list[str]) -> Column:
    """How often each word stands in ``common``: taking a word out shows it, and leaves less for the next one."""
    zero = F.struct(common.alias("rest"), F.array().cast("array<long>").alias("n"))

    def take(s: Column, w: Column) -> Column:
        left = F.array(F.replace(s.rest, w, F.lit("")))  # in an array, so that it is computed once
        return F.get(F.transform(left, lambda r: F.struct(r.alias("rest"), F.array_append(s.n, (
            (F.octet_length(s.rest) - F.octet_length(r)) / F.octet_length(w)).cast("long")).alias("n"))), F.lit(0))

    return F.aggregate(F.array(*[F.lit(f" {w} ") for w in vocabulary]), zero, take, lambda s: s.n)


def references(measured: DataFrame, min_words: int = MIN_WORDS) -> list[tuple[list[float], list[float]]]:
    """Mean class and common-word shares of the corpus, per language of COMMON_WORDS and over all documents."""
    known = F.when(F.col("lang").isin(list(COMMON_WORDS)), F.col("lang"))
    sides = F.explode(F.array(F.lit("*"), known)).alias("ref")
    sizes = (("h_class", len(CLASSES)), ("h_word", len(_vocabulary()) + 1))
    rows = (keep_where(measured, F.col("n_words") >= min_words)
            .select(*[_shares(h, HISTOGRAMS[h]).alias(h) for h, _ in sizes], sides).where("ref is not null").groupBy("ref")
            .agg(*[F.array(*[F.avg(F.get(h, F.lit(i))) for i in range(n)]).alias(h) for h, n in sizes])
            .collect())  # at most len(COMMON_WORDS) + 1 rows
    return [(r.h_class, r.h_word) for r in sorted(rows, key=lambda r: r.ref)]


@functools.cache
def _spellings(vocabulary: tuple[str, ...]) -> list[str]:
    """Every spelling whose lower case is one of the words: a look-up a word is cheaper than lowering all words of a text."""
    forms: dict[str, list[str]] = {}
    for c in map(chr, range(sys.maxunicode + 1)):
        if c.lower() in _LETTERS:
            forms.setdefault(c.lower(), []).append(c)
    return sorted({"".join(p) for w in vocabulary for p in itertools.product(*(forms[c] for c in w))})


_LETTERS = {c for ws in COMMON_WORDS.values() for w in ws for c in w}


def _vocabulary() -> list[str]:
    return sorted({w for ws in COMMON_WORDS.values() for w in ws})


def _shares(h: str, total: str) -> Column:
    return F.transform(h, lambda x: x / F.greatest(F.col(total), F.lit(1)))


def jensen_shannon(shares: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (root of the divergence in bits, 0 to 1)."""
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(shares, F.array(*map(F.lit, reference)),
                       lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def judge(docs: DataFrame, carry: tuple[str, ...] = (), min_words: int = MIN_WORDS, max_repeated: float = MAX_REPEATED_SHARE,
          max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """``measures(docs)`` with class_distance, word_distance, base_failed and kept.

    Without ``carry`` the texts are read once: their measures, some 70 small counts a row, are stored in the scratch
    folder, and references and verdicts both follow from them (the result has no ``text``). Whole rows to carry
    would be a second copy of the corpus there, so with ``carry`` the texts are read twice instead, the first time
    for the histograms alone.
    """
    if carry:
        df = measures(docs, carry)
        refs = references(measures(docs), min_words)
    else:
        df = stored(measures(docs).drop("text"), "quality")
        refs = references(df, min_words)
    for h, d, k in (("h_class", "class_distance", 0), ("h_word", "word_distance", 1)):
        df = df.withColumn(f"{h}_share", _shares(h, HISTOGRAMS[h]))
        nearest = (F.array_min(F.array(*[jensen_shannon(F.col(f"{h}_share"), r[k]) for r in refs])) if refs
                   else F.lit(0.0))
        df = df.withColumn(d, nearest)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 100 * max_repeated * F.col("n_words"))
    far = (((F.col("n_words") >= min_words) & (F.col("class_distance") > max_class))
           | ((F.col("n_words") >= MIN_WORDS_FOR_WORDS) & (F.col("word_distance") > max_word)))
    return opaque(df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~far), "kept")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    whole = fresh("row")
    judged = judge(docs.withColumn(whole, F.struct("*")), carry=(whole,), **options)
    return judged.where("kept").select(f"{whole}.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))


def _op7_sql() -> str:
    """The same from the definitions, in long tables: a row per word, window, and histogram bin."""
    terms = ", ".join(f"('{w}')" for w in _vocabulary())
    langs = ", ".join(f"'{x}'" for x in COMMON_WORDS)
    classes = (r"\p{Ll}", r"\p{Lu}", r"\p{L}", "[0-9]", rf"[{WS_CLASS}]", r"""[.,;:!?''"()-]""", "[#*$%&|<>]")
    steps = []
    for k, pattern in enumerate(classes):
        steps.append(f"SELECT *, regexp_replace(left_{k}, '{pattern}', '', 'g') AS left_{k + 1} FROM c{k}")
    chain = ",\n".join(f"c{k + 1} AS ({s})" for k, s in enumerate(steps))
    bins = ", ".join([f"length(left_{k}) - length(left_{k + 1})" for k in range(len(classes))] + [f"length(left_{len(classes)})"])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
t AS (SELECT rid, doc_id, lang, text, regexp_extract_all(text, '[^{WS_CLASS}]+') AS words FROM d),
n AS (SELECT *, len(words)::BIGINT AS n_words FROM t),
word AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM n),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS times
        FROM (SELECT rid, i, w AS a, lead(w) OVER s AS b, lead(w, 2) OVER s AS c FROM word WINDOW s AS (PARTITION BY rid ORDER BY i)) x
        WHERE c IS NOT NULL),
rep AS (SELECT rid, count(DISTINCT j) AS n_repeat_words
        FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM win WHERE times > 1) x GROUP BY rid),
line AS (SELECT rid, count(*) - count(DISTINCT l) AS n_dup_lines
         FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM n) x
         WHERE regexp_matches(l, '[^{WS_CLASS}]') GROUP BY rid),
c0 AS (SELECT rid, text, text AS left_0 FROM n),
{chain},
class AS (SELECT rid, 'class' AS hist, unnest(['0', '1', '2', '3', '4', '5', '6', '7']) AS bin, unnest([{bins}]) AS x, length(text) AS total
          FROM c{len(classes)}),
vocab AS (SELECT * FROM (VALUES {terms}) v(term)),
common AS (SELECT rid, term, count(*) AS x FROM word JOIN vocab ON lower(w) = term GROUP BY ALL),
in_words AS (SELECT n.rid, 'word' AS hist, v.term AS bin, coalesce(c.x, 0) AS x, n.n_words AS total
             FROM n CROSS JOIN vocab v LEFT JOIN common c ON c.rid = n.rid AND c.term = v.term),
bins AS (SELECT * FROM class UNION ALL SELECT * FROM in_words
         UNION ALL SELECT rid, 'word', '', any_value(total) - sum(x), any_value(total) FROM in_words GROUP BY rid),
share AS (SELECT rid, hist, bin, x::DOUBLE / greatest(total, 1) AS p FROM bins),
ref AS (SELECT name, hist, bin, avg(p) AS q
        FROM share JOIN (SELECT rid, unnest(['*', CASE WHEN lang IN ({langs}) THEN lang END]) AS name FROM n WHERE n_words >= {MIN_WORDS}) m USING (rid)
        WHERE name IS NOT NULL GROUP BY ALL),
dist AS (SELECT rid, hist, min(js) AS js FROM (
           SELECT rid, hist, name, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                                                    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS js
           FROM share JOIN ref USING (hist, bin) GROUP BY ALL) x GROUP BY ALL),
m AS (SELECT n.doc_id, n.n_words, (length(n.text) - c.x)::BIGINT AS word_chars, s.x::BIGINT AS n_symbols,
             coalesce(line.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(rep.n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(a.js, 0.0) AS ca, coalesce(b.js, 0.0) AS wa
      FROM n JOIN class c ON c.rid = n.rid AND c.bin = '4' JOIN class s ON s.rid = n.rid AND s.bin = '6'
      LEFT JOIN line ON line.rid = n.rid LEFT JOIN rep ON rep.rid = n.rid
      LEFT JOIN dist a ON a.rid = n.rid AND a.hist = 'class' LEFT JOIN dist b ON b.rid = n.rid AND b.hist = 'word'),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {100 * MAX_REPEATED_SHARE} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_words >= {MIN_WORDS} AND ca > {MAX_CLASS_DISTANCE}
         OR n_words >= {MIN_WORDS_FOR_WORDS} AND wa > {MAX_WORD_DISTANCE}) AS kept,
       round(ca, 6) AS class_distance, round(wa, 6) AS word_distance
FROM f
"""


OP7_SQL = _op7_sql()
