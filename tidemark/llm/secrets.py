"""Secret scan in DataFrame functions only: base patterns and sliding-window entropy.

Base spans: assignments to credential names, access-key ids and long hex runs, by pattern.
Added spans: candidate strings are maximal runs of the hex or of the base64 alphabet. A window of
``WINDOW`` characters slides over a candidate; its Shannon entropy follows from the counts of its
characters, kept up to date by the one that enters and the one that leaves. A candidate whose
highest window entropy reaches its class's threshold is a span, unless the allow list suppresses it: no digit or no
letter at all, and UUIDs. Strings that count up and placeholder words clear their own characters: what is left must be as long as a
candidate, half of the candidate at least, and reach the threshold. Base spans are blanked before (assignments, then access-key ids,
then hex runs in what is left), so each part of a string beside them is a candidate of its own.

Offsets: the pieces between a pattern's matches (``split``) and the matches (``regexp_extract_all``) alternate, so
their running lengths are the offsets in code points. Texts without any hit skip all of that.

Edge cases: a null text is empty; an empty text has no spans; repeated rows each get their row; other columns are
ignored; an empty table gives an empty result. Offsets of a text's matches take its length plus, per match, a block of 256; a
redacted text is copied once per span.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, opaque, read_table, text_or_empty

# Fixed patterns (letter case written out: no engine's case folding is involved).
_NAMES = ("[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}+"
HEX = "[0-9a-f]{24,}+"
MIN_SECRET = 6
BASE_KINDS = ("assign", "access", "hex")

# Candidate alphabets of the entropy scan: (kind, characters, shortest candidate, bits per character asked).
WINDOW = 20
CLASSES = (
    ("entropy_hex", "[0-9A-Fa-f]", 20, 3.0),
    ("entropy_base64", "[A-Za-z0-9+/_-]", 20, 3.7),
)
KINDS = BASE_KINDS + tuple(c[0] for c in CLASSES)
# Allow list: a candidate that matches whole is no secret; placeholders clear their own characters only.
ALLOWED = (
    r"^[^0-9]*$", r"^[^A-Za-z]*$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)
PLACEHOLDERS = r"(?:0123456789|abcdefgh|ABCDEFGH|(?i:example|sample|dummy|placeholder|changeme|xxxxxx))"
BLOCK = 256  # matches whose offsets are summed one by one; blocks start from the sums of those before them


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, text) of a pattern's matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found,
                       lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), m.alias("text")))
    nothing = F.array().cast("array<struct<start:int,end:int,text:string>>")
    starts = F.transform(F.sequence(F.lit(0), F.floor(F.size(found) / BLOCK).cast("int")), lambda k: k * BLOCK + 1)
    blocks = F.transform(starts, lambda at: F.slice(steps, at, F.lit(BLOCK)))
    lengths = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x.gap + x.size))
    # where each block begins: a running sum over blocks
    begins = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda s, n: F.struct(
        (s["at"] + n).alias("at"), F.array_append(s.out, s["at"]).alias("out"))).out

    def placed(block: Column, begin: Column) -> Column:
        return F.aggregate(block, F.struct(begin.alias("at"), nothing.alias("out")), lambda s, x: F.struct(
            (s["at"] + x.gap + x["size"]).alias("at"),
            F.array_append(s.out, F.struct((s["at"] + x.gap).alias("start"), (s["at"] + x.gap + x["size"]).alias("end"),
                                           x.text.alias("text"))).alias("out"))).out

    return F.flatten(F.zip_with(blocks, begins, placed))


def max_window_entropy(text: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy (bits) over the windows of an ASCII string; of all of it if it is shorter.

    State: one count per character, and the sum of c * log2(c) over the counts c. The entropy of
    n characters is log2(n) - sum / n, so a step only touches two counts.
    """
    plogp = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c))
    zero = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"),
                    F.lit(0).alias("i"))

    def step(s: Column, code: Column) -> Column:
        gone = F.when(s.i >= window, F.get(codes, s.i - window)).otherwise(F.lit(-1))
        n_in = F.get(s.counts, code)
        counts = F.when(gone == code, s.counts).otherwise(F.transform(
            s.counts, lambda c, j: F.when(j == code, c + 1).when(j == gone, c - 1).otherwise(c)))
        n_out = F.get(s.counts, F.greatest(gone, F.lit(0)))
        total = (s["sum"] + F.when(gone == code, 0.0).otherwise(
            F.get(plogp, n_in + 1) - F.get(plogp, n_in)
            + F.when(gone >= 0, F.get(plogp, n_out - 1) - F.get(plogp, n_out)).otherwise(0.0)))
        size = F.least(s.i + 1, F.lit(window))
        full = (s.i + 1 >= window) | (s.i + 1 == F.length(text))
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(s.best, F.when(
            full, F.log2(size.cast("double")) - total / size).otherwise(0.0)).alias("best"), (s.i + 1).alias("i"))

    return F.aggregate(codes, zero, step).best


def _blanked(text: Column, pattern: str, blank) -> Column:
    """``text`` with the pattern's matches that ``blank`` holds for overwritten by spaces, so that all offsets stay."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.split(text, pattern, -1)
    over = lambda g, m: F.concat(g, F.when(blank(m), F.repeat(F.lit(" "), F.length(m))).otherwise(m))
    return F.concat(F.array_join(F.zip_with(F.slice(gaps, 1, F.size(found)), found, over), ""), F.element_at(gaps, -1))


def scan(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``carry``, doc_id and ``found``: array of (start, rank, end, kind, text) by start, then kind as in KINDS."""
    df = docs.select(*carry, "doc_id", text_or_empty().alias("text"))
    text = F.col("text")
    longest = "|".join([_NAMES, "AKIA", HEX] + [f"{chars}{{{least},}}+" for _, chars, least, _ in CLASSES])
    nothing = F.array().cast("array<struct<start:int,end:int,text:string>>")
    hit = fresh("hit")
    df = df.withColumn(hit, text.rlike(longest))
    each = lambda p: F.when(F.col(hit), _matches(text, p)).otherwise(nothing)
    # group 2 of an assignment is the run of secret characters at its end
    secret = lambda m: F.regexp_extract(m.text, ASSIGN, 2)
    df = (df.withColumn("assign", F.filter(each(ASSIGN), lambda m: F.length(secret(m)) >= MIN_SECRET))
          .withColumn("access", each(ACCESS)).withColumn("hex", each(HEX)))
    spans = lambda name, kind: F.transform(name, lambda m: F.struct(
        m.start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m.end.alias("end"), F.lit(kind).alias("kind"),
        m.text.alias("text")))
    df = df.withColumn("base", F.array_sort(F.concat(*[spans(k, k) for k in BASE_KINDS])))
    # base spans are blanked, one kind after the other; candidates are looked for in what is left
    rest = fresh("rest")
    df = df.withColumn(rest, text)
    for kind, pattern, blank in (("assign", ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_SECRET),
                                 ("access", ACCESS, lambda m: F.lit(True)), ("hex", HEX, lambda m: F.lit(True))):
        df = df.withColumn(rest, F.when(F.size(kind) > 0, _blanked(F.col(rest), pattern, blank)).otherwise(F.col(rest)))
    added = []
    for kind, chars, least, bits in CLASSES:
        allowed = lambda m: reduce(lambda a, b: a | b, [m.text.rlike(p) for p in ALLOWED])
        found = F.when(F.col(hit), _matches(F.col(rest), f"{chars}{{{least},}}+")).otherwise(nothing)
        df = df.withColumn(kind, F.filter(found, lambda m: ~allowed(m)))
        df = df.withColumn(kind, F.filter(kind, _reaches(bits, least)))
        added.append(spans(kind, kind))
    return opaque(df.select(*carry, "doc_id", F.array_sort(F.concat("base", *added)).alias("found")), "found")


def _is_kind(kind: str):
    return lambda x: x.kind == kind


def _reaches(bits: float, least: int):
    """What is left of a candidate without placeholders must be long enough, half of it, and reach the entropy."""
    bare = lambda m: F.regexp_replace(m.text, PLACEHOLDERS, "")
    return lambda m: ((F.length(bare(m)) >= least) & (2 * F.length(bare(m)) >= m.end - m.start)
                      & (max_window_entropy(bare(m)) >= bits))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x["rank"] < len(BASE_KINDS))
    n = [F.size(F.filter("found", _is_kind(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return df.select("doc_id", *n, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span's characters replaced by ``[SECRET]`` (overlapping spans by one)."""
    whole = fresh("row")
    rows = scan(docs.withColumn(whole, F.struct("*")), carry=(whole,))
    text = F.coalesce(F.col(f"{whole}.text").cast("string"), F.lit(""))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        clear = F.when(x.start >= s["at"], F.concat(s.out, F.substr(text, s["at"] + 1, x.start - s["at"]), F.lit("[SECRET]")))
        return F.struct(F.greatest(s["at"], x.end).alias("at"), clear.otherwise(s.out).alias("out"))

    done = F.aggregate("found", zero, step, lambda s: F.concat(s.out, F.substr(text, s["at"] + 1, F.length(text))))
    clean = F.when(F.size("found") == 0, F.col(f"{whole}.text")).otherwise(done)
    return rows.select(*[(clean if c == "text" else F.col(f"{whole}.`{c}`")).alias(c) for c in docs.columns])
