"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding: a text is normalised, then its adjacent symbol pairs that form a piece stand on an agenda ordered by
score, ties by place. The best pair is merged, its new neighbours join the agenda, pairs whose symbols have
changed since are skipped. What is no piece at the end falls back to its bytes (or to the unknown id).

No piece holds a space mark behind another character, so no merge crosses such a place: a text is cut there into
units, each unit is encoded by the agenda once and remembered (``CACHE_UNITS`` at most, then forgotten). The cuts follow from the
vocabulary; a model that has such pieces is encoded whole. In every Arrow batch all newly encoded units are
encoded by the sentencepiece library too, many in one text, so that the cuts are checked as well; a difference fails the job: no
wrong id is ever returned.

The driver reads the model file (some hundred kilobytes) and ships its bytes; executors need the library only.
Tasks hold one slice of a batch (``SLICE_CHARS`` characters, or one text if it is longer). Work is n log n in a unit.

Edge cases: a null text is empty; an empty text is its begin and end ids and decodes to an empty text; control strings such as
``</s>`` in a text are ordinary characters; repeated rows each get their row; a null ``doc_id`` stays null; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, share, text_or_empty

MODEL = "piece_bpe_32k.model"
SPACE = "▁"  # the library's mark for a space
CACHE_UNITS = 500_000
CACHE_CHARS = 64  # longer units are not remembered
SLICE_CHARS = 4_000_000
FEW = 32  # symbols up to which a list is the faster agenda
NONE = float("-inf")
PROBE_UNITS = 64


class Vocabulary:
    """Pieces of a model: id and score by string, byte ids, special ids; read through the library."""

    def __init__(self, model: bytes):
        sp = load(model)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.model = model
        self.packed = {sp.id_to_piece(i): _pack(i) for i in plain}
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        held = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [_pack(i) for i in held] if all(map(sp.is_byte, held)) else None
        self.begin, self.end, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        longer = [p for p in self.packed if len(p) > 1]
        spaced = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in longer)
        lines = any("\n" in p for p in longer)
        self.whole = spaced
        self.unit = "(?s:.+)" if spaced else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if lines else f"{SPACE}+[^{SPACE}\\n]*|\\n|[^{SPACE}\\n]+"


def _pack(token: int) -> bytes:
    return token.to_bytes(4, "little")


def load(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def merge(unit: str, scores: dict[str, float]) -> list[str]:
    """The symbols that are left of ``unit`` when no adjacent pair forms a piece any more."""
    return _merge_few(unit, scores) if len(unit) <= FEW else _merge_many(unit, scores)


def _merge_few(unit: str, scores: dict[str, float]) -> list[str]:
    """The agenda as a plain list, one score per adjacent pair: its best entry, the first of equals, is merged."""
    symbols = list(unit)
    score = scores.get
    agenda = [score(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
    while agenda and (best := max(agenda)) > NONE:
        at = agenda.index(best)
        symbols[at] += symbols.pop(at + 1)
        del agenda[at]
        if at:
            agenda[at - 1] = score(symbols[at - 1] + symbols[at], NONE)
        if at < len(agenda):
            agenda[at] = score(symbols[at] + symbols[at + 1], NONE)
    return symbols


def _merge_many(unit: str, scores: dict[str, float]) -> list[str]:
    """The agenda as a heap over a linked list of symbols."""
    symbols = list(unit)
    after = list(range(1, len(symbols))) + [-1]
    before = list(range(-1, len(symbols) - 1))
    agenda: list[tuple[float, int, int, str]] = []

    def propose(left: int, right: int) -> None:
        if left >= 0 and right >= 0 and (score := scores.get(pair := symbols[left] + symbols[right])) is not None:
            heapq.heappush(agenda, (-score, left, right, pair))

    for at in range(len(symbols) - 1):
        propose(at, at + 1)
    while agenda:
        _, left, right, pair = heapq.heappop(agenda)
        if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != pair:
            continue  # one of the two has been merged since
        symbols[left], symbols[right] = pair, ""
        after[left] = after[right]
        if after[right] >= 0:
            before[after[right]] = left
        propose(before[left], left)
        propose(left, after[left])
    return [s for s in symbols if s]


def encode_unit(unit: str, vocabulary: Vocabulary) -> bytes:
    symbols = merge(unit, vocabulary.scores)
    try:
        return b"".join([vocabulary.packed[s] for s in symbols])
    except KeyError:
        pass
    out, unknown = [], False
    for symbol in symbols:
        known = vocabulary.packed.get(symbol)
        if known is not None:
            out.append(known)
        elif vocabulary.bytes is not None:
            out += [vocabulary.bytes[b] for b in symbol.encode("utf-8", "surrogatepass")]
        elif not unknown:  # without bytes a stretch of unknown symbols is one id
            out.append(_pack(vocabulary.unknown))
        unknown = known is None
    return b"".join(out)


class Encoder(dict):
    """Unit -> its ids as little-endian unsigned 32-bit integers; new units wait in ``new`` for the library's check."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.library, self.new = vocabulary, load(vocabulary.model), {}
        self.units = re.compile(vocabulary.unit).findall
        self.head, self.tail = (_pack(i) if i >= 0 else b"" for i in (vocabulary.begin, vocabulary.end))

    def __missing__(self, unit: str) -> bytes:
        found = self.new.get(unit)
        if found is None:
            found = self.new[unit] = encode_unit(unit, self.vocabulary)
        return found

    def encode(self, text: str) -> bytes:
        return b"".join([self.head, *map(self.__getitem__, self.units(self.library.normalize(text))), self.tail])

    def settle(self) -> None:
        """Hold the new units against the library, then remember the short ones."""
        marked = [u for u in self.new if u[0] == SPACE]
        alone = [u for u in marked if self.vocabulary.whole or not u.strip(SPACE)]
        marked = [] if self.vocabulary.whole else [u for u in marked if u.strip(SPACE)]
        others = [u for u in self.new if u[0] != SPACE and u != "\n"]
        # The library puts a space mark before a text; behind a line feed, which is a unit too, a unit has none.
        mark, feed = self[SPACE], self["\n"]
        probes = [(u, self.new[u]) for u in alone if len(u) > 1]
        for part in (marked[k:k + PROBE_UNITS] for k in range(0, len(marked), PROBE_UNITS)):
            probes.append(("".join(part), b"".join([self.new[u] for u in part])))
        for part in (others[k:k + PROBE_UNITS] for k in range(0, len(others), PROBE_UNITS)):
            probes.append((f"{SPACE}\n" + "\n".join(part), mark + feed + feed.join([self.new[u] for u in part])))
        for probe, ids in probes:
            if np.array(self.library.encode(probe[1:].replace(SPACE, " ")), "<u4").tobytes() != ids:
                raise ValueError(f"not a merge-type vocabulary: the library encodes {probe[:80]!r} otherwise")
        if len(self) + len(self.new) > CACHE_UNITS:
            self.clear()
        self.update((u, i) for u, i in self.new.items() if len(u) <= CACHE_CHARS)
        self.new = {}


def encode(docs: DataFrame, model: bytes, decode: bool = True) -> DataFrame:
    """doc_id, ``ids`` (little-endian unsigned 32-bit integers, begin and end ids included) and ``decoded`` (null unless asked)."""
    vocabulary = share(docs.sparkSession, Vocabulary(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary())
        for b in batches:
            for part in _slices(b, SLICE_CHARS):
                ids = [encoder.encode(t) for t in part.column(1).to_pylist()]
                encoder.settle()
                texts = [encoder.library.decode(np.frombuffer(i, "<u4").tolist()) if decode else None for i in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                                                 names=["doc_id", "ids", "decoded"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(run, "doc_id long, ids binary, decoded string"))


def _slices(batch: pa.RecordBatch, chars: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``chars`` bytes of text, or one row."""
    ends = np.cumsum(np.array([len(t.as_buffer()) for t in batch.column(1)], np.int64))
    at = 0
    while at < len(batch):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + chars, side="right")))
        yield batch.slice(at, to - at)
        at = to


def read_model(name: str = MODEL) -> bytes:
    """The bytes of a model among the public tokenizers (or at a path), read on the driver."""
    import public_tokenizers

    with open(name if "/" in name else public_tokenizers.path(name), "rb") as f:
        return f.read()


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(read_table(spark, sf_dir, "documents"), read_model())
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
