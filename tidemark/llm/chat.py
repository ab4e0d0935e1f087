"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and its sorted turn spans are intersected with the
sorted token spans by binary search: a token is under the loss mask if it shares a character with an
assistant text, and the mask's character spans are those intersections. So a token that reaches over a
turn's edge never brings template characters into the masked text.

Template: ``<|role|>\\n`` text ``<|end|>\\n`` per turn. Control strings (those of this template and of other common
ones) are escaped in roles and texts: a backslash is doubled, and a ``<`` or ``[`` that could begin a control string
becomes ``\\l`` or ``\\b`` (``|`` in a role ``\\p``). Every escape is a backslash and one character, so formatting is
reversible whatever the text holds.

Rows of a conversation are brought together by one shuffle and sorted by turn inside their partition; tasks
stream over them and hold one piece of a conversation. A conversation of more than ``PIECE_CHARS``
rendered characters is encoded in several pieces, cut between turns; ``piece`` numbers them.

Edge cases: a null text or role is empty; a null ``conv_id`` is one conversation; ties in ``turn`` are ordered by role, then text;
repeated rows are repeated turns; a null turn comes first; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, text_or_empty

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_CHARS = 4_000_000
TRAINED_ROLE = "assistant"

END = "<|end|>\n"
# Where a control string begins: < before | / s < or [ before / I (any case): <|..|>, <s>, </s>, <<SYS>>, [INST], [/INST].
_CONTROL = re.compile(r"\\|<(?=[|/s<]|$)|\[(?=[/I]|$)", re.I)
_ROLE_CONTROL = re.compile(r"[\\<\[|]")
_ESCAPED = re.compile(r"\\(.)")
_SPELLED = {"\\": "\\\\", "<": "\\l", "[": "\\b", "|": "\\p"}
_MEANT = {v[1]: k for k, v in _SPELLED.items()}
_TURN = re.compile(r"<\|([^|]*)\|>\n(.*?)<\|end\|>\n", re.S)


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: _SPELLED[m.group()], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _MEANT[m.group(1)], text)


def render(turns: list[tuple[str, str]], trained: str = TRAINED_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """The rendered text, and the sorted spans of the trained role's (escaped) texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<|{escape(role, _ROLE_CONTROL)}|>\n", escape(text)
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(text: str) -> list[tuple[str, str]]:
    """Turns (role, text) read back from a rendered text."""
    return [(unescape(m.group(1)), unescape(m.group(2))) for m in _TURN.finditer(text)]


def align(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Token mask and masked character spans: sorted token offsets (n, 2) against sorted turn spans.

    Tokens that share a character (pieces of one code point) count it once. White space that a tokenizer leaves out
    of its offsets belongs to the token behind it.
    """
    mask = np.zeros(len(offsets), bool)
    found: list[tuple[int, int]] = []
    ends = np.maximum.accumulate(offsets[:, 1]) if len(offsets) else offsets[:, 1]
    starts = np.minimum(offsets[:, 0], np.concatenate(([0], ends[:-1]))) if len(offsets) else offsets[:, 0]
    for lo, hi in spans:
        if lo == hi:
            continue
        first, last = np.searchsorted(ends, lo, side="right"), np.searchsorted(starts, hi, side="left")
        mask[first:last] = True
        at = lo
        for s, e in zip(np.maximum(starts[first:last], lo).tolist(), np.minimum(ends[first:last], hi).tolist()):
            s = max(s, at)
            if s < e:
                if found and found[-1][1] == s and s > lo:
                    found[-1] = (found[-1][0], e)
                else:
                    found.append((s, e))
                at = e
    return mask, found


def format_conversations(conversations: DataFrame, tokenizer: str = TOKENIZER, trained: str = TRAINED_ROLE,
                         piece_chars: int = PIECE_CHARS) -> DataFrame:
    """conv_id, piece, text, input_ids, loss_mask (per token) and loss_spans (characters), in order inside partitions."""
    schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("last", pa.bool_()), ("text", pa.string()),
                        ("input_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_())),
                        ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True  # their strings in a text are ordinary text

        def encoded(pieces: list[tuple]) -> pa.RecordBatch:
            rows = []
            drawn = [render(turns, trained) for _, _, _, turns in pieces]
            for (conv, piece, last, _), (text, spans), code in zip(
                    pieces, drawn, encoder.encode_batch([t for t, _ in drawn], add_special_tokens=False)):
                mask, found = align(np.array(code.offsets, np.int64).reshape(-1, 2), spans)
                rows.append((conv, piece, last, text, code.ids, mask.tolist(), [{"start": s, "end": e} for s, e in found]))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        ready, size = [], 0
        for piece in _pieces(batches, piece_chars):
            ready.append(piece)
            size += sum(len(t) for _, t in piece[3])
            if size > 1_000_000:
                yield encoded(ready)
                ready, size = [], 0
        if ready:
            yield encoded(ready)

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text_or_empty().alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(run, "conv_id long, piece long, last boolean, text string, input_ids array<int>, "
                                "loss_mask array<boolean>, loss_spans array<struct<start:long,end:long>>")


def _pieces(batches: Iterator[pa.RecordBatch], piece_chars: int) -> Iterator[tuple]:
    """(conv_id, piece number, whether it is the last, turns) from rows in order."""
    turns, size, conv, number, begun = [], 0, None, 0, False
    for c, role, text in chain.from_iterable(zip(*(b.column(i).to_pylist() for i in (0, 2, 3))) for b in batches):
        if begun and c != conv:
            yield conv, number, True, turns
            turns, size, number = [], 0, 0
        elif size > piece_chars:
            yield conv, number, False, turns
            turns, size, number = [], 0, number + 1
        conv, begun = c, True
        turns.append((role, text))
        size += len(role) + len(text)
    if begun:
        yield conv, number, True, turns


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from ``format_conversations``' rows: counts and digests of turns and masked text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            out = []
            for conv, piece, last, text, spans in zip(*(b.column(i).to_pylist() for i in range(5))):
                if not piece:
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for s in spans:
                    said = unescape(text[s["start"]:s["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                if last:
                    out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(zip(*out))],
                                                 names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                                        "formatted_chars"])

    return formatted.select("conv_id", "piece", "last", "text", "loss_spans").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    table = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return digests(format_conversations(table.unionByName(probe)))
