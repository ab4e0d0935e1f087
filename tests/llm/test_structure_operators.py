"""Operators 11 to 13 against brute force and the sentencepiece library: nulls, empty and long texts, ties, repeated rows, empty
tables, extra columns with clashing names."""

import hashlib
import heapq
import random
import re
import time
import zlib

import numpy as np
import pytest
import sentencepiece

from tidemark.llm import piece, repair, runs

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def sha(data):
    return hashlib.sha256(data.encode("utf-8", "surrogatepass") if isinstance(data, str) else data).hexdigest()


# --- 11 conversation repair

def cheapest(rows, begin=0, ends=(0, 3)):
    """(cost, audit, places) by uniform-cost search over (cost, audit)."""
    heap, done = [(0, "", 0, begin)], set()
    while heap:
        cost, audit, at, place = heapq.heappop(heap)
        if (at, place) in done:
            continue
        done.add((at, place))
        if at == len(rows) and place in ends:
            return cost, audit
        grammar = {0: "su", 1: "u", 2: "a", 3: "u"}[place]
        to = {"s": 1, "u": 2, "a": 3}
        for r in grammar:
            if r != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", at, to[r]))
        if at < len(rows):
            initial, wrong = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, place))
            if wrong not in ("blank", "duplicate"):
                extra = 3 * (wrong == "truncated")
                for r in grammar:
                    if r != "s":
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, to[r]))
                    if r == initial:
                        heapq.heappush(heap, (cost + extra, audit + "K", at + 1, to[r]))
    return None


def brute_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, kinds = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        kinds.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest([(r[:1], k) for (_, r, _), k in zip(rows, kinds)])
    out, left = [], iter(rows)
    for letter in audit:
        _, role, text = next(left) if letter != "I" else (0, "", "")
        if letter in "RI":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if letter != "D":
            out.append((role, text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            sha("\n".join(f"{r}:{t}" for r, t in out)))


def brute_damage(rows):
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: brute_repair(r) for c, r in found.items()}


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_search_equals_uniform_cost_search_from_every_place():
    r = random.Random(3)
    kinds = {repair.OK: "", repair.BLANK: "blank", repair.DUPLICATE: "duplicate", repair.CUT_SHORT: "truncated"}
    for _ in range(1500):
        letters = r.choice(["uuas", "ua", "suax", "u", "uuuua"])
        rows = [(r.choice(letters + " ").strip(), r.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(r.randint(0, 12))]
        begin, ends = r.choice([0, 0, 1, 2, 3]), r.choice([(0, 3), (0,), (1,), (2,), (3,)])
        assert repair.search(rows, begin, ends) == cheapest([(a, kinds[w]) for a, w in rows], begin, ends)


@pytest.mark.parametrize("letters", ["u", "s", "x", "uuaa", "ua", "ssuu"])
def test_search_stays_small_on_long_monotonous_conversations(letters):
    rows = [(letters[i % len(letters)], repair.OK) for i in range(1000)]
    begun = time.time()
    cost, audit = repair.search(rows)
    assert time.time() - begun < 30 and cost == cheapest([(a, "") for a, _ in rows])[0] and len(audit) >= 1000


def test_conversation_repair_equals_brute_force_over_the_table(spark):
    rows = [tuple(r) for r in table(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(repair.op11_conversation_repair(spark, SF)) == brute_damage(rows)


def odd_conversations():
    """Nulls everywhere, ties, repeats, an empty role, letters of other scripts, long texts and one conversation of many rows."""
    r = random.Random(5)
    rows = [(1, 0, "user", "hi."), (1, None, None, None), (1, 0, "user", "hi."), (1, 1, "", "x!"), (None, 0, "user", "a."), (None, None, "user", ""),
            (2, 5, "tool", "é?"), (2, 5, "assistant", "é?"), (2, 9, "system", "　"), (3, 0, "user", "long " * 50_000 + "."),
            (3, 1, "assistant", "ok."), (4, None, "system", "s.")]
    rows += [(7, r.choice([None, *range(40)]), r.choice(["user", "assistant", "system", "User", ""]), r.choice(["a.", "b!", "c", "", " ", "d?"]))
             for _ in range(120)]
    rows += [(8, 3, "user", "same.")] * 60
    return rows


@pytest.mark.parametrize("long_rows, piece_rows", [(2000, 500), (50, 7), (0, 3), (0, 1)])
def test_long_conversations_are_solved_in_pieces_with_the_same_result(spark, long_rows, piece_rows):
    rows = odd_conversations()
    df = spark.createDataFrame([(*x, "extra") for x in rows], CONV + ", part string")
    expected = {}
    for conv, turn, role, text in rows:
        expected.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    expected = {c: brute_repair(x) for c, x in expected.items()}
    assert rows_of(repair.repair(df, long_rows, piece_rows)) == expected
    assert rows_of(repair.repair(repair.damaged(df), long_rows, piece_rows)) == brute_damage(rows)


def test_conversation_repair_of_empty_tables_and_dropped_conversations(spark):
    assert repair.repair(spark.createDataFrame([], CONV)).count() == 0
    gone = spark.createDataFrame([(5, 0, "user", "x.", False)], CONV + ", present boolean")
    for long_rows in (10, 0):
        assert rows_of(repair.repair(gone, long_rows)) == {5: (0, 0, 0, 0, 0, 0, "", sha(""))}


# --- 12 periodic runs

def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            s = i - q
            while i < n and w[i] == w[i - q]:
                i += 1
            if i - s >= max(6, 4 * q) and not any(all(w[k] == w[k - p] for k in range(s + p, i)) for p in range(1, q)):
                out.append((s, i - s, q))
    return sorted(out)


@pytest.mark.parametrize("many", [0, 2, 16])
def test_runs_equal_brute_force_on_nested_repetitions(monkeypatch, many):
    monkeypatch.setattr(runs, "MANY", many)
    r = random.Random(many)
    for _ in range(2500):
        letters = r.choice([1, 2, 2, 3, 4])
        word = lambda more=0: b"%d" % r.randrange(letters + more)
        w = [word() for _ in range(r.randint(0, 90))]
        if r.random() < .7:
            block = [word() for _ in range(r.randint(1, 4))] * r.randint(1, 8) + [word(1) for _ in range(r.randint(0, 3))]
            w = w[:r.randint(0, 10)] + block * r.randint(1, 7) + w[:r.randint(0, 12)] + block[r.randint(0, 3):] * r.randint(0, 5)
        assert runs.find_runs(w) == brute_runs(w)


def test_runs_of_long_repetitive_texts_take_time_in_proportion():
    r = random.Random(1)
    for words in ([b"na"] * 200_000, ([b"na"] * 10 + [b"x"]) * 15_000,
                  [x for i in range(300) for x in [b"na"] * r.randint(200, 300) + [b"%d" % i]]):
        begun = time.time()
        found = runs.find_runs(words)
        assert found and time.time() - begun < 20


def brute_repeated(doc_id, text):
    words = text.encode("utf-8", "surrogatepass").split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def brute_digests(doc_id, text):
    w = brute_repeated(doc_id, text or "")
    found = brute_runs(w)
    best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
    out = {k for s, n, q in found for k in range(s + q, s + n)}
    return (len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(b" ".join(x for k, x in enumerate(w) if k not in out)))


def test_periodic_runs_equal_brute_force_over_the_table(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect() if len(r.text or "") < 4000]
    odd = [(None, "a b c a b c a b c a b c a b c"), (30_001, None), (30_002, ""), (30_003, " \t\x0b\n"), (30_004, "na " * 300), (30_004, "na " * 300),
           (30_005, "x y z " * 9)]
    odd += [(i, "la " * (i % 17) + "u v " * (i % 5) + "é w " * (i % 11)) for i in range(40_000, 40_200)]
    df = spark.createDataFrame([(*x, 1) for x in rows + odd], "doc_id long, text string, words int")
    monkeypatch.setattr(runs, "read_table", lambda spark, sf_dir, name: df)
    found = sorted((tuple(r) for r in runs.op12_periodic_runs(spark, "").collect()), key=str)
    assert found == sorted(((d, *brute_digests(d, t)) for d, t in rows + odd), key=str)
    assert any(r[1] for r in found) and runs.periodic_runs(df.limit(0)).count() == 0


# --- 13 SentencePiece

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=piece.read_model())


ODD_TEXTS = [None, "", " ", "   ", "a", " a", "a  b   c ", "\n\n", "a\nb\n c", "▁x▁▁y", "</s><s> <0x0A> <unk>", "\x00\x01", "é́ 한글 \U0001f600 ‍",
             "tab\tcr\r\nvt\x0b", "no" * 20_000, "word " * 20_000, "=" * 3000 + " " * 3000 + "-" * 3000, "�   　"]


def expected_pieces(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids))


def test_sentencepiece_equals_the_library_on_whole_texts(spark, library, monkeypatch):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    odd = [(None, "no id"), *((100_000 + i, t) for i, t in enumerate(ODD_TEXTS)), (100_004, "a")]
    df = spark.createDataFrame([(*x, b"") for x in rows + odd], "doc_id long, text string, ids binary")
    monkeypatch.setattr(piece, "read_table", lambda spark, sf_dir, name: df)
    found = sorted((tuple(r) for r in piece.op13_sentencepiece(spark, "").collect()), key=str)
    assert found == sorted(((d, *expected_pieces(library, t)) for d, t in rows + odd), key=str)
    assert piece.encode(df.limit(0), piece.read_model()).count() == 0


@pytest.mark.parametrize("few", [0, 32])
def test_every_unit_of_random_characters_merges_as_the_library_does(library, monkeypatch, few):
    monkeypatch.setattr(piece, "FEW", few)
    vocabulary, r = piece.Vocabulary(piece.read_model()), random.Random(2)
    signs = "etaoinshr THE,.'é▁\n<>0123 \t中\U0001f600"
    encoder = piece.Encoder(vocabulary)
    for _ in range(3000):
        text = "".join(r.choice(signs) for _ in range(r.randint(0, 40)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
        encoder.settle()


def test_a_small_cache_and_units_that_span_the_text_give_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(piece, "CACHE_UNITS", 3)
    vocabulary = piece.Vocabulary(piece.read_model())
    text = "the cat  sat\non the mat " * 30
    for unit in (vocabulary.unit, "(?s:.+)"):
        vocabulary.unit, vocabulary.whole = unit, unit == "(?s:.+)"
        encoder = piece.Encoder(vocabulary)
        for _ in range(2):
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
            encoder.settle()
            assert len(encoder) <= max(3, len(set(re.findall(unit, library.normalize(text)))))


def test_a_difference_from_the_library_fails_the_job():
    vocabulary = piece.Vocabulary(piece.read_model())
    vocabulary.scores = {k: -v for k, v in vocabulary.scores.items()}
    encoder = piece.Encoder(vocabulary)
    encoder.encode("the conversation continues")
    with pytest.raises(ValueError, match="merge-type"):
        encoder.settle()
