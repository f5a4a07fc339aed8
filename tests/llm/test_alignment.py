import random
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF_DIR
from gondola.llm import alignment
from gondola.llm.queries import BYTES, PIECES

A, B = public_tokenizers.path(BYTES), public_tokenizers.path(PIECES)
BITS = ["a", "the", "Some", " ", "  ", "\n", "\n\n", "\t", "▁", "é", "ß", "日本", "　", "\xa0", "'s", "<s>", "<|endoftext|>",
        "<0x41>", "1", "23", ".", "\r\n", "​", "\x1c", "🙂", " \n", "_", "\x00", "(", "aa" * 20]


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(open(A, "rb").read(), open(B, "rb").read())


@pytest.fixture(scope="module")
def brute():
    """Groups and links by definition: whole texts, all pairs of tokens."""
    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    points = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in points} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in points)}

    def spans(ids, raw):
        end, result = 0, []
        for i, part in zip(ids, raw):
            result.append((i, end, end + len(part)))
            end += len(part)
        return result

    def run(text):
        if not text:
            return "", Counter()
        a_ids, b_ids = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        a_raw = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a_ids]
        b_raw = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()
                 for i, p in zip(b_ids, map(b_model.id_to_piece, b_ids))]
        if not b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
            return "", Counter()
        a, b = spans(a_ids, a_raw), spans(b_ids, b_raw)
        linked = Counter((x, y) for x, s, e in a for y, t, f in b if s < f and t < e)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        parts = [[",".join(str(x) for x, s, e in side if low <= s and e <= high) for side in (a, b)]
                 for low, high in zip([0, *cuts], cuts)]
        return ";".join("|".join(p) for p in parts), linked

    return run


def counter(pairs, times):
    return Counter({(int(p) >> alignment.SHIFT, int(p) & (1 << alignment.SHIFT) - 1): int(n) for p, n in zip(pairs, times)})


def texts(number, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(BITS) for _ in range(rnd.randint(1, 30))) for _ in range(number)]


def test_words_apart_give_the_tokens_of_the_whole_text(pair, brute):
    assert pair.apart
    for text in texts(800, 1):
        words = pair.words(text)
        pair.known([words])
        found = pair.closed(words)
        groups, linked = brute(text)
        assert (found[0] if found else "") == groups, text
        assert counter(*found[4:]) == linked if found else not linked


def test_ranges_of_any_size_compose_to_the_whole(pair, brute):
    rnd = random.Random(2)
    for text in texts(800, 3):
        found = alignment.EMPTY
        for part in alignment.ranges(text, rnd.randint(1, 12)):
            found = found + pair.fragment(*part)
        whole = found.whole()
        groups, linked = brute(text)
        assert whole.closed == groups and counter(whole.pairs, whole.times) == linked, text
        assert whole.n_a + whole.n_b - whole.n_groups == sum(linked.values())


def test_composition_is_associative(pair):
    text = "Some tokenizers' cut-points differ: naïve, 日本語 <0x41> 12345 unbelievableness"
    parts = [pair.fragment(*p) for p in alignment.ranges(text, 7)]

    def plain(f):
        tokens = [[x.tolist() for x in side] for side in (f.prefix, f.suffix)]
        return (*f[:2], tokens, f.closed, f.n_a, f.n_b, f.n_groups, f.pairs.tolist(), f.times.tolist())

    rnd = random.Random(4)
    left = alignment.EMPTY
    for p in parts:
        left = left + p
    for _ in range(20):
        some = list(parts)
        while len(some) > 1:
            i = rnd.randrange(len(some) - 1)
            some[i:i + 2] = [some[i] + some[i + 1]]
        assert plain(some[0]) == plain(left) == plain(alignment.EMPTY + left + alignment.EMPTY)


def test_a_long_word_is_one_range():
    word = "x" * 100
    found = list(alignment.ranges(f"a b {word} c d e f g", 10))
    assert sum(word.encode() in p[0].encode() for p in found) <= 2
    assert found[0][2] == 0 and all(p[3] == q[2] for p, q in zip(found, found[1:]))


def test_forgetting_words_changes_nothing(pair, brute, monkeypatch):
    monkeypatch.setattr(alignment, "WORDS", 20)
    for text in texts(60, 5):
        words = pair.words(text)
        pair.known([words])
        assert (pair.closed(words) or ("",))[0] == brute(text)[0]


def test_report(spark, brute, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts(60, 6))] + [(7, "Some more"), (None, "a b"), (90, None), (91, ""), (7, "Some more")]
    rows += [(100 + i, "".join(texts(60, 7 + i))) for i in range(4)] + [(110, " ".join(["aa" * 40, "the 23 "] * 300).strip())]
    expected = [(d, *brute(t)) for d, t in rows]
    count = Counter(p for _, _, linked in expected for p in linked)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)

    def line(doc_id, groups, linked):
        sides = [g.split("|") for g in groups.split(";")] if groups else []
        n_a, n_b = (sum(len(s[i].split(",")) for s in sides) for i in (0, 1))
        best = sum(k for p, k in linked.items() if count[p] == most[p[0]])
        total = sum(k * count[p] for p, k in linked.items())
        return doc_id, n_a, n_b, len(sides), sum(linked.values()), best, total, sha256(groups.encode()).hexdigest() if groups else ""

    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, key long, row long").repartition(3)
    monkeypatch.setattr(alignment.aligned, "__defaults__", (64, 2))
    for at_once in (alignment.COUNTS, 50):
        found = [tuple(r) for r in alignment.report(docs, A, B, at_once).collect()]
        assert sorted(found, key=str) == sorted((line(*e) for e in expected), key=str)


def test_no_documents(spark):
    assert alignment.report(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_given_documents(spark, brute):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r for r in alignment.aligned(docs, A, B, 1 << 12).collect()}
    for r in docs.collect():
        groups, linked = brute(r.text)
        assert rows[r.doc_id].groups == groups and counter(rows[r.doc_id].pairs, rows[r.doc_id].times) == linked
