import random

import numpy as np
import pytest
import xxhash

from gondola.llm import simhash
from gondola.llm.common import components


def brute_print(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()]
    if not words:
        return 0
    pieces = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, threshold=3):
    """Smallest index reachable, by comparing all pairs."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= threshold and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_print_of_texts():
    for text in [None, "", " \n", "One", "One two", "One two three", "a b c d " * 50, "É é\x0bÀ b C", "x" * 5000]:
        assert simhash.fingerprint_bits((text or "").encode()) == brute_print(text)


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(str(i % 97) for i in range(1000))
    whole = simhash.fingerprint_bits(text.encode())
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint_bits(text.encode()) == whole


@pytest.mark.parametrize("bits", [31, 15])
def test_anchors_are_all_within_two_bits(bits):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(0, 2 ** (bits + 1), 300, dtype=np.uint64), np.zeros(1, np.uint64)])
    near = simhash.anchors(points, bits)
    code = [p for p in range(2 ** bits) if not simhash._syndrome(np.array([p], np.uint64), bits)[0]] if bits == 15 else None
    for p, row in zip(points, near):
        assert (np.bitwise_count(row ^ p) <= 2).all() and np.bitwise_count(row[0] ^ p) <= 1
        if code:
            true = {c | top << bits for c in code for top in (0, 1) if (int(p) ^ (c | top << bits)).bit_count() <= 2}
            assert {int(x) for x in row} == true


def near_prints(seed, number=400):
    rnd = random.Random(seed)
    prints = {0, 2 ** 64 - 1}
    while len(prints) < number:
        base = rnd.choice([rnd.getrandbits(64), rnd.choice(sorted(prints))])
        for bit in rnd.sample(range(64), rnd.randint(0, 4)):
            base ^= 1 << bit
        prints.add(base)
    return sorted(prints, key=lambda p: xxhash.xxh64_intdigest(str(p).encode()))


@pytest.mark.parametrize("split_from", [4096, 3])
def test_links_connect_what_all_pairs_connect(spark, split_from):
    prints = near_prints(split_from)
    signed = [p - 2 ** 64 if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "node long, print long")
    links = simhash.linked_prints(df, split_from=split_from)
    assert all((prints[r.a] ^ prints[r.b]).bit_count() <= 3 for r in links.collect())
    got = {r.node: r.component for r in components(links).collect()}
    assert [got.get(i, i) for i in range(len(prints))] == brute_components(prints)


def test_documents(spark):
    rows = [(1, "a b c d"), (2, "A  b\nc d"), (3, None), (4, ""), (5, " "), (None, "a b c d"), (1, "a b c d"), (7, "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as print", "7 as component_id")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    want = []
    for doc_id, text in rows:
        near = [d for d, t in rows if d is not None and (brute_print(t) ^ brute_print(text)).bit_count() <= 3]
        want.append((doc_id, f"{brute_print(text):016x}", min(near)))
    assert got == sorted(want, key=str)
    kept = sorted(r.doc_id or 0 for r in simhash.one_per_component(docs).collect())
    assert kept == [0, 1, 3, 7] and simhash.one_per_component(docs).columns == docs.columns


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0 and simhash.one_per_component(docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 180)] + [(5, 5), (200, 201), (201, 200)]
    edges = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 180)}, 200: 200, 201: 200}


def test_one_row_of_each_component_where_ids_repeat(spark):
    a, b, c = ("the quick brown fox jumps over a lazy dog", "wholly other words stand in this one text", "and a third that shares nothing at all")
    rows = [(3, a, {"x": 1}), (5, a, None), (5, b, {"y": 2}), (5, c, None), (5, c, None), (7, b, None), (None, a, None), (None, None, None), (9, None, None), (8, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print map<string,int>")
    got = simhash.one_per_component(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(3, a), (5, b), (5, c), (None, a), (None, None), (8, "")], key=str)
    assert simhash.one_per_component(docs.limit(0)).count() == 0
