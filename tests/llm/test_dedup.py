import hashlib
import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tabwright.llm import lzprint, simhash, suffixes
from tabwright.llm.components import component_labels

from .conftest import EDGES, make_docs, prose


def brute_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least id of each row's component; prints: (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 4:
                root[find(a)] = find(b)
    ids = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    return [ids.get(find(i)) for i in range(len(prints))]


def test_simhash_edges(edges, no_docs):
    prints = [(i, brute_simhash(t)) for i, t in EDGES]
    expected = sorted(
        ((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints))), key=str
    )
    got = simhash.near_duplicate_components(edges).collect()
    assert sorted(map(tuple, got), key=str) == expected
    assert simhash.near_duplicate_components(no_docs).count() == 0
    kept = simhash.keep_one_of_each(edges)
    assert kept.columns == edges.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(None) == 2
    assert set(ids) - {None} == {c for _, _, c in expected if c is not None}


@pytest.mark.parametrize("block", [8192, 20])
def test_fingerprint_links_lose_nothing(spark, block):
    rng = random.Random(3)
    values = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 6))))
    centre = rng.getrandbits(64)
    for a in range(40):  # a tight group: many share every segment
        values.add(centre ^ (1 << a % 64) ^ (1 << (a * 7) % 64))
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    edges = simhash.fingerprint_edges(spark.createDataFrame([(v,) for v in signed], "fp long"), block=block)
    pairs = [tuple(r) for r in edges.collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in pairs)
    labels = {r.node: r.label for r in component_labels(edges).collect()}
    expected = brute_components([(v, v & (2**64 - 1)) for v in signed])
    by_label, by_brute = {}, {}
    for v, e in zip(signed, expected):
        by_label.setdefault(labels.get(v, v), set()).add(v)
        by_brute.setdefault(e, set()).add(v)
    assert sorted(map(sorted, by_label.values())) == sorted(map(sorted, by_brute.values()))


def test_component_labels_long_chain(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(300, 301), (301, 300), (5, 5)]
    labels = {r.node: r.label for r in component_labels(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert labels == {i: 0 for i in range(201)} | {300: 300, 301: 300}


def brute_removal(docs):
    """Rows of the report for (doc_id, bytes) in order, by every string of 100 bytes."""
    seen, out = set(), []
    for doc_id, body in docs:
        gone = np.zeros(len(body) + 1, bool)
        for k in range(len(body) - 99):
            piece = body[k : k + 100]
            if piece in seen:
                gone[k : k + 100] = True
            seen.add(piece)
        kept = bytes(c for c, g in zip(body, gone) if not g)
        runs = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if body else 0
        out.append((doc_id, len(body), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def in_order(pairs):
    return sorted(
        ((i, (t or "").encode()) for i, t in pairs), key=lambda r: (r[0] is None, r[0] or 0, r[1])
    )


def test_suffix_removal_edges(edges, no_docs):
    got = sorted(map(tuple, suffixes.removal_report(edges).collect()), key=str)
    assert got == sorted(brute_removal(in_order(EDGES)), key=str)
    assert suffixes.removal_report(no_docs).count() == 0
    cut = suffixes.remove_repeats(edges)
    assert cut.columns == edges.columns and cut.count() == len(EDGES)
    rows = {r.doc_id: r for r in cut.collect() if r.doc_id not in (None, 1)}
    assert rows[2].text == "" and rows[2].n_chars == 0 and rows[6].text == "one" and rows[3].text == ""
    assert suffixes.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("most", [20_000, 3])
def test_suffix_removal_random(spark, monkeypatch, most):
    monkeypatch.setattr(suffixes, "SHARD_CONTEXTS", most)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 3000)
    rng = random.Random(most)
    base = "".join(rng.choice("abcdé ") for _ in range(2500)) + "xyz ab c" * 60
    pairs = [(500, "ab" * 400), (501, "ab" * 300 + "x" * 500), (502, "y" * 99), (503, "y" * 101)]
    for i in range(50):
        text = list(base[rng.randrange(2000) :][: rng.randrange(1500)])
        for _ in range(rng.randrange(6)):
            if text:
                text[rng.randrange(len(text))] = "Z"
        pairs.append((i * 3, "".join(text)))
    got = sorted(map(tuple, suffixes.removal_report(make_docs(spark, pairs).repartition(4)).collect()))
    assert got == sorted(brute_removal(in_order(pairs)))


def test_suffix_order_and_prefixes():
    rng = random.Random(8)
    for text in (bytes(rng.choice(b"ab") for _ in range(600)), b"abcab" * 90, b"z" * 150, b"q", b"mno" * 40 + b"mno"):
        data = np.frombuffer(text, np.uint8)
        order = suffixes.suffix_order(data).tolist()
        assert sorted(order) == list(range(len(text)))
        cut = [text[i : i + 100] for i in order]
        assert cut == sorted(cut)
        found = suffixes.common_prefixes(data, np.array(order), 100)
        for k in range(1, len(order)):
            a, b = text[order[k - 1] :], text[order[k] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert min(int(found[k]), 100) == min(same, 100)


def brute_fingerprints(pairs):
    ordered = [(i, t.decode()) for i, t in in_order(pairs)]
    expected = []
    for k, (doc_id, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        swap = len(text) // 4
        edited = text[: len(text) - swap] + following[:swap]
        own, changed, other = map(lzprint.text_signature, (text, edited, following))
        expected.append(
            (
                doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), lzprint.print_text(own),
                lzprint.print_text(changed), lzprint.likeness(own, changed), lzprint.likeness(own, other),
            )
        )
    return sorted(expected, key=str)


def test_fingerprints_follow_the_contract(edges, no_docs):
    got = lzprint.fingerprint_report(edges).collect()
    assert sorted(map(tuple, got), key=str) == brute_fingerprints(EDGES)
    assert lzprint.fingerprint_report(no_docs).count() == 0


@pytest.mark.parametrize("crowd", ["nulls", "one id", "only nulls", "copies", "great ids"])
def test_fingerprints_of_crowded_ids(spark, crowd):
    rng = random.Random(crowd)
    texts = [prose(k, rng.randrange(0, 30)) for k in range(120)]
    ids = {
        "nulls": [None if k % 3 else k for k in range(120)],
        "one id": [7 if k % 3 else k for k in range(120)],
        "only nulls": [None] * 120,
        "copies": [None if k % 2 else k for k in range(120)],
        "great ids": [(1 << 62) + 3 * k + 1 for k in range(120)],
    }[crowd]
    if crowd == "copies":
        texts = [texts[0] if k % 5 else t for k, t in enumerate(texts)]
    pairs = list(zip(ids, texts))
    docs = make_docs(spark, pairs).repartition(5)
    got = lzprint.fingerprint_report(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute_fingerprints(pairs)
    if crowd in ("nulls", "one id", "only nulls"):
        blocks = lzprint._in_blocks(docs, 12).filter("not guest").groupBy("block").count().collect()
        assert max(r["count"] for r in blocks) < 60


def test_phrases_set_aside_are_not_forgotten():
    data = prose(4, 3000).encode()
    small, plain = lzprint.PhraseParse(recent=16), lzprint.PhraseParse()
    small.feed(data[:5000])
    fork = small.fork().feed(data[5000:])
    small.feed(b"other words")
    assert fork.older and fork.ends == plain.feed(data).ends


def test_phrases_are_the_longest_known_and_one_more():
    data = prose(9, 300).encode()
    parse = lzprint.PhraseParse().feed(data[:500]).feed(data[500:])
    known, at, ends = set(), 0, []
    for i in range(1, len(data) + 1):
        if data[at:i] not in known:
            known.add(data[at:i])
            ends.append(i)
            at = i
    assert list(parse.ends) == ends
    assert lzprint.likeness(lzprint.text_signature("ab"), lzprint.text_signature("ab")) == 1.0
    assert lzprint.likeness(lzprint.text_signature("ab"), lzprint.text_signature("xy")) == 0.0
