import collections
import random
import struct
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from tabwright.llm import encode, tiers

from .conftest import EDGES, make_docs, prose

DOCS = "/root/testdata/sf0.001/documents.parquet"
PATH = encode.tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_byte_encoder_equals_the_tokenizer(tokenizer):
    texts = pq.read_table(DOCS, columns=["text"])["text"].to_pylist()
    texts = [t or "" for t in texts] + [t or "" for _, t in EDGES]
    rng = random.Random(5)
    odd = " \n\t\r \x1c\u0085aéßı'sS'll19½٣.,!<|>end日本☃́‍"
    texts += ["".join(rng.choice(odd) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> <|endoftext|>\n y"]
    coder = tiers.ByteEncoder(PATH)
    found = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [coder.encode(t).tolist() for t in texts] == [x.ids for x in found]


def test_long_texts_are_cut_where_no_merge_reaches(tokenizer, monkeypatch):
    monkeypatch.setattr(tiers, "PART", 40)
    coder = tiers.ByteEncoder(PATH)
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice("ab  \n\t'sé1.") for _ in range(400))
        parts = list(tiers.text_parts(text, 40))
        assert "".join(parts) == text
        assert coder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert list(tiers.text_parts("x" * 500, 40)) == ["x" * 500]


def pieces_of(windows):
    return sorted((p.doc, p.start, p.length, p.body()) for w in windows for p in w)


@pytest.mark.parametrize("seed", range(12))
def test_packer_places_every_id_once_and_pads_nothing(seed):
    rng = random.Random(seed)
    spec = tiers.TierSpec(tiers=(8, 16, 32, 64), block_tokens=500)
    packer, windows, docs = tiers.TierPacker(spec), [], {}
    for doc in range(rng.choice([0, 1, 3, 200])):
        size = rng.choice([1, 2, rng.randrange(1, 64), rng.randrange(1, 300), 64, 128])
        ids = np.array([rng.randrange(1000) for _ in range(size)], "<u4")
        docs[doc] = ids.tobytes()
        packer.add(doc, ids)
        if packer.tokens >= spec.block_tokens:
            full = packer.pack()
            assert {sum(p.length for p in w) for w in full} <= {8, 16, 32, 64}
            assert packer.tokens < 64
            windows += full
    last = packer.pack(last=True)
    windows += last
    sizes = [sum(p.length for p in w) for w in windows]
    assert all(0 < s <= 64 and not s & (s - 1) for s in sizes)
    assert sum(s < 8 for s in sizes) <= 3  # only digits of the last rest lie below the tiers
    found = collections.defaultdict(bytes)
    for doc, start, length, body in pieces_of(windows):
        assert len(found[doc]) == 4 * start and len(body) == 4 * length
        found[doc] += body
    assert dict(found) == docs
    # a document is cut into whole windows and otherwise only where a gap is filled
    whole = sum(len(b) // 256 for b in docs.values())
    assert sum(map(len, windows)) <= whole + len(docs) + len(windows)


def test_best_fit_and_gap_filling():
    packer = tiers.TierPacker(tiers.TierSpec(tiers=(8, 16), block_tokens=99))
    for doc, size in enumerate([12, 3, 4, 7, 9, 5]):
        packer.add(doc, np.arange(size, dtype="<u4"))
    got = [[(p.doc, p.start, p.length) for p in w] for w in packer.pack(last=True)]
    assert got == [
        [(0, 0, 12), (2, 0, 4)],  # 16: the gap of four is met exactly
        [(4, 0, 9), (3, 0, 7)],
        [(5, 0, 5), (1, 0, 3)],  # 8
    ]


def test_step_groups_hold_equal_tokens():
    rng = random.Random(4)
    lengths = [rng.choice([256, 512, 1024, 2048]) for _ in range(700)] + [64, 1]
    groups = tiers.step_groups(lengths, 1 << 14)
    totals = collections.Counter()
    for n, g in zip(lengths, groups):
        totals[g] += n
    assert len(totals) == round(sum(lengths) / (1 << 14))
    assert max(totals.values()) - min(totals.values()) <= 256 + 65
    assert tiers.step_groups([], 10) == []


def test_packing_of_documents(spark, edges, no_docs, tokenizer):
    rows = tiers.placement_report(edges, tiers.TierSpec(block_tokens=20_000)).collect()
    ids = {}
    for doc_id, t in EDGES:
        body = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        ids.setdefault(doc_id, []).append(body)
    covered, sequences = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        bodies = [b for b in ids[r.doc_id] if len(b) == r.doc_tokens]
        crcs = {
            zlib.crc32(struct.pack(f"<{r.length}I", *b[r.start : r.start + r.length]))
            for b in bodies
            if r.start + r.length <= len(b)
        }
        assert r.ids_crc32 in crcs
        covered[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length, r.tier, r.step_group))
    assert covered == {d: sum(map(len, bodies)) for d, bodies in ids.items()}
    for places in sequences.values():
        places.sort()
        assert [o for o, *_ in places] == [sum(n for _, n, *_ in places[:i]) for i in range(len(places))]
        total = sum(n for _, n, *_ in places)
        assert {t for *_, t, _ in places} == {total} and len({g for *_, g in places}) == 1
        assert total <= 2048 and not total & (total - 1)
    assert tiers.placement_report(no_docs).count() == 0


def test_ids_are_those_of_the_documents(spark, tokenizer):
    docs = make_docs(spark, [(1, prose(1, 3000)), (2, "b"), (3, None)])
    parts = sorted(map(tuple, tiers.pack_tiers(docs).select("doc_id", "start", "ids").collect()))
    text = prose(1, 3000)
    joined = b"".join(bytes(b) for d, _, b in parts if d == 1)
    want = tokenizer.encode(text, add_special_tokens=False).ids + [1]
    assert np.frombuffer(joined, "<u4").tolist() == want
    assert [bytes(b) for d, _, b in parts if d == 3] == [b"\1\0\0\0"]


def test_tiers_are_powers_of_two():
    for bad in ((256, 300), (512, 256)):
        with pytest.raises(ValueError):
            tiers.TierSpec(tiers=bad)
