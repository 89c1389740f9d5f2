import collections
import math
import struct
import zlib

import numpy as np
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

from tabwright.llm import encode, lengths, packing, pitman, unigram

from .conftest import EDGES, make_docs, prose

DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encode.tokenizer_path())


def test_word_encoder_equals_the_tokenizer(tokenizer):
    texts = pq.read_table(DOCS, columns=["text"])["text"].to_pylist()[:100]
    texts += ["It's ÉCOLE, don’t x<|ENDoftext|>y a<|endoftext|>b", "Σας. ΣΑΣ é, ́a ", "", "日本語。 naïve a.,b 12,5 １２"]
    texts += ["x y z , . .. ,a", "a!, b?. 'S's ll'", prose(5, 500)]
    coder = encode.WordEncoder(encode.tokenizer_path())
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode([t.encode() for t in texts])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing(spark, edges, no_docs, tokenizer):
    rows = packing.pack_documents(edges, group_documents=5).collect()
    texts = {}
    for i, t in EDGES:
        texts.setdefault(i, []).append(t or "")
    pieces = collections.Counter()
    sequences = collections.defaultdict(list)
    for r in rows:
        bodies = [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in set(texts[r.doc_id])]
        parts = [b[r.start : r.start + 2048] for b in bodies]
        assert any(
            len(p) == r.length and zlib.crc32(struct.pack(f"<{len(p)}I", *p)) == r.ids_crc32 for p in parts
        )
        assert r.start == 2048 * r.piece
        pieces[r.doc_id] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    lengths_of = {
        i: sum(-(-(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1) // 2048) for t in ts)
        for i, ts in texts.items()
    }
    assert dict(pieces) == lengths_of
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(no_docs).count() == 0


def test_open_bins_fit_best_and_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 3)] == [(0, 0), (1, 0), (1, 7)]  # the tighter bin is full now
    assert bins.put(5) == (2, 0)
    assert bins.put(9) == (3, 0)  # opens a third: bin 0, with the least room, closes
    assert bins.put(4) == (2, 5)
    assert bins.put(1) == (3, 9) or bins.put(1)


def test_length_tables(spark, edges, no_docs, tokenizer):
    sizes = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in EDGES)
    report = {r.context_limit: r for r in lengths.length_report(edges).collect()}
    assert set(report) == {0, *range(1, sizes[-1] + 1)}
    for limit in {*sizes, 2, 7, 512, 2047, 4096, sizes[-1] - 1}:
        r = report[limit]
        over = [s for s in sizes if s >= limit]
        assert (r.docs_at_least, r.tokens_at_least) == (len(over), sum(over))
        assert r.truncated_tokens == sum(min(s, limit) for s in sizes)
        assert r.lost_tokens == sum(sizes) - r.truncated_tokens
        assert math.isclose(r.rank_fraction, sum(s <= limit for s in sizes) / len(sizes))
        assert r.percentile == 100 * sum(s <= limit for s in sizes) // len(sizes)
    assert all(r.n_docs == sizes.count(limit) for limit, r in report.items())
    histogram = lengths.length_histogram(lengths.encoded_lengths(edges))
    asked = spark.createDataFrame([(5000,), (10**7,), (5000,), (None,)], "context_limit int")
    some = {r.context_limit: r for r in lengths.limit_table(histogram, asked).collect()}
    assert set(some) == {*sizes, 5000, 10**7}
    assert some[5000].truncated_tokens == sum(min(s, 5000) for s in sizes)
    assert (some[10**7].docs_at_least, some[10**7].lost_tokens) == (0, 0)
    assert set(r.context_limit for r in lengths.limit_table(histogram).collect()) == set(sizes)
    found = lengths.quantile_lengths(lengths.length_report(edges), [0.5, 1.0]).collect()
    assert {r.share: r.n_tokens for r in found} == {0.5: sizes[len(sizes) // 2 - 1], 1.0: sizes[-1]}
    assert lengths.length_report(no_docs).count() == 0
    none = lengths.length_histogram(lengths.encoded_lengths(no_docs))
    assert lengths.limit_table(none, asked).count() == 0


@pytest.fixture(scope="module")
def table():
    return unigram.PieceTable.load(unigram.piece_model_path())


def test_double_array_holds_every_key():
    keys = sorted({prose(i, 1).encode() for i in range(300)} | {b"a", b"ab", b"abc", "é".encode()})
    base, check, value = unigram.build_double_array(keys)

    def find(key):
        state = 0
        for c in key:
            step = base[state] + c
            if check[step] != state:
                return -1
            state = step
        return value[state]

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert find(b"abcd") == -1 and find(b"zzzz") == -1


def test_viterbi_is_the_best_segmentation(table):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=unigram.piece_model_path())
    pieces = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            pieces[model.id_to_piece(i).replace("▁", " ")] = model.get_score(i)
    coder = unigram.UnigramCoder(table)
    for text in [t or "" for _, t in EDGES[:13]] + ["  a  b ", "é☃①x 日本", "\n\n x\n"]:
        text = text[:600]
        body = (" " + text.replace("▁", " ")) if text else ""
        best = [0.0] + [-math.inf] * len(body)
        for i in range(len(body)):
            for j in range(i + 1, min(len(body), i + 50) + 1):
                if body[i:j] in pieces:
                    best[j] = max(best[j], best[i] + pieces[body[i:j]])
            if body[i] not in pieces:
                best[i + 1] = max(best[i + 1], best[i] + table.unknown)
        ids, score, spelled = coder.encode(text.encode())
        assert score == best[-1]
        assert coder.decode(ids) == text.replace("▁", " ")
        numbers = np.frombuffer(ids, "<u4").tolist()
        assert coder.decode(ids) == model.decode(numbers)
        assert spelled == sum(model.is_byte(i) for i in numbers)


def test_unigram_documents(edges, no_docs):
    rows = unigram.encode_documents(edges, with_ids=True).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        assert r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.round_trip == (r.doc_id != 12)
    assert unigram.encode_documents(no_docs).count() == 0


def brute_base(pairs):
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in pairs]
    counts = collections.Counter()
    for i, words in tokens:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, words in tokens:
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        out.append((i, len(words), sum(counts[w] > 0 for w in words), total, round(base, 6)))
    return sorted(out, key=str)


def test_long_texts_add_parts_to_packing(spark):
    docs = make_docs(spark, [(i, prose(i, 3000)) for i in range(4)])
    parts = lambda **kw: {r.sequence_id >> 40 for r in packing.pack_documents(docs, **kw).collect()}
    assert parts() == {0}
    assert len(parts(group_bytes=10_000)) > 1


def test_pitman_yor_counts_and_scores(spark, edges, no_docs):
    report = pitman.score_report(edges, pitman.ModelSpec(shard_tokens=2000)).collect()
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in report), key=str)
    assert got == brute_base(EDGES)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in report)
    assert pitman.score_report(no_docs).count() == 0


def test_pitman_yor_beats_its_base_and_does_not_depend_on_shards(spark):
    docs = spark.read.parquet(DOCS)
    spec = pitman.ModelSpec(shard_tokens=1 << 22)
    one = {r.doc_id: r for r in pitman.score_report(docs, spec).collect()}
    unseen = [r for r in one.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    two = pitman.score_report(docs.repartition(3), pitman.ModelSpec(shard_tokens=5000))
    assert all(math.isclose(one[r.doc_id].score, r.score, rel_tol=1e-5) for r in two.collect())


def test_seating_follows_the_restaurant():
    rng = np.random.default_rng(1)
    count = np.array([0, 1, 2, 2000])
    tables = np.mean(
        [pitman.seat(count, np.full(4, 10.0), np.full(4, 0.2), 0.5, 1.0, rng) for _ in range(4000)], axis=0
    )
    assert tables[0] == 0 and tables[1] == 1
    odds = (1 + 0.5 * 11) * 0.2
    assert abs(tables[2] - 1 - odds / (odds + 0.5)) < 0.03
    one_by_one = np.random.default_rng(2)
    t = 1.0
    runs = []
    for _ in range(200):
        t = 1.0
        for k in range(1, 2000):
            odds = (1 + 0.5 * (10 + t)) * 0.2
            t += one_by_one.random() < odds / (odds + k - 0.5 * t)
        runs.append(t)
    assert abs(tables[3] - np.mean(runs)) < 0.1 * np.mean(runs)


def pair_probabilities(spark, docs, spec):
    """{(context, word hash): probability} of all pairs in the documents, and the layout."""
    rows = docs.select("doc_id", (~pitman.held_out(docs.doc_id)).alias("train"), docs.text.cast("binary"))
    shards = rows.mapInArrow(pitman._shards(spec), pitman.SHARD_DDL).cache()
    layout = pitman.laid_out(shards, spec)
    asked = pitman.asked_pairs(shards, layout)
    known, told = pitman.train(asked, layout, spec)
    asked, told = asked.toArrow(), told.toArrow()
    out = {}
    for bucket in set(asked.column("bucket").to_pylist()):
        own, rows = (t.filter(pc.equal(t.column("bucket"), bucket)) for t in (asked, told))
        b = pitman.Bucket(own, layout)
        share = pitman.predictive(b, layout, known, spec, rows)
        for context, word, p in zip(b.contexts[b.context].tolist(), b.words[b.word].tolist(), share.tolist()):
            assert (context, word) not in out
            out[context, word] = p
    return out, layout


@pytest.mark.parametrize("bucket_tokens", [1 << 22, 300])
def test_predictive_probabilities_of_every_context_sum_to_one(spark, bucket_tokens):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(12)]
    held = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 7 == 2]
    train = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 7 != 2]
    ranks = lambda n: np.minimum(rng.zipf(1.4, n) - 1, 11)
    docs = [(train[i], " ".join(vocabulary[k] for k in ranks(40))) for i in range(60)]
    pairs = [f"{u} {w}" for u in [*vocabulary, "fresh"] for w in [*vocabulary, "unseen"]]
    docs += list(zip(held, [*pairs, *vocabulary, "unseen", "fresh", ""]))
    spec = pitman.ModelSpec(bucket_tokens=bucket_tokens, shard_tokens=1500)
    found, layout = pair_probabilities(spark, make_docs(spark, docs).coalesce(2), spec)
    assert (len(layout.hot) > 0) == (bucket_tokens == 300)
    hashes = pitman.token_hashes([" ".join([*vocabulary, "unseen"]).encode()])[0]
    starts = pitman.token_hashes([b"fresh"])[0][:1]
    contexts = layout.contexts(np.concatenate((hashes[:-2], starts, [pitman.START]))).tolist()
    for context in contexts:
        assert math.isclose(sum(found[context, w] for w in hashes.tolist()), 1, abs_tol=1e-9)


def table_shares(count, others, weight, discount, strength):
    """Exact law of a dish's tables given the rest: partitions into t tables times new-table odds."""
    ways = {1: 1.0}
    for n in range(1, count):
        ways = {
            t: ways.get(t - 1, 0) + (n - discount * t) * ways.get(t, 0) for t in range(1, n + 2)
        }
    odds = [
        ways[t] * math.prod((strength + discount * (others + i)) * weight for i in range(t))
        for t in range(1, count + 1)
    ]
    return np.array(odds) / sum(odds)


def test_gibbs_moves_follow_the_exact_law():
    rng = np.random.default_rng(8)
    n, count, others, weight, discount, strength = 20_000, 6, 3, 0.15, 0.4, 1.0
    seating = pitman.Seating.opened(np.full(n, count), np.full(n, 6), discount, rng)
    totals = np.full(n, others + 6.0)
    for _ in range(12):
        seating.move(np.arange(n), totals, np.full(n, weight), discount, strength, 4, rng)
    assert (totals == others + seating.tables).all()
    assert (np.add.reduceat(seating.sizes, np.cumsum(seating.tables) - seating.tables) == count).all()
    shares = np.bincount(seating.tables, minlength=7)[1:] / n
    assert np.abs(shares - table_shares(count, others, weight, discount, strength)).max() < 0.012


def test_customers_come_and_go_at_the_root():
    rng = np.random.default_rng(9)
    before, after = np.array([0, 1, 5, 400, 3, 9]), np.array([2, 0, 7, 3, 3, 900])
    seating = pitman.Seating.opened(before, (before > 0) * 2, 0.5, rng)
    total = seating.settle(after, float(seating.tables.sum()), 0.1, 0.5, 1.0, 4, rng)
    assert (seating.count == after).all() and total == seating.tables.sum()
    assert ((seating.tables > 0) == (after > 0)).all() and (seating.sizes > 0).all()
    again = pitman.Seating.unpacked(seating.packed())
    assert (again.count == after).all()


def test_language_model_without_training_documents(spark):
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = pitman.score_report(make_docs(spark, [(held[0], "a b"), (held[1], None)])).collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in rows] == [(0, 0, 0.0)] * 2
