import re
import textwrap
import zlib

import numpy as np

import corpus_pipeline
from tabwright.llm import licences, linecrf, rules, sql

from .conftest import EDGES, make_docs, prose


def oracle(query, pairs=None, docs=None):
    import duckdb

    con = duckdb.connect()
    documents = docs.select("doc_id", "text", "lang", "source", "n_chars").toPandas()  # noqa: F841
    con.execute(
        "CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)"
    )
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    return con.execute(query)


def same(df, query, docs):
    result = oracle(query, docs=docs)
    names = [d[0] for d in result.description]
    got = sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    expected = sorted(str(tuple(x for _, x in sorted(zip(names, r)))) for r in result.fetchall())
    assert got == expected


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for k in range(len(words) - 7):
        at.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {p for ks in at.values() if len(ks) > 1 for k in ks for p in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules_edges(edges, no_docs):
    report = rules.rule_report(edges)
    got = sorted((tuple(r)[:6] for r in report.collect()), key=str)
    assert got == sorted(((i, *brute_counts(t)) for i, t in EDGES), key=str)
    same(report, sql.rules_sql(), edges)
    kept = rules.keep_by_rules(edges)
    assert kept.columns == edges.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in report.collect() if r.kept)
    assert rules.rule_report(no_docs).count() == 0 and rules.keep_by_rules(no_docs).count() == 0


def test_rules_adapt_to_their_group(spark):
    def text(i, marks):
        return prose(i, 100) + " ###" * marks

    rows = [(i, text(i, 12), "en", "tables", 0) for i in range(300)]
    rows += [(1000 + i, text(1000 + i, 0), "en", "plain", 0) for i in range(300)]
    rows += [(5000, text(5000, 12), "en", "plain", 0), (6000, text(1, 12), "fr", "few", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.kept for r in rules.rule_report(docs).collect()}
    assert all(v for k, v in kept.items() if k != 5000)  # usual among tables, odd among plain texts
    assert not kept[5000]
    same(rules.rule_report(docs), sql.rules_sql(), docs)


def test_repeats_and_duplicate_lines_are_judged_by_their_group(spark):
    def repeats(i):  # 24 of 96 words
        return " ".join([prose(i, 12), prose(i + 10**6, 36), prose(i, 12), prose(i + 10**7, 36)])

    def lines(i):  # 3 of 12 lines again
        own = [prose(100 * i + k, 5) for k in range(9)]
        return "\n".join([*own, *own[:8:3]])

    rows = [(i, prose(i, 96), "en", "clean", 0) for i in range(300)]
    rows += [(1000 + i, repeats(1000 + i), "en", "songs", 0) for i in range(300)]
    rows += [(2000 + i, lines(2000 + i), "en", "lists", 0) for i in range(300)]
    rows += [(5000, repeats(5000), "en", "clean", 0), (5001, lines(5001), "en", "clean", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    report = rules.rule_report(docs)
    found = {r.doc_id: r for r in report.collect()}
    assert not any(r.base_failed for r in found.values())
    assert {k for k, r in found.items() if not r.kept} == {5000, 5001}
    same(report, sql.rules_sql(), docs)


def test_rules_use_no_python(edges):
    plan = rules.rule_report(edges)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_licences(spark, edges, no_docs):
    assert [tuple(r)[:3] for r in licences.licence_matches(edges).collect()] == [(11, "MIT/licensed", 1)]
    mit = licences.TEMPLATES["MIT/text"].replace(". ", ".\n")
    pairs = [(1, mit), (2, "x\n" + mit.replace("free of charge", "gratis").replace("\n", " ")), (None, "All rights reserved.")]
    pairs += [(3, "The licence of Licensed under the Apache License"), (4, "released UNDER the mit—license!"), (4, "a")]
    docs = make_docs(spark, pairs)
    found = licences.licence_matches(docs)
    assert {(r.doc_id, r.license_id) for r in found.collect()} == {
        (1, "MIT/text"), (2, "MIT/text"), (None, "reserved"), (4, "MIT/notice"),
    }
    same(found, sql.licences_sql(), docs)
    assert licences.licence_matches(no_docs).count() == 0


def test_licences_inside_longer_texts(spark):
    def wrapped(name, lead=""):
        return "\n".join(lead + x for x in textwrap.wrap(licences.TEMPLATES[name], 70))

    def around(i, text):
        return f"{prose(i, 400)}\n{text}\n{prose(i + 1, 400)}"

    pairs = [(i, around(10 * i, wrapped(name))) for i, name in enumerate(["MIT/text", "GPL-3.0/header", "BSD-2-Clause/text"])]
    pairs += [(3, around(60, wrapped("MIT/text", " * "))), (4, f"{prose(7, 30)} released under the MIT License. {prose(8, 30)}")]
    pairs += [(5, around(70, wrapped("MIT/text") + "\n" + prose(9, 300) + "\n" + wrapped("MIT/text", "rem ")))]
    pairs += [(6, f"Released under the MIT License.\n{prose(1, 30)} released under the MIT license {prose(2, 30)}"), (7, around(80, "all rights"))]
    found = {(r.doc_id, r.license_id): r for r in licences.licence_matches(make_docs(spark, pairs)).collect()}
    for key in ((0, "MIT/text"), (1, "GPL-3.0/header"), (2, "BSD-2-Clause/text"), (3, "MIT/text"), (4, "MIT/notice")):
        assert found[key].n_segments == 1 and found[key].best_dice == 1, key
    assert found[5, "MIT/text"].n_segments == 2 and found[6, "MIT/notice"].n_segments == 2
    assert not any(doc == 7 for doc, _ in found)


def test_line_features_do_not_depend_on_neighbours_in_the_batch():
    bodies = [(t or "").encode() for _, t in EDGES]
    owner, size, own = linecrf.line_features(bodies)
    for i, body in enumerate(bodies):
        _, size_alone, alone = linecrf.line_features([body])
        assert np.array_equal(own[owner == i], alone) and np.array_equal(size[owner == i], size_alone)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(4)
    owner = np.array([0, 0, 0, 0, 1, 2, 2])
    scores, moves = rng.normal(size=7), rng.normal(size=(2, 2))
    got = linecrf.sigmoid(sum(linecrf.chain(owner, scores, moves)))
    for doc in range(3):
        at = np.flatnonzero(owner == doc)
        weight = np.zeros((len(at), 2))
        for code in range(2 ** len(at)):
            y = [code >> k & 1 for k in range(len(at))]
            w = np.exp(sum(s * v for s, v in zip(scores[at], y)) + sum(moves[a, b] for a, b in zip(y, y[1:])))
            for k, v in enumerate(y):
                weight[k, v] += w
        assert np.allclose(got[at], weight[:, 1] / weight.sum(axis=1))


def test_quality_edges(spark, edges, no_docs, edge_labels):
    report = linecrf.quality_report(edges, edge_labels)
    assert report.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = report.collect()
    assert len(rows) == len(EDGES)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert linecrf.keep_good(edges, edge_labels).columns == edges.columns
    none = spark.createDataFrame([], edge_labels.schema)
    assert {r.score for r in linecrf.quality_report(edges, none).collect()} == {0.5}
    assert linecrf.quality_report(no_docs, edge_labels).count() == 0


def test_training_lines_are_bounded(spark, monkeypatch):
    """Documents that do not fit into the bound are passed over, however many rows an id has."""
    known = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5][:12]
    pairs = [(i, f"good words here {i}.\nmore of them {i}.") for i in known]
    pairs += [(known[0], "x\n" * 500)] * 3 + [(known[1], None)]
    labels = spark.createDataFrame([(i, i % 2) for i in known], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(linecrf, "train", lambda owner, n_bytes, own, y: seen.append((len(owner), len(y))))
    for bound in (0, 9, 400, 10_000):
        linecrf.fit_quality(make_docs(spark, pairs), labels, most_lines=bound)
    # two lines a document; the row without a text adds none, and counts as one
    assert seen[0] == (0, 0) and seen[1][0] <= 9 and seen[2] == (22, 12) and seen[3] == (24 + 1500, 16)


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = linecrf.quality_report(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 40
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_pipeline_stages_keep_columns_and_take_effect(spark, edges, no_docs, edge_labels, tmp_path):
    edge_labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [f for f, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "quality_rules", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing",
    ]
    for docs in (edges, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = docs.count()
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    left = {r.doc_id for r in rows}
    assert 0.6 * before < len(left) < before
    assert {"sequence_id", "offset", "ids_crc32"} <= set(rows[0].asDict())


def test_each_notice_is_one_licence(spark):
    """The four notices of the GNU family differ in a word or two: the best match counts alone."""
    names = ["GPL-2.0/notice", "GPL-3.0/notice", "LGPL-3.0/notice", "AGPL-3.0/notice"]
    names = [n for n in names if n in licences.TEMPLATES]
    assert len(names) >= 3
    pairs = [(i, licences.TEMPLATES[n]) for i, n in enumerate(names)]  # lines of their own
    pairs += [(10 + i, f"{prose(i, 30)}\n{licences.TEMPLATES[n]}\n{prose(i + 9, 30)}") for i, n in enumerate(names)]
    for i, n in enumerate(names):  # wrapped over lines, inside other words
        body = licences.TEMPLATES[n].split()
        pairs.append((20 + i, f"{prose(i, 20)} {' '.join(body[:5])}\n{' '.join(body[5:])} {prose(i + 5, 20)}"))
    docs = make_docs(spark, pairs)
    found = sorted((r.doc_id, r.license_id) for r in licences.licence_matches(docs).collect())
    assert found == sorted((at + i, n) for at in (0, 10, 20) for i, n in enumerate(names))
    same(licences.licence_matches(docs.filter("doc_id < 20")), sql.licences_sql(), docs.filter("doc_id < 20"))


def test_licence_scan_reads_once_and_compares_near_documents_only(spark, tmp_path):
    least_hits = "under the MIT License"  # as few of the notice's bigrams as still reach the least Dice
    longest = "Released under the MIT License of"
    pairs = [(1, prose(1, 300)), (2, f"{prose(2, 200)}\n{least_hits}\n{prose(3, 200)}"), (3, f"{longest}\n{prose(4, 90)}")]
    pairs += [(4, f"the MIT {prose(5, 200)} MIT License"), (4, least_hits), (5, f"{prose(6, 50)} all rights reserved")]
    make_docs(spark, pairs).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = licences.licence_matches(docs)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    near = licences._near(docs, licences.TEMPLATES, 0.8)
    assert sorted(r.doc_id for r in near.collect()) == [2, 3, 4, 5]
    ids = sorted((r.doc_id, r.license_id, r.n_segments) for r in found.collect())
    assert ids == [(2, "MIT/licensed", 1), (3, "MIT/notice", 1), (4, "MIT/licensed", 1), (5, "reserved", 1)]
    same(licences.licence_matches(docs.filter("doc_id < 5")), sql.licences_sql(), docs.filter("doc_id < 5"))
