import collections
import zlib

import pytest

from tabwright.llm import merkle
from tabwright.llm.merkle import sha

from .conftest import make_docs, prose


def parents(nodes):
    return [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]


def tree_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(parents(levels[-1]))
    return levels


def postorder(levels):
    """The log by plain recursion, as (level, node)."""
    out = []

    def visit(level, node):
        if level:
            for child in range(8 * node, min(8 * node + 8, len(levels[level - 1]))):
                visit(level - 1, child)
        out.append((level, node))

    visit(len(levels) - 1, 0)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 73, 511, 512])
def test_log_of_a_block_is_the_postorder(n):
    leaves = [sha(str(i)) for i in range(n)]
    levels = tree_levels(leaves)
    order = postorder(levels)
    assert merkle.append_log(leaves, merkle.height(n)) == [levels[a][i] for a, i in order]
    assert [merkle.position(a, i, n) for a, i in order] == list(range(len(order)))


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def expected(rows):
    """(doc_id, leaf, subroot, root, proof, folded) by plain recursion over whole trees."""
    trees = collections.defaultdict(list)
    for r in rows:
        body = [field(r[c]) for c in ("doc_id", "source", "lang", "n_chars")]
        leaf = sha("".join(body) + field(r["text"]))
        text, altered = r["text"], leaf
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            altered = sha("".join(body) + field(low))
        trees[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, r["doc_id"], altered))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda t: t[:3])
        built[lang] = tree_levels([t[2] for t in trees[lang]])
    top = tree_levels([built[lang][-1][0] for lang in order])
    out = []
    for place, lang in enumerate(order):
        for j, (_, _, leaf, doc_id, altered) in enumerate(trees[lang]):
            siblings, cur = [], altered
            for levels, at in ((built[lang], j), (top, place)):
                for nodes in levels[:-1]:
                    first = at // 8 * 8
                    run = nodes[first : first + 8]
                    siblings += run[: at - first] + run[at - first + 1 :]
                    cur = sha("".join(run[: at - first]) + cur + "".join(run[at - first + 1 :]))
                    at //= 8
            root = top[-1][0]
            out.append((doc_id, leaf, built[lang][-1][0], root, sha("".join(siblings)), cur, cur == root))
    return sorted(out, key=str)


def as_dicts(df):
    return [r.asDict() for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_proofs_of_edge_rows(edges, no_docs):
    got = sorted(map(tuple, merkle.proof_report(edges).collect()), key=str)
    assert got == expected(as_dicts(edges))
    assert merkle.proof_report(no_docs).count() == 0
    assert merkle.manifest_log(no_docs).count() == 0


def test_proofs_over_several_tiers(spark, monkeypatch):
    """Blocks of 8 leaves instead of 512, so that 700 rows need four tiers."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [
        (i, None if i % 50 == 3 else f"{prose(i, 3)} Upper", "a" if i < 513 else ("b", "é", None)[i % 3], "s", i)
        for i in range(700)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.repartition(7)
    got = sorted(map(tuple, merkle.proof_report(docs).collect()), key=str)
    assert got == expected(as_dicts(docs))
    by_tree = collections.defaultdict(list)
    for r in merkle.manifest_log(docs).collect():
        by_tree[r.tree].append((r.position, r.level, r.node, r.digest))
    assert len(by_tree) == 4
    leaves = collections.defaultdict(list)
    for lang, group in by_tree.items():
        group.sort()
        width = sum(1 for _, level, _, _ in group if level == 0)
        levels = tree_levels([d for _, level, _, d in group if level == 0])
        order = postorder(levels)
        assert [(p, a, n) for p, a, n, _ in group] == [(p, a, n) for p, (a, n) in enumerate(order)]
        assert [d for *_, d in group] == [levels[a][n] for a, n in order]
        leaves[lang] = width
    assert sum(leaves.values()) == 700


def test_one_row_is_its_own_root(spark):
    row = merkle.proof_report(make_docs(spark, [(5, "abc")])).first()
    assert row.leaf == row.subroot == row.root
    assert row.proof_sha256 == sha("")
