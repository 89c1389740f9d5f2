"""Registered queries of this subpackage and the oracle SQL of those SQL can express."""

from __future__ import annotations

from . import (
    lengths,
    licences,
    linecrf,
    lzprint,
    merkle,
    packing,
    pitman,
    rules,
    simhash,
    sql,
    suffixes,
    tiers,
    unigram,
    whitening,
)
from .common import read_table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark, sf_dir):
    """For every context limit: suffix sums and truncated totals of encoded lengths."""
    return lengths.length_report(read_table(spark, sf_dir, "documents"))


@query
def op8_best_fit_packing(spark, sf_dir):
    """Every piece of every document and its place in a sequence of at most 2048 ids."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


@query
def op10_simhash_components(spark, sf_dir):
    """SimHash of every document and the least id among its linked documents."""
    return simhash.near_duplicate_components(read_table(spark, sf_dir, "documents"))


@query
def op7_quality_classifier(spark, sf_dir):
    """Quality score of every document from a conditional random field over its lines."""
    docs = read_table(spark, sf_dir, "documents")
    return linecrf.quality_report(docs, read_table(spark, sf_dir, "labels"))


@query
def op3_document_fingerprints(spark, sf_dir):
    """Phrase fingerprints of every document and of its edited text."""
    return lzprint.fingerprint_report(read_table(spark, sf_dir, "documents"))


@query
def op1_quality_rules(spark, sf_dir):
    """Counts of every document and the verdict of base rule and adaptive thresholds."""
    return rules.rule_report(read_table(spark, sf_dir, "documents"))


ORACLES["op1_quality_rules"] = sql.rules_sql()


@query
def op6_license_scans(spark, sf_dir):
    """Every licence template found in every document."""
    return licences.licence_matches(read_table(spark, sf_dir, "documents"))


ORACLES["op6_license_scans"] = sql.licences_sql()


@query
def op5_sentencepiece(spark, sf_dir):
    """Unigram pieces of every document: counts, score, checksums and decoding."""
    return unigram.encode_documents(read_table(spark, sf_dir, "documents"))


@query
def op2_suffix_array_dedup(spark, sf_dir):
    """Bytes of every document covered by 100-byte strings that also start earlier."""
    return suffixes.removal_report(read_table(spark, sf_dir, "documents"))


@query
def op9_lm_scoring(spark, sf_dir):
    """Score of every document under a hierarchical Pitman-Yor model of the corpus."""
    return pitman.score_report(read_table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark, sf_dir):
    """Leaf, roots and proof of every document, and the root folded from its tampered form."""
    return merkle.proof_report(read_table(spark, sf_dir, "documents"))


ORACLES["op13_merkle_manifest"] = sql.merkle_sql()


@query
def op12_embedding_whitening(spark, sf_dir):
    """Sixteen whitened components of every vector, from a bidiagonalisation."""
    return whitening.whitening_report(read_table(spark, sf_dir, "embeddings"))


@query
def op11_tier_packing(spark, sf_dir):
    """Every piece of every document and its place in a window of one of several lengths."""
    return tiers.placement_report(read_table(spark, sf_dir, "documents"))
