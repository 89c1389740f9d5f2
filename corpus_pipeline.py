"""Cleaning and packing a corpus: stages over the table of documents, each written and reread."""

from __future__ import annotations

from tabwright.llm.linecrf import keep_good
from tabwright.llm.packing import pack_documents
from tabwright.llm.rules import keep_by_rules
from tabwright.llm.simhash import keep_one_of_each
from tabwright.llm.suffixes import remove_repeats
from tabwright.session import scratch_path


def good_documents(spark, docs, sf_dir):
    """Documents that the line classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def within_rules(spark, docs, sf_dir):
    """Documents outside the adaptive thresholds of their language and source go."""
    return keep_by_rules(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of SimHash near-duplicates stays."""
    return keep_one_of_each(docs)


def without_repeats(spark, docs, sf_dir):
    """Byte strings that also start earlier are cut out of the texts."""
    return remove_repeats(docs)


def sequences(spark, docs, sf_dir):
    """Every piece of every document and its place in a training sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("quality_rules", within_rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", without_repeats),
    ("best_fit_packing", sequences),
]

#: Encoding and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after the other, each result written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return out
        path = scratch_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
