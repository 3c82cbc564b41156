"""The registered queries of this subpackage: name -> (query, SQL or None)."""

from __future__ import annotations

import functools

from ..session import ship_package
from . import bitslices, bpe, classifier, collocations, exact, html, infill, jaccard, lines, packing, quality, shards, substrings


def _documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def _labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


def vocabulary():
    """The public tokenizer file that the queries use; a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark, sf):
    return substrings.substring_query(_documents(spark, sf))


def op2_html_extraction(spark, sf):
    return html.main_text(spark.read.parquet(f"{sf}/pages.parquet"))


def op3_training_shards(spark, sf):
    return shards.training_order(spark, _documents(spark, sf), vocabulary())


def op4_best_fit_packing(spark, sf):
    return packing.pack_documents(_documents(spark, sf), vocabulary())


def op7_bpe_automaton(spark, sf):
    return bpe.encode_decode(_documents(spark, sf), vocabulary())


def op5_jaccard_join(spark, sf):
    return jaccard.jaccard_components(_documents(spark, sf))


def op6_quality_classifier(spark, sf):
    return classifier.quality_scores(_documents(spark, sf), _labels(spark, sf))


def op8_line_dedup(spark, sf):
    return lines.line_query(_documents(spark, sf))


def op9_quality_rules(spark, sf):
    return quality.quality_rules(_documents(spark, sf), _labels(spark, sf))


def op10_exact_dedup(spark, sf):
    return exact.exact_dedup(_documents(spark, sf))


def op11_fill_in_middle(spark, sf):
    return infill.fill_query(_documents(spark, sf))


def op12_collocations(spark, sf):
    return collocations.collocations(_documents(spark, sf))


def op13_topk_search(spark, sf):
    return bitslices.topk_search(spark.read.parquet(f"{sf}/embeddings.parquet"))


def _shipped(query):
    """The workers may run in another folder than the driver and still need the package."""
    @functools.wraps(query)
    def run(spark, sf):
        ship_package(spark)
        return query(spark, sf)
    return run


_ALL = {
    "op1_substring_dedup": (op1_substring_dedup, None),
    "op2_html_extraction": (op2_html_extraction, None),
    "op3_training_shards": (op3_training_shards, None),
    "op4_best_fit_packing": (op4_best_fit_packing, None),
    "op7_bpe_automaton": (op7_bpe_automaton, None),
    "op5_jaccard_join": (op5_jaccard_join, None),
    "op6_quality_classifier": (op6_quality_classifier, None),
    "op8_line_dedup": (op8_line_dedup, lines.SQL),
    "op9_quality_rules": (op9_quality_rules, None),
    "op10_exact_dedup": (op10_exact_dedup, exact.SQL),
    "op11_fill_in_middle": (op11_fill_in_middle, infill.SQL),
    "op12_collocations": (op12_collocations, collocations.SQL),
    "op13_topk_search": (op13_topk_search, bitslices.SQL),
}

QUERIES = {name: (_shipped(query), sql) for name, (query, sql) in _ALL.items()}
