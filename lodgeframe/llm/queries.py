"""Queries over the operators, and their SQL where SQL can express them."""
from __future__ import annotations

from lodgeframe.llm import (anchor_lists, bitslice, impact_treap, jaccard_join, kneser_ney, langid, line_quality, mixing,
                            packing, pii, recompression, token_files, toxicity)
from lodgeframe.llm.staging import read_table


def op1_toxicity(spark, sf_dir):
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_kneser_ney(spark, sf_dir):
    return kneser_ney.score(read_table(spark, sf_dir, "documents"), order=kneser_ney.ORDER)


def op3_line_quality(spark, sf_dir):
    return line_quality.digest(line_quality.judge(read_table(spark, sf_dir, "documents")))


def op4_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op5_personal_data(spark, sf_dir):
    return pii.find(read_table(spark, sf_dir, "documents"))


def op6_language_crf(spark, sf_dir):
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op7_source_mixing(spark, sf_dir):
    return mixing.digest(mixing.mix_plan(read_table(spark, sf_dir, "documents")))


def op8_parity_sketch_join(spark, sf_dir):
    return jaccard_join.classes(read_table(spark, sf_dir, "documents"), k=4, percent=85)


def op9_bit_sliced_search(spark, sf_dir):
    return bitslice.top_k(read_table(spark, sf_dir, "embeddings"))


def op10_recompression(spark, sf_dir):
    return recompression.remove_repeats(read_table(spark, sf_dir, "documents"))


def op11_ranked_token_files(spark, sf_dir):
    return token_files.round_trip(read_table(spark, sf_dir, "documents"))


def op12_impact_treap(spark, sf_dir):
    return impact_treap.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark, sf_dir):
    return anchor_lists.hard_negatives(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_kneser_ney, op3_line_quality, op4_best_fit_packing, op5_personal_data, op6_language_crf,
    op7_source_mixing, op8_parity_sketch_join, op9_bit_sliced_search, op10_recompression, op11_ranked_token_files,
    op12_impact_treap, op13_hard_negatives)}
ORACLE = {"op3_line_quality": line_quality.DIGEST_SQL, "op7_source_mixing": mixing.DIGEST_SQL,
          "op9_bit_sliced_search": bitslice.DIGEST_SQL, "op10_recompression": recompression.DIGEST_SQL,
          "op12_impact_treap": impact_treap.DIGEST_SQL, "op13_hard_negatives": anchor_lists.DIGEST_SQL}
