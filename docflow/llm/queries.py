"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import (
    bpe,
    bucket_refinement,
    chat_format,
    decontaminate,
    dimension_lloyd,
    fp_tree,
    lattice,
    line_blocks,
    line_frequency,
    paragraphs,
    partenum,
    probminhash,
    site_quality,
)

QUERIES = {
    "op1_line_frequency": line_frequency.op1_line_frequency,
    "op2_line_blocks": line_blocks.op2_line_blocks,
    "op3_paragraph_minhash": paragraphs.op3_paragraph_minhash,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_bucket_refinement": bucket_refinement.op5_bucket_refinement,
    "op6_subword_lattice": lattice.op6_subword_lattice,
    "op7_pair_index_bpe": bpe.op7_pair_index_bpe,
    "op8_site_quality": site_quality.op8_site_quality,
    "op9_probminhash": probminhash.op9_probminhash,
    "op10_incremental_chat": chat_format.op10_incremental_chat,
    "op11_partenum": partenum.op11_partenum,
    "op12_dimension_lloyd": dimension_lloyd.op12_dimension_lloyd,
    "op13_fp_tree": fp_tree.op13_fp_tree,
}

ORACLE = {
    "op1_line_frequency": line_frequency.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op11_partenum": partenum.ORACLE,
    "op12_dimension_lloyd": dimension_lloyd.ORACLE,
    "op13_fp_tree": fp_tree.ORACLE,
}
