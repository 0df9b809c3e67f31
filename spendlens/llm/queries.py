"""Queries of the operators: one per operator over its whole table, with the
DuckDB text where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, chat, collocations, hostrules, imatch, lattice, maintext, pu, raking, rollup, simhash, spm, tokenbin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_imatch_fingerprints": imatch.query,
    "op2_chat_format": chat.query,
    "op3_token_rollup": rollup.query,
    "op4_raked_mix": raking.query,
    "op5_sentencepiece": spm.query,
    "op6_host_rules": hostrules.query,
    "op7_simhash_gray": simhash.query,
    "op8_lattice_lm": lattice.query,
    "op9_pu_quality": pu.query,
    "op10_token_files": tokenbin.query,
    "op11_token_alignment": alignment.query,
    "op12_main_text": maintext.query,
    "op13_phrase_stripes": collocations.query,
}
ORACLE: dict[str, str] = {
    "op2_chat_format": chat.SQL,
    "op3_token_rollup": rollup.SQL,
    "op6_host_rules": hostrules.SQL,
    "op13_phrase_stripes": collocations.SQL,
}
