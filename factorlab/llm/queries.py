"""Queries of the training-data operators and their DuckDB forms."""

from __future__ import annotations

from factorlab.llm import ann, chat, decontaminate, fim, langid, linededup, mixing, packing, pii, quality, resample, simhash, warc

QUERIES = {
    "op1_template_decontamination": decontaminate.query,
    "op2_compression_langid": langid.query,
    "op3_column_generation": packing.query,
    "op4_simhash_trie": simhash.query,
    "op5_reply_trees": chat.query,
    "op6_kmeans_tree": ann.query,
    "op7_keyed_surrogates": pii.query,
    "op8_deletion_neighbourhood": linededup.query,
    "op9_splittable_warc": warc.query,
    "op10_empirical_bayes": quality.query,
    "op11_sparse_index_fim": fim.query,
    "op12_sainte_lague_mix": mixing.query,
    "op13_position_crc_resample": resample.query,
}

#: The others have no SQL form as a whole (compression, tokenizers, linear programs, archives...); see tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op5_reply_trees": chat.ORACLE,
    "op9_splittable_warc": warc.ORACLE,
    "op11_sparse_index_fim": fim.ORACLE,
    "op12_sainte_lague_mix": mixing.ORACLE,
    "op13_position_crc_resample": resample.ORACLE,
}
