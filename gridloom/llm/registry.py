"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from gridloom.llm import collocations, conversations, language, maxscore, mixing, ngram_join, order_minhash, page_text, pieces, secrets_scan, substring_dedup, surrogates, warc

QUERIES = {
    "op1_surrogates": surrogates.op1_surrogates,
    "op2_ngram_jaccard": ngram_join.op2_ngram_jaccard,
    "op3_language_id": language.op3_language_id,
    "op4_secrets": secrets_scan.op4_secrets,
    "op5_maxscore": maxscore.op5_maxscore,
    "op6_order_minhash": order_minhash.op6_order_minhash,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_mixing": mixing.op8_mixing,
    "op9_warc": warc.op9_warc,
    "op10_pieces": pieces.op10_pieces,
    "op11_page_text": page_text.op11_page_text,
    "op12_conversations": conversations.op12_conversations,
    "op13_collocations": collocations.op13_collocations,
}
SQL = {
    "op2_ngram_jaccard": ngram_join.SQL,
    "op5_maxscore": maxscore.SQL,
    "op7_substring_dedup": substring_dedup.SQL,
    "op8_mixing": mixing.SQL,
    "op9_warc": warc.SQL,
    "op12_conversations": conversations.SQL,
    "op13_collocations": collocations.SQL,
}
