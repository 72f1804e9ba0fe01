"""The queries of this package over the test tables, and what SQL can say of them."""

from tidelog.llm import conversations, language, line_dedup, mixing, near_dedup, packing, phrases, quality, search, substring_dedup, suffix_dedup, url_templates, warc

QUERIES = {
    "op1_warc_reassembly": warc.op1_warc_reassembly,
    "op2_url_templates": url_templates.op2_url_templates,
    "op3_source_mix": mixing.op3_source_mix,
    "op4_bag_minhash": near_dedup.op4_bag_minhash,
    "op5_packing": packing.op5_packing,
    "op6_quality_cascade": quality.op6_quality_cascade,
    "op7_bm25_search": search.op7_bm25_search,
    "op8_language_mixture": language.op8_language_mixture,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_collocations": phrases.op11_collocations,
    "op12_suffix_dedup": suffix_dedup.op12_suffix_dedup,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}

ORACLE = {
    "op1_warc_reassembly": warc.OP1_SQL,
    "op2_url_templates": url_templates.OP2_SQL,
    "op6_quality_cascade": quality.OP6_SQL,
    "op9_substring_dedup": substring_dedup.OP9_SQL,
    "op10_line_dedup": line_dedup.OP10_SQL,
    "op11_collocations": phrases.OP11_SQL,
    "op12_suffix_dedup": suffix_dedup.OP12_SQL,
    "op13_conversation_repair": conversations.OP13_SQL,
}
