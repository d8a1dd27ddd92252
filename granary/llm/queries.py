"""Registered queries of this folder and their DuckDB SQL where SQL can express them."""

from granary.llm import langid, mixing, packing, quality_rules, simhash, suffix_dedup, topk, toxicity, url_filter, warc

QUERIES = {
    "op1_simhash": simhash.query,
    "op2_warc": warc.query,
    "op3_quality_rules": quality_rules.query,
    "op4_packing": packing.query,
    "op5_topk": topk.query,
    "op6_langid": langid.query,
    "op7_toxicity": toxicity.query,
    "op8_suffix_dedup": suffix_dedup.query,
    "op9_url_filter": url_filter.query,
    "op10_mixing": mixing.query,
}

ORACLE_SQL = {
    "op2_warc": warc.SQL,
    "op3_quality_rules": quality_rules.SQL,
    "op5_topk": topk.SQL,
    "op8_suffix_dedup": suffix_dedup.SQL,
    "op9_url_filter": url_filter.SQL,
}
