"""Queries of the text operators, and SQL for those that SQL can express."""

import corpus_pipeline
from riskwindow.llm import (
    bpe,
    capfilter,
    chunkdedup,
    decontam,
    langid,
    linededup,
    phrases,
    pii,
    search,
    simhash,
    tokencount,
    topk,
    warc,
)


def queries() -> dict:
    return {
        "op1_kdtree_topk": topk.op1_kdtree_topk,
        "op2_line_dedup": linededup.op2_line_dedup,
        "op3_language_id": langid.op3_language_id,
        "op4_warc_revisits": warc.op4_warc_revisits,
        "op5_pii": pii.op5_pii,
        "op6_simhash": simhash.op6_simhash,
        "op7_bpe": bpe.op7_bpe,
        "op8_token_counts": tokencount.op8_token_counts,
        "op9_substring_dedup": chunkdedup.op9_substring_dedup,
        "op10_decontamination": decontam.op10_decontamination,
        "op11_collocations": phrases.op11_collocations,
        "op12_cap_filters": capfilter.op12_cap_filters,
        "op13_search": search.op13_search,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    found = {
        "op1_kdtree_topk": topk.ORACLE_SQL,
        "op4_warc_revisits": warc.ORACLE_SQL,
        "op11_collocations": phrases.ORACLE_SQL,
        "op12_cap_filters": capfilter.ORACLE_SQL,
        "op13_search": search.ORACLE_SQL,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: sql for name, sql in found.items() if sql}
