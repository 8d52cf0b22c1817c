"""The queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from quernflow.llm import decontam, html, infill, licenses, mixing, quality, ranking, repeats, sharding, simhash, tokens, toxicity, warc


def queries() -> dict:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_sharding": sharding.op2_sharding,
        "op3_mixing": mixing.op3_mixing,
        "op4_repeats": repeats.op4_repeats,
        "op5_licenses": licenses.op5_licenses,
        "op6_quality": quality.op6_quality,
        "quality_base": quality.quality_base,
        "op7_html": html.op7_html,
        "op8_warc": warc.op8_warc,
        "op9_decontamination": decontam.op9_decontamination,
        "op10_token_counts": tokens.op10_token_counts,
        "op11_toxicity": toxicity.op11_toxicity,
        "op12_search": ranking.op12_search,
        "op13_infill": infill.op13_infill,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_sharding": sharding.ORACLE,
        "op3_mixing": mixing.ORACLE,
        "op5_licenses": licenses.oracle(),
        "quality_base": quality.BASE_ORACLE,
        "op8_warc": warc.ORACLE,
        "op12_search": ranking.ORACLE,
        "op13_infill": infill.ORACLE,
    }
