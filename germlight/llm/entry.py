"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from germlight.llm import decontaminate, fingerprints, html_text, language_id, license_scan, packed_ids, prefix_bpe, quality_classifier, quality_rules, ranked_search, simhash, warc


def queries() -> dict:
    return {
        "op1_license_scan": license_scan.op1_license_scan,
        "op2_quality_rules": quality_rules.op2_quality_rules,
        "op3_quality_classifier": quality_classifier.op3_quality_classifier,
        "op4_simhash": simhash.op4_simhash,
        "op5_language_id": language_id.op5_language_id,
        "op6_html_text": html_text.op6_html_text,
        "op7_packed_ids": packed_ids.op7_packed_ids,
        "op8_decontaminate": decontaminate.op8_decontaminate,
        "op9_warc": warc.op9_warc,
        "op10_prefix_bpe": prefix_bpe.op10_prefix_bpe,
        "op11_block_max": ranked_search.op11_block_max,
        "op12_multiset_hash": fingerprints.op12_multiset_hash,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality_rules.SQL, "op8_decontaminate": decontaminate.SQL, "op9_warc": warc.SQL, "op11_block_max": ranked_search.SQL}
