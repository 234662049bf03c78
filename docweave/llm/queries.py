"""Queries of the training-data operators, by name, and their SQL twins."""

from __future__ import annotations

from . import collocations, conversations, decontaminate, html_extract, jaccard_join, language_id, licences, pii, quality_classifier, quality_rules, substring_dedup
from .piece_codec import op3_sentencepiece
from .token_counts import op6_token_counts

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_licence_scan": licences.op2_licence_scan,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_token_counts": op6_token_counts,
    "op7_html_extraction": html_extract.op7_html_extraction,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_quality_classifier": quality_classifier.op9_quality_classifier,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_language_id": language_id.op12_language_id,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES: dict[str, str] = {"op5_quality_rules": quality_rules.ORACLE_SQL, "op2_licence_scan": licences.ORACLE_SQL, "op11_conversation_repair": conversations.ORACLE_SQL, "op13_collocations": collocations.ORACLE_SQL}
ORACLES |= {"op4_jaccard_join": jaccard_join.ORACLE_SQL, "op8_substring_dedup": substring_dedup.ORACLE_SQL, "op10_decontamination": decontaminate.ORACLE_SQL}


def pipeline(spark, sf_dir):
    """All stages of corpus_pipeline, which stands beside the package."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {**QUERIES, "pipeline": pipeline}


def oracle_sql():
    return dict(ORACLES)
