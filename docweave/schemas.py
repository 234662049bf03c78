"""Record types as Spark schemas in DDL. NULL, empty and zero keep their own meanings throughout."""

from __future__ import annotations

SCHEMA_VERSION = "1.0"
ROUTES = ("textract", "bedrock")
STATUSES = ("PROCESSING", "COMPLETED", "REVIEW_PENDING", "FAILED")
CONFIDENCE_FIELDS = ("title", "authors", "abstract", "sections", "figures", "tables", "references")

AUTHOR = "STRUCT<name: STRING, affiliation: STRING, email: STRING>"
SECTION = "STRUCT<level: INT, heading: STRING, text: STRING, pages: ARRAY<INT>>"
FIGURE = "STRUCT<id: STRING, caption: STRING, page: INT, bbox: ARRAY<DOUBLE>>"
TABLE = "STRUCT<id: STRING, caption: STRING, page: INT, bbox: ARRAY<DOUBLE>, header: ARRAY<ARRAY<STRING>>, rows: ARRAY<ARRAY<STRING>>>"
REFERENCE = "STRUCT<raw: STRING, title: STRING, authors: ARRAY<STRING>, year: INT, venue: STRING, doi: STRING>"
METADATA = f"STRUCT<title: STRING, authors: ARRAY<{AUTHOR}>, abstract: STRING, keywords: ARRAY<STRING>, venue: STRING, year: INT, primary_category: STRING>"
CONFIDENCE = "STRUCT<" + ", ".join(f"`{f}`: DOUBLE" for f in CONFIDENCE_FIELDS) + ">"
COST = "STRUCT<textract_pages: INT, textract_features: ARRAY<STRING>, bedrock_model: STRING, input_tokens: INT, output_tokens: INT>"
PROVENANCE = f"STRUCT<route: STRING, extracted_at: TIMESTAMP, confidence: {CONFIDENCE}, cost: {COST}, duration_ms: BIGINT, warnings: ARRAY<STRING>>"
SOURCE = "STRUCT<bucket: STRING, key: STRING, filename: STRING, sha256: STRING, language: STRING, page_count: INT, has_text_layer: BOOLEAN, uploaded_at: TIMESTAMP>"

DOCUMENT = (
    f"job_id STRING, schema_version STRING, source {SOURCE}, metadata {METADATA}, sections ARRAY<{SECTION}>, figures ARRAY<{FIGURE}>, "
    f"tables ARRAY<{TABLE}>, references ARRAY<{REFERENCE}>, provenance {PROVENANCE}"
)
BLOCKS = (
    "job STRING, ord INT, id STRING, block_type STRING, page INT, text STRING, confidence FLOAT, left FLOAT, top FLOAT, width FLOAT, height FLOAT, "
    "row_index INT, column_index INT, row_span INT, column_span INT, entity_types ARRAY<STRING>, selection_status STRING"
)
BLOCK_EDGES = "job STRING, parent STRING, child STRING, rel_type STRING, pos INT"
PAGE_RESULTS = (
    f"job STRING, page INT, arrival INT, title STRING, abstract STRING, authors ARRAY<{AUTHOR}>, keywords ARRAY<STRING>, "
    "sections ARRAY<STRUCT<level: INT, heading: STRING, text: STRING>>, figures ARRAY<STRUCT<label: STRING, caption: STRING>>, "
    "tables ARRAY<STRUCT<label: STRING, caption: STRING, header: ARRAY<ARRAY<STRING>>, rows: ARRAY<ARRAY<STRING>>>>, "
    f"references ARRAY<{REFERENCE}>, cont_section BOOLEAN, cont_reference BOOLEAN, model STRING, input_tokens INT, output_tokens INT, extracted_at TIMESTAMP, duration_ms BIGINT"
)
JOBS = "job STRING, status STRING, filename STRING, created_at TIMESTAMP, updated_at TIMESTAMP, error_reason STRING"
WORKS = "doi STRING, title STRING"
PAPERS = "arxiv_id STRING, version STRING, title STRING, categories ARRAY<STRING>, published TIMESTAMP, pages INT, references INT, has_source BOOLEAN, license STRING, license_kind STRING, file STRING, sha256 STRING, fetched_at TIMESTAMP"
