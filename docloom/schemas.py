"""Row schemas of the tables that operators exchange."""

from __future__ import annotations

#: A parsed document before enrichment.
PARSED = "path string, text string, summary string, tags array<string>, source string, subject string, ocr boolean"

#: A line of the corpus in JSON.
CORPUS = (
    "text string, summary string, tags array<string>, source string, subject string, ocr boolean, size_bytes bigint, "
    "created_ts double, modified_ts double, language string, token_estimate int, hash_sha1 string, pii_risk double, "
    "category string, hash_content string, is_duplicate boolean, size_bytes_text bigint, line_count int, "
    "requires_split boolean"
)

#: A point of the vector store: two named vectors and what search returns.
PAYLOAD = (
    "text: string, source: string, hash_content: string, category: string, language: string, summary: string, "
    "tags: array<string>, created_ts: double, modified_ts: double, size_bytes: bigint, token_estimate: int, "
    "pii_risk: double, is_duplicate: boolean"
)
POINT = f"id string, body array<float>, summary_vec array<float>, payload struct<{PAYLOAD}>"

RESULT = (
    "id string, score double, original_score double, text string, summary string, tags array<string>, category string, "
    "source string, was_boosted boolean, boost_factor double, matched_tags array<string>"
)

#: Metadata as a language model returns it; keys are those of its prompt.
LLM_METADATA = "cesta_k_suboru string, nazov_suboru string, typ_suboru string, tagy array<string>, sumar string"

INVENTORY = "path string, suffix string, size_bytes bigint, modified string, error string"
DEAD_LETTER = "path string, stage string, error string"
