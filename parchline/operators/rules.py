"""Layered rules: an ordered override list over per-key defaults.

Rule lists are written by people and read once by the driver. They enter the plan as literals, so
resolving them is a narrow expression: no join, no shuffle, and nothing that grows with the data.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

CHUNK_METHODS_WITH_SIZE = ("fixed_size_with_overlap", "recursive_structure_aware", "heading_hierarchy_split", "semantic_split")

# The platform's default rules.
EXTRACTION_RULES: dict[str, Any] = {
    "extraction": {
        "defaults": {
            "pdf": "pymupdf_standard",
            "docx": "python_docx_standard",
            "xlsx": "openpyxl_standard",
            "text": "plain_text_decode",
        },
        "overrides": [
            {
                "path_prefix": "contracts_scanned/",
                "file_type": "pdf",
                "method": "azure_document_intelligence_ocr",
                "on_failure": "atomic",
            },
            {
                "path_prefix": "reports_digital/",
                "file_type": "pdf",
                "method": "pymupdf_standard",
                "on_failure": "atomic",
            },
        ],
    }
}
CHUNKING_RULES: dict[str, Any] = {
    "chunking": {
        "defaults": {
            "pdf": {"method": "recursive_structure_aware", "chunk_size": 512, "overlap": 50},
            "docx": {"method": "heading_hierarchy_split", "chunk_size": 512, "overlap": 50},
            "xlsx": {"method": "table_aware_row_based", "chunk_size": None, "overlap": None},
            "text": {"method": "fixed_size_with_overlap", "chunk_size": 512, "overlap": 50},
        },
        "overrides": [
            {
                "extraction_method_used": "azure_document_intelligence_ocr",
                "method": "semantic_split",
                "chunk_size": 256,
                "overlap": 25,
            }
        ],
    }
}
RETRIEVAL_RULES: dict[str, Any] = {
    "retrieval": {
        "defaults": {
            "query_type": "hybrid",
            "retrieval_top_k": 20,
            "final_top_k": 5,
            "rerank": True,
            "query_rewrite": True,
        },
        "overrides": [
            {"endpoint_name": "quick-lookup-bot", "final_top_k": 3, "query_rewrite": False},
            {"endpoint_name": "deep-research-tool", "retrieval_top_k": 50, "final_top_k": 10},
        ],
    }
}


def load_rules(path: str) -> dict[str, Any]:
    """Read a rule file on the driver: ``.json`` as JSON, any other as YAML, which needs the package PyYAML."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            return json.load(handle)
        try:
            import yaml
        except ImportError as missing:
            raise ImportError(f"{path}: YAML rules need the package PyYAML; JSON rules (.json) do not") from missing
        return yaml.safe_load(handle)


def _section(config: dict[str, Any], name: str) -> tuple[dict, list]:
    body = config.get(name) or {}
    return body.get("defaults") or {}, body.get("overrides") or []


def check_chunking(config: dict[str, Any]) -> None:
    """Refuse sizes that could only fail once a long text arrives."""
    defaults, overrides = _section(config, "chunking")
    for rule in [*defaults.values(), *overrides]:
        if rule["method"] not in CHUNK_METHODS_WITH_SIZE:
            continue
        size, overlap = rule.get("chunk_size"), rule.get("overlap")
        if not size or overlap is None or not 0 <= overlap < size:
            raise ValueError(f"{rule['method']}: needs chunk_size > overlap >= 0, has {size} and {overlap}")


def _first_match(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first rule whose condition holds."""
    for condition, value in reversed(rules):
        otherwise = F.when(condition, value).otherwise(otherwise)
    return otherwise


def in_folder(path: Column, name: str | None) -> Column:
    """Does the path run through this folder (one or several names)? No folder named: any path does."""
    names = [part for part in (name or "").split("/") if part]
    return path.contains("/".join(["", *names, ""])) if names else path.isNotNull()


def _extraction_decision(method: str | None, on_failure: str | None, matched: str) -> Column:
    return F.struct(
        F.lit(method).cast("string").alias("method"),
        F.lit(on_failure).cast("string").alias("on_failure"),
        F.lit(matched).alias("matched_rule"),
    )


def extraction_decision(path: Column, file_type: Column, config: dict[str, Any]) -> Column:
    """``struct<method, on_failure, matched_rule>`` for one file."""
    defaults, overrides = _section(config, "extraction")
    rules = [
        (
            (file_type == F.lit(rule.get("file_type"))) & in_folder(path, rule.get("path_prefix")),
            _extraction_decision(rule["method"], rule.get("on_failure", "atomic"), "override"),
        )
        for rule in overrides
    ] + [
        (file_type == F.lit(kind), _extraction_decision(method, "atomic", "default"))
        for kind, method in defaults.items()
    ]
    return _first_match(rules, _extraction_decision(None, None, "none"))


def _chunking_decision(rule: dict[str, Any], matched: str) -> Column:
    return F.struct(
        F.lit(rule.get("method")).cast("string").alias("method"),
        F.lit(rule.get("chunk_size")).cast("int").alias("chunk_size"),
        F.lit(rule.get("overlap")).cast("int").alias("overlap"),
        F.lit(matched).alias("matched_rule"),
    )


def chunking_decision(file_type: Column, extraction_method: Column, config: dict[str, Any]) -> Column:
    """``struct<method, chunk_size, overlap, matched_rule>`` for one content."""
    check_chunking(config)
    defaults, overrides = _section(config, "chunking")
    rules = [
        (
            extraction_method.eqNullSafe(F.lit(rule.get("extraction_method_used"))),
            _chunking_decision(rule, "override"),
        )
        for rule in overrides
    ] + [(file_type == F.lit(kind), _chunking_decision(rule, "default")) for kind, rule in defaults.items()]
    return _first_match(rules, _chunking_decision({}, "none"))


def resolve_extraction(files: DataFrame, config: dict[str, Any] = EXTRACTION_RULES) -> DataFrame:
    decision = extraction_decision(F.col("source_path"), F.col("file_type"), config)
    return files.withColumn("decision", decision).select(
        *files.columns,
        F.col("decision.method").alias("extraction_method"),
        F.col("decision.on_failure").alias("on_failure"),
        F.col("decision.matched_rule").alias("matched_rule"),
    )


def resolve_chunking(extracted: DataFrame, config: dict[str, Any] = CHUNKING_RULES) -> DataFrame:
    decision = chunking_decision(F.col("file_type"), F.col("extraction_method_used"), config)
    return extracted.withColumn("decision", decision).select(
        *extracted.columns,
        F.col("decision.method").alias("chunking_method"),
        F.col("decision.chunk_size").alias("chunk_size"),
        F.col("decision.overlap").alias("overlap"),
        F.col("decision.matched_rule").alias("matched_rule"),
    )


def resolve_retrieval(
    requests: DataFrame, config: dict[str, Any] = RETRIEVAL_RULES, endpoint: str = "endpoint_name"
) -> DataFrame:
    """Settings per request: each field the endpoint's override names replaces the default."""
    defaults, overrides = _section(config, "retrieval")

    def setting(field: str, default: Any) -> Column:
        rules = [
            (F.col(endpoint) == F.lit(rule["endpoint_name"]), F.lit(rule[field]))
            for rule in overrides
            if field in rule
        ]
        return _first_match(rules, F.lit(default)).alias(field)

    return requests.select("*", *[setting(field, value) for field, value in defaults.items()])
