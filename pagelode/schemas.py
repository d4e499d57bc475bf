"""Fixed schemas of the pipeline's tables; readers never infer."""

from __future__ import annotations

_REFS = "array<struct<page:int,block_id:string,method:string,bbox:array<double>,page_height:double>>"
_RUN = "trace_id string, stage_name string, stage_run_id string"

PAGE_BLOCKS = (
    f"{_RUN}, document_id string, page int, block_id string, block_type string, bbox struct<x0:double,y0:double,x1:double,y1:double>, "
    f"raw_text string, extraction_method string, confidence_score double, source_refs {_REFS}, "
    "multi_page_bboxes array<struct<page:int,bbox:array<double>>>, cross_page_continuation boolean, "
    "relationships array<struct<type:string,target:string>>"
)
INSTRUCTION_CATALOG = (
    f"{_RUN}, document_id string, instruction_name string, variation string, aliases array<string>, opcode_raw string, opcode_radix string, "
    f"opcode_value bigint, execution_unit string, instruction_kind string, instruction_kind_confidence double, confidence_score double, source_refs {_REFS}"
)
FIELD_MAP = (
    f"{_RUN}, document_id string, instruction_name string, variation string, field_name string, bit_range string, word_index int, "
    f"confidence_score double, source_refs {_REFS}, uncertain boolean"
)
DATATYPE_REGISTRY = (
    "trace_id string, type_id string, type_name_raw string, type_name_normalized string, category string, description string, "
    f"value_constraint_summary string, value_generation_method string, source_refs {_REFS}"
)
FIELD_DATATYPES = (
    f"trace_id string, document_id string, instruction_name string, variation string, field_name string, data_type_raw string, data_type_ref string, source_refs {_REFS}"
)
FIELD_DOMAINS = (
    "trace_id string, document_id string, instruction_name string, variation string, field_name string, allowed_value_form string, "
    f"allowed_values_or_range string, source_refs {_REFS}"
)
_DOMAIN_META = (
    "struct<allowed_value_form:string,domain_value_unspecified:boolean,"
    "structured_domain:struct<form:string,values:array<string>,lo_raw:string,hi_raw:string,raw:string>>"
)
CONSTRAINTS = (
    "trace_id string, constraint_id string, constraint_type_level1 string, constraint_type_level2 string, expression string, "
    f"classification_rationale string, source_refs {_REFS}, applies_to struct<entity_type:string,entity_name:string>, "
    f"domain_constraint_meta {_DOMAIN_META}, verbatim_sentence string"
)
NODES = "id string, type string, props string, pos bigint"
EDGES = "`from` string, rel string, `to` string"
RUN_MANIFEST = "stage_name string, stage_run_id string, started_at timestamp, ended_at timestamp"

#: Required columns, allowed values and bounds per table, for the contract check.
CONTRACTS: dict[str, dict] = {
    "page_blocks": {
        "required": ["trace_id", "document_id", "page", "block_id", "block_type", "raw_text", "extraction_method"],
        "choices": {"block_type": ["text", "table", "image", "equation"]},
        "bounds": {"page": (1, None), "confidence_score": (0, 1)},
    },
    "instruction_catalog": {
        "required": ["trace_id", "instruction_name", "opcode_raw", "execution_unit"],
        "choices": {"opcode_radix": ["hex", "dec", "unknown"], "instruction_kind": ["macro", "micro", "unknown"]},
        "bounds": {"confidence_score": (0, 1), "instruction_kind_confidence": (0, 1)},
    },
    "instruction_field_map": {
        "required": ["trace_id", "instruction_name", "field_name", "bit_range"],
        "choices": {},
        "bounds": {"confidence_score": (0, 1), "word_index": (0, None)},
    },
    "field_datatype_catalog": {"required": ["trace_id", "instruction_name", "field_name", "data_type_ref"], "choices": {}, "bounds": {}},
    "datatype_registry": {
        "required": ["trace_id", "type_id"],
        "choices": {"category": ["software_primitive", "ip_architecture", "alias", "unknown"]},
        "bounds": {},
    },
    "constraint_registry": {"required": ["trace_id", "constraint_id", "expression"], "choices": {}, "bounds": {}},
}
