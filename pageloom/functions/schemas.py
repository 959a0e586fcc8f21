"""Payload schemas of the summary stages, as JSON Schema objects, and their templates."""

from __future__ import annotations

from typing import Any

_STRING: dict[str, Any] = {"type": "string"}
_STRINGS: dict[str, Any] = {"type": "array", "items": _STRING}
_CONFIDENCE: dict[str, Any] = {"type": "string", "enum": ["high", "medium", "low"]}
_KIND: dict[str, Any] = {"type": "string", "enum": ["core_argument", "case_study", "framing", "reference", "endmatter", "mixed"]}
_WEIGHT: dict[str, Any] = {"type": "integer", "minimum": 1, "maximum": 5}


def _closed(**fields: dict[str, Any]) -> dict[str, Any]:
    """A closed object whose fields are all required."""
    return {"type": "object", "additionalProperties": False, "properties": fields, "required": list(fields)}


# --- fixed values: field names and their order ---
_CHUNK_LEGACY = {
    "chapter_title": _STRING, "covered_sections": _STRINGS, "summary": _STRING, "main_points": _STRINGS, "examples_or_evidence": _STRINGS,
    "ambiguity_flags": _STRINGS, "confidence": _CONFIDENCE,
}
_CHUNK_ADDED = {
    "packet_kind": _KIND, "role_in_book": _STRING, "primary_claims": _STRINGS, "methods_or_principles": _STRINGS, "story_events": _STRINGS,
    "priority_weight": _WEIGHT,
}
_CHAPTER_LEGACY = {
    "chapter_title": _STRING, "summary": _STRING, "major_points": _STRINGS, "notable_examples": _STRINGS, "ambiguity_flags": _STRINGS,
    "confidence": _CONFIDENCE,
}
_CHAPTER_ADDED = {
    "chapter_kind": _KIND, "chapter_thesis": _STRING, "priority_weight": _WEIGHT, "primary_claims": _STRINGS, "methods_or_principles": _STRINGS,
    "story_progression": _STRINGS, "what_to_preserve_in_final": _STRINGS,
}
_FINAL = {
    "book_title": _STRING, "executive_summary": _STRING, "central_thesis": _STRING, "structural_overview": _STRING,
    "chapter_summaries": {"type": "array", "items": _closed(chapter_title=_STRING, summary=_STRING)},
    "major_themes": _STRINGS, "notable_examples": _STRINGS, "practical_takeaways": _STRINGS, "faithfulness_notes": _STRINGS,
}
_ISSUES = {"type": "array", "items": _closed(severity={"type": "string", "enum": ["high", "medium", "low"]}, problem=_STRING, correction=_STRING)}

SCHEMAS: dict[str, dict[str, Any]] = {
    "chunk": _closed(**_CHUNK_LEGACY, **_CHUNK_ADDED),
    "chunk_legacy": _closed(**_CHUNK_LEGACY),
    "chapter": _closed(**_CHAPTER_LEGACY, **_CHAPTER_ADDED),
    "chapter_legacy": _closed(**_CHAPTER_LEGACY),
    "final": _closed(**_FINAL),
    "verify": _closed(issues=_ISSUES, **_FINAL),
}
#: What a stage accepts, the current schema first.
STAGE_SCHEMAS = {"chunk": ("chunk", "chunk_legacy"), "chapter": ("chapter", "chapter_legacy"), "final": ("final",), "verify": ("verify",)}


def errors(value: Any, schema: dict[str, Any], path: str = "$") -> list[tuple[str, str]]:
    """(path, message) of everything in ``value`` that the schema does not allow, required fields first."""
    kind = schema.get("type")
    types = {"object": dict, "array": list, "string": str, "integer": int}
    if kind is None:
        return []
    if kind not in types:
        return [(path, f"unsupported schema type {kind!r}")]
    if not isinstance(value, types[kind]) or (kind == "integer" and isinstance(value, bool)):
        return [(path, f"expected {kind}, got {type(value).__name__}")]
    if kind == "object":
        fields = schema.get("properties", {})
        found = [(f"{path}.{k}", "missing required property") for k in schema.get("required", ()) if k not in value]
        if schema.get("additionalProperties") is False:
            found += [(f"{path}.{k}", "unexpected property") for k in sorted(value.keys() - fields.keys())]
        return found + [e for k, sub in fields.items() if k in value for e in errors(value[k], sub, f"{path}.{k}")]
    if kind == "array":
        return [e for k, item in enumerate(value) for e in errors(item, schema.get("items") or {}, f"{path}[{k}]")]
    found = []
    if kind == "integer":
        found += [(path, f"expected >= {schema['minimum']}, got {value}")] if value < schema.get("minimum", value) else []
        found += [(path, f"expected <= {schema['maximum']}, got {value}")] if value > schema.get("maximum", value) else []
    if "enum" in schema and value not in schema["enum"]:
        found.append((path, f"expected one of {schema['enum']!r}, got {value!r}"))
    return found


def template(schema: dict[str, Any], choose: bool = False) -> Any:
    """A payload with the schema's shape; choices are listed, or made (the first) if ``choose``."""
    kind = schema.get("type")
    if kind == "object":
        return {k: template(v, choose) for k, v in schema.get("properties", {}).items()}
    if kind == "array":
        return []
    if kind == "integer":
        return schema.get("minimum", 0)
    if kind == "string":
        choices = schema.get("enum", ("",))
        return choices[0] if choose else " | ".join(choices)
    return None
