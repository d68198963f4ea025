"""Settings as dataclasses, with inheritance between YAML files, cross-field checks and a secrets file."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any, get_type_hints


class ConfigError(ValueError):
    """A setting that is unknown, out of range, or at odds with another."""


#: The least and the most that settings of a file may be.
RANGES: dict[str, tuple[float | None, float | None]] = {
    "dpi": (72, 400), "page_image_dpi": (72, 400), "minimum_page_image_dpi": (72, 400), "num_workers": (1, None), "native_text_min_chars_per_page": (0, None),
    "model_context_tokens": (1, None), "minimum_output_and_safety_reserve_tokens": (1, None), "question_reserve_tokens": (0, None), "system_prompt_reserve_tokens": (0, None),
    "provisional_image_tokens_per_megapixel": (0, None), "candidates_per_document": (1, 20), "batches_per_document": (1, 10), "hard_min_evidence_nodes": (2, 12),
    "hard_min_evidence_pages": (2, 8), "hard_min_dependent_operations": (2, 12), "max_structure_repair_attempts": (0, 2), "max_tasks_per_document": (1, 20),
    "bbox_match_iou": (0, 1), "max_evidence_page_jaccard": (0, 1), "max_evidence_region_jaccard": (0, 1), "max_prompt_token_jaccard": (0, 1), "max_page_operation_jaccard": (0, 1),
    "minimum_evidence_nodes": (2, None), "minimum_dependent_operations": (2, None), "context_window_tokens": (1, None), "max_output_tokens": (1, None), "temperature": (0, 2), "top_p": (0, 1),
    "max_reconstruction_attempts": (1, 3), "minimum_reconstructed_answer_chars": (1, None), "audit_crop_padding_ratio": (0, 1), "audit_crop_min_side_pixels": (32, None),
    "audit_bbox_min_page_token_coverage": (0, 1), "audit_bbox_min_relative_token_coverage": (0, 1), "audit_bbox_repair_max_blocks": (1, 20),
    "audit_bbox_repair_min_token_coverage": (0, 1), "audit_bbox_repair_min_improvement": (0, 1),
}


@dataclass
class Security:
    forbidden_input_roots: list[str] = field(default_factory=lambda: ["benchmarks"])
    forbidden_source_substrings: list[str] = field(default_factory=list)
    allowed_download_schemes: list[str] = field(default_factory=lambda: ["https"])
    max_pdf_bytes: int = 209_715_200


@dataclass
class TargetInput:
    profile: str = "multimodal"
    page_image_dpi: int = 150
    minimum_page_image_dpi: int = 72

    def check(self) -> None:
        if self.minimum_page_image_dpi > self.page_image_dpi:
            raise ConfigError("minimum_page_image_dpi is above page_image_dpi")


@dataclass
class ContextBudget:
    model_context_tokens: int = 524_288
    target_input_utilization: float = 0.80
    preferred_input_utilization_min: float = 0.70
    preferred_input_utilization_max: float = 0.85
    maximum_input_utilization: float = 0.90
    minimum_output_and_safety_reserve_tokens: int = 32_768
    question_reserve_tokens: int = 4096
    system_prompt_reserve_tokens: int = 2048
    text_tokenizer_path: str | None = None
    provisional_chars_per_token: float = 3.5
    provisional_image_tokens_per_megapixel: int = 1200

    def check(self) -> None:
        steps = [self.preferred_input_utilization_min, self.target_input_utilization, self.preferred_input_utilization_max, self.maximum_input_utilization]
        if steps != sorted(steps) or not 0 < steps[0] <= steps[-1] <= 1:
            raise ConfigError("input utilizations must rise from preferred minimum over target and preferred maximum to maximum")
        if self.minimum_output_and_safety_reserve_tokens >= self.model_context_tokens:
            raise ConfigError("the output reserve leaves no context")


@dataclass
class Generation:
    candidates_per_document: int = 3
    batches_per_document: int = 1
    target_difficulty: str = "standard"
    hard_min_evidence_nodes: int = 3
    hard_min_evidence_pages: int = 2
    hard_min_dependent_operations: int = 3
    max_structure_repair_attempts: int = 1
    primary_evidence_type_weights: dict[str, float] = field(default_factory=lambda: {"visual_spatial": 0.40, "structured_layout": 0.45, "text_reasoning": 0.15})

    def check(self) -> None:
        if abs(sum(self.primary_evidence_type_weights.values()) - 1) > 1e-6:
            raise ConfigError("evidence type weights must sum to 1")


@dataclass
class Deduplication:
    max_tasks_per_document: int = 3
    bbox_match_iou: float = 0.30
    max_evidence_page_jaccard: float = 0.50
    max_evidence_region_jaccard: float = 0.50
    max_prompt_token_jaccard: float = 0.75
    max_page_operation_jaccard: float = 0.80


@dataclass
class Difficulty:
    minimum_evidence_nodes: int = 2
    minimum_dependent_operations: int = 2
    require_non_lookup_operation: bool = True
    require_controlling_evidence: bool = True
    require_tier_2_axis: bool = True
    require_tier_3_axis: bool = True


@dataclass
class Verification:
    max_reconstruction_attempts: int = 2
    minimum_reconstructed_answer_chars: int = 256
    require_labeled_subquestion_coverage: bool = True
    audit_image_scope: str = "evidence_pages"
    audit_include_complete_document_text: bool = True
    audit_include_evidence_crops: bool = True
    audit_crop_padding_ratio: float = 0.10
    audit_crop_min_side_pixels: int = 256
    audit_bbox_min_page_token_coverage: float = 0.45
    audit_bbox_min_relative_token_coverage: float = 0.50
    audit_bbox_repair_max_blocks: int = 6
    audit_bbox_repair_min_token_coverage: float = 0.60
    audit_bbox_repair_min_improvement: float = 0.20


@dataclass
class Model:
    model: str = ""
    base_url: str | None = None
    base_url_env: str | None = None
    context_window_tokens: int | None = None
    max_output_tokens: int = 8000
    temperature: float | None = None
    top_p: float | None = None

    def check(self) -> None:
        if self.base_url and self.base_url_env:
            raise ConfigError("a model has its address from one place only")

    def fits(self, input_tokens: int) -> bool:
        return self.context_window_tokens is None or input_tokens + self.max_output_tokens <= self.context_window_tokens


@dataclass
class Models:
    generator: Model = field(default_factory=Model)
    verifier: Model = field(default_factory=Model)
    verifier_long_context: Model | None = None
    judge: Model = field(default_factory=Model)


@dataclass
class Parse:
    ocr_enabled: bool = True
    dpi: int = 150
    native_text_min_chars_per_page: int = 40


@dataclass
class Config:
    run_id: str = "run"
    source_manifest: str | None = None
    secrets_file: str | None = None
    security: Security = field(default_factory=Security)
    parse: Parse = field(default_factory=Parse)
    target_input: TargetInput = field(default_factory=TargetInput)
    context_budget: ContextBudget = field(default_factory=ContextBudget)
    document_view: dict[str, Any] = field(default_factory=lambda: {"overrides": {}})
    generation: Generation = field(default_factory=Generation)
    deduplication: Deduplication = field(default_factory=Deduplication)
    difficulty: Difficulty = field(default_factory=Difficulty)
    verification: Verification = field(default_factory=Verification)
    models: Models = field(default_factory=Models)


def _made(kind: type, values: dict[str, Any], strict: bool) -> Any:
    hints = get_type_hints(kind)
    known = {f.name for f in fields(kind)}
    if strict and (unknown := set(values) - known):
        raise ConfigError(f"unknown settings: {sorted(unknown)}")
    got = {}
    for name in known & set(values):
        hint = hints[name]
        inner = next((t for t in getattr(hint, "__args__", (hint,)) if isinstance(t, type) and is_dataclass(t)), None)
        got[name] = _made(inner, values[name], False) if inner and isinstance(values[name], dict) else values[name]
    for name, value in got.items():
        low, high = RANGES.get(name, (None, None))
        if isinstance(value, int | float) and ((low is not None and value < low) or (high is not None and value > high)):
            raise ConfigError(f"{name} is {value}, which is not within {low} and {high}")
    out = kind(**got)
    if hasattr(out, "check"):
        out.check()
    return out


def merged(base: dict, over: dict) -> dict:
    """over on top of base; dictionaries join key by key, everything else is replaced."""
    return {**base, **{k: merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}}


def read_settings(path: str | Path, above: tuple[Path, ...] = ()) -> dict:
    """A YAML file and what it extends, nearest file last; a cycle is an error."""
    import yaml

    path = Path(path).resolve()
    if path in above:
        raise ConfigError(f"{path} extends itself")
    own = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    if not isinstance(own, dict):
        raise ConfigError(f"{path} does not hold settings")
    parent = own.pop("extends", None)
    return merged(read_settings(path.parent / parent, (*above, path)), own) if parent else own


def load_config(source: str | Path | dict) -> Config:
    """Config from a YAML file or a dictionary. The top level allows known sections (and schema_version, project_root, paths) only."""
    values = dict(source) if isinstance(source, dict) else read_settings(source)
    for name in ("schema_version", "project_root", "paths"):
        values.pop(name, None)
    return _made(Config, values, True)


def load_env(path: str | Path, override: bool = False) -> dict[str, str]:
    """KEY=VALUE lines into the environment; what is set already stays unless override. Returns what was set. A line that is neither that, nor blank, nor a comment, is an error."""
    out = {}
    if Path(path).exists():
        for n, line in enumerate(Path(path).read_text(encoding="utf-8").splitlines(), 1):
            if not line.strip() or line.lstrip().startswith("#"):
                continue
            name, mark, value = line.strip().removeprefix("export ").partition("=")
            if not mark or not name.strip():
                raise ConfigError(f"{path}, line {n}: no NAME=VALUE")
            if override or name.strip() not in os.environ:
                out[name.strip()] = value.strip().strip("'\"")
    os.environ.update(out)
    return out


def route(models: list[Model], input_tokens: int) -> Model | None:
    """The first model whose window holds the request."""
    return next((m for m in models if m.fits(input_tokens)), None)
