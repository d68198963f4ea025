"""Fixed values that decide results."""

# fixed values: evidence roles, and those that control how a value is read
ROLES = ["base_value", "comparison_value", "label", "legend", "definition", "qualifier", "exception", "exclusion", "footnote", "threshold", "effective_date", "superseding_rule", "missing_required_evidence"]
CONTROLLING_ROLES = ["legend", "definition", "qualifier", "exception", "exclusion", "footnote", "effective_date", "superseding_rule", "missing_required_evidence"]
# fixed values: operation verbs
VERBS = ["lookup", "spatial_bind", "normalize", "join", "compare", "calculate", "filter", "exclude", "rank", "intersect", "aggregate", "reconcile", "resolve_scope", "supersede", "determine_support"]
# fixed values: capability axes by tier
TIER_2_AXES = ["semantic_reading_flow", "typographic_hierarchy", "standard_table_parsing", "chart_multimodal_interpretation"]
TIER_3_AXES = ["complex_multi_page_tables", "cross_referencing", "artifact_noise", "unsupported_queries"]
# fixed values: words that do not count when an excerpt is aligned with a page
ALIGNMENT_STOPWORDS = ["a", "an", "and", "are", "as", "at", "be", "between", "by", "can", "for", "from", "in", "is", "it", "of", "on", "or", "the", "this", "to", "which", "with"]
# fixed values: kinds of primary evidence, input profiles, license states, alignment states
EVIDENCE_TYPES = ["visual_spatial", "structured_layout", "text_reasoning"]
PROFILES = ["multimodal", "text_only"]
LICENSE_STATES = ["approved", "needs_review", "rejected"]
ALIGNMENT_STATES = ["aligned", "misaligned", "missing_page", "not_checkable_no_excerpt", "not_checkable_visual_or_ocr"]
