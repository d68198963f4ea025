"""Token budgets, tolerance matches and scores."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from evigrain.config import ContextBudget


def text_tokens(chars: Column, b: ContextBudget) -> Column:
    """Provisional count from characters."""
    return F.ceil(chars / F.lit(float(b.provisional_chars_per_token))).cast("long")


def image_tokens(megapixels: Column, b: ContextBudget) -> Column:
    return F.ceil(megapixels * F.lit(float(b.provisional_image_tokens_per_megapixel))).cast("long")


def megapixels(width_points: Column, height_points: Column, dpi: Column) -> Column:
    return (width_points * dpi / F.lit(72.0)) * (height_points * dpi / F.lit(72.0)) / F.lit(1_000_000.0)


def estimated_input(text: Column, image: Column, b: ContextBudget) -> Column:
    return text + image + F.lit(b.question_reserve_tokens + b.system_prompt_reserve_tokens)


def utilization(tokens: Column, b: ContextBudget) -> Column:
    return tokens.cast("double") / F.lit(float(b.model_context_tokens))


def fits(tokens: Column, b: ContextBudget) -> Column:
    return (utilization(tokens, b) <= b.maximum_input_utilization) & (tokens + b.minimum_output_and_safety_reserve_tokens <= b.model_context_tokens)


def dpi_steps(configured: int, least: int) -> list[int]:
    """Image resolutions to try, from the configured one down."""
    # fixed values: the steps after the configured resolution
    return [d for d in dict.fromkeys((configured, 120, 96, 72)) if least <= d <= configured]


def is_close(a: Column, b: Column, rel: float = 0.005, absolute: float = 1e-6) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def difficulty_score(nodes: Column, operations: Column, pages: Column, controlling: Column, tiers: Column, visual: Column) -> Column:
    """Structural difficulty from 0 to 1, rounded to four places before anything is decided on it."""
    capped = lambda c, n: F.least(c, F.lit(n)).cast("double") / F.lit(float(n))
    score = F.lit(0.20) * capped(nodes, 6) + F.lit(0.20) * capped(operations, 6) + F.lit(0.20) * capped(pages, 4)
    score = score + F.lit(0.15) * capped(controlling, 2) + F.lit(0.15) * capped(tiers, 4) + F.lit(0.10) * F.when(visual, 1.0).otherwise(0.0)
    return F.round(score, 4)


def difficulty_label(score: Column) -> Column:
    return F.when(score >= 0.65, "hard").when(score >= 0.45, "medium").otherwise("reject")


def repair_score(cover: Column, precision: Column, blocks: Column) -> Column:
    return F.greatest(F.lit(0.0), F.lit(0.85) * cover + F.lit(0.15) * precision - F.lit(0.005) * (blocks - 1).cast("double"))


def repair_confidence(cover: Column, gain: Column) -> Column:
    return F.when((cover >= 0.80) & (gain >= 0.40), "high").when((cover >= 0.65) & (gain >= 0.25), "medium").otherwise("low")
