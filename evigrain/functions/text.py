"""Text functions: token sets, coverage, numbers, labels, page marks, model families."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from evigrain.constants import ALIGNMENT_STOPWORDS


def stripped(col: Column) -> Column:
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def is_blank(col: Column) -> Column:
    return F.coalesce(stripped(col), F.lit("")) == ""


def token_set(col: Column) -> Column:
    """Distinct lower-case alphanumeric tokens."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit("[a-z0-9]+"), 0))


def alignment_tokens(col: Column) -> Column:
    """Tokens that count for alignment: no stop words, and two characters at least unless digits."""
    stop = F.array(*[F.lit(w) for w in ALIGNMENT_STOPWORDS])
    words = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit("[a-z0-9]+"), 0)
    return F.filter(F.array_except(words, stop), lambda t: (F.length(t) >= 2) | t.between("0", "9"))


def ratio(part: Column, whole: Column, empty: float) -> Column:
    return F.when(whole == 0, F.lit(empty)).otherwise(part.cast("double") / F.when(whole != 0, whole))


def coverage(expected: Column, seen: Column) -> Column:
    """Share of expected tokens that are seen; 0 where none are expected."""
    return ratio(F.size(F.array_intersect(expected, seen)), F.size(expected), 0.0)


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard index of two sets; 1 where both are empty."""
    both = F.size(F.array_intersect(left, right))
    return ratio(both, F.size(F.array_distinct(left)) + F.size(F.array_distinct(right)) - both, 1.0)


def numbers_in(col: Column) -> Column:
    """Signed numbers with thousands commas and decimals that no letter precedes."""
    found = F.regexp_extract_all(col, F.lit(r"(?<![A-Za-z])[-+]?\d[\d,]*(?:\.\d+)?"), 0)
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).cast("double"))


def labels_in(col: Column) -> Column:
    """Sub-question labels (a) to (z), sorted; case tells labels apart, as it does before an answer is searched for them."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(col, F.lit(r"(?i)\(([a-z])\)"), 1)))


def missing_labels(prompt: Column, answer: Column) -> Column:
    """Labels of the prompt that the answer lacks, where the prompt has two or more."""
    labels = labels_in(prompt)
    gone = F.filter(labels, lambda x: ~F.contains(F.lower(answer), F.concat(F.lit("("), F.lower(x), F.lit(")"))))
    return F.when(F.size(labels) >= 2, gone).otherwise(F.array().cast("array<string>"))


def is_figure_caption(col: Column) -> Column:
    return col.rlike(r"(?i)^\s*(?:figure|fig\.)\s*\d")


def model_family(col: Column) -> Column:
    name = F.lower(stripped(col))
    return (
        F.when(F.contains(name, F.lit("qwen")), "qwen")
        .when(F.contains(name, F.lit("glm")) | F.startswith(name, F.lit("zai-org/")), "glm")
        .when(F.contains(name, F.lit("deepseek")), "deepseek")
        .when(F.contains(name, F.lit("kimi")) | F.contains(name, F.lit("moonshot")), "kimi")
        .otherwise(name)
    )


def marked_pages(pages: Column) -> Column:
    """Pages (page_number, extracted_text) in order, each between marks, joined by a blank line."""
    text = lambda p: stripped(F.coalesce(p["extracted_text"], F.lit("")))
    n = lambda p: p["page_number"].cast("string")
    one = lambda p: F.concat(F.lit("[Page "), n(p), F.lit("]\n"), text(p), F.lit("\n[End Page "), n(p), F.lit("]"))
    return F.array_join(F.transform(F.array_sort(pages, lambda a, b: a["page_number"] - b["page_number"]), one), "\n\n")


def markdown_cell(col: Column) -> Column:
    return F.replace(F.replace(col, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))
