"""Named checks array<struct<check,passed,details>>, the state that all gates share."""

from pyspark.sql import Column
from pyspark.sql import functions as F

KIND = "array<struct<check:string,passed:boolean,details:string>>"


def check(name: str, passed: Column, details: Column | str) -> Column:
    """One check; details are kept for failures only."""
    text = F.lit(details) if isinstance(details, str) else details
    passed = F.coalesce(passed, F.lit(False))
    return F.struct(F.lit(name).alias("check"), passed.alias("passed"), F.when(~passed, text).alias("details"))


def all_passed(checks: Column) -> Column:
    return F.forall(checks, lambda c: c["passed"])


def replaced(checks: Column, new: Column) -> Column:
    """checks with those of the same name removed and new at the end."""
    return F.concat(F.filter(checks, lambda c: c["check"] != new["check"]), F.array(new))


def replaced_all(checks: Column, prefix: str, new: Column) -> Column:
    return F.concat(F.filter(checks, lambda c: ~F.startswith(c["check"], F.lit(prefix))), new)


def passed_or_absent(checks: Column, name: str) -> Column:
    return F.forall(checks, lambda c: (c["check"] != name) | c["passed"])


def reasons(*pairs: tuple[str, Column]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in pairs]))
