"""Retry rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt strategies from mildest to strictest.
STRATEGIES = ("default", "strict_json", "after_validation_fail", "ocr_retry")


# The next strategy by what failed and what was tried before (nothing counts as default); the empty text
# stands for any other strategy, and any other failure gets OTHER_NEXT.
NEXT = {
    "llm": {"default": "strict_json", "": "ocr_retry"},
    "validation": {"default": "after_validation_fail", "after_validation_fail": "strict_json", "": "ocr_retry"},
}
OTHER_NEXT = "strict_json"


def next_strategy(failure_class: Column, previous: Column) -> Column:
    """the next prompt strategy, given what failed and what was tried."""
    tried = F.coalesce(F.nullif(previous, F.lit("")), F.lit("default"))
    out = F.lit(OTHER_NEXT)
    for failed, table in NEXT.items():
        chosen = F.lit(table[""])
        for before, following in table.items():
            if before:
                chosen = F.when(tried == before, following).otherwise(chosen)
        out = F.when(failure_class == failed, chosen).otherwise(out)
    return out


def next_strategy_of(failure_class: str, previous: str | None) -> str:
    """The same for one job at a time."""
    table = NEXT.get(failure_class, {"": OTHER_NEXT})
    return table.get(previous or "default", table[""])


def base_delay(k: Column, base: float = 5.0, cap: float = 900.0) -> Column:
    return F.least(F.lit(float(cap)), F.lit(float(base)) * F.pow(F.lit(2.0), k))


def jitter(key: Column, k: Column, width: float = 1.5) -> Column:
    """Spread in [0, width), the same for the same job and attempt whenever it is recomputed."""
    return F.pmod(F.xxhash64(key, k), F.lit(1_000_000)) / F.lit(1_000_000.0) * F.lit(width)


def backoff(key: Column, k: Column, base: float = 5.0, cap: float = 900.0) -> Column:
    """seconds until retry number ``k`` (from 0) of a job."""
    return base_delay(k, base, cap) + jitter(key, k)


def retry_outcome(failures: Column, max_failures: Column) -> Column:
    """the failure that reaches the limit sends the job to review."""
    return F.when(failures >= max_failures, "NEEDS_REVIEW").otherwise("RETRY_SCHEDULED")


def strategy_rank(strategy: Column) -> Column:
    rank = F.lit(0)
    for i, name in enumerate(STRATEGIES):
        rank = F.when(strategy == name, F.lit(i)).otherwise(rank)
    return rank


def strategy_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STRATEGIES]), rank + 1)
