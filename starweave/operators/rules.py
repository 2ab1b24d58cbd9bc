"""Ordered decision tables as one Catalyst expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """The first rule whose ``when`` holds decides; ``reasons`` are appended to the common ones."""

    when: Column
    decision: str
    action: str
    severity: str
    reasons: tuple[str, ...]


def decide(rules: list[Rule], common: list[Column]) -> dict[str, Column]:
    """decision, recommended_action, severity and ``;``-joined reasons; ``common`` reasons come first, NULLs are left out."""

    def pick(value) -> Column:
        out = F.lit(None)
        for rule in reversed(rules):
            out = F.when(rule.when, value(rule)).otherwise(out)
        return out

    own = pick(lambda r: F.array(*map(F.lit, r.reasons)))
    return {
        "decision": pick(lambda r: F.lit(r.decision)),
        "recommended_action": pick(lambda r: F.lit(r.action)),
        "severity": pick(lambda r: F.lit(r.severity)),
        "reasons": F.array_join(F.concat(F.array_compact(F.array(*common)), own), ";"),
    }
