"""Rules on rows, checked in the pass that writes them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP, FAIL, QUARANTINE = "warn", "drop", "fail", "quarantine"
STATE, BROKEN = "_state", "_broken"
KEPT, QUARANTINED, DROPPED = "kept", "quarantined", "dropped"


@dataclass(frozen=True)
class Rule:
    """``condition`` is SQL text that holds for good rows; neither false nor null does.

    A row that breaks it is counted, and with ``warn`` that is all; ``drop``
    leaves it out, ``quarantine`` puts it into a table of its own, ``fail`` ends
    the run.  Among several broken rules quarantine wins over drop.
    """

    name: str
    condition: str
    action: str = WARN

    def __post_init__(self):
        if self.action not in (WARN, DROP, FAIL, QUARANTINE):
            raise ValueError(f"{self.name}: unknown action {self.action!r}")

    @property
    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(False))


def judged(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rows`` with ``_broken``, the names of the rules each breaks, and ``_state``."""
    if len({r.name for r in rules}) != len(rules):
        raise ValueError("rule names repeat")
    names = [F.when(r.broken, F.lit(r.name)) for r in rules]
    marked = rows.withColumn(
        BROKEN, F.array_compact(F.array(*names)) if rules else F.array().cast("array<string>")
    )
    with_action = lambda action: [F.lit(r.name) for r in rules if r.action == action]
    state = F.lit(KEPT)
    for action, result in (
        (DROP, F.lit(DROPPED)),
        (QUARANTINE, F.lit(QUARANTINED)),
        (FAIL, F.raise_error(F.concat(F.lit("rules broken: "), F.array_join(BROKEN, ", ")))),
    ):
        found = with_action(action)
        if found:
            state = F.when(F.arrays_overlap(BROKEN, F.array(*found)), result).otherwise(state)
    return marked.withColumn(STATE, state)


def observed(rows: DataFrame, rules: Sequence[Rule], observation: Observation | str) -> DataFrame:
    """``judged`` rows that count themselves as they pass: all of them, and per rule the broken ones.

    What reads the result may filter it: no filter moves below the counts.
    """
    counts = [F.count_if(F.array_contains(BROKEN, r.name)).alias(r.name) for r in rules]
    return rows.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)
