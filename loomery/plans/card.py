"""A dataset card: counts come aggregated, rendering is text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loomery.config import SplitProfile
from loomery.functions.scalars import to_fixed
from loomery.operators import split


def percent(part: int, whole: int) -> str:
    return f"{to_fixed(part / whole * 100, 1)}%" if whole else "—"


def render(name: str, counts: dict[str, int], assigned: DataFrame, profile: SplitProfile) -> str:
    """Markdown over total, included and excluded records, parts, lane balance and the leakage check. One row a part and lane reaches the driver."""
    parts = {r["part"]: r["count"] for r in assigned.groupBy("part").count().collect()}
    balance = split.lane_balance(assigned, profile)
    lanes = balance.orderBy("lane").collect()
    summary = split.balance_summary(balance).first()
    leaks = split.leakage(assigned).count()
    n = sum(parts.values())
    lines = [f"# {name}", "", f"{counts['included']} of {counts['total']} records ({percent(counts['included'], counts['total'])}), {counts['excluded']} excluded", "", "| Part | Records | Share |", "|---|---|---|"]
    lines += [f"| {p} | {parts.get(p, 0)} | {percent(parts.get(p, 0), n)} |" for p in split.PARTS]
    lines += ["", "| Lane | Records | Train | Val | Test | Deviation |", "|---|---|---|---|---|---|"]
    lines += [f"| {r['lane']} | {r['total']} | {r['train_pct']} | {r['val_pct']} | {r['test_pct']} | {r['deviation']} |" for r in lanes]
    lines += ["", f"Seed {profile.seed}; families in more than one part: {leaks}; overall deviation {summary['overall_deviation']}, worst lane {summary['worst_lane']}"]
    return "\n".join(lines) + "\n"
