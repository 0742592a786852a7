"""Lane and group of a record, as expressions folded from configuration."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from loomery.config import Lanes, Terminology, java_pattern


def _any_of(text: Column, patterns: Iterable[str]) -> Column:
    hits = [text.rlike(java_pattern(p)) for p in patterns]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out


def _ladder(steps: list[tuple[Column, Column]], otherwise: Column) -> Column:
    if not steps:
        return otherwise
    out = F.when(*steps[0])
    for condition, value in steps[1:]:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def lane_of(record_id: Column, lanes: Lanes) -> Column:
    """First lane with a pattern in the lower-cased id; patterns are used as they are."""
    low = F.lower(record_id)
    return _ladder([(_any_of(low, x.patterns), F.lit(x.id)) for x in lanes.lanes if x.patterns], F.lit(lanes.default).cast("string"))


def group_of(record_id: Column, prompt: Column, terms: Terminology) -> Column:
    """Group by six tiers in order; a tier may decide for null, so this is one ladder and not a coalesce."""
    by_id = terms.ordered(terms.id_order)
    none = F.lit(None).cast("string")
    steps = [(_any_of(record_id, g.id_patterns), F.lit(g.name)) for g in by_id if g.id_patterns]
    for pattern, behaviour in terms.cross_group:
        named = _ladder([(record_id.contains(g.name), F.lit(g.name)) for g in by_id], none) if behaviour == "detect_from_id_suffix" else none
        steps.append((_any_of(record_id, [pattern]), named))
    steps += [(_any_of(record_id, [p]), F.lit(name)) for p, name in terms.edge_defaults]
    low = F.lower(F.coalesce(prompt, F.lit("")))
    steps += [((low != "") & _any_of(low, g.prompt_patterns), F.lit(g.name)) for g in terms.ordered(terms.prompt_order) if g.prompt_patterns]
    if terms.null_patterns:
        steps.append((_any_of(record_id, terms.null_patterns), none))
    steps += [(_any_of(record_id, [p]), F.lit(name)) for p, name in terms.id_fallbacks]
    return _ladder(steps, none)
