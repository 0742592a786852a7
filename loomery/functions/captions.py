"""Caption strategies for training rows, and captions of canon entities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from loomery.config import TrainingProfile
from loomery.functions.scalars import either, truthy


def style_trigger(profile: TrainingProfile) -> str | None:
    return profile.style_trigger or (profile.profile_id or "").replace("-", "_") or None


def _listed(*parts: Column | None) -> Column:
    return F.concat_ws(", ", *(truthy(p) for p in parts if p is not None))


def _trigger(profile: TrainingProfile, suffix: str = "") -> Column | None:
    word = style_trigger(profile)
    return F.lit(word + suffix) if word else None


def legacy(record: Callable[[str], Column], lane: Column, group: Column, profile: TrainingProfile) -> Column:
    """trigger word, group, lane, then the start of the prompt, or the id in words."""
    word = F.lit(profile.profile_id.replace("-", "_")) if profile.prompt_strategy == "trigger-word" and profile.profile_id else None
    text = F.coalesce(F.substring(truthy(record("provenance.prompt")), 1, 200), F.replace(record("id"), F.lit("_"), F.lit(" ")))
    return _listed(word, group, lane, text)


def structured(record: Callable[[str], Column], lane: Column, group: Column, profile: TrainingProfile) -> Column:
    """Reviewed fields only: trigger, faction, a different group, lane, the reviewer's words."""
    faction, scene = truthy(record("canon.faction")), truthy(record("judgment.explanation"))
    other = F.when(faction.isNull() | (group != faction), group)
    return _listed(_trigger(profile), F.concat(faction, F.lit(" faction")), other, lane, F.trim(scene))


def natural(record: Callable[[str], Column], lane: Column, group: Column, profile: TrainingProfile) -> Column:
    """A phrase: trigger style, a subject, the reviewer's words."""
    faction, scene = truthy(record("canon.faction")), truthy(record("judgment.explanation"))
    other = F.when(faction.isNull() | (group != faction), truthy(group))
    subject = F.concat_ws(" ", F.concat(faction, F.lit(" faction")), F.coalesce(truthy(lane), other))
    return _listed(_trigger(profile, " style"), F.when(subject != "", F.concat(F.lit("a "), subject)), F.trim(scene))


STRATEGIES = {"legacy": legacy, "structured-metadata": structured, "flux-natural-language": natural}


def caption(record: Callable[[str], Column], lane: Column, group: Column, profile: TrainingProfile) -> Column:
    """By the profile's strategy; an unknown one counts as legacy."""
    return STRATEGIES.get(profile.caption_strategy, legacy)(record, lane, group, profile)


def _text(entry: Column, path: str) -> Column:
    return truthy(F.get_json_object(entry, f"$.{path}"))


def _items(entry: Column, path: str) -> Column:
    return F.from_json(F.get_json_object(entry, f"$.{path}"), "array<string>")


def _first(entry: Column, path: str, n: int) -> Column:
    return F.array_join(F.slice(F.coalesce(_items(entry, path), F.array().cast("array<string>")), 1, n), ", ")


def _worded(entry: Column, kind: str) -> list[Column]:
    """Parts of an entity's caption by its kind; empty ones fall out."""
    t, lit = (lambda path: _text(entry, path)), F.lit
    cue = t("visual.silhouette_cue")
    if kind == "character":
        who = F.concat(lit("a "), F.coalesce(t("kind"), t("role_class"), lit("figure")), F.coalesce(F.concat(lit(" wearing "), t("visual.attire")), lit("")))
        return [who, cue, F.concat(t("visual.build"), lit(" build")), t("visual.hair")]
    if kind == "deity":
        shine = F.when(t("visual.divine_radiance") != "none-on-earth", t("visual.divine_radiance"))
        return [F.concat_ws(" ", F.coalesce(t("generation"), lit("greek")), shine, lit("deity")), cue, F.concat(lit("holding "), t("visual.signature_attribute"))]
    if kind == "faction":
        name = F.coalesce(t("faction_class"), lit("faction"))
        return [F.concat(name, lit(" faction aesthetic")), t("visual.architectural_style"), _first(entry, "visual.aesthetic_markers", 2)]
    if kind == "location":
        place = F.concat_ws(" ", F.concat(lit("a "), t("location_type")), F.concat(lit("in "), F.coalesce(t("region"), t("scale_context.parent_sector"))))
        return [place, cue, t("visual.lighting_mood")]
    if kind == "monster":
        return [F.concat(lit("a "), F.coalesce(t("species_tag"), lit("creature")), lit(" creature")), _first(entry, "signature_features", 2), t("anatomy_descriptor.notable[0]")]
    if kind == "relic":
        stuff = F.array_join(F.coalesce(_items(entry, "materials"), F.array().cast("array<string>")), " and ")
        return [F.concat(lit("a "), F.coalesce(t("relic_type"), lit("relic"))), cue, stuff]
    if kind == "ship":
        return [F.concat(lit("a "), F.coalesce(t("ship_class"), lit("ship")), lit(" ship")), cue, t("visual.material_dominant")]
    if kind == "species":
        return [F.concat(lit("a "), F.coalesce(t("biology_class"), lit("species")), lit(" species")), t("visual.body_plan"), t("visual.anatomy_descriptors.signature_appendages")]
    raise KeyError(kind)


ENTITY_KINDS = ("character", "deity", "faction", "location", "monster", "relic", "ship", "species")


def entity_caption(entry: Column, kind: Column, trigger: str | None) -> Column:
    """Caption of a canon entry given as JSON; null for an unknown kind. The body never enters it."""
    out = None
    for k in ENTITY_KINDS:
        text = _listed(F.lit(f"{trigger} style") if trigger else None, *_worded(entry, k))
        out = F.when(kind == k, text) if out is None else out.when(kind == k, text)
    return out


def entity_type(entry: Column) -> Column:
    return either(*(F.get_json_object(entry, f"$.{k}") for k in ("kind", "species_tag", "location_type", "relic_type", "generation")))
