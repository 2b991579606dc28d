"""Pipeline specification: YAML groups with common defaults, templates, sources.

Precedence (lowest to highest): group ``common`` < template < source or
pipeline entry.  A NULL value never overrides; lists replace, they do not
append; unknown keys are kept and merged like known ones.

Expansion: each source runs the templates named by its ``targetTemplates``,
else those named by ``common.targetTemplates``, else every template.  The
generated name is ``pipelineNamePrefix + pipelineNameSuffix`` when both are
set, else the merged ``name``.
"""

from __future__ import annotations

import copy
import os
import re
from collections.abc import Mapping as _Mapping

import yaml

from cdcflow.plans.registry import GROUPS

GROUP_KEYS = {"lv1": "lv1_processors", "api": "api_processors", "lv2": "lv2_processors"}
CONFIG_PATH_ENV = "CDCFLOW_PIPELINES"
class SpecError(ValueError):
    pass


def merge(base: dict | None, override: dict | None) -> dict:
    """``override`` wins key by key, except where its value is NULL."""
    out = copy.deepcopy(base or {})
    for k, v in (override or {}).items():
        if v is not None:
            out[k] = copy.deepcopy(v)
    return out


def _runs(group: dict):
    """Every (template, source) of a group that its targets ask for."""
    named = (group.get("common") or {}).get("targetTemplates")
    for source in group.get("sources") or []:
        wanted = source.get("targetTemplates", named)
        wanted = named if wanted is None else wanted
        for template in group.get("templates") or []:
            if wanted is None or template.get("name") in wanted:
                yield template, source


def expand_group(group: dict | None) -> list[dict]:
    """Explicit pipelines plus template x source expansion (before ``common``)."""
    group = group or {}
    made = [merge(p, None) for p in group.get("pipelines") or []]
    for template, source in _runs(group):
        ends = template.get("pipelineNamePrefix"), source.get("pipelineNameSuffix")
        named = {"name": "".join(ends)} if None not in ends else None
        made.append(merge(merge(template, source), named))
    return made


def resolve_group(group_type: str, group: dict | None) -> list[dict]:
    """Fully merged, validated definitions of one group."""
    if group_type not in GROUPS:
        raise SpecError(f"unknown group type {group_type!r}")
    common = (group or {}).get("common")
    defs = []
    for d in expand_group(group):
        merged = merge(common, d) if common else d
        validate(group_type, merged)
        merged["group"] = group_type
        defs.append(merged)
    return defs


_PLACEHOLDER = re.compile(r"\{([^{}]+)\}")


def validate(group_type: str, d: dict) -> None:
    if d.get("name") is None:
        raise SpecError(f"a pipeline of group {group_type} has no name")
    absent = [k for k in ("sourceTopic", "destinationTopic", "failTopic", "mapperName", "schemaName") if not d.get(k)]
    if absent:
        raise SpecError(f"pipeline {d['name']} lacks {', '.join(absent)}")
    pk = d.get("primaryKeyFields")
    if pk is not None and not isinstance(pk, list):
        raise SpecError(f"primaryKeyFields must be a list in pipeline: {d['name']}")


def check_against_schema(d: dict, field_names: list[str]) -> None:
    """Plan-time checks the original leaves to run time: key fields and
    key-format placeholders must name declared fields."""
    names = set(field_names)
    fmt = d.get("keyFormat")
    if str(d.get("keyType", "")).lower() == "string" and fmt:
        unknown = [p for p in _PLACEHOLDER.findall(fmt) if p not in names]
        if unknown:
            raise SpecError(f"keyFormat placeholders {unknown} are not fields of {d['schemaName']}")
        return
    missing = [f for f in d.get("primaryKeyFields") or [] if f not in names]
    if missing:
        raise SpecError(f"Primary key field(s) {missing} not found in schema {d['schemaName']}")


def check(defs: dict[str, list[dict]]) -> dict[str, list[dict]]:
    """Names are unique over all groups (they name queries and checkpoints), mappers and
    schemas exist, and keys name declared fields."""
    from cdcflow.plans import registry
    from cdcflow.plans import samples as _samples  # noqa: F401  (registers the sample mappers)

    seen: set[str] = set()
    for group, members in defs.items():
        for d in members:
            if d["name"] in seen:
                raise SpecError(f"two pipelines are named {d['name']!r}")
            seen.add(d["name"])
            try:
                registry.get_mapper(group, d["mapperName"])
                fields = registry.get_schema(d["schemaName"], group).fieldNames()
            except (KeyError, ValueError) as e:
                raise SpecError(f"pipeline {d['name']}: {e}") from e
            check_against_schema(d, fields)
    return defs


def load(text_or_path: str | None = None) -> dict[str, list[dict]]:
    """Parse a spec (YAML text, a path, ``$CDCFLOW_PIPELINES``, or the bundled
    sample when none is named) into resolved, checked definitions per group."""
    raw = _read(text_or_path)
    doc = yaml.safe_load(raw) or {}
    if not isinstance(doc, _Mapping):
        raise SpecError("pipeline spec must be a mapping of groups")
    return check({g: resolve_group(g, doc.get(key)) for g, key in GROUP_KEYS.items()})


def _read(text_or_path: str | None) -> str:
    if text_or_path is None:
        text_or_path = os.environ.get(CONFIG_PATH_ENV)
    if text_or_path is None:
        from cdcflow.plans.samples import SAMPLE_SPEC

        return SAMPLE_SPEC
    if "\n" in text_or_path:
        return text_or_path
    if os.path.exists(text_or_path):
        with open(text_or_path, encoding="utf-8") as fh:
            return fh.read()
    raise SpecError(f"no pipeline spec at {text_or_path!r}")
