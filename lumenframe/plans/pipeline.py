"""Declarative plans: a configuration becomes one lazy chain of DataFrame operators.

A configuration has a key a step (a missing or empty one is off). Steps of a method take their arguments
as ``settings`` or ``kwargs``. ``feature_extraction`` is a list of types for all masks, such a list under
``types``, or a list for each mask by its name. Beside masks, the raw intensities of the whole frames are
always a branch of their own. Keys that no step reads raise, at every level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import TYPES, feature_arrays, spread
from ..model import channel
from ..operators import filters, illumination, masking, normalization, projection, sampling, segmentation

#: The steps, and what each may hold.
STEPS = {
    "load": ("format", "channels", "channel_names", "kwargs"),
    "project": ("method", "settings", "kwargs"),
    "illumination_correction": ("method", "key", "export", "settings", "kwargs"),
    "segment": ("method", "group_keys", "export", "settings", "kwargs"),
    "mask": ("combined_indices", "main_channel_index", "filters", "methods"),
    "filter": ("name", "method", "settings", "kwargs"),
    "normalization": ("lower", "upper", "group_by"),
    "feature_extraction": None,
    "export": ("format", "filename"),
}
_METHOD = ("method", "name", "export", "border", "bbox_channel_index", "settings", "kwargs")
_MASK_FILTER = ("method", "channel_indices", "settings", "kwargs")


@dataclass
class Result:
    """The wide table, the extremes of each branch if there was a normalization, and what is persisted."""

    features: DataFrame
    boundaries: dict[str, DataFrame]
    persisted: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        for d in self.persisted:
            d.unpersist()


def load_config(path: str) -> dict:
    import yaml

    with open(path) as f:
        return yaml.safe_load(f)


def _known(step, keys, where: str) -> None:
    if not isinstance(step, dict):
        raise ValueError(f"{where} must be a mapping, not {step!r}")
    if unknown := sorted(set(map(str, step)) - set(keys)):
        raise ValueError(f"unknown keys {unknown} in {where}; among {tuple(keys)}")


def arguments(step: dict, where: str) -> dict:
    """What a step's method is called with: its ``settings`` or its ``kwargs``."""
    settings, kwargs = step.get("settings") or {}, step.get("kwargs") or {}
    if settings and kwargs:
        raise ValueError(f"{where} has both settings and kwargs")
    return dict(settings or kwargs)


def _feature_types(step, masks: list[str]) -> dict[str, list[str]]:
    """Types by branch: by mask name, or under "" without masks. ``raw`` is no type of a mask."""
    named = isinstance(step, dict) and not (set(step) == {"types"} and "types" not in masks)
    if isinstance(step, dict) and not named:
        step = step["types"]
    if not named:
        types = list(step or [])
        out = {m: [t for t in types if t != "raw"] for m in masks} | {"raw": ["raw"]} if masks else {"": types}
    else:
        _known(step, masks, "feature_extraction")
        if missing := [m for m in masks if m not in step]:
            raise ValueError(f"feature_extraction has no types for {missing}")
        out = {m: list(step[m] or []) for m in masks} | {"raw": ["raw"]}
    for name, types in out.items():
        if unknown := set(types) - set(TYPES):
            raise ValueError(f"unknown feature types {sorted(unknown)} of {name or 'all'}; among {TYPES}")
    return out


def validate(config: dict) -> dict:
    """Missing steps are off; unknown keys and impossible plans raise."""
    _known(config, STEPS, "the configuration")
    out = {s: config.get(s) for s in STEPS}
    for name, keys in STEPS.items():
        if out[name] is not None and keys:
            _known(out[name], keys, name)
    load = out["load"] or {}
    names, channels = load.get("channel_names"), load.get("channels")
    if not names or (channels is not None and len(names) != len(channels)):
        raise ValueError("channels and channel_names must have one entry a channel")
    masks = []
    if out["mask"]:
        for f in out["mask"].get("filters") or []:
            _known(f, _MASK_FILTER, "mask.filters")
        for m in out["mask"].get("methods") or []:
            _known(m, _METHOD, "mask.methods")
            masks.append(m.get("name") or m["method"])
        if not masks or len(set(masks)) < len(masks) or "raw" in masks:
            raise ValueError("mask.methods needs methods with names of their own, and none named raw")
    types = _feature_types(out["feature_extraction"], masks)
    if not (out["mask"] or out["segment"]) and set(types[""]) - {"raw"}:
        raise ValueError("without masks or segmentation only raw features can be computed")
    if out["filter"] and (kind := out["filter"].get("name") or out["filter"].get("method")) != "threshold":
        raise ValueError(f"unknown filter {kind!r}; threshold is the one there is")
    return out | {"types": types}


def build(config: dict, images: DataFrame, meta: list[str] = ("event",), limit: int | None = None, with_replacement: bool = False, output: str | None = None, seed: int = 0, persist: bool = False) -> Result:
    """All steps over image rows; each mask is a branch, and branches meet again by event.

    ``persist`` keeps the rows that several branches read (memory, then disk) until ``Result.release``.
    """
    c = validate(config)
    names, n = c["load"]["channel_names"], len(c["load"]["channel_names"])
    main = (c["mask"] or {}).get("main_channel_index") or 0
    meta, kept = list(meta), []
    d = images
    if c["project"]:
        settings = arguments(c["project"], "project")
        # a method of one operator, or the operator as a setting of the method "op"
        method = c["project"].get("method", "max")
        d = projection.project(d, settings.pop("op", method if method != "op" else "max"), **settings)
    if c["illumination_correction"]:
        i = c["illumination_correction"]
        if i.get("method", "jones_2006") != "jones_2006":
            raise ValueError(f"unknown illumination correction {i['method']!r}; jones_2006 is the one there is")
        d = illumination.correct(d, i["key"], output=output if i.get("export") else None, **arguments(i, "illumination_correction"))
    if c["segment"]:
        s = c["segment"]
        d = segmentation.segment(d, s["method"], arguments(s, "segment"), s.get("group_keys") or [], output if s.get("export") else None)
        meta += [m for m in ("id", "group") if m not in meta]
    if limit is not None and limit > 0:
        d = (sampling.sample_with_replacement if with_replacement else sampling.sample)(d, limit, "event", seed)
        if with_replacement:
            meta += ["_draw"]
    if persist and (c["mask"] or c["filter"] is not None or c["normalization"] is not None):
        d = d.persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(d)
    branches = []
    if c["mask"]:
        f = [{"method": x["method"], "channel_indices": x.get("channel_indices"), "settings": arguments(x, "mask.filters")} for x in c["mask"].get("filters") or []]
        filtered = filters.mask_filters(d, f, main, n)
        for m in c["mask"]["methods"]:
            b = masking.make(filtered, m["method"], m.get("border", True), main, **arguments(m, "mask.methods"))
            branches.append((m.get("name") or m["method"], masking.apply(b, n, c["mask"].get("combined_indices"))))
        branches.append(("raw", d))
    else:
        branches.append(("", d))
    out, boundaries = None, {}
    keys = [m for m in meta if m in ("event", "_draw")]
    by = (c["normalization"] or {}).get("group_by") or "group"
    for k, (name, b) in enumerate(branches):
        if c["filter"] is not None:
            b = filters.threshold(b)
        if c["normalization"] is not None:
            lower, upper = (c["normalization"].get(k) for k in ("lower", "upper"))
            b, boundaries[name] = normalization.normalize(b, by, 0.0 if lower is None else lower, 1.0 if upper is None else upper)
        # branches meet as a few arrays a row, and spread into columns once
        arrays = feature_arrays(b, c["types"][name], meta if out is None else keys, f"b{k}")
        out = arrays if out is None else out.join(arrays, [f"meta_{x}" for x in keys], "left")
    out = spread(out, names, [(name, f"b{k}", c["types"][name]) for k, (name, _) in enumerate(branches)])
    return Result(out, {k: normalization.channel_boundaries(x, names, by) for k, x in boundaries.items()}, kept)


def select_channels(images: DataFrame, wanted: list[int]) -> DataFrame:
    """Only the given channels of image rows (channels, rows, columns), in their order."""
    cut = F.concat(*(channel(F.col("pixels"), F.col("shape"), k) for k in wanted))
    return images.withColumns({"pixels": cut, "shape": F.array(F.lit(len(wanted)), F.element_at("shape", -2), F.element_at("shape", -1))})
