"""Configuration on the driver: layers, overlays, selectors, schemas."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import types as T


def overlay(base: Mapping, extra: Mapping) -> dict:
    """extra laid over base, objects merged key by key, all else replaced."""
    out = dict(base)
    for k, v in extra.items():
        out[k] = overlay(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def for_environment(layers: Mapping, environment: str, shared: str = "default") -> dict:
    """The block of the environment (else the shared one) under all plain top-level keys."""
    blocks = {k for k, v in layers.items() if isinstance(v, Mapping) and k in (environment, shared)}
    chosen = layers.get(environment) or layers.get(shared) or {}
    return overlay(chosen, {k: v for k, v in layers.items() if k not in blocks})


def read_yaml(path: str | Path, environment: str) -> dict:
    import yaml

    return for_environment(yaml.safe_load(Path(path).read_text()) or {}, environment)


def one_of(step: Mapping, names: Iterable[str]) -> str | None:
    """The only name of those that a step has; None for none, an error for several."""
    got = [n for n in names if n in step]
    if len(got) > 1:
        raise ValueError(f"only one of {', '.join(sorted(got))} may be set")
    return got[0] if got else None


def out_of_range(parameters: Mapping, ranges: Mapping[str, tuple[float, float]]) -> list[str]:
    """Names of the parameters that lie outside their range."""
    return sorted(k for k, (lo, hi) in ranges.items() if k in parameters and not lo <= parameters[k] <= hi)


def of_family(name: str, prefixes: Iterable[str], joints: str = "-/") -> bool:
    """Whether a name is one of the prefixes, or one followed by a joint and more."""
    return any(name == p or any(name.startswith(p + j) for j in joints) for p in prefixes)


def choose(items: list[str], selector: str) -> list[str]:
    """All items, the first N in order, or those named in a comma-parted list."""
    if selector.strip().lower() in ("", "all"):
        return sorted(items)
    if selector.strip().isdigit():
        return sorted(items)[: int(selector)]
    wanted = {x.strip() for x in selector.split(",")}
    return [x for x in sorted(items) if x in wanted]


def grid(**axes: Iterable) -> list[dict]:
    """All combinations of the axes' values, the last axis fastest."""
    return [dict(zip(axes, v)) for v in itertools.product(*axes.values())]


def schema_of(schema: Mapping) -> T.DataType:
    """A JSON Schema as a Spark type; objects without properties are maps, unknown types text."""
    kind = schema.get("type")
    kind = next((k for k in kind if k != "null"), None) if isinstance(kind, list) else kind
    if kind == "object":
        if not schema.get("properties"):
            return T.MapType(T.StringType(), T.StringType())
        need = set(schema.get("required", ()))
        return T.StructType([T.StructField(k, schema_of(v), k not in need) for k, v in schema["properties"].items()])
    if kind == "array":
        return T.ArrayType(schema_of(schema.get("items", {})))
    return {"integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}.get(kind, T.StringType())


def missing_fields(want: T.StructType, have: T.StructType) -> list[str]:
    """Names of fields that one schema has and the other lacks."""
    return sorted(set(want.fieldNames()) - set(have.fieldNames()))


def level_of(schema: Mapping, settings: Mapping | None = None, name: str = "") -> str:
    """panel, figure or document: set outright, by the shape of the outputs, or by the name."""
    if settings and settings.get("level"):
        return settings["level"]
    outputs = schema.get("properties", {}).get("outputs", {})
    if outputs.get("type") == "array":
        return "panel" if "panel_label" in outputs.get("items", {}).get("properties", {}) else "document"
    if outputs:
        return "figure"
    return next((k for k in ("document", "figure", "panel") if name.startswith(k[:3])), "panel")
