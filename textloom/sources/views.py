"""Views from a TOML file: rewrites described by configuration alone."""

from __future__ import annotations

import re
import tomllib
from dataclasses import fields
from pathlib import Path

from textloom.operators.gates import View

PLACEHOLDERS = ("{title}", "{continuity}", "{text}")
_KINDS = {f.name: f.type for f in fields(View)}


class ViewError(ValueError):
    """The file cannot be used; the message names the view and the key."""


def _value(view: str, key: str, x: object) -> object:
    kind = _KINDS.get(key)
    if kind is None or key == "name":
        raise ViewError(f"{view}: unknown key {key}")
    if kind == "float" and isinstance(x, int) and not isinstance(x, bool):
        x = float(x)
    if kind.startswith("tuple") and isinstance(x, list) and all(isinstance(y, str) for y in x):
        x = tuple(x)
    wanted = {"str": str, "bool": bool, "int": int, "float": float}.get(kind, tuple)
    if not isinstance(x, wanted) or (wanted is int and isinstance(x, bool)):
        raise ViewError(f"{view}: {key} must be {kind}")
    return x


def parse_views(path: str | Path) -> list[View]:
    """Views in the file's order, each over the file's defaults; anything not understood is an error."""
    with open(path, "rb") as f:
        made = tomllib.load(f)
    if unknown := set(made) - {"defaults", "views", "view"}:
        raise ViewError(f"unknown table {sorted(unknown)[0]}")
    defaults = made.get("defaults", {})
    out = []
    for name, own in (made.get("views") or made.get("view") or {}).items():
        v = View(name=name, **{k: _value(name, k, x) for k, x in (defaults | own).items()})
        for key in ("out_dir", "system", "user_template"):
            if not getattr(v, key):
                raise ViewError(f"{name}: {key} is missing")
        for p in PLACEHOLDERS:
            if p in v.system:
                raise ViewError(f"{name}: {p} in system, which is the same for all articles")
            if p not in v.user_template:
                raise ViewError(f"{name}: {p} is missing in user_template")
        for pattern in (v.require_pattern, *v.forbid):
            try:
                re.compile(pattern)
            except re.error as e:
                raise ViewError(f"{name}: {pattern!r}: {e}") from e
        out.append(v)
    if not out:
        raise ViewError("no views")
    return out


def select_views(views: list[View], names: list[str] | None = None) -> list[View]:
    """Named ones, else those enabled, in the file's order; an unknown name is an error."""
    if names is None:
        return [v for v in views if v.enabled]
    if unknown := set(names) - {v.name for v in views}:
        raise ViewError(f"unknown views: {', '.join(sorted(unknown))}")
    return [v for v in views if v.name in names]


def output_dirs(path: str | Path) -> dict[str, str]:
    """Name to folder; nothing if the file cannot be used."""
    try:
        return {v.name: v.out_dir for v in parse_views(path)}
    except (OSError, ViewError, tomllib.TOMLDecodeError):
        return {}
