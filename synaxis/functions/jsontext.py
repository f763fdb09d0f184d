"""Strict JSON parsing shared by the Arrow batch functions (runs in Python workers)."""

from __future__ import annotations

import json
from typing import Any


def _no_constant(name: str) -> Any:
    raise ValueError(f"{name} is not JSON")


_DECODER = json.JSONDecoder(parse_constant=_no_constant)
BAD = object()


def parse(text: str | None) -> Any:
    """The JSON value of a text, or ``BAD`` where the text is not JSON (null and blank included)."""
    if text is None:
        return BAD
    try:
        return _DECODER.decode(text)
    except (ValueError, RecursionError):
        return BAD


def plain(value: Any) -> str | None:
    """A scalar as text, a list or object as compact JSON, null as None; always encodable."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        text = value
    elif isinstance(value, (int, float)):
        text = repr(value)
    else:
        text = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return text.encode("utf-8", "replace").decode("utf-8")
