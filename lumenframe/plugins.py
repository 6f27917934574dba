"""Steps named in a configuration: a registered name, or ``module:function`` of any importable module."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping


def resolve(table: Mapping[str, Callable], name: str, what: str) -> Callable:
    """The function ``name`` of ``table``, or the one that a dotted ``module:function`` names."""
    if name in table:
        return table[name]
    module, colon, function = str(name).partition(":")
    if not colon:
        raise ValueError(f"unknown {what} {name!r}; one of {sorted(table)}, or module:function")
    try:
        return getattr(importlib.import_module(module), function)
    except (ImportError, AttributeError) as e:
        raise ValueError(f"{what} {name!r} can't be imported: {e}") from e
