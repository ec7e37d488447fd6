"""Independent SQL for each query, run by another engine on the same tables."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from . import quality, sales, tables, texts

    out: dict[str, str] = {}
    for module in (tables, sales, quality, texts):
        out.update(module.oracles())
    return out
