"""All queries, by topic."""

from __future__ import annotations

import importlib

from larder.catalog.entry import Entry

TOPICS = ("silver", "gold", "dashboard", "dates", "quality", "stats", "sources", "models")


def entries() -> dict[str, Entry]:
    """Every catalog entry by name."""
    found: dict[str, Entry] = {}
    for topic in TOPICS:
        for entry in importlib.import_module(f"larder.catalog.{topic}").ENTRIES:
            if entry.name in found:
                raise ValueError(f"two entries named {entry.name}")
            found[entry.name] = entry
    return found
