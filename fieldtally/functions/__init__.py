"""Column expressions; all of them are built-ins that stay in the JVM."""

from fieldtally.functions.columns import (
    UNTITLED_KINGDOM,
    is_kingdom,
    kingdom_label,
    source_label,
    source_name,
    source_url,
)

__all__ = [
    "UNTITLED_KINGDOM",
    "is_kingdom",
    "kingdom_label",
    "source_label",
    "source_name",
    "source_url",
]
