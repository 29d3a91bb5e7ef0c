"""Fixtures of hand-made rows, and plain versions that the operators are held against."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, rate double, host string"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) with further columns of names that operators use inside."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, *(None,) * (4 - len(row)))
        full.append((doc_id, text, lang, source, len(text or ""), "k", 0.5, "h"))
    return spark.createDataFrame(full, DOCS)


def reachable(nodes, links):
    """Smallest node reachable of every node."""
    best = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(best[a], best[b])
            if best[a] != low or best[b] != low:
                best[a] = best[b] = low
                changed = True
    return best
