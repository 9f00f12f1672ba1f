"""Puts the tables a statement reads in front of it, in dependency order."""

from __future__ import annotations

import re

from oracle.marts_sql import Q
from oracle.recast import AS_OF, TABLES
from oracle import day_sql  # noqa: F401  (adds its entries and those it builds on to Q)

# Names that exist both as a source table and as a report are told apart by the suffix _mart in Q.
_SOURCES = {t: s.replace("TIMESTAMP_AS_OF", f"TIMESTAMP '{AS_OF} 00:00:00'") for t, s in TABLES.items()}
_ALL = {**_SOURCES, **Q}
_WORD = re.compile(r"'[^']*'|[A-Za-z_][A-Za-z_0-9]*")


def _reads(text: str) -> list[str]:
    own = set(re.findall(r"(\w+) AS \(", text))
    words = dict.fromkeys(w for w in _WORD.findall(text) if w in _ALL and w not in own)
    return list(words)


def _closure(text: str, seen: dict[str, str]) -> None:
    for name in _reads(text):
        if name not in seen and text is not _ALL[name]:
            _closure(_ALL[name], seen)
            seen[name] = _ALL[name]


def sql(name_or_text: str) -> str:
    """A complete statement over the driver's tables."""
    text = _ALL.get(name_or_text, name_or_text)
    parts: dict[str, str] = {}
    _closure(text, parts)
    if not parts:
        return text.strip()
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({t.strip()})" for n, t in parts.items())
    return f"WITH {ctes}\nSELECT * FROM ({text.strip()}) AS result"
