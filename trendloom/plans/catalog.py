"""All registered queries with their SQL texts."""

from __future__ import annotations

from . import exports, feeds, history, interests, requests, streams

_MODULES = [history, feeds, exports, interests, requests, streams]

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
