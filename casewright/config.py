"""Settings of the command line, from arguments or the environment; no default endpoint."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    data: str | None = None
    mapping: str | None = None
    output: str | None = None
    master: str = "local[*]"
    vector_size: int = 256
    target_tokens: int = 200
    max_tokens: int = 384

    def require(self, *names: str) -> None:
        """Fail, naming them, if settings are missing."""
        lacking = [n for n in names if not getattr(self, n)]
        if lacking:
            raise ValueError("missing settings: " + ", ".join(lacking))


def load(prefix: str = "CASEWRIGHT_", **given: object) -> Settings:
    """Given values first, then environment variables, then defaults; numbers are read as such."""
    out = {}
    for f in fields(Settings):
        value = given.get(f.name)
        if value is None:
            value = os.environ.get(prefix + f.name.upper())
        if value is not None:
            out[f.name] = int(value) if f.name in ("vector_size", "target_tokens", "max_tokens") else str(value)
    return Settings(**out)
