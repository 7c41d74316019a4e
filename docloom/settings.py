"""Validated settings, from arguments, environment (prefix DOCLOOM_, any case) or defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

DEVICES = ("cpu", "cuda", "mps")
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
#: Least and greatest allowed.
BOUNDS = {
    "batch_size": (1, 512),
    "chunk_size": (50, 2000),
    "chunk_overlap": (0, None),
    "max_retries": (0, 10),
    "retry_delay": (0.1, None),
    "tag_boost": (0.0, 1.0),
    "search_limit": (1, 100),
}


@dataclass(frozen=True)
class Settings:
    embedder: str = "hashing"
    device: str = "cpu"
    batch_size: int = 32
    max_seq_length: int = 512
    chunk_size: int = 450
    chunk_overlap: int = 100
    store_path: str = "vectors"
    collection: str = "documents"
    store_timeout: float = 30.0
    max_retries: int = 3
    retry_delay: float = 1.0
    log_level: str = "INFO"
    tag_boost: float = 0.20
    search_limit: int = 10
    use_summary_vector: bool = False

    def __post_init__(self) -> None:
        for name, (low, high) in BOUNDS.items():
            value = getattr(self, name)
            if value < low or (high is not None and value > high):
                raise ValueError(f"{name} must lie between {low} and {high}: {value}")
        if self.chunk_overlap >= self.chunk_size:
            raise ValueError("chunk_overlap must be less than chunk_size")
        if self.device not in DEVICES:
            raise ValueError(f"device must be one of {DEVICES}")
        if self.log_level.upper() not in LOG_LEVELS:
            raise ValueError(f"log_level must be one of {LOG_LEVELS}")
        object.__setattr__(self, "log_level", self.log_level.upper())

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **given) -> Settings:
        env = {k.upper(): v for k, v in (os.environ if env is None else env).items()}
        found = {}
        for f in fields(cls):
            text = env.get(f"DOCLOOM_{f.name.upper()}")
            if text is not None:
                kind = type(f.default)
                found[f.name] = text.strip().lower() in ("1", "true", "yes", "on") if kind is bool else kind(text)
        return cls(**(found | given))
