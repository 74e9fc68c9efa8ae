"""Settings, from the environment or as given."""

from __future__ import annotations

import os
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    collection: str = "dev_docs"
    samples_dir: str = "samples"
    index_dir: str = "index"
    batch_size: int = 50
    embedding_batch_size: int = 100
    max_retries: int = 3
    dimensions: int = 3072
    api_key: str = ""

    @classmethod
    def from_env(cls, **given) -> Config:
        """Environment variables in capitals; what is given goes first. A number that
        cannot be read raises ValueError."""
        env = {}
        for name in cls.__dataclass_fields__:
            if (v := os.environ.get(name.upper())) is not None:
                env[name] = int(v) if isinstance(getattr(cls, name), int) else v
        return cls(**env | {k: v for k, v in given.items() if v is not None})

    def shown(self) -> dict[str, str]:
        """Settings for a log, without secrets."""
        return {k: ("***" if v else "") if k == "api_key" else str(v) for k, v in self.__dict__.items()}
