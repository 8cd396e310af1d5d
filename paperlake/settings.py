"""Source registry, thresholds and table layout.

One settings object is passed through every stage, so that all stages agree on
the same paths and limits.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Source:
    """A record provider. A lower ``priority`` wins when two providers hold one paper."""

    name: str
    format: str = "parquet"
    enabled: bool = True
    priority: int = 100


# --- Fixed values: source registry (name, file format, enabled, priority) ---
DEFAULT_SOURCES: tuple[Source, ...] = (
    Source("arxiv", "parquet", True, 1),
    Source("pubmed", "json", True, 2),
    Source("ieee", "parquet", True, 3),
    Source("acm", "json", True, 4),
    Source("springer", "parquet", False, 5),
)

# --- Fixed values: provider column -> canonical column ---
MAPPED_FIELDS: tuple[str, ...] = (
    "title",
    "authors",
    "abstract",
    "full_text",
    "publication_date",
    "doi",
    "journal",
    "keywords",
)
FIELD_MAPPINGS: dict[str, dict[str, str]] = {
    "arxiv": {name: name for name in MAPPED_FIELDS},
    "pubmed": {name: name for name in MAPPED_FIELDS},
}

# --- Fixed values: thresholds (text lengths count characters) ---
MIN_TITLE_LENGTH = 10
MAX_ABSTRACT_LENGTH = 50_000
MAX_FULL_TEXT_LENGTH = 1_000_000
LOOKBACK_DAYS = 7
MAX_FILES_PER_BATCH = 1000
ENCODER_BATCH_SIZE = 128
TOP_K = 10
# Of the lake's tables and of batches written aside; texts take two thirds of Spark's own choice.
CODEC = "zstd"

# Session options that differ from Spark's own.
SESSION_OPTIONS: dict[str, str] = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Recording a call site for every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def _env_int(name: str, default: int) -> int:
    return int(os.environ.get(name, default))


@dataclass(frozen=True)
class LakeSettings:
    """Where a lake lives and which rules its stages apply.

    ``root`` is any Hadoop-compatible URI shared by all executors.
    """

    root: str
    sources: tuple[Source, ...] = DEFAULT_SOURCES
    min_title_length: int = MIN_TITLE_LENGTH
    max_abstract_length: int = MAX_ABSTRACT_LENGTH
    max_full_text_length: int = MAX_FULL_TEXT_LENGTH
    lookback_days: int = LOOKBACK_DAYS
    vector_dim: int = 384
    max_files_per_batch: int = MAX_FILES_PER_BATCH
    field_mappings: dict[str, dict[str, str]] = field(default_factory=lambda: dict(FIELD_MAPPINGS))

    @classmethod
    def from_env(cls, root: str, **overrides) -> "LakeSettings":
        """Settings whose thresholds can be overridden by environment variables."""
        values = {
            "min_title_length": _env_int("MIN_TITLE_LENGTH", MIN_TITLE_LENGTH),
            "max_abstract_length": _env_int("MAX_ABSTRACT_LENGTH", MAX_ABSTRACT_LENGTH),
            "max_full_text_length": _env_int("MAX_FULL_TEXT_LENGTH", MAX_FULL_TEXT_LENGTH),
            "lookback_days": _env_int("PARTITION_LOOKBACK_DAYS", LOOKBACK_DAYS),
        }
        return cls(root, **{**values, **overrides})

    @property
    def enabled_sources(self) -> list[Source]:
        return [s for s in self.sources if s.enabled]

    def source(self, name: str) -> Source:
        for s in self.sources:
            if s.name == name:
                return s
        raise KeyError(f"source {name!r} is not registered")

    def _under(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def landing_path(self, source: str) -> str:
        return self._under("raw_metadata", source)

    def raw_table_path(self, source: str) -> str:
        return self._under("tables", f"{source}_raw")

    def landed_files_path(self, source: str) -> str:
        """The names of the files of each batch taken in."""
        return self._under("tables", f"{source}_landed_files")

    def checkpoint_path(self, source: str) -> str:
        return self._under("checkpoints", source)

    @property
    def master_path(self) -> str:
        return self._under("tables", "papers_master")

    @property
    def vectors_path(self) -> str:
        return self._under("tables", "papers_vectors")
