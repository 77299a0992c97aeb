"""Settings of a run, from a YAML file or by hand."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields
from pathlib import PurePosixPath
from typing import Any

STAGES = ("works", "authors", "deduplication", "graph_filtering", "metrics")


@dataclass(frozen=True)
class SelectedConcepts:
    """Whose scores are kept whatever the threshold: none, all concepts of a work, or the listed ones for every work."""

    enabled: bool = True
    get_all_concepts: bool = False
    concept_ids: tuple[str, ...] = ()


@dataclass(frozen=True)
class Settings:
    """Paths may be on any file system that Spark reads. Every deduplicated table is checked for repeated keys as a whole, so global_duplicate_check, as older settings files have
    it, asks for nothing more."""

    works_input: str = "input/works"
    authors_input: str = "input/authors"
    data_path: str = "data"
    shards_path: str = "shards"
    tables_path: str = "tables"
    filtered_tables_path: str = "filtered_tables"
    metrics_path: str = "metrics"
    min_publication_year: int = 2005
    max_publication_year: int = 2024
    concept_score_threshold: float = 0.3
    include_abstract_inverted: bool = False
    selected_concepts: SelectedConcepts = field(default_factory=SelectedConcepts)
    graph_filter_concepts: tuple[str, ...] = ()
    global_duplicate_check: bool = False
    parquet_compression: str = "zstd"
    max_connection_retries: int = 3
    enabled_pipelines: tuple[str, ...] = STAGES

    def root(self, kind: str) -> str:
        """Folder of shards, tables, filtered_tables or metrics."""
        sub = getattr(self, f"{kind}_path")
        return sub if "://" in sub or PurePosixPath(sub).is_absolute() else f"{self.data_path.rstrip('/')}/{sub}"

    def seeds(self) -> list[str]:
        return valid_seeds(self.graph_filter_concepts)

    def object_store_options(self) -> dict[str, str]:
        """Hadoop options for public buckets, read without credentials, with the retries asked for."""
        return {
            "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
            "spark.hadoop.fs.s3a.attempts.maximum": str(self.max_connection_retries),
            "spark.task.maxFailures": str(max(4, self.max_connection_retries)),
        }


def valid_seeds(ids: tuple[str, ...] | list[str]) -> list[str]:
    """Seed concept ids; anything but C and digits is refused."""
    for x in ids:
        if not isinstance(x, str) or not re.fullmatch(r"C[0-9]+", x):
            raise ValueError(f"not a concept id: {x!r}")
    return list(dict.fromkeys(ids))


def from_dict(values: dict[str, Any]) -> Settings:
    known = {f.name for f in fields(Settings)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    given = dict(values)
    chosen = given.get("selected_concepts")
    if isinstance(chosen, dict):
        given["selected_concepts"] = SelectedConcepts(**{k: tuple(v) if isinstance(v, list) else v for k, v in chosen.items()})
    settings = Settings(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
    wrong = [x for x in settings.enabled_pipelines if x not in STAGES]
    if wrong:
        raise ValueError(f"unknown stages: {', '.join(wrong)}")
    return settings


def load(path: str) -> Settings:
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_dict(yaml.safe_load(f) or {})
