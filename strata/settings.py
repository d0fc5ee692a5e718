"""Where tables live and how many rows of a published query may be fetched."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """``mode`` is ``path`` (files under ``root``) or ``catalog`` (``catalog.schema.layer_name`` tables).

    ``provider`` is any data source installed in the session; ``catalog`` may be empty to use the session's
    current catalog.
    """

    mode: str = "path"
    provider: str = "parquet"
    root: str = "lake"
    catalog: str = ""
    schema: str = "default"
    max_result_rows: int = 200

    def __post_init__(self):
        if self.mode not in ("path", "catalog"):
            raise ValueError(f"mode must be 'path' or 'catalog', not {self.mode!r}")
