"""The region's settings: a mapping read from YAML, checked and completed on the driver."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class Compute:
    match_jobs: int = 6
    threads: int = 4


@dataclass(frozen=True)
class Config:
    catalog: str
    working_dir: str
    subdir: str | None = None
    entity_ids: tuple[str, ...] = ()
    pad_deg: float = 0.01
    reuse_crops: bool = True
    compute: Compute = field(default_factory=Compute)
    s1_phases: tuple[int, ...] = tuple(range(1, 16))
    s2_phases: tuple[int, ...] = tuple(range(1, 18))


def load_config(path: str | None = None, default: str = "config/config.yaml", variable: str = "SKYQUILT_CONFIG", root: str = ".") -> Config:
    """The argument, else the environment's file, else the default. Exactly one of subdir and entity_ids is set.

    Paths are relative to the file, but a catalogue's that begins with ./ is relative to ``root``.
    """
    import yaml

    at = Path(path or os.environ.get(variable) or default)
    if not at.is_file():
        raise FileNotFoundError(at)
    raw = yaml.safe_load(at.read_text()) or {}
    if bool(raw.get("subdir")) == bool(raw.get("entity_ids")):
        raise ValueError("set exactly one of subdir and entity_ids")
    known = {k: raw[k] for k in ("subdir", "pad_deg", "reuse_crops") if k in raw} | {k: tuple(raw[k]) for k in ("entity_ids", "s1_phases", "s2_phases") if raw.get(k)}
    place = lambda x, base=at.parent: x if "://" in x else str((base / x).resolve())
    home = Path(root) if str(raw["catalog"]).startswith("./") else at.parent
    return Config(catalog=place(raw["catalog"], home), working_dir=place(raw["working_dir"]), compute=Compute(**(raw.get("compute") or {})), **known)
