"""Settings of a run, read from TOML; paths are relative to the file."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any

from seqloom.plans.training_set import PrepSettings


class ConfigError(ValueError):
    """A setting is missing or out of range."""


@dataclass(frozen=True)
class QuantiserSettings:
    """Codebook training."""

    levels: int = 8
    codebook_size: int = 2048
    rounds: int = 8
    ema_decay: float = 0.99
    ema_eps: float = 1e-5
    val_ratio: float = 0.05
    seed: int = 42

    def __post_init__(self) -> None:
        _require(self.levels >= 1 and self.codebook_size >= 2 and self.rounds >= 1, "levels, codebook_size and rounds must be positive")
        _require(0 < self.ema_decay < 1 and self.ema_eps > 0 and 0 < self.val_ratio < 1, "ema_decay, ema_eps or val_ratio out of range")


@dataclass(frozen=True)
class TokeniseSettings:
    """Semantic ids and their evaluation."""

    special_tokens: tuple[str, ...] = ("<anime_start>", "<anime_end>", "<watch>", "<liked>", "<disliked>", "<dropped>")
    semantic_id_concat: bool = True
    semantic_id_separator: str = ""
    cluster_sample_size: int = 10
    cluster_min_bucket: int = 20
    cluster_random_seed: int = 42
    recall_k: int = 20
    recall_min_support: int = 10
    recall_positive_score_min: int = 7
    recall_completed_status: int = 2
    recall_max_queries: int = 500
    recall_seed: int = 42

    def __post_init__(self) -> None:
        _require(self.cluster_sample_size >= 2 and self.cluster_min_bucket >= 1, "cluster settings must be positive")
        _require(self.recall_k >= 1 and self.recall_min_support >= 1 and self.recall_max_queries >= 1, "recall settings must be positive")
        _require(1 <= self.recall_positive_score_min <= 10, "recall_positive_score_min must be 1 to 10")


@dataclass(frozen=True)
class StageSettings:
    """Weights of the tasks in a training stage."""

    weight_task_a: float = 0.85
    weight_task_b: float = 0.10
    weight_task_c: float = 0.05
    max_domain_rows: int = 0

    def __post_init__(self) -> None:
        weights = (self.weight_task_a, self.weight_task_b, self.weight_task_c)
        _require(min(weights) >= 0 and abs(sum(weights) - 1) <= 1e-8, "task weights must add up to 1")
        _require(self.max_domain_rows >= 0, "max_domain_rows must not be negative")


# Names of the preparation settings in files.
_PREP_NAMES = {
    "target_examples": "target_examples", "split_task_a": "share_a", "split_task_b": "share_b", "split_task_c": "share_c", "max_task_a_templates_per_anime": "max_templates",
    "task_b_min_history": "min_history", "task_b_max_history": "max_history", "task_b_mask_modes": "mask_modes", "task_b_positive_score_min": "liked_from",
    "task_b_allowed_statuses": "statuses", "seed": "seed",
}


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def load(path: str | Path) -> dict[str, Any]:
    """A TOML file as a mapping."""
    path = Path(path)
    _require(path.exists(), f"no such file: {path}")
    with path.open("rb") as f:
        return tomllib.load(f)


def section(body: Mapping[str, Any], name: str) -> Mapping[str, Any]:
    """A section (dots go deeper) that must be there."""
    for part in name.split("."):
        _require(isinstance(body, Mapping) and isinstance(body.get(part), Mapping), f"missing section [{name}]")
        body = body[part]
    return body


def _build(kind: type, values: Mapping[str, Any], names: Mapping[str, str] | None = None) -> Any:
    """A settings object of the known names; lists become tuples, unknown names are passed over."""
    known = {f.name for f in fields(kind)}
    pairs = (((names or {}).get(k, k if not names else None), v) for k, v in values.items())
    try:
        return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in pairs if k in known})
    except (TypeError, ValueError) as e:
        raise ConfigError(str(e)) from e


def prep_settings(path: str | Path) -> PrepSettings:
    """Section [prep]."""
    return _build(PrepSettings, section(load(path), "prep"), _PREP_NAMES)


def quantiser_settings(path: str | Path) -> QuantiserSettings:
    """Section [rqvae]."""
    return _build(QuantiserSettings, {"levels" if k == "rq_levels" else k: v for k, v in section(load(path), "rqvae").items()})


def tokenise_settings(path: str | Path) -> TokeniseSettings:
    """Section [tokenize]."""
    return _build(TokeniseSettings, section(load(path), "tokenize"))


def stage_settings(path: str | Path, phase: str) -> StageSettings:
    """Section [train.<phase>]."""
    return _build(StageSettings, section(load(path), f"train.{phase}"))


def resolve(path: str | Path, value: str) -> Path:
    """A path of a file's settings, relative to that file."""
    found = Path(value).expanduser()
    return found if found.is_absolute() else (Path(path).resolve().parent / found).resolve()


def secret(direct: str, env_name: str, env_file: str | Path | None = None, fallbacks: tuple[str, ...] = ()) -> str:
    """A value given directly, else from a file of NAME=value lines, else from the environment."""
    if direct.strip():
        return direct.strip()
    kept: dict[str, str] = {}
    if env_file and Path(env_file).exists():
        for line in Path(env_file).read_text(encoding="utf-8").splitlines():
            name, sign, value = line.strip().removeprefix("export ").partition("=")
            if sign and not name.startswith("#"):
                kept[name.strip()] = value.strip().strip("'\"")
    for name in (env_name, *fallbacks):
        if found := kept.get(name) or os.environ.get(name, ""):
            return found.strip()
    return ""
