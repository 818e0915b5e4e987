"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# Words for yes and no.
YES, NO = {"1", "true", "yes", "on"}, {"0", "false", "no", "off"}


def flag(name: str, default: bool, env: Mapping[str, str] = os.environ) -> bool:
    word = env.get(name, "").strip().casefold()
    if not word and name not in env:
        return default
    if word in YES | NO:
        return word in YES
    raise ValueError(f"{name} must be one of {', '.join(sorted(YES | NO))}")


def positive(name: str, default: int, env: Mapping[str, str] = os.environ) -> int:
    raw = env.get(name)
    if raw is None:
        return default
    try:
        value = int(raw)
    except ValueError:
        value = 0
    if value < 1:
        raise ValueError(f"{name} must be a positive whole number")
    return value


def threshold(name: str, default: float = 90.0, env: Mapping[str, str] = os.environ) -> float:
    raw = env.get(name)
    if raw is None:
        return default
    try:
        value = float(raw)
    except ValueError:
        value = float("nan")
    if not 0 <= value <= 100:
        raise ValueError(f"{name} must be a number from 0 to 100")
    return value


@dataclass(frozen=True)
class Settings:
    """What a batch needs to know. Separate pools are used if either kind of work has a size of its own."""

    input_dir: str
    output_dir: str
    failed_dir: str
    engine: str = "paddleocr"
    fusion_threshold: float = 90.0
    workers: int = 2
    native_workers: int | None = None
    ocr_workers: int | None = None

    @property
    def separate_pools(self) -> bool:
        return self.native_workers is not None or self.ocr_workers is not None

    @classmethod
    def from_env(cls, base: str, env: Mapping[str, str] = os.environ) -> Settings:
        own = {k: positive(v, 1, env) if v in env else None for k, v in (("native_workers", "NATIVE_POOL_WORKERS"), ("ocr_workers", "OCR_POOL_WORKERS"))}
        return cls(env.get("OCR_INPUT_DIR", f"{base}/input"), f"{base}/output", f"{base}/failed", env.get("OCR_ENGINE", "paddleocr").strip().lower(), threshold("OCR_FUSION_THRESHOLD", 90.0, env), positive("OCR_WORKERS", 2, env), **own)
