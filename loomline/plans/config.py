"""Settings of a pipeline run; they live on the driver."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields
from pathlib import Path
from typing import Any

FORMATS = ("sharegpt", "alpaca", "openai")
STEPS = ("md_processing", "qdrant_search", "conversation_generation", "dataset_generation", "quality_validation")
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")


@dataclass
class BatchConfig:
    """Batching, concurrency, back-pressure, degradation, timeouts and retries. :meth:`validate` isn't called by itself."""

    # The settings' names and defaults.
    batch_size: int = 32
    min_batch_size: int = 16
    max_batch_size: int = 100
    max_concurrent: int = 8
    max_queue_size: int = 1000
    enable_backpressure: bool = True
    backpressure_threshold: float = 0.8
    backpressure_delay: float = 0.1
    enable_graceful_degradation: bool = True
    degradation_threshold: float = 0.9
    degradation_factor: float = 0.5
    task_timeout: float = 300.0
    batch_timeout: float = 600.0
    max_retries: int = 3
    retry_delay: float = 1.0
    retry_backoff_factor: float = 2.0

    def problems(self) -> list[str]:
        """All broken rules in the order in which they are checked; a NaN ratio is broken."""
        out = []
        if self.batch_size < self.min_batch_size or self.batch_size > self.max_batch_size:
            out.append(f"batch_size must lie within {self.min_batch_size} and {self.max_batch_size}")
        if self.max_concurrent < 1:
            out.append("max_concurrent must be at least 1")
        ratios = ("backpressure_threshold", "degradation_threshold", "degradation_factor")
        out += [f"{name} must lie strictly between 0 and 1" for name in ratios if not 0.0 < getattr(self, name) < 1.0]
        return out

    def validate(self) -> None:
        """ValueError for the first broken rule."""
        if found := self.problems():
            raise ValueError(found[0])

    def retry_delays(self) -> list[float]:
        return [self.retry_delay * self.retry_backoff_factor**k for k in range(self.max_retries)]


@dataclass
class PipelineConfig:
    """One run of the pipeline."""

    project_name: str = "dataset"
    project_version: str = "1.0.0"
    target_count: int = 5000
    output_directory: str = "./output/datasets"
    md_staging_path: str = "./md_staging"
    md_output_path: str = "./output"
    max_seq_length: int = 8192
    formats: list[str] = field(default_factory=lambda: list(FORMATS))
    train_test_split: float = 0.9
    min_quality_score: float = 0.7
    max_similarity_threshold: float = 0.9
    safety_threshold: float = 0.1
    enable_auto_correction: bool = True
    test_mode: bool = False
    sample_size: int = 100
    verbose: bool = False
    progress_bar: bool = True
    log_level: str = "INFO"
    log_file: str = "dataset_generation.log"
    steps: list[str] = field(default_factory=lambda: list(STEPS))
    #: A folder ``<section>/page_<digits>.json``: only pages with such a sidecar are taken; and a Parquet table ``vec_id, embedding``.
    sidecar_path: str | None = None
    vectors_path: str | None = None
    top_k: int = 5
    batch: BatchConfig = field(default_factory=BatchConfig)
    #: Settings this engine has no use for (services it doesn't call) are kept as they are.
    other: dict[str, Any] = field(default_factory=dict)

    def problems(self) -> list[str]:
        out = [f"{n} must be positive" for n in ("target_count", "max_seq_length", "sample_size", "top_k") if getattr(self, n) < 1]
        out += [f"{n} must lie between 0 and 1" for n in ("train_test_split", "min_quality_score", "max_similarity_threshold", "safety_threshold") if not 0.0 <= getattr(self, n) <= 1.0]
        out += [f"format {f!r} is not supported" for f in self.formats if str(f).lower() not in FORMATS]
        out += [f"step {s!r} doesn't exist" for s in self.steps if s not in STEPS]
        if str(self.log_level).upper() not in LOG_LEVELS:
            out.append(f"log level {self.log_level!r} doesn't exist")
        return out + self.batch.problems()


def _scalar(text: str) -> Any:
    text = text.strip()
    if text[:1] in "\"'" and text[:1]:
        return text[1 : text.index(text[0], 1)]
    text = text.split(" #", 1)[0].strip()
    if text.startswith("[") and text.endswith("]"):
        return [_scalar(x) for x in text[1:-1].split(",") if x.strip()]
    low = text.lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("", "null", "~"):
        return None
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


def read_flat_yaml(text: str) -> dict[str, Any]:
    """The part of YAML that settings need: ``key: value`` lines, flow lists and lists of scalars below a key."""
    out: dict[str, Any] = {}
    key = None
    for n, line in enumerate(text.splitlines(), 1):
        bare = line.strip()
        if not bare or bare.startswith("#"):
            continue
        if bare.startswith("- "):
            if key is None:
                raise ValueError(f"line {n}: a list item without key")
            if out[key] is None:
                out[key] = []
            out[key].append(_scalar(bare[2:]))
        elif ":" in bare and line[0] not in " \t":
            key, _, value = bare.partition(":")
            out[key] = _scalar(value)
        else:
            raise ValueError(f"line {n}: neither a setting nor a list item")
    return out


def load_config(path: str) -> PipelineConfig:
    got = read_flat_yaml(Path(path).read_text(encoding="utf-8"))
    known, batch = {f.name for f in fields(PipelineConfig)} - {"other", "batch"}, {f.name for f in fields(BatchConfig)}
    other = {k: v for k, v in got.items() if k not in known | batch}
    return PipelineConfig(**{k: v for k, v in got.items() if k in known}, batch=BatchConfig(**{k: v for k, v in got.items() if k in batch}), other=other)


def validate_config_file(path: str) -> list[str]:
    """What is wrong with a settings file; nothing if it is sound."""
    if not Path(path).exists():
        return [f"{path} doesn't exist"]
    try:
        return load_config(path).problems()
    except (ValueError, TypeError) as e:
        return [str(e)]


def create_default_config(path: str) -> None:
    lines = []
    for k, v in asdict(PipelineConfig()).items():
        if k in ("other", "batch") or v is None:
            continue
        shown = "[" + ", ".join(f'"{x}"' for x in v) + "]" if isinstance(v, list) else f'"{v}"' if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)
        lines.append(f"{k}: {shown}")
    Path(path).write_text("\n".join(lines) + "\n", encoding="utf-8")
