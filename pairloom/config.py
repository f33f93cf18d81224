"""Settings as frozen dataclasses; a bad combination fails when the object is built."""

from __future__ import annotations

from dataclasses import dataclass, field

# The operating defaults that results depend on, here and as defaults of the classes below.
DEFAULT_SYSTEM = "You are a helpful assistant."
SELECTION_SEED = 42
TRAINING_SEED = 18072005
READY_AT = 50


def _not_negative(name: str, value: float | None) -> None:
    if value is not None and value < 0:
        raise ValueError(f"{name} must not be negative, got {value}")


@dataclass(frozen=True)
class Fields:
    """Names of the mapped columns in the caller's data; ``key`` is a unique row key, if any."""

    prompt: str = "instruction"
    chosen: str = "output"
    rejected: str | None = None
    key: str | None = None

    @property
    def names(self) -> list[str]:
        return [n for n in (self.prompt, self.chosen, self.rejected) if n is not None]


PAIR_FIELDS = Fields("prompt", "chosen", "rejected")


@dataclass(frozen=True)
class Selection:
    max_samples: int | None = None
    shuffle: bool = True
    seed: int = SELECTION_SEED

    def __post_init__(self) -> None:
        _not_negative("max_samples", self.max_samples)


@dataclass(frozen=True)
class Request:
    """One chat call. ``system=None`` sends the user message alone."""

    model: str = "llama-3.2-1b-instruct"
    system: str | None = DEFAULT_SYSTEM
    temperature: float = 1.1
    max_tokens: int = 4000
    top_p: float = 0.95


# The sampling settings of the smoke check that follows training.
SMOKE_REQUEST = Request(system=None, temperature=0.7, max_tokens=256, top_p=0.9)


@dataclass(frozen=True)
class Generation:
    """``concurrency`` is the number of tasks that call the generator at the same time (None: the
    session's shuffle partitions). ``waves`` cuts a long run into separately committed jobs."""

    request: Request = field(default_factory=Request)
    max_retries: int = 3
    retry_delay: float = 2.0
    request_timeout: float = 60
    concurrency: int | None = None
    waves: int = 1

    def __post_init__(self) -> None:
        _not_negative("max_retries", self.max_retries)
        _not_negative("retry_delay", self.retry_delay)
        if self.concurrency is not None and self.concurrency < 1:
            raise ValueError("concurrency must be at least 1")
        if self.waves < 1:
            raise ValueError("waves must be at least 1")


@dataclass(frozen=True)
class Quality:
    """Thresholds of the cascade. None or 0 switches a length rule off."""

    min_rejected_length: int | None = 20
    min_length_ratio: float | None = 0.1
    skip_if_too_similar: bool = True
    similarity_threshold: float | None = 0.85

    def __post_init__(self) -> None:
        if self.skip_if_too_similar and self.similarity_threshold is None:
            raise ValueError("skip_if_too_similar needs a similarity_threshold")


@dataclass(frozen=True)
class Training:
    fields: Fields = PAIR_FIELDS
    split: str = "train"
    max_samples: int | None = None
    family: str = "llama"
    system: str = DEFAULT_SYSTEM
    eval_split: float | None = 0.05
    seed: int = TRAINING_SEED
    batch_size: int = 2
    accumulation: int = 8
    epochs: int = 2
    warmup_ratio: float = 0.1
    max_length: int = 4200
    beta: float = 0.125
    loss_type: str = "sigmoid"

    def __post_init__(self) -> None:
        _not_negative("max_samples", self.max_samples)
        if self.eval_split is not None and self.eval_split >= 1:
            raise ValueError("eval_split is a fraction below 1")
        if self.loss_type not in ("sigmoid", "ipo", "hinge"):
            raise ValueError(f"unknown loss type {self.loss_type!r}")
