"""Run settings."""

from dataclasses import dataclass


# Run metrics order rows by one number that leaves so many places for workers.
MOST_WORKERS = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Sizes and training knobs of one run.

    ``averaging_frequency`` is the number of mini-batches a worker takes
    between two parameter averages. ``None`` averages once per epoch, which is
    the setting for large data: a round is one Spark job.

    ``workers`` train side by side; by default one for each scan partition of the
    examples, at most ``most_workers``. So what an average adds up is bounded by a
    setting and follows neither the table nor the executors that happen to be there.
    """

    # Default sizes and seed of a run.
    embedding_dim: int = 50
    window_size: int = 4
    hidden_size: int = 128
    batch_size: int = 32
    epochs: int = 5
    train_percent: int = 80
    averaging_frequency: int | None = None
    workers: int | None = None
    most_workers: int = 4096
    weighted_average: bool = False
    learning_rate: float = 1e-3
    seed: int = 12345
    split_salt: str = "split"

    def __post_init__(self):
        for name in ("embedding_dim", "window_size", "hidden_size", "batch_size", "epochs"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if not 0 < self.train_percent < 100:
            raise ValueError("train_percent must lie between 1 and 99")
        if self.averaging_frequency is not None and self.averaging_frequency < 1:
            raise ValueError("averaging_frequency must be at least 1 or None")
        if self.workers is not None and not 1 <= self.workers < MOST_WORKERS:
            raise ValueError(f"workers must be at least 1 and below {MOST_WORKERS}, or None")
        if not 1 <= self.most_workers < MOST_WORKERS:
            raise ValueError(f"most_workers must be at least 1 and below {MOST_WORKERS}")
