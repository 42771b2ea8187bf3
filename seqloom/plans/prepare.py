"""Token stream and embedding table to stored windows or examples."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seqloom.config import Settings
from seqloom.operators.checks import check_embeddings, require_rows, require_vectors
from seqloom.operators.examples import keep_complete, training_examples
from seqloom.operators.split import train_valid_split
from seqloom.operators.windows import sliding_window, window_rows
from seqloom.sources.embeddings import scan_embeddings_csv
from seqloom.sources.examples import write_examples, write_windows
from seqloom.sources.tokens import scan_token_lists
from seqloom.storage import stage


def read_inputs(
    spark: SparkSession, embeddings_path: str, tokens_path: str, settings: Settings, form="csv"
) -> tuple[DataFrame, DataFrame]:
    """Numbered token stream and embedding table of the two input files."""
    tokens = scan_token_lists(spark, tokens_path, form)
    embeddings = scan_embeddings_csv(spark, embeddings_path, settings.embedding_dim)
    return tokens, stage(embeddings, "embeddings")


class _Counted:
    """A stream whose rows are counted while something else reads it."""

    def __init__(self, tokens: DataFrame):
        self.plain, self._seen = tokens, Observation()
        self.rows = tokens.observe(
            self._seen,
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("token_id").isNull()).alias("null_ids"),
        )

    def require(self, written: int) -> None:
        """Raises for a stream without rows. Adaptive execution may skip a stream that gives nothing, so only then it is looked at."""
        if not written and self.plain.isEmpty():
            raise ValueError("no tokens to work on")

    def counts(self, written: int) -> dict:
        if written:
            return dict(self._seen.get)
        counts = F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("token_id").isNull()).alias("null_ids")
        return self.plain.agg(*counts).first().asDict()


def prepare_windows(tokens: DataFrame, settings: Settings, path: str) -> dict:
    """The compact output: ids only, ``embedding_dim`` times smaller than examples. Returns the counts of the stream."""
    stream = _Counted(tokens)
    rows = window_rows(sliding_window(stream.rows, settings.window_size))
    written = write_windows(rows, path, check=stream.require).rows
    return {"tokens": stream.counts(written), "windows": written}


def prepare_examples(
    tokens: DataFrame,
    embeddings: DataFrame,
    settings: Settings,
    path: str,
    strict: bool = False,
    order_by: list[str] | None = None,
    step_targets: bool = False,
) -> dict:
    """Publish ``(example_id, x, y)`` in one folder per split and return the input counts.

    Of a repeated embedding id the last by ``order_by`` is taken; without an order one raises. A vector
    of another length gives a zero row in an input matrix; as a target it cannot be learned, so such
    examples are left out and counted as ``dropped``. ``strict`` rejects such vectors instead. With
    ``step_targets`` each step of an example has its own target.

    The stream is read once: its rows are counted while the examples are made of them. An empty input
    raises before anything is published.
    """
    dim, size = settings.embedding_dim, settings.window_size
    check = check_embeddings(embeddings, dim)
    counts = {"embeddings": require_vectors(check) if strict else require_rows(check, "embeddings")}
    repeated = counts["embeddings"]["repeated_ids"]
    if repeated and not order_by:
        raise ValueError(f"{repeated} repeated embedding ids and no order to choose by")
    stream = _Counted(tokens)
    examples = training_examples(
        stream.rows, embeddings, size, dim, order_by=order_by, unique=True, step_targets=step_targets
    )
    examples = train_valid_split(
        keep_complete(examples, size, dim, step_targets),
        train_percent=settings.train_percent,
        salt=settings.split_salt,
    )
    version = write_examples(examples, path, check=stream.require)
    kept = version.rows
    counts["tokens"] = stream.counts(kept)
    counts["examples"] = {"kept": kept, "dropped": max(0, counts["tokens"]["n_rows"] - size) - kept}
    counts["splits"] = version.details
    return counts
