"""Both stages in one call."""

from pyspark.sql import DataFrame

from seqloom.config import Settings
from seqloom.plans.prepare import prepare_examples
from seqloom.plans.train import RunTables, train
from seqloom.sources.examples import scan_examples


def prepare_and_train(
    tokens: DataFrame, embeddings: DataFrame, settings: Settings, root: str, run_id: str
) -> RunTables:
    """Examples to ``root/examples``, then the run's tables to ``root``."""
    prepare_examples(tokens, embeddings, settings, f"{root}/examples")
    examples = scan_examples(tokens.sparkSession, f"{root}/examples")
    tables, _ = train(examples, settings, root, run_id)
    return tables
