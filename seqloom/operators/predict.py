"""Model output for stored examples."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from seqloom.functions import lstm


def matrices(column: pa.Array, dim: int) -> np.ndarray:
    """A list-of-lists Arrow column as ``[n, T, D]`` without a copy per row; raises on rows of another shape."""
    steps = pc.max(pc.list_value_length(column)).as_py() or 0
    _require_length(column, steps, "matrices of another height")
    _require_length(column.flatten(), dim, "matrix rows of another length")
    values = column.flatten().flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1, dim)


def vectors(column: pa.Array, dim: int) -> np.ndarray:
    _require_length(column, dim, "vectors of another length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def targets(column: pa.Array, dim: int) -> np.ndarray:
    """``[n, D]``, or ``[n, T, D]`` where every step has a target of its own."""
    by_step = pa.types.is_list(column.type.value_type)
    return matrices(column, dim) if by_step else vectors(column, dim)


def _require_length(column: pa.Array, length: int, what: str) -> None:
    same = pc.sum(pc.equal(pc.list_value_length(column), length)).as_py() or 0
    if same != len(column):
        raise ValueError(f"{len(column) - same} {what}")


def as_matrices(values: np.ndarray) -> pa.Array:
    n, steps, dim = values.shape
    inner = pa.ListArray.from_arrays(
        pa.array(np.arange(0, n * steps * dim + 1, dim, dtype=np.int32)),
        pa.array(values.reshape(-1).astype(np.float32, copy=False)),
    )
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, n * steps + 1, steps, dtype=np.int32)), inner
    )


def predict(examples: DataFrame, flat: np.ndarray, dim: int, hidden: int) -> DataFrame:
    """``(example_id, y, p)``: one predicted vector per step. ``flat`` is the model, no data."""
    model = examples.sparkSession.sparkContext.broadcast(flat)

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrices(batch.column("x"), dim)
            p = as_matrices(lstm.predict(model.value, x, hidden))
            yield pa.RecordBatch.from_arrays(
                [batch.column("example_id"), batch.column("y"), p], ["example_id", "y", "p"]
            )

    y = examples.schema["y"].dataType.simpleString()
    return examples.select("example_id", "x", "y").mapInArrow(
        run, f"example_id bigint, y {y}, p array<array<float>>"
    )
