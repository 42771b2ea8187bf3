"""Array expressions over ``ARRAY<FLOAT>`` vectors."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: base of the positional angles.
ANGLE_BASE = 10000.0

# Largest method that HotSpot compiles, and the setting of Spark that keeps to it.
HOTSPOT_METHOD_BYTES = 8000
HUGE_METHOD_KEY = "spark.sql.codegen.hugeMethodLimit"


def vector_columns(df: DataFrame, prefix: str = "embedding") -> list[str]:
    """Names of the wide vector columns, in schema order."""
    return [name for name in df.columns if name.startswith(prefix)]


def pack_vector(*columns: str | Column) -> Column:
    """Wide numeric columns as one float32 vector; NULL becomes 0."""
    cells = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.array(*[F.coalesce(c.cast("float"), F.lit(0.0).cast("float")) for c in cells])


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def positional_encoding(position: Column, dim: int) -> Column:
    """Sine/cosine encoding of a position inside the window (Vaswani et al. 2017)."""

    def cell(i):
        even = i - i % 2
        angle = position.cast("double") / F.pow(F.lit(ANGLE_BASE), even / F.lit(float(dim)))
        return F.when(i % 2 == 0, F.sin(angle)).otherwise(F.cos(angle)).cast("float")

    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), cell)


def position_code(position: int, dim: int) -> Column:
    """The encoding of a known position; Catalyst folds it to one constant array."""
    cells = []
    for i in range(dim):
        angle = f"{float(position)}D / pow({ANGLE_BASE}D, {2 * (i // 2) / dim}D)"
        cells.append(f"cast({'cos' if i % 2 else 'sin'}({angle}) as float)")
    return F.expr(f"array({', '.join(cells)})")


def vector_add(vec: Column, other: Column, dim: int) -> Column:
    """Element-wise sum; a vector of another length gives a zero vector."""
    total = F.zip_with(vec, other, lambda a, b: a + b)
    return F.when(F.size(vec) == dim, total).otherwise(zeros(dim))


def keep_compiled(spark: SparkSession) -> None:
    """Have Spark leave whole-stage code that the JVM would never compile.

    HotSpot interprets every method above 8,000 bytes of bytecode for good; Spark's default lets its
    generated methods grow to 65,535. Rows of some 60 columns or cells get there.
    """
    if int(spark.conf.get(HUGE_METHOD_KEY, "65535")) > HOTSPOT_METHOD_BYTES:
        spark.conf.set(HUGE_METHOD_KEY, str(HOTSPOT_METHOD_BYTES))


def to_time_series(matrix: Column, dim: int) -> Column:
    """``[T, D]`` rows as ``[D, T]``."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)), lambda k: F.transform(matrix, lambda row: row[k])
    )


def tile_target(vec: Column, steps: int) -> Column:
    """The same target at every step."""
    return F.array_repeat(vec, steps)


def step_targets(inputs: Column, target: Column) -> Column:
    """A target for each step of a window: the element that follows it, and at the last step the window's own."""
    return F.concat(F.slice(inputs, F.lit(2), F.greatest(F.size(inputs) - 1, F.lit(0))), F.array(target))


def target_series(target: Column, steps: int, dim: int, by_step: bool = False) -> Column:
    """Targets as ``[D, T]``: one vector for every step, or, with ``by_step``, the rows of a ``[T, D]`` matrix."""
    return to_time_series(target if by_step else tile_target(target, steps), dim)


def l2_norm(vec: Column) -> Column:
    square_sum = F.aggregate(
        vec, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.sqrt(square_sum)
