"""Every operator applied to whole tables."""

import pathlib
import shutil
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.config import Settings
from seqloom.functions import lstm
from seqloom.functions import text as txt
from seqloom.functions import vectors as vec
from seqloom.operators import bucketed, checks, evaluate, examples, lookup, metrics
from seqloom.operators.index import sequence_index
from seqloom.operators.predict import predict
from seqloom.operators.split import split_label
from seqloom.operators.train import average, round_of
from seqloom.operators.windows import sliding_window, sliding_window_by_key, window_rows
from seqloom.plans.prepare import prepare_examples
from seqloom.plans.run import prepare_and_train
from seqloom.plans.train import RunTables, parameter_table, train
from seqloom.sources import embeddings as emb_source
from seqloom.sources import examples as stored
from seqloom.sources import appended, published, rejects
from seqloom.sources import tokens as token_source
from seqloom.storage import new_folder

WINDOW = 4
WIDE_WINDOW = 40
MESSY_WINDOW = 20
DIM = 64
VOCABULARY = 600
PROPS_NUMBER = r"([0-9]+)"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    vec.keep_compiled(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark, sf_dir) -> DataFrame:
    """Events as a numbered stream of user ids."""
    return token_source.token_table(table(spark, sf_dir, "events"), "event_id", "user_id")


def sparse_stream(spark, sf_dir, *keep: Column) -> DataFrame:
    """A stream in which part of the ids have no embedding; ``keep`` are more columns of the events."""
    events = table(spark, sf_dir, "events")
    token = (F.col("user_id") * 7 % VOCABULARY).cast("int")
    return events.select(F.col("event_id").alias("idx"), token.alias("token_id"), *keep)


def embedding(spark, sf_dir) -> DataFrame:
    return emb_source.embedding_table(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def word_tokens(text: str = "text") -> Column:
    """The words of a text as token ids."""
    return F.transform(
        txt.words(F.col(text)), lambda word: txt.hash_bucket(word, VOCABULARY).cast("int")
    )


def document_words(spark, sf_dir) -> DataFrame:
    """All words of all documents as one numbered stream of token ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sequence_index(docs, ["doc_id"], explode=word_tokens())
    return rows.select("idx", "doc_id", "pos", "token_id")


def spread(prefix: str, column: str, dim: int = DIM) -> list:
    """A vector as one DOUBLE column per dimension."""
    return [F.expr(f"cast({column}[{k}] as double) as {prefix}_{k}") for k in range(dim)]


def window_columns(key: list, size: int = WINDOW) -> list:
    cells = [F.col("input_tokens")[k].alias(f"w{k}") for k in range(size)]
    return [*key, *cells, F.col("target_token")]


def by_step(df: DataFrame, *keep: str) -> DataFrame:
    return df.select("example_id", *keep, F.posexplode("x").alias("step", "row"))


# --- order and windows -------------------------------------------------------------------


def sequence_index_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return sequence_index(events, ["user_id", "ts", "event_id"]).select("idx", "event_id")


def token_index_documents(spark, sf_dir):
    return document_words(spark, sf_dir)


def sliding_window_events(spark, sf_dir):
    rows = sliding_window(stream(spark, sf_dir), WINDOW)
    return rows.select(*window_columns([F.col("idx").alias("example_id")]))


def sliding_window_events_wide(spark, sf_dir):
    rows = sliding_window(stream(spark, sf_dir), WIDE_WINDOW)
    joined = F.array_join(F.col("input_tokens").cast("array<string>"), ",")
    return rows.select(F.col("idx").alias("example_id"), joined.alias("inputs"), "target_token")


def sliding_window_documents(spark, sf_dir):
    rows = sliding_window(document_words(spark, sf_dir), WINDOW)
    return rows.select(*window_columns([F.col("idx").alias("example_id")]))


def _per_user(spark, sf_dir, **options):
    rows = table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.regexp_extract("props", PROPS_NUMBER, 1).cast("int").alias("token_id"),
    )
    windows = sliding_window_by_key(rows, WINDOW, "user_id", ["event_id"], **options)
    return windows.select(*window_columns([F.col("user_id"), F.col("event_id")]))


def sliding_window_per_user(spark, sf_dir):
    return _per_user(spark, sf_dir)


def sliding_window_per_user_hot(spark, sf_dir):
    """The same with every sequence treated as oversized."""
    return _per_user(spark, sf_dir, hot_rows=0)


def sliding_window_conversation(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    tokens = turns.select(
        "conv_id", "turn", F.posexplode(word_tokens()).alias("pos", "token_id")
    )
    windows = sliding_window_by_key(tokens, WINDOW, "conv_id", ["turn", "pos"])
    return windows.select(*window_columns([F.col("conv_id"), F.col("turn"), F.col("pos")]))


# --- sources and parsing -----------------------------------------------------------------


def id_list_text() -> Column:
    """Token lists in the shapes a file may hold, one per event type."""
    number = F.regexp_extract("props", PROPS_NUMBER, 1)
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    kind = F.col("event_type")
    return (
        F.when(F.col("event_id") % 50 == 0, F.lit(" [ , ] "))
        .when(F.col("event_id") % 50 == 1, F.lit(None))
        .when(kind == "error", F.concat(F.lit("["), user, F.lit(", x, "), event, F.lit("]")))
        .when(kind == "view", F.concat(F.lit(" ["), user, F.lit(",,"), number, F.lit("] ")))
        .when(kind == "click", F.concat(user, F.lit(" "), event, F.lit(" -"), number))
        .when(kind == "purchase", F.concat(F.lit("[["), user, F.lit("]]")))
        .otherwise(F.concat(F.lit("["), user, F.lit(", "), event, F.lit("]")))
    )


def parse_id_list(spark, sf_dir):
    ids = txt.parse_id_list(id_list_text())
    rows = table(spark, sf_dir, "events").select("event_id", ids.alias("ids"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("event_id", F.size("ids").alias("n_ids"), joined.alias("ids"))


def scan_token_lists_csv(spark, sf_dir):
    """Documents written as quoted token lists in document order, then read as one stream."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _token_lists(spark, docs, ["doc_id"], "csv").select("idx", "token_id")


def scan_token_lists_text(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return _token_lists(spark, turns, ["conv_id", "turn"], "text").select("idx", "token_id")


def token_lists_appended(spark, sf_dir):
    """The same documents in two folders that come one after the other: the second is numbered from where the first ended."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    middle = docs.agg(F.max("doc_id")).first()[0] // 2
    source, path = new_folder(spark, "token_lists"), new_folder(spark, "numbered")
    for part, rows in enumerate((docs.where(F.col("doc_id") <= middle), docs.where(F.col("doc_id") > middle))):
        folder = f"{source}/part{part}"
        _write_token_lists(rows, ["doc_id"], "csv", folder)
        appended.append_token_lists(spark, folder, path)
        # a second look finds nothing new
        appended.append_token_lists(spark, folder, path)
    return appended.read_appended(spark, path)


def _token_lists(spark, rows, order_by, form):
    path = new_folder(spark, "token_lists")
    _write_token_lists(rows, order_by, form, path)
    return token_source.scan_token_lists(spark, path, form)


def _write_token_lists(rows, order_by, form, path):
    ids = F.array_join(word_tokens().cast("array<string>"), ", ")
    lists = F.concat(F.lit("["), ids, F.lit("]"))
    rows = rows.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    options = {"quoteAll": True} if form == "csv" else {"quote": "", "sep": "\t"}
    rows.select(lists.alias("tokens")).write.csv(path, header=True, **options)


def scan_embeddings_csv(spark, sf_dir):
    """Every vector written twice, a zero copy first: the later row must win."""
    rows = embedding(spark, sf_dir)
    copies = rows.select("token_id", "vec", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    cells = [
        F.when(F.col("copy") == 1, F.col("vec")[k].cast("double"))
        .otherwise(F.lit(0.0))
        .alias(f"embedding{k + 1}")
        for k in range(DIM)
    ]
    copies = copies.repartitionByRange("copy", "token_id").sortWithinPartitions("copy", "token_id")
    path = new_folder(spark, "embeddings_csv")
    copies.select(F.col("token_id").alias("tokenId"), *cells).write.csv(path, header=True)
    found = emb_source.scan_embeddings_csv(spark, path, DIM)
    return found.select("token_id", *spread("v", "vec"))


def scan_embeddings_csv_bad_ids(spark, sf_dir):
    """Every fifth id is no number: such a row is dropped."""
    rows = embedding(spark, sf_dir)
    key = F.col("token_id").cast("string")
    bad = F.when(F.col("token_id") % 5 == 0, F.concat(F.lit("x"), key)).otherwise(key)
    cells = [F.col("vec")[k].cast("double").alias(f"embedding{k + 1}") for k in range(DIM)]
    path = new_folder(spark, "embeddings_csv")
    rows.select(bad.alias("tokenId"), *cells).write.csv(path, header=True)
    found = emb_source.scan_embeddings_csv(spark, path, DIM)
    return found.select("token_id", *spread("v", "vec"))


def rejected_embedding_rows(spark, sf_dir):
    """Files in which every fifth id is no number, every seventh is missing and every third row comes twice: what is left out and why."""
    rows = embedding(spark, sf_dir)
    key = F.col("token_id").cast("string")
    bad = F.when(F.col("token_id") % 7 == 0, F.lit(None)).when(F.col("token_id") % 5 == 0, F.concat(F.lit("x"), key)).otherwise(key)
    times = F.when(F.col("token_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("token_id", F.explode(times).alias("copy"), bad.alias("tokenId"), (F.col("token_id") % 10).alias("embedding1"))
    rows = rows.repartitionByRange("token_id").sortWithinPartitions("token_id", "copy")
    path = new_folder(spark, "embeddings_csv")
    rows.select("tokenId", "embedding1").write.csv(path, header=True)
    found = rejects.scan_embeddings_csv(spark, path, 1)
    return found.rejected.select("raw", "reason", F.lit(found.kept.count()).cast("bigint").alias("kept"))


def rejected_token_lists(spark, sf_dir):
    """Token lists of events: the lines that give no ids although they hold text, and how many ids the others give."""
    path = new_folder(spark, "token_lists")
    rows = table(spark, sf_dir, "events").select("event_id", id_list_text().alias("tokens")).where("tokens is not null")
    rows = rows.repartitionByRange("event_id").sortWithinPartitions("event_id")
    rows.select("tokens").write.csv(path, header=True, quoteAll=True)
    found = rejects.scan_token_lists(spark, path, "csv")
    kept = found.kept.agg(F.count("*").alias("ids"), (F.max("idx") + 1).alias("numbered")).first()
    return found.rejected.select("raw", "reason", *(F.lit(kept[c]).cast("bigint").alias(c) for c in ("ids", "numbered")))


def rejected_examples(spark, sf_dir):
    """Examples whose target cannot be learned, and why."""
    rows = examples.training_examples(
        sparse_stream(spark, sf_dir), messy_embedding(spark, sf_dir), WINDOW, DIM, order_by=["copy"]
    )
    kept, rejected = rejects.split_examples(rows, WINDOW, DIM)
    kept = kept.select("example_id", F.lit("kept").alias("reason"))
    return rejected.unionByName(kept)


def pack_vector(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    packed = parts.select("p_partkey", vec.pack_vector("p_size", "p_retailprice").alias("vec"))
    return packed.select("p_partkey", *spread("v", "vec", 2))


def stored_windows(spark, sf_dir):
    path = new_folder(spark, "windows")
    stored.write_windows(window_rows(sliding_window(stream(spark, sf_dir), WINDOW)), path)
    rows = stored.scan_windows(spark, path)
    return rows.select(*window_columns([F.col("example_id")]))


def published_windows(spark, sf_dir):
    """Windows read through their manifest: the second version, which a third that fails half-way leaves readable."""
    path = new_folder(spark, "windows")
    windows = window_rows(sliding_window(stream(spark, sf_dir), WINDOW))
    stored.write_windows(windows.where("example_id % 2 = 0"), path)
    stored.write_windows(windows, path)
    broken = F.when(F.col("example_id") % 1000 == 999, F.raise_error(F.lit("stopped"))).otherwise(F.col("target_token"))
    try:
        stored.write_windows(windows.withColumn("target_token", broken.cast("int")), path)
    except Exception as failure:
        if "stopped" not in str(failure):
            raise
    last = published.versions(spark, path)[-1]
    rows = stored.scan_windows(spark, path)
    keys = [F.col("example_id"), F.lit(last.number).cast("bigint").alias("version"), F.lit(last.rows).cast("bigint").alias("n_rows")]
    return rows.select(*window_columns(keys))


def examples_text(spark, sf_dir):
    """Examples written as JSON lines and read back."""
    path = new_folder(spark, "examples_text")
    stored.write_examples_text(training_set(spark, sf_dir), path)
    schema = "example_id bigint, x array<array<float>>, y array<float>"
    lines = spark.read.text(path).select(F.from_json("value", schema).alias("e")).select("e.*")
    return by_step(lines, "y").select(
        "example_id", "step", *spread("x", "row"), *spread("y", "y")
    )


# --- lookups and examples ----------------------------------------------------------------


def dedupe_by_key_last(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("token_id"),
        vec.pack_vector("value").alias("vec"),
        "event_id",
    )
    last = lookup.dedupe_last(rows, ["event_id"])
    return last.select("token_id", *spread("v", "vec", 1))


def _looked_up(spark, sf_dir, **options):
    found = lookup.lookup_embedding(
        sparse_stream(spark, sf_dir), embedding(spark, sf_dir), DIM, **options
    )
    key = F.col("idx").alias("event_id")
    return found.select(key, "token_id", "hit", *spread("v", "vec"))


def lookup_embedding(spark, sf_dir):
    return _looked_up(spark, sf_dir)


def lookup_embedding_large(spark, sf_dir):
    """The same with the table taken as too large to broadcast."""
    return _looked_up(spark, sf_dir, limit=0)


def lookup_embedding_hot(spark, sf_dir):
    """A large table and a stream in which one token holds a third of the rows."""
    rows = sparse_stream(spark, sf_dir)
    token = F.when(F.col("idx") % 3 == 0, F.lit(7)).otherwise(F.col("token_id"))
    rows = rows.withColumn("token_id", token)
    found = lookup.lookup_embedding(rows, embedding(spark, sf_dir), DIM, limit=0)
    key = F.col("idx").alias("event_id")
    return found.select(key, "token_id", "hit", *spread("v", "vec"))


def lookup_embedding_bucketed(spark, sf_dir):
    """The same stream against the table stored in buckets of its id, which stays where it is."""
    rows = sparse_stream(spark, sf_dir)
    token = F.when(F.col("idx") % 3 == 0, F.lit(7)).otherwise(F.col("token_id"))
    rows = rows.withColumn("token_id", token)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"vectors_{uuid.uuid4().hex}"
    bucketed.store_bucketed(embedding(spark, sf_dir), name, DIM, parts, new_folder(spark, "buckets"))
    found = bucketed.lookup_bucketed(rows, name, DIM)
    key = F.col("idx").alias("event_id")
    return found.select(key, "token_id", "hit", *spread("v", "vec"))


def positional_encoding(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    code = vec.positional_encoding(F.col("turn"), 50)
    return turns.select("conv_id", "turn", code.alias("pe")).select(
        "conv_id", "turn", *spread("pe", "pe", 50)
    )


def training_set(spark, sf_dir, **options):
    return examples.training_examples(
        sparse_stream(spark, sf_dir), embedding(spark, sf_dir), WINDOW, DIM, **options
    )


def input_matrix(spark, sf_dir):
    rows = by_step(training_set(spark, sf_dir))
    return rows.select("example_id", "step", *spread("x", "row"))


def input_matrix_large(spark, sf_dir):
    """The same with the table taken as too large to broadcast."""
    rows = by_step(training_set(spark, sf_dir, limit=0))
    return rows.select("example_id", "step", *spread("x", "row"))


def embed_windows(spark, sf_dir):
    windows = window_rows(sliding_window(sparse_stream(spark, sf_dir), WINDOW))
    rows = examples.embed_windows(windows, embedding(spark, sf_dir), WINDOW, DIM)
    rows = by_step(rows)
    return rows.select("example_id", "step", *spread("x", "row"))


def embed_windows_large(spark, sf_dir):
    windows = window_rows(sliding_window(sparse_stream(spark, sf_dir), WINDOW))
    rows = examples.embed_windows(
        windows, embedding(spark, sf_dir), WINDOW, DIM, limit=0
    )
    rows = by_step(rows)
    return rows.select("example_id", "step", *spread("x", "row"))


def embed_windows_gaps_large(spark, sf_dir):
    """Stored windows of which some are missing, over a table taken as too large to broadcast."""
    windows = window_rows(sliding_window(sparse_stream(spark, sf_dir), WINDOW))
    windows = windows.where("example_id % 10 not in (3, 4) and example_id % 97 > 6")
    rows = by_step(examples.embed_windows(windows, embedding(spark, sf_dir), WINDOW, DIM, limit=0))
    return rows.select("example_id", "step", *spread("x", "row"))


def step_targets(spark, sf_dir):
    """Examples with a target for each step: the vector of the token that follows it."""
    rows = training_set(spark, sf_dir, step_targets=True)
    rows = rows.select("example_id", F.posexplode("y").alias("step", "row"))
    return rows.select("example_id", "step", *spread("y", "row"))


def step_target_series_large(spark, sf_dir):
    """The same as one series per dimension, stored and read back; the table is taken as too large to broadcast."""
    path = new_folder(spark, "step_examples")
    rows = training_set(spark, sf_dir, step_targets=True, limit=0)
    stored.write_examples(examples.keep_complete(rows, WINDOW, DIM, step_targets=True), path)
    rows = stored.scan_examples(spark, path, step_targets=True)
    series = vec.target_series(F.col("y"), WINDOW, DIM, by_step=True)
    rows = rows.select("example_id", F.posexplode(series).alias("dim", "steps"))
    return rows.select("example_id", "dim", *spread("t", "steps", WINDOW))


def prepare_counts(spark, sf_dir):
    """What the preparation counts of its inputs and examples while it works, one row per figure."""
    settings = Settings(embedding_dim=DIM, window_size=WINDOW)
    path = new_folder(spark, "prepared")
    counts = prepare_examples(
        sparse_stream(spark, sf_dir), messy_embedding(spark, sf_dir), settings, path, order_by=["copy"]
    )
    found = [(group, item, int(n)) for group, items in counts.items() for item, n in items.items()]
    stored_rows = stored.scan_examples(spark, path).groupBy("split").count()
    stored_rows = stored_rows.select(F.lit("stored").alias("part"), F.col("split").alias("item"), F.col("count").alias("n"))
    return spark.createDataFrame(found, "part string, item string, n bigint").unionByName(stored_rows)


def messy_embedding(spark, sf_dir) -> DataFrame:
    """Repeated ids (the last copy wins), vectors that are missing and vectors of another length."""
    vector = (
        F.when(F.col("token_id") % 7 == 0, F.lit(None))
        .when(F.col("token_id") % 11 == 0, F.slice("vec", 1, 5))
        .otherwise(F.col("vec"))
    )
    copies = F.when(F.col("token_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(1))
    )
    rows = embedding(spark, sf_dir).withColumn("copy", F.explode(copies))
    return rows.withColumn("vec", F.when(F.col("copy") == 1, vector).otherwise(F.reverse("vec")))


def _messy(spark, sf_dir, size, **options):
    rows = examples.training_examples(
        sparse_stream(spark, sf_dir),
        messy_embedding(spark, sf_dir),
        size,
        DIM,
        order_by=["copy"],
        **options,
    )
    rows = by_step(rows, "y")
    target = [F.size("y").alias("y_size"), F.col("y")[0].cast("double").alias("y_0")]
    return rows.select("example_id", "step", *target, *spread("x", "row"))


def input_matrix_messy(spark, sf_dir):
    return _messy(spark, sf_dir, WINDOW)


def input_matrix_messy_large(spark, sf_dir):
    """The same with the table taken as too large to broadcast."""
    return _messy(spark, sf_dir, WINDOW, limit=0)


def input_matrix_messy_wide(spark, sf_dir):
    """A window beyond the width up to which each place is probed."""
    return _messy(spark, sf_dir, MESSY_WINDOW)


def embed_windows_messy_large(spark, sf_dir):
    windows = window_rows(sliding_window(sparse_stream(spark, sf_dir), WINDOW))
    table = messy_embedding(spark, sf_dir)
    rows = examples.embed_windows(windows, table, WINDOW, DIM, limit=0, order_by=["copy"])
    rows = by_step(rows, "y")
    target = [F.size("y").alias("y_size"), F.col("y")[0].cast("double").alias("y_0")]
    return rows.select("example_id", "step", *target, *spread("x", "row"))


def keep_complete_examples(spark, sf_dir):
    """Examples whose target has another length are left out."""
    rows = examples.training_examples(
        sparse_stream(spark, sf_dir),
        messy_embedding(spark, sf_dir),
        WINDOW,
        DIM,
        order_by=["copy"],
    )
    kept = examples.keep_complete(rows, WINDOW, DIM)
    return kept.select("example_id", *spread("y", "y"))


def training_pairs(spark, sf_dir):
    """Examples through the stored form."""
    path = new_folder(spark, "examples")
    rows = examples.keep_complete(training_set(spark, sf_dir), WINDOW)
    stored.write_examples(rows, path)
    rows = by_step(stored.scan_examples(spark, path), "y")
    return rows.select(
        "example_id", "step", *spread("x", "row"), *spread("y", "y")
    )


def target_vector(spark, sf_dir):
    found = examples.target_vectors(sparse_stream(spark, sf_dir), embedding(spark, sf_dir), DIM)
    return found.select(F.col("idx").alias("event_id"), *spread("y", "y"))


def tile_target(spark, sf_dir):
    rows = training_set(spark, sf_dir)
    tiled = rows.select(
        "example_id", F.posexplode(vec.tile_target(F.col("y"), WINDOW)).alias("step", "row")
    )
    return tiled.select("example_id", "step", *spread("y", "row"))


def time_series_transpose(spark, sf_dir):
    rows = training_set(spark, sf_dir).select(
        "example_id", F.posexplode(vec.to_time_series(F.col("x"), DIM)).alias("dim", "steps")
    )
    return rows.select("example_id", "dim", *spread("t", "steps", WINDOW))


# --- checks, split, scores ---------------------------------------------------------------


def check_tokens(spark, sf_dir):
    return checks.check_tokens(sparse_stream(spark, sf_dir))


def check_embeddings(spark, sf_dir):
    return checks.check_embeddings(embedding(spark, sf_dir), DIM)


def check_lists(spark, sf_dir):
    return checks.check_lists(table(spark, sf_dir, "events").select(id_list_text().alias("tokens")))


def train_valid_split(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", split_label(F.col("event_id")).alias("split"))


def vector_norm(spark, sf_dir):
    rows = metrics.vector_norms(table(spark, sf_dir, "embeddings"), "embedding")
    return rows.select("vec_id", F.round("norm", 6).alias("norm"))


def persistence_forecast(spark, sf_dir, *keep: Column):
    """Stand-in model: at each step the next vector is said to equal the step's own vector. ``keep`` are columns of the events that go along."""
    rows = sparse_stream(spark, sf_dir, *keep)
    names = [c for c in rows.columns if c not in ("idx", "token_id")]
    found = lookup.lookup_embedding(rows, embedding(spark, sf_dir), DIM)
    rows = sliding_window(found, WINDOW, value="vec", inputs="p", target="y")
    return rows.select(F.col("idx").alias("example_id"), *names, "y", "p")


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def regression_eval(spark, sf_dir):
    scores = evaluate.regression_eval(persistence_forecast(spark, sf_dir))
    return rounded(scores, "mse", "rmse", "mae", "r2")


def macro_average(spark, sf_dir):
    scores = evaluate.regression_eval(persistence_forecast(spark, sf_dir))
    return rounded(evaluate.macro_average(scores), "mse", "rmse", "mae", "r2")


# --- run metrics: events as an iteration log, a day as an epoch, a user as a run --------------


def epoch_of_event() -> Column:
    """The day of an event."""
    return F.datediff("ts", F.lit("2024-01-01").cast("date")).alias("epoch")


def iteration_log(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        epoch_of_event(),
        F.col("event_id").alias("iteration"),
        F.lit(0).alias("worker"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("loss"),
        F.regexp_extract("props", PROPS_NUMBER, 1).cast("double").alias("gradient_norm"),
    )


def score_iterations(spark, sf_dir):
    rows = metrics.score_iterations(iteration_log(spark, sf_dir))
    return rows.select("run_id", "epoch", "iteration", "loss")


def epoch_spans(log: DataFrame) -> DataFrame:
    """An epoch starts with its day and ends with its last iteration."""
    start = F.date_trunc("day", F.min("ts"))
    return log.groupBy("run_id", "epoch").agg(start.alias("start_ts"), F.max("ts").alias("end_ts"))


def in_millis(rows: DataFrame) -> DataFrame:
    """Times as whole milliseconds."""
    return rows.withColumns(
        {name: F.unix_millis(name) for name in ("start_ts", "end_ts") if name in rows.columns}
    )


def throughput(spark, sf_dir):
    log = iteration_log(spark, sf_dir)
    return rounded(metrics.throughput(log, epoch_spans(log)), "iterations_per_second")


def epoch_durations(spark, sf_dir):
    return in_millis(metrics.epoch_durations(epoch_spans(iteration_log(spark, sf_dir))))


def epoch_final_metrics(spark, sf_dir):
    return metrics.epoch_final_metrics(iteration_log(spark, sf_dir))


def average_epoch_time(spark, sf_dir):
    spans = epoch_spans(iteration_log(spark, sf_dir))
    return metrics.average_epoch_time(metrics.epoch_durations(spans))


def run_summary(spark, sf_dir):
    durations = metrics.epoch_durations(epoch_spans(iteration_log(spark, sf_dir)))
    settings = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("run_id"),
        F.col("c_nationkey").alias("batch_size"),
        F.length("c_name").alias("hidden_size"),
    )
    return in_millis(metrics.run_summary(durations, settings))


def epoch_validation(spark, sf_dir):
    """Scores of the stand-in model per day, next to the day's duration.

    The day goes along with its token, four bytes a row, so that no row of vectors is shuffled to a join.
    """
    log = iteration_log(spark, sf_dir).withColumn("run_id", F.lit("all"))
    predicted = persistence_forecast(spark, sf_dir, epoch_of_event()).withColumn("run_id", F.lit("all"))
    scores = evaluate.regression_eval(predicted, by=["run_id", "epoch"])
    averages = evaluate.macro_average(scores, by=["run_id", "epoch"])
    rows = metrics.epoch_validation(averages, metrics.epoch_durations(epoch_spans(log)))
    return rounded(rows.drop("run_id", "dims", "r2_dims"), "mse", "rmse", "mae", "r2")


def parameter_norms(spark, sf_dir):
    """Consecutive vectors as the parameters of consecutive epochs."""
    params = table(spark, sf_dir, "embeddings").select(
        F.lit("all").alias("run_id"),
        F.col("vec_id").alias("epoch"),
        F.lit(0).alias("layer"),
        F.lit("weight").alias("name"),
        F.posexplode("embedding").alias("param_idx", "value"),
    )
    rows = metrics.parameter_norms(params).drop("run_id")
    return rounded(rows, "parameter_norm", "parameter_update")


def layer_info(spark, sf_dir):
    """Vector elements as parameters of the layer their label names; some layers are unknown."""
    params = table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("layer"), F.explode("embedding").alias("value")
    )
    layers = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("int").alias("layer"),
        F.col("r_name").alias("kind"),
        F.lit(DIM).alias("n_in"),
        F.lit(DIM).alias("n_out"),
        F.lit("tanh").alias("activation"),
    )
    return metrics.layer_info(params, layers)


# --- training ----------------------------------------------------------------------------


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python tasks of the session."""
    if getattr(spark.sparkContext, "_seqloom_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parents[2]
    target = tempfile.mkdtemp(prefix="seqloom-zip-")
    archive = shutil.make_archive(f"{target}/seqloom_tasks", "zip", root, "seqloom")
    spark.sparkContext.addPyFile(archive)
    spark.sparkContext._seqloom_shipped = True


def formula_parameters(dim: int, hidden: int) -> np.ndarray:
    """Parameters that SQL can write, too."""
    place = np.arange(lstm.size(dim, hidden))
    return ((place * 37 % 101 - 50) / 500).astype(np.float32)


def predict_untrained(spark, sf_dir):
    """Scores of a model of one hidden unit whose parameters come from a formula."""
    ship_package(spark)
    predicted = predict(training_set(spark, sf_dir), formula_parameters(DIM, 1), DIM, 1)
    scores = evaluate.macro_average(evaluate.regression_eval(predicted))
    return scores.withColumns({name: F.round(name, 4) for name in ("mse", "rmse", "mae", "r2")})


def train_metrics(spark, sf_dir):
    """Prepare and train on the whole stream; the rows each epoch trained on, and what it scored."""
    ship_package(spark)
    settings = Settings(embedding_dim=DIM, window_size=WINDOW, epochs=2)
    root = new_folder(spark, "run")
    tables = prepare_and_train(
        stream(spark, sf_dir), embedding(spark, sf_dir), settings, root, "events"
    )
    trained = tables.iterations(spark).groupBy("epoch").agg(F.sum("n").alias("rows_trained"))
    scored = tables.epochs(spark).where("mse > 0 and duration_ms > 0").select("epoch", "dims")
    return trained.join(scored, "epoch")


def train_resumed(spark, sf_dir):
    """One run of two epochs, and one that stops after the first and is resumed: rows per epoch, and how far their parameters are apart."""
    ship_package(spark)
    root = new_folder(spark, "resume")
    settings = Settings(embedding_dim=DIM, window_size=WINDOW, hidden_size=4, epochs=2, batch_size=64)
    tokens, vectors = stream(spark, sf_dir), embedding(spark, sf_dir)
    tables = prepare_and_train(tokens, vectors, settings, root, "whole")
    rows = stored.scan_examples(spark, f"{root}/examples")
    train(rows, replace(settings, epochs=1), root, "cut")
    # what a run that is cut short in its second epoch leaves behind
    half = F.col("run_id") == "cut"
    for name, known, below in (("workers", tables.iterations(spark), "/round=0"), ("params", tables.params(spark), "")):
        known.filter(half).drop("run_id", "epoch", "round").limit(3).write.parquet(f"{root}/{name}/run_id=cut/epoch=2{below}")
    seen = tables.iterations(spark).filter(half).agg(F.max("epoch")).first()[0]
    train(rows, settings, root, "cut", resume=True)
    trained = tables.iterations(spark).groupBy("epoch", "run_id").agg(F.sum("n").alias("n"))
    trained = trained.groupBy("epoch").agg(*(F.max(F.when(F.col("run_id") == r, F.col("n"))).alias(f"rows_{r}") for r in ("whole", "cut")))
    params = tables.params(spark).groupBy("epoch", "layer", "name", "param_idx")
    gap = params.agg((F.max("value") - F.min("value")).cast("double").alias("gap"), F.count("*").alias("runs"))
    gap = gap.groupBy("epoch").agg(F.max("gap").alias("largest_gap"), F.min("runs").alias("runs"), F.count("*").alias("parameters"))
    return trained.join(gap, "epoch").withColumn("epochs_before", F.lit(seen).cast("int"))


def worker_outputs(spark, sf_dir) -> DataFrame:
    """Every vector as the parameters that a worker returns, a label as its number of rows."""
    return table(spark, sf_dir, "embeddings").select(
        (F.col("label") + 1).cast("bigint").alias("n"),
        F.col("vec_id").alias("iteration"),
        F.col("embedding").alias("params"),
        F.transform("embedding", lambda x: x * x).alias("m"),
        F.transform("embedding", F.abs).alias("v"),
    )


def average_parameters(spark, sf_dir):
    """Plain and weighted means of the workers."""
    outputs = worker_outputs(spark, sf_dir)
    plain = average(outputs).select("pos", *(F.col(c).cast("double") for c in ("params", "m", "v")), "step")
    heavy = average(outputs, weighted=True)
    weighted = heavy.select("pos", *(F.col(c).cast("double").alias(f"weighted_{c}") for c in ("params", "m", "v")))
    names = [f"{w}{c}" for w in ("", "weighted_") for c in ("params", "m", "v")]
    return rounded(plain.join(weighted, "pos"), *names)


def round_plan(spark, sf_dir):
    """The averaging round of every example."""
    events = table(spark, sf_dir, "events")
    return events.select("event_id", round_of(F.col("event_id"), 7).alias("round"))


def stored_model(spark, sf_dir):
    """An average written as a parameter table and read back."""
    settings = Settings(embedding_dim=1, hidden_size=3)
    root = new_folder(spark, "model")
    averaged = average(worker_outputs(spark, sf_dir))
    parameter_table(averaged, settings).write.parquet(f"{root}/params/run_id=all/epoch=1")
    rows = RunTables(root).params(spark)
    return rows.select(
        "epoch", "layer", "name", "param_idx", "step", F.round(F.col("value").cast("double"), 6).alias("value")
    )


def stored_stats(spark, sf_dir):
    """The reports of one run written and read back, one row per figure."""
    root = new_folder(spark, "stats")
    log = iteration_log(spark, sf_dir).withColumn("run_id", F.lit("all"))
    log = log.withColumn("learning_rate", F.col("loss") / 4).withColumn("round", F.lit(0))
    log.write.partitionBy("run_id", "epoch", "round").parquet(f"{root}/workers")
    epoch_spans(log).write.partitionBy("run_id", "epoch").parquet(f"{root}/epochs")
    scores = log.groupBy("run_id", "epoch").agg(
        F.count("*").alias("dims"), F.max("loss").alias("mse"), F.min("loss").alias("mae")
    )
    scores.write.partitionBy("run_id", "epoch").parquet(f"{root}/scores")
    knobs = log.select("run_id", F.lit(32).alias("batch_size"), F.lit(9).alias("hidden_size"))
    knobs.limit(1).write.partitionBy("run_id").parquet(f"{root}/settings")
    tables = RunTables(root)
    tables.write_stats(spark, "all")
    found = []
    for report, names in STATS.items():
        rows = in_millis(spark.read.parquet(f"{root}/stats/{report}"))
        epoch = F.col("epoch").cast("int") if "epoch" in rows.columns else F.lit(0)
        figures = [F.col(name).cast("double").alias(name) for name in names]
        rows = rows.select(F.lit(report).alias("report"), epoch.alias("epoch"), *figures)
        found.append(rows.unpivot(["report", "epoch"], names, "item", "value"))
    rows = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
    return rounded(rows, "value")


#: The figures of each report.
STATS = {
    "epochs": ["duration_ms", "dims", "mse", "mae"],
    "final_metrics": ["loss", "learning_rate", "gradient_norm"],
    "throughput": ["iterations", "iterations_per_second"],
    "summary": ["start_ts", "end_ts", "total_minutes", "epochs", "average_epoch_ms", "batch_size", "hidden_size"],
}


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        sequence_index_events,
        token_index_documents,
        sliding_window_events,
        sliding_window_events_wide,
        sliding_window_documents,
        sliding_window_per_user,
        sliding_window_per_user_hot,
        sliding_window_conversation,
        parse_id_list,
        scan_token_lists_csv,
        scan_token_lists_text,
        token_lists_appended,
        scan_embeddings_csv,
        scan_embeddings_csv_bad_ids,
        rejected_embedding_rows,
        rejected_token_lists,
        rejected_examples,
        pack_vector,
        stored_windows,
        published_windows,
        examples_text,
        dedupe_by_key_last,
        lookup_embedding,
        lookup_embedding_large,
        lookup_embedding_hot,
        lookup_embedding_bucketed,
        positional_encoding,
        input_matrix,
        input_matrix_large,
        embed_windows,
        embed_windows_large,
        embed_windows_gaps_large,
        step_targets,
        step_target_series_large,
        prepare_counts,
        input_matrix_messy,
        input_matrix_messy_large,
        input_matrix_messy_wide,
        embed_windows_messy_large,
        keep_complete_examples,
        training_pairs,
        target_vector,
        tile_target,
        time_series_transpose,
        check_tokens,
        check_embeddings,
        check_lists,
        train_valid_split,
        vector_norm,
        regression_eval,
        macro_average,
        score_iterations,
        throughput,
        epoch_durations,
        epoch_final_metrics,
        average_epoch_time,
        run_summary,
        epoch_validation,
        parameter_norms,
        layer_info,
        predict_untrained,
        train_metrics,
        train_resumed,
        average_parameters,
        round_plan,
        stored_model,
        stored_stats,
    )
}
