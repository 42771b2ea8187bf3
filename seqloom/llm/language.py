"""Language identification by Bayesian fusion of text, declared language, address suffix and host."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from seqloom.llm.urls import host_of, path_of
from seqloom.storage import stage

#: Labelled rows that the text model is fitted on, shared by the languages, and the rows that each may have at least: the bound of the training sample.
TRAIN_ROWS = 4000
LEAST_SAMPLE = 300
#: A language needs so many rows of the whole table, or this share of a small one.
LEAST_ROWS = 20
LEAST_SHARE = 0.005
#: Places of the hashed character trigrams.
SLOTS = 1 << 16
SMOOTHING = 0.05
#: Neighbouring trigrams repeat each other: a text never counts as more than so many independent ones.
MOST_EVIDENCE = 100
#: Any other language: letters at random, of so many equally likely trigrams, with a prior of its own.
OTHER = "und"
OTHER_TRIGRAMS = 27**3
OTHER_PRIOR = 0.01
#: Pseudo-counts: a host starts as its parent domain seen so often, a hint as an unknown one.
HOST_WEIGHT = 20.0
HINT_WEIGHT = 5.0
#: A document stays if its best language is a known one with this probability.
LEAST_PROBABILITY = 0.5


class TextModel(NamedTuple):
    languages: list[str]
    log_likelihood: np.ndarray  # (SLOTS, languages)

    def score(self, text: str) -> np.ndarray:
        """Log likelihood of a text by language, ``OTHER`` last; all zero for a text without letters."""
        slots = trigrams(text)
        total = np.zeros(len(self.languages) + 1)
        if len(slots):
            total[:-1] = self.log_likelihood[slots].sum(axis=0, dtype=np.float64)
            total[-1] = -len(slots) * np.log(OTHER_TRIGRAMS)
            total *= min(len(slots), MOST_EVIDENCE) / len(slots)
        return total


def trigrams(text: str) -> np.ndarray:
    """Places of the character trigrams of the lower-cased letters; anything else is a blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letters = ((codes >= 97) & (codes <= 122)) | ((codes >= 0xC0) & (codes != 0xD7) & (codes != 0xF7) & ((codes < 0x2000) | (codes > 0x2BFF)))
    codes = np.concatenate([[32], np.where(letters, codes, 32), [32]]).astype(np.uint32)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    # a blank between blanks says nothing, nor does a middle blank: its neighbours have trigrams of their own
    some = b != 32
    mixed = (a[some] * np.uint32(0x9E3779B1)) ^ (b[some] * np.uint32(0x85EBCA77)) ^ (c[some] * np.uint32(0xC2B2AE3D))
    return (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(16)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", rows: int = TRAIN_ROWS) -> TextModel:
    """A text model of every label with enough rows, from a sample of each, chosen by a hash.

    Labels are counted over all rows. Each has an even part of ``rows`` in the sample, or LEAST_SAMPLE
    if that is more. Counts are summed in the tasks, so the driver gets some rows of counts per
    language. Rows without a label or text are not chosen; without any labelled row the model knows
    no language.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(text_col).alias("text")).where("label is not null and text <> ''")
    by_count = stage(chosen.groupBy("label").count(), "language-labels")
    seen = by_count.agg(F.sum("count")).first()[0] or 0
    enough = by_count.where(F.col("count") >= min(LEAST_ROWS, LEAST_SHARE * seen))
    part = max(rows // max(enough.count(), 1), LEAST_SAMPLE)
    # about twice the rows wanted are near; of those the first of each label are taken
    near = F.least(F.lit(1.0), F.lit(2.0 * part) / F.col("count")) * (1 << 30)
    place = F.pmod(F.xxhash64("id", "label", "text"), F.lit(1 << 30))
    chosen = chosen.withColumn("place", place).join(F.broadcast(enough.select("label", near.alias("near"))), "label").where("place <= near")
    first = F.row_number().over(Window.partitionBy("label").orderBy("place", "id", "text"))
    chosen = chosen.withColumn("first", first).where(F.col("first") <= part).select("label", "text")

    def count(batches):
        last, sums = None, None
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if label != last:
                    if sums is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([sums.tobytes()])], ["label", "counts"])
                    last, sums = label, np.zeros(SLOTS, np.int64)
                sums += np.bincount(trigrams(text.as_py()), minlength=SLOTS)
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([sums.tobytes()])], ["label", "counts"])

    by_label: dict[str, np.ndarray] = {}
    for label, counts in chosen.mapInArrow(count, "label string, counts binary").collect():
        by_label[label] = by_label.get(label, 0) + np.frombuffer(counts, np.int64)
    languages = sorted(k for k in by_label if by_label[k].any())
    table = np.array([by_label[k] for k in languages]).reshape(len(languages), SLOTS) + SMOOTHING
    return TextModel(languages, np.log(table / table.sum(axis=1, keepdims=True)).T.astype(np.float32).copy())


def text_scores(rows: DataFrame, model: TextModel, text_col: str) -> DataFrame:
    """``rows`` without the text but with ``scores``, the log likelihoods, and ``letters``, whether there are any."""
    kept = [c for c in rows.columns if c != text_col]
    fields = [rows.schema[c] for c in kept] + [T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("letters", T.BooleanType())]
    model = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [model.value.score(t.as_py() or "") for t in batch.column(batch.schema.get_field_index(text_col))]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns += [pa.array([s.tolist() for s in scores], pa.list_(pa.float64())), pa.array([bool(s.any()) for s in scores], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "scores", "letters"])

    return rows.mapInArrow(run, T.StructType(fields))


def address_suffix(url: Column) -> Column:
    """What an address says of its language: the first folder if it has two letters, else the last host label; else null."""
    folder = F.lower(F.regexp_extract(path_of(url), r"^/([A-Za-z]{2})(?:[-_/]|$)", 1))
    last = F.regexp_extract(host_of(url), r"\.([a-z]{2,})(?::\d+)?$", 1)
    return F.when(folder != "", folder).when(last != "", last)


def declared_language(html: Column) -> Column:
    """The language that a page's markup declares, without its region; else null."""
    found = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,8})""", 1))
    return F.when(found != "", found)


def page_text(html: Column) -> Column:
    """What a page says without its markup, scripts, styles and comments."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def _counts(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``votes``: for each key the number of rows by best language of the text."""
    votes = F.array(*(F.count(F.when(F.col("vote") == k, 1)).cast("double") for k in range(size)))
    return rows.where("vote is not null").groupBy(*keys).agg(votes.alias("votes"))


def _smoothed(votes: Column, parent: Column, weight: float) -> Column:
    total = F.aggregate(votes, F.lit(0.0), lambda a, v: a + v)
    return F.zip_with(votes, parent, lambda v, p: (v + F.lit(weight) * p) / (total + F.lit(weight)))


def host_priors(rows: DataFrame, size: int, weight: float = HOST_WEIGHT) -> DataFrame:
    """(host, prior): the shares of languages of each host, smoothed towards its parent domains and all rows.

    ``rows`` has host and vote. Counts are taken per host first, so however many rows a host has, one
    per task is shuffled; hosts then add to their parents. A parent is the host without its first
    label. From all rows downwards, each level is (count + weight * level above) / (total + weight).
    """
    counts = stage(_counts(rows.where("host is not null"), ["host"], size), "language-hosts")
    labels = F.split("host", r"\.")
    levels = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    steps = counts.select("host", "votes", F.posexplode(levels).alias("level", "node"))
    sums = F.array(*(F.sum(F.col("votes")[k]) for k in range(size)))
    nodes = steps.groupBy("node").agg(sums.alias("sums"))
    everything = counts.agg(*(F.coalesce(F.sum(F.col("votes")[k]), F.lit(0.0)) for k in range(size))).first()
    whole = np.array(everything, float)
    base = (whole + 1.0) / (whole.sum() + size)
    path = steps.join(nodes, "node").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("level", "sums"))).alias("path"))
    prior = F.aggregate("path", F.array(*(F.lit(float(p)) for p in base)), lambda above, step: _smoothed(step["sums"], above, weight))
    return path.select("host", prior.alias("prior"))


def _hints(rows: DataFrame, hint: str, size: int) -> DataFrame:
    """(hint, support): for each value of a hint, log P(value | language), up to a common factor.

    By Bayes' rule this is P(language | value) / P(language), both smoothed.
    """
    counts = stage(_counts(rows.where(F.col(hint).isNotNull()), [hint], size), f"language-{hint}")
    whole = np.array(counts.agg(*(F.coalesce(F.sum(F.col("votes")[k]), F.lit(0.0)) for k in range(size))).first(), float)
    base = (whole + 1.0) / (whole.sum() + size)
    share = F.array(*(F.lit(float(p)) for p in base))
    support = F.zip_with(_smoothed(F.col("votes"), share, HINT_WEIGHT), share, lambda p, q: F.log(p / q))
    return counts.select(hint, support.alias(f"{hint}_support"))


def identify(
    rows: DataFrame,
    model: TextModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared: Column | None = None,
    suffix: Column | None = None,
    host: Column | None = None,
    label: Column | None = None,
) -> DataFrame:
    """(id, language, probability, text_language, kept) for every row of ``rows``.

    The posterior of a language is its likelihood of the whole text times the prior of the host and
    the support of the declared language and of the address suffix. Priors and supports come from
    counts over all rows of the languages that texts alone speak for. A null hint or host says
    nothing. A text without letters, a best language of probability below LEAST_PROBABILITY, or
    ``OTHER`` as best is rejected (``kept`` false), unless it has letters and a ``label``, a language
    as in training, of which there is no model; ties go to the first language by name. Repeated
    rows are judged each time, null ids like others, an empty table gives no rows. Columns of
    ``rows`` that are not named here are not read.
    """
    names = [*model.languages, OTHER]
    size = len(model.languages)
    null = F.lit(None).cast("string")
    hints = {"declared": declared, "suffix": suffix, "host": host}
    unjudged = F.lit(False) if label is None else label.isNotNull() & ~F.coalesce(label.cast("string").isin(model.languages), F.lit(False))
    source = rows.select(
        F.col(id_col).alias("id"), unjudged.alias("unjudged"), F.col(text_col).alias("text"), *((null if c is None else c.cast("string")).alias(n) for n, c in hints.items())
    )
    scored = text_scores(source, model, "text")
    best = F.array_position("scores", F.array_max("scores")) - 1
    scored = stage(scored.withColumn("vote", F.when(F.col("letters") & (best < size), best)), "language-scores")
    if not size:
        return scored.select(F.col("id").alias(id_col), F.lit(OTHER).alias("language"), F.lit(1.0).alias("probability"), F.lit(None).cast("string").alias("text_language"), (F.col("unjudged") & F.col("letters")).alias("kept"))
    flat = F.array(*(F.lit(0.0) for _ in range(size)))
    even = F.array(*(F.lit(1.0 / size) for _ in range(size)))
    fused = scored
    for hint in ("declared", "suffix"):
        if hints[hint] is not None:
            fused = fused.join(_hints(scored, hint, size), hint, "left")
        else:
            fused = fused.withColumn(f"{hint}_support", flat)
    if host is not None:
        fused = fused.join(host_priors(scored.select("host", "vote"), size), "host", "left")
    else:
        fused = fused.withColumn("prior", even)
    # for languages and the unknown one: score + log prior + supports
    priors = F.transform(F.coalesce("prior", even), lambda p: F.log(p * F.lit(1 - OTHER_PRIOR)))
    parts = [F.concat(priors, F.array(F.log(F.lit(OTHER_PRIOR))))]
    parts += [F.concat(F.coalesce(f"{h}_support", flat), F.array(F.lit(0.0))) for h in ("declared", "suffix")]
    logs = F.col("scores")
    for part in parts:
        logs = F.zip_with(logs, part, lambda a, b: a + b)
    fused = fused.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    mass = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    known = F.array(*(F.lit(n) for n in names))
    probability = F.lit(1.0) / mass
    language = F.element_at(known, F.array_position("logs", F.col("top")).cast("int"))
    kept = F.col("letters") & (F.col("unjudged") | (language != OTHER) & (probability >= LEAST_PROBABILITY))
    return fused.select(
        F.col("id").alias(id_col),
        language.alias("language"),
        probability.alias("probability"),
        F.when(F.col("vote").isNotNull(), F.element_at(known, F.col("vote").cast("int") + 1)).alias("text_language"),
        kept.alias("kept"),
    )
