"""Secret scan: candidates by pattern, false positives removed by a random forest, in DataFrame functions only."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import bounded_sample
from seqloom.storage import stage

#: Characters of the shortest candidate.
LEAST_CHARS = 16
#: Candidates longer than this may be files in text form; their features are taken all the same.
CONTEXT_CHARS = 40
#: Times a word must occur in the corpus to be in the dictionary, and its shortest length.
LEAST_TIMES = 5
LEAST_WORD = 3
#: Findings of each label that the forest is fitted on, and its size: the bound of the training sample.
TRAIN_ROWS = 20_000
TREES = 20
DEPTH = 6
SEED = 7
#: A candidate is a secret with this probability.
LEAST_PROBABILITY = 0.5

_CHAR = "[A-Za-z0-9+/_-]"
#: A run of key characters with a digit or with a capital behind a small letter.
_CANDIDATE = rf"(?<!{_CHAR})(?={_CHAR}*(?:[0-9]|[a-z][A-Z])){_CHAR}{{{LEAST_CHARS},}}={{0,2}}"
_SPLIT = rf"(?s)(.*?)({_CANDIDATE}|\z)"
_MAYBE = rf"{_CHAR}{{{LEAST_CHARS}}}"
_LETTERS = r"[^a-zà-öø-ÿ]+"

#: Words beside a secret, words beside other strings of that form, folders of samples, and forms that only secrets have.
_FOR = r"(?i)(token|secret|passw|pwd|api.?key|auth|credential|private|bearer|access.?key)\W*\w*\W*$"
_AGAINST = r"(?i)(sha\d*|md5|commit|hash|checksum|digest|uuid|guid|etag|revision|build|version|integrity)\W*\w*\W*$"
_SAMPLES = r"(?i)(^|[/_.-])(tests?|examples?|samples?|fixtures?|mocks?|docs?|vendor)([/_.-]|$)"
_SURE = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]+|sk_live_[A-Za-z0-9]+|AIza[A-Za-z0-9_-]{35})$"

FEATURES = (
    "length", "digits", "capitals", "smalls", "marks", "turns", "variety", "hex", "sure", "transitions", "coverage",
    "assigned", "quoted", "words_for", "words_against", "path_depth", "path_sample",
)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(id, path, start, secret, before, after) of every candidate; starts count code points from 0.

    A text is cut into pieces that each end with a candidate, the last one with the text, so starts
    are sums of lengths and the pattern never fails over the rest of a text. ``before`` is the text in
    front of a candidate, also where it is a candidate itself, as long names of variables are.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    pieces = docs.where(F.col(text_col).rlike(_MAYBE)).select(
        F.col(id_col).alias("id"),
        path.alias("path"),
        F.regexp_extract_all(text_col, F.lit(_SPLIT), F.lit(1)).alias("gaps"),
        F.regexp_extract_all(text_col, F.lit(_SPLIT), F.lit(2)).alias("found"),
    )
    lengths = F.zip_with("gaps", "found", lambda g, f: F.length(g) + F.length(f))
    none = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("ends"))

    def add(so_far: Column, length: Column) -> Column:
        end = so_far["sum"] + length
        return F.struct(end.alias("sum"), F.concat(so_far["ends"], F.array(end)).alias("ends"))

    pieces = pieces.where(F.size("found") > 1).withColumn("ends", F.aggregate(lengths, none, add)["ends"])

    def end_of(piece: Column) -> Column:
        return F.coalesce(F.substring(piece, -CONTEXT_CHARS, CONTEXT_CHARS), F.lit(""))

    def before(k: Column) -> Column:
        # candidates are context too; so many of the shortest have CONTEXT_CHARS characters
        back = range(-(-CONTEXT_CHARS // LEAST_CHARS), 0, -1)
        pieces_before = [end_of(F.get(part, k - n + shift)) for n in back for part, shift in (("found", 0), ("gaps", 1))]
        return end_of(F.concat(*pieces_before))

    def candidate(k: Column) -> Column:
        secret = F.get("found", k)
        return F.struct(
            (F.get("ends", k) - F.length(secret)).cast("long").alias("start"),
            secret.alias("secret"),
            before(k).alias("before"),
            F.substring(F.get("gaps", k + 1), 1, 1).alias("after"),
        )

    every = F.transform(F.sequence(F.lit(0), F.size("found") - 2), candidate)
    return pieces.select("id", "path", F.inline(every)).where("secret <> ''")


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, times): words of letters of all texts, in lower case, that occur LEAST_TIMES times or more."""
    words = docs.select(F.explode(F.split(F.lower(text_col), _LETTERS)).alias("word")).where(F.length("word") >= LEAST_WORD)
    return words.groupBy("word").agg(F.count("*").alias("times")).where(F.col("times") >= LEAST_TIMES)


def transitions(words: DataFrame) -> DataFrame:
    """(pair, weight): log probability of the second letter behind the first, over the dictionary's occurrences.

    Pairs are at most those of the ASCII and Latin-1 letters, some thousands, so the table is small.
    """
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    pairs = words.select("word", "times", at.alias("k")).select(F.substr("word", F.col("k"), F.lit(2)).alias("pair"), "times")
    sums = pairs.groupBy("pair").agg(F.sum("times").alias("n")).withColumn("first", F.substring("pair", 1, 1))
    whole = sums.groupBy("first").agg(F.sum("n").alias("all"))
    return sums.join(whole, "first").select("pair", F.log(F.col("n") / F.col("all")).alias("weight"))


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("secret", f"[^{pattern}]", "")) / F.length("secret")


def _count(column: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(column, F.lit(f"({pattern})"), F.lit(1)))


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns of FEATURES, each row once.

    Coverage and transitions are functions of the candidate's string, so they are computed once per
    different string: its pieces of letters meet the dictionary, its letter pairs the small table.
    """
    strings = stage(found.select("secret").distinct(), "secret-strings")
    apart = F.regexp_replace("secret", "([a-zà-öø-ÿ])([A-Z])", "$1 $2")
    pieces = strings.select("secret", F.explode(F.split(F.lower(apart), _LETTERS)).alias("word")).where(F.length("word") >= LEAST_WORD)
    covered = pieces.join(words.select("word"), "word").groupBy("secret").agg(F.sum(F.length("word")).alias("covered"))
    pairs = F.regexp_extract_all(F.lower("secret"), F.lit("(?=([a-z][a-z]))"), F.lit(1))
    weights = strings.select("secret", F.explode(pairs).alias("pair")).join(F.broadcast(transitions(words)), "pair", "left")
    weights = weights.groupBy("secret").agg(F.avg(F.coalesce("weight", F.lit(-12.0))).alias("weight"))
    known = strings.join(covered, "secret", "left").join(weights, "secret", "left")
    rows = found.join(known, "secret")
    turns = F.lit("(?=([a-z][^a-z]|[A-Z][^A-Z]|[0-9][^0-9]))")
    return rows.select(
        *found.columns,
        F.length("secret").cast("double").alias("length"),
        _share("0-9").alias("digits"),
        _share("A-Z").alias("capitals"),
        _share("a-z").alias("smalls"),
        _share("+/_=-").alias("marks"),
        (F.size(F.regexp_extract_all("secret", turns, F.lit(1))) / F.length("secret")).alias("turns"),
        (F.size(F.array_distinct(F.split("secret", ""))) / F.length("secret")).alias("variety"),
        F.col("secret").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex"),
        F.col("secret").rlike(_SURE).cast("double").alias("sure"),
        F.coalesce("weight", F.lit(-6.0)).alias("transitions"),
        (F.coalesce("covered", F.lit(0)) / F.length("secret")).alias("coverage"),
        F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        (F.col("before").rlike("[\"']$") & F.col("after").isin("'", '"')).cast("double").alias("quoted"),
        F.col("before").rlike(_FOR).cast("double").alias("words_for"),
        F.col("before").rlike(_AGAINST).cast("double").alias("words_against"),
        _count(F.col("path"), "/").cast("double").alias("path_depth"),
        F.col("path").rlike(_SAMPLES).cast("double").alias("path_sample"),
    )


def plain_labels(rows: DataFrame) -> DataFrame:
    """Labelled findings where no reviewed ones are at hand: the rows whose case is clear, with ``label``.

    A secret has a form that only secrets have, or is assigned to a name for secrets and has digits. No
    secret is what stands by a name of other strings, is a number, or is made of words.
    """
    yes = (F.col("sure") == 1) | ((F.col("words_for") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0))
    no = (F.col("words_against") == 1) | (F.col("digits") >= 0.95) | (F.col("coverage") >= 0.6) | (F.col("digits") == 0)
    label = F.when(yes & ~(F.col("words_against") == 1), 1.0).when(no & ~yes, 0.0)
    return rows.withColumn("label", label).where("label is not null")


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(rows)


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """A forest from at most ``rows`` findings of each label (FEATURES and ``label``), chosen by a hash; the two classes weigh the same.

    None if the findings do not have both labels, at any size of the table.
    """
    known = labelled.select("label", *FEATURES)
    chosen = stage(bounded_sample(known.where("label = 0"), rows).unionByName(bounded_sample(known.where("label = 1"), rows)), "secret-training")
    sizes = {r.label: r["count"] for r in chosen.groupBy("label").count().collect()}
    if set(sizes) != {0.0, 1.0}:
        return None
    weight = F.when(F.col("label") == 1, sum(sizes.values()) / (2 * sizes[1.0])).otherwise(sum(sizes.values()) / (2 * sizes[0.0]))
    forest = RandomForestClassifier(featuresCol="__features", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(_assembled(chosen.withColumn("weight", weight)))


def secrets(rows: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``rows`` (with FEATURES) with ``probability`` and ``is_secret``. Without a model the sure forms count alone."""
    if model is None:
        judged = rows.withColumn("probability", F.col("sure"))
    else:
        judged = model.setProbabilityCol("__probability").setRawPredictionCol("__raw").setPredictionCol("__label").transform(_assembled(rows))
        judged = judged.withColumn("probability", vector_to_array("__probability")[1]).drop("__features", "__probability", "__raw", "__label")
    return judged.withColumn("is_secret", F.col("probability") >= LEAST_PROBABILITY)


def scan(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source"
) -> DataFrame:
    """(id, start, secret, probability, is_secret) of every candidate of every whole text.

    The dictionary and the letter transitions are counted over all texts. ``labelled`` has FEATURES
    and ``label`` (1 secret, 0 not); without it, the candidates of ``docs`` whose case is clear serve
    (see ``plain_labels``). Null and empty texts have no candidates; repeated rows give theirs each
    time; null ids and paths are allowed; an empty table gives no rows. Other columns are not read.
    """
    found = stage(candidates(docs, id_col, text_col, path_col), "secret-candidates")
    words = stage(dictionary(docs, text_col), "secret-dictionary")
    rows = stage(with_features(found, words), "secret-features")
    judged = secrets(rows, fit(plain_labels(rows) if labelled is None else labelled))
    return judged.select(F.col("id").alias(id_col), "start", "secret", "probability", "is_secret")
