"""I-Match fingerprints: terms of a band of inverse document frequencies, hashed by randomised lexicons.

After Chowdhury et al. (2002) and Kolcz et al. (2004), in DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.operators.index import sequence_index
from seqloom.storage import stage

#: Terms are runs of letters and digits, lower-cased.
_TERM = r"[\p{L}\p{N}]+"
#: The band: a term is in the lexicon if it stands in at least one document of MOST_IDF and in at most
#: one of LEAST_IDF. As a document counts once for each of its different terms, at most (their mean
#: number) * MOST_IDF terms reach the lower end, whatever the number of documents.
LEAST_IDF, MOST_IDF = 10, 8192
#: Randomised lexicons: ORDERS independent pairs at each of the densities 1/2, 1/4, ..., 2**-LEVELS.
#: Sparse ones tell what long documents share, dense ones short documents.
ORDERS, LEVELS = 8, 11
#: A pair is what one more bit of a term's hash makes of the first lexicon of the denser pair.
_HALVES = {"set": "=", "other": "<>"}
#: Hex digits of the hash of a randomised lexicon; that of all terms has 16.
DIGITS = 4
#: The lexicon is broadcast while its counted bytes stay below; beyond, the join shuffles both sides.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Bytes of a broadcast term besides its own.
TERM_BYTES = 64
#: An id is hot when its rows fill more than 1/HOT_SHARE of an even partition: there are fewer than HOT_SHARE for each partition.
HOT_SHARE = 4


def terms(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0)))


def lexicon(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, documents) of the terms in the band, counted over all rows of ``docs``; a stored table.

    Rows with a null or empty text count as documents without a term.
    """
    total = docs.count()
    counts = docs.select(F.explode(terms(F.col(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("documents"))
    inside = (F.col("documents") * MOST_IDF >= total) & (F.col("documents") * LEAST_IDF <= total)
    return stage(counts.where(inside), "imatch-lexicon")


def _known(words: DataFrame, limit: int) -> DataFrame:
    size = words.agg(F.sum(F.octet_length("term") + TERM_BYTES)).first()[0] or 0
    known = words.select("term", F.lit(True).alias("_known"))
    return F.broadcast(known) if size <= limit else known.hint("merge")


def fingerprints(
    texts: DataFrame, words: DataFrame, keys: list[str], text_col: str = "text", carry: tuple[str, ...] = (), limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``keys``, ``carry`` and ``fingerprint`` of every row of ``texts``, whose keys are unique.

    The different terms of a text that stand in the lexicon ``words`` are sorted and hashed, first all
    of them, then those of each randomised lexicon. At level l, those hold a term the last l - 1 bits of
    whose r-th hash are zero and the bit before is zero, or is one; so level l + 1 lies within the first
    of level l. A lexicon with no term of the text gives an empty hash. A text with terms but none in the band has one hash of the set of all its terms; one without any
    term, null or empty, has an empty first hash, too.

    Rows that are already dealt by some of ``keys`` stay where they are, as the lexicon comes to them.
    """
    rows = texts.withColumn("_terms", terms(F.col(text_col)))
    # an order-free hash of the whole set
    whole = F.expr("aggregate(_terms, 0L, (h, t) -> h ^ xxhash64(t))")
    # the first row of a text stands for it: it alone holds what is carried, and no lexicon knows its term
    carried = F.struct(whole.alias("whole"), (F.size("_terms") > 0).alias("any"), *carry)
    salt = F.concat(F.lit(" "), F.pmod(F.xxhash64(*keys), F.lit(1024)).cast("string"))
    rows = rows.withColumn("_first", F.struct(salt.alias("term"), carried.alias("carried")))
    others = F.expr("transform(coalesce(_terms, array()), t -> struct(t as term, if(false, _first.carried, null) as carried))")
    rows = rows.select(*keys, F.explode(F.concat(F.array("_first"), others)).alias("_row"))
    rows = rows.select(*keys, F.col("_row.term").alias("term"), F.col("_row.carried").alias("_carried"))
    rows = rows.join(_known(words, limit), "term", "left").where("_known or _carried is not null")
    kept = F.sort_array(F.collect_list(F.expr("if(_carried is null, term, null)"))).alias("_kept")
    rows = rows.groupBy(*keys).agg(kept, F.first("_carried", ignorenulls=True).alias("_carried"))
    return _hashed(rows, keys, carry)


def _hashed(rows: DataFrame, keys: list[str], carry: tuple[str, ...]) -> DataFrame:
    """The hashes of ``_kept``; each step is a projection of its own, so that a level filters what the one above left."""
    whole = "lpad(hex(if(size(_kept) > 0, xxhash64(_kept), _carried.whole)), 16, '0')"
    rows = rows.select(
        *keys,
        *(F.col(f"_carried.{c}").alias(c) for c in carry),
        F.expr(f"if(coalesce(_carried.any, false), {whole}, '')").alias("_prints"),
        *(F.expr(f"transform(_kept, t -> xxhash64({r}, t))").alias(f"_set{r}") for r in range(ORDERS)),
    )
    # the last digits, under a leading one that keeps their zeros
    room = 1 << 4 * DIGITS
    for level in range(LEVELS):
        halves = [F.expr(f"filter(_set{r}, h -> (h & {1 << level}) {half} 0)").alias(f"_{name}{r}") for name, half in _HALVES.items() for r in range(ORDERS)]
        rows = rows.select(*keys, *carry, "_prints", *halves)
        shorts = [
            F.expr(f"if(size(_{name}{r}) > 0, substr(hex((xxhash64(_{name}{r}) & {room - 1}) + {room}), 2), '')") for name in _HALVES for r in range(ORDERS)
        ]
        rows = rows.select(*keys, *carry, F.concat_ws(",", "_prints", *shorts).alias("_prints"), *(f"_set{r}" for r in range(ORDERS)))
    return rows.select(*keys, *carry, F.lower("_prints").alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal hashes among the lexicons that hold a term of either text: 0 to 1, and 1 for two texts without terms."""
    pairs = F.zip_with(F.split(a, ","), F.split(b, ","), lambda x, y: F.when((x != "") | (y != ""), x == y))
    told, same = F.size(F.filter(pairs, lambda p: p.isNotNull())), F.size(F.filter(pairs, lambda p: p))
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(told == 0, 1.0).otherwise(same / told)


def match_next(docs: DataFrame, words: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Every row of ``docs``, a stored table, held against its edited text and the next document.

    The next document is the one with the next greater id; the first follows the last. The edited text
    has its last floor(n / 2) code points replaced by the first as many, or all, of the next document.
    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    A null text is empty. Of the rows that share an id, the one with the smallest hash of its text is
    the next document for the id before; each of them is edited with the same next document. A row
    without an id has none: its edited text is its first half and near_next is null. One single id
    follows itself. An empty table gives no rows. Other columns are not read.

    Texts are dealt by id once and beginnings of texts go to the document before; hot ids are salted. Each
    text is hashed once, but for rows that repeat an id.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a join of ids that may be null filters one of its sides, and texts would be dealt anew for the other
    known = F.col(id_col).isNotNull().alias("known")
    key = F.coalesce(F.col(id_col), F.lit(0).cast(docs.schema[id_col].dataType)).alias("id")
    rows = docs.select(key, known, F.coalesce(text_col, F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "row"))["row"].alias("row")
    ids = rows.where("known").groupBy("id").agg(F.count("*").alias("copies"), first, F.max(F.length("text")).alias("longest"))
    numbered = stage(sequence_index(ids, ["id"]), "imatch-ids")
    count, total = numbered.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    salts = F.ceil(F.col("copies") * (HOT_SHARE * parts) / F.lit(max(total, 1))).cast("int").alias("salts")
    # there are fewer than HOT_SHARE * parts of them
    hot = stage(numbered.where((F.col("copies") > 1) & (F.col("copies") * (HOT_SHARE * parts) > total)).select("id", salts), "imatch-hot")

    def salted(side: DataFrame, row: str) -> DataFrame:
        place = F.pmod(F.xxhash64(row), F.when(F.col("known"), F.coalesce("salts", F.lit(1))).otherwise(F.lit(parts)))
        place = F.coalesce(F.when(F.col("known"), place).otherwise(-1 - place).cast("int"), F.lit(0))
        return side.join(F.broadcast(hot), "id", "left").withColumn("salt", place).drop("salts")

    before = numbered.select("idx", F.col("id").alias("previous"), "longest")
    after = numbered.select(F.pmod(F.col("idx") - 1, F.lit(max(count, 1))).alias("idx"), "id", F.col("row").alias("next_row"))
    links = stage(salted(after.join(before, "idx").withColumn("known", F.lit(True)), "next_row").drop("idx", "known"), "imatch-links")
    # rows without an id have negative salts, which no link has
    rows = salted(rows, "row").drop("known")
    # no third key of the join, so that both joins deal texts alike and one exchange of them serves both
    here = (rows["id"] == links["id"]) & (rows["salt"] == links["salt"]) & (F.abs(rows["row"] - links["next_row"]) < 1)
    starts = rows.join(links, here).select(rows["id"], rows["salt"], "row", "text", "previous", F.expr("substr(text, 1, longest div 2)").alias("start"))
    prints = fingerprints(starts, words, ["id", "salt"], carry=("row", "previous", "start"), limit=limit)
    # a print is made once: it goes to the document before, with the beginning of the text, and back to its own
    forth = "struct(previous as to_id, true as is_next, start, cast(null as bigint) as first_row, fingerprint as print)"
    back = "struct(id as to_id, false as is_next, cast(null as string) as start, row as first_row, fingerprint as print)"
    told = f"inline(array({forth}, {back}))"
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
    messages = prints.selectExpr(told).withColumnRenamed("to_id", "id").join(F.broadcast(hot), "id", "left")
    messages = messages.select("id", copies, "is_next", "start", "first_row", "print")
    pairs = rows.join(messages, ["id", "salt"], "left").withColumn("n_chars", F.length("text").cast("long"))
    # what is left to hash: the edited text, the text of a row that repeats an id, or both for a row without an id
    kinds = "case when is_next then array('edited') when first_row = row then array('known') when first_row is not null then array('text') else array('text', 'edited') end"
    pairs = pairs.select("*", F.expr(f"explode({kinds})").alias("kind"))
    edited = "concat(substr(text, 1, int(n_chars - n_chars div 2)), coalesce(substr(start, 1, int(n_chars div 2)), ''))"
    pairs = pairs.withColumn("version", F.expr(f"case kind when 'edited' then {edited} when 'text' then text else '' end"))
    carried = {
        "edited_sha256": "if(kind = 'edited', sha2(version, 256), null)",
        "next_print": "if(kind = 'edited', print, null)",
        "own_print": "if(kind = 'known', print, null)",
    }
    pairs = pairs.withColumns({c: F.expr(e) for c, e in carried.items()})
    keys = ["id", "salt", "row", "kind"]
    prints = fingerprints(pairs, words, keys, "version", ("n_chars", *carried), limit)
    # all that belongs to a row lies in one task
    joined = prints.groupBy("id", "salt", "row").agg(
        F.max("n_chars").alias("n_chars"),
        F.max("edited_sha256").alias("edited_sha256"),
        F.max("next_print").alias("next_print"),
        F.max(F.expr("case kind when 'known' then own_print when 'text' then fingerprint end")).alias("fingerprint"),
        F.max(F.expr("if(kind = 'edited', fingerprint, null)")).alias("edited_fingerprint"),
    )
    own = F.col("fingerprint")
    return joined.select(
        F.when(F.col("salt") >= 0, F.col("id")).alias(id_col),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(own, F.col("next_print")).alias("near_next"),
    )
