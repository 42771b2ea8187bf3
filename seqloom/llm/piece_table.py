"""Fill-in-middle by piece tables: descriptors over immutable text and sentinel buffers, in DataFrame functions.

A document never changes. It is a list of descriptors (buffer, start, length) in code points; cutting
splits a descriptor in two, an arrangement lists descriptors in another order with sentinels between
them, and only reading a table (``read``) makes a string of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sentinels and the shares of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SHARE = 90
SPM_SHARE = 20

#: The buffer of all sentinels; a sentinel is a descriptor over it.
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT, MARKS = 0, 1
#: The parts of a document in the order in which they stand in the text.
PARTS = (PREFIX, MIDDLE, SUFFIX)
#: The parts of each form in the order in which they are written; plain documents are not cut.
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN = "plain"
#: Three parts and their sentinels.
MOST_PIECES = 2 * len(PARTS)


def piece(buffer: int, start: Column, length: Column) -> Column:
    return F.struct(F.lit(buffer).alias("buffer"), start.cast("int").alias("start"), length.cast("int").alias("length"))


def sentinel(mark: str) -> Column:
    return piece(MARKS, F.lit(SENTINELS.index(mark)), F.lit(len(mark)))


def whole(text: Column) -> Column:
    """The descriptor of an uncut text."""
    return piece(TEXT, F.lit(0), F.length(text))


def cut(descriptor: Column, *places: Column) -> Column:
    """``descriptor`` split after each of the ascending ``places`` (code points from its start) into one more descriptors, some of which may be empty."""
    bounds = [F.lit(0), *(p.cast("int") for p in places), descriptor["length"]]
    pairs = zip(bounds, bounds[1:], strict=False)
    return F.array(
        *(F.struct(descriptor["buffer"].alias("buffer"), (descriptor["start"] + low).alias("start"), (high - low).alias("length")) for low, high in pairs)
    )


def arrange(pieces: Column, form: str) -> Column:
    """The three ``pieces`` (prefix, middle, suffix) in the order of ``form``, each behind its sentinel."""
    out = []
    for mark in ORDER[form]:
        out += [sentinel(mark), pieces[PARTS.index(mark)]]
    return F.array(*out)


def inverse(pieces: Column, form: str) -> Column:
    """The descriptors of ``arrange`` in the order of the text again, without sentinels."""
    place = {mark: k for k, mark in enumerate(ORDER[form])}
    return F.array(*(pieces[2 * place[mark] + 1] for mark in PARTS))


def read(pieces: Column, text: Column) -> Column:
    """The string that a table of at most MOST_PIECES descriptors stands for, slice by slice in the order of the table."""
    slices = []
    for k in range(MOST_PIECES):
        p = F.get(pieces, F.lit(k))
        buffer = F.when(p["buffer"] == TEXT, text).otherwise(F.lit(SENTINELS))
        slices.append(F.when(p.isNull(), "").otherwise(F.substring(buffer, p["start"] + 1, p["length"])))
    return F.concat(*slices)


def reparse(output: Column, form: str) -> Column:
    """The table that ``output`` was written from, over the output itself as text buffer: its sentinels are searched from left to right."""
    found = []
    starts = [F.locate(mark, output) for mark in ORDER[form]]
    ends = [*(s - 1 for s in starts[1:]), F.length(output)]
    for mark, start, end in zip(ORDER[form], starts, ends, strict=True):
        at = start - 1 + len(mark)
        found += [piece(TEXT, start - 1, F.lit(len(mark))), piece(TEXT, at, end - at)]
    return F.array(*found)


def _draws(key: Column) -> list[Column]:
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars, pieces and output.

    The draws h1 to h4 come from the id alone, so a retry cuts the same. The prefix ends after the
    smaller of h1 % (n + 1) and h2 % (n + 1) code points, the middle after the larger. A text that is
    empty, holds a sentinel or draws h3 % 100 >= SHARE stays plain: one descriptor, null prefix_chars
    and middle_chars. A null text is an empty one. A null id draws like an empty id. Rows that repeat
    an id are cut alike if their texts are. Long texts are read slice by slice, never word by word.
    An empty table gives no rows. Columns with the names of new ones are replaced, all others stay.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = _draws(F.col(id_col))
    n = F.length(text)
    own = [c for c in docs.columns if c not in ("n", "form", "prefix_chars", "middle_chars", "pieces", "output", text_col, id_col)]
    # one projection per step, so that a step's columns are computed once
    rows = docs.select(id_col, text_col, *own, text.alias("_fim_text"), n.cast("long").alias("n"), *(h.alias(f"_fim_h{k}") for k, h in enumerate((h1, h2, h3, h4))))
    holds = F.lit(False)
    for mark in PARTS:
        holds = holds | F.contains(F.col("_fim_text"), F.lit(mark))
    places = [F.col(f"_fim_h{k}") % (F.col("n") + 1) for k in (0, 1)]
    form = F.when((F.col("n") == 0) | holds | (F.col("_fim_h2") % 100 >= SHARE), PLAIN).when(F.col("_fim_h3") % 100 < SPM_SHARE, "spm").otherwise("psm")
    rows = rows.withColumns({"form": form, "_fim_whole": whole(F.col("_fim_text"))})
    parts = cut(F.col("_fim_whole"), F.least(*places), F.greatest(*places))
    rows = rows.withColumn("_fim_parts", F.when(F.col("form") != PLAIN, parts))
    pieces = F.when(F.col("form") == PLAIN, F.array("_fim_whole"))
    for name in ORDER:
        pieces = pieces.when(F.col("form") == name, arrange(F.col("_fim_parts"), name))
    rows = rows.withColumn("pieces", pieces).withColumn("output", read(F.col("pieces"), F.col("_fim_text")))
    length = lambda k: F.get("_fim_parts", F.lit(k))["length"].cast("long")
    new = ["n", "form", length(0).alias("prefix_chars"), length(1).alias("middle_chars"), "pieces", "output"]
    return rows.select(*(c for c in docs.columns if c in (id_col, text_col, *own)), *new)


def restore(rows: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """``rows`` with the column ``name``: the text that ``fill_in_middle`` took, from output and form alone.

    Null for a null output or an unknown form. A column ``name`` is replaced, all others stay.
    """
    steps = rows.drop(name)
    for column, step in (("_fim_found", reparse), ("_fim_order", inverse)):
        source = F.col(output if step is reparse else "_fim_found")
        made = F.when(F.col(form) == PLAIN, F.array(whole(F.col(output))))
        for known in ORDER:
            made = made.when(F.col(form) == known, step(source, known))
        steps = steps.withColumn(column, made)
    text = F.when(F.col("_fim_order").isNotNull(), read(F.col("_fim_order"), F.col(output)))
    return steps.withColumn(name, text).drop("_fim_found", "_fim_order")
