"""Chat formatting with a grammar round trip, in DataFrame functions only.

A formatted conversation is a row of turns, each an opening mark, a text and a closing mark:

    user       [INST] text [/INST]      (without the blanks)
    assistant  <s> text </s>
    system     [SYS] text [/SYS]
    others     [ROLE] role [TEXT] text [/ROLE]

A text that holds a mark is escaped by one backslash behind the bracket of every mark in it, and of
every mark that already has backslashes there; reading takes one away. So every text has exactly one
escaped form, and an escaped text holds no mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Role, opening and closing mark.
MARKS = (("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"), ("system", "[SYS]", "[/SYS]"))
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
LOSS_ROLE = "assistant"

_BEHIND = r"(?:/?(?:INST|SYS|ROLE)|TEXT)\]"
_ESCAPE = rf"(<(?=\\*/?s>)|\[(?=\\*{_BEHIND}))"
_UNESCAPE = rf"(<(?=\\+/?s>)|\[(?=\\+{_BEHIND}))\\"
_MARK = rf"</?s>|\[{_BEHIND}"
_TURN = r"(?s)(<s>|\[INST\]|\[SYS\]|\[ROLE\])(.*?)(</s>|\[/INST\]|\[/SYS\]|\[/ROLE\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1")


def _by_role(role: Column, place: int, other: str) -> Column:
    chosen = F.lit(other)
    for mark in MARKS:
        chosen = F.when(role == mark[0], F.lit(mark[place])).otherwise(chosen)
    return chosen


def _opening(turn: Column) -> Column:
    """The opening mark with, for other roles, the role."""
    other = F.concat(F.lit(OTHER[0]), escape(turn["role"]), F.lit(OTHER[1]))
    return F.when(turn["role"].isin([m[0] for m in MARKS]), _by_role(turn["role"], 1, "")).otherwise(other)


def _closing(turn: Column) -> Column:
    return _by_role(turn["role"], 2, OTHER[2])


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, by the grammar alone."""

    def read(opening: Column, body: Column) -> Column:
        role = F.substring_index(body, OTHER[1], 1)
        named = opening != OTHER[0]
        return F.struct(
            F.when(opening == MARKS[0][1], MARKS[0][0])
            .when(opening == MARKS[1][1], MARKS[1][0])
            .when(opening == MARKS[2][1], MARKS[2][0])
            .otherwise(unescape(role))
            .alias("role"),
            unescape(F.when(named, body).otherwise(F.substr(body, F.length(role) + F.lit(len(OTHER[1]) + 1)))).alias("text"),
        )

    return F.zip_with(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1)), F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2)), read)


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: (id, formatted, turns, mask).

    Rows are taken by turn, equal turns by role and text; repeated rows are turns of their own. Null
    texts and roles are empty, null turns come first and a null id is a conversation of its own. An
    empty table gives no rows. Other columns are not read. A single conversation is one value, which
    must fit a task.

    Every turn is rendered, read back by ``parse`` and compared; a turn that is not identical, or whose
    text holds a mark, is escaped. The whole conversation is then read back from ``formatted`` into
    ``turns``; if it still differs, all its turns are escaped, and a difference that is left is an
    error. ``mask`` has the runs (chars, loss) of ``formatted`` in code points: the loss falls on the
    assistant's texts without their marks.
    """
    turn = F.col("turn")
    source = rows.select(
        F.col(conv_col).alias("id"),
        F.struct(F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")).alias("turn"),
        F.col(turn_col).alias("place"),
    )
    marked = source.withColumn("opening", _opening(turn)).withColumn("closing", _closing(turn)).withColumn("safe", escape(turn["text"]))
    read = marked.withColumn("read", parse(F.concat("opening", turn["text"], "closing")))
    alone = (F.size("read") == 1) & (F.get("read", F.lit(0)) == turn) & ~turn["text"].rlike(_MARK)
    ready = read.withColumn("body", F.when(alone, turn["text"]).otherwise(F.col("safe")))
    # place, role and text stand first and so give the order
    row = F.struct("place", "turn", "opening", "body", "safe", "closing")
    chats = ready.groupBy("id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    first = chats.withColumn("formatted", _joined("body")).withColumn("turns", parse(F.col("formatted")))
    same = F.col("turns") == F.col("rows")["turn"]
    sure = first.select(
        "id",
        "rows",
        same.alias("same"),
        F.when(same, F.col("formatted")).otherwise(_joined("safe")).alias("formatted"),
    ).withColumn("turns", parse(F.col("formatted")))
    checked = F.when(F.col("turns") == F.col("rows")["turn"], F.col("turns")).otherwise(F.raise_error(F.lit("a conversation does not read back")))
    runs = F.transform(
        "rows",
        lambda r: F.array(
            F.struct(F.length(r["opening"]).alias("chars"), F.lit(False).alias("loss")),
            F.struct(F.length(F.when(F.col("same"), r["body"]).otherwise(r["safe"])).alias("chars"), (r["turn"]["role"] == LOSS_ROLE).alias("loss")),
            F.struct(F.length(r["closing"]).alias("chars"), F.lit(False).alias("loss")),
        ),
    )
    return sure.select(F.col("id").alias(conv_col), "formatted", checked.alias("turns"), F.flatten(runs).alias("mask"))


def _joined(body: str) -> Column:
    return F.array_join(F.transform("rows", lambda r: F.concat(r["opening"], r[body], r["closing"])), "")
