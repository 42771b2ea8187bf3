"""Token lists and words held in strings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The outer characters a token list may carry, the separators between its ids, the characters of a list of ids.
OUTER_SPACE = r"^[\x00-\x20]+|[\x00-\x20]+$"
SEPARATORS = r"[,\s]+"
PLAIN = r"^[0-9+,\x00-\x20-]*\z"


def parse_id_list(text: Column) -> Column:
    """``"[1, 2, 3]"`` as ``ARRAY<INT>``.

    One opening and one closing bracket are dropped, empty pieces are skipped.
    A piece that is no 32-bit integer empties the whole list, as does NULL.
    """
    body = F.regexp_replace(text, OUTER_SPACE, "")
    body = F.regexp_replace(F.regexp_replace(body, r"^\[", ""), r"\]\z", "")
    # What a cast reads beyond plain integers holds another character; told once a list, not once a piece.
    plain = F.when(body.rlike(PLAIN), body)
    pieces = F.filter(F.split(plain, SEPARATORS), lambda piece: piece != "")
    ids = F.transform(pieces, lambda piece: piece.try_cast("int"))
    # nested in one expression, so that a list is read once and not again for its result
    whole = F.transform(F.array(ids), lambda found: F.when(~F.exists(found, F.isnull), found))
    return F.coalesce(whole[0], F.array().cast("array<int>"))


def is_bad_id_list(text: Column) -> Column:
    """True where a list has text but :func:`parse_id_list` rejects it."""
    body = F.regexp_replace(text, OUTER_SPACE, "")
    blank = body.rlike(r"^\[?[,\s]*\]?\z")
    return F.coalesce(~blank & (F.size(parse_id_list(text)) == 0), F.lit(False))


def words(text: Column) -> Column:
    """Whitespace-separated words in text order, case kept."""
    return F.filter(F.split(text, r"\s+"), lambda word: word != "")


def hash_bucket(text: Column, buckets: int) -> Column:
    """A bucket in ``0..buckets-1`` from the first 32 bits of md5; equal on every engine."""
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10)
    return head.cast("bigint") % F.lit(buckets).cast("bigint")
