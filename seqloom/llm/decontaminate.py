"""Benchmark decontamination by spaced seeds and verified overlaps that tolerate substitutions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Fixed masks: word positions that are hashed; those between are ignored. Any 13 to 25 words of which SHARE are equal hold a hit of one
#: of them; so does any longer stretch, as one of its halves is such a stretch again.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8), (0, 2, 7, 9, 10, 11), (0, 1, 4, 8, 10, 12))
#: Words of the shortest overlap, and the part of them that must be equal.
LEAST_WORDS = 13
SHARE = (4, 5)
#: Items of fewer words say nothing about where a text is from.
SHORTEST_ITEM = 5
#: Bytes of benchmark text that tasks hold at a time.
BLOCK_BYTES = 16 << 20
#: Characters of one text whose words are held at a time.
TEXT_BLOCK = 1 << 20

_WORD = re.compile(r"\w+")
_SPACE = re.compile(r"\s")
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


class Overlap(NamedTuple):
    item: int
    doc_start: int
    item_start: int
    words: int
    equal: int


def words_of(text: str) -> Iterator[str]:
    """Runs of word characters of the text in lower case, block by block."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, min(at + TEXT_BLOCK, len(text)))
        end = cut.start() if cut else len(text)
        yield from _WORD.findall(text[at:end].lower())
        at = end


class TestIndex:
    """Seeds of a block of benchmark items. ``add`` order numbers the items."""

    __test__ = False

    def __init__(self, texts: list[str]):
        self.vocabulary: dict[str, int] = {}
        self.items = [self._numbers(text) for text in texts]
        self.masks: dict[tuple[int, ...], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_mask: dict[tuple[int, ...], list[int]] = {}
        for k, item in enumerate(self.items):
            if len(item) >= LEAST_WORDS:
                for mask in MASKS:
                    by_mask.setdefault(mask, []).append(k)
            elif len(item) >= SHORTEST_ITEM:
                by_mask.setdefault(tuple(range(len(item))), []).append(k)
        for mask, members in by_mask.items():
            keys, item_at, pos = [], [], []
            for k in members:
                where = np.arange(len(self.items[k]) - mask[-1])
                keys.append(seeds(self.items[k], mask, where))
                item_at.append(np.full(len(where), k))
                pos.append(where)
            order = np.argsort(np.concatenate(keys), kind="stable")
            self.masks[mask] = tuple(np.concatenate(x)[order] for x in (keys, item_at, pos))

    def _numbers(self, text: str) -> np.ndarray:
        number = self.vocabulary.setdefault
        return np.array([number(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int64)

    def read(self, text: str) -> np.ndarray:
        """A document as the numbers of its words; words of no item are 0."""
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words_of(text)), np.int64)

    def overlaps(self, text: str) -> list[Overlap]:
        doc = self.read(text)
        known = doc > 0
        lines: set[tuple[int, int]] = set()
        for mask, (keys, items, positions) in self.masks.items():
            room = len(doc) - mask[-1]
            if room <= 0:
                continue
            fits = np.logical_and.reduce([known[o : o + room] for o in mask])
            where = np.flatnonzero(fits)
            if not len(where):
                continue
            found = seeds(doc, mask, where)
            low, high = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
            for k in np.flatnonzero(high > low).tolist():
                for at in range(low[k], high[k]):
                    lines.add((int(items[at]), int(where[k]) - int(positions[at])))
        checked = (verify(doc, self.items[item], item, shift) for item, shift in sorted(lines))
        return [c for c in checked if c]


def seeds(numbers: np.ndarray, mask: tuple[int, ...], where: np.ndarray) -> np.ndarray:
    """Hashes of the words under the mask laid at each place."""
    total = np.zeros(len(where), np.uint64)
    for k, offset in enumerate(mask):
        total = (total ^ (numbers[where + offset].astype(np.uint64) * _FACTORS[k % len(_FACTORS)])) * np.uint64(0x9FB21C651E98DF25)
        total ^= total >> np.uint64(29)
    return total


def verify(doc: np.ndarray, item: np.ndarray, number: int, shift: int) -> Overlap | None:
    """The longest stretch of item and document, laid at ``shift``, of enough words with enough of them equal."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    least = min(LEAST_WORDS, len(item))
    share = SHARE if len(item) >= LEAST_WORDS else (1, 1)
    if high - low < least:
        return None
    equal = doc[low + shift : high + shift] == item[low:high]
    score = np.concatenate([[0], np.cumsum(np.where(equal, share[1] - share[0], -share[0]))])
    # the longest i < j with score[j] >= score[i]; for each j, the first i that low is found by bisection in the running minima
    first = np.searchsorted(-np.minimum.accumulate(score), -score, "left")
    lengths = np.arange(len(score)) - first
    end = int(np.argmax(lengths))
    start = int(first[end])
    if end - start < least:
        return None
    return Overlap(number, low + shift + start, low + start, end - start, int(equal[start:end].sum()))


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items in blocks of about BLOCK_BYTES; only one block is on the driver at a time."""
    items = benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull())
    size = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    count = -(-size // BLOCK_BYTES)
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64(text_col), F.lit(count)) == k) if count > 1 else items
        yield [tuple(r) for r in rows.orderBy(id_col, text_col).collect()]


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(id, item, doc_start, item_start, words, equal_words): one row per document row, item and alignment.

    Words are runs of word characters in lower case. An overlap is a stretch of at least LEAST_WORDS
    words of an item, found at the same distances in the document, of which SHARE are equal; an item
    of fewer words must occur whole and unchanged, one of less than SHORTEST_ITEM words never matches.
    Null or empty texts and items overlap with nothing; items of one text are each reported; repeated
    rows are reported each time; empty tables give no rows. Other columns are not read.

    Documents are never shuffled: every block of items, of bounded bytes, is sent to the tasks and
    the documents are read once per block.
    """
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), T.StructField("item", benchmark.schema[item_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("doc_start", "item_start", "words", "equal_words")]
    )
    spark = docs.sparkSession
    kinds = to_arrow_schema(schema)
    found = None
    for items in _blocks(benchmark, item_col, item_text_col):
        index = spark.sparkContext.broadcast(([i for i, _ in items], TestIndex([t for _, t in items])))

        def run(batches, index=index):
            names, tests = index.value
            for batch in batches:
                rows = [
                    (doc, names[o.item], o.doc_start, o.item_start, o.words, o.equal)
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                    for o in tests.overlaps(text.as_py() or "")
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], kinds.names)

        part = docs.select(id_col, text_col).mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    found = spark.createDataFrame([], schema) if found is None else found
    return found.withColumnsRenamed({"id": id_col, "item": item_col}) if id_col != item_col else found


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with no overlap with any item, all their columns as they are. No row is shuffled."""
    for items in _blocks(benchmark, item_col, item_text_col):
        index = docs.sparkSession.sparkContext.broadcast(TestIndex([t for _, t in items]))
        at = docs.columns.index(text_col)

        def run(batches, index=index, at=at):
            tests = index.value
            for batch in batches:
                clean = [not tests.overlaps(text.as_py() or "") for text in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
