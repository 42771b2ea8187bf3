"""Packing of documents into token windows by multiway differencing."""

from __future__ import annotations

import heapq
import os
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CAPACITY = 2048
#: Tokens of the pieces that the end of a document is cut into.
PIECE = 512
#: Windows that are balanced together. A partition wastes less than one window, a batch some tokens.
WINDOWS = 256
#: Words whose ids a Python worker remembers.
WORDS = 1_000_000
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Letters up to here have the same lower case in any library.
_LAST_PLAIN = "ÿ"


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, by the tokenizer, word by word.

    The tokenizer cuts at white space before it merges, so a text's ids are those of its words. A
    word is encoded once and remembered; with WORDS words known, further ones are encoded each time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True

    def __call__(self, texts: list[str]) -> list[bytes]:
        words = [text.replace("\n", " ").split(" ") for text in texts]
        new = set().union(*words).difference(self.known)
        lookup = self.known
        if new:
            found = self._encoded(new)
            if len(self.known) < WORDS:
                self.known.update(found)
            else:
                lookup = _Both(found, self.known)
        return [b"".join(map(lookup.__getitem__, w)) for w in words]

    def _encoded(self, new: set[str]) -> dict[str, bytes]:
        """Ids of words, and of those words in lower case without a comma or point behind them."""
        plain, other, cut = set(), set(), []
        for word in new:
            core, end = _parts(word)
            if core.isalpha() and (core.isascii() or max(core) <= _LAST_PLAIN):
                core = core.lower()
                plain.add(core)
            else:
                other.add(core)
            cut.append((word, core, end))
        other.update(",.")
        ids = self._of_letters(list(plain.difference(self.known)))
        rest = list(other.difference(self.known))
        for word, coded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            ids[word] = struct.pack(f"<{len(coded.ids)}I", *coded.ids)
        lookup = _Both(ids, self.known)
        ids.update([(word, lookup[core] + lookup[end]) for word, core, end in cut])
        return ids

    def _of_letters(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters only are encoded many at a time: each ends with the one id that ends a word."""
        parts = [words[k : k + 64] for k in range(0, len(words), 64)]
        found = {}
        for part, coded in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False), strict=True):
            ids = np.array(coded.ids, "<u4")
            ends = (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not end every word with an id of its own")
            data = ids.tobytes()
            found.update(zip(part, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        return found


class _Both(dict):
    """A small dictionary before a large one."""

    def __init__(self, first: dict, rest: dict):
        super().__init__(first)
        self.rest = rest

    def __missing__(self, key):
        return self.rest[key]


def _parts(word: str) -> tuple[str, str]:
    """A word and the comma or point behind its last letter: the ids of both in turn are the word's."""
    if word[-1] in ",." and word[-2:-1].isalpha() and word[-2] <= _LAST_PLAIN:
        return word[:-1], word[-1]
    return word, ""


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Positions of ``sizes`` in ``ways`` sets of near-equal sums, by the largest differencing method.

    Every item starts as a partial partition, a row of sums in falling order. The two with the widest
    spread are merged, the largest sums of one with the smallest of the other, until one is left.
    """
    if not sizes:
        return [[] for _ in range(ways)]
    trees: list = list(range(len(sizes)))
    heap = []
    for k, size in enumerate(sizes):
        # sums and set numbers (-1: empty set) of the sets in use; the others are empty
        heap.append((-size, k, [size], [k]))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, sums_a, sets_a = heapq.heappop(heap)
        _, _, sums_b, sets_b = heapq.heappop(heap)
        if len(sums_a) + len(sums_b) <= ways:
            sums, sets = sums_a + sums_b, sets_a + sets_b
        else:
            if len(sums_a) < len(sums_b):
                sums_a, sets_a, sums_b, sets_b = sums_b, sets_b, sums_a, sets_a
            sums_a, sets_a = sums_a + [0] * (ways - len(sums_a)), sets_a + [-1] * (ways - len(sets_a))
            sums, sets = sums_a[:], sets_a[:]
            for k, (s, t) in enumerate(zip(sums_b, sets_b, strict=True)):
                at = ways - 1 - k
                sums[at] += s
                if sets[at] < 0:
                    sets[at] = t
                else:
                    trees.append((sets[at], t))
                    sets[at] = len(trees) - 1
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, sets = [sums[k] for k in order], [sets[k] for k in order]
        low = sums[-1] if len(sums) == ways else 0
        heapq.heappush(heap, (low - sums[0], serial, sums, sets))
        serial += 1
    found = []
    for top in heap[0][3]:
        todo, items = [top] if top >= 0 else [], []
        while todo:
            node = trees[todo.pop()]
            if isinstance(node, tuple):
                todo += node
            else:
                items.append(node)
        found.append(sorted(items))
    return found + [[] for _ in range(ways - len(found))]


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Sets of positions with sums of at most ``capacity``; the count rises until every set fits."""
    ways = -(-sum(sizes) // capacity)
    while True:
        found = differencing(sizes, ways)
        if all(sum(sizes[k] for k in items) <= capacity for items in found):
            return [items for items in found if items]
        ways += max(1, ways // 200)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, piece: int = PIECE, windows: int = WINDOWS
) -> DataFrame:
    """Pieces of documents in windows of at most ``capacity`` tokens.

    One row per piece: the id, ``start`` (tokens of the document before it), ``ids`` (binary,
    little-endian unsigned 32-bit ids), ``doc_tokens``, ``sequence_id`` and ``offset`` in the window.
    A document is its ids by the tokenizer and then END_ID; a null text is empty and so one token.
    Whole windows of long documents are cut off first, the rest into pieces of at most ``piece``
    tokens, and batches of pieces that fill ``windows`` windows are balanced by differencing.
    Repeated rows and null ids are packed like any other. Other columns are not read.

    Batches form within an input partition: no row is shuffled and a task holds one batch. ``docs``
    must be a stored table, so that a task that runs again sees the same rows.
    """
    if not 0 < piece <= capacity:
        raise ValueError("piece must lie between 1 and capacity")
    fields = [docs.schema[id_col], T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType())]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        base = TaskContext.get().partitionId() << 36
        ids_of = _worker_ids(tokenizer)
        full, rest, rest_tokens, made, kind = [], [], 0, 0, None

        def rows(sets):
            nonlocal made
            out = [[], [], [], [], [], []]
            for pieces in sets:
                offset = 0
                for doc, start, ids, tokens in pieces:
                    for column, value in zip(out, (doc, start, ids, tokens, base + made, offset), strict=True):
                        column.append(value)
                    offset += len(ids) // 4
                made += 1
            kinds = (kind, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], schema.names)

        def balanced():
            sets = windows_of([len(p[2]) // 4 for p in rest], capacity)
            return rows([[rest[k] for k in items] for items in sets])

        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), ids_of(texts), strict=True):
                    ids += END_ID.to_bytes(4, "little")
                    tokens, start = len(ids) // 4, 0
                    while tokens - start >= capacity:
                        full.append([(doc, start, ids[4 * start : 4 * (start + capacity)], tokens)])
                        start += capacity
                        if len(full) == windows:
                            yield rows(full)
                            full = []
                    while start < tokens:
                        end = min(start + piece, tokens)
                        rest.append((doc, start, ids[4 * start : 4 * end], tokens))
                        rest_tokens += end - start
                        start = end
                        if rest_tokens >= (windows - 1) * capacity:
                            yield balanced()
                            rest, rest_tokens = [], 0
        if full:
            yield rows(full)
        if rest:
            yield balanced()

    return docs.select(id_col, text_col).mapInArrow(run, schema)


_workers: dict[str, WordIds] = {}


def _worker_ids(path: str) -> WordIds:
    """One tokenizer for all tasks of a Python worker."""
    if path not in _workers:
        _workers[path] = WordIds(path)
    return _workers[path]
