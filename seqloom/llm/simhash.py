"""SimHash near-duplicates: exact comparison of fingerprint tiles that popcounts cannot rule out."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.llm.common import components, roots_of
from seqloom.storage import stage

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints in a tile. Two tiles and their comparison fit a few hundred kilobytes.
TILE = 512
#: Bytes of one text whose words are held at a time.
BLOCK = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the 64-bit ``fingerprint`` (long) of every row's whole text.

    A-Z is lower-cased, words end at ASCII white space, shingles of three words count as often as
    they occur; a shorter text is one shingle, an empty or null text has fingerprint zero. Other
    columns are not read.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("fingerprint", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = np.fromiter((_fingerprint(t.as_py() or b"") for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _word_blocks(data: bytes):
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, min(at + BLOCK, len(data)))
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end + 1


def _fingerprint(data: bytes) -> int:
    ones, total, words = np.zeros(64, np.int64), 0, []
    for block in _word_blocks(data.lower()):
        words += block
        if len(words) >= SHINGLE:
            ones += _bit_sums(words)
            total += len(words) - SHINGLE + 1
            words = words[1 - SHINGLE :]
    if not total:
        if not words:
            return 0
        hashed = xxhash.xxh64_intdigest(b" ".join(words), SEED)
        return hashed
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > total).tolist())


def _bit_sums(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: -SHINGLE] + 1).tolist()]
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)), np.uint64, len(starts)
    )
    octets = hashes.view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])


def _cell(fingerprint: Column) -> Column:
    """Popcounts of the four 16-bit words, five bits each, with room for a neighbour's difference."""
    counts = [F.bit_count(F.shiftrightunsigned(fingerprint, 16 * k).bitwiseAND(F.lit(0xFFFF))) + F.lit(4) for k in range(4)]
    return sum((F.shiftleft(c.cast("int"), 5 * k) for k, c in enumerate(counts[1:], 1)), counts[0].cast("int"))


def _neighbours(radius: int) -> list[int]:
    """Differences of cells that can hold fingerprints within ``radius``; of each pair of cells, one."""
    steps = itertools.product(range(-radius, radius + 1), repeat=4)
    near = (sum(d << 5 * k for k, d in enumerate(s)) for s in steps if sum(map(abs, s)) <= radius)
    return sorted(d for d in near if d >= 0)


def _tile_pairs(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """Pairs of tiles of distinct fingerprints: (left, right, same).

    A tile holds fingerprints with equal popcounts in all four words. The sum of the differences of
    those counts never exceeds the number of differing bits, so tiles further apart are skipped
    without loss. There are at most 17^4 cells, which bounds the broadcast table of their sizes.
    """
    cells = prints.withColumn("cell", _cell(F.col("fingerprint")))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    sizes = stage(sizes, "simhash-cells")
    tiles = (
        cells.join(F.broadcast(sizes), "cell")
        .withColumn("part", F.pmod(F.xxhash64("fingerprint"), "parts").cast("int"))
        .groupBy("cell", "part")
        .agg(F.collect_list("fingerprint").alias("prints"))
    )
    tiles = stage(tiles, "simhash-tiles")
    steps = F.array(*(F.lit(d) for d in _neighbours(radius)))
    near = sizes.select(F.col("cell").alias("cell_b"), "parts")
    left = (
        tiles.select(F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), F.col("prints").alias("left"), F.explode(steps).alias("step"))
        .withColumn("cell_b", F.col("cell_a") + F.col("step"))
        .join(F.broadcast(near), "cell_b")
        .withColumn("part_b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .where("step > 0 or part_b >= part_a")
    )
    right = tiles.select(F.col("cell").alias("cell_b"), F.col("part").alias("part_b"), F.col("prints").alias("right"))
    return left.join(right, ["cell_b", "part_b"]).select("left", "right", F.expr("step = 0 and part_a = part_b").alias("same"))


def _compare(radius: int):
    def run(batches):
        for batch in batches:
            lefts, rights = batch.column(0), batch.column(1)
            same = batch.column(2).to_numpy(zero_copy_only=False)
            ends = [x.offsets.to_numpy() for x in (lefts, rights)]
            values = [x.values.to_numpy().view(np.uint64) for x in (lefts, rights)]
            a, b = [], []
            for k in range(len(same)):
                x = values[0][ends[0][k] : ends[0][k + 1]]
                y = values[1][ends[1][k] : ends[1][k + 1]]
                near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
                i, j = np.nonzero(near)
                if same[k]:
                    i, j = i[i < j], j[i < j]
                if len(i):
                    # a spanning forest of the tile pair: never more links than fingerprints
                    nodes, at = np.unique(np.concatenate([x[i], y[j]]), return_inverse=True)
                    root = roots_of(at[: len(i)], at[len(i) :], len(nodes))
                    own = np.flatnonzero(root != np.arange(len(nodes)))
                    a.append(nodes[own])
                    b.append(nodes[root[own]])
            if a:
                x, y = np.concatenate(a), np.concatenate(b)
                nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
                root = roots_of(at[: len(x)], at[len(x) :], len(nodes))
                own = np.flatnonzero(root != np.arange(len(nodes)))
                found = [nodes[own].view(np.int64), nodes[root[own]].view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b"])

    return run


def near_duplicates(prints: DataFrame, id_col: str = "doc_id", radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``prints`` (id, fingerprint), a stored table.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest id
    reachable by links, the row's own included. Equal fingerprints are compared once. Null ids belong
    to their component but never name it; repeated rows are returned each time.
    """
    if radius > 3:
        raise ValueError("cells leave room for a radius of at most 3")
    distinct = stage(prints.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "simhash-prints")
    links = _tile_pairs(distinct.select("fingerprint"), radius, tile).mapInArrow(_compare(radius), "a bigint, b bigint")
    groups = components(links, "simhash").withColumnRenamed("node", "fingerprint")
    linked = distinct.join(groups, "fingerprint")
    named = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.join(named, "component").select("fingerprint", "component_id")
    names = distinct.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component_id", "least").alias("component_id")
    )
    return prints.join(names, "fingerprint").select(id_col, "fingerprint", "component_id")


def hex_print(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
