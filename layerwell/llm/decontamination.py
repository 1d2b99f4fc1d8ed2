"""Benchmark decontamination by greedy string tiling.

The benchmark is taken in blocks of bounded size. A block is broadcast, and each
document is compared with it where it lies, so no text is shuffled and a
passage that a third of all documents hold is no hot key. Shared runs of
``MIN_MATCH`` tokens (seeds) find the items a document may hold; the tokens that
seeds cover bound what tiles can cover, so other items are left out without
loss. Greedy string tiling then marks the longest common runs that do not
overlap, found by running Karp-Rabin hashes, down to ``MIN_MATCH`` tokens. Tiles
may come in any order, so a passage with its sentences rearranged is covered
like one that is whole.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerwell.llm.common import batch_of, columns, gram_hashes, in_batches, running_total
from layerwell.sinks.parquet import stage

MIN_MATCH = 5  # tokens of the shortest tile
COVERAGE = 0.5  # share of an item's tokens that makes a leak
BLOCK_TOKENS = 1_000_000  # tokens of the benchmark that are broadcast at once

# Marks that are cut off both ends of a word.
MARKS = string.punctuation + "¡¿«»‹›„“”‘’…–—·•§¶©®™"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def tokens(text: str | None) -> list[str]:
    return list(filter(None, map(str.strip, (text or "").lower().split(), repeat(MARKS))))


class RunningHash:
    """Hashes of all windows of any length, each from two prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[:1] = 1
        self.shift = np.full(n + 1, _INVERSE, np.uint64)
        self.shift[:1] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.shift, out=self.shift)
        mixed = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed * powers[:n], out=self.sums[1:])

    def windows(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        if n <= 0:
            return np.empty(0, np.uint64)
        return (self.sums[length:] - self.sums[:n]) * self.shift[:n]


def tile(item: np.ndarray, text: np.ndarray, shortest: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in item, start in text, length), longest
    first; among equal lengths the earliest in the item, then in the text."""
    item_hash, text_hash = RunningHash(item), RunningHash(text)
    item_used, text_used = np.zeros(len(item), bool), np.zeros(len(text), bool)
    tiles: list[tuple[int, int, int]] = []
    # No longer match than the item is possible; each round halves the length.
    length = max(len(item), shortest)
    while True:
        while matches := _matches(item, text, item_used, text_used, item_hash, text_hash, length):
            marked = False
            for size, p, t in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
                if item_used[p : p + size].any() or text_used[t : t + size].any():
                    continue
                item_used[p : p + size] = text_used[t : t + size] = True
                tiles.append((p, t, size))
                marked = True
            if not marked:
                break
        if length <= shortest:
            return tiles
        length = max(shortest, length // 2)


def _free(used: np.ndarray, length: int) -> np.ndarray:
    taken = np.concatenate([[0], np.cumsum(used)])
    return np.flatnonzero(taken[length:] == taken[: len(taken) - length])


def _matches(item, text, item_used, text_used, item_hash, text_hash, length) -> list[tuple[int, int, int]]:
    """Maximal unmarked matches of at least ``length`` tokens."""
    if length > min(len(item), len(text)):
        return []
    starts, places = _free(item_used, length), _free(text_used, length)
    by_hash: dict[int, list[int]] = {}
    for p, h in zip(starts.tolist(), item_hash.windows(length)[starts].tolist()):
        by_hash.setdefault(h, []).append(p)
    hashes = text_hash.windows(length)[places]
    hit = np.isin(hashes, np.fromiter(by_hash, np.uint64, len(by_hash)))
    found = []
    for t, h in zip(places[hit].tolist(), hashes[hit].tolist()):
        for p in by_hash[h]:
            # Not at the start of a maximal match: the one before reports it.
            if p and t and not item_used[p - 1] and not text_used[t - 1] and item[p - 1] == text[t - 1]:
                continue
            if not np.array_equal(item[p : p + length], text[t : t + length]):
                continue
            size, most = length, min(len(item) - p, len(text) - t)
            while size < most and item[p + size] == text[t + size] and not item_used[p + size] and not text_used[t + size]:
                size += 1
            found.append((size, p, t))
    return found


class Block:
    """Items of the benchmark as token numbers, with an index of their seeds."""

    def __init__(self, rows: Sequence[tuple[int | None, str | None]], shortest: int = MIN_MATCH):
        self.shortest, self.numbers = shortest, {}
        self.ids, self.items = [], []
        seeds, owners, places = [], [], []
        for item_id, text in rows:
            words = tokens(text)
            if len(words) < shortest:
                continue
            item = np.array([self.numbers.setdefault(w, len(self.numbers)) for w in words], np.int64)
            grams = gram_hashes(item.view(np.uint64), shortest)
            seeds.append(grams)
            owners.append(np.full(len(grams), len(self.items)))
            places.append(np.arange(len(grams)))
            self.ids.append(item_id)
            self.items.append(item)
        joined = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (seeds, owners, places)]
        order = np.argsort(joined[0], kind="stable")
        self.seeds, self.owners, self.places = (x[order] for x in joined)
        self.bits = np.zeros(1 << 20, bool)  # most other hashes are ruled out here
        self.bits[self._low(self.seeds)] = True

    @staticmethod
    def _low(hashes: np.ndarray) -> np.ndarray:
        return (hashes.astype(np.uint64) >> np.uint64(44)).astype(np.int64)

    def leaks(self, text: str | None, coverage: float = COVERAGE) -> Iterator[tuple[int, int, int, int, int]]:
        """(item number, item tokens, covered tokens, tiles, longest tile)."""
        if not self.items:
            return
        found = tokens(text)
        words = np.fromiter(map(self.numbers.get, found, repeat(-1)), np.int64, len(found))
        grams = gram_hashes(words.view(np.uint64), self.shortest)
        shared = np.unique(grams[self.bits[self._low(grams)]])
        first, last = np.searchsorted(self.seeds, shared, "left"), np.searchsorted(self.seeds, shared, "right")
        rows = [np.arange(a, b) for a, b in zip(first, last) if a < b]
        if not rows:
            return
        rows = np.concatenate(rows)
        owners, places = self.owners[rows], self.places[rows]
        for number in np.unique(owners).tolist():
            item = self.items[number]
            reached = np.zeros(len(item) + 1, np.int64)
            mine = places[owners == number]
            np.add.at(reached, mine, 1)
            np.add.at(reached, mine + self.shortest, -1)
            if np.count_nonzero(np.cumsum(reached)) < coverage * len(item):
                continue
            tiles = tile(item, words, self.shortest)
            covered = sum(size for _, _, size in tiles)
            if covered >= coverage * len(item):
                yield number, len(item), covered, len(tiles), max(size for _, _, size in tiles)


def blocks(benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS) -> Iterator[list[tuple]]:
    """The rows of the benchmark, at most about ``block_tokens`` tokens at once."""
    rows = columns(benchmark, "item_id", "text").withColumn("_h", F.xxhash64("item_id", "text"))
    rows = rows.withColumn("_range", F.pmod("_h", F.lit(1024)))
    # A token takes two characters of text at least, but for the last one.
    size = F.ceil((F.length(F.coalesce("text", F.lit(""))) + 1) / 2)
    numbered = stage(
        running_total(rows, [], "_range", ["_h", "item_id"], size, "_before")
        .select("item_id", "text", F.floor(F.col("_before") / block_tokens).alias("_block"))
    )
    most = numbered.agg(F.max("_block")).first()[0]
    for number in range(0 if most is None else most + 1):
        yield [tuple(r) for r in numbered.where(F.col("_block") == number).select("item_id", "text").collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Pairs of a document and an item of which it holds at least ``coverage``:
    doc_id, item_id, item_tokens, covered_tokens, n_tiles, longest_tile.

    Tokens are words in lower case without punctuation at their ends. Null and
    empty texts hold nothing; an item of fewer than 5 tokens is no evidence and
    is never matched. Rows that repeat are reported as often as they occur; an
    empty documents or benchmark table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, item_tokens long, covered_tokens long, n_tiles long, longest_tile long"
    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    out = spark.createDataFrame([], schema)
    for items in blocks(benchmark):
        shared = spark.sparkContext.broadcast(Block(items))
        found = in_batches(rows, _reporter(shared, coverage), schema)
        out = out.unionByName(stage(found))
        shared.unpersist()
    return out


def _reporter(shared, coverage: float):
    names = ["doc_id", "item_id", "item_tokens", "covered_tokens", "n_tiles", "longest_tile"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            ids, found = batch.column("doc_id"), []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found += [(ids[i].as_py(), block.ids[n], *rest) for n, *rest in block.leaks(text, coverage)]
            if found:
                yield batch_of(names, list(zip(*found)), [pa.int64()] * 6)

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    spark, text_at = docs.sparkSession, docs.columns.index("text")
    pending = None
    for items in blocks(benchmark):
        docs = docs if pending is None else stage(docs)
        if pending is not None:
            pending.unpersist()
        pending = spark.sparkContext.broadcast(Block(items))
        docs = in_batches(docs, _keeper(pending, text_at, coverage), docs.schema)
    return docs


def _keeper(shared, text_at: int, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            clean = [next(block.leaks(t, coverage), None) is None for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
