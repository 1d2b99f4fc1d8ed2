"""Spelling variants: words one edit apart, found with k-d trees over letter counts.

A word is a vector of letter counts. One inserted, deleted or replaced letter
moves that vector by an L1 distance of two at most: one count goes up by one, one
goes down by one, or both. Counts are kept in 64 bits, two for each of 32 letter
classes (count at least one, count at least two), which can only bring vectors
nearer. A plane of a tree is one of these bits, so a search that may go up once
and down once crosses at most one plane in each direction and prunes the rest.

Trees are searched per pair of lengths (equal, or longer by one):

* A tree over each length that is too large for one task cuts it into cells. Its
  planes are balanced on a sample, its cells hold all words. Every word goes to
  its home cell and, as a visitor, to the cells that its search reaches: those of
  its own length with a higher number, so that a pair meets once, and those of the
  next length.
* In each cell a smaller tree over its words answers the searches of words and
  visitors down to a few candidates; these are compared letter by letter.

What leaves a cell is, for each word, how many near words it met and the most
frequent of them, never the pairs.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerwell.llm.common import batch_of, columns, in_batches
from layerwell.sinks.parquet import stage

# Fixed values of the query's contract.
MIN_LETTERS = 7
MIN_COUNT = 2
TYPO_RATE = 31
FORM_RATIO = 10

CELL_WORDS = 8192  # words of up to 16 letters in a cell of the outer trees, about; fewer longer ones
SAMPLE_WORDS = 32  # words per cell that the planes of the outer trees are balanced on
LEAF_WORDS = 8
BLOCK = 2048  # searches that a task runs at once
_FLUSH = 400_000  # different words that a task counts before it sends them

# Latin-1 letters as the contract has them, after A-Z is lower-cased.
_RUNS = re.compile(f"[a-zÀ-ÿ]{{{MIN_LETTERS},}}")

# Class of each Latin-1 byte: a to z, and six for all others.
_CLASS = np.array([b - 97 if 97 <= b <= 122 else 26 + b % 6 for b in range(256)], np.uint64)


# ------------------------------------------------------------------ vocabulary


def count_words(docs: DataFrame, typo_rate: int = TYPO_RATE, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n: how often it occurs, for words of at least ``MIN_LETTERS``
    letters that occur at least ``min_count`` times. A run of letters whose
    checksum with the doc_id is divisible by ``typo_rate`` loses one letter first
    (0: none does)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if text is None:
                    continue
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, times in Counter(_RUNS.findall(text.lower().decode())).items():
                    if typo_rate:
                        checksum = zlib.crc32(word.encode(), prefix)
                        if checksum % typo_rate == 0:
                            at = checksum % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < MIN_LETTERS:
                                continue
                    total[word] += times
                if len(total) > _FLUSH:
                    yield counted(total)
                    total = Counter()
        if total:
            yield counted(total)

    def counted(total: Counter) -> pa.RecordBatch:
        return batch_of(["word", "n"], [list(total), list(total.values())], [pa.string(), pa.int64()])

    # Binary text: bytes.lower() changes A-Z only.
    rows = columns(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"))
    found = in_batches(rows, run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letters(words: pa.Array, length: int) -> np.ndarray:
    """Latin-1 words of one length as a matrix of bytes."""
    return np.frombuffer(b"".join(words.to_pylist()), np.uint8).reshape(-1, length)


def counts_in_bits(matrix: np.ndarray) -> np.ndarray:
    """Bit 2c: letters of class c occur; bit 2c + 1: at least twice."""
    out = np.zeros(len(matrix), np.uint64)
    for column in _CLASS[matrix].T:
        once = np.uint64(1) << (column * np.uint64(2))
        out |= np.where(out & once, once << np.uint64(1), once)
    return out


# ----------------------------------------------------------------------- trees


@dataclass
class Tree:
    """Nodes in arrays; a node without a plane (-1) is a leaf, whose ``left`` is
    its number."""

    plane: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int

    def reach(self, vectors: np.ndarray, up: bool, down: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (vector, leaf) of all leaves whose box can be entered with at most
        one count one up, if ``up``, and one count one down, if ``down``."""
        query, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        ups, downs = np.full(len(vectors), up), np.full(len(vectors), down)
        found = []
        while len(query):
            plane = self.plane[node]
            ended = plane < 0
            if ended.any():
                found.append((query[ended], self.left[node[ended]]))
                query, node, ups, downs, plane = (x[~ended] for x in (query, node, ups, downs, plane))
            own = vectors[query]
            bit = plane.astype(np.uint64)
            has = (own >> bit & np.uint64(1)).astype(bool)
            second = plane % 2 == 1
            # A step down from two or more does not get below one, nor one up from none above one.
            other = (own >> (bit ^ np.uint64(1)) & np.uint64(1)).astype(bool)
            crosses = np.where(has, downs & (second | ~other), ups & (~second | other))
            home, away = np.where(has, self.right[node], self.left[node]), np.where(has, self.left[node], self.right[node])
            node = np.concatenate([home, away[crosses]])
            query = np.concatenate([query, query[crosses]])
            downs = np.concatenate([downs, downs[crosses] & ~has[crosses]])
            ups = np.concatenate([ups, ups[crosses] & has[crosses]])
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))


def build_tree(vectors: np.ndarray, most: int) -> Tree:
    """Each plane is the bit that cuts its words most evenly; a leaf has at most
    ``most`` words, or only words with equal vectors."""
    plane, left, right, leaves = [], [], [], 0
    waiting = [(np.arange(len(vectors)), None, 0)]
    while waiting:
        rows, parent, side = waiting.pop()
        number = len(plane)
        if parent is not None:
            (right if side else left)[parent] = number
        own, best = vectors[rows], -1
        if len(rows) > most:
            bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            evenness = np.minimum(bits, len(rows) - bits)
            best = int(evenness.argmax()) if evenness.max() > 0 else -1
        plane.append(best)
        left.append(leaves)
        right.append(-1)
        if best < 0:
            leaves += 1
        else:
            has = (own >> np.uint64(best) & np.uint64(1)).astype(bool)
            waiting += [(rows[has], number, 1), (rows[~has], number, 0)]
    return Tree(np.array(plane), np.array(left), np.array(right), leaves)


def outer_trees(vocabulary: DataFrame, cell_words: int = CELL_WORDS) -> dict[int, Tree]:
    """A tree for every length that needs more than one cell. The driver gets
    ``SAMPLE_WORDS`` words for each cell, chosen by a hash."""
    weight = F.greatest(F.length("word"), F.lit(16))
    room = 16 * cell_words
    lengths = (
        vocabulary.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("words"), F.sum(weight).alias("weight"))
        .where(F.col("weight") > room)
        .select("length", (SAMPLE_WORDS * F.col("weight") / room / F.col("words")).alias("rate"))
    )
    thousandths = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) / (1 << 20)
    sample = (
        vocabulary.select("word", F.length("word").alias("length"))
        .join(F.broadcast(lengths), "length")
        .where(thousandths < F.col("rate"))
        .select("length", F.encode("word", "ISO-8859-1").alias("word"))
    )
    words: dict[int, list[bytes]] = {}
    for row in sample.collect():
        words.setdefault(row["length"], []).append(bytes(row["word"]))
    return {
        length: build_tree(counts_in_bits(letters(pa.array(sorted(own)), length)), SAMPLE_WORDS)
        for length, own in words.items()
    }


# ----------------------------------------------------------------------- cells

WORD, VISITOR, SHORTER = 0, 1, 2


def _deal(vocabulary: DataFrame, trees: dict[int, Tree], partitions: int) -> DataFrame:
    """Every word in its home cell and in those that its searches reach."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths).tolist():
                own = batch.filter(pa.array(lengths == length))
                yield from dealt(own, length)

    def dealt(own: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
        vectors = counts_in_bits(letters(own.column("word"), length))
        here, longer = shared.value.get(length), shared.value.get(length + 1)
        every, none = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        query, cell = here.reach(vectors, False, False) if here else (every, none)
        home = np.empty(len(vectors), np.int64)
        home[query] = cell
        parts = [(length, WORD, every, home)]
        if here:
            query, cell = here.reach(vectors, True, True)
            later = cell > home[query]
            parts.append((length, VISITOR, query[later], cell[later]))
        parts.append((length + 1, SHORTER, *(longer.reach(vectors, True, False) if longer else (every, none))))
        for size, role, rows, cells in parts:
            taken = own.take(pa.array(rows))
            yield batch_of(
                ["length", "cell", "role", "word", "n"],
                [np.full(len(rows), size), cells, np.full(len(rows), role), taken.column("word"), taken.column("n")],
                [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64()],
            )

    words = vocabulary.select(F.length("word").alias("length"), F.encode("word", "ISO-8859-1").alias("word"), "n")
    schema = "length int, cell int, role int, word binary, n long"
    return (
        in_batches(words, run, schema)
        .repartition(partitions, "length", "cell")
        .sortWithinPartitions("length", "cell", "role")
    )


class Cell:
    """The words of a cell, with the inner tree over them."""

    def __init__(self, words: list[pa.Array], counts: list[np.ndarray], length: int):
        self.words = pa.concat_arrays(words)
        self.counts = np.concatenate(counts)
        self.matrix = letters(self.words, length)
        self.vectors = counts_in_bits(self.matrix)
        self.tree = build_tree(self.vectors, LEAF_WORDS)
        query, leaf = self.tree.reach(self.vectors, False, False)
        order = np.argsort(leaf, kind="stable")
        self.order = query[order]
        self.starts = np.searchsorted(leaf[order], np.arange(self.tree.leaves + 1))

    def near(self, matrix: np.ndarray, vectors: np.ndarray, shorter: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (searching word, word of the cell) that are one edit apart, some
        searches at a time."""
        step = max(1, min(BLOCK, (1 << 26) // (64 * matrix.shape[1])))
        for start in range(0, len(vectors), step):
            own = vectors[start : start + step]
            query, leaf = self.tree.reach(own, True, not shorter)
            for part in range(0, len(query), 1 << 17):
                q, at = query[part : part + (1 << 17)], leaf[part : part + (1 << 17)]
                size = self.starts[at + 1] - self.starts[at]
                first = np.repeat(self.starts[at] - np.cumsum(size) + size, size)
                point = self.order[first + np.arange(size.sum())]
                q = np.repeat(q, size)
                a, b = own[q], self.vectors[point]
                up, down = np.bitwise_count(b & ~a), np.bitwise_count(a & ~b)
                fits = (up <= 1) & (down <= (0 if shorter else 1))
                q, point = q[fits] + start, point[fits]
                edited = _one_edit(matrix, q, self.matrix, point, shorter)
                yield q[edited], point[edited]


def _one_edit(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, shorter: bool) -> np.ndarray:
    """Whether a[i] becomes b[j] by replacing one letter or, if it is shorter by
    one, by inserting one. Long words are compared a bounded number at a time."""
    out, step = np.zeros(len(i), bool), max(1, (1 << 25) // b.shape[1])
    for start in range(0, len(i), step):
        own, other = a[i[start : start + step]], b[j[start : start + step]]
        if shorter:
            front = np.logical_and.accumulate(own == other[:, :-1], axis=1).sum(axis=1)
            back = np.logical_and.accumulate((own == other[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            out[start : start + step] = front + back >= own.shape[1]
        else:
            out[start : start + step] = (own != other).sum(axis=1) == 1
    return out


def _met(words: pa.Array, index: np.ndarray, others: pa.Array, other: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Per word of ``index``: how many near words it met, and the best of them."""
    names = np.array(others.take(pa.array(other)).to_pylist())
    n = counts[other]
    order = np.lexsort((names, -n, index))
    index, other, n = index[order], other[order], n[order]
    starts = np.flatnonzero(np.diff(index, prepend=-1))
    return batch_of(
        ["word", "n_near", "best_n", "best"],
        [words.take(pa.array(index[starts])), np.diff(starts, append=len(index)), n[starts],
         others.take(pa.array(other[starts]))],
        [pa.binary(), pa.int64(), pa.int64(), pa.binary()],
    )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell, its words before the visitors."""
    key, words, counts, cell = None, [], [], None

    def among_themselves() -> Iterator[pa.RecordBatch]:
        for i, j in cell.near(cell.matrix, cell.vectors, False):
            # A pair is met from both sides.
            if len(i):
                yield _met(cell.words, i, cell.words, j, cell.counts)

    for batch in batches:
        head = [batch.column(c).to_numpy() for c in ("length", "cell", "role")]
        changes = np.flatnonzero(np.any([np.diff(x, prepend=x[:1]) != 0 for x in head], axis=0)).tolist() if batch.num_rows else []
        bounds = [0, *changes, batch.num_rows]
        for start, end in zip(bounds, bounds[1:]):
            if start == end:
                continue
            length, number, role = (int(x[start]) for x in head)
            if (length, number) != key:
                if words:
                    cell = Cell(words, counts, key[0])
                    yield from among_themselves()
                key, words, counts, cell = (length, number), [], [], None
            own = batch.column("word").slice(start, end - start)
            n = batch.column("n").to_numpy()[start:end]
            if role == WORD:
                words.append(own)
                counts.append(n)
                continue
            if words:
                cell, words, counts = Cell(words, counts, length), [], []
                yield from among_themselves()
            if cell is None:
                continue
            matrix = letters(own, length - 1 if role == SHORTER else length)
            for i, j in cell.near(matrix, counts_in_bits(matrix), role == SHORTER):
                if len(i):
                    yield _met(own, i, cell.words, j, cell.counts)
                    yield _met(cell.words, j, own, i, n)
    if words:
        cell = Cell(words, counts, key[0])
        yield from among_themselves()


def near_words(vocabulary: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """Per word with near words: word, n_near, best (the most frequent near word,
    of equally frequent ones the first in code-point order) and best_n."""
    trees = outer_trees(vocabulary, cell_words)
    least = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = sum(tree.leaves for tree in trees.values())
    met = in_batches(
        _deal(vocabulary, trees, max(least, cells)), _search, "word binary, n_near long, best_n long, best binary"
    )
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("best")))
    text = lambda c: F.decode(c, "ISO-8859-1")
    return (
        met.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
        .select(
            text("word").alias("word"), "n_near",
            (-F.col("first.n")).alias("best_n"), text(F.col("first.best")).alias("best"),
        )
    )


# ----------------------------------------------------------------------- forms


def group_variants(
    docs: DataFrame, typo_rate: int = TYPO_RATE, ratio: int = FORM_RATIO, cell_words: int = CELL_WORDS
) -> DataFrame:
    """Every word of the vocabulary (see ``count_words``) with n, n_near (words one
    edit away), form and form_n (the most frequent of these and its n, if that is
    at least ``ratio`` times the word's own; else null) and root (where following
    forms ends; the word itself if it has none).

    Null and empty texts have no words; a null doc_id counts as an empty one in the
    checksum; repeated rows count each. Words of any length are compared whole. An
    empty table gives no rows; columns other than doc_id and text are ignored.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its variants")
    vocabulary = stage(count_words(docs, typo_rate))
    near = near_words(vocabulary, cell_words)
    is_form = F.col("best_n") >= ratio * F.col("n")
    words = stage(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
    ))
    # Every step multiplies n by the ratio, so paths are short; each round doubles
    # the steps taken.
    largest = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.floor(math.log(largest, ratio)) + 1)
    links = words.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        links = stage(links)
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return words.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


ORACLE_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
    list_concat([b], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= {MIN_LETTERS}
  GROUP BY ALL
), hashed AS (
  SELECT run, times,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT],
             list_transform(range(strlen(key)),
               lambda i: (instr('123456789ABCDEF', substr(hex(encode(key)), 2 * i + 1, 1)) * 16
                   + instr('123456789ABCDEF', substr(hex(encode(key)), 2 * i + 2, 1)))::BIGINT)),
           lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])))::BIGINT AS h
  FROM (SELECT *, concat(doc_id, ':', run) AS key FROM runs), crc
), words AS (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT times, CASE WHEN h % {TYPO_RATE} = 0
                      THEN concat(substr(run, 1, (h % length(run))::INTEGER), substr(run, (h % length(run))::INTEGER + 2))
                      ELSE run END AS word FROM hashed)
  WHERE length(word) >= {MIN_LETTERS}
  GROUP BY word HAVING sum(times) >= {MIN_COUNT}
), cut AS (
  SELECT word, n, i, concat(substr(word, 1, i::INTEGER), substr(word, i::INTEGER + 2)) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.rest
  UNION SELECT b.word, a.word, a.n FROM words a JOIN cut b ON a.word = b.rest
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(any_value(best.n_near), 0)::BIGINT AS n_near,
         min(p.other) AS form, any_value(p.other_n) AS form_n
  FROM words w LEFT JOIN best USING (word)
  LEFT JOIN pairs p ON p.word = w.word AND p.other_n = best.best_n AND best.best_n >= {FORM_RATIO} * w.n
  GROUP BY w.word, w.n
), paths AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT p.word, f.word, f.form FROM paths p JOIN forms f ON f.word = p.next
)
SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM forms f JOIN paths p ON p.word = f.word AND p.next IS NULL
"""
