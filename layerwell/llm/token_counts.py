"""Edit-aware token counts.

Each document keeps a segment tree over its pre-tokens: the leaves are short
segments of whole pre-tokens with their numbers of characters and tokens, the
inner nodes the sums. Pre-tokens are found from left to right, and where one
starts nothing before it matters any more. So after an edit only the segments
that it touches, with the two characters of context a pre-token may look ahead,
are split and encoded again, until a pre-token ends where a segment of old text
begins; the sums above them are updated and everything else is kept.

Leaves travel as two arrays beside the text, so later edits start from them.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from layerwell.llm.common import batch_of, columns, in_batches

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SEGMENT = 64  # characters from which a segment is closed
LOOK_AHEAD = 2  # characters behind its end that a pre-token may depend on
_CACHED = 500_000

# Edits that a clean-up of web text makes, as (pattern, replacement): addresses
# and long numbers are masked, licence lines and runs of marks are removed.
CLEAN_UP = (
    (r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "[email]"),
    (r"\+?\d[\d ().-]{6,}\d", "[number]"),
    (r"(?m)^.*(?:[Ll]icensed under|All rights reserved).*\n?", ""),
    (r"([*#%&$!])\1+", r"\1"),
)
# A text without any of these has no match of the rule.
_NEEDLES = ("@",), (), ("icensed under", "All rights reserved"), ()


class Counter:
    """Tokens of pre-tokens. Each is encoded by itself, so counts are kept."""

    def __init__(self, path: str):
        # Batches are small, and Spark runs a task on every core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}

    def learn(self, pieces: Sequence[str]) -> None:
        if len(self.known) > _CACHED:
            self.known = {}
        new = list(set(pieces).difference(self.known))
        if new:
            made = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            self.known.update(zip(new, map(len, made)))

    def segments(self, text: str, start: int = 0, stops: Sequence[int] = (), after: int = 0) -> tuple[list[int], list[int], int]:
        """Characters and tokens of the segments from ``start`` on, and the end:
        the first pre-token's end at or behind ``after`` that is in ``stops``
        (sorted), else the end of the text."""
        pieces, end = [], start
        for m in self.split.finditer(text, start):
            pieces.append(m.group())
            end = m.end()
            if stops and end >= after:
                i = bisect_left(stops, end)
                if i < len(stops) and stops[i] == end:
                    break
        return *self._grouped(pieces), end

    def _grouped(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        self.learn(pieces)
        chars, tokens, size, count = [], [], 0, 0
        known = self.known
        for piece in pieces:
            size += len(piece)
            count += known[piece]
            if size >= SEGMENT:
                chars.append(size), tokens.append(count)
                size = count = 0
        if size:
            chars.append(size), tokens.append(count)
        return chars, tokens

    def build(self, text: str) -> tuple[list[int], list[int]]:
        return self._grouped(self.split.findall(text))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter for each Python worker."""
    return Counter(path)


class SegmentTree:
    """Sums of characters and tokens over slots; a slot is an old segment, or
    what has taken its place."""

    def __init__(self, chars: Sequence[int], tokens: Sequence[int]):
        self.width = 1 << max(0, len(chars) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width : self.width + len(chars), 0] = chars
        self.sums[self.width : self.width + len(tokens), 1] = tokens
        level = self.width
        while level > 1:  # all parents of a level at once
            self.sums[level // 2 : level] = self.sums[level : 2 * level].reshape(-1, 2, 2).sum(1)
            level //= 2

    def find(self, place: int) -> tuple[int, int]:
        """The slot that holds a character, and the place where it starts. Places
        behind the last character belong to the last slot in use."""
        node, before = 1, 0
        left = max(0, min(place, int(self.sums[1, 0]) - 1))
        while node < self.width:
            node *= 2
            if left >= (size := int(self.sums[node, 0])):
                left -= size
                before += size
                node += 1
        return node - self.width, before

    def put(self, slot: int, chars: int, tokens: int) -> None:
        node = slot + self.width
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])


def merged_edits(edits: Sequence[tuple[int, int, str]], size: int) -> list[tuple[int, int, str]]:
    """Edits in order and within the text; of overlapping ones, a later one is
    cut down to what the earlier ones leave."""
    out, at = [], 0
    for start, end, new in sorted(edits, key=lambda e: (e[0], e[1])):
        start, end = max(min(start, size), at), min(end, size)
        if end < start or start == end and not new:
            continue
        out.append((start, end, new))
        at = end
    return out


def apply_edits(
    text: str, chars: Sequence[int], tokens: Sequence[int], edits: Sequence[tuple[int, int, str]], count: Counter
) -> tuple[str, list[int], list[int], int, int]:
    """The edited text, its segments, its tokens, and the characters that were
    encoded for that. Edits refer to the text before any of them."""
    edits = merged_edits(edits, len(text))
    if not edits:
        return text, list(chars), list(tokens), int(sum(tokens)), 0
    parts, at = [], 0
    for start, end, new in edits:
        parts += [text[at:start], new]
        at = end
    made = "".join([*parts, text[at:]])
    if not len(chars):
        new_chars, new_tokens = count.build(made)
        return made, new_chars, new_tokens, sum(new_tokens), len(made)

    old, tree = SegmentTree(chars, tokens), SegmentTree(chars, tokens)
    starts = np.concatenate([[0], np.cumsum(chars)]).tolist()  # of old segments, in old text
    replaced: dict[int, tuple[int, list[int], list[int]]] = {}  # first slot -> (slots, segments)
    shift, encoded, i = 0, 0, 0
    while i < len(edits):
        # A pre-token that ends within LOOK_AHEAD of the edit may change.
        first, at = old.find(edits[i][0] - LOOK_AHEAD)
        begin = at + shift
        while True:
            # Take in edits until the text comes back into step before the next.
            start, end, new = edits[i]
            shift += len(new) - (end - start)
            i += 1
            stop_at = edits[i][0] - LOOK_AHEAD if i < len(edits) else len(text)
            low = bisect_left(starts, max(end, at + 1))
            high = bisect_left(starts, stop_at + 1)
            stops = [s + shift for s in starts[low:high]]
            if not stops and i < len(edits):
                continue
            own_chars, own_tokens, reached = count.segments(made, begin, stops, end + shift)
            encoded += sum(own_chars)
            if i >= len(edits) or reached in stops:
                break
        last = bisect_left(starts, reached - shift)
        for slot in range(first + 1, last):
            tree.put(slot, 0, 0)
        tree.put(first, sum(own_chars), sum(own_tokens))
        replaced[first] = (last - first, own_chars, own_tokens)
    new_chars, new_tokens, slot = [], [], 0
    while slot < len(chars):
        if slot in replaced:
            taken, own_chars, own_tokens = replaced[slot]
            new_chars += own_chars
            new_tokens += own_tokens
            slot += taken
        else:
            new_chars.append(int(chars[slot]))
            new_tokens.append(int(tokens[slot]))
            slot += 1
    return made, new_chars, new_tokens, tree.tokens, encoded


TREE = "struct<chars: array<int>, tokens: array<int>>"
_TREE_TYPE = pa.struct([("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))])


def build_trees(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Per row: doc_id, text, tree (the leaves), n_tokens. A null text is kept,
    with an empty tree and no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            made = [own.build(t or "") for t in batch.column("text").to_pylist()]
            yield batch_of(
                ["doc_id", "text", "tree", "n_tokens"],
                [
                    batch.column("doc_id"), batch.column("text"),
                    [{"chars": c, "tokens": t} for c, t in made], [sum(t) for _, t in made],
                ],
                [None, None, _TREE_TYPE, pa.int64()],
            )

    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return in_batches(rows, run, f"doc_id long, text string, tree {TREE}, n_tokens long")


def edit_trees(trees: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Apply the column ``edits`` (array of start, end, replacement) of a frame of
    trees: doc_id, text, tree and n_tokens after the edits, tokens_before, n_edits
    (those that are left after clipping), encoded_chars. Positions count code
    points of the text before all edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        names = ["text", "tree", "n_tokens", "tokens_before", "n_edits", "encoded_chars"]
        for batch in batches:
            rows = []
            for text, tree, before, edits in zip(*(batch.column(c).to_pylist() for c in ("text", "tree", "n_tokens", "edits"))):
                wanted = [(e["start"], e["end"], e["replacement"] or "") for e in edits or []]
                tree = tree or {"chars": [], "tokens": []}
                made, chars, tokens, total, encoded = apply_edits(text or "", tree["chars"], tree["tokens"], wanted, own)
                used = len(merged_edits(wanted, len(text or "")))
                rows.append((
                    made if used else text, {"chars": chars, "tokens": tokens}, total, before, used, encoded,
                ))
            yield batch_of(
                ["doc_id", *names],
                [batch.column("doc_id"), *(list(c) for c in zip(*rows))] if rows else [[]] * 7,
                [pa.int64(), pa.string(), _TREE_TYPE, *[pa.int64()] * 4],
            )

    return in_batches(
        trees.select("doc_id", "text", "tree", "n_tokens", "edits"),
        run,
        f"doc_id long, text string, tree {TREE}, n_tokens long, tokens_before long, n_edits long, encoded_chars long",
    )


_RULES = [(re.compile(rule), new, needles) for (rule, new), needles in zip(CLEAN_UP, _NEEDLES)]


def clean_up_edits(text: str | None) -> list[tuple[int, int, str]]:
    """The edits of ``CLEAN_UP``, by rule and place."""
    text = text or ""
    return [
        (m.start(), m.end(), m.expand(new))
        for rule, new, needles in _RULES
        if not needles or any(n in text for n in needles)
        for m in rule.finditer(text)
    ]


def with_clean_up_edits(trees: DataFrame) -> DataFrame:
    """Adds the column ``edits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("replacement", pa.string())]))
        for batch in batches:
            found = [
                [dict(zip(("start", "end", "replacement"), e)) for e in clean_up_edits(t)]
                for t in batch.column("text").to_pylist()
            ]
            yield batch_of([*batch.schema.names, "edits"], [*batch.columns, found], [None] * batch.num_columns + [kind])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in trees.schema.fields)
    return in_batches(trees, run, schema + ", edits array<struct<start: int, end: int, replacement: string>>")


def count_after_clean_up(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Tokens of every document before and after the edits of a clean-up: doc_id,
    tokens_before, n_edits, n_tokens, n_chars (after), encoded_chars.

    A null or empty text has no tokens and no edits. Rows may repeat; an empty
    table gives no rows; columns other than doc_id and text are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        names = ["tokens_before", "n_edits", "n_tokens", "n_chars", "encoded_chars"]
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                chars, tokens = own.build(text)
                edits = merged_edits(clean_up_edits(text), len(text))
                made, _, _, total, encoded = apply_edits(text, chars, tokens, edits, own)
                rows.append((sum(tokens), len(edits), total, len(made), encoded))
            yield batch_of(
                ["doc_id", *names],
                [batch.column("doc_id"), *(list(c) for c in zip(*rows))] if rows else [[]] * 6,
                [pa.int64()] * 6,
            )

    # Built and edited in one pass: the trees need not leave the task here.
    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return in_batches(
        rows, run,
        "doc_id long, tokens_before long, n_edits long, n_tokens long, n_chars long, encoded_chars long",
    )
