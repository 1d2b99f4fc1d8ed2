"""Packing with a controlled mixture: deficit round-robin over source queues.

Every source has a queue of its documents and a quantum: its share of all
tokens, times the window. In each round a source's deficit grows by its quantum
and it sends grains (runs of at most ``GRAIN`` tokens of a document) while the
deficit lasts; what is left is carried to the next round. So a round fills one
window to the target proportions, to within a grain per source, and as the
quanta are proportional to the queues all of them run dry together.

Nothing of this needs to run one step after the other: a grain that ends at
token e of its queue is sent in round ceil(e / quantum). Deficits are thereby
carried over windows and partitions by running totals of tokens, in two levels
(see ``running_total``), once along the queues and once along the rounds. Cutting
that order every ``WINDOW`` tokens gives sequences without padding, but for the
last one.

Documents are encoded once, into a table in the shared scratch folder. Planning
reads its counts only; then the pieces are joined to the ids by document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from layerwell.llm.common import RANGES, batch_of, columns, in_batches, running_total
from layerwell.sinks.parquet import stage

WINDOW = 4096
GRAIN = 256
END_ID = 2  # follows each document
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
_CACHED_WORDS = 1_000_000
_CHUNK = 4_000_000  # characters encoded at once

# Texts of these characters need no normalising but lower case: ASCII without
# separators 1C to 1F, and composed Latin letters and common marks.
_PLAIN = re.compile(
    "[\t-\r -~¡-©«¬®-±´¶-¸»¿-įı-ňŊ-ž–-…]*"
)
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


class Encoder:
    """Token ids of texts. Pieces never reach over white space, so the ids of a
    word are kept and looked up, and only words not met lately are encoded;
    other than plain texts go through the tokenizer as they are."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # The same merges for pieces that are normalised and split already.
        self.merger = Tokenizer.from_file(path)
        self.merger.encode_special_tokens = True
        self.merger.normalizer = normalizers.Sequence([])
        self.merger.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        """Start over with the empty word, which has no ids."""
        self.known = pa.array([""], pa.large_string())
        self.ids = np.empty(0, self.type)
        self.first, self.size = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids in the fixed width of ``type``, little-endian."""
        plain = ["<|" not in t and _PLAIN.fullmatch(t) is not None for t in (t or "" for t in texts)]
        lower = [t.lower() if t and is_plain else "" for t, is_plain in zip(texts, plain)]
        split = pc.utf8_split_whitespace(pa.array(lower, pa.large_string()))
        words = split.flatten().dictionary_encode()
        number = self._numbers(words.dictionary)[words.indices.to_numpy()]
        size = self.size[number]
        end = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.first[number] - end[:-1], size) + np.arange(end[-1])
        ids = self.ids[at].tobytes()
        bounds = (end[split.offsets.to_numpy()] * self.type.itemsize).tolist()
        return [
            ids[a:b] if is_plain else self.whole(t)
            for t, is_plain, a, b in zip(texts, plain, bounds, bounds[1:])
        ]

    def _numbers(self, words: pa.LargeStringArray) -> np.ndarray:
        """Numbers of the words, after encoding those not known."""
        if len(self.known) > _CACHED_WORDS:
            self._forget()
        found = pc.index_in(words, value_set=self.known)
        missing = found.is_null()
        fresh = words.filter(missing)
        new = fresh.to_numpy(zero_copy_only=False).tolist()
        number = found.fill_null(-1).to_numpy().astype(np.int64)
        number[missing.to_numpy(zero_copy_only=False)] = np.arange(len(new)) + len(self.known)
        if new:
            pieces = [[w] if w.isalpha() else _PIECES.findall(w) for w in new]
            text = " ".join(p for own in pieces for p in own)
            ids = np.array(self.merger.encode_batch_fast([text], add_special_tokens=False)[0].ids)
            after = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])  # ends of pieces
            bounds = after[np.cumsum([0, *map(len, pieces)])]
            self.known = pa.concat_arrays([self.known, fresh])
            self.first = np.concatenate([self.first, bounds[:-1] + len(self.ids)])
            self.size = np.concatenate([self.size, np.diff(bounds)])
            self.ids = np.concatenate([self.ids, ids.astype(self.type)])
        return number


def _chunks(texts: Sequence[str | None]) -> Iterator[Sequence[str | None]]:
    """Runs of texts of about ``_CHUNK`` characters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= _CHUNK or i == len(texts) - 1:
            yield texts[start : i + 1]
            start, size = i + 1, 0


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)


def token_table(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Per document: key (of the row), doc_id, source, th (hash of the text), n
    (ids and the end) and ids, as a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = np.array([END_ID], own.type).tobytes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            parts = map(own.encode, _chunks(texts))
            ids = [x + end for part in parts for x in part]
            yield batch_of(
                ["doc_id", "source", "th", "n", "ids"],
                [*(batch.column(c) for c in ("doc_id", "source", "th")), [len(x) // own.type.itemsize for x in ids], ids],
                [None, None, None, pa.int64(), pa.binary()],
            )

    rows = columns(docs, "doc_id", "text", "source").select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64("text").alias("th"), "text"
    )
    made = in_batches(rows, run, "doc_id long, source string, th long, n long, ids binary")
    return stage(made.withColumn("key", F.monotonically_increasing_id()))


def shuffled_order() -> Column:
    """Place of a row in its queue. Rows without an id go by their text, so that
    they do not meet in one range."""
    return F.xxhash64(F.coalesce("doc_id", "th"))


def plan_pieces(counts: DataFrame, window: int = WINDOW, grain: int = GRAIN) -> DataFrame:
    """Pieces of documents in sequences. ``counts`` has key, doc_id, source, th
    and n; the result has key, start, length, sequence_id, offset."""
    order = shuffled_order()
    queued = running_total(
        counts.select(
            "key", "doc_id", "th", "n", order.alias("shuffled"),
            F.pmod(order, F.lit(RANGES)).alias("range"),
            F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("queue"),
        ),
        ["queue"], "range", ["shuffled", "doc_id", "th", "key"], F.col("n"), "queued", total="queue_tokens",
    )
    total = counts.agg(F.sum("n").alias("tokens")).first()["tokens"] or 0
    quantum = F.col("queue_tokens") * F.lit(float(window)) / F.lit(float(max(total, 1)))
    grains = queued.select(
        "key", "queue", "queued", "n", quantum.alias("quantum"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(grain).cast("long"))).alias("start"),
    ).withColumn("length", F.least(F.lit(grain), F.col("n") - F.col("start")))
    sent = grains.withColumn(
        "round", F.ceil((F.col("queued") + F.col("start") + F.col("length")) / F.col("quantum"))
    )
    # The grains of one document in one round follow each other.
    runs = sent.groupBy("key", "queue", "round").agg(
        F.min("start").alias("start"),
        F.min(F.col("queued") + F.col("start")).alias("at"),
        F.sum("length").alias("length"),
    )
    rounds_per_range = max(1, -(-(total // window + 2) // RANGES))
    runs = runs.withColumn("range", F.floor(F.col("round") / rounds_per_range))
    placed = running_total(runs, [], "range", ["round", "queue", "at"], F.col("length"), "place")

    first, last = f"place div {window}", f"(place + length - 1) div {window}"
    cut = placed.select(
        "key", "start", "length", "place",
        F.explode(F.expr(f"sequence({first}, {last})")).alias("sequence_id"),
    )
    begin = F.greatest(F.col("place"), F.col("sequence_id") * window)
    end = F.least(F.col("place") + F.col("length"), (F.col("sequence_id") + 1) * window)
    return cut.select(
        "key",
        (F.col("start") + begin - F.col("place")).alias("start"),
        (end - begin).alias("length"),
        "sequence_id",
        (begin - F.col("sequence_id") * window).alias("offset"),
    )


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, source string"
)


def pack_documents(
    docs: DataFrame, window: int = WINDOW, grain: int = GRAIN, path: str = VOCABULARY
) -> DataFrame:
    """All documents in sequences of at most ``window`` tokens, one row per piece:
    doc_id, start, length, ids_crc32 (of the ids as little-endian 32-bit
    numbers), doc_tokens, sequence_id, offset, source.

    A null or empty text is a document of the end id alone. A null source is a
    queue of its own. Repeated rows are packed as often as they occur. An empty
    table gives no rows; other columns are ignored.
    """
    table = token_table(docs, path)
    plan = plan_pieces(table.drop("ids"), window, grain)
    of_document = plan.groupBy("key").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(path).type
        names = [c.split()[0] for c in PIECES.replace(", ", ",").split(",")]
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "source", "n", "ids", "pieces")]
            for doc_id, source, n, ids, pieces in zip(*columns):
                wide = np.frombuffer(ids, width).astype("<u4")
                for p in pieces:
                    own = wide[p["start"] : p["start"] + p["length"]]
                    rows.append((
                        doc_id, p["start"], p["length"], zlib.crc32(own.tobytes()), n,
                        p["sequence_id"], p["offset"], source,
                    ))
            types = [pa.string() if c == "source" else pa.int64() for c in names]
            yield batch_of(names, list(zip(*rows)) or [[]] * 8, types)

    joined = table.select("key", "doc_id", "source", "n", "ids").join(of_document, "key")
    return in_batches(joined.select("doc_id", "source", "n", "ids", "pieces"), cut, PIECES)
