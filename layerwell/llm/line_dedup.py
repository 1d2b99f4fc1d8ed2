"""Removal of lines that many documents share, behind two Bloom filters.

A line's key is the line without white space at its ends, A-Z in lower case. A
128-bit digest stands for the key from here on. Three passes read the texts:

1. Every task sends the distinct keys it met as 4 bytes each, packed per slice of
   the hash space. The tasks of the slices fill two Bloom filters, for hashes
   seen once and for hashes seen again; only the second one leaves them.
2. With that filter in every task, only suspected repeats are shuffled: digest,
   number of documents and first document, summed in the task first. The exact
   count confirms them and drops those that the filters let through by chance.
3. Confirmed lines are removed where they are; texts are never shuffled.

The filter for repeats never has more than ``MOST_WORDS`` words. Beyond that it is
folded onto itself: more lines are suspected and their digests shuffled, the
result stays the same.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from layerwell.llm.common import WHITE_SPACE, batch_of, columns, document_key, in_batches
from layerwell.sinks.parquet import stage

MIN_DOCS = 10
MIN_CHARS = 1
MOST_WORDS = 1 << 23  # of 64 bits, of the filter that is broadcast: 64 MB
MOST_KEYS = 1 << 20  # confirmed keys that are broadcast: 32 MB; more are joined by document

_STRIP = WHITE_SPACE.encode()


@dataclass(frozen=True)
class Geometry:
    """How hashes are cut: the top bits name the slice, the next ones the word
    within the slice; the two bits of the word come from the end of ``rest``."""

    slice_bits: int
    word_bits: int
    kept_bits: int  # of the word's number, after folding

    @classmethod
    def of(cls, lines: int, most_words: int = MOST_WORDS) -> Geometry:
        """Four lines to a word of 64 bits; a slice has at most 2^20 words."""
        needed = math.ceil(math.log2(max(lines, 1) + 1))
        slices = max(6, needed - 22)
        words = min(20, max(4, needed - 2 - slices))
        return cls(slices, words, max(0, min(words, int(math.log2(most_words)) - slices)))

    def slices(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.slice_bits)).astype(np.int32)

    def rests(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(32 - self.slice_bits)).astype(np.uint32)

    def suspected(self, repeats: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        word = repeats[hashes >> np.uint64(64 - self.slice_bits - self.kept_bits)]
        bits = _bits(self.rests(hashes))
        return word & bits == bits


def _bits(rests: np.ndarray) -> np.ndarray:
    one, low = np.uint64(1), rests.astype(np.uint64)
    return one << (low & np.uint64(63)) | one << (low >> np.uint64(6) & np.uint64(63))


def line_key(line: bytes) -> bytes:
    return line.strip(_STRIP).lower()  # bytes.lower() changes A-Z only


def _keys(lines: list[bytes], min_chars: int) -> list[bytes | None]:
    """The key of every line; none for keys that are too short to count."""
    made = [line_key(line) for line in lines]
    if min_chars <= 1:
        return [key or None for key in made] if min_chars else made
    return [key if len(key.decode("utf-8", "replace")) >= min_chars else None for key in made]


def _digests(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2)
    return raw[:, 0].astype(np.uint64), raw[:, 1].astype(np.uint64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").to_pylist()]


def _batch_keys(batch: pa.RecordBatch, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of the distinct keys of each row, and the number of their row."""
    keys, sizes = [], []
    for text in _texts(batch):
        own = set(_keys(text.split(b"\n"), min_chars))
        own.discard(None)
        keys += own
        sizes.append(len(own))
    return *_digests(keys), np.repeat(np.arange(len(sizes)), sizes)


def _rows(docs: DataFrame) -> DataFrame:
    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.select("doc_id", F.col("text").cast("binary").alias("text"), *document_key())


def repeat_filter(docs: DataFrame, min_chars: int, most_words: int) -> tuple[Geometry, np.ndarray]:
    """The filter of hashes seen in two documents or more."""
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = columns(docs, "text").agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0]
    geometry = Geometry.of(lines or 0, most_words)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = _batch_keys(batch, min_chars)[0]
            # Of equal hashes one is sent, and marked as seen again.
            hashes, times = np.unique(hashes, return_counts=True)
            if not len(hashes):
                continue
            slices, rests = geometry.slices(hashes), geometry.rests(hashes)
            starts = np.flatnonzero(np.diff(slices, prepend=-1))
            ends = [*starts[1:], len(slices)]
            yield batch_of(
                ["slice", "seen", "again"],
                [
                    slices[starts],
                    [rests[a:b].tobytes() for a, b in zip(starts, ends)],
                    [rests[a:b][times[a:b] > 1].tobytes() for a, b in zip(starts, ends)],
                ],
                [pa.int32(), pa.binary(), pa.binary()],
            )

    sent = in_batches(_rows(docs).select("text"), send, "slice int, seen binary, again binary")
    dealt = sent.repartition("slice").sortWithinPartitions("slice")
    filled = in_batches(dealt, lambda batches: _fill(batches, geometry), "slice int, repeats binary")
    size = 1 << geometry.kept_bits
    repeats = np.zeros(size << geometry.slice_bits, np.uint64)
    for number, packed in filled.collect():
        repeats[number * size : (number + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint64)
    return geometry, repeats


def _fill(batches: Iterator[pa.RecordBatch], geometry: Geometry) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by slice; both filters of one slice are held at a time."""
    current, once, again = None, None, None
    shift = np.uint32(32 - geometry.word_bits)

    def put(words: np.ndarray, rests: np.ndarray) -> None:
        np.bitwise_or.at(words, rests >> shift, _bits(rests))

    def finished() -> pa.RecordBatch:
        folded = np.bitwise_or.reduce(again.reshape(1 << geometry.kept_bits, -1), axis=1)
        packed = zlib.compress(folded.tobytes(), 1)
        return batch_of(["slice", "repeats"], [[current], [packed]], [pa.int32(), pa.binary()])

    for batch in batches:
        for number, *packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if number != current:
                if current is not None:
                    yield finished()
                current = number
                once, again = (np.zeros(1 << geometry.word_bits, np.uint64) for _ in range(2))
            seen, twice = (np.frombuffer(p, np.uint32) for p in packed)
            bits = _bits(seen)
            put(again, seen[once[seen >> shift] & bits == bits])
            put(again, twice)
            put(once, seen)
    if current is not None:
        yield finished()


def suspects(docs: DataFrame, geometry: Geometry, repeats, min_chars: int) -> DataFrame:
    """Digest (d1, d2) of every suspected key, summed per batch: n, the number of
    rows that hold it, and the first of these rows (did, th)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2, row = _batch_keys(batch, min_chars)
            suspected = geometry.suspected(repeats.value, d1)
            d1, d2, row = d1[suspected], d2[suspected], row[suspected]
            if not len(d1):
                continue
            did, th = (batch.column(c).to_numpy()[row] for c in ("did", "th"))
            order = np.lexsort((th, did, d2, d1))
            d1, d2, did, th = (x[order] for x in (d1, d2, did, th))
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(d1) != 0) | (np.diff(d2) != 0)]))
            yield batch_of(
                ["d1", "d2", "n", "did", "th"],
                [d1[starts].view(np.int64), d2[starts].view(np.int64),
                 np.diff(starts, append=len(d1)), did[starts], th[starts]],
                [pa.int64()] * 5,
            )

    return in_batches(_rows(docs).select("text", "did", "th"), run, "d1 long, d2 long, n long, did long, th long")


def _held(docs: DataFrame, geometry: Geometry, repeats, min_chars: int) -> DataFrame:
    """Suspected keys document by document: did, th, d1, d2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2, row = _batch_keys(batch, min_chars)
            found = geometry.suspected(repeats.value, d1)
            did, th = (batch.column(c).to_numpy()[row[found]] for c in ("did", "th"))
            yield batch_of(
                ["did", "th", "d1", "d2"],
                [did, th, d1[found].view(np.int64), d2[found].view(np.int64)], [pa.int64()] * 4,
            )

    return in_batches(_rows(docs).select("text", "did", "th"), run, "did long, th long, d1 long, d2 long").distinct()


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, most_words: int = MOST_WORDS) -> DataFrame:
    """Digests (d1, d2) of the keys that at least ``min_docs`` documents hold, how
    many hold them (n), and the first document (did, th; see ``document_key``)."""
    geometry, repeats = repeat_filter(docs, min_chars, most_words)
    return _confirmed(docs, geometry, docs.sparkSession.sparkContext.broadcast(repeats), min_docs, min_chars)


def _confirmed(docs, geometry, repeats, min_docs, min_chars) -> DataFrame:
    if min_docs < 2:
        raise ValueError("a repeat is found in two documents at least")
    found = suspects(docs, geometry, repeats, min_chars)
    return (
        found.groupBy("d1", "d2").agg(F.sum("n").alias("n"), F.min(F.struct("did", "th")).alias("first"))
        .where(F.col("n") >= min_docs)
        .select("d1", "d2", "n", "first.did", "first.th")
    )


def drop_repeated_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    keep: str = "none",
    most_words: int = MOST_WORDS,
    most_keys: int = MOST_KEYS,
) -> DataFrame:
    """Every row of ``docs``: doc_id, text (the lines that stay, joined by line
    feeds), n_lines (before) and n_dropped.

    Lines whose key at least ``min_docs`` documents hold are dropped: all of them,
    or, with ``keep="first"``, all but the first one in the first document (the
    smallest doc_id, then the smallest hash of the text; of rows equal in both,
    each keeps it). Keys of fewer than ``min_chars`` code points stay.

    A null or empty text is one empty line. Every row counts as a document, also
    with a null or repeated doc_id; a key counts once in a document. A document
    that loses all its lines has an empty text. An empty table gives no rows;
    columns other than doc_id and text are ignored.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be none or first, not {keep}")
    context = docs.sparkSession.sparkContext
    geometry, repeats = repeat_filter(docs, min_chars, most_words)
    shared = context.broadcast(repeats)
    confirmed = stage(_confirmed(docs, geometry, shared, min_docs, min_chars))
    fields = ["d1", "d2", "did", "th"]
    schema = "doc_id long, text string, n_lines long, n_dropped long"
    if confirmed.count() <= most_keys:
        rows = confirmed.select(*fields).collect()
        table = context.broadcast({(r.d1, r.d2): (r.did, r.th) for r in rows})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _without(batch, [table.value] * batch.num_rows, min_chars, keep)

        return in_batches(_rows(docs), run, schema)

    # Too many for every task: each document is joined to its own.
    own = (
        _held(docs, geometry, shared, min_chars)
        .join(confirmed.select("d1", "d2", F.struct(*fields).alias("line")), ["d1", "d2"])
        .groupBy("did", "th").agg(F.collect_list("line").alias("lines"))
    )

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = [
                {(x["d1"], x["d2"]): (x["did"], x["th"]) for x in lines or ()}
                for lines in batch.column("lines").to_pylist()
            ]
            yield _without(batch, tables, min_chars, keep)

    return in_batches(_rows(docs).join(own, ["did", "th"], "left"), run_joined, schema)


def _without(batch: pa.RecordBatch, tables: list[dict], min_chars: int, keep: str) -> pa.RecordBatch:
    """The texts of a batch without the lines listed for each row, by digest."""
    kept, before, dropped = [], [], []
    documents = zip(batch.column("did").to_pylist(), batch.column("th").to_pylist())
    for text, table, document in zip(_texts(batch), tables, documents):
        lines = text.split(b"\n")
        keys = _keys(lines, min_chars)
        counted = list({key for key in keys if key is not None})
        d1, d2 = (d.view(np.int64).tolist() for d in _digests(counted))
        owners = {key: table[pair] for key, pair in zip(counted, zip(d1, d2)) if pair in table}
        if owners:
            first = {key for key, owner in owners.items() if keep == "first" and owner == document}
            stays = []
            for line, key in zip(lines, keys):
                if key not in owners or key in first:
                    stays.append(line)
                    first.discard(key)
            text = b"\n".join(stays)
        else:
            stays = lines
        kept.append(text)
        before.append(len(lines))
        dropped.append(len(lines) - len(stays))
    return batch_of(
        ["doc_id", "text", "n_lines", "n_dropped"],
        [batch.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()), before, dropped],
        [None, None, pa.int64(), pa.int64()],
    )


ORACLE_SQL = f"""
WITH lines AS (
  SELECT d.rowid_ AS r, d.doc_id, unnest(string_split(d.body, chr(10))) AS line,
         generate_subscripts(string_split(d.body, chr(10)), 1) AS place
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, coalesce(text, '') AS body FROM documents) d
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT r) >= {MIN_DOCS}
), marked AS (
  SELECT keyed.*, common.key IS NOT NULL AS dropped FROM keyed LEFT JOIN common ON keyed.key = common.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
