"""SimHash near-duplicates, found with covering locality-sensitive hashing.

Fingerprints within ``RADIUS`` bits are links. Every bit position i has a label
m(i), a non-zero vector of RADIUS + 1 bits; table v (any non-zero vector) keeps
the positions with <m(i), v> = 1. RADIUS positions have RADIUS labels, so some
non-zero v is orthogonal to all of them: whatever bits a pair differs in, some
table keeps none of them, and the pair meets there. That is a guarantee, not a
probability, and it takes 2^(RADIUS + 1) - 1 = 15 tables.

Only distinct fingerprints enter the tables. A bucket is joined within one task,
which emits a spanning forest of its links, never all pairs. A bucket with more
than ``BUCKET_ROWS`` fingerprints is dealt once more by a covering of the bits
that its table leaves out; such an inner bucket can only hold fingerprints that
agree in two masks, at most 2^16 of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from layerwell.llm.common import batch_of, columns, document_key, in_batches, mapped
from layerwell.llm.components import connected_components
from layerwell.sinks.parquet import stage

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 3
BUCKET_ROWS = 2000


def masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Covering masks over the given bit positions."""
    labels = {p: i % (2 ** (radius + 1) - 1) + 1 for i, p in enumerate(positions)}
    return [
        sum(1 << p for p, label in labels.items() if bin(label & v).count("1") % 2)
        for v in range(1, 2 ** (radius + 1))
    ]


MASKS = masks(list(range(BITS)))
INNER = [masks([p for p in range(BITS) if not mask >> p & 1]) for mask in MASKS]


def fingerprint(text: str | None) -> int:
    """A bit is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(BITS, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, did, th (see ``document_key``) and fp (as a signed long)."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        return batch_of(
            ["doc_id", "did", "th", "fp"],
            [*(batch.column(c) for c in ("doc_id", "did", "th")), pa.array(prints.view(np.int64))],
            [None] * 4,
        )

    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = rows.select("doc_id", "text", *document_key())
    return mapped(keyed, step, "doc_id long, did long, th long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct values of ``fp``: enough of the pairs
    within the radius to connect what all of them connect."""
    distinct = prints.select("fp").distinct()
    tables = F.array(*[
        F.struct(F.lit(t).alias("t"), F.lit(_signed(mask)).alias("mask")) for t, mask in enumerate(MASKS)
    ])
    dealt = distinct.select("fp", F.explode(tables).alias("x")).select(
        F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"), "fp"
    )
    # Counts are summed before the exchange; only full buckets are kept.
    full = dealt.groupBy("t", "key").count().where(F.col("count") > BUCKET_ROWS).select("t", "key", F.lit(True).alias("full"))
    inner = F.array(*[
        F.array(*[F.struct(F.lit(u).alias("u"), F.lit(_signed(m)).alias("mask")) for u, m in enumerate(row)])
        for row in INNER
    ])
    plain = F.array(F.struct(F.lit(-1).alias("u"), F.lit(0).cast("long").alias("mask")))
    spread = (
        dealt.join(full, ["t", "key"], "left")
        .select("t", "key", "fp", F.explode(F.when(F.col("full"), F.get(inner, F.col("t"))).otherwise(plain)).alias("x"))
        .select("t", "key", F.col("x.u").alias("u"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("sub"), "fp")
    )
    keys = ["t", "key", "u", "sub"]
    grouped = spread.repartition(*keys).sortWithinPartitions(*keys)
    return in_batches(grouped, _bucket_links, "a long, b long").distinct()


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; a bucket may go on in the next batch."""
    keys, held = ["t", "key", "u", "sub"], None
    for batch in batches:
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "fp")]
        if held is not None:
            now = [np.concatenate(pair) for pair in zip(held, now)]
        change = np.zeros(len(now[0]), bool)
        for column in now[:4]:
            change[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(change)
        if not len(starts):
            held = now
            continue
        held = [column[starts[-1] :] for column in now]
        yield from _forest(now[4], np.concatenate([[0], starts]))
    if held is not None and len(held[4]):
        yield from _forest(held[4], np.array([0, len(held[4])]))


def _forest(values: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    sizes = np.diff(starts)
    twos = starts[:-1][sizes == 2]
    left, right = values[twos], values[twos + 1]
    near = np.bitwise_count((left ^ right).view(np.uint64)) <= RADIUS
    made = [np.stack([left[near], right[near]], axis=1)]
    for i in np.flatnonzero(sizes > 2):
        made.append(spanning_forest(values[starts[i] : starts[i + 1]]))
    if len(pairs := np.concatenate(made)):
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def spanning_forest(values: np.ndarray) -> np.ndarray:
    """Links that connect all of the distinct values within the radius of each
    other. Each value is compared once with those not reached yet."""
    rest, links = values.view(np.uint64), []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            value = queue.pop()
            near = np.bitwise_count(rest ^ value) <= RADIUS
            if near.any():
                found, rest = rest[near], rest[~near]
                links.append(np.stack([np.full(len(found), value), found], axis=1))
                queue.extend(found)
    return np.concatenate(links).view(np.int64) if links else np.empty((0, 2), np.int64)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row with its fingerprint (16 hex digits) and component_id, the
    smallest doc_id reachable over links of at most 3 differing bits.

    Null and empty texts, and texts of white space only, have fingerprint zero
    and are linked like any other. Fewer than three words form one shingle. Rows
    may repeat: each is returned. A null doc_id takes part, but is a component's
    id only if no row of it has one. An empty table gives no rows; columns other
    than doc_id and text are ignored.
    """
    prints = stage(fingerprints(docs))
    return _with_component(prints).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_component(prints: DataFrame) -> DataFrame:
    """Adds group (a fingerprint that names the component) and component_id."""
    roots = connected_components(near_links(prints))
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = smallest.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("group")
    )
    of_group = named.groupBy("group").agg(F.min("least").alias("component_id"))
    labels = stage(named.select("fp", "group").join(of_group, "group"))
    return prints.join(labels, "fp")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with
    all its columns, whatever their names. Rows equal in doc_id and text count as
    copies too. Nulls are linked as in :func:`near_duplicates`; of a component
    with a null doc_id, a row without one stays. An empty table gives no rows."""
    prints = stage(fingerprints(docs))
    kept = (
        _with_component(prints)
        .groupBy("group").agg(F.min(F.struct("did", "th")).alias("first"))
        .select("first.did", "first.th")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    same = Window.partitionBy("did", "th").orderBy(F.lit(0))
    return (
        docs.select(*document_key(), row)
        .join(kept, ["did", "th"], "left_semi")
        .withColumn("copy", F.row_number().over(same))
        .where("copy = 1")
        .select("row.*")
    )
