"""SimHash near-dedup: 64-bit fingerprints of 4-word shingles, linked at 4 or fewer differing bits.

Candidates come from the pigeonring principle. A fingerprint is cut into a ring of 5 segments. If two fingerprints differ in
4 bits at most, then from some segment on, the differences of the first 1, 2, 3, ... segments of the ring sum up to no more than
4/5, 8/5, 12/5, ..., that is 0, 1, 2, 3, 4. So the first segment is equal, and of the next two, cut in halves, enough halves
are equal for one of five pairs to be: this gives 25 keys of about 26 bits a fingerprint, and pairs that share a key go on
to the whole chain and at last to the full count of differing bits.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lendgrid.llm.components import connected_components
from lendgrid.llm.frames import fresh, slices, texts_as_bytes, written

SEED = 42
SHINGLE = 4
BITS = 4
#: Bits of each segment of the ring, lowest first.
SEGMENTS = (13, 13, 13, 13, 12)
#: Rows that one slice of texts may hold, in bytes.
_SLICE = 4 << 20


def _span(start: int, width: int) -> int:
    return ((1 << width) - 1) << start


def _ring() -> tuple[list[int], list[tuple[int, int]]]:
    """The mask of each segment, and (first segment, mask) of each key."""
    starts = [sum(SEGMENTS[:i]) for i in range(len(SEGMENTS))]
    whole = [_span(s, w) for s, w in zip(starts, SEGMENTS)]
    halves = [(_span(s, w // 2), _span(s + w // 2, w - w // 2)) for s, w in zip(starts, SEGMENTS)]
    keys = []
    for i in range(len(SEGMENTS)):
        (a1, a2), (b1, b2) = halves[(i + 1) % len(SEGMENTS)], halves[(i + 2) % len(SEGMENTS)]
        keys += [(i, whole[i] | pair) for pair in (a1 | a2, a1 | b1, a1 | b2, a2 | b1, a2 | b2)]
    return whole, keys


SEGMENT_MASKS, KEYS = _ring()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes) -> int:
    """The SimHash of a text in UTF-8: bit by bit the majority of its shingles' XXH64."""
    words = text.lower().split()  # of bytes: only A-Z and only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return digest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: 1 - SHINGLE].tolist()
    total = np.zeros(64, np.int64)
    n = len(starts)
    stops = ends[SHINGLE - 1:].tolist()
    for at in range(0, n, 65536):
        found = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + 65536], stops[at:at + 65536])], np.uint64)
        total += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for part in slices(batches, "text", _SLICE):
        found = [_signed(fingerprint(t)) for t in texts_as_bytes(part.column(1))]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])


def within_chain(differing: np.ndarray, first: int) -> np.ndarray:
    """Which of these XORs keep the ring's budgets from segment ``first`` on; the last one is the full count."""
    alive = np.arange(len(differing))
    mask, ring = 0, len(SEGMENTS)
    for length in range(1, ring + 1):
        mask |= SEGMENT_MASKS[(first + length - 1) % ring]
        counts = np.bitwise_count(differing[alive] & np.uint64(mask))
        alive = alive[counts <= length * BITS // ring]
    return alive


#: A larger bucket is cut once more by the bits that its key leaves open.
_LARGE = 4096


def bucket_links(values: np.ndarray, first: int, key_mask: int) -> list[tuple[int, int]]:
    """Links that join what is linked within a bucket: a forest, not all pairs."""
    if len(values) > _LARGE:
        # at most BITS open bits differ, so one of BITS + 1 parts of them is equal
        open_bits = [b for b in range(64) if not key_mask >> b & 1]
        links = []
        for part in range(BITS + 1):
            mask = sum(1 << b for b in open_bits[part::BITS + 1])
            order = np.argsort(values & np.uint64(mask), kind="stable")
            keys = (values & np.uint64(mask))[order]
            for group in np.split(order, np.flatnonzero(keys[1:] != keys[:-1]) + 1):
                if 1 < len(group):
                    links += _forest(values[group], first)
        return links
    return _forest(values, first)


def _forest(values: np.ndarray, first: int) -> list[tuple[int, int]]:
    links, rest = [], values
    front: list = []
    while len(rest):
        if not front:
            front, rest = [rest[0]], rest[1:]
        node = front.pop()
        near = within_chain(rest ^ node, first)
        if len(near):
            found = rest[near]
            links += [(int(node), int(x)) for x in found]
            front.extend(found)
            rest = np.delete(rest, near)
    return links


def _link_buckets(batches):
    """Links within each bucket of rows (``j``, ``key``, ``fp``) sorted by bucket; a bucket may go over several batches."""
    def linked(j, key, fp):
        edges = []
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (j[1:] != j[:-1])) + 1
        sizes = np.diff(np.concatenate([[0], cuts, [len(key)]]))
        starts = np.concatenate([[0], cuts])
        for size in (2, 3, 4):  # small buckets all at once: the pairs at each distance
            at = starts[sizes == size]
            for x in range(size):
                for y in range(x + 1, size):
                    a, b = fp[at + x], fp[at + y]
                    near = np.flatnonzero(np.bitwise_count(a ^ b) <= BITS)
                    edges += zip(a[near].tolist(), b[near].tolist())
        for at, size in zip(starts[sizes > 4].tolist(), sizes[sizes > 4].tolist()):
            first, mask = KEYS[int(j[at])]
            edges += bucket_links(fp[at:at + size], first, mask)
        return edges

    held = None
    for batch in chain(batches, [None]):
        if batch is None:
            whole, held = held, None
        else:
            now = [np.asarray(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(2)).view(np.uint64)]
            if held is not None:
                now = [np.concatenate([a, b]) for a, b in zip(held, now)]
            j, key, _ = now
            # the last bucket may go on in the next batch
            changes = np.flatnonzero((key[1:] != key[:-1]) | (j[1:] != j[:-1]))
            end = changes[-1] + 1 if len(changes) else 0
            whole, held = [x[:end] for x in now], [x[end:] for x in now]
        if whole is not None and len(whole[0]):
            edges = np.array(linked(*whole), np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])


def fingerprint_links(fingerprints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints (``fp``) at ``BITS`` or fewer differing bits."""
    keys = F.array(*[F.struct(F.lit(j).cast("short").alias("j"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"), F.col("fp").alias("fp"))
                     for j, (_, mask) in enumerate(KEYS)])
    rows = fingerprints.select(F.explode(keys).alias("k")).select("k.*")
    dealt = rows.repartition("j", "key").sortWithinPartitions("j", "key")
    return dealt.mapInArrow(_link_buckets, "a long, b long").distinct()


def _classes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` and ``root`` (the class itself, as one of its fingerprints) of every row."""
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = written(texts.mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    parts = written(connected_components(fingerprint_links(distinct.select("fp"))), "components")
    of_fp = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    several = of_fp.filter("component IS NOT NULL")
    least = several.groupBy("component").agg(F.min("least").alias("of_component"))
    classes = several.join(least, "component").select("fp", F.col("of_component").alias("component_id"), F.col("component").alias("root")).unionByName(
        of_fp.filter("component IS NULL").select("fp", F.col("least").alias("component_id"), F.col("fp").alias("root")))
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id", "root")


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, one row per row of ``docs``.

    The component is the smallest id that links lead to. Texts without words, missing ones included, have fingerprint zero and
    are linked like any other; a text of fewer than 4 words is one shingle. Missing ids are never the smallest; a component
    of nothing else has none. Other columns are ignored. Fingerprints are written once; equal ones are one node, so copies of
    a text make no links, and a bucket of near copies gives a forest instead of all its pairs.
    """
    return _classes(docs, doc_id, text).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class of near duplicates: a row with the class's smallest id; rows that repeat it count once.

    Rows that share an id but not a class are judged each by their own class. Rows without an id are kept: nothing tells them apart.
    """
    known = docs.filter(F.col(f"`{doc_id}`").isNotNull())
    classes = _classes(known, doc_id, text)
    name, several, goes, mixed = fresh(docs, "class_id", "several", "goes", "mixed")
    # only ids that go, stand for several rows or are of several classes are joined: few beside all rows, so the texts mostly stay where they are
    ids = classes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("least"), F.min("root").alias("first"), F.max("root").alias("last"))
    apart = F.col("first") != F.col("last")
    marks = ids.select(F.col("doc_id").alias(name), (~apart & (F.col("n") > 1)).alias(several), (~apart & (F.col("least") != F.col("doc_id"))).alias(goes), apart.alias(mixed))
    marked = docs.join(written(marks.filter(F.col(several) | F.col(goes) | F.col(mixed)), "duplicates"), F.col(f"`{doc_id}`") == F.col(name), "left")
    left = marked.filter(F.col(name).isNull() | ~F.col(goes))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = left.filter(F.col(mixed)).select(F.struct(*columns).alias("row"), F.col(name).alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def mark(batches):
        for part in slices(batches, "text", _SLICE):
            found = [_signed(fingerprint(t)) for t in texts_as_bytes(part.column(2))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.int64())], names=["row", "doc_id", "fp"])

    kind = T.StructType([own.schema["row"], T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])
    judged = own.mapInArrow(mark, kind).join(classes.filter(F.col("component_id") == F.col("doc_id")).select("doc_id", "fp", "root").distinct(), ["doc_id", "fp"])
    return left.filter(F.col(name).isNull()).select(*columns).unionByName(left.filter(F.col(several)).dropDuplicates([name]).select(*columns)).unionByName(
        judged.dropDuplicates(["doc_id", "root"]).select("row.*"))
