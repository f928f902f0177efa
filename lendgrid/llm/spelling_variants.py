"""Spelling variant grouping: words one edit apart, found by Gram matrices of letter counts, follow their most frequent neighbours."""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendgrid.llm.frames import written
from lendgrid.llm.words import letters

#: A run of letters; the least length of a word, and the least number of its occurrences.
RUN, LEAST_LENGTH, LEAST_COUNT = r"[A-Za-zÀ-ÿ]", 7, 2
#: A form is at least so many times as frequent as its word.
TIMES = 10
#: Home words of a block of one task at most, words whose matrices are made together, and entries of a product at a time.
BLOCK, TOGETHER, TILE = 8192, 4096, 1 << 19
#: Letters of a word up to which squared distances are whole numbers in single precision.
SINGLE = 1000
#: Code points of one block held together, unless a single word has more.
LETTERS = 1 << 22


def slipped_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 31) -> DataFrame:
    """``word`` and ``n``: the words of all texts, some runs of letters with one letter left out, and their occurrences.

    A word is a maximal run of letters of the whole text with A to Z in lower case; a run whose CRC-32 together with the id is divisible by ``every``
    loses the letter that the CRC names. Only words of ``LEAST_LENGTH`` and ``LEAST_COUNT`` or more stay. A null text has no
    words, a null id counts as an empty one, repeated rows count each.
    """
    # shorter runs cannot become words, and a longer one is matched from its start to its end
    runs = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"{RUN}{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    lower = runs.select("id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("run")).alias("run"))
    h = lower.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = h.select(F.when(F.col("h") % every == 0, short).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def class_number(words: int) -> int:
    """Into how many classes letters are put: more for more words, so that the words that share their class counts stay about as many."""
    return min(12, max(3, 2 + round(math.log(max(words, 1) / 1000, 8))))


def _halves(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of the first and of the last half of each word, and of the halves that one letter less would have.

    One edit leaves one half of the shorter word as it is, so the words of a pair have equal sums of one of them.
    """
    place = np.arange(len(flat)) - np.repeat(begins[:-1], sizes)
    weights = np.random.default_rng(0).integers(1, 1 << 62, int(sizes.max()), np.uint64)
    forth = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * weights[place], dtype=np.uint64)])
    back = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * weights[np.repeat(sizes, sizes) - 1 - place], dtype=np.uint64)])
    less = np.maximum(sizes - 1, 0)
    head = [forth[begins[:-1] + n // 2] - forth[begins[:-1]] for n in (sizes, less)]
    tail = [back[begins[1:]] - back[begins[1:] - (n - n // 2)] for n in (sizes, less)]
    return head[0], tail[0], head[1], tail[1]


def block_keys(words: pa.Array, classes: int) -> np.ndarray:
    """The blocks of each word: in the first column its home, then those where it is a guest.

    The key of a block is the number of letters in each class, as digits of one number. A word with one more letter, or with another one in the place of one, is
    in the same block or in one whose key differs by one or two digits. Of each pair of such blocks one sends its words to the
    other, so two words one edit apart meet in exactly one block. Blocks of one key hold words of one length, and guests are
    as long or one shorter.
    """
    flat, begins = letters(words)
    bits = 62 // classes
    unit = np.uint64(1) << (np.arange(classes, dtype=np.uint64) * np.uint64(bits))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(unit[flat % classes], dtype=np.uint64)])
    home = sums[begins[1:]] - sums[begins[:-1]]
    moves = [np.uint64(0), *unit, *[unit[i] - unit[j] for i in range(classes) for j in range(i)]]
    return (home[:, None] + np.array(moves, np.uint64)[None, :]).view(np.int64)


def _one_edit(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words ``a`` become the words ``b``, as long or one longer, by one replaced or inserted letter."""
    out = np.zeros(len(a), bool)
    order = np.argsort(sizes[a], kind="stable")
    start = 0
    while start < len(order):
        # pairs of about the same length, so that few cells are padding
        width = int(sizes[a[order[start]]])
        end = min(len(order), start + max(1, TILE // (8 * (width + 2))))
        end = start + int(np.searchsorted(sizes[a[order[start:end]]], width + max(2, width // 4), "right"))
        part = order[start:end]
        i, j = a[part], b[part]
        place = np.arange(int(sizes[i].max()))[None, :]
        inside = place < sizes[i][:, None]
        first = flat[np.minimum(begins[i][:, None] + place, len(flat) - 1)]
        ahead = flat[np.minimum(begins[j][:, None] + place, len(flat) - 1)]
        behind = flat[np.minimum(begins[j][:, None] + place + 1, len(flat) - 1)]
        unlike = (first != ahead) & inside
        shifted = (first != behind) & inside
        # an inserted letter: equal up to the first difference, and from there with the next letter
        reached = np.logical_or.accumulate(unlike, axis=1)
        out[part] = np.where(sizes[i] == sizes[j], unlike.sum(axis=1) == 1, ~(shifted & reached).any(axis=1))
        start = end
    return out


def near_pairs(words: pa.Array, home: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of the words one edit apart: pairs of home words of a block, and of a home word with a guest of its block.

    The counts of each letter make the rows of two matrices, and the products of their blocks the squared distances. One edit
    changes them by 1 (a letter more) or 2 (a letter for another); such pairs of the same or the next length are compared
    letter by letter if one of their halves agrees.
    """
    flat, begins = letters(words)
    sizes = np.diff(begins)
    if not len(flat):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if flat.max() < 1 << 16:
        seen = np.bincount(flat) > 0
        width, column = int(seen.sum()), (np.cumsum(seen) - 1)[flat]
    else:
        alphabet, column = np.unique(flat, return_inverse=True)
        width = len(alphabet)
    at = np.repeat(np.arange(len(sizes)) * width, sizes) + column
    counts = np.bincount(at, minlength=len(sizes) * width).reshape(len(sizes), width).astype(np.float32 if sizes.max() <= SINGLE else np.float64)
    norms = (counts * counts).sum(axis=1, keepdims=True)
    one = np.ones_like(norms)
    right = np.concatenate([counts, one, norms], axis=1).T.copy()
    head, tail, less_head, less_tail = _halves(flat, begins, sizes)
    own, found = np.flatnonzero(home), []
    step = max(1, TILE // len(sizes))
    for start in range(0, len(own), step):
        rows = own[start:start + step]
        # |a|^2 + |b|^2 - 2ab in one product
        squared = np.concatenate([-2 * counts[rows], norms[rows], one[rows]], axis=1) @ right
        near = np.flatnonzero(squared.reshape(-1) < 2.5)
        i, j = np.divmod(near, len(sizes))
        apart = squared.reshape(-1)[near] > 0.5
        i, j = rows[i[apart]], j[apart]
        there = (block[i] == block[j]) & (~home[j] | (i < j)) & (np.abs(sizes[i] - sizes[j]) <= 1)
        i, j = i[there], j[there]
        swap = sizes[i] > sizes[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        equal = sizes[i] == sizes[j]
        half = (head[i] == np.where(equal, head[j], less_head[j])) | (tail[i] == np.where(equal, tail[j], less_tail[j]))
        i, j = i[half], j[half]
        same = _one_edit(flat, begins, sizes, i, j)
        found.append((i[same], j[same]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of the near pairs of the rows ``key part role word n`` that are sorted by ``key part role``.

    Blocks are taken together while they are small. Of a block only its home words are held; guests come in pieces.
    """
    schema = None
    waiting: list[pa.RecordBatch] = []
    rows = chars = 0
    homes = None  # of the block that the last rows before this point belong to: its key, part and home words

    def flush():
        nonlocal waiting, rows, chars, homes
        if not waiting:
            return
        new = pa.Table.from_batches(waiting, schema)
        waiting, rows, chars = [], 0, 0
        if not new.num_rows:
            return
        keys = np.stack([new.column(c).to_numpy() for c in ("key", "part")], axis=1)
        role = new.column("role").to_numpy()
        kept = 0
        if homes is not None and tuple(keys[0]) == homes[0]:
            # a block that was cut goes on: its home words come first, and what they had among themselves is known
            kept = homes[1].num_rows
            keys, role = np.concatenate([np.repeat(keys[:1], kept, axis=0), keys]), np.concatenate([np.zeros(kept, role.dtype), role])
            new = pa.concat_tables([homes[1], new])
        block = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))])
        home = role == 0
        last = np.flatnonzero((block == block[-1]) & home)
        homes = (tuple(keys[-1]), new.take(pa.array(last)))
        met = np.flatnonzero((np.bincount(block, home) > 0)[block])  # guests without a host go
        words, n = new.column("word").combine_chunks().take(pa.array(met)), new.column("n").combine_chunks().take(pa.array(met))
        a, b = near_pairs(words, home[met], block[met])
        unseen = (met[a] >= kept) | (met[b] >= kept)
        for x, y in ((a[unseen], b[unseen]), (b[unseen], a[unseen])):
            at, to = pa.array(x), pa.array(y)
            yield pa.RecordBatch.from_arrays([words.take(at), words.take(to), n.take(to)], names=["word", "near", "near_n"])

    for batch in batches:
        schema = batch.schema
        sizes = pa.compute.binary_length(batch.column(batch.schema.get_field_index("word"))).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and (rows + i - start >= TOGETHER or chars + held + size > LETTERS):
                waiting.append(batch.slice(start, i - start))
                yield from flush()
                start, held = i, 0
            held += size
        waiting.append(batch.slice(start))
        rows, chars = rows + batch.num_rows - start, chars + held
    yield from flush()


def near_words(words: DataFrame, classes: int | None = None, block: int = BLOCK) -> DataFrame:
    """``word near near_n``: both directions of all pairs of words (``word``, ``n``; distinct) one inserted, deleted or replaced code point apart.

    Words meet by the counts of their letters in ``classes`` classes (which only decides how the work is cut). The home words of a block
    are dealt into parts of about ``block`` words; the words of other parts and guests go to each of them. So no task holds more than
    a part, and every pair is met once.
    """
    classes = classes or class_number(words.count())

    def send(batches):
        for batch in batches:
            keys = block_keys(batch.column(0), classes)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["word", "n", "keys"])

    sent = words.select("word", "n").mapInArrow(send, "word string, n long, keys array<long>")
    met = sent.select("word", "n", F.posexplode("keys").alias("role", "key"))
    large = written(sent.groupBy(F.col("keys")[0].alias("key")).agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > block)
                    .select("key", F.ceil(F.col("words") / block).cast("int").alias("parts")), "blocks")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    # home words go to their own part, and as guests to the later ones; guests go to all
    parts = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("role") > 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.sequence(own, F.col("parts") - 1))
    dealt = met.join(large, "key", "left").select("word", "n", "key", "role", F.posexplode(parts).alias("later", "part"))
    rows = dealt.select("key", "part", F.when((F.col("role") == 0) & (F.col("later") == 0), 0).otherwise(1).alias("role"), "word", "n")
    return rows.repartition("key", "part").sortWithinPartitions("key", "part", "role").mapInArrow(_links, "word string, near string, near_n long")


def group_spellings(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word form root n n_near form_n`` for every row of ``words`` (``word``, ``n``; distinct words, no nulls).

    ``form`` is the most frequent near word (of equals the first in code-point order) if it is ``times`` times as frequent or more,
    else null; ``root`` follows forms to the last. Forms become at least ``times`` times as frequent with each step, so the
    way to a root is short, and following it takes as many rounds as doubling needs. Links are summed per word before they are shuffled.
    """
    table = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = near_words(table).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    joined = table.join(best, "word", "left")
    follows = -F.col("best.less") >= times * F.col("n")
    formed = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(follows, F.col("best.near")).alias("form"),
                                   F.when(follows, -F.col("best.less")).alias("form_n")), "forms")
    way = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = written(way.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        way = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            break
    return formed.join(way, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
