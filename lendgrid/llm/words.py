"""Words of texts as numbers, for the tasks that count and compare them in NumPy."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_EDGE = string.punctuation + "“”‘’«»…–—¿¡"
#: Words of more bytes are hashed one by one, so that no text, however long its words are, needs many rounds.
_LONG = 64
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


class Remembered(dict):
    """Values computed once for each key, up to a number of keys; then it starts afresh, so memory stays bounded."""

    def __init__(self, compute, most: int = 200_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


def _cores(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, in lower case without punctuation at their ends (which may leave nothing), and
    at which word each text begins and the last one ends."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    offsets = np.asarray(lists.offsets, np.int64)
    return pc.utf8_trim(lists.flatten(), characters=_EDGE), offsets - offsets[0]


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit number for each string, 8 bytes a round; 0 for an empty one."""
    wide = pa.types.is_large_string(words.type)
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    at, left = ends[:-1].copy(), np.diff(ends)
    value = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    long = np.flatnonzero(left > _LONG)
    live = np.flatnonzero((left > 0) & (left <= _LONG))
    if len(live):
        held = bytes(data) + bytes(8)
        eights = np.ndarray(len(held) - 7, "<u8", held, 0, (1,))
    while len(live):
        mixed = (value[live] ^ (eights[at[live]] & _FIRST[np.minimum(left[live], 8)])) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x94D049BB133111EB)
        value[live] = mixed ^ (mixed >> np.uint64(29))
        at[live] += 8
        left[live] -= 8
        live = live[left[live] > 0]
    for i in long.tolist():
        value[i] = xxhash.xxh64_intdigest(words[i].as_buffer())
    value |= np.uint64(1)
    value[np.diff(ends) == 0] = 0
    return value


def number_words(words: list[str]) -> list[int]:
    """The number of each plain word."""
    return _hashes(pa.array(words, pa.string())).tolist() if words else []


def plain_words(text: str) -> list[str]:
    """The words that ``number_texts`` numbers."""
    return [w for w in _cores(pa.array([text], pa.string()))[0].to_pylist() if w]


def number_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all words one after the other, and where each text ends."""
    words, begins = _cores(texts)
    numbers = _hashes(words) if len(words) else np.empty(0, np.uint64)
    there = numbers > 0
    return numbers[there], np.concatenate([[0], np.cumsum(there)])[begins[1:]]


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words one after the other, and where each word begins and the last one ends."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = words.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
    if len(data) and data.max() >= 0xE0:  # code points of three bytes or more
        flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
        return flat, np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64))])
    lead = (data & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(lead)])
    flat = data[lead].astype(np.uint32)
    two = np.flatnonzero(data >= 0xC0)
    flat[at[two]] = ((data[two] & 0x1F).astype(np.uint32) << 6) | (data[two + 1] & 0x3F)
    return flat, at[ends - ends[0]]
