"""Words of whole batches of texts, as 64-bit hashes, with numpy."""

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES_AT_ONCE = 4 << 20
_BLOCK = 1 << 18
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finishing step of the public splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_ODD = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
# Keeps the first n of eight little-endian bytes.
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TO_LOWER = _LOWER.tobytes()


def byte_class(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)])


# Words of all bytes but ASCII white space.
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
# Words of ASCII digits and letters and of all bytes beyond ASCII.
ALPHANUMERIC = byte_class(
    lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A
)


@dataclass
class Words:
    """The words of a batch: hash and byte range of each, and the first word of each text."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def text(self, word: int) -> bytes:
        return self.data[self.starts[word] : self.ends[word]].tobytes().translate(_TO_LOWER)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one text after another, and the texts' offsets; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data, offsets


def release_memory() -> None:
    """Gives freed memory back to the system; workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library than glibc


def slices(batch: pa.RecordBatch, text_col: str, limit: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about ``limit`` bytes of text; a longer text is a run of its own."""
    _, offsets = utf8(batch[text_col])
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def _hash_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, eight bytes at a time; ``data`` ends with eight spare bytes."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    hashes = mix(lengths.astype(np.uint64) * _ODD[0] + (eight[starts] & _KEEP[np.minimum(lengths, 8)]))
    more = np.flatnonzero(lengths > 8)
    done = 8
    while len(more) and done < _LONG:
        part = eight[starts[more] + done] & _KEEP[np.minimum(lengths[more] - done, 8)]
        hashes[more] = mix((hashes[more] ^ part) * _ODD[1])
        done += 8
        more = more[lengths[more] > done]
    for i in more:
        body = data[starts[i] : starts[i] + lengths[i]].tobytes()
        hashes[i] = int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little")
    return hashes


def _block_words(lowered: np.ndarray, inner: np.ndarray, is_word: np.ndarray):
    """Start, end and hash of the words of one block; ``inner``: where a new text begins in it."""
    word = is_word[lowered[:-8]]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    begin[inner] = word[inner]
    last = word.copy()
    last[:-1] &= ~word[1:] | begin[1:]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return starts, ends, _hash_words(lowered, starts, ends - starts)


def words_of(column: pa.Array, is_word: np.ndarray) -> Words:
    """The words of each text, A-Z lower-cased; works through the bytes in blocks of about 1 MB."""
    data, offsets = utf8(column)
    low, high = int(offsets[0]), int(offsets[-1])
    found = []
    while low < high:
        end = min(low + _BLOCK, high)
        while end < high and is_word[data[end]] and is_word[data[end - 1]]:
            # Never cut a word: go on to its end, at most to the end of its text.
            text_end = int(offsets[np.searchsorted(offsets, end, side="left")])
            gap = np.flatnonzero(~is_word[data[end : min(end + _BLOCK, text_end)]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + _BLOCK, text_end)
            if end == text_end:
                break
        a, b = np.searchsorted(offsets, [low, end])
        inner = np.unique(offsets[a:b]) - low
        lowered = np.frombuffer(data[low:end].tobytes().translate(_TO_LOWER) + bytes(8), np.uint8)
        starts, ends, hashes = _block_words(lowered, inner[inner < end - low], is_word)
        found.append((starts + low, ends + low, hashes))
        low = end
    if not found:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    starts, ends, hashes = (np.concatenate(x) for x in zip(*found))
    return Words(data, hashes, starts, ends, np.searchsorted(starts, offsets))


def runs_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words in a row, also where it runs over the end of a text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * _ODD[0]
    for k in range(1, width):
        total += hashes[k : k + n] * _ODD[k]
    return mix(total + np.uint64(width))


def short_run(hashes: np.ndarray) -> np.ndarray:
    """The hash of a whole text as one run, as an array of one."""
    return runs_of(hashes, len(hashes))
