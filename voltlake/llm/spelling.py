"""Spelling variants of words, found by PartEnum signatures of their letters."""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import Workspace
from .wordhash import release_memory, slices, utf8

# Fixed value: a run loses one letter if this divides its checksum.
_DROP_ONE_IN = 97

MIN_LENGTH = 5
MIN_COUNT = 3
# A form occurs at least so many times as often as its variant.
FORM_RATIO = 2

# Parts into which the letters are dealt, for one replaced letter and for one inserted.
REPLACED_PARTS = 3
INSERTED_PARTS = 2
STRETCHES = 4

# Bytes of text searched at once, and words counted in a task before they are handed on.
_BLOCK = 4 << 20
_COUNTED = 1 << 18
# Checksums of runs of up to so many bytes are made for all runs of a block together.
_SHORT = 64

_ALPHABET = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LETTER = np.array([0x61 <= b <= 0x7A for b in range(256)])
# First byte of U+00C0 to U+00FF in UTF-8, and of nothing else.
_LEAD = 0xC3
_SAFE_CUT = re.compile(rb"[\x00-\x60\x7B-\x7F\xC4-\xFF]")


def _checksum_table() -> np.ndarray:
    """What the public CRC-32 makes of one byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


_CHECKSUMS = _checksum_table()


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, list[int]]]:
    """Lower-cased bytes of some texts, where each begins, and the checksums of their ids and a colon.

    A text of more than one block comes in several that cut no run of letters.
    """
    for part in slices(batch, "_text", _BLOCK):
        ids = [zlib.crc32(f"{doc_id.as_py() or ''}:".encode()) for doc_id in part[0]]
        data, offsets = utf8(part[1])
        lowered = data[offsets[0] : offsets[-1]].tobytes().translate(_LOWER)
        if part.num_rows > 1 or len(lowered) <= _BLOCK:
            yield lowered, offsets[:-1] - offsets[0], ids
            continue
        begin = 0
        while begin < len(lowered):
            cut = _SAFE_CUT.search(lowered, begin + _BLOCK)
            end = cut.start() if cut else len(lowered)
            yield lowered[begin:end], np.zeros(1, np.int64), ids
            begin = end


def _runs(lowered: bytes, texts: np.ndarray, min_length: int) -> tuple[pa.Array, np.ndarray]:
    """The runs of at least ``min_length`` letters, and the place in ``texts`` of each."""
    data = np.frombuffer(lowered, np.uint8)
    lead = data == _LEAD
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = texts[texts < len(data)]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    offsets = np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside)).astype(np.int64)
    n_leads = np.append(np.cumsum(lead[inside]) - lead[inside], np.count_nonzero(lead))
    long_enough = np.diff(offsets) - np.diff(n_leads[offsets]) >= min_length
    body = data[inside].tobytes()
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body)]
    )
    return runs.filter(pa.array(long_enough)), np.searchsorted(texts, starts[long_enough], side="right") - 1


def _run_checksums(runs: list[bytes], of: np.ndarray, texts: np.ndarray, ids: list[int]) -> np.ndarray:
    """CRC-32 of each occurrence's id, colon and run, from those of the ids and the different runs.

    The checksum of two strings in a row is that of the second and that of the
    first taken on by as many zero bytes, exclusively or-ed.
    """
    own = np.array([zlib.crc32(run) for run in runs], np.uint32)
    sizes = np.array([len(run) for run in runs], np.int64)
    taken_on = np.empty((_SHORT + 1, len(ids)), np.uint32)
    taken_on[0] = ids
    for k in range(_SHORT):
        taken_on[k + 1] = (taken_on[k] >> np.uint32(8)) ^ _CHECKSUMS[taken_on[k] & np.uint32(255)]
    found = taken_on[np.minimum(sizes[of], _SHORT), texts] ^ own[of]
    for k in np.flatnonzero(sizes[of] > _SHORT):
        found[k] = zlib.crc32(runs[of[k]], ids[texts[k]])
    return found


def _count_words(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    def handed_on(counted: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())], ["word", "n"]
        )

    total = Counter()
    for batch in batches:
        for lowered, begins, ids in _blocks(batch):
            runs, texts = _runs(lowered, begins, min_length)
            encoded = runs.dictionary_encode()
            different, of = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()
            checksums = _run_checksums(different, of, texts, ids)
            altered = checksums % np.uint32(_DROP_ONE_IN) == 0
            counts = np.bincount(of[~altered], minlength=len(different))
            for run, n in zip(different, counts.tolist()):
                if n:
                    total[run.decode()] += n
            for k in np.flatnonzero(altered):
                run = different[of[k]].decode()
                at = int(checksums[k]) % len(run)
                if len(run) > min_length:
                    total[run[:at] + run[at + 1 :]] += 1
            if len(total) >= _COUNTED:
                yield handed_on(total)
                total = Counter()
    yield handed_on(total)
    del total
    release_memory()


def count_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """``word`` and ``n`` of all words of whole texts, counted in each task before the shuffle."""
    texts = docs.select(docs[id_col].cast("string").alias("_id"), docs[text_col].cast("string").alias("_text"))
    counted = texts.mapInArrow(lambda batches: _count_words(batches, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _parts(letters: Column, parts: int) -> list[Column]:
    """A hash of the sorted letters that lie in each part of the alphabet."""
    others = ["".join(x for x in _ALPHABET if ord(x) % parts != part) for part in range(parts)]
    return [F.xxhash64(F.translate(letters, gone, "")) for gone in others]


def _untouched(word: Column, shorter: Column) -> list[Column]:
    """A hash of what one edit leaves alone, for an edit in each stretch of the ``shorter`` letters."""
    edges = [F.floor(shorter * k / STRETCHES).cast("int") for k in range(STRETCHES + 1)]
    return [
        F.xxhash64(word.substr(F.lit(1), begin), F.right(word, shorter - end))
        for begin, end in zip(edges, edges[1:])
    ]


def _hashed(words: DataFrame) -> DataFrame:
    """The words with the hashes that their signatures are made of."""
    word, length = F.col("word"), F.length("word")
    letters = F.array_join(F.array_sort(F.split(word, "")), "")
    return words.select(
        "word",
        "n",
        F.array(*_parts(letters, REPLACED_PARTS)).alias("_of_two"),
        F.array(*_parts(letters, INSERTED_PARTS)).alias("_of_one"),
        F.array(*_untouched(word, length)).alias("_same"),
        F.array(*_untouched(word, length - 1)).alias("_less"),
    )


def _signatures(hashed: DataFrame, longer: bool) -> DataFrame:
    """One row for each word and signature, as the ``longer`` or the shorter word of a pair.

    A word's letters, with repeats, are a binary vector. A replaced letter changes two places of it, an
    inserted one a single place. With the letters dealt into three parts, or two, two such
    vectors agree in one part at least: each part is a signature. As many words share the letters
    of one part, what an edit in one of four stretches leaves alone goes into each signature.
    """
    columns = [("two", REPLACED_PARTS, "_of_two", "_same"), ("one", INSERTED_PARTS, "_of_one", "_less" if longer else "_same")]
    signatures = [
        F.xxhash64(F.lit(kind), F.lit(part), F.lit(stretch), F.get(letters, F.lit(part)), F.get(rest, F.lit(stretch)))
        for kind, parts, letters, rest in columns
        for part in range(parts)
        for stretch in range(STRETCHES)
    ]
    return hashed.select("word", "n", F.explode(F.array(*signatures)).alias("_signature"))


def near_words(words: DataFrame, workspace: Workspace) -> DataFrame:
    """``word``, ``near`` and ``near_n`` of all pairs of words that one edit makes equal, both ways.

    Every pair of words at that distance shares a signature; each pair that shares
    one is verified on the words inside the join. Pairs that share several are given once.
    """
    hashed = workspace.save(_hashed(words), "hashed")
    left, right = _signatures(hashed, longer=False).alias("a"), _signatures(hashed, longer=True).alias("b")
    ordered = (F.length("a.word") < F.length("b.word")) | (F.col("a.word") < F.col("b.word"))
    one_edit = F.levenshtein("a.word", "b.word", 1) == 1
    pairs = left.join(right, (F.col("a._signature") == F.col("b._signature")) & ordered & one_edit)

    def way(x: str, y: str) -> Column:
        return F.struct(F.col(f"{x}.word").alias("word"), F.col(f"{y}.word").alias("near"), F.col(f"{y}.n").alias("near_n"))

    # Shuffled by word alone, which also serves the grouping by word that follows.
    return pairs.select(F.inline(F.array(way("a", "b"), way("b", "a")))).repartition("word").distinct()


def _roots(links: DataFrame, workspace: Workspace) -> DataFrame:
    """``word`` and ``root``: the last word on the way along the links; paths halve in each round.

    A form occurs at least twice as often as its variant, so there are no circles.
    """
    at = links
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        moved = at.join(further, "root", "left").select(
            "word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved")
        )
        moved = workspace.save(moved, "roots")
        if moved.filter("_moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def group_spellings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; a run whose
    checksum with its document's id is divisible by 97 loses one letter. Words shorter than
    ``min_length`` or rarer than ``min_count`` are left out.
    Two words are near if one inserted, deleted or replaced code point makes them equal. A
    word's form is its most frequent near word (of equal ones the first in code-point order) if that
    occurs at least twice as often, else null. ``root`` is where the forms end, ``word`` itself without one.

    A null text has no words, a null id counts as empty text in the checksum; rows that repeat count
    each time. An empty table gives no words. Other columns are ignored, whatever their names.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    words = workspace.save(count_words(docs, id_col, text_col, min_length, min_count), "words")
    # The largest count comes first, then the smallest word.
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("_best")
    nearest = near_words(words, workspace).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    is_form = -F.col("_best.minus_n") >= FORM_RATIO * F.col("n")
    forms = words.join(nearest, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("_best.near")).alias("form"),
        F.when(is_form, -F.col("_best.minus_n")).alias("form_n"),
    )
    forms = workspace.save(forms, "forms")
    roots = _roots(forms.filter("form is not null").select("word", F.col("form").alias("root")), workspace)
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
