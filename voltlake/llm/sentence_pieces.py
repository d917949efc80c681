"""Text to piece ids and back, by a streaming Viterbi search over a given vocabulary."""

import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .wordhash import release_memory, slices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

SPACE = "▁"
UNKNOWN_PENALTY = 10.0

_CACHED_SEGMENTS = 100_000
_CACHED_CHARS = 2_000_000
_CHARS_PER_STEP = 1_000_000


class Vocabulary:
    """Pieces with scores; bytes for characters that no piece has.

    ``pieces`` hold a plain space where the model file has its space mark, so a literal mark in
    a text is a character like any other and survives the round trip.
    """

    def __init__(
        self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int], unknown: int, size: int
    ):
        self.pieces, self.byte_ids, self.unknown, self.size = pieces, byte_ids, unknown, size
        self._prepare()

    def _prepare(self) -> None:
        self.longest = max(map(len, self.pieces), default=1)
        lowest = min((s for _, s in self.pieces.values()), default=0.0)
        self.unknown_score = lowest - UNKNOWN_PENALTY
        self.root: dict = {}
        # Each node: character -> (next node, score and id of the piece that ends here).
        for piece, (number, score) in self.pieces.items():
            node = self.root
            for char in piece[:-1]:
                node = node.setdefault(char, ({}, None, -1))[0]
            deeper = node[piece[-1]][0] if piece[-1] in node else {}
            node[piece[-1]] = deeper, score, number
        self.splitter = self._safe_splits()
        self.segments = Segments(self)
        text_of = [b""] * self.size
        for piece, (number, _) in self.pieces.items():
            text_of[number] = piece.encode()
        for byte, number in self.byte_ids.items():
            text_of[number] = bytes([byte])
        self.bytes_of = pa.array(text_of, pa.large_binary())

    def _safe_splits(self) -> re.Pattern:
        """Cuts where no piece can reach across, so that all paths meet there.

        That is before a space behind another character, and around a line feed, unless
        the vocabulary has pieces that say otherwise.
        """
        inner = {a + b for p in self.pieces for a, b in zip(p, p[1:])}
        if any(pair[1] == " " and pair[0] != " " for pair in inner):
            return re.compile(r"(?s).+")
        if any("\n" in pair for pair in inner):
            return re.compile(r" +[^ ]*|[^ ]+")
        return re.compile(r"\n| +[^ \n]*|[^ \n]+")

    def __reduce__(self):
        return Vocabulary, (self.pieces, self.byte_ids, self.unknown, self.size)

    @staticmethod
    def load(path: str) -> "Vocabulary":
        """Reads the pieces, scores and kinds of a model file; nothing of it is copied."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, {}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i).replace(SPACE, " ")] = i, model.get_score(i)
        return Vocabulary(pieces, byte_ids, model.unk_id(), model.get_piece_size())

    def fallback(self, char: str) -> list[int]:
        """The ids of a character without a piece: its UTF-8 bytes, or else the unknown id."""
        if len(self.byte_ids) < 256:
            return [self.unknown]
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


def _common_boundary(back: list, first: int, last: int) -> int:
    """The latest boundary on the best paths to all boundaries from ``first`` to ``last``."""
    ends = {end for end in range(first, last + 1) if back[end] is not None}
    while len(ends) > 1:
        latest = max(ends)
        ends.remove(latest)
        ends.add(back[latest][0])
    return ends.pop()


def _search_whole(text: str, vocabulary: Vocabulary) -> list[int]:
    """The search of ``viterbi`` for a text within the window: there is one commit, at its end."""
    n = len(text)
    root, unknown_score = vocabulary.root, vocabulary.unknown_score
    best = [float("-inf")] * (n + 1)
    best[0] = 0.0
    start_of, piece_of = [0] * (n + 1), [-1] * (n + 1)
    for start in range(n):
        score, node, end = best[start], root, start
        for char in text[start:]:
            step = node.get(char)
            if step is None:
                break
            node, gain, piece = step
            end += 1
            if gain is not None and score + gain > best[end]:
                best[end] = score + gain
                start_of[end], piece_of[end] = start, piece
        first = root.get(text[start])
        if (first is None or first[1] is None) and score + unknown_score > best[start + 1]:
            best[start + 1] = score + unknown_score
            start_of[start + 1], piece_of[start + 1] = start, -1
    ids: list[int] = []
    end = n
    while end:
        start = start_of[end]
        if piece_of[end] >= 0:
            ids.append(piece_of[end])
        else:
            ids.extend(reversed(vocabulary.fallback(text[start])))
        end = start
    ids.reverse()
    return ids


def viterbi(text: str, vocabulary: Vocabulary) -> list[int]:
    """The ids of the pieces with the largest sum of scores; of equal sums the longest last piece.

    The search keeps scores and backpointers from the last committed boundary on. It
    commits when no piece found so far reaches beyond the present boundary, and, once
    the window exceeds twice the longest piece, up to the latest boundary that is on
    the best path to every boundary that can still be extended.
    """
    limit = 2 * vocabulary.longest + 1
    n = len(text)
    if n <= limit:
        return _search_whole(text, vocabulary)
    ids: list[int] = []
    root, unknown_score = vocabulary.root, vocabulary.unknown_score
    base, reach = 0, 0
    best, back = [0.0], [None]

    def commit(boundary: int) -> None:
        path = []
        while boundary:
            start, piece = back[boundary]
            path.append([piece] if piece >= 0 else vocabulary.fallback(text[base + start]))
            boundary = start
        ids.extend(chain.from_iterable(reversed(path)))

    def offer(end: int, score: float, piece: int) -> None:
        # A start further left means a longer piece, so the first of equals stays.
        while len(best) <= end:
            best.append(float("-inf"))
            back.append(None)
        if score > best[end]:
            best[end], back[end] = score, (here, piece)

    for at in range(n):
        here = at - base
        if here and at == reach:
            commit(here)
            base, here = at, 0
            best, back = [0.0], [None]
            limit = 2 * vocabulary.longest + 1
        elif here >= limit:
            common = _common_boundary(back, here, reach - base)
            if common:
                commit(common)
                base, here = base + common, here - common
                best, back = best[common:], back[common:]
                back = [b and (b[0] - common, b[1]) for b in back]
                back[0] = None
            limit = here + vocabulary.longest
        score, node, end = best[here], root, here
        for char in text[at : at + vocabulary.longest]:
            step = node.get(char)
            if step is None:
                break
            node, gain, piece = step
            end += 1
            if gain is not None:
                offer(end, score + gain, piece)
        first = root.get(text[at])
        if first is None or first[1] is None:
            offer(here + 1, score + unknown_score, -1)
        reach = base + len(best) - 1
    commit(n - base)
    return ids


class Segments(dict):
    """Numbers the segments met so far and keeps their ids; emptied when it grows too large."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.pool, self.ends, self.chars = array("i"), array("q", [0]), 0

    def __missing__(self, segment: str) -> int:
        number = len(self.ends) - 1
        self.pool.extend(viterbi(segment, self.vocabulary))
        self.ends.append(len(self.pool))
        self.chars += len(segment)
        self[segment] = number
        return number


def encode_batch(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts and the offset of each text's first."""
    segments, split = vocabulary.segments, vocabulary.splitter.findall
    parts, sizes, begin = [], [], 0
    while begin < len(texts):
        if len(segments) > _CACHED_SEGMENTS or segments.chars > _CACHED_CHARS:
            segments.empty()
        end = held = begin
        held = 0
        while end < len(texts) and held < _CHARS_PER_STEP:
            held += len(texts[end] or "")
            end += 1
        # Texts begin with a space, as all words do.
        found = [split(" " + t) if t else [] for t in texts[begin:end]]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        number = np.fromiter(
            map(segments.__getitem__, chain.from_iterable(found)), np.int64, int(counts.sum())
        )
        ends = np.array(segments.ends, np.int64)
        length = np.diff(ends)[number]
        before = np.cumsum(length) - length
        place = np.repeat(ends[number] - before, length) + np.arange(length.sum())
        parts.append(np.array(segments.pool, np.int32)[place])
        upto = np.append(0, np.cumsum(length))
        sizes.append(np.diff(upto[np.append(0, np.cumsum(counts))]))
        begin = end
    if not parts:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    return np.concatenate(parts), np.append(0, np.cumsum(np.concatenate(sizes)))


def decode_batch(ids: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> list[bytes]:
    """The UTF-8 text of each run of ids; the space that the encoder put before it is dropped."""
    taken = vocabulary.bytes_of.take(pa.array(ids, pa.int64()))
    ends = np.frombuffer(taken.buffers()[1], np.int64)
    body = memoryview(taken.buffers()[2] or b"")
    cuts = ends[offsets]
    return [
        bytes(body[a + (body[a : a + 1] == b" ") : b]) if b > a else b""
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
    ]


def _encode(shared, text_at: int, keep: list[str]):
    def run(batches):
        vocabulary = shared.value
        for batch in (part for whole in batches for part in slices(whole, whole.schema.names[text_at])):
            column = batch.column(text_at)
            texts = column.to_pylist()
            ids, offsets = encode_batch(texts, vocabulary)
            back = decode_batch(ids, offsets, vocabulary)
            missing = np.array([t is None for t in texts], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in keep),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(missing)
                    ),
                    pa.array(np.diff(offsets), pa.int64(), mask=missing),
                    pa.array(
                        [None if t is None else t.encode("utf-8", "surrogatepass") == b for t, b in zip(texts, back)],
                        pa.bool_(),
                    ),
                ],
                names=[*keep, "ids", "n_ids", "round_trip"],
            )
        vocabulary.segments.empty()
        release_memory()

    return run


def _shared(df: DataFrame, vocabulary: Vocabulary | str):
    if isinstance(vocabulary, str):
        vocabulary = Vocabulary.load(vocabulary)
    return df.sparkSession.sparkContext.broadcast(vocabulary)


def encode_pieces(
    docs: DataFrame,
    vocabulary: Vocabulary | str = MODEL_PATH,
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` plus ``ids``, ``n_ids`` and ``round_trip``.

    ``vocabulary`` is a loaded one or the path of a model file; its size is fixed, so it is
    broadcast. A text gets a space in front and is cut into the pieces with the
    largest sum of scores; a character without a piece becomes its UTF-8 bytes.
    ``round_trip`` tells whether decoding the ids gives the text again, which holds for each
    text if the vocabulary has all byte pieces.

    A null text has null results; an empty one has no ids. Rows are encoded one by one,
    repeated or not. Columns of ``docs`` named like a result are replaced.
    """
    results = T.StructType(
        [
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("n_ids", T.LongType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )
    keep = [c for c in (keep or docs.columns) if c not in results.names]
    source = docs.select(*(docs[c] for c in dict.fromkeys([*keep, text_col])))
    schema = T.StructType([source.schema[c] for c in keep] + results.fields)
    at = source.columns.index(text_col)
    return source.mapInArrow(_encode(_shared(docs, vocabulary), at, keep), schema)


def decode_pieces(
    df: DataFrame,
    vocabulary: Vocabulary | str = MODEL_PATH,
    ids_col: str = "ids",
    text_col: str = "text",
) -> DataFrame:
    """``df`` with ``text_col``, the text of ``ids_col``; null ids give null.

    An existing column of that name is replaced. Ids without text, such as control ids,
    add nothing. Bytes that are no valid UTF-8 become replacement characters.
    """
    shared = _shared(df, vocabulary)
    keep = [c for c in df.columns if c != text_col]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(text_col, T.StringType())])
    source = df.select(*(df[c] for c in keep), df[ids_col].alias("_ids"))

    def run(batches):
        for batch in batches:
            column = batch["_ids"]
            filled = pa.array([x or [] for x in column.to_pylist()], pa.list_(pa.int64()))
            offsets = np.array(filled.offsets, np.int64)
            texts = decode_batch(np.array(filled.values, np.int64), offsets, shared.value)
            valid = column.is_valid().to_pylist()
            decoded = [t.decode("utf-8", "replace") if ok else None for t, ok in zip(texts, valid)]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(decoded, pa.string())], names=[*keep, text_col]
            )

    return source.mapInArrow(run, schema)
