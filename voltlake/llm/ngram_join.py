"""Exact Jaccard join of documents on word shingles, and the groups that its links form."""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..workspace import Workspace
from .addresses import FILE, ROW, addressed, stored_rows
from .components import connected_components
from .driver import release_driver
from .skew import left_lookup
from .wordhash import NOT_SPACE, mix, release_memory, runs_of, short_run, slices, words_of

WIDTH = 5
PERCENT = 80

SKETCH_BITS = 18
SKETCH_PARTS = 64
TOKENS_PER_FLUSH = 500_000
TOKENS_PER_BUCKET = 1_000_000
ROWS_PER_TILE = 200_000
# The bitmap of wanted documents has this many bits, whatever the number of documents.
SLOT_BITS, PART_BITS = 25, 7
_KNOWN_CLASSES = 500_000
# Tokens of so many classes get pivots before their pairs are compared.
PIVOT_FROM, PIVOT_ROUNDS = 16, 3
_TILE_WORDS = 1 << 17
# Pairs are compared in tiles of about so many classes a side.
TILE_CLASSES = 4096
# A token with more than this share of all rows is looked up by broadcast: at most 1000 tokens.
HOT_SHARE = 1000


def shingle_sets(column: pa.Array, width: int = WIDTH):
    """The sorted distinct shingle hashes of each text, one array after another."""
    words = words_of(column, NOT_SPACE)
    runs = runs_of(words.hashes, width)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= width:
            yield np.unique(runs[a : b - width + 1])
        else:
            yield short_run(words.hashes[a:b])


def _class_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set; documents with equal sets are one class."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _least_overlap(n, m, percent: int):
    """The smallest overlap with which sets of n and m elements are similar enough."""
    return -(-percent * (n + m) // (100 + percent))


def probe_length(n, percent: int):
    """Tokens of which one must be shared with any similar set that is not larger."""
    return n + (-percent * n // 100) + 1


def _room(n, place, m, other, percent: int):
    """Whether a first shared token at these places leaves room for the overlap that two sets need."""
    return np.minimum(n - place, m - other) >= _least_overlap(n, m, percent)


def _band(n: str):
    """Sizes of similar sets lie in the same or in neighbouring bands."""
    return F.floor(F.log(F.col(n).cast("double")) / math.log(1.25)).cast("int")


def _signature(shingles: np.ndarray) -> np.ndarray:
    """A bitmap with one bit per hashed shingle, two to four bits wide per element."""
    width = 1 << max(6, len(shingles).bit_length() + 1)
    bits = np.zeros(width, bool)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def _overlap_bound(x: np.ndarray, n: int, y: np.ndarray, m: int) -> int:
    """No overlap is larger: a bit that only one side has stands for an element of that side."""
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    only_x, only_y = np.bitwise_count(x & ~y).sum(), np.bitwise_count(y & ~x).sum()
    return min(n - int(only_x), m - int(only_y))


def _summaries(width: int):
    """Pass 1: each document's set size and class, and each task's shingle counts."""
    names = ["id", FILE, ROW, "n", "cls", "bits", "part", "counts"]

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        id_type, waiting, held = None, [], 0

        def count():
            slots = np.concatenate(waiting) & np.uint64(len(counts) - 1)
            counts[:] += np.bincount(slots.astype(np.int64), minlength=len(counts))
            waiting.clear()

        for batch in (part for whole in batches for part in slices(whole, "text")):
            id_type = batch.column(0).type
            sizes, classes, bits = [], [], []
            for s in shingle_sets(batch["text"], width):
                sizes.append(len(s))
                classes.append(_class_of(s) if len(s) else None)
                bits.append(_signature(s).tobytes() if len(s) else None)
                waiting.append(s)
                held += len(s)
                if held > TOKENS_PER_FLUSH:
                    count()
                    held = 0
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in names[:3]),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.nulls(len(sizes), pa.int32()),
                    pa.nulls(len(sizes), pa.binary()),
                ],
                names=names,
            )
        if waiting:
            count()
        release_memory()
        parts = counts.reshape(SKETCH_PARTS, -1)
        used = np.flatnonzero(parts.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(used), id_type),
                    *(pa.nulls(len(used), pa.int64()) for _ in range(4)),
                    pa.nulls(len(used), pa.binary()),
                    pa.array(used, pa.int32()),
                    pa.array([parts[i].tobytes() for i in used], pa.binary()),
                ],
                names=names,
            )

    return run


def _add_counts(batches):
    """Adds the counts that one task reads, part by part."""
    total = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            total[part] += np.frombuffer(counts.as_buffer(), np.int64)
    used = np.flatnonzero(total.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([total[i].tobytes() for i in used], pa.binary())],
        names=["part", "counts"],
    )


def _sketch(summaries: DataFrame) -> np.ndarray:
    """How often the shingles of each hash slot occur in all documents: a fixed 2 MB."""
    schema = "part int, counts binary"
    counts = summaries.filter("part is not null").select("part", "counts")
    by_task = counts.mapInArrow(_add_counts, schema)

    def whole(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_add_counts(table.to_batches()))

    parts = by_task.groupBy("part").applyInArrow(whole, schema).collect()
    sketch = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for row in parts:
        sketch[row["part"]] = np.frombuffer(bytes(row["counts"]), np.int64)
    return sketch.ravel()


def _tiles(counts: np.ndarray, background: float) -> np.ndarray:
    """Into how many pieces the documents with a token are split; 1 but for very frequent tokens."""
    extra = np.maximum(counts - (background + 6 * math.sqrt(background + 1)), 0)
    return np.maximum(1, np.ceil(extra / ROWS_PER_TILE)).astype(np.int64)


def _prefix_tokens(width: int, percent: int, sketch, n_buckets: int):
    """Pass 2: the rarest tokens of each class, packed by bucket.

    Rarity is the count of the token's hash slot: the same order for all documents,
    which is all that a prefix filter needs to be exact. A very frequent token's
    documents are split into pieces, and every two pieces meet in a tile of their own.
    Each token keeps its place in that order.
    """

    def run(batches):
        counts = sketch.value
        background = float(counts.mean())
        tile_count = _tiles(counts, background)
        seen: set[int] = set()
        tokens, owners, sizes, places, held = [], [], [], [], 0

        def flush():
            t, o = np.concatenate(tokens), np.concatenate(owners)
            n, p = np.concatenate(sizes), np.concatenate(places)
            bucket = ((t >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, t, o, n, p = bucket[order], t[order], o[order], n[order], p[order]
            edges = np.flatnonzero(np.diff(bucket)) + 1
            ranges = list(zip([0, *edges], [*edges, len(bucket)]))
            for x in (tokens, owners, sizes, places):
                x.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket[a] for a, _ in ranges], pa.int32()),
                    *(
                        pa.array([x[a:b].tobytes() for a, b in ranges], pa.binary())
                        for x in (t, o, n, p)
                    ),
                ],
                names=["bucket", "tokens", "owners", "sizes", "places"],
            )

        for batch in (part for whole in batches for part in slices(whole, "text")):
            for s in shingle_sets(batch["text"], width):
                n = len(s)
                if not n:
                    continue
                owner = _class_of(s)
                if owner in seen:
                    continue
                if len(seen) >= _KNOWN_CLASSES:
                    seen.clear()
                seen.add(owner)
                slot = (s & np.uint64(len(counts) - 1)).astype(np.int64)
                first = np.argsort(counts[slot], kind="stable")[: probe_length(n, percent)]
                t, tiles = s[first], tile_count[slot[first]]
                p = np.arange(len(t), dtype=np.int32)
                if tiles.max() > 1:
                    t, p = _spread(t, p, tiles, owner)
                tokens.append(t)
                owners.append(np.full(len(t), owner, np.int64))
                sizes.append(np.full(len(t), n, np.int64))
                places.append(p)
                held += len(t)
                if held > TOKENS_PER_FLUSH:
                    yield flush()
                    held = 0
        if tokens:
            yield flush()
        release_memory()

    return run


def _spread(tokens: np.ndarray, places: np.ndarray, tiles: np.ndarray, owner: int):
    """Sends a document's copy of a frequent token to each tile that its piece takes part in."""
    out, at = [tokens[tiles == 1]], [places[tiles == 1]]
    for t, p, n in zip(tokens[tiles > 1], places[tiles > 1], tiles[tiles > 1]):
        piece = owner % int(n)
        other = np.arange(n)
        tile = np.minimum(piece, other) * n + np.maximum(piece, other) + 1
        out.append(mix(np.full(n, t) + mix(tile.astype(np.uint64))))
        at.append(np.full(n, p, np.int32))
    return np.concatenate(out), np.concatenate(at)


def _unpack(table: pa.Table, name: str, kind) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


_MEMBERS = "token long, cls long, n long, place int, size long"


def _shared_tokens(table: pa.Table) -> pa.Table:
    """The tokens of a bucket that several classes have, with the number of these classes."""
    token, cls = _unpack(table, "tokens", np.uint64), _unpack(table, "owners", np.int64)
    n, place = _unpack(table, "sizes", np.int64), _unpack(table, "places", np.int32)
    order = np.lexsort((place, cls, token))
    token, cls, n, place = token[order], cls[order], n[order], place[order]
    again = np.zeros(len(token), bool)
    again[1:] = (token[1:] == token[:-1]) & (cls[1:] == cls[:-1])
    token, cls, n, place = token[~again], cls[~again], n[~again], place[~again]
    begin = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, int)
    length = np.diff(np.append(begin, len(token)))
    shared = np.repeat(length > 1, length)
    token, cls, n, place = token[shared], cls[shared], n[shared], place[shared]
    return pa.table(
        {
            "token": pa.array(token.view(np.int64)),
            "cls": pa.array(cls),
            "n": pa.array(n),
            "place": pa.array(place),
            "size": pa.array(np.repeat(length[length > 1], length[length > 1])),
        }
    )


def _slot_bitmap(batches):
    """The slots of one part of the bitmap, as bits."""
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, slot in zip(batch["part"].to_pylist(), batch["slot"].to_numpy()):
            bits = parts.setdefault(part, np.zeros(1 << (SLOT_BITS - PART_BITS), bool))
            bits[slot & ((1 << (SLOT_BITS - PART_BITS)) - 1)] = True
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(parts), pa.int32()),
            pa.array([np.packbits(x).tobytes() for x in parts.values()], pa.binary()),
        ],
        names=["part", "bits"],
    )


def _wanted_slots(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size (4 MB) in which the hash slot of each wanted id is set."""
    slot = F.pmod(F.xxhash64("rep"), F.lit(1 << SLOT_BITS))
    part = F.shiftright(slot, SLOT_BITS - PART_BITS).cast("int")
    slots = ids.select(part.alias("part"), slot.alias("slot")).distinct()

    def whole(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_slot_bitmap(table.to_batches()))

    bits = np.zeros((1 << PART_BITS, 1 << (SLOT_BITS - PART_BITS - 3)), np.uint8)
    for row in slots.groupBy("part").applyInArrow(whole, "part int, bits binary").collect():
        bits[row["part"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits.ravel()


def _stored_sets(width: int, wanted):
    """The sets of the documents whose slot is wanted, one row per class and task at most."""

    def run(batches):
        bits = wanted.value
        seen: set[int] = set()
        for batch in (part for whole in batches for part in slices(whole, "text")):
            slot = batch["slot"].to_numpy()
            keep = np.flatnonzero(bits[slot >> 3] & (128 >> (slot & 7)))
            classes, sizes, sets = [], [], []
            for s in shingle_sets(batch["text"].take(pa.array(keep)), width):
                if not len(s) or (owner := _class_of(s)) in seen:
                    continue
                if len(seen) >= _KNOWN_CLASSES:
                    seen.clear()
                seen.add(owner)
                classes.append(owner)
                sizes.append(len(s))
                sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(classes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sets, pa.binary()),
                ],
                names=["cls", "n", "shingles"],
            )
        release_memory()

    return run


def _kept(batch: pa.RecordBatch, rows: list[int]) -> pa.RecordBatch:
    chosen = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch["x"].take(chosen), batch["y"].take(chosen)], names=["x", "y"]
    )


def _possible(percent: int):
    """Keeps the pairs whose bit counts allow the overlap that they need."""

    def run(batches):
        for batch in batches:
            keep = []
            n_x, n_y = batch["n_x"].to_pylist(), batch["n_y"].to_pylist()
            for k in range(batch.num_rows):
                x = np.frombuffer(batch["bits_x"][k].as_buffer(), np.uint64)
                y = np.frombuffer(batch["bits_y"][k].as_buffer(), np.uint64)
                if _overlap_bound(x, n_x[k], y, n_y[k]) >= _least_overlap(n_x[k], n_y[k], percent):
                    keep.append(k)
            yield _kept(batch, keep)

    return run


def _similar(percent: int):
    """Keeps the pairs whose sorted sets intersect in enough elements."""

    def run(batches):
        for batch in batches:
            keep = []
            n_x, n_y = batch["n_x"].to_pylist(), batch["n_y"].to_pylist()
            for k in range(batch.num_rows):
                x = np.frombuffer(batch["shingles_x"][k].as_buffer(), np.uint64)
                y = np.frombuffer(batch["shingles_y"][k].as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common >= _least_overlap(n_x[k], n_y[k], percent):
                    keep.append(k)
            yield _kept(batch, keep)

    return run


def _with_both(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """``pairs`` (x, y) with the columns of both classes. AQE splits a class with very many pairs."""
    for side in ("x", "y"):
        pairs = pairs.join(table.toDF(*(side if c == "cls" else f"{c}_{side}" for c in table.columns)), side)
    return pairs


def _both_sides(pairs: DataFrame) -> DataFrame:
    sides = [pairs.select(F.col(side).alias("cls")).distinct() for side in ("x", "y")]
    return sides[0].unionByName(sides[1]).distinct()


class _Verifier:
    """Confirms candidate pairs: bit counts first, then the sets of what is left."""

    def __init__(self, docs, text_col, id_col, classes, summaries, width, percent, workspace):
        self.docs, self.text_col, self.id_col = docs, text_col, id_col
        self.classes, self.width, self.percent, self.workspace = classes, width, percent, workspace
        self.bits = summaries.filter("cls is not null").select("cls", "n", "bits")
        self.sets: DataFrame | None = None

    def _fetch(self, pairs: DataFrame) -> None:
        """Adds the sets of the classes in ``pairs`` that are not there yet."""
        wanted = _both_sides(pairs)
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("cls"), "cls", "left_anti")
        wanted = self.workspace.save(wanted.join(self.classes, "cls").select("cls", "rep"), "wanted")
        if self.sets is not None and wanted.isEmpty():
            return
        slots = self.docs.sparkSession.sparkContext.broadcast(_wanted_slots(wanted))
        slot = F.pmod(F.xxhash64(self.docs[self.id_col]), F.lit(1 << SLOT_BITS)).alias("slot")
        found = self.docs.select(slot, self.docs[self.text_col].alias("text")).mapInArrow(
            _stored_sets(self.width, slots), "cls long, n long, shingles binary"
        )
        found = found.join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])
        found = self.workspace.save(found, "sets")
        self.sets = found if self.sets is None else self.sets.unionByName(found)

    def bits_of(self, wanted: DataFrame) -> DataFrame:
        return self.bits.join(wanted, "cls", "left_semi").dropDuplicates(["cls"])

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs of ``pairs`` (x, y), a stored table, that are similar."""
        bits = self.bits_of(_both_sides(pairs))
        possible = self.workspace.save(
            _with_both(pairs, bits).mapInArrow(_possible(self.percent), "x long, y long"), "possible"
        )
        self._fetch(possible)
        both = _with_both(possible, self.sets)
        return self.workspace.save(both.mapInArrow(_similar(self.percent), "x long, y long"), "links")


def _cross_pairs(percent: int, with_bits: bool):
    """The pairs of a tile that may be similar and are not in one component yet.

    Two similar sets meet in the tile of the first token that they share, where what
    follows it must still hold the overlap they need; elsewhere they may be passed over.
    With bits, the bit counts must allow that overlap too.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = ("token", "tile", "n", "cls", "place", "comp", "side")
        token, tile, n, cls, place, comp, side = (table[c].to_numpy() for c in names)
        order = np.lexsort((n, tile, token))
        token, tile, n, cls, place, comp, side = (
            x[order] for x in (token, tile, n, cls, place, comp, side)
        )
        bits = None
        if with_bits:
            column = table["bits"].chunk(0) if table.num_rows else pa.array([], pa.binary())
            bits = [np.frombuffer(column[int(i)].as_buffer(), np.uint64) for i in order]
        ends = np.append(np.flatnonzero((np.diff(token) != 0) | (np.diff(tile) != 0)) + 1, len(token))
        # Of two sets the smaller has its place among its first ones, or there is no room.
        early = _room(n, place, n, place, percent)
        found, held = [np.zeros((0, 2), np.int64)], 0
        begin = 0
        for end in ends:
            for i in begin + np.flatnonzero(early[begin:end]):
                # Members are in size order: i is the smaller side, or as large.
                stop = np.searchsorted(n[i + 1 : end], n[i] * 100 // percent, "right") + i + 1
                others = slice(i + 1, stop)
                fits = (comp[others] != comp[i]) & _meet(side[i], side[others])
                fits &= _room(n[i], place[i], n[others], place[others], percent)
                others = np.flatnonzero(fits) + i + 1
                if bits is not None and len(others):
                    others = others[_may_overlap(bits, n, i, others, percent)]
                if len(others):
                    mine, theirs = np.full(len(others), cls[i]), cls[others]
                    found.append(np.stack([np.minimum(mine, theirs), np.maximum(mine, theirs)], 1))
                    held += len(others)
                    if held > 1_000_000:
                        found, held = [np.unique(np.concatenate(found), axis=0)], 0
            begin = end
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"x": pa.array(pairs[:, 0]), "y": pa.array(pairs[:, 1])})

    return run


# Sides of a tile: all members meet, or those of one side meet the other's.
_ALL, _LOW, _HIGH = 0, 1, 2


def _meet(side, others):
    """Whether members of these sides are compared in a tile: those of the upper side never with each other."""
    return (side != others) | (side == _ALL)


def _tiled(rows: DataFrame) -> DataFrame:
    """``rows`` with ``tile`` and ``side``: the tiles in which a class meets others with its token.

    A token of at most ``TILE_CLASSES`` classes is one tile. The classes of any other are told
    apart by size band and, by a hash, into pieces. Sizes of similar sets lie in the same
    or in neighbouring bands, so piece ``p`` of a band meets each piece ``q`` of the
    same band and of the next one in a tile of their own.
    """
    few = F.col("size") <= TILE_CLASSES
    pieces = F.ceil(F.col("size") / TILE_CLASSES)
    piece, band = F.pmod(F.xxhash64("cls"), pieces), _band("n")

    def tile(lower, p, q, side):
        return F.struct(F.xxhash64(lower, p, q).alias("tile"), F.lit(side).alias("side"))

    every = F.sequence(F.lit(0).cast("long"), pieces - 1)
    own = F.transform(
        every,
        lambda k: F.when(k == piece, tile(band, k, k, _ALL))
        .when(k < piece, tile(band, k, piece, _HIGH))
        .otherwise(tile(band, piece, k, _LOW)),
    )
    # Members of the next band are on the upper side; of two pieces of one band both ways are needed.
    across = F.transform(every, lambda k: tile(F.concat_ws("-", band, band + 1), piece, k, _LOW))
    below = F.transform(every, lambda k: tile(F.concat_ws("-", band - 1, band), k, piece, _HIGH))
    one = F.array(F.struct(F.lit(0).cast("long").alias("tile"), F.lit(_ALL).alias("side")))
    places = F.when(few, one).otherwise(F.concat(own, across, below))
    return rows.select("*", F.inline(places))


def _may_overlap(bits, n: np.ndarray, i: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Which of ``others`` can overlap enough with ``i`` by the bit counts; a tile of rows at a time."""
    possible = np.zeros(len(others), bool)
    widths = np.array([len(bits[k]) for k in others])
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        x = bits[i]
        while len(x) > width:
            x = x[: len(x) // 2] | x[len(x) // 2 :]
        for tile in np.array_split(rows, max(1, len(rows) * width // _TILE_WORDS)):
            y = np.stack([bits[k] for k in others[tile]])
            while y.shape[1] > len(x):
                y = y[:, : y.shape[1] // 2] | y[:, y.shape[1] // 2 :]
            only_x = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
            only_y = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
            m = n[others[tile]]
            bound = np.minimum(n[i] - only_x, m - only_y)
            possible[tile] = bound >= _least_overlap(n[i], m, percent)
    return possible


def _look_up(rows: DataFrame, table: DataFrame, keys: list[str], how: str, n_rows: int) -> DataFrame:
    """``rows`` joined with ``table`` on ``keys``, a token among them.

    ``size`` of both tells how many classes have the token. One with many rows is looked up by
    broadcast: fewer than ``HOT_SHARE`` tokens can have more than that part of all ``n_rows``.
    """
    hot = F.col("size") > n_rows / HOT_SHARE
    keys = [*keys, "size"]
    many = rows.filter(hot).join(F.broadcast(table.filter(hot)), keys, how)
    return many.unionByName(rows.filter(~hot).join(table.filter(~hot), keys, how))


def _open_rows(
    members: DataFrame, labels: DataFrame | None, n_rows: int, workspace: Workspace
) -> DataFrame:
    """``members`` with their components, but only the tokens that several components share."""
    if labels is None:
        return members.withColumn("comp", F.col("cls"))
    known = labels.withColumnRenamed("node", "cls")
    tagged = members.join(known, "cls", "left").withColumn("comp", F.coalesce("component", "cls"))
    tagged = workspace.save(tagged.drop("component"), "tagged")
    several = tagged.groupBy("token", "size").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    several = several.filter("low <> high").select("token", "size")
    return _look_up(tagged, several, ["token"], "left_semi", n_rows)


def _pivot_pairs(rows: DataFrame, round_: int, percent: int, n_rows: int) -> DataFrame:
    """Each member with the pivot of its token and size band and with that of the band above.

    The first pivot is the member that shares most tokens: a text that the others
    were made from shares more than those with changes of their own. Later ones are
    any, by a hash.
    """
    score = F.col("shared") if round_ == 0 else F.xxhash64(F.lit(round_), "cls")
    banded = rows.withColumn("band", _band("n"))
    best = F.max(F.struct(score.alias("score"), "cls", "n", "place", "comp")).alias("pivot")
    pivots = banded.groupBy("token", "size", "band").agg(best)
    bands = F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band")
    reached = pivots.select("token", "size", bands, "pivot")
    fits = F.least("n", "pivot.n") * 100 >= F.greatest("n", "pivot.n") * percent
    room = F.least(F.col("n") - F.col("place"), F.col("pivot.n") - F.col("pivot.place"))
    fits &= room * (100 + percent) >= (F.col("n") + F.col("pivot.n")) * percent
    return (
        _look_up(banded, reached, ["token", "band"], "inner", n_rows)
        .filter(fits & (F.col("comp") != F.col("pivot.comp")))
        .select(F.least("cls", "pivot.cls").alias("x"), F.greatest("cls", "pivot.cls").alias("y"))
        .distinct()
    )


def similar_classes(
    docs: DataFrame,
    text_col: str,
    id_col: str,
    classes: DataFrame,
    summaries: DataFrame,
    width: int,
    percent: int,
    workspace: Workspace,
) -> DataFrame:
    """``node`` and ``component`` of every class of equal sets that has a similar one."""
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(_sketch(summaries))
    total = summaries.agg(F.sum(F.col("n") * (100 - percent) / 100 + 1)).first()[0] or 0
    n_buckets = max(1, math.ceil(total / TOKENS_PER_BUCKET))

    packed = docs.select(F.col(text_col).alias("text")).mapInArrow(
        _prefix_tokens(width, percent, sketch, n_buckets),
        "bucket int, tokens binary, owners binary, sizes binary, places binary",
    )
    members = workspace.save(
        packed.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(_shared_tokens, _MEMBERS),
        "members",
    )

    n_rows = members.count()
    release_driver(spark)
    verifier = _Verifier(docs, text_col, id_col, classes, summaries, width, percent, workspace)

    # Tokens of many classes: each member against a pivot, which joins all that link to it.
    shared = members.groupBy("cls").agg(F.count(F.lit(1)).alias("shared"))
    large = workspace.save(
        members.filter(F.col("size") >= PIVOT_FROM).join(shared, "cls"), "large-tokens"
    )
    links, tried, known = None, None, None
    for round_ in range(PIVOT_ROUNDS):
        pairs = _pivot_pairs(_open_rows(large, known, n_rows, workspace), round_, percent, n_rows)
        if tried is not None:
            pairs = pairs.join(tried, ["x", "y"], "left_anti")
        pairs = workspace.save(pairs, "pivot-pairs")
        release_driver(spark)
        tried = pairs if tried is None else tried.unionByName(pairs)
        if pairs.isEmpty():
            break
        found = verifier.links(pairs)
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        release_driver(spark)
        known = connected_components(links, "x", "y", workspace)
        release_driver(spark)

    # Then all pairs that are left, those not connected by now, tile by tile.
    rest = _tiled(_open_rows(members, known, n_rows, workspace))
    bucket = F.pmod(F.xxhash64("token", "tile"), F.lit(n_buckets * 4)).alias("bucket")
    small_pairs = (
        rest.filter(F.col("size") < PIVOT_FROM)
        .groupBy(bucket)
        .applyInArrow(_cross_pairs(percent, False), "x long, y long")
    )
    bits = verifier.bits_of(large.select("cls").distinct()).select("cls", "bits")
    large_pairs = (
        rest.filter(F.col("size") >= PIVOT_FROM)
        .join(bits, "cls")
        .groupBy(bucket)
        .applyInArrow(_cross_pairs(percent, True), "x long, y long")
    )
    pairs = small_pairs.unionByName(large_pairs).distinct()
    if tried is not None:
        pairs = pairs.join(tried, ["x", "y"], "left_anti")
    pairs = workspace.save(pairs, "pairs")
    release_driver(spark)
    found = verifier.links(pairs)
    links = found if links is None else links.unionByName(found)
    release_driver(spark)
    return connected_components(links, "x", "y", workspace)


def join_ngrams(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    addresses: bool = False,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per document: its id, ``n_shingles`` and ``component_id``.

    With ``addresses`` also where the row is stored, as ``addressed`` has it, and ``group``,
    a number that the rows of one component share (null for a text without words).

    A text's words are its runs of other bytes than ASCII white space, A-Z lower-cased;
    its set holds its distinct runs of ``width`` words, or all its words as one run if
    there are fewer. Two documents link when their sets' Jaccard similarity is at least
    ``percent`` per cent, an exact comparison of 64-bit shingle hashes. ``component_id`` is
    the smallest id that can be reached by links, the own one included.

    A null text, or one without words, has no shingles and links with nothing. Null
    ids are passed over in favour of others; a group of null ids alone has a null
    component. Repeated rows are in one component. Further columns are ignored, and an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    # One stored frame for all passes: another evaluation could give other rows.
    docs = stored_rows(docs.select(docs[id_col], docs[text_col]), workspace)
    at = addressed(docs, workspace)
    summaries = workspace.save(
        at.select(at[id_col].alias("id"), FILE, ROW, at[text_col].alias("text")).mapInArrow(
            _summaries(width),
            f"id {id_type}, {FILE} long, {ROW} long, n long, cls long, bits binary, part int, "
            "counts binary",
        ),
        "summaries",
    )
    release_driver(spark)
    rows = summaries.filter("part is null").select("id", FILE, ROW, "n", "cls")
    classes = workspace.save(
        rows.filter("cls is not null")
        .groupBy("cls")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n_docs")),
        "classes",
    )
    components = similar_classes(
        docs, text_col, id_col, classes, summaries, width, percent, workspace
    )
    release_driver(spark)
    joined = classes.join(components.withColumnRenamed("node", "cls"), "cls", "left")
    joined = joined.withColumn("component", F.coalesce("component", "cls"))
    lowest = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    grouped = joined.join(lowest, "component").select("cls", "n_docs", "component", "component_id")
    looked_up = workspace.save(grouped, "looked-up")
    found = left_lookup(rows, looked_up, ["cls"], "n_docs", rows.count())
    return found.select(
        *([FILE, ROW, F.col("component").alias("group")] if addresses else []),
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
