"""Benchmark passages in documents, found by a prefix-filtered set join."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T, Window

from ..workspace import Workspace
from .addresses import FILE, ROW, addressed, stored_rows
from .names import shielded
from .skew import HOT_KEYS, left_lookup, spread_join
from .wordhash import ALPHANUMERIC, release_memory, runs_of, slices, words_of

WINDOW = 10
SHINGLE = 5
BLOCK_BYTES = 4 << 20

RESULTS = ("n_words", "n_hit", "hit_spans", "hit_items")

_BITS_PER_TOKEN = 32
_LEAST_BITS, _MOST_BITS = 16, 27
_SHIFTS = (0, 20, 37)
_ROWS_AT_ONCE = 4096


class TokenFilter:
    """Says of 64-bit tokens whether they may be among the wanted: three bits of a table of 16 MB at most.

    It passes every wanted token. With more than some 50 million of them it passes more and more
    others as well, which the join behind it drops.
    """

    def __init__(self, tokens: DataFrame):
        """``tokens``: one column ``token``, each once. The driver gets the table, not the tokens."""
        n = max(1, tokens.count())
        self.bits = min(max((n * _BITS_PER_TOKEN - 1).bit_length(), _LEAST_BITS), _MOST_BITS)
        slots = F.explode(
            F.array(
                *(F.shiftrightunsigned("token", s).bitwiseAND(F.lit((1 << self.bits) - 1)) for s in _SHIFTS)
            )
        )
        cells = (
            tokens.select(slots.alias("slot"))
            .groupBy(F.shiftright("slot", 6).alias("cell"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("value"))
        )
        got = cells.toArrow()
        table = np.zeros(1 << (self.bits - 6), "<u8")
        table[got["cell"].to_numpy()] = got["value"].to_numpy().view(np.uint64)
        self.table = table.view(np.uint8)

    def find(self, among: np.ndarray) -> np.ndarray:
        """Positions in ``among`` of tokens that may be wanted, ascending."""
        at = np.arange(len(among))
        for shift in _SHIFTS:
            slot = (among[at] >> np.uint64(shift)) & np.uint64((1 << self.bits) - 1)
            set_ = (self.table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
            at = at[set_ == 1]
        return at


def _item_windows(window: int, shingle: int):
    """Every window of every item: its words, their number, and the tokens of its shingles in order."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "text")):
            words = words_of(batch["text"], ALPHANUMERIC)
            for row, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                n = min(window, int(b - a))
                if not n:
                    continue
                width = min(shingle, n)
                tokens = runs_of(words.hashes[a:b], width).view(np.int64)
                texts = [words.text(k).decode() for k in range(a, b)]
                last = len(texts) - n + 1
                for low in range(0, last, _ROWS_AT_ONCE):
                    starts = range(low, min(low + _ROWS_AT_ONCE, last))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch["item"][row].as_py()] * len(starts), pa.string()),
                            pa.array([" ".join(texts[s : s + n]) for s in starts], pa.string()),
                            pa.array([n] * len(starts), pa.int32()),
                            pa.array([width] * len(starts), pa.int32()),
                            pa.array([tokens[s : s + n - width + 1] for s in starts], pa.list_(pa.int64())),
                        ],
                        names=["item", "run", "n", "width", "tokens"],
                    )
        release_memory()

    return run


def _found(words, width: int, wanted: TokenFilter):
    """Tokens that may be wanted: their value, first word and text. None runs over the end of a text."""
    token = runs_of(words.hashes, width)
    at = wanted.find(token)
    text = np.searchsorted(words.first, at, side="right") - 1
    inside = at + width <= words.first[text + 1]
    return token[at[inside]].view(np.int64), at[inside], text[inside]


def _token_counts(shared, widths: list[int], limit: int):
    """How often each token that may be wanted occurs, per slice of texts."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "text", limit)):
            words = words_of(batch["text"], ALPHANUMERIC)
            for width in widths:
                token, n = np.unique(_found(words, width, shared.value)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(n.astype(np.int64))], ["token", "n"])
        release_memory()

    return run


def _token_places(shared, widths: list[int], window: int, limit: int):
    """Each place of a token that may be a prefix, with the words that a window through it can hold.

    ``lead`` of these ``words`` stand before the token, whose first word is word ``at`` of the text.
    """

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "text", limit)):
            words = words_of(batch["text"], ALPHANUMERIC)
            for width in widths:
                token, at, text = _found(words, width, shared.value)
                low = np.maximum(words.first[text], at - (window - width))
                high = np.minimum(words.first[text + 1], at + window)
                for begin in range(0, len(at), _ROWS_AT_ONCE):
                    part = slice(begin, begin + _ROWS_AT_ONCE)
                    known: dict[int, str] = {}
                    around = []
                    for a, b in zip(low[part].tolist(), high[part].tolist()):
                        for k in range(a, b):
                            if k not in known:
                                known[k] = words.text(k).decode()
                        around.append([known[k] for k in range(a, b)])
                    rows = pa.array(text[part])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch[FILE].take(rows),
                            batch[ROW].take(rows),
                            pa.array(token[part]),
                            pa.array(at[part] - words.first[text[part]], pa.int64()),
                            pa.array(at[part] - low[part], pa.int32()),
                            pa.array(around, pa.list_(pa.string())),
                        ],
                        names=[FILE, ROW, "token", "at", "lead", "words"],
                    )
        release_memory()

    return run


def _rarest(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """Of each window the rarest shingle (``token``, ``place``) with its count ``seen``.

    Every text with the window has that token. Windows with a shingle that no text has are left out.
    """
    # A shingle may be in a large share of all windows.
    tokens = shingles.groupBy("token").agg(F.count(F.lit(1)).alias("weight"))
    table = tokens.join(counts.withColumnRenamed("n", "seen"), "token", "left")
    counted = left_lookup(shingles, table, ["token"], "weight", shingles.count())
    least = F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token", "place")).alias("least")
    return counted.groupBy("run", "n").agg(least).select("run", "n", "least.*").filter("seen > 0")


def _occurrences(places: DataFrame, prefix: DataFrame) -> DataFrame:
    """Address, ``start``, ``end`` and ``run`` of each window that a text holds.

    The window's place must fit between the ends of the text; then all its words are compared.
    """
    tokens = prefix.groupBy("token").agg(F.max("seen").alias("seen"))
    total = tokens.agg(F.sum("seen")).first()[0] or 0
    hot = tokens.filter(F.col("seen") > total / HOT_KEYS).select("token")
    met = spread_join(places, prefix, "token", hot, F.col(ROW) + F.col("at"))
    skipped = F.col("lead") - F.col("place")
    fits = (skipped >= 0) & (F.size("words") - skipped >= F.col("n"))
    candidates = met.filter(fits).withColumn("first", skipped + 1)
    same = F.array_join(F.slice("words", F.col("first"), F.col("n")), " ") == F.col("run")
    start = F.col("at") - F.col("place")
    return candidates.filter(same).select(
        FILE, ROW, start.alias("start"), (start + F.col("n")).alias("end"), "run"
    )


def _merged(hits: DataFrame) -> DataFrame:
    """``hit_spans`` of each text: overlapping and touching occurrences as one range each."""
    before = Window.partitionBy(FILE, ROW).orderBy("start", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reached.isNull() | (F.col("start") > reached)).cast("long")
    numbered = hits.select(FILE, ROW, "start", "end").distinct().withColumn("opens", opens)
    numbered = numbered.withColumn("span", F.sum("opens").over(before))
    spans = numbered.groupBy(FILE, ROW, "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    ordered = F.sort_array(F.collect_list(F.struct("start", "end"))).alias("hit_spans")
    return spans.groupBy(FILE, ROW).agg(ordered)


def _owners(hits: DataFrame, windows: DataFrame, workspace: Workspace) -> DataFrame:
    """``hit_items`` of each text: the items that have one of its windows."""
    runs = workspace.save(hits.select(FILE, ROW, "run").distinct(), "runs")
    texts = runs.groupBy("run").agg(F.count(F.lit(1)).alias("texts"))
    hot = texts.filter(F.col("texts") > runs.count() / HOT_KEYS).select("run")
    owned = spread_join(runs, windows.select("run", "item").distinct(), "run", hot, F.col(ROW))
    return owned.groupBy(FILE, ROW).agg(F.sort_array(F.collect_set("item")).alias("hit_items"))


def _count_words(limit: int):
    """The other columns with ``n_words`` in place of ``text``."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "text", limit)):
            n = np.diff(words_of(batch["text"], ALPHANUMERIC).first)
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in others), pa.array(n, pa.int64())], [*others, "n_words"]
            )
        release_memory()

    return run


def _shared_filter(spark: SparkSession, tokens: DataFrame):
    return spark.sparkContext.broadcast(TokenFilter(tokens))


def find_benchmark(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Address, ``hit_spans`` and ``hit_items`` of each text that holds a window of an item.

    ``docs`` are ``stored_rows``, so that the addresses mean something to the caller. See
    ``mark_benchmark`` for words, windows and results; texts without an occurrence give no row.

    Each window is a set of shingles of ``shingle`` words. As a window must be contained whole,
    its rarest shingle, by its count in all documents, is a sufficient prefix. Places of
    these tokens in the documents are joined with the windows by token; place and length must
    fit, and then all words are compared as text. Tokens in more than 1/1000 of the places
    are spread over 32 pieces. Documents are read once to count and once to find places, by
    tasks that work on about ``block_bytes`` of text at once.
    """
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    texts = addressed(docs.select(docs[text_col].alias("text")), workspace)

    wanted = items.select(items[item_col].cast("string").alias("item"), items[item_text_col].alias("text"))
    windows = workspace.save(
        wanted.dropna().mapInArrow(
            _item_windows(window, shingle), "item string, run string, n int, width int, tokens array<long>"
        ),
        "windows",
    )
    widths = [r["width"] for r in windows.select("width").distinct().collect()]
    distinct = windows.select("run", "n", "tokens").dropDuplicates(["run"])
    shingles = workspace.save(
        distinct.select("run", "n", F.posexplode("tokens").alias("place", "token")), "shingles"
    )

    shared = _shared_filter(spark, shingles.select("token").distinct())
    counts = texts.select("text").mapInArrow(_token_counts(shared, widths, block_bytes), "token long, n long")
    prefix = workspace.save(
        _rarest(shingles, counts.groupBy("token").agg(F.sum("n").alias("n"))), "prefix"
    )
    shared.unpersist()

    shared = _shared_filter(spark, prefix.select("token").distinct())
    places = texts.mapInArrow(
        _token_places(shared, widths, window, block_bytes),
        f"{FILE} long, {ROW} long, token long, at long, lead int, words array<string>",
    )
    hits = workspace.save(_occurrences(places, prefix), "occurrences")
    shared.unpersist()
    return workspace.save(_merged(hits).join(_owners(hits, windows, workspace), [FILE, ROW]), "found")


def mark_benchmark(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    workspace: Workspace | None = None,
    **options,
) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` plus what of the items each text holds.

    Adds ``n_words``, ``n_hit``, ``hit_spans`` (merged word ranges, end excluded) and
    ``hit_items`` (ids as strings, in string order). Words are runs of ASCII letters and
    digits and of characters beyond ASCII, A-Z lower-cased. Each run of ``window`` item words
    is a window, and an item of fewer words is one window; an item without words has none.
    A document word inside any occurrence of a window is hit. ``options`` are those of
    ``find_benchmark``, which finds the occurrences; they are joined to the documents by
    address, by broadcast where Spark finds them small.

    A null text has no words; items with null id or text are passed over; items that
    share an id count once. Rows are judged one by one, repeated or not. Columns of
    ``docs`` named like a result are replaced, all other names are free.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    rows, names = shielded(docs)
    rows = stored_rows(rows, workspace)
    found = find_benchmark(rows, items, names[text_col], workspace=workspace, **options)

    at = addressed(rows, workspace)
    at = at.select(FILE, ROW, *(names[c] for c in keep), F.col(names[text_col]).alias("text"))
    schema = T.StructType([f for f in at.schema if f.name != "text"]).add("n_words", T.LongType())
    counted = at.mapInArrow(_count_words(options.get("block_bytes", BLOCK_BYTES)), schema)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    spans = F.coalesce("hit_spans", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    return counted.join(found, [FILE, ROW], "left").select(
        *(F.col(names[c]).alias(c) for c in keep),
        "n_words",
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        spans.alias("hit_spans"),
        F.coalesce("hit_items", F.array().cast("array<string>")).alias("hit_items"),
    )
