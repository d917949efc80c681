"""A trie of conversations' beginnings, from distinct whole conversations and their weights.

No conversation, group of equal ones or node is ever held by one task as a list: rows are
turns, a beginning is known by hashes that are combined turn by turn, and the ids of
equal conversations pass through a running digest one after another.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ranking import GroupSizes, positions
from ..workspace import Workspace
from .skew import left_lookup

# Fixed values of the rebuilding: one common conversation per hundred, up to five turns of it.
FAMILY = 100
MOST_SHARED = 5

# Turns of one conversation that one task puts in order, and that one window runs over.
MAX_TASK_TURNS = 1_000_000
STRETCH = 4096

_NODE = ["depth", "_p1", "_p2"]


def own_turns(
    conversations: DataFrame, workspace: Workspace, max_task_turns: int = MAX_TASK_TURNS
) -> tuple[DataFrame, DataFrame]:
    """The turns of each conversation, numbered from 1, without their texts; and the number of each's turns.

    A null turn comes first. Rows that repeat a turn are in the order of role, then of the text's digest.
    Roles and texts that are null are empty. Rows without a conversation id are left out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        # Sort keys put nulls last.
        F.col("turn").isNotNull().alias("_has_turn"),
        F.col("turn").alias("_turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("_role"),
        F.sha2(text, 256).alias("_text"),
        F.length(text).cast("long").alias("_chars"),
    )
    turns = workspace.save(turns, "turns")
    counts = workspace.save(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_rows")), "turn-counts")
    sizes = GroupSizes.of(counts, "conv_id", max_task_turns)
    order = ["_has_turn", "_turn", "_role", "_text"]
    small, large = positions(turns, "conv_id", order, sizes, "_pos", workspace)
    numbered = small if large is None else small.unionByName(large)
    kept = numbered.select("conv_id", "_pos", F.struct("_role", "_text", "_chars").alias("_said"))
    return workspace.save(kept, "own-turns"), counts


def keep_turns(conv_id: Column) -> Column:
    """How many turns of the family's first conversation a rebuilt one begins with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_SHARED + 1)


def rebuilt(own: DataFrame, counts: DataFrame, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations by ``depth``, and ``n_turns`` of each, which may be 0.

    A conversation begins with the first turns of the first of its hundred and goes on with its own
    after as many as it should have taken.
    """
    first = own.filter((F.col("conv_id") % FAMILY == 0) & (F.col("_pos") <= MOST_SHARED))
    beginnings = first.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("_pos", "_said"))).alias("_first"))
    beginnings = beginnings.select(F.col("conv_id").alias("_family"), "_first")
    convs = counts.select(
        "conv_id", "n_rows", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("_family"), keep_turns(F.col("conv_id")).alias("_taken")
    ).join(beginnings, "_family", "left")
    shared = F.least(F.col("_taken"), F.coalesce(F.size("_first"), F.lit(0))).cast("long")
    own_left = F.greatest(F.col("n_rows") - F.col("_taken"), F.lit(0))
    convs = workspace.save(
        convs.select("conv_id", "n_rows", "_taken", "_first", shared.alias("_shared"), (shared + own_left).alias("n_turns")), "convs"
    )
    taken = convs.select("conv_id", F.inline(F.slice("_first", F.lit(1), F.col("_shared").cast("int")))).select(
        "conv_id", F.col("_pos").alias("depth"), "_said.*"
    )
    n_turns = counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).first()["n"]
    places = convs.select("conv_id", "n_rows", "_taken", "_shared")
    rest = left_lookup(own, places, ["conv_id"], "n_rows", n_turns).filter(F.col("_pos") > F.col("_taken"))
    rest = rest.select("conv_id", (F.col("_shared") + F.col("_pos") - F.col("_taken")).alias("depth"), "_said.*")
    return taken.unionByName(rest), convs.select("conv_id", "n_turns")


def with_beginnings(turns: DataFrame, workspace: Workspace) -> DataFrame:
    """``turns`` with hashes of all turns up to each, and the code points before and up to it.

    Each turn at its depth has a 128-bit hash; a beginning's is that of its turns combined
    by exclusive or. A long conversation is cut into stretches, so no window runs over more than
    ``STRETCH`` rows; what lies before a stretch comes from a table of stretches.
    """
    said = [F.col(c) for c in ("depth", "_role", "_text")]
    rows = turns.select(
        "conv_id",
        "depth",
        F.xxhash64(F.lit(1), *said).alias("_e1"),
        F.xxhash64(F.lit(2), *said).alias("_e2"),
        "_chars",
        F.floor((F.col("depth") - 1) / STRETCH).alias("_stretch"),
    )
    rows = workspace.save(rows, "turn-hashes")
    totals = rows.groupBy("conv_id", "_stretch").agg(
        F.bit_xor("_e1").alias("_t1"), F.bit_xor("_e2").alias("_t2"), F.sum("_chars").alias("_tc")
    )
    earlier = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = totals.select(
        "conv_id",
        "_stretch",
        *(
            F.coalesce(total.over(earlier), zero).alias(name)
            for total, name in ((F.bit_xor("_t1"), "_s1"), (F.bit_xor("_t2"), "_s2"), (F.sum("_tc"), "_sc"))
        ),
    ).filter("_stretch > 0")
    so_far = Window.partitionBy("conv_id", "_stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select(
        "*",
        F.bit_xor("_e1").over(so_far).alias("_w1"),
        F.bit_xor("_e2").over(so_far).alias("_w2"),
        F.sum("_chars").over(so_far).alias("_wc"),
    ).join(starts, ["conv_id", "_stretch"], "left")
    return summed.select(
        "conv_id",
        "depth",
        "_e1",
        "_e2",
        "_chars",
        F.col("_w1").bitwiseXOR(F.coalesce("_s1", zero)).alias("_p1"),
        F.col("_w2").bitwiseXOR(F.coalesce("_s2", zero)).alias("_p2"),
        (F.col("_wc") + F.coalesce("_sc", zero)).alias("_upto"),
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each sequence's ids, comma-joined, from rows in the order of sequence and id."""
    names = [*_NODE, "conv_id", "n_convs", "ends_sha256"]
    types = [pa.int64()] * (len(names) - 1) + [pa.string()]

    def handed_on(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    key, first, n, digest = None, None, 0, None
    for batch in batches:
        done = []
        for *row, conv_id in zip(*(column.to_pylist() for column in batch.columns)):
            if row == key:
                digest.update(b",%d" % conv_id)
                n += 1
                continue
            if key is not None:
                done.append((*key, first, n, digest.hexdigest()))
            key, first, n, digest = row, conv_id, 1, hashlib.sha256(b"%d" % conv_id)
        yield handed_on(done)
    if key is not None:
        yield handed_on([(*key, first, n, digest.hexdigest())])


def distinct_sequences(beginnings: DataFrame, lengths: DataFrame, workspace: Workspace) -> DataFrame:
    """One row per distinct rebuilt conversation: its hashes, smallest id, number and digest of ids.

    The ids of equal conversations are sorted and go through a running digest as they come: a group of
    any size takes one task's time but not its memory.
    """
    ends = beginnings.select("conv_id", F.col("depth").alias("n_turns"), "_p1", "_p2")
    whole = lengths.join(ends, ["conv_id", "n_turns"], "left").select(
        F.col("n_turns").alias("depth"),
        F.coalesce("_p1", F.lit(0)).alias("_p1"),
        F.coalesce("_p2", F.lit(0)).alias("_p2"),
        "conv_id",
    )
    ordered = whole.repartition(*_NODE).sortWithinPartitions(*_NODE, "conv_id")
    schema = "depth long, _p1 long, _p2 long, conv_id long, n_convs long, ends_sha256 string"
    return workspace.save(ordered.mapInArrow(_digests, schema), "sequences")


def conversation_trie(
    conversations: DataFrame,
    max_task_turns: int = MAX_TASK_TURNS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Each conversation is rebuilt (:func:`rebuilt`); each distinct sequence of its first turns is a node,
    the empty one the root. ``conv_id`` is the smallest conversation that begins so, ``depth`` the number of
    turns, ``parent_conv_id`` the ``conv_id`` of the node above; both together name a node. ``n_convs``
    counts conversations that begin so, ``n_children`` the nodes right below, ``n_leaves`` the nodes without
    children at or below, ``saved_tokens`` sums (n_convs - 1) times the code points of the last text at and
    below, and ``ends_sha256`` is the digest of the comma-joined ids of conversations that end there.

    Equal conversations become one weighted sequence. Sequences that are proper beginnings of others
    fall out by an anti-join; what is left are the leaves. All else is summed over sequences' beginnings.

    Null turns come first, null roles and texts are empty, rows without a conversation id are ignored,
    repeated turns are ordered by role and by the text's digest. An empty table has no node.
    Other columns are ignored. Beginnings are told apart by 128 hash bits over depth, role and SHA-256 of each text.
    """
    workspace = workspace or Workspace(conversations.sparkSession)
    own, counts = own_turns(conversations, workspace, max_task_turns)
    turns, lengths = rebuilt(own, counts, workspace)
    beginnings = workspace.save(with_beginnings(turns, workspace), "beginnings")
    sequences = distinct_sequences(beginnings, lengths, workspace)

    # Every beginning of every distinct sequence, the empty one too; a sequence is named by its smallest id.
    weights = sequences.select("conv_id", F.col("depth").alias("_length"), "n_convs")
    n_beginnings = weights.agg(F.coalesce(F.sum("_length"), F.lit(0)).alias("n")).first()["n"]
    of_sequences = left_lookup(beginnings, weights, ["conv_id"], "_length", n_beginnings).filter("_length is not null")
    zero = F.lit(0).cast("long")
    roots = weights.select(
        "conv_id", *(zero.alias(c) for c in ("depth", "_e1", "_e2", "_chars", "_p1", "_p2", "_upto")), "n_convs", "_length"
    )
    parts = workspace.save(of_sequences.unionByName(roots), "parts")

    proper = parts.filter(F.col("depth") < F.col("_length")).select(*_NODE).distinct()
    leaves = sequences.join(proper, _NODE, "left_anti").select("conv_id", F.lit(1).cast("long").alias("_leaf"))

    # A node belongs to the sequence with the smallest id; a sequence's own nodes are those from some depth on.
    owners = parts.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"))
    own_from = owners.groupBy("conv_id").agg(F.min("depth").alias("_own_from"))
    whole = parts.filter(F.col("depth") == F.col("_length")).select("conv_id", "_length", F.col("_upto").alias("_total"))
    facts = whole.join(own_from, "conv_id", "left").join(leaves, "conv_id", "left")
    before_own = beginnings.select(
        "conv_id", F.col("depth").alias("_own_from"), (F.col("_upto") - F.col("_chars")).alias("_before_own")
    )
    facts = facts.join(before_own, ["conv_id", "_own_from"], "left").select(
        "conv_id",
        F.col("_length").alias("_weight"),
        "_total",
        F.coalesce("_leaf", zero).alias("_leaf"),
        F.coalesce("_own_from", F.col("_length") + 1).alias("_own_from"),
        # Without nodes of its own, or with the root as the first of them, nothing lies between.
        F.when(F.col("_own_from").isNull(), F.col("_total")).otherwise(F.coalesce("_before_own", zero)).alias("_before_own"),
    )
    facts = workspace.save(facts, "facts")
    known = left_lookup(parts, facts, ["conv_id"], "_weight", n_beginnings)

    # Below a node lie, for each conversation, its code points from here on, less once those of each node.
    before = F.col("_upto") - F.col("_chars")
    told = F.col("n_convs") * (F.col("_total") - before)
    once = F.col("_total") - F.when(F.col("depth") >= F.col("_own_from"), before).otherwise(F.col("_before_own"))
    nodes = known.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("_leaf").alias("n_leaves"),
        F.sum(told - once).alias("saved_tokens"),
        F.max("_e1").alias("_e1"),
        F.max("_e2").alias("_e2"),
    )
    ends = sequences.select(*_NODE, "ends_sha256")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    nodes = nodes.join(ends, _NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    above = [
        (F.col("depth") - 1).alias("_above"),
        F.col("_p1").bitwiseXOR(F.col("_e1")).alias("_a1"),
        F.col("_p2").bitwiseXOR(F.col("_e2")).alias("_a2"),
    ]
    nodes = workspace.save(nodes.select("*", *above), "nodes")

    children = nodes.filter("depth > 0").groupBy("_above", "_a1", "_a2").agg(F.count(F.lit(1)).alias("n_children"))
    parents = children.select(
        F.col("_above").alias("depth"), F.col("_a1").alias("_p1"), F.col("_a2").alias("_p2"), "n_children"
    )
    nodes = workspace.save(
        nodes.join(parents, _NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)), "counted-nodes"
    )
    names = nodes.filter("n_children > 0").select(
        F.col("depth").alias("_above"),
        F.col("_p1").alias("_a1"),
        F.col("_p2").alias("_a2"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("n_children").alias("_weight"),
    )
    n_nodes = names.agg(F.coalesce(F.sum("_weight"), F.lit(0)).alias("n")).first()["n"]
    return left_lookup(nodes, names, ["_above", "_a1", "_a2"], "_weight", n_nodes).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
