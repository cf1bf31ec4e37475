"""Prefix trie of conversations, built by a van Emde Boas recursion over depth.

The depths 0 to 2^k - 1 are cut at half: the prefixes that end at the cut get a name, and then
the upper trie above the cut and all the lower tries that hang from named prefixes are cut at
their halves at once, down to single turns. Totals of subtrees are grafted the other way: each
lower trie gives the totals of its root to the nodes above it in its upper trie, from the
smallest pieces to the whole. Both take as many rounds as a depth has bits, and move each turn
once a round at most.

All tables are tall: a turn, or a node, is a row. A conversation of any length is spread over
many tasks, and so is a first turn that a third of all conversations share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.operators.rank import rank_within_key
from airstrata.operators.skew import heavy_keys, spread_join
from airstrata.session import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Turns that a conversation may take over from the first of its block of twenty.
MOST_SHARED, BLOCK = 3, 20
#: Ids that are written together before they are hashed in order.
CHUNK_IDS = 256


def _name(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def number_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, position, name, n_words)``: the turns of each conversation from 1.

    They are ordered by ``turn``, a whole number, NULL first; turns of an equal number follow
    each other by their name, the SHA-256 of role and text. NULL role or text counts as
    empty. Rows without a conv_id belong to no conversation and are left out. Other columns
    play no part.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    size = F.octet_length(role).cast("string")
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.col("turn").isNull().alias("unnumbered"),
        F.bitwise_not(F.col("turn").cast("long")).alias("falling"),
        _name(size.cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary")).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
    )
    # Ranking reads its input twice, so the texts are hashed and counted before.
    order = ["unnumbered", "falling", "name"]
    placed = rank_within_key(stored(turns, "turns"), ["conv_id"], order, "position")
    return placed.select("conv_id", F.col("position").cast("long"), "name", "n_words")


def _shared_turns() -> Column:
    """How many turns a conversation takes over, drawn from its id."""
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)


def rebuild_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin alike: ``(conv_id, depth, name, n_words)`` and ``(conv_id, length)``.

    A conversation c gets the first h turns of conversation c - c % 20 (all it has, if fewer;
    none, if there is no such conversation) and keeps its own turns after its first h, where h
    is the CRC-32 of its decimal id modulo 4. One that has no further turns stays, turnless.
    ``turns`` are numbered (``number_turns``) and should be stored, since they are read often.
    """
    sizes = stored(
        turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns")).select(
            "conv_id", "n_turns", _shared_turns().alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base")
        ),
        "conversations",
    )
    # At most 39 conversations have one base, so these joins have no large groups.
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    lengths = sizes.join(bases, "base", "left").select(
        "conv_id", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("length"),
    )
    lengths = stored(lengths, "lengths")
    heads = turns.filter(F.col("position") <= MOST_SHARED).withColumnRenamed("conv_id", "base")
    shared = sizes.join(heads, "base").filter("position <= h").select(
        "conv_id", F.col("position").alias("depth"), "name", "n_words"
    )
    # Own turns move up where the base had fewer turns than were to be taken.
    short = lengths.filter("taken < h").select(
        F.col("conv_id").alias("short_id"), (F.col("h") - F.col("taken")).alias("missing")
    )
    own = turns.filter(F.col("position") > _shared_turns())
    own = spread_join(own, short, "conv_id", "short_id", heavy_keys(own, "conv_id"), "left")
    moved = (F.col("position") - F.coalesce("missing", F.lit(0))).alias("depth")
    rebuilt = shared.unionByName(own.select("conv_id", moved, "name", "n_words"))
    return rebuilt, lengths.select("conv_id", "length")


def _segments(turns: DataFrame, rounds: int) -> list[DataFrame]:
    """By round j: ``(conv_id, block, name, n_words)`` of the complete runs of 2^j turns.

    Block b covers turns b * 2^j + 1 to (b + 1) * 2^j; equal runs have equal names. ``n_words``
    are those of the last turn.
    """
    found = [turns.select("conv_id", (F.col("depth") - 1).alias("block"), "name", "n_words")]
    odd = F.col("block") % 2 == 1
    for _ in range(rounds - 1):
        halves = found[-1].groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.when(~odd, F.col("name"))).alias("left"),
            F.max(F.when(odd, F.col("name"))).alias("right"),
            F.max(F.when(odd, F.col("n_words"))).alias("n_words"),
        )
        whole = halves.filter("n = 2").select(
            "conv_id", "block", _name(F.col("left"), F.col("right")).alias("name"), "n_words"
        )
        found.append(stored(whole, "segments"))
    return found


def name_prefixes(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, int]:
    """``(conv_id, depth, prefix, n_words)`` of every prefix, and the rounds of the recursion.

    Equal prefixes, and no others, share ``(depth, prefix)``. The empty prefix has depth 0 and
    no words.
    """
    deepest = lengths.agg(F.max("length")).first()[0] or 0
    rounds = int(deepest).bit_length()
    root = F.unhex(F.sha2(F.lit(b""), 256))
    named = lengths.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), root.alias("prefix"), F.lit(0).cast("long").alias("n_words")
    )
    segments = _segments(turns, rounds) if rounds else []
    for j in reversed(range(rounds)):
        # Tries of height 2^(j+1), rooted at the depths that are named by now, are cut at half.
        halves = segments[j].filter(F.col("block") % 2 == 0).select(
            "conv_id",
            F.shiftleft("block", j).alias("depth"),
            F.col("name"),
            F.col("n_words").alias("last_words"),
        )
        cut = halves.join(named, ["conv_id", "depth"]).select(
            "conv_id",
            (F.col("depth") + (1 << j)).alias("depth"),
            _name(F.col("prefix"), F.col("name")).alias("prefix"),
            F.col("last_words").alias("n_words"),
        )
        named = stored(named.unionByName(cut), "prefixes")
    return named, rounds


def _graft(totals: DataFrame, paths: DataFrame, j: int) -> DataFrame:
    """Totals within tries of height 2^(j+1), from those within their halves of height 2^j.

    A root of a lower half gives its totals to the nodes above it in the upper half. These lie
    on the path of any member, such as the one the root is named by.
    """
    low = (1 << j) - 1
    roots = totals.filter(
        (F.shiftright("depth", j) % 2 == 1) & (F.col("depth").bitwiseAND(F.lit(low)) == 0)
    ).select("conv_id", (F.shiftright("depth", j) - 1).alias("half"), "n_leaves", "saved_tokens")
    above = paths.select("conv_id", F.shiftright("depth", j).alias("half"), "depth", "prefix")
    gains = above.join(roots, ["conv_id", "half"]).groupBy("depth", "prefix").agg(
        F.lit(None).cast(totals.schema["conv_id"].dataType).alias("conv_id"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
    )
    return totals.unionByName(gains).groupBy("depth", "prefix").agg(
        F.max("conv_id").alias("conv_id"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
    )


def _chunks(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of (depth, prefix, conv_id) as comma-joined runs of ids of one node."""
    for table in tables:
        rows: dict[str, list] = {"depth": [], "prefix": [], "first_id": [], "ids": []}
        before, run = None, []
        columns = (table.column(name).to_pylist() for name in ("depth", "prefix", "conv_id"))

        def end() -> None:
            if run:
                for name, value in zip(rows, (*before, run[0], ",".join(map(str, run)))):
                    rows[name].append(value)
                run.clear()

        for depth, prefix, conv in zip(*columns):
            if (depth, prefix) != before or len(run) == CHUNK_IDS:
                end()
                before = (depth, prefix)
            run.append(conv)
        end()
        yield pa.RecordBatch.from_pydict(
            rows,
            pa.schema([("depth", pa.int64()), ("prefix", pa.binary()), ("first_id", pa.int64()), ("ids", pa.string())]),
        )


def _hashed_in_order(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, which come sorted; holds one state at a time."""
    schema = pa.schema([("depth", pa.int64()), ("prefix", pa.binary()), ("ends_sha256", pa.string())])
    node, state = None, hashlib.sha256()
    for table in tables:
        done = []
        columns = (table.column(name).to_pylist() for name in ("depth", "prefix", "ids"))
        for depth, prefix, ids in zip(*columns):
            if (depth, prefix) == node:
                state.update(b",")
            else:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (depth, prefix), hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done) if done else ([], [], []), schema)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((*node, state.hexdigest()), schema)], schema=schema
        )


def digest_ends(ends: DataFrame) -> DataFrame:
    """``(depth, prefix, ends_sha256)`` of ``(depth, prefix, conv_id)``: a hash of the sorted ids.

    A hash of ids in order has to see them one after the other. Rows are sorted over all tasks
    and written as chunks of ids there, so a node at which a third of all conversations end
    brings a small part of that many rows to the task that hashes them, and that task holds a
    batch of chunks at a time.
    """
    order = ["depth", "prefix", "conv_id"]
    placed = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = placed.mapInArrow(_chunks, "depth long, prefix binary, first_id long, ids string")
    chunks = stored(chunks, "ends")
    node = ["depth", "prefix"]
    return chunks.repartition(*node).sortWithinPartitions(*node, "first_id").mapInArrow(
        _hashed_in_order, "depth long, prefix binary, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each distinct prefix of the sequences, the empty one included.

    ``turns`` has ``(conv_id, depth, name, n_words)``, depths from 1 without gaps, and
    ``lengths`` a row ``(conv_id, length)`` for each sequence, also the empty ones; conv_id is
    a long. A node is known by ``depth`` and ``conv_id``, the smallest of its members (the
    sequences that begin with it). ``parent_conv_id`` is the parent's conv_id, NULL for the
    root; ``n_convs`` counts members, ``n_children`` children, ``n_leaves`` the childless nodes
    of its subtree, itself included; ``saved_tokens`` sums over its subtree what keeping each
    node once saves, (n_convs - 1) * n_words; ``ends_sha256`` is the SHA-256 of the decimal ids
    of the members that end there, in order, joined by commas. Without sequences there are no
    rows.
    """
    turns, lengths = stored(turns, "turns"), stored(lengths, "lengths")
    paths, rounds = name_prefixes(turns, lengths)
    nodes = stored(
        paths.groupBy("depth", "prefix").agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("n_words").alias("n_words"),
        ),
        "nodes",
    )
    # The parent lies one step up on the path of any member.
    step = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"))
    edges = nodes.filter("depth > 0").join(step, ["conv_id", "depth"]).select(
        "depth", "prefix", (F.col("depth") - 1).alias("above_depth"), "above",
        F.xxhash64(F.col("depth") - 1, "above").alias("above_key"),
    )
    edges = stored(edges, "edges")
    children = edges.groupBy(F.col("above_depth").alias("depth"), F.col("above").alias("prefix")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = stored(
        nodes.join(children, ["depth", "prefix"], "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0))
        ),
        "nodes",
    )
    totals = nodes.select(
        "depth", "prefix", "conv_id",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
    )
    for j in range(rounds):
        totals = stored(_graft(totals, paths, j), "totals")

    above = nodes.select(
        F.xxhash64("depth", "prefix").alias("node_key"),
        F.col("depth").alias("node_depth"),
        F.col("prefix").alias("node_prefix"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    same = (F.col("above_depth") == F.col("node_depth")) & (F.col("above") == F.col("node_prefix"))
    heavy = heavy_keys(edges, "above_key")
    parents = spread_join(edges, above, "above_key", "node_key", heavy, also=same)
    ends = paths.join(lengths.withColumnRenamed("length", "depth"), ["conv_id", "depth"])
    ends = digest_ends(ends.select("depth", "prefix", "conv_id"))
    node = ["depth", "prefix"]
    whole = (
        nodes.select(*node, "conv_id", "n_convs", "n_children")
        .join(totals.drop("conv_id"), node)
        .join(parents.select(*node, "parent_conv_id"), node, "left")
        .join(ends, node, "left")
    )
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, rebuilt: bool = False) -> DataFrame:
    """``prefix_trie`` of ``conversations`` as they are, or ``rebuilt`` to begin alike.

    Rows repeat turns where they repeat. For nulls, ties and other columns see
    ``number_turns``; an empty table gives no rows.
    """
    turns = stored(number_turns(conversations), "turns")
    if rebuilt:
        return prefix_trie(*rebuild_conversations(turns))
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    return prefix_trie(turns.withColumnRenamed("position", "depth"), lengths)
