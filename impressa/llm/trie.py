"""Prefix trie of conversations as a z-fast trie in tables.

A node of the compacted trie is where conversations part or end; its edge covers the turns since the
node above. Nodes are found by their handles: the hash of the prefix whose length is the two-fattest
number of the edge (the one divisible by the largest power of two). A conversation finds the node
where it leaves the trie by fat binary search over lengths, one probe of the handle table a round.

Conversations are inserted in batches. What a batch shares with the trie is passed over by the search;
only turns beyond it become nodes, and edges that are left half way are split. At the end edges are
expanded to one node a turn.

All of it is joins and aggregations over rows (conversation, depth). No sequence is ever a list in one
row, so a conversation of millions of turns is spread like any other rows, and a node with very many
conversations is only ever added up, or met by a join whose other side has one row for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from impressa.operators.ordering import number_rows, running_totals
from impressa.session import materialize

# The first batch has one in so many sequences, each further one so many times more.
BATCH_GROWTH = 8
# Rounds of the search between two written tables.
_ROUNDS_A_TABLE = 4
# Ids are hashed in runs of about this many characters.
_RUN_CHARACTERS = 1 << 16


# ---------------------------------------------------------------- conversations


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position from 1, digest, chars) of every row with a conv_id.

    Turns follow their number, null first; rows of equal number follow the SHA-256 of role and text,
    so that repeated rows are turns of their own. A null role or text is empty. ``chars`` counts the
    code points of the text. Texts are read once and not shuffled.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.sha2(F.encode(content, "UTF-8"), 256).alias("digest"),
        F.length(text).cast("bigint").alias("chars"),
    )
    rows = materialize(number_rows(turns, ["conv_id", F.asc_nulls_first("turn"), "digest"], "place"))
    starts = rows.groupBy("conv_id").agg(F.min("place").alias("start"))
    return rows.join(starts, "conv_id").select(
        "conv_id", (F.col("place") - F.col("start") + 1).alias("position"), "digest", "chars"
    )


def rebuilt(turns: DataFrame, every: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows): every conversation begins with turns of the first one of its hundred.

    ``turns`` is the result of :func:`ordered_turns`. Conversation c takes the first h turns of
    c - c % ``every`` (all if fewer, none if absent), h being the CRC-32 of c in decimal modulo
    ``most`` + 1, and then its own turns after its first h. Results are (conv_id, length), also of
    those without turns, and (conv_id, depth from 1, digest, chars).
    """
    turns = materialize(turns)
    conversations = turns.groupBy("conv_id").agg(F.max("position").alias("own"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = (
        turns.filter((F.col("conv_id") % every == 0) & (F.col("position") <= most))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("position", "digest", "chars"))).alias("head"))
    )
    planned = materialize(
        conversations.withColumn("taken", taken)
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
        .join(heads, "base", "left")
        .withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("taken")), F.array().cast(heads.schema["head"].dataType)))
    )
    begun = F.size("head")
    first = planned.select("conv_id", F.inline("head")).withColumnRenamed("position", "depth")
    rest = turns.join(planned.select("conv_id", "taken", begun.alias("begun")), "conv_id").filter(
        F.col("position") > F.col("taken")
    )
    rows = first.unionByName(
        rest.select("conv_id", (F.col("position") - F.col("taken") + F.col("begun")).alias("depth"), "digest", "chars")
    )
    length = begun + F.greatest(F.lit(0), F.col("own") - F.col("taken"))
    return planned.select("conv_id", length.cast("bigint").alias("length")), rows


def prefix_keys(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, pa, pb, chars, total) for rows (conv_id, depth from 1, digest, chars).

    (a, b) stands for the first ``depth`` turns, (pa, pb) for those without the last: 128 bits, the
    exclusive or of a hash of each turn and its depth. So keys are running totals, which need no task
    that holds a conversation. ``total`` adds up the code points of these turns.
    """
    hashed = rows.select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), "chars",
        F.xxhash64("depth", "digest").alias("a"), F.xxhash64("digest", F.lit(7), "depth").alias("b"),
    )
    summed = materialize(running_totals(hashed, ["conv_id", "depth"], ["chars"], ["a", "b"]))
    begins = summed.filter(F.col("depth") == 1).select(
        "conv_id",
        F.col("cum_a").bitwiseXOR(F.col("a")).alias("start_a"),
        F.col("cum_b").bitwiseXOR(F.col("b")).alias("start_b"),
        (F.col("cum_chars") - F.col("chars")).alias("start"),
    )
    key = lambda c: F.col(f"cum_{c}").bitwiseXOR(F.col(f"start_{c}"))
    return summed.join(begins, "conv_id").select(
        "conv_id", "depth", key("a").alias("a"), key("b").alias("b"),
        key("a").bitwiseXOR(F.col("a")).alias("pa"), key("b").bitwiseXOR(F.col("b")).alias("pb"),
        "chars", (F.col("cum_chars") - F.col("start")).alias("total"),
    )


# ---------------------------------------------------------------- z-fast trie


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that is divisible by the largest power of two; ``low`` < ``high``."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, bits), bits)


def _previous(points: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """Each point with ``columns`` of the point before it in its group, by depth, as ``before``.

    Points are numbered over a global order and joined with themselves, so no task holds a group.
    """
    numbered = materialize(number_rows(points, [*groups, "depth"], "place"))
    before = numbered.select(
        (F.col("place") + 1).alias("place"), F.struct(*groups, *columns).alias("before")
    )
    joined = numbered.join(before, "place", "left").drop("place")
    same = [F.col(f"before.{g}") == F.col(g) for g in groups]
    for condition in same:
        joined = joined.withColumn("before", F.when(condition, F.col("before")))
    return joined


def _at(rows: DataFrame, owner: str, depth: str, **names: str) -> DataFrame:
    """Columns of the path of sequence ``owner`` at ``depth``, under other names, for a join on these."""
    return rows.select(
        F.col("x").alias(owner), F.col("depth").alias(depth), *[F.col(c).alias(n) for c, n in names.items()]
    )


_NODE = ["depth", "a", "b", "low", "la", "lb", "owner"]


@dataclass(frozen=True)
class Trie:
    """Nodes (depth, a, b, low, la, lb, owner), with handle (f, fa, fb) and first key (ca, cb).

    The edge of a node covers depths ``low`` + 1 to ``depth`` on the path of sequence ``owner``; (la, lb)
    is the key of the node above. The root has no row.
    """

    nodes: DataFrame

    @staticmethod
    def of(nodes: DataFrame, rows: DataFrame) -> Trie:
        """A trie of nodes whose handles and first keys are looked up on the paths of their owners."""
        named = nodes.select(*_NODE, two_fattest(F.col("low"), F.col("depth")).alias("f"), (F.col("low") + 1).alias("c"))
        joined = named.join(_at(rows, "owner", "f", a="fa", b="fb"), ["owner", "f"]).join(
            _at(rows, "owner", "c", a="ca", b="cb"), ["owner", "c"]
        )
        return Trie(materialize(joined.drop("c")))


def _locate(batch: DataFrame, rows: DataFrame, trie: Trie, longest: int) -> DataFrame:
    """(x, shared, node depth, node a, node b): how many turns of each sequence are in the trie already.

    The node is the one whose edge is left, or null where the sequence leaves at a node or the root.
    """
    handles = trie.nodes.select(
        "f", "fa", "fb", F.struct("depth", "a", "b", "owner", "f").alias("hit")
    )
    none = F.lit(None).cast(handles.schema["hit"].dataType)
    state = batch.select(
        "x", "length", F.lit(0).cast("bigint").alias("low"), F.col("length").alias("high"), none.alias("node")
    )
    for step in range(longest.bit_length()):
        probe = F.when(F.col("low") < F.col("high"), two_fattest(F.col("low"), F.col("high")))
        probed = state.withColumn("f", probe).join(_at(rows, "x", "f", a="fa", b="fb"), ["x", "f"], "left")
        looked = probed.join(handles, ["f", "fa", "fb"], "left")
        missed = F.col("f").isNotNull() & F.col("hit").isNull()
        state = looked.select(
            "x", "length",
            F.coalesce(F.col("hit.depth"), F.col("low")).alias("low"),
            F.when(missed, F.col("f") - 1).otherwise(F.col("high")).alias("high"),
            F.coalesce(F.col("hit"), F.col("node")).alias("node"),
        )
        if step % _ROUNDS_A_TABLE == _ROUNDS_A_TABLE - 1:
            state = materialize(state)
    # The last handle found is that of the node that is left, or of the one above it. Where its whole
    # edge is shared, the next key tells whether another edge begins that is left half way.
    state = state.withColumn("end", F.coalesce(F.col("node.depth"), F.lit(0).cast("bigint")))
    at_end = state.join(_at(rows, "x", "end", a="ea", b="eb"), ["x", "end"], "left")
    whole = F.col("node").isNull() | (
        F.coalesce(F.col("ea") == F.col("node.a"), F.lit(False)) & F.coalesce(F.col("eb") == F.col("node.b"), F.lit(False))
    )
    passed = at_end.select("x", "length", "node", "end", whole.alias("whole"), (F.col("end") + 1).alias("next"))
    firsts = trie.nodes.select(
        F.col("low").alias("end"), "ca", "cb",
        F.struct("depth", "a", "b", "owner", (F.col("low") + 1).alias("f")).alias("child"),
    )
    stepped = passed.join(_at(rows, "x", "next", a="ca", b="cb"), ["x", "next"], "left").join(
        firsts, ["end", "ca", "cb"], "left"
    )
    left = F.when(F.col("whole"), F.col("child")).otherwise(F.col("node"))
    exits = materialize(
        stepped.withColumn("left", left).select(
            "x", "end", F.col("left.depth").alias("node_depth"), F.col("left.a").alias("node_a"),
            F.col("left.b").alias("node_b"), F.col("left.owner").alias("owner"), F.col("left.f").alias("known"),
        )
    )
    # On that edge the sequence and the owner's path are compared depth by depth beyond the known part.
    inside = exits.filter(F.col("owner").isNotNull()).join(rows.select("x", "depth", "a", "b"), "x")
    inside = inside.filter((F.col("depth") > F.col("known")) & (F.col("depth") <= F.col("node_depth")))
    compared = inside.join(_at(rows, "owner", "depth", a="oa", b="ob"), ["owner", "depth"])
    equal = compared.filter((F.col("a") == F.col("oa")) & (F.col("b") == F.col("ob"))).groupBy("x").agg(
        F.count("*").alias("more")
    )
    shared = F.when(F.col("known").isNull(), F.col("end")).otherwise(F.col("known") + F.coalesce("more", F.lit(0)))
    return materialize(
        exits.join(equal, "x", "left").select("x", shared.alias("shared"), "node_depth", "node_a", "node_b", "owner")
    )


def _insert(batch: DataFrame, rows: DataFrame, ends: DataFrame, trie: Trie | None, longest: int) -> Trie:
    """The trie with the sequences of ``batch`` (x, length) in it."""
    if trie is None:
        missing = F.lit(None).cast("bigint")
        exits = batch.select(
            "x", F.lit(0).cast("bigint").alias("shared"),
            *[missing.alias(c) for c in ("node_depth", "node_a", "node_b", "owner")],
        )
    else:
        exits = _locate(batch, rows, trie, longest)
    beyond = rows.join(exits.select("x", "shared"), "x").filter(F.col("depth") > F.col("shared"))
    beyond = materialize(beyond.select("x", "shared", "depth", "a", "b", "pa", "pb"))
    # New depths: one row for each key, on the path of the smallest sequence with it.
    units = beyond.groupBy("depth", "a", "b").agg(
        F.min("x").alias("owner"), F.first("pa").alias("pa"), F.first("pb").alias("pb")
    )
    units = materialize(units)
    kids = units.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count("*").alias("kids")
    )
    key = ["depth", "a", "b"]
    marked = units.join(kids, key, "left").join(ends.select(*key, F.lit(True).alias("ends")), key, "left")
    passed_by = (F.coalesce("kids", F.lit(0)) == 1) & F.col("ends").isNull()
    explicit = marked.filter(~passed_by).select(*key, "owner")
    # The node above is the one before on the owner's path, or where the owner leaves the old trie.
    on_path = beyond.join(explicit, key).select("x", "shared", *key, "owner")
    linked = _previous(on_path, ["x"], ["depth", "a", "b"]).filter(F.col("x") == F.col("owner"))
    leaves = _at(rows, "x", "shared", a="sa", b="sb")
    new = linked.join(leaves, ["x", "shared"], "left").select(
        *key,
        F.coalesce(F.col("before.depth"), F.col("shared")).alias("low"),
        *[
            F.coalesce(F.when(F.col("before").isNotNull(), F.col(f"before.{c}")), F.col(f"s{c}"), F.lit(0).cast("bigint")).alias(f"l{c}")
            for c in ("a", "b")
        ],
        "owner",
    )
    if trie is None:
        return Trie.of(materialize(new), rows)
    # Edges that were left half way are cut there.
    cut = exits.filter(F.col("shared") < F.col("node_depth")).select(
        F.col("node_depth").alias("nd"), F.col("node_a").alias("na"), F.col("node_b").alias("nb"),
        "owner", F.col("shared").alias("depth"),
    ).distinct()
    cut = materialize(cut.join(_at(rows, "owner", "depth", a="a", b="b"), ["owner", "depth"]))
    edge = ["nd", "na", "nb"]
    touched = trie.nodes.select(F.col("depth").alias("nd"), F.col("a").alias("na"), F.col("b").alias("nb"), "low", "la", "lb", "owner").join(
        cut.select(*edge).distinct(), edge
    )
    whole = touched.select(*edge, "owner", F.col("nd").alias("depth"), F.col("na").alias("a"), F.col("nb").alias("b"))
    points = whole.unionByName(cut)
    pieces = _previous(points, edge, ["depth", "a", "b"]).join(
        touched.select(*edge, "low", "la", "lb"), edge
    )
    old = {"low": "depth", "la": "a", "lb": "b"}
    split = pieces.select(
        *key,
        *[F.when(F.col("before").isNotNull(), F.col(f"before.{c}")).otherwise(F.col(n)).alias(n) for n, c in old.items()],
        "owner",
    )
    kept = trie.nodes.select(*_NODE).join(
        touched.select(F.col("nd").alias("depth"), F.col("na").alias("a"), F.col("nb").alias("b")), key, "left_anti"
    )
    return Trie.of(materialize(kept.unionByName(split).unionByName(new)), rows)


def build(rows: DataFrame, ends: DataFrame, batches: int = 2) -> Trie | None:
    """The trie of distinct sequences, or None without any.

    ``rows`` is (x, depth, a, b, pa, pb, total) of each sequence, ``ends`` (x, depth, a, b) its last row.
    Batches are chosen by a hash of x, each ``BATCH_GROWTH`` times as large as the one before.
    """
    longest = ends.agg(F.max("depth")).first()[0]
    if not longest:
        return None
    draw = F.pmod(F.xxhash64("x", F.lit(3)), F.lit(BATCH_GROWTH ** (batches - 1)))
    trie = None
    for i in range(batches):
        low, high = (0 if i == 0 else BATCH_GROWTH ** (i - 1)), BATCH_GROWTH**i
        batch = ends.filter((draw >= low) & (draw < high)).select("x", F.col("depth").alias("length"))
        batch = materialize(batch)
        if not batch.isEmpty():
            trie = _insert(batch, rows, ends, trie, longest)
    return trie


# ---------------------------------------------------------------- operator


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, a, b, first, run): ids of each end in order, joined by commas, in runs of bounded length."""
    key, ids, size = None, [], 0

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["depth", "a", "b", "first", "run"]
        )

    for batch in batches:
        done: list[tuple] = []
        for *at, number in zip(*(batch[c].to_pylist() for c in ("depth", "a", "b", "conv_id")), strict=True):
            if ids and (at != key or size >= _RUN_CHARACTERS):
                done.append((*key, ids[0], ",".join(map(str, ids))))
                ids, size = [], 0
            key = at
            ids.append(number)
            size += len(str(number)) + 1
        yield out(done)
    if ids:
        yield out([(*key, ids[0], ",".join(map(str, ids)))])


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, a, b, ends_sha256) from sorted runs; a hash reads them one after the other."""
    key, digest = None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["depth", "a", "b", "ends_sha256"]
        )

    for batch in batches:
        done: list[tuple] = []
        for *at, run in zip(*(batch[c].to_pylist() for c in ("depth", "a", "b", "run")), strict=True):
            if at != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = at, hashlib.sha256(run.encode())
            else:
                digest.update(f",{run}".encode())
        yield out(done)
    if key is not None:
        yield out([(*key, digest.hexdigest())])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of rows (depth, a, b, conv_id): SHA-256 of the ids in ascending order.

    A hash is read in order, so its ids cannot be split; they are sorted by range over all tasks and
    joined to runs of about 64 KiB first, which is all that meets in one task.
    """
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["depth", "a", "b"]
    ordered = ends.select(*key, "conv_id").repartitionByRange(tasks, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
    runs = ordered.mapInArrow(_hash_ids, "depth bigint, a bigint, b bigint, first bigint, run string")
    gathered = runs.repartition(tasks, *key).sortWithinPartitions(*key, "first")
    return gathered.mapInArrow(_hash_runs, "depth bigint, a bigint, b bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, turns: DataFrame, batches: int = 2) -> DataFrame:
    """Nodes of the prefix trie: one row for each distinct sequence of first turns, and the root.

    ``conversations`` is (conv_id, length), ids unique; ``turns`` is (conv_id, depth from 1, digest,
    chars), ``length`` rows of each. Columns: conv_id (smallest member), depth, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256. Members are the conversations
    that begin with the sequence, all at the root; saved_tokens adds up, over the subtree, each node's
    members but one times the code points of its last text. A conversation without turns ends at the
    root. Without conversations there are no nodes.
    """
    spark = conversations.sparkSession
    path = materialize(prefix_keys(turns))
    key = ["depth", "a", "b"]
    last = path.join(conversations, "conv_id").filter(F.col("depth") == F.col("length"))
    zero = F.lit(0).cast("bigint")
    none = conversations.filter(F.col("length") == 0).select("conv_id", *[zero.alias(c) for c in (*key, "total")])
    ends = materialize(last.select("conv_id", *key, "total").unionByName(none))
    if ends.isEmpty():
        return _empty(spark)
    classes = materialize(ends.groupBy(*key, "total").agg(F.min("conv_id").alias("x"), F.count("*").alias("times")))
    sequences = classes.filter(F.col("depth") > 0)
    # Copies of a conversation are one sequence from here on.
    rows = materialize(
        path.join(sequences.select(F.col("x").alias("conv_id")), "conv_id", "left_semi").withColumnRenamed("conv_id", "x")
    )
    trie = build(rows, sequences, batches)
    everything = ends.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    digests = ends_digests(ends)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    if trie is None:
        return everything.join(digests).select(
            "conv_id", zero.alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs",
            zero.alias("n_children"), (zero + 1).alias("n_leaves"), zero.alias("saved_tokens"), "ends_sha256",
        )
    nodes = trie.nodes.select(*_NODE)
    kids = nodes.groupBy(F.col("low").alias("depth"), F.col("la").alias("a"), F.col("lb").alias("b")).agg(
        F.count("*").alias("n_children")
    )
    nodes = nodes.join(kids, key, "left").withColumn("n_children", F.coalesce("n_children", zero))
    lows = nodes.join(
        _at(rows, "owner", "low", total="low_total"), ["owner", "low"], "left"
    ).withColumn("low_total", F.coalesce("low_total", zero))
    nodes = materialize(lows.drop("owner"))
    # Every sequence brings its copies to all nodes of its path.
    weighted = sequences.select("x", "times", F.col("total").alias("all"))
    passing = materialize(
        rows.select("x", *key).join(nodes.select(*key, "low_total", "n_children"), key).join(weighted, "x")
    )
    leaf = F.count_if(F.col("n_children") == 0).alias("leaves_here")
    shares = passing.groupBy(*key).agg(
        F.sum("times").alias("n_convs"), F.min("x").alias("conv_id"),
        F.sum(F.col("times") * F.col("all")).alias("weighted"),
    )
    shares = materialize(shares)
    # A leaf is on one path, so the leaves below a node are its paths that end at one. Of the edges
    # below a node each belongs to the path of its smallest member: a path owns its own end, from the
    # highest node of which it is the smallest member.
    owned = passing.join(shares.select(*key, "conv_id"), key).filter(F.col("x") == F.col("conv_id"))
    tops = owned.groupBy("x").agg(F.min("low_total").alias("top"))
    ending = passing.groupBy("x").agg(leaf)
    facts = passing.join(tops.join(ending, "x"), "x")
    below = facts.groupBy(*key).agg(
        F.sum("leaves_here").alias("n_leaves"),
        F.sum(F.col("all") - F.greatest("top", "low_total")).alias("own_chars"),
    )
    full = nodes.join(shares, key).join(below, key).withColumn(
        "saved", F.col("weighted") - F.col("n_convs") * F.col("low_total") - F.col("own_chars")
    )
    full = materialize(full)
    above = full.select(
        F.col("depth").alias("low"), F.col("a").alias("la"), F.col("b").alias("lb"), F.col("conv_id").alias("above_id")
    )
    named = full.join(above, ["low", "la", "lb"], "left")
    top = everything.select(F.col("conv_id").alias("root_id"))
    named = named.join(F.broadcast(top)).withColumn("above_id", F.coalesce("above_id", "root_id"))
    # Edges become a node a turn, on the path of the smallest member.
    expanded = named.select(
        "conv_id", "low", F.col("depth").alias("end"), F.col("a").alias("end_a"), F.col("b").alias("end_b"), "above_id",
        "n_convs", "n_children", "n_leaves", "saved", "low_total",
        F.explode(F.sequence(F.col("low") + 1, F.col("depth"))).alias("depth"),
    )
    units = rows.select(F.col("x").alias("conv_id"), "depth", "chars", "total")
    placed = expanded.join(units, ["conv_id", "depth"])
    passed = F.col("total") - F.col("chars") - F.col("low_total")
    inner = F.col("depth") < F.col("end")
    turns_out = placed.select(
        "conv_id", "depth",
        F.when(F.col("depth") == F.col("low") + 1, F.col("above_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(inner, zero + 1).otherwise(F.col("n_children")).alias("n_children"),
        "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * passed).alias("saved_tokens"),
        *[F.when(~inner, F.col(f"end_{c}")).alias(c) for c in ("a", "b")],
    )
    base = full.filter(F.col("low") == 0).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    root = F.broadcast(everything).join(F.broadcast(base)).select(
        "conv_id", zero.alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens", zero.alias("a"), zero.alias("b"),
    )
    nodes_out = turns_out.unionByName(root).join(digests, key, "left")
    return nodes_out.withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).drop("a", "b")


def _empty(spark) -> DataFrame:
    numbers = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens".split()
    return spark.createDataFrame([], ", ".join([*[f"{c} bigint" for c in numbers], "ends_sha256 string"]))


def last_turns(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """``nodes`` with columns of ``rows`` (conv_id, depth, ...) for the last turn of each; the root has none."""
    return nodes.join(rows, ["conv_id", "depth"], "left")
