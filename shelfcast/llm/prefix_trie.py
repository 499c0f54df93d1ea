"""The trie of all conversations by their turns, with totals of subtrees passed from nodes to parents.

A node is a sequence of first turns, named by 128 bits that a hash of its parent's name and its last
turn gives. Nodes that many conversations share make the top of the trie; what hangs below
it, subtrees of few conversations each, are the shards. In a task, the nodes of its shards are sorted
by reverse level order. A node takes what its children have left for it in a priority queue, adds its
own, and leaves the sum for its parent: nothing but the queue is held, and that spills. Roots of
shards pass on to the top, whose nodes go through the same in the end.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.shared import stored

#: Conversations a shard may have, and the number of nodes the top may have.
SHARD_CONVERSATIONS = 100
TOP_NODES = 100_000
#: Messages that a queue holds before it spills, ids in a piece of text, rows in a batch.
QUEUE, PIECE, BATCH = 200_000, 4_096, 8_192
ROOT = bytes(16)
MESSAGE, MESSAGE_BYTES = "<qqqqq", 40


class SpillingQueue:
    """Messages (level, name in two numbers, leaves, saved) by their first three, least first.

    Over ``limit`` of them go to a file as a sorted run, and runs are read again as their turn comes.
    """

    def __init__(self, limit: int = QUEUE) -> None:
        self.limit, self.held, self.runs = limit, [], []

    def push(self, message: tuple[int, int, int, int, int]) -> None:
        heapq.heappush(self.held, message)
        if len(self.held) > self.limit:
            run = tempfile.TemporaryFile()
            for m in sorted(self.held):
                run.write(struct.pack(MESSAGE, *m))
            run.seek(0)
            self.held = []
            self._next(run)

    def _next(self, run) -> None:
        data = run.read(MESSAGE_BYTES)
        if data:
            heapq.heappush(self.runs, (struct.unpack(MESSAGE, data), id(run), run))
        else:
            run.close()

    def take(self, address: tuple[int, int, int]) -> list[tuple[int, int, int, int, int]]:
        """All messages for an address, which no other in the queue is before."""
        found = []
        while self.held and self.held[0][:3] == address:
            found.append(heapq.heappop(self.held))
        while self.runs and self.runs[0][0][:3] == address:
            message, _, run = heapq.heappop(self.runs)
            found.append(message)
            self._next(run)
        return found


def _turns(rows: DataFrame, donor: Column, taken: Column) -> DataFrame:
    """Every turn as a digest of role and text and the bytes of the text, with its donor."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), donor.cast("long").alias("donor"),
        taken.cast("int").alias("taken"), "turn", F.unhex(F.sha2(said, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


PATH = T.StructType([
    *[T.StructField(c, T.LongType()) for c in (
        "k1", "k2", "p1", "p2", "s1", "s2", "depth", "conv_id", "bytes", "ends")],
])


def _paths(turns: DataFrame, most_taken: int, top: set[bytes] | None) -> DataFrame:
    """One row per conversation and node on its path: the node (k), its parent (p) and shard (s).

    Turns of a donor and of all who take from it are one stream, the donor's first. Only its first
    ``most_taken`` turns are held. ``ends`` is 1 where the conversation ends. The shard is the first
    node of the path that isn't in ``top``, by its name; nodes of the top have none. Without ``top``
    shards are left open.
    """
    spark = turns.sparkSession
    marks = None if top is None else spark.sparkContext.broadcast(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = marks.value if marks else None
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)], names=PATH.names
            )
            out.clear()
            return made

        def node(conv: int, depth: int, key: bytes, parent: bytes | None, shard: bytes | None, size: int):
            """The node's row, its end still open."""
            p = struct.unpack("<qq", parent) if parent is not None else (None, None)
            s = struct.unpack("<qq", shard) if shard is not None else (None, None)
            return (*struct.unpack("<qq", key), *p, *s, depth, conv, size, 0)

        donor, first, now, last = None, [], None, None
        for rows in batches:
            for conv, source, taken, digest, size in zip(
                *[rows.column(c).to_pylist() for c in ("conv_id", "donor", "taken", "digest", "bytes")]
            ):
                if source != donor:
                    donor, first = source, []
                steps = []
                if conv != now:
                    if last:
                        out.append((*last[:-1], 1))
                    now, place, depth, key, shard = conv, 0, 0, ROOT, None
                    last = node(conv, 0, ROOT, None, None, 0)
                    if conv != donor:
                        steps = first[:taken]
                if conv == donor:
                    if len(first) < most_taken:
                        first.append((digest, size))
                    steps = [(digest, size)]
                elif place >= taken:
                    steps = [*steps, (digest, size)]
                place += 1
                for said, length in steps:
                    out.append(last)
                    parent, key = key, hashlib.sha256(key + said).digest()[:16]
                    depth += 1
                    if shard is None and heavy is not None and key not in heavy:
                        shard = key
                    last = node(conv, depth, key, parent, shard, length)
                if len(out) >= BATCH:
                    yield batch()
        if last:
            out.append((*last[:-1], 1))
        if out:
            yield batch()

    together = turns.withColumn("other", F.col("conv_id") != F.col("donor"))
    order = ("donor", "other", "conv_id", F.col("turn").asc_nulls_first(), "digest")
    return (
        together.repartition("donor").sortWithinPartitions(*order)
        .select("conv_id", "donor", "taken", "digest", "bytes").mapInArrow(run, PATH)
    )


def _top(counts: DataFrame, shard_conversations: int, top_nodes: int) -> set[bytes]:
    """Names of the nodes with more conversations than a shard may have. Each stands for that
    many rows of the paths, so a limit of a ``top_nodes``-th of all rows leaves at most so many."""
    rows = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(shard_conversations, rows // top_nodes)
    large = counts.filter(F.col("n") > limit).select("k1", "k2").collect()
    return {ROOT, *[struct.pack("<qq", *r) for r in large]}


TOTALS = T.StructType([
    *[T.StructField(c, T.LongType()) for c in (
        "k1", "k2", "p1", "p2", "s1", "s2", "depth", "conv_id", "n_convs", "saved",
        "n_children", "n_leaves", "saved_tokens")],
])


def _time_forward(nodes: DataFrame, queue: int) -> DataFrame:
    """Totals of the subtrees of all nodes of a partition, which holds whole shards.

    ``saved`` is the node's own; n_children, n_leaves and saved_tokens come with what subtrees outside
    the partition have passed on, and get those inside added.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        messages = SpillingQueue(queue)
        for rows in batches:
            out = []
            for k1, k2, p1, p2, s1, s2, depth, conv, n, own, children, leaves, saved in zip(
                *[c.to_pylist() for c in rows.columns]
            ):
                mail = messages.take((-depth, k1, k2))
                children += len(mail)
                leaves = leaves + sum(m[3] for m in mail) if children else 1
                saved += own + sum(m[4] for m in mail)
                if p1 is not None and (k1, k2) != (s1, s2):
                    messages.push((1 - depth, p1, p2, leaves, saved))
                out.append((k1, k2, p1, p2, s1, s2, depth, conv, n, own, children, leaves, saved))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)], names=TOTALS.names
                )

    ordered = nodes.sortWithinPartitions(F.col("depth").desc(), "k1", "k2")
    return ordered.select(*TOTALS.names).mapInArrow(run, TOTALS)


def _ends(paths: DataFrame) -> DataFrame:
    """(k1, k2, sha) of nodes at which conversations end, over their ids in order.

    Ids are sorted across all tasks, so those of one node may lie in many. A task writes them as
    pieces of text, and the pieces of a node, few and in order, go through one hash.
    """
    piece = T.StructType([
        T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
        T.StructField("first", T.LongType()), T.StructField("text", T.StringType()),
    ])
    hashed = T.StructType([*piece.fields[:2], T.StructField("sha", T.StringType())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, ids = [], None, []
        for rows in batches:
            for k1, k2, conv in zip(*[c.to_pylist() for c in rows.columns]):
                if ids and ((k1, k2) != now or len(ids) >= PIECE):
                    out.append((*now, ids[0], ",".join(map(str, ids))))
                    ids = []
                now = (k1, k2)
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(piece.names, r)) for r in out], schema=pieces
                )
                out = []
        if ids:
            last = dict(zip(piece.names, (*now, ids[0], ",".join(map(str, ids)))))
            yield pa.RecordBatch.from_pylist([last], schema=pieces)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for rows in batches:
            out = []
            for k1, k2, text in zip(*[rows.column(c).to_pylist() for c in ("k1", "k2", "text")]):
                if (k1, k2) == now:
                    sha.update(b"," + text.encode())
                else:
                    if now:
                        out.append((*now, sha.hexdigest()))
                    now, sha = (k1, k2), hashlib.sha256(text.encode())
            if out:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(hashed.names, r)) for r in out], schema=shas
                )
        if now:
            last = dict(zip(hashed.names, (*now, sha.hexdigest())))
            yield pa.RecordBatch.from_pylist([last], schema=shas)

    pieces = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("text", pa.string())])
    shas = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("sha", pa.string())])
    order = ("k1", "k2", "conv_id")
    ends = paths.filter("ends = 1").select(*order)
    texts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, piece)
    return (
        texts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
        .mapInArrow(digest, hashed)
    )


def prefix_trie(
    rows: DataFrame, donor: Column | None = None, taken: Column | None = None, most_taken: int = 8,
    shard_conversations: int = SHARD_CONVERSATIONS, top_nodes: int = TOP_NODES, queue: int = QUEUE,
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256, as in the trie of ``rows`` (conv_id, turn, role, text).

    A conversation may take its first turns from another: ``donor`` and ``taken`` (at most
    ``most_taken``) are expressions on conv_id. It is then the first ``taken`` turns of the donor and
    its own behind its first ``taken``; the donor must be its own donor. By default all
    are as they are.

    Turns go by ``turn``, NULL first; ties by a digest of role and text; repeated rows are repeated
    turns. A NULL role or text is empty. Rows with a NULL conv_id belong to no conversation and are
    left out. Other columns are ignored, and no rows make no node. A conversation is one stream
    through a task, its turns as digests; of a node's conversations nothing is held together.
    """
    donor = F.col("conv_id") if donor is None else donor
    turns = stored(_turns(rows, donor, F.lit(0) if taken is None else taken), "trie-turns")
    counts = stored(
        _paths(turns, most_taken, None).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")),
        "trie-counts",
    )
    top = _top(counts, shard_conversations, top_nodes)
    paths = stored(_paths(turns, most_taken, top), "trie-paths")
    # What depends on the node alone is the same in all of its rows.
    nodes = paths.groupBy("k1", "k2").agg(
        *[F.max(c).alias(c) for c in ("p1", "p2", "s1", "s2", "depth", "bytes")],
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
    ).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = stored(nodes, "trie-nodes")

    nothing = {c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved_tokens")}
    below = nodes.filter("s1 IS NOT NULL").withColumns(nothing).repartition("s1", "s2")
    below = stored(_time_forward(below, queue), "trie-shards")
    passed = below.filter("k1 = s1 AND k2 = s2").groupBy(
        F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
    )
    above = nodes.filter("s1 IS NULL").join(passed, ["k1", "k2"], "left").fillna(0, list(nothing))
    done = below.unionByName(_time_forward(above.repartition(1), queue))

    parents = nodes.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    empty = hashlib.sha256(b"").hexdigest()
    return (
        done.join(parents, ["p1", "p2"], "left").join(_ends(paths), ["k1", "k2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            "saved_tokens", F.coalesce("sha", F.lit(empty)).alias("ends_sha256"),
        )
    )
