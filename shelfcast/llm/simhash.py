"""SimHash near-duplicates, found on a grid of bit counts and verified bit by bit."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.shared import map_texts, stored, unused

SEED = 42
#: Points grow with the square of the number of segments from three bits on.
MOST_BITS = 4
#: Fingerprints at a grid point that are compared with each other.
CROWD = 64
#: Hashes whose bits are counted at a time.
BLOCK = 65536


def fingerprint(text: str | None, shingle_words: int) -> int:
    """Majority of the bits of all shingle hashes, as a signed long; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle_words)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at:at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    """Adds ``fp``, the fingerprint as a long, to the columns of ``docs``."""
    def start():
        return lambda texts: [(fingerprint(t, shingle_words),) for t in texts]

    return map_texts(docs, start, [T.StructField("fp", T.LongType())])


def _ball(center: str, step: str, radius: int) -> str:
    """SQL for the array of ``center`` and all values up to ``radius`` steps from it, each once.

    ``step`` is SQL for the array of values one step from ``x``.
    """
    ball = f"array({center})"
    for _ in range(radius):
        ball = f"array_distinct(flatten(transform({ball}, x -> concat(array(x), {step}))))"
    return ball


def grid_point(fp: str) -> str:
    """SQL for a fingerprint's point on the grid of segment counts.

    A segment is two bits; its count, 0 to 2, takes two bits of the packed point. Bits that differ
    move the counts by no more than one each, so the Manhattan distance of two points bounds the
    bit distance from below.
    """
    low = "6148914691236517205L"  # every second bit
    return (
        f"(((shiftrightunsigned({fp}, 1) ^ {fp}) & {low}) | "
        f"shiftleft(shiftrightunsigned({fp}, 1) & {fp} & {low}, 1))"
    )


def grid_points(points: DataFrame, max_bits: int) -> DataFrame:
    """(fp, point): each fingerprint at its own point and at all within half of ``max_bits`` steps.

    Points within Manhattan distance ``max_bits`` have a common one among these.
    """
    # On packed counts, 0 <-> 1 is an XOR with 1 and 1 <-> 2 an XOR with 3.
    step = (
        "flatten(transform(sequence(0, 62, 2), at -> CASE shiftrightunsigned(x, at) & 3L "
        "WHEN 0 THEN array(x ^ shiftleft(1L, at)) "
        "WHEN 1 THEN array(x ^ shiftleft(1L, at), x ^ shiftleft(3L, at)) "
        "ELSE array(x ^ shiftleft(3L, at)) END))"
    )
    ball = _ball(grid_point("fp"), step, (max_bits + 1) // 2)
    return points.selectExpr("fp", f"explode({ball}) AS point")


def crowd_links(crowd: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b), a > b, that connect all of ``fp`` within ``max_bits`` of each other, by stars.

    Here the segments have one bit, so that the grid's distance is the bit distance itself. Two
    values within ``max_bits`` share a point to which one has half of it, rounded down, and the
    other the rest. All values at a point are in reach of the least of its inner ones and are
    linked to that, so a crowd makes as many links as it has members and points, never its pairs.
    """
    step = "transform(sequence(0, 63), at -> x ^ shiftleft(1L, at))"
    balls = crowd.selectExpr(
        "fp", f"explode({_ball('fp', step, (max_bits + 1) // 2)}) AS z"
    ).repartition("z")
    inner = F.when(F.bit_count(F.col("fp").bitwiseXOR(F.col("z"))) <= max_bits // 2, F.col("fp"))
    hubs = balls.groupBy("z").agg(F.min(inner).alias("hub"), F.count("*").alias("n"))
    return (
        balls.join(hubs.filter("n > 1").hint("merge"), "z").filter("fp != hub")
        .selectExpr("greatest(fp, hub) AS a", "least(fp, hub) AS b")
    )


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b), a > b, that connect all distinct ``fp`` within ``max_bits`` of each other.

    Fingerprints at one grid point are candidates, and those within ``max_bits`` by their bits are
    linked. At a point of over ``CROWD`` fingerprints the candidates would be too many; these go to
    :func:`crowd_links`, which connects the same ones. Two that are near share a point, crowded or
    not, so none is missed.
    """
    if not 0 <= max_bits <= MOST_BITS:
        raise ValueError(f"distances go up to {MOST_BITS} bits")
    points = grid_points(prints, max_bits).repartition("point")
    sizes = points.groupBy("point").agg(F.count("*").alias("n")).hint("merge")
    at = points.join(sizes.filter(f"n BETWEEN 2 AND {CROWD}"), "point").select("point", "fp")
    other = at.selectExpr("point", "fp AS b").hint("merge")
    # Two fingerprints with one point share all the points around; they meet at their own.
    near = (
        at.withColumnRenamed("fp", "a").join(other, "point")
        .filter(f"a > b AND bit_count(a ^ b) <= {max_bits}")
        .filter(f"{grid_point('a')} != {grid_point('b')} OR point = {grid_point('a')}")
        .select("a", "b")
    )
    crowd = points.join(sizes.filter(f"n > {CROWD}"), "point").select("fp").distinct()
    return near.unionByName(crowd_links(crowd, max_bits)).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node in ``pairs`` (a, b): the connected components.

    Each round maps a node to the least of its neighbours, jumps once along that map, and contracts
    the links by it. Rounds are written out, so a lost executor repeats one round only.
    """
    edges, maps = stored(pairs, "links"), []
    while not edges.isEmpty():
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        low = stored(
            both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")), "links-low"
        )
        jumped = stored(
            low.join(low.selectExpr("a AS low", "low AS root"), "low")
            .selectExpr("a AS node", "root"),
            "links-map",
        )
        maps.append(jumped)
        to_a = jumped.selectExpr("node AS a", "root AS ra")
        to_b = jumped.selectExpr("node AS b", "root AS rb")
        edges = stored(
            edges.join(to_a, "a").join(to_b, "b").filter("ra != rb")
            .selectExpr("greatest(ra, rb) AS a", "least(ra, rb) AS b").distinct(),
            "links",
        )
    if not maps:
        return edges.selectExpr("a AS node", "b AS root")
    found = maps.pop()
    while maps:
        later = found.selectExpr("node AS root", "root AS last")
        found = maps.pop().join(later, "root", "left").selectExpr(
            "node", "coalesce(last, root) AS root"
        )
    return found


def _first(doc_id: str = "doc_id") -> Column:
    """Least id first, NULL ids last."""
    return F.min(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id), F.col("_text")))


def _members(docs: DataFrame, shingle_words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The stored rows (doc_id, _text, fp), and per fp the first row of its component."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    prints = stored(fingerprints(rows, shingle_words).drop("text"), "simhash-prints")
    classes = stored(prints.groupBy("fp").agg(_first().alias("first")), "simhash-classes")
    roots = components(links(classes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    linked = classes.join(roots, "fp")
    firsts = linked.groupBy("root").agg(F.min("first").alias("head"))
    heads = linked.join(firsts, "root").select("fp", "head")
    members = classes.join(heads, "fp", "left").select(
        "fp", F.coalesce("head", "first").alias("head")
    )
    return prints, stored(members, "simhash-members")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Equal fingerprints form a class, and classes within ``max_bits`` differing bits are linked;
    component_id is the least doc_id reachable, NULL only where all ids reached are NULL. Texts
    without words, NULL among them, have fingerprint zero. Repeated rows are in one class. An empty
    table gives no rows. Only doc_id and text are read.
    """
    prints, members = _members(docs, shingle_words, max_bits)
    return prints.join(members, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
    )


def deduplicate(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that come first in their component, all columns kept, one of each.

    First is the least doc_id (NULL last), then the hash of the text; of rows equal in both, the one
    whose other columns come first in order (NULL first), so that equal rows collapse. The columns must have
    an order.
    """
    _, members = _members(docs, shingle_words, max_bits)
    mark = unused(docs.columns)
    row, said, head = f"{mark}row", f"{mark}text", f"{mark}id"
    heads = members.select(
        F.col("head.doc_id").alias(head), F.col("head._text").alias(f"{mark}head")
    ).distinct()
    hashed = docs.select("doc_id", F.xxhash64("text").alias(said), F.struct("*").alias(row))
    kept = hashed.join(
        heads, F.col("doc_id").eqNullSafe(F.col(head)) & (F.col(said) == F.col(f"{mark}head")), "left_semi"
    )
    return kept.groupBy("doc_id", said).agg(F.min(row).alias(row)).select(f"{row}.*")
