"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfcast.llm.shared import stored

OVERHEAD = 16
#: Equal rows that are written out by one row of a plan.
TOGETHER = 4096


def ring(spark: SparkSession, shards: int, replicas: int, positions: int) -> DataFrame:
    """One row per ring position: the shard whose virtual node comes next clockwise.

    A node's place depends on its shard and number only, so that one more shard takes positions and
    changes no other. Of nodes that hash to one position the one with the least hash stays.
    """
    nodes = shards * replicas
    if positions < 2 * nodes:
        raise ValueError("the ring needs at least two positions for each virtual node")
    placed = (
        spark.range(nodes)
        .selectExpr(f"CAST(id div {replicas} AS INT) AS node_shard", f"id % {replicas} AS number")
        .withColumn("hash", F.xxhash64(F.lit("node"), "node_shard", "number"))
        .groupBy(F.pmod("hash", F.lit(positions)).alias("cell"))
        .agg(F.min_by("node_shard", "hash").alias("node_shard"))
    )
    cells = spark.range(positions).withColumnRenamed("id", "cell").join(placed, "cell", "left")
    back = W.orderBy(F.desc("cell")).rowsBetween(W.unboundedPreceding, 0)
    ahead = F.last("node_shard", ignorenulls=True).over(back)
    around = F.min_by("node_shard", F.when(F.col("node_shard").isNotNull(), F.col("cell"))).over(
        W.partitionBy()
    )
    return cells.withColumn("owner", F.coalesce(ahead, around))


def load_plan(ring_counts: DataFrame, shards: int, positions: int) -> DataFrame:
    """Which rows of each ring position go to which shard, from the counts per position alone.

    A shard keeps the first rows of its own arcs, in ring order, up to its capacity. What is left
    over continues clockwise; the free room of a shard is offered in equal parts at its virtual
    nodes, and is taken first come first served. All of it is running sums over ``positions`` rows,
    a number fixed by the ring, not by the data.

    Returns pieces as rows (cell, from_row, shard, slot): row i of a cell belongs to its last piece
    with from_row <= i.
    """
    everything = W.partitionBy()
    own = W.partitionBy("owner")
    before = own.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("n").over(everything)
    walked = (
        ring_counts.withColumn("total", total)
        .withColumn("load", F.sum("n").over(own))
        .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn(
            "capacity",
            F.expr(f"total div {shards}") + (F.col("owner") < F.col("total") % shards).cast("long"),
        )
        .withColumn("keep", F.greatest(F.lit(0), F.least("n", F.expr("capacity - base"))))
        .withColumn("over", F.expr("n - keep"))
        .withColumn("free", F.greatest(F.lit(0), F.expr("capacity - load")))
        .withColumn("nodes", F.count("node_shard").over(own))
        .withColumn("node", F.count("node_shard").over(own.orderBy("cell")))
        .withColumn(
            "room",
            F.when(F.col("node_shard").isNull(), 0).otherwise(
                F.expr("free * node div nodes - free * (node - 1) div nodes")
            ),
        )
        .withColumn("balance", F.sum(F.expr("over - room")).over(W.orderBy("cell")))
        # From the lowest balance on, left-over rows always come before the room they take.
        .withColumn("start", F.min(F.struct("balance", "cell")).over(everything)["cell"] + 1)
        .withColumn("turn", F.pmod(F.col("cell") - F.col("start"), F.lit(positions)))
    )
    lap = W.orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    shard_lap = W.partitionBy("owner").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    lapped = walked.select(
        "cell", "owner", "keep", "base", "over", "room", "n",
        F.least("load", "capacity").alias("kept"),
        F.coalesce(F.sum("over").over(lap), F.lit(0)).alias("over_at"),
        F.coalesce(F.sum("room").over(lap), F.lit(0)).alias("room_at"),
        F.coalesce(F.sum("room").over(shard_lap), F.lit(0)).alias("given"),
    )
    edges = (
        lapped.filter("over > 0")
        .selectExpr("over_at AS q", "struct(cell, keep, over_at) AS rows", "null AS place")
        .unionByName(
            lapped.filter("room > 0").selectExpr(
                "room_at AS q", "null AS rows",
                "struct(owner AS shard, kept + given AS slot, room_at) AS place",
            )
        )
        .groupBy("q").agg(F.max("rows").alias("rows"), F.max("place").alias("place"))
    )
    seen = W.orderBy("q")
    moved = (
        edges.select(
            "q",
            F.last("rows", ignorenulls=True).over(seen).alias("rows"),
            F.last("place", ignorenulls=True).over(seen).alias("place"),
        )
        .selectExpr(
            "rows.cell AS cell", "rows.keep + q - rows.over_at AS from_row",
            "place.shard AS shard", "place.slot + q - place.room_at AS slot",
        )
    )
    stayed = lapped.filter("keep > 0").selectExpr(
        "cell", "0L AS from_row", "owner AS shard", "base AS slot"
    )
    return stayed.unionByName(moved)


def _places(groups: DataFrame, counts: DataFrame, plan: DataFrame) -> DataFrame:
    """Equal rows of one piece as one line: the row, ``shard``, first ``slot`` and ``length``.

    Groups of equal rows and pieces both cut the rows of a cell; what lies between two cuts belongs
    to the last group and the last piece. No row is sent the pieces of its cell.
    """
    order = W.partitionBy("cell").orderBy("key", "doc_id", "text_crc32", "size")
    before = F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1))
    cuts = (
        groups.select(
            "cell", F.coalesce(before, F.lit(0)).alias("at"),
            F.struct("doc_id", "size", "text_crc32").alias("row"),
        )
        .unionByName(
            plan.select(
                "cell", F.col("from_row").alias("at"), F.struct("shard", "slot", "from_row").alias("piece")
            ),
            allowMissingColumns=True,
        )
        .unionByName(counts.select("cell", F.col("n").alias("at")), allowMissingColumns=True)
    )
    so_far = W.partitionBy("cell").orderBy("at").rangeBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy("cell").orderBy("at")
    return (
        cuts.select(
            "cell", "at", (F.lead("at").over(ahead) - F.col("at")).alias("length"),
            F.last("row", ignorenulls=True).over(so_far).alias("row"),
            F.last("piece", ignorenulls=True).over(so_far).alias("piece"),
        )
        .filter("length > 0")
        .selectExpr(
            "row.*", "cell", "at", "piece.shard AS shard",
            "piece.slot + at - piece.from_row AS slot", "length",
        )
    )


def _one_by_one(lines: DataFrame) -> DataFrame:
    """Every line ``length`` times, at one slot after the other. Long lines are spread over tasks."""
    parts = lines.withColumn(
        "part", F.explode(F.expr(f"sequence(0L, (length - 1) div {TOGETHER})"))
    ).repartition("cell", "at", "part")
    step = f"sequence(part * {TOGETHER}, least((part + 1) * {TOGETHER}, length) - 1)"
    return parts.withColumn("step", F.explode(F.expr(step)))


def shard(
    docs: DataFrame, shards: int = 40, replicas: int = 64, positions: int = 16384
) -> DataFrame:
    """Puts documents into shards whose row counts differ by one at most.

    The ring key is a hash of id and text, so NULL or repeated ids spread over the ring. Rows equal
    in both are interchangeable: they are counted, placed as one line per shard, and written out
    again from there, so that repeated rows cost no more than others, however many they are. A NULL
    text has size 16 and the CRC of no bytes; NULL ids are ordinary rows. An empty table gives an empty
    result. Only doc_id and text are read; other columns are ignored. The position count is a
    parameter: a position holds different rows / positions, ranked in one sort of narrow rows.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64("doc_id", "text").alias("key"),
        ),
        "shard-rows",
    ).withColumn("cell", F.pmod(F.col("key"), F.lit(positions)).cast("long"))
    counts = rows.groupBy("cell").agg(F.count("*").alias("n"))
    counted = ring(spark, shards, replicas, positions).join(counts, "cell", "left")
    plan = load_plan(counted.fillna({"n": 0}), shards, positions)
    groups = rows.groupBy("cell", "key", "doc_id", "text_crc32", "size").agg(F.count("*").alias("n"))
    lines = _places(groups, counts, plan)
    return _one_by_one(lines).selectExpr(
        "doc_id", "size", "text_crc32", "'rows' AS law", "shard", "slot + step AS slot",
        "CAST(null AS INT) AS grown_shard",
    )
