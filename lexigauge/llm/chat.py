r"""Chat formatting with shared beginnings emitted once.

A turn becomes `### role: text </turn>` and a line end. Inside roles and texts a backslash goes before every backslash and every control
string (and before a colon in a role), so nothing in a text can pass for a mark and the text can be read back.

Conversations that start with the same turns share a path of a prefix tree. A node is the digest of all turns up to it, a running
xor of hashes of (place, turn). Conversations ordered by their paths are the tree depth-first; a node belongs to the first of them that
has it, and lies behind that conversation's earlier nodes. So running sums over (conversation, depth) give every node its place in the
packed stream, and each node's text is emitted once. `position` counts along the conversation, not along the stream; `ancestors` are the
intervals of the stream that a node's tokens may attend to besides their own node up to themselves. Tokens are code points.

Paths, not texts, are sorted, in ranges; copies of a conversation count as one path and a common first turn as one node, both counted before the
shuffle. One conversation's rows meet in one task, as they do in training.

Defined cases: a null role or text is empty; a null conversation id is a conversation; equal turn numbers are ordered by role, then text, null turns
first; repeated rows are repeated turns; an empty table gives empty results; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lexigauge.sources.scratch import materialize

OPEN, CLOSE, LEARNED = "###", "</turn>", "assistant"
_ESCAPE, _ESCAPE_ROLE, _UNESCAPE = r"(\\|###|</turn>)", r"(\\|:|###|</turn>)", r"\\(\\|:|###|</turn>)"
_HEAD = r"^### ((?:[^\\:]|\\\\|\\:|\\###|\\</turn>)*): "
NODE = ("depth", "a", "b")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv, conv_id, depth, a, b, segment, length, position, loss_start, loss_length): a row per turn, formatted, with its node."""
    rows = turns.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), F.col("conv_id").cast("long").alias("conv_id"),
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    head = F.concat(F.lit(f"{OPEN} "), F.regexp_replace("role", _ESCAPE_ROLE, r"\\$1"), F.lit(": "))
    rows = rows.withColumn("depth", F.row_number().over(order) - 1).withColumn("_head", head).withColumn("_body", escape(F.col("text")))
    rows = rows.withColumn("segment", F.concat("_head", "_body", F.lit(f" {CLOSE}\n"))).withColumn("length", F.length("segment").cast("long"))
    learned = F.col("role") == LEARNED
    rows = rows.withColumn("loss_start", F.when(learned, F.length("_head"))).withColumn("loss_length", F.when(learned, F.length("_body")))
    rows = rows.withColumn("_h1", F.xxhash64("depth", "segment")).withColumn("_h2", F.xxhash64(F.lit("node"), "segment", "depth"))
    upto = W.partitionBy("conv").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    return rows.select(
        "conv", "conv_id", "depth", F.bit_xor("_h1").over(upto).alias("a"), F.bit_xor("_h2").over(upto).alias("b"), "segment", "length",
        (F.sum("length").over(upto) - F.col("length")).alias("position"), "loss_start", "loss_length",
    )


def pack(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, members) of conversations given by turn (conv_id, turn, role, text).

    nodes: tree (digest of its first turn), depth, a, b (digest of the node), start, length (its interval of the stream), position (of its
    first token), loss_start, loss_length (within the segment; null: no loss), segment, ancestors (array of start, end).
    members: conv, conv_id, depth, a, b: the node of each turn.
    """
    rows = materialize(format_turns(turns), "turns")
    narrow = rows.select("conv", *NODE, "length")
    leaf = narrow.groupBy("conv").agg(F.max(F.struct(*NODE)).alias("leaf"))
    first = leaf.groupBy("leaf").agg(F.min("conv").alias("conv")).select("conv")
    paths = narrow.join(first, "conv", "left_semi").groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*NODE, "length"))).alias("path"))
    key = F.transform("path", lambda n: F.struct(n.a.alias("a"), n.b.alias("b")))
    ordered = paths.withColumn("_key", key).repartitionByRange("_key").sortWithinPartitions("_key").drop("_key")
    ranked = materialize(ordered.withColumn("rank", F.monotonically_increasing_id()), "paths")  # partition, then row: the order of the paths
    steps = ranked.select("conv", "rank", F.inline("path"))
    owners = steps.groupBy(*NODE, "length").agg(F.min("rank").alias("owner"))
    owners = materialize(owners, "owners")
    # Start of every owner: the sums of the ranges before, then of the owners before in its range.
    totals = owners.groupBy("owner").agg(F.sum("length").alias("n")).withColumn("range", F.shiftright("owner", 33))
    ranges = totals.groupBy("range").agg(F.sum("n").alias("n")).select(  # a row per partition
        "range", (F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("before")
    )
    inside = W.partitionBy("range").orderBy("owner").rowsBetween(W.unboundedPreceding, 0)
    starts = totals.withColumn("inside", F.sum("n").over(inside) - F.col("n")).join(F.broadcast(ranges), "range").select(
        "owner", (F.col("before") + F.col("inside")).alias("own_start")
    )
    along = W.partitionBy("owner").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    placed = owners.withColumn("within", F.sum("length").over(along) - F.col("length")).join(starts, "owner").select(
        *NODE, "length", "owner", "own_start", (F.col("own_start") + F.col("within")).alias("start")
    )
    placed = materialize(placed, "placed")
    # The nodes above those that a path owns: their intervals in order of depth, neighbours joined.
    above = steps.select("rank", *NODE).join(placed.select(*NODE, "length", "owner", "start"), list(NODE)).filter("owner != rank")
    spans = above.groupBy(F.col("rank").alias("owner")).agg(
        F.array_sort(F.collect_list(F.struct("depth", "start", (F.col("start") + F.col("length")).alias("end")))).alias("_up")
    ).select("owner", _joined(F.col("_up")).alias("_up"))
    own = F.when(F.col("start") > F.col("own_start"), F.array(F.struct(F.col("own_start").alias("start"), F.col("start").alias("end"))))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    both = _joined(F.concat(F.coalesce("_up", empty), F.coalesce(own, empty)))
    holders = ranked.select(F.col("rank").alias("owner"), "conv", F.col("path")[0]["a"].alias("tree"))
    where = placed.join(spans, "owner", "left").join(holders, "owner").select("conv", "depth", "tree", "start", both.alias("ancestors"))
    nodes = rows.join(where, ["conv", "depth"]).select("tree", *NODE, "start", "length", "position", "loss_start", "loss_length", "segment", "ancestors")
    return nodes, rows.select("conv", "conv_id", *NODE)


def _joined(spans: Column) -> Column:
    """Join intervals that touch the one before."""
    return F.aggregate(
        spans, F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1).end == s.start),
            F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(F.element_at(out, -1).start.alias("start"), s.end.alias("end")))),
        ).otherwise(F.concat(out, F.array(F.struct(s.start.alias("start"), s.end.alias("end"))))),
    )


def read_back(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, turns, formatted): per conversation its turns (role, text, learned) and formatted text, read from the packed nodes."""
    body = F.regexp_replace(F.regexp_replace("segment", _HEAD, ""), rf" {CLOSE}\n$", "")
    read = members.join(nodes.select(*NODE, "segment", "loss_start", "loss_length"), list(NODE)).select(
        "conv", "conv_id", F.struct(
            "depth", unescape(F.regexp_extract("segment", _HEAD, 1)).alias("role"), unescape(body).alias("text"),
            unescape(F.substring("segment", F.col("loss_start") + 1, F.col("loss_length"))).alias("learned"), "segment",
        ).alias("turn"),
    )
    return read.groupBy("conv").agg(F.max("conv_id").alias("conv_id"), F.array_sort(F.collect_list("turn")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"), t.learned.alias("learned"))).alias("turns"),
        F.array_join(F.transform("turns", lambda t: t.segment), "").alias("formatted"),
    )
