"""The prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is cut into blocks of ``WIDTH`` turns, one column per position. GROUP BY the node where
the block starts and ROLLUP of its columns counts all prefixes of a block together; ``grouping_id``
tells their depth. A conversation goes on into the next block, keyed by the node it reached, only while
others share that node: beyond it the trie is a path, one node a turn, which needs no counting.

A node is named by its smallest member and its depth, so every node on a member's path down from where
that member becomes the smallest bears its name. Sums over subtrees use this: a second ROLLUP adds up
what the members' own nodes hold, and the top of a subtree takes off what its namesakes above it hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewright.llm.frames import columns_as, map_arrow, materialize, parts
from galewright.operators.keys import global_row_number

WIDTH = 8
#: Length of the digest that a turn id starts with.
_DIGEST = 32
#: Ids of one node that are written as one text.
_PIECE = 8192


def turn_id(role: Column, text: Column) -> Column:
    """md5 of role and text, followed by the text's number of code points. NULL is the empty text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)), F.length(text).cast("string"))


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, pos, turn, length)``: turns by ascending number, NULL first, counted from 1.

    Turns of one number come in the order of their ids, so repeated rows are turns of their own. Rows
    without conv_id belong to no conversation and are left out. The order is a range partition, so a
    conversation of any length is cut between tasks.
    """
    own = columns_as(conversations, conv_id=conv_id, number=turn, role=role, text=text).where("conv_id IS NOT NULL")
    keyed = own.select(F.col("conv_id").cast("long"), F.col("number").cast("long"), turn_id(F.col("role"), F.col("text")).alias("turn"))
    rows = global_row_number(keyed, ["conv_id", "number", "turn"], "row")
    spans = rows.groupBy("conv_id").agg(F.min("row").alias("first"), F.count("*").alias("length"))
    return rows.join(spans, "conv_id").select("conv_id", (F.col("row") - F.col("first") + 1).alias("pos"), "turn", "length")


def with_borrowed_starts(turns: DataFrame, lender: Column, taken: Column) -> DataFrame:
    """Each conversation's first ``taken`` turns replaced by the first ``taken`` turns of ``lender``.

    ``turns`` has conv_id, pos, turn and length; ``lender`` and ``taken`` (at most 5) are expressions of
    conv_id. A lender that is missing lends nothing, one with fewer turns all it has. A conversation that
    lends to itself stays as it is. Conversations that are left without a turn have one row, pos 0.
    """
    convs = turns.groupBy("conv_id").agg(F.max("length").alias("own")).withColumns({"lender": lender, "taken": taken.cast("int")})
    heads = turns.where("pos <= 5").groupBy(F.col("conv_id").alias("lender")).agg(F.sort_array(F.collect_list(F.struct("pos", "turn"))).alias("head"))
    lent = F.slice(F.coalesce(F.col("head.turn"), F.array().cast("array<string>")), 1, F.col("taken"))
    joined = convs.join(heads, "lender", "left").withColumn("lent", F.when(F.col("lender") == F.col("conv_id"), F.slice(F.col("head.turn"), 1, F.col("taken"))).otherwise(lent))
    n = F.size("lent")
    joined = joined.select("conv_id", "taken", "lent", (n + F.greatest(F.col("own") - F.col("taken"), F.lit(0))).alias("length"))
    joined = materialize(joined, "conversations")
    rest = turns.where(F.col("pos") > taken).select("conv_id", "pos", "turn")
    kept = rest.join(joined.select("conv_id", "taken", n.alias("n"), "length"), "conv_id")
    kept = kept.select("conv_id", (F.col("pos") - F.col("taken") + F.col("n")).alias("pos"), "turn", "length")
    borrowed = joined.where(n > 0).select("conv_id", "length", F.posexplode("lent").alias("at", "turn"))
    borrowed = borrowed.select("conv_id", (F.col("at") + 1).cast("long").alias("pos"), "turn", "length")
    empty = joined.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("turn"), "length")
    return kept.unionByName(borrowed).unionByName(empty)


@dataclass(frozen=True)
class _Blocks:
    width: int

    @property
    def slots(self) -> list[str]:
        return [f"t{i}" for i in range(1, self.width + 1)]

    def path(self, upto: Column | None = None) -> Column:
        turns = F.array(*self.slots)
        return F.md5(F.concat_ws(" ", turns if upto is None else F.slice(turns, F.lit(1), upto)))

    def cut(self, turns: DataFrame) -> DataFrame:
        """One row per conversation and block: its turns in columns, their number, the conversation's length."""
        block = F.floor((F.col("pos") - 1) / self.width).cast("int")
        slot = (F.col("pos") - 1) % self.width
        columns = [F.max(F.when(slot == i, F.col("turn"))).alias(name) for i, name in enumerate(self.slots)]
        return turns.where("pos > 0").groupBy("conv_id", block.alias("block")).agg(*columns, F.count("*").alias("filled"), F.max("length").alias("length"))

    def rolled(self, rows: DataFrame, by: str, sums: str) -> DataFrame:
        """All prefixes of the blocks in ``rows``; ``k`` is a prefix's number of turns in its block."""
        names = ", ".join(self.slots)
        found = rows.sparkSession.sql(
            f"SELECT {by}, {names}, {self.width} - bit_count(grouping_id()) AS k, count(*) AS n_convs, min(conv_id) AS conv_id, {sums} "
            f"FROM {{rows}} GROUP BY {by}, ROLLUP({names})",
            rows=rows,
        )
        # A conversation that ended before k is no member at k.
        return found.where((F.col("k") > 0) & F.get(F.array(*self.slots), F.col("k") - 1).isNotNull())


def prefix_trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per distinct sequence of first turns; see the module's text.

    ``turns`` has conv_id, pos (from 1), turn (ids of ``turn_id``) and length; a row with pos 0 stands for
    a conversation without turns. Columns: conv_id (smallest member), depth, parent_conv_id (NULL for
    the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. No conversations, no rows.
    Two turns are equal if their ids are: 128 bits of md5 and the length.
    """
    spark, blocks = turns.sparkSession, _Blocks(width)
    turns = materialize(turns, "turns")
    members = turns.agg(F.count_distinct("conv_id").alias("n"), F.min("conv_id").alias("least")).first()
    if not members["n"]:
        return _empty(spark)
    cut = materialize(blocks.cut(turns).sortWithinPartitions("block"), "blocks")
    rows = cut.where("block = 0").withColumn("at", F.lit(members["least"]))
    all_rows, all_nodes, all_stops = [], [], []
    depth = 0
    while True:
        if depth:
            rows = materialize(rows, "rows")
        nodes = materialize(_block_nodes(blocks, rows, depth), "nodes")
        stops = materialize(_stops(blocks, rows, nodes, depth + width), "stops")
        all_rows.append(rows.withColumn("block", F.lit(depth // width)))
        all_nodes.append(nodes)
        all_stops.append(stops)
        going = stops.where("more AND NOT alone").select("conv_id", F.col("node").alias("at"))
        if going.isEmpty():
            break
        depth += width
        rows = cut.where(F.col("block") == depth // width).join(going, "conv_id")
    nodes, stops, rows = (_union(tables) for tables in (all_nodes, all_stops, all_rows))
    shared = _with_subtrees(blocks, nodes, stops, rows)
    paths = _paths(nodes, stops)
    totals = nodes.agg(
        F.count_if(F.col("depth") == 1).alias("children"), F.sum(F.col("leaf").cast("long")).alias("leaves"), F.sum(_saved()).alias("saved")
    ).first()
    beyond = stops.where("more AND alone").count()  # each such conversation ends in a leaf of its own
    root = spark.range(1).select(
        F.lit(members["least"]).alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(members["n"]).cast("long").alias("n_convs"),
        F.lit(totals["children"]).cast("long").alias("n_children"),
        F.lit(max((totals["leaves"] or 0) + beyond, 1)).cast("long").alias("n_leaves"),
        F.lit(totals["saved"] or 0).cast("long").alias("saved_tokens"),
    )
    without = turns.where("pos = 0").select("conv_id", F.lit(members["least"]).alias("node"), F.lit(0).cast("long").alias("depth"))
    ending = stops.where("NOT more AND NOT alone").select("conv_id", "node", "depth").unionByName(without)
    digests = ends_digests(ending)
    several = shared.unionByName(root).join(digests, ["conv_id", "depth"], "left")
    several = several.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    return several.unionByName(paths)


def _empty(spark) -> DataFrame:
    longs = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    return spark.createDataFrame([], f"{longs}, ends_sha256 string")


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def _saved() -> Column:
    return (F.col("n_convs") - 1) * F.col("chars")


def _block_nodes(blocks: _Blocks, rows: DataFrame, depth: int) -> DataFrame:
    """The nodes of one block with their parents."""
    last = F.get(F.array(*blocks.slots), F.col("k") - 1)
    found = blocks.rolled(rows, "at", "max(length) AS longest").select(
        "at",
        "k",
        blocks.path().alias("path"),
        blocks.path(F.col("k") - 1).alias("before"),
        (F.lit(depth) + F.col("k")).cast("long").alias("depth"),
        "conv_id",
        "n_convs",
        F.substring(last, _DIGEST + 1, 20).cast("long").alias("chars"),
        (F.col("longest") == F.lit(depth) + F.col("k")).alias("leaf"),
    )
    found = materialize(found, "prefixes")
    above = found.where("n_convs > 1").select("at", F.col("path").alias("before"), F.col("conv_id").alias("above"))
    first = found.where("k = 1").withColumn("above", F.col("at"))
    deeper = found.where("k > 1").join(above, ["at", "before"], "left")
    return first.unionByName(deeper).select(
        "at", "path", "depth", "conv_id", "n_convs", "chars", "leaf",
        F.coalesce("above", "conv_id").alias("parent_conv_id"),
        F.col("above").isNotNull().alias("under_several"),
    )


def _stops(blocks: _Blocks, rows: DataFrame, nodes: DataFrame, end: int) -> DataFrame:
    """The node that each conversation reaches in the block, and whether it is alone there."""
    several = nodes.where("n_convs > 1").select("at", "path", F.col("conv_id").alias("node"))
    reached = rows.select("conv_id", "at", blocks.path().alias("path"), "length", (F.col("length") > end).alias("more"))
    joined = reached.join(several, ["at", "path"], "left")
    return joined.select(
        "conv_id",
        F.coalesce("node", "conv_id").alias("node"),
        F.col("node").isNull().alias("alone"),
        "more",
        "length",
        F.least("length", F.lit(end)).cast("long").alias("depth"),
    )


def _with_subtrees(blocks: _Blocks, nodes: DataFrame, stops: DataFrame, rows: DataFrame) -> DataFrame:
    """Nodes with several members: children, and sums over their subtrees by the second ROLLUP."""
    several = nodes.where("n_convs > 1").withColumn("saved", _saved())
    own = several.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum(F.col("leaf").cast("long")).alias("leaves"))
    ended = stops.where("alone OR NOT more")
    weights = ended.join(own, "conv_id", "left").select(
        "conv_id", F.coalesce("saved", F.lit(0)).alias("saved"), (F.coalesce("leaves", F.lit(0)) + F.col("alone").cast("long")).alias("leaves")
    )
    weighed = rows.select("conv_id", "block", "at", *blocks.slots).join(weights, "conv_id")
    sums = blocks.rolled(weighed, "block, at", "sum(saved) AS saved_all, sum(leaves) AS n_leaves").where("n_convs > 1")
    sums = sums.select("conv_id", (F.col("block") * blocks.width + F.col("k")).cast("long").alias("depth"), "saved_all", "n_leaves")
    above = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    children = nodes.where("under_several").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    topped = several.withColumn("saved_above", F.coalesce(F.sum("saved").over(above), F.lit(0)))
    joined = topped.join(sums, ["conv_id", "depth"]).join(children, ["conv_id", "depth"], "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", (F.col("saved_all") - F.col("saved_above")).alias("saved_tokens"),
    )


def _paths(nodes: DataFrame, stops: DataFrame) -> DataFrame:
    """Nodes with one member: those counted in blocks, and one for each turn beyond."""
    lone = nodes.where("n_convs = 1").select("conv_id", "depth", "parent_conv_id", "leaf")
    further = stops.where("more AND alone").select("conv_id", "length", F.explode(F.sequence(F.col("depth") + 1, F.col("length"))).alias("depth"))
    further = further.select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), (F.col("depth") == F.col("length")).alias("leaf"))
    end = F.when(F.col("leaf"), F.col("conv_id").cast("string")).otherwise(F.lit(""))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return lone.unionByName(further).select(
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"), (one - F.col("leaf").cast("long")).alias("n_children"),
        one.alias("n_leaves"), none.alias("saved_tokens"), F.sha2(end, 256).alias("ends_sha256"),
    )


def ends_digests(ends: DataFrame) -> DataFrame:
    """``(conv_id, depth, ends_sha256)`` of nodes: SHA-256 of the ids of conversations that end there.

    A node may be the end of most conversations. Its ids are ordered by range partitions, which write
    them as texts of up to ``_PIECE`` ids; one task then takes a node's texts in order, one at a time.
    """
    order = ["node", "depth", "conv_id"]
    # The id orders last, so that the ids of one node are cut between partitions too.
    ranged = ends.select(*order).repartitionByRange(parts(ends.sparkSession), *order).sortWithinPartitions(*order)
    pieces = map_arrow(ranged, _joined_ids, "node long, depth long, first long, ids string")
    placed = pieces.repartition(parts(ends.sparkSession), "node", "depth").sortWithinPartitions("node", "depth", "first")
    return map_arrow(placed, _hashed, "conv_id long, depth long, ends_sha256 string")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, ids = None, []
    out: list[tuple] = []
    for batch in batches:
        for node, depth, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if (node, depth) != key or len(ids) >= _PIECE:
                if ids:
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids = (node, depth), []
            ids.append(conv_id)
            if len(out) >= 1024:
                yield _rows(out, ("node", "depth", "first", "ids"))
                out = []
    if ids:
        out.append((*key, ids[0], ",".join(map(str, ids))))
    if out:
        yield _rows(out, ("node", "depth", "first", "ids"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    out: list[tuple] = []
    for batch in batches:
        for node, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (node, depth) == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((*key, state.hexdigest()))
            key, state = (node, depth), hashlib.sha256(ids.encode())
    if key is not None:
        out.append((*key, state.hexdigest()))
    if out:
        yield _rows(out, ("conv_id", "depth", "ends_sha256"))


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=list(names))


_CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
  lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""


def trie_sql() -> str:
    """DuckDB's form of the query: prefixes as lists of turns, subtrees by joining each node to its prefixes."""
    return f"""WITH given AS (SELECT conv_id, turn, {{'role': COALESCE(role, ''), 'text': COALESCE(text, '')}} AS said FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY turn NULLS FIRST, md5(concat(length(said.role), ':', said.role, said.text))) AS turns, {_CRC32} % 6 AS h FROM given GROUP BY conv_id),
rebuilt AS (SELECT o.conv_id, CASE WHEN o.conv_id % 100 = 0 THEN o.turns ELSE COALESCE(b.turns[:o.h], []) || o.turns[o.h + 1:] END AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
prefixes AS (SELECT conv_id, CAST(unnest(range(len(turns) + 1)) AS BIGINT) AS depth, turns FROM rebuilt),
members AS (SELECT conv_id, depth, turns[:depth] AS path, len(turns) = depth AS ends FROM prefixes),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM members GROUP BY path, depth),
linked AS (SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]),
counted AS (SELECT n.*, (SELECT count(*) FROM linked c WHERE c.depth = n.depth + 1 AND c.parent_conv_id = n.conv_id) AS n_children FROM linked n),
below AS (SELECT conv_id, CAST(unnest(range(depth + 1)) AS BIGINT) AS top, path, n_children = 0 AS leaf, CASE WHEN depth > 0 THEN (n_convs - 1) * length(path[depth].text) ELSE 0 END AS saved FROM counted),
sums AS (SELECT path[:top] AS path, CAST(sum(CAST(leaf AS INT)) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM below GROUP BY path[:top])
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256 FROM counted c JOIN sums s ON s.path = c.path"""
