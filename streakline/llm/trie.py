"""Conversation prefix trie by ROLLUP over positional turn columns.

Turns are known by a digest of role and text, with the text's length beside it. A conversation
is laid out as rows of ``BLOCK`` turn columns. In the first block one ROLLUP over these columns
aggregates all prefixes together; ``grouping_id`` tells a prefix's length, and a group whose last
column is NULL is no prefix but the end of a shorter conversation. Longer conversations go on in
further blocks, each grouped by the node where the block before ended, which is named by the
digest of its path. A conversation that is alone in its node needs no further ROLLUP: what is left
of it is a chain without branches. So there are as many rounds as the longest *shared* prefix has
blocks, plus one.

Sums over subtrees go back from the last block to the first: a second ROLLUP, over the nodes of a
block, where the nodes of its last column carry what the blocks below them came to.

Nothing is gathered by a hot key: ROLLUP aggregates before it shuffles; joins against a node
deal a crowded node over parts (``_salted``); the ids of conversations that end in one node are
sorted by range, packed into pieces and hashed as a stream.

Defined cases: turns go by ``turn``, null first, turns of one number by their digests; null role
or text is empty; a repeated row is a turn of its own; rows without ``conv_id`` belong to no
conversation and are left out; a conversation that rebuilds to no turn ends in the root; an empty
table gives no rows, not even a root. Texts of any length are only hashed and counted. Only
``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streakline.functions.ordered import row_numbers
from streakline.session import stage

BLOCK = 8
FAMILY, MOST_SHARED = 100, 6
#: Rows of one node, or turns of one conversation, that may meet in one task of a join.
PART_ROWS = 1_000_000
PIECE_BYTES = 1_000_000
ROOT = b""


# --- Turns and the conversations rebuilt from them -------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos`` (from 1), ``id`` (digest and length of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.sha2(framed, 256)).alias("digest"),
        F.char_length(text).cast("bigint").alias("chars"),
    )
    numbered = row_numbers(turns, ["conv_id"], ["turn", "digest"], "pos")
    return numbered.select("conv_id", "pos", F.struct("digest", "chars").alias("id"))


def _by_turn_range(convs: DataFrame, turns: str, part_rows: int = PART_ROWS) -> DataFrame:
    """``convs`` once per ``part_rows`` of its turns, as ``range``: a long conversation is no hot key."""
    last = F.floor(F.col(turns) / part_rows).cast("bigint")
    return convs.withColumn("range", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))


def rebuilt(turns: DataFrame, part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id, length``) and their turns (``conv_id, pos, id``) after the rebuild.

    The first ``h`` turns come from the first conversation of the family of a hundred, ``h`` being
    the checksum of the id modulo 6; the conversation's own turns after its first ``h`` follow.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    heads = (
        turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < MOST_SHARED))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("head"))
        .withColumnRenamed("conv_id", "first")
    )
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    convs = (
        sizes.withColumn("h", shared)
        .withColumn("first", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(heads, "first", "left")
        .withColumn("head", F.filter(F.coalesce("head", F.array()), lambda t: t["pos"] <= F.col("h")))
        .withColumn("taken", F.size("head").cast("bigint"))
        .select("conv_id", "own", "h", "head", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    )
    convs = stage(convs)
    of_first = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.id")
    places = _by_turn_range(convs.where("own > h").select("conv_id", "own", "h", "taken"), "own", part_rows)
    own = (
        turns.withColumn("range", F.floor(F.col("pos") / part_rows).cast("bigint"))
        .join(places, ["conv_id", "range"])
        .where("pos > h")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id")
    )
    return convs.select("conv_id", "length"), stage(of_first.unionByName(own))


# --- Blocks ------------------------------------------------------------------------------


def _columns(block: int) -> list[str]:
    return [f"p{i}" for i in range(1, block + 1)]


def _path(prior: Column, columns: list[str]) -> Column:
    """The name of the node at the end of the turns ``columns``; the prior node itself if there are none."""
    joined = F.concat(prior, *[F.coalesce(F.col(f"{c}.digest"), F.lit(ROOT)) for c in columns])
    return F.when(F.col(columns[0]).isNull(), prior).otherwise(F.unhex(F.sha2(joined, 256)))


def laid_out(turns: DataFrame, block: int) -> DataFrame:
    """One row per conversation and block of turns."""
    at = F.pmod(F.col("pos") - 1, F.lit(block)) + 1
    spread = [F.max(F.when(at == i, F.col("id"))).alias(c) for i, c in enumerate(_columns(block), 1)]
    return turns.groupBy("conv_id", F.floor((F.col("pos") - 1) / block).cast("int").alias("block")).agg(*spread)


def _level(block: int) -> Column:
    """How many of the columns a group of the ROLLUP has."""
    return reduce(lambda found, j: F.when(F.col("gid") == 2 ** (block - j) - 1, j).otherwise(found), range(block + 1), F.lit(-1))


def _at_level(columns: list[str], field: str | None = None) -> Column:
    """The last column of a group."""
    value = lambda c: F.col(f"{c}.{field}") if field else F.col(c)
    return F.coalesce(*[F.when(F.col("level") == i, value(c)) for i, c in enumerate(columns, 1)])


def _rollup(df: DataFrame, columns: list[str], sums: str) -> DataFrame:
    """All prefixes of ``columns`` within each prior node, with ``level``; ends of shorter ones are left out."""
    listed = ", ".join(columns)
    text = f"select prior, {listed}, grouping_id() as gid, {sums} from {{rows}} group by prior, rollup({listed})"
    found = df.sparkSession.sql(text, rows=df).withColumn("level", _level(len(columns)))
    return found.where((F.col("level") == 0) | _at_level(columns, "digest").isNotNull()).drop("gid")


def _salted(many: DataFrame, nodes: DataFrame, key: str, rows: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Join ``many`` with the unique ``key`` of ``nodes``, whose column ``rows`` counts their matches.

    Nodes with more than ``part_rows`` matches, of which there are fewer than all rows over
    ``part_rows``, meet theirs in parts.
    """
    parts = F.ceil(F.col(rows) / part_rows).cast("int")
    crowded = stage(nodes.where(F.col(rows) > part_rows).select(key, parts.alias("parts")))
    dealt = many.join(crowded, key, "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("conv_id"), F.col("parts")).cast("int"), F.lit(0))
    )
    spread = nodes.withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return dealt.join(spread, [key, "part"]).drop("part", "parts")


def _block_nodes(rows: DataFrame, block: int, done: int) -> DataFrame:
    """The nodes of a block, and the prior nodes as level 0; ``rows``: ``conv_id, length, prior, p1...``."""
    columns = _columns(block)
    sums = "min(conv_id) as conv_id, count(1) as n_convs, max(length) as longest"
    nodes = _rollup(rows, columns, sums)
    return stage(
        nodes.withColumn("depth", F.col("level") + done)
        .withColumn("key", _path(F.col("prior"), columns))
        .withColumn("childless", (F.col("longest") == F.col("depth")).cast("bigint"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.coalesce(_at_level(columns, "chars"), F.lit(0)))
    )


def _subtrees(nodes: DataFrame, below: DataFrame, block: int) -> DataFrame:
    """Sums over subtrees for the nodes of a block.

    ``below`` has what hangs under nodes of the last column: ``key, n_children, n_leaves, saved_tokens``.
    """
    columns = _columns(block)
    carried = nodes.where("level > 0").join(
        below.select("key", F.col("n_children").alias("c_children"), F.col("n_leaves").alias("c_leaves"), F.col("saved_tokens").alias("c_saved")),
        "key",
        "left",
    )
    levels = ", ".join(f"count_if(level = {i}) as n{i}" for i in range(1, block + 1))
    sums = f"""min(conv_id) as conv_id, max(n_convs) as n_convs, {levels}, sum(c_children) as c_children,
        sum(childless + coalesce(c_leaves, 0)) as n_leaves, sum(saved + coalesce(c_saved, 0)) as saved_tokens"""
    found = _rollup(carried, columns, sums)
    under = F.coalesce(*[F.when(F.col("level") == i, F.col(f"n{i + 1}")) for i in range(block)])
    return found.withColumn("n_children", F.coalesce(under, "c_children", F.lit(0)))


# --- Ends ----------------------------------------------------------------------------------


def digests_of_ends(ends: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``key, ends_sha256`` of the ascending, comma-joined ids of ``ends`` (``key, conv_id``).

    A digest is one stream of bytes. So the ids are sorted by range, each task packs its own into
    pieces, and a node's pieces pass through one task in order, one at a time.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": [key], "first": [held[0]], "ids": [",".join(map(str, held))]}, schema=packed)

        for b in batches:
            for k, c in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
                if held and (k != key or size >= piece_bytes):
                    yield piece()
                    held, size = [], 0
                key = k
                held.append(c)
                size += 20
        if held:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            done: dict[str, list] = {"key": [], "ends_sha256": []}
            for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if state is not None and k == key:
                    state.update(b",")
                else:
                    if state is not None:
                        done["key"].append(key)
                        done["ends_sha256"].append(state.hexdigest())
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_pydict(done, schema=made)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [state.hexdigest()]}, schema=made)

    packed = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    made = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    ranged = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = ranged.mapInArrow(pack, "key binary, first bigint, ids string")
    in_order = pieces.repartition("key").sortWithinPartitions("key", "first").select("key", "ids")
    return in_order.mapInArrow(digest, "key binary, ends_sha256 string")


# --- The trie ----------------------------------------------------------------------------------

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(convs: DataFrame, turns: DataFrame, block: int = BLOCK, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per distinct prefix of the conversations; ``convs`` has ``conv_id, length``, ``turns`` ``conv_id, pos, id``."""
    columns = _columns(block)
    blocks = stage(laid_out(turns, block))
    rows = stage(
        convs.join(blocks.where("block = 0").drop("block"), "conv_id", "left").withColumn("prior", F.lit(ROOT))
    )
    levels, ends, tails = [], [], []
    while True:
        done = block * len(levels)
        levels.append(_block_nodes(rows, block, done))
        named = rows.withColumn("key", _path(F.col("prior"), columns))
        ends.append(named.where(F.col("length") <= done + block).select("key", "conv_id"))
        going = named.where(F.col("length") > done + block).select("conv_id", "length", F.col("key").alias("prior"))
        full = levels[-1].where(F.col("level") == block).where(F.col("longest") > F.col("depth"))
        met = stage(_salted(going, full.select(F.col("key").alias("prior"), F.col("n_convs").alias("met")), "prior", "met", part_rows))
        tails.append(met.where("met = 1").select("conv_id", "length", F.lit(done + block).cast("bigint").alias("done"), "prior"))
        shared = met.where("met > 1").drop("met")
        rows = stage(shared.join(blocks.where(F.col("block") == len(levels)).drop("block"), "conv_id"))
        if rows.isEmpty():
            break

    # Back from the last block: what hangs under the nodes of a block's last column.
    alone = reduce(DataFrame.unionByName, tails).select(
        F.col("prior").alias("key"), F.lit(1).alias("n_children"), F.lit(1).alias("n_leaves"), F.lit(0).alias("saved_tokens")
    )
    below, summed = alone, []
    for nodes in reversed(levels):
        found = stage(_subtrees(nodes, below, block))
        under = found.where("level = 0").select(F.col("prior").alias("key"), "n_children", "n_leaves", "saved_tokens")
        below = alone.unionByName(under)
        summed.append(found.where("level > 0"))
    top = levels[0].where("level = 0").select(
        "key", F.lit(None).cast("binary").alias("parent"), "conv_id", "depth", "n_convs", "childless"
    )
    root = top.join(below, "key", "left").select(
        "key", "parent", "conv_id", "depth", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("n_leaves", "childless").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
    )
    parts = [root]
    for nth, found in enumerate(reversed(summed)):
        parents = [_path(F.col("prior"), columns[: i - 1]) if i > 1 else F.col("prior") for i in range(1, block + 1)]
        parts.append(
            found.select(
                _path(F.col("prior"), columns).alias("key"),
                F.coalesce(*[F.when(F.col("level") == i, p) for i, p in enumerate(parents, 1)]).alias("parent"),
                "conv_id", (F.col("level") + nth * block).alias("depth"), "n_convs", "n_children", "n_leaves", "saved_tokens",
            )
        )
    nodes = stage(reduce(DataFrame.unionByName, parts))

    known = nodes.where("n_children > 0").select(
        F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("met")
    )
    with_parent = _salted(nodes.where("parent is not null"), known, "parent", "met", part_rows).drop("met")
    placed = with_parent.unionByName(nodes.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    whole = placed.join(digests_of_ends(reduce(DataFrame.unionByName, ends)), "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))
    )
    return _typed(whole).unionByName(_typed(_chains(reduce(DataFrame.unionByName, tails), part_rows)))


def _chains(tails: DataFrame, part_rows: int) -> DataFrame:
    """The nodes of conversations that go on alone: one per turn after ``done``."""
    pieces = tails.withColumn(
        "start", F.explode(F.sequence(F.col("done") + 1, F.col("length"), F.lit(part_rows).cast("bigint")))
    )
    stop = F.least(F.col("length"), F.col("start") + part_rows - 1)
    own = pieces.withColumn("depth", F.explode(F.sequence(F.col("start"), stop)))
    last = F.col("depth") == F.col("length")
    return own.select(
        "conv_id",
        "depth",
        F.col("conv_id").alias("parent_conv_id"),
        F.lit(1).alias("n_convs"),
        F.when(last, 0).otherwise(1).alias("n_children"),
        F.lit(1).alias("n_leaves"),
        F.lit(0).alias("saved_tokens"),
        F.sha2(F.when(last, F.col("conv_id").cast("string")).otherwise(F.lit("")).cast("binary"), 256).alias("ends_sha256"),
    )


def _typed(nodes: DataFrame) -> DataFrame:
    return nodes.select(*[F.col(c).cast("string" if c == "ends_sha256" else "bigint").alias(c) for c in NODE])


def prefix_trie(conversations: DataFrame, block: int = BLOCK, part_rows: int = PART_ROWS) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node."""
    convs, turns = rebuilt(stage(numbered_turns(conversations)), part_rows)
    return trie(convs, turns, block, part_rows)


#: The same rows for DuckDB: conversations as lists of turns, nodes as their distinct heads.
SQL = """
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
        struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS t
    FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
    SELECT conv_id, list(t ORDER BY pos) AS own FROM turns GROUP BY conv_id
), sums AS (
    SELECT conv_id, own, conv_id - conv_id % 100 AS first,
        xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, b: list_reduce(
                list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
            4294967295::BIGINT) % 6 AS h
    FROM lists
), made AS (
    SELECT s.conv_id, list_concat(coalesce(b.own, [])[1:s.h], s.own[s.h + 1:]) AS whole
    FROM sums s LEFT JOIN lists b ON b.conv_id = s.first
), heads AS (
    SELECT conv_id, len(whole) AS length, d, whole[1:d] AS path, whole[1:d - 1] AS above
    FROM (SELECT conv_id, whole, unnest(range(0, len(whole) + 1)) AS d FROM made)
), nodes AS (
    SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(length) AS longest,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE length = d), '') AS ends,
        CASE WHEN d > 0 THEN len(path[d].text) ELSE 0 END AS chars
    FROM heads GROUP BY path, d
), named AS (
    SELECT h.conv_id AS member, h.d AS depth, n.conv_id AS node FROM heads h JOIN nodes n ON n.path = h.path
), ups AS (
    SELECT m.node, m.depth, n.conv_id, n.depth AS below, n.n_convs, n.longest, n.chars
    FROM nodes n JOIN named m ON m.member = n.conv_id AND m.depth <= n.depth
), subtrees AS (
    SELECT node, depth, sum(CASE WHEN longest = below THEN 1 ELSE 0 END) AS n_leaves,
        sum(CASE WHEN below = depth + 1 THEN 1 ELSE 0 END) AS n_children, sum((n_convs - 1) * chars) AS saved_tokens
    FROM ups GROUP BY node, depth
)
SELECT n.conv_id, n.depth, p.node AS parent_conv_id, n.n_convs, CAST(s.n_children AS BIGINT) AS n_children,
    CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN subtrees s ON s.node = n.conv_id AND s.depth = n.depth
LEFT JOIN named p ON p.member = n.conv_id AND p.depth = n.depth - 1
"""
