"""Prefix trie of conversations, by smallest-member ownership.

Each node belongs to its smallest member, so a conversation owns a suffix of its path (going down,
members only get fewer).  Windows mark the owned nodes; from them each conversation knows where its
own suffix begins, and one group-by over (conversation, prefix) rows gives every node its subtree:
what its members say below it, less what they own (so that each distinct node counts once), its
children (each has one owner) and its leaves (so has each leaf).

No step sees a large group whole.  A node that many conversations pass is cut by ranges of conv_id,
windows run inside those and then over one row a range, and a join on (node, range) brings the owner
back.  A long conversation is cut by ranges of turns: ordinals, sums of bytes and prefix keys are made
inside a range and carried on over one row a range.  The digest of the conversations that end in a node
is one chain over sorted ids by its nature; ids come to it joined in blocks of up to 1,024.

Turns are compared by role and text through SHA-256 (128 bits), prefixes by 128 bits of a chain of these.
Null roles and texts are empty.  Order is by turn, nulls first; rows of one turn come by role, then by
the SHA-256 of role and text, so that texts are not shuffled; repeated rows are turns of their own.
Rows without conv_id are left out.  c % 5 keeps the sign of c, as in SQL.  Other columns are not read.
An empty table has no root, so gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import stored

#: Turns in a range of a conversation, and ids in a range of a node's members.
TURNS = 64
MEMBERS = 256
END_BLOCK = 1024
FAMILY = 5
SHARED = 9


def digest(*parts: str | Column) -> Column:
    """128 bits of the SHA-256 of strings or binaries, as binary."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, ord, said, n_bytes) of every row, and (conv_id, n_turns) of every conversation.

    ``said`` stands for role and text, the role's length being part of what is hashed.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.col("turn").cast("long")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"), digest(F.char_length(role).cast("string"), F.lit(":"), role, text).alias("said"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.coalesce(F.floor(turn / TURNS), F.lit(-(1 << 62))).alias("part"),
    )
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "said")
    rows = rows.withColumn("at", F.row_number().over(inside))
    parts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    parts = parts.withColumn("before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n"))
    turns = stored(rows.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("before")).cast("long").alias("ord"), "said", "n_bytes"))
    return turns, turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))


def rebuilt(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, said, n_bytes) of the rebuilt conversations, and (conv_id, len) of each, turnless ones too.

    The first h turns come from conversation c - c % 5, the rest are c's own after its first h, where h is CRC-32 of c's
    decimal form modulo 9.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    head = sizes.select(F.col("conv_id").alias("head"), F.col("n_turns").alias("head_turns"))
    plan = sizes.withColumns({"h": h, "head": F.col("conv_id") - F.col("conv_id") % FAMILY}).join(head, "head", "left")
    plan = plan.withColumns({"taken": F.least("h", F.coalesce("head_turns", F.lit(0))), "own": F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))})
    lengths = plan.select("conv_id", "h", "taken", (F.col("taken") + F.col("own")).alias("len"))
    # every conversation's rows meet their h by range of turns, so that a long one is not one group
    spread = lengths.select("conv_id", "h", "taken", F.explode(F.sequence(F.lit(0), F.floor((F.col("len") + SHARED) / TURNS))).alias("range"))
    own = turns.withColumn("range", F.floor(F.col("ord") / TURNS)).join(spread, ["conv_id", "range"]).where(F.col("ord") > F.col("h"))
    own = own.select("conv_id", (F.col("taken") + F.col("ord") - F.col("h")).alias("depth"), "said", "n_bytes")
    first = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("ord") < SHARED))
    kin = F.array(*(F.try_add(F.col("conv_id"), F.lit(k)) for k in range(1 - FAMILY, FAMILY)))
    first = first.select(F.col("conv_id").alias("head"), F.explode(kin).alias("conv_id"), "ord", "said", "n_bytes").where(F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("head"))
    first = first.join(lengths, "conv_id").where(F.col("ord") <= F.col("h")).select("conv_id", F.col("ord").alias("depth"), "said", "n_bytes")
    return own.unionByName(first), lengths.select("conv_id", "len")


def chained(ranges: DataFrame) -> DataFrame:
    """(conv_id, range, prefix): for each full range of turns, the key of all turns up to its end, handed to the next range.

    One row a range of 64 turns passes, sorted, with one hash held for the conversation at hand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, key = None, b""
        for batch in batches:
            out = []
            for c, said in zip(batch.column("conv_id").to_pylist(), batch.column("inner").to_pylist(), strict=True):
                conv, key = c, hashlib.sha256((key if c == conv else b"") + said).digest()[:16]
                out.append(key)
            yield pa.record_batch([batch.column("conv_id"), pa.array([r + 1 for r in batch.column("range").to_pylist()], pa.int64()), pa.array(out, pa.binary())], names=["conv_id", "range", "prefix"])

    return ranges.repartition("conv_id").sortWithinPartitions("conv_id", "range").mapInArrow(run, "conv_id long, range long, prefix binary")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, key, n_bytes, upto, len): a row for every conversation and prefix of it, from the empty one.

    ``key`` stands for the prefix, ``upto`` is the sum of bytes of its turns.
    """
    rows = turns.withColumn("range", F.floor((F.col("depth") - 1) / TURNS))
    inside = Window.partitionBy("conv_id", "range").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"inner": F.sha2(F.array_join(F.transform(F.collect_list("said").over(inside), F.hex), ""), 256), "within": F.sum("n_bytes").over(inside)})
    full = rows.where(F.col("depth") % TURNS == 0).select("conv_id", "range", F.unhex("inner").alias("inner"), "within")
    carried = full.withColumns({"range": F.col("range") + 1, "before": F.sum("within").over(Window.partitionBy("conv_id").orderBy("range"))}).select("conv_id", "range", "before")
    later = chained(full.select("conv_id", "range", "inner")).join(carried, ["conv_id", "range"])
    rows = rows.join(later, ["conv_id", "range"], "left")
    key = digest(F.coalesce(F.hex("prefix"), F.lit("")), F.lit(":"), F.col("inner"), F.lit(":"), F.col("depth").cast("string"))
    spread = lengths.select("conv_id", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("len") - 1, F.lit(0)) / TURNS))).alias("range"))
    out = rows.join(spread, ["conv_id", "range"]).select("conv_id", "depth", key.alias("key"), "n_bytes", (F.col("within") + F.coalesce("before", F.lit(0))).alias("upto"), "len")
    zero = F.lit(0).cast("long")
    return out.unionByName(lengths.select("conv_id", zero.alias("depth"), F.lit(b"").alias("key"), zero.alias("n_bytes"), zero.alias("upto"), "len"))


def owners(paths: DataFrame) -> DataFrame:
    """The rows of ``prefixes`` with ``owner``, the node's smallest member, and ``deepest``, the longest member's length."""
    part = F.floor(F.col("conv_id") / MEMBERS)
    rows = paths.withColumn("part", part)
    inside, over = Window.partitionBy("key", "part"), Window.partitionBy("key")
    first = rows.withColumns({"least": F.min("conv_id").over(inside), "most": F.max("len").over(inside)}).where(F.col("least") == F.col("conv_id"))
    found = first.select("key", "part", F.min("least").over(over).alias("owner"), F.max("most").over(over).alias("deepest"))
    return rows.join(found, ["key", "part"]).drop("part")


def suffixes(owned: DataFrame) -> DataFrame:
    """(conv_id, from_depth, spoken, above, ends_leaf): where a conversation's own nodes begin, the bytes before that, the owner of
    the node above, and whether it owns a leaf."""
    mine, strange = F.col("owner") == F.col("conv_id"), F.col("owner") != F.col("conv_id")
    facts = owned.groupBy("conv_id").agg(
        F.coalesce(F.min(F.when(mine, F.col("depth"))), F.max("len") + 1).alias("from_depth"), F.coalesce(F.max(F.when(strange, F.col("upto"))), F.lit(0)).alias("spoken"),
        F.max_by(F.when(strange, F.col("owner")), F.when(strange, F.col("depth"))).alias("above"), F.max(F.when(mine & (F.col("depth") == F.col("len")) & (F.col("deepest") == F.col("len")), 1).otherwise(0)).alias("ends_leaf"), F.max("len").alias("len"),
    )
    return facts.withColumn("range", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("len") / TURNS)))).drop("len")


def end_digests(paths: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of the sorted ids of the conversations that end in a node, for nodes where any does.

    Ids are sorted and joined in blocks first; what runs in order over a node's blocks holds one hash.
    """
    block = F.floor(F.col("conv_id") / END_BLOCK)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = paths.where(F.col("depth") == F.col("len")).groupBy("key", block.alias("block")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chain, done = None, None, []
        for batch in batches:
            for k, some in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if chain is not None and k == key:
                    chain.update(b"," + some.encode())
                    continue
                if chain is not None:
                    done.append((key, chain.hexdigest()))
                key, chain = k, hashlib.sha256(some.encode())
            yield _pairs(done)
            done = []
        yield _pairs(done + ([(key, chain.hexdigest())] if chain is not None else []))

    return blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInArrow(run, "key binary, ends_sha256 string")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([k for k, _ in rows], pa.binary()), pa.array([v for _, v in rows], pa.string())], names=["key", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row a node."""
    paths = stored(prefixes(*rebuilt(*ordered_turns(conversations))))
    owned = owners(paths)
    rows = paths.withColumn("range", F.floor(F.col("depth") / TURNS)).join(suffixes(owned), ["conv_id", "range"])
    depth, begins = F.col("depth"), F.col("from_depth")
    # bytes that the member says from this node on, less those it owns from here on
    extra = F.when(depth < begins, F.col("spoken") - F.col("upto") + F.col("n_bytes")).otherwise(0)
    parent = F.when(depth > begins, F.col("conv_id")).when((depth == begins) & (depth > 0), F.col("above"))
    nodes = rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.max(parent).alias("parent_conv_id"), F.count("*").alias("n_convs"),
        F.sum(F.when((depth + 1 >= begins) & (depth < F.col("len")), 1).otherwise(0)).alias("n_children"), F.sum("ends_leaf").cast("long").alias("n_leaves"), F.sum(extra).alias("saved_tokens"),
    )
    ends = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return nodes.join(end_digests(paths), "key", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends.alias("ends_sha256"))
