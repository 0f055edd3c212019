"""Prefix trie of conversations by prefix-doubling names.

Equal turns (role and text) get the same dense name. Blocks of 2, 4, 8, ... turns that start at multiples of their size are
named by the names of their halves, a join round for each size. The prefix of d turns is the prefix without d's last binary
digit, followed by one block, so that prefixes are named in as many rounds again, largest blocks first. Two prefixes of d
turns are equal exactly where their names are: a node of the trie is a group of rows with one depth and name. No text or
sequence is compared, and no conversation is held whole by a task; turns go on as SHA-256 digests, lengths and names.

What a node's subtree holds comes from sums along each conversation, from a depth to its end. A node counts for one of its
members only, the smallest, so that sums over the members of a node are sums over its subtree.

A conversation that holds a third of all turns is dealt out: turns are put in order by ranges of (conversation, turn,
digest), sums go over stretches of STRETCH turns and then over the stretches, and all joins are on finer keys, or plain, so
that Spark splits them. Hashes over member lists are fed from blocks of BLOCK ids in order; no list is held whole.

Defined results: null role or text is empty; rows of one conversation with one turn number follow each other by their
digests; repeated rows are turns each; rows without a conv_id are left out; null turn numbers come first; an empty table
gives no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivena.llm._common import discard, numbered, scratch

#: Turns of a stretch, and bits of the ids of a block of members.
STRETCH, BLOCK = 1024, 16


def _named(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """rows, written, with `name` instead of keys: a dense number for each distinct combination of them."""
    names = numbered(rows.select(*keys).distinct(), "name", f"{label}-names")
    out = scratch(rows.join(names, keys).drop(*(k for k in keys if k != "d")), label)
    discard(names)
    return out


def positions(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), n (the conversation's turns), x (the turn's digest) and bytes (of its text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("x"), F.octet_length(text).cast("long").alias("bytes")).where("conv_id is not null")
    # Copies of a row are told apart by where they lay, so that ranges can split them.
    order = ["conv_id", "turn", "x", "copy"]
    rows = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = numbered(rows.drop("copy", "turn"), "at", "turns")
    first = rows.groupBy("conv_id").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    return rows.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("first")).alias("pos"), "n", "x", "bytes")


def rebuild(turns: DataFrame, group: int = 5, choices: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share their beginnings: c gets the first h turns of c - c % group, then its own after its first h;
    h is crc32(c) % choices. turns as of positions(). Returns (turns, conversations), written: conv_id, pos, x, bytes, len;
    and conv_id, len."""
    turns = scratch(turns, "positions")
    convs = turns.groupBy("conv_id").agg(F.first("n").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % group
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % choices
    convs = convs.select("conv_id", "n", base.alias("base"), h.alias("h"))
    convs = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.select("conv_id", "base", "h", taken.alias("taken"), (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("len"))
    convs = scratch(convs, "conversations")
    own = turns.join(convs, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "x", "bytes", "len")
    heads = turns.where((F.col("pos") < choices - 1) & (F.col("conv_id") == base)).select(F.col("conv_id").alias("base"), "pos", "x", "bytes")
    heads = heads.join(convs, "base").where("pos < h").select("conv_id", "pos", "x", "bytes", "len")
    out = scratch(own.unionByName(heads), "rebuilt")
    discard(turns)
    return out, convs.select("conv_id", "len")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, d, name: of each conversation's first d turns (d from 1), equal for equal ones. turns: conv_id, pos, x."""
    longest = turns.agg(F.max("pos")).first()[0]
    if longest is None:
        return turns.select("conv_id", F.col("pos").alias("d"), F.lit(0).cast("long").alias("name"))
    blocks = [_named(turns.select("conv_id", F.col("pos").alias("j"), "x"), ["x"], "turn-names")]
    for k in range(1, (longest + 1).bit_length()):
        half = lambda odd: F.max(F.when(F.col("j") % 2 == odd, F.col("name")))
        pairs = blocks[-1].groupBy("conv_id", F.shiftright("j", 1).alias("j")).agg(half(0).alias("a"), half(1).alias("b")).where("b is not null")
        blocks.append(_named(pairs, ["a", "b"], f"blocks-{k}"))
    known: list[DataFrame] = []
    for k in range(len(blocks) - 1, -1, -1):
        # Depths whose last binary digit is k: the block before them starts where the rest of the depth ends.
        last = blocks[k].where("j % 2 = 0").select("conv_id", F.shiftleft("j", k).alias("rest"), F.col("name").alias("b"))
        rest = None
        for t in known:
            rest = t if rest is None else rest.unionByName(t)
        if rest is None:
            rows = last.withColumn("a", F.lit(0).cast("long"))
        else:
            rest = rest.select("conv_id", F.col("d").alias("rest"), F.col("name").alias("a"))
            rows = last.where("rest > 0").join(rest, ["conv_id", "rest"]).unionByName(last.where("rest = 0").withColumn("a", F.lit(0).cast("long")))
        known.append(_named(rows.select("conv_id", (F.col("rest") + (1 << k)).alias("d"), "a", "b"), ["d", "a", "b"], f"prefixes-{k}"))
    out = known[0]
    for t in known[1:]:
        out = out.unionByName(t)
    out = scratch(out, "prefixes")
    discard(*blocks, *known)
    return out


def _to_the_end(rows: DataFrame, *names: str) -> DataFrame:
    """Each of names summed over a conversation's rows from d to its end: inside stretches, then over those after."""
    rows = rows.withColumn("s", F.shiftright("d", STRETCH.bit_length() - 1))
    ahead = Window.partitionBy("conv_id", "s").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    whole = rows.groupBy("conv_id", "s").agg(*(F.sum(n).alias(n) for n in names))
    later = Window.partitionBy("conv_id").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("conv_id", "s", *(F.coalesce(F.sum(n).over(later), F.lit(0)).alias(f"_{n}") for n in names))
    inside = rows.withColumns({n: F.sum(n).over(ahead) for n in names})
    return inside.join(whole, ["conv_id", "s"]).withColumns({n: F.col(n) + F.col(f"_{n}") for n in names}).drop("s", *(f"_{n}" for n in names))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """d, name, sha256 of the ids of each run of equal (d, name), fed block by block."""

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0][0] for r in rows], pa.int64()), pa.array([r[0][1] for r in rows], pa.int64()), pa.array([r[1].hexdigest() for r in rows], pa.string())], names=["d", "name", "ends_sha256"])

    key, state = None, None
    for batch in batches:
        done = []
        for d, name, ids in zip(*(batch.column(c).to_pylist() for c in ("d", "name", "ids"))):
            if (d, name) == key:
                state.update(b"," + ids.encode())
            else:
                if state:
                    done.append((key, state))
                key, state = (d, name), hashlib.sha256(ids.encode())
        yield out(done)
    if state:
        yield out([(key, state)])


def _ends(members: DataFrame) -> DataFrame:
    """d, name, ends_sha256 of those conversations that end at a node."""
    at = members.where("d = len").groupBy("d", "name", F.shiftright("conv_id", BLOCK).alias("block")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    at = at.repartition("d", "name").sortWithinPartitions("d", "name", "block").select("d", "name", "ids")
    return at.mapInArrow(_hashes, "d long, name long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, pos (from 0, gapless), x (equal for equal turns), bytes, len; convs: conv_id, len, also those without
    turns. Both are read more than once and should be written tables.
    """
    zero = F.lit(0).cast("long")
    named = prefixes(turns)
    rows = named.join(turns.select("conv_id", (F.col("pos") + 1).alias("d"), "bytes", "len"), ["conv_id", "d"])
    rows = rows.unionByName(convs.select("conv_id", zero.alias("d"), zero.alias("name"), zero.alias("bytes"), "len"))
    nodes = rows.groupBy("d", "name").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.count_if(F.col("len") > F.col("d")).alias("on"))
    nodes = scratch(nodes, "nodes")  # written first, so that Spark can split the rows of a node that most conversations share
    is_rep: Column = F.col("conv_id") == F.col("rep")
    members = rows.join(nodes, ["d", "name"])
    members = scratch(members.select("conv_id", "d", "name", "len", "rep", F.when(is_rep, 0).otherwise(F.col("bytes")).cast("long").alias("saved_tokens"), (is_rep & (F.col("on") == 0)).cast("long").alias("n_leaves")), "members")
    sums = _to_the_end(members.select("conv_id", "d", "name", "saved_tokens", "n_leaves"), "saved_tokens", "n_leaves")
    sums = sums.groupBy("d", "name").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    # Each node but the root has one row in `members` that stands for it; its parent is the same conversation's row above.
    above = members.select("conv_id", (F.col("d") + 1).alias("d"), F.col("name").alias("above"), F.col("rep").alias("parent_conv_id"))
    tops = members.where(is_rep & (F.col("d") > 0)).select("conv_id", "d", "name").join(above, ["conv_id", "d"])
    children = tops.groupBy((F.col("d") - 1).alias("d"), F.col("above").alias("name")).agg(F.count("*").alias("n_children"))
    out = sums.join(tops.select("d", "name", "parent_conv_id"), ["d", "name"], "left").join(children, ["d", "name"], "left").join(_ends(members), ["d", "name"], "left")
    return out.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
