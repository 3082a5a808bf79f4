"""Prefix trie of conversations by fixed-length block hashing.

A conversation's turns are cut into blocks of ``BLOCK`` turns.  Conversations are grouped by the blocks
they begin with: a block's group is the digest of all blocks before it (``p``) and its own (``d``).  Where
all conversations that go on after a prefix have the same next block, its turns are nodes as they
stand; only where sibling blocks diverge are the turns inside compared, and there once for each different block,
not once for each conversation.

Every node is named by its smallest conversation, so a conversation c is the name of the lower end of its own
path.  With u(c) the characters of those turns, c adds max(0, characters from the node's turn to the
end of c, less u(c)) to what sharing saves below a node; leaves are counted at the conversations that name them.
So sums over subtrees are sums over members, and the number of rounds does not follow the depth.

Scale: a turn's text is hashed once where it is read; later steps carry digests of 16 bytes.  Turns and
blocks are numbered and summed along a conversation by dealt ranges (``common.ranged``): a conversation with a third of
all turns is dealt like any other.  A prefix digest is a sum of block digests in eight lanes of 32 bits, each
block hashed with its place, so it needs no sequential scan.  Groups of copies are counted by map-side partials.
Children meet their parent by a join, those of large parents by a broadcast of at most ``LARGE_PARENTS`` rows.
The digest of a node's ended conversations is by definition one sequential hash: their ids are sorted by
ranges, joined into pieces of ``PIECE_IDS`` ids, and the pieces streamed through the hash.

Defined cases: turns go by ``turn``, null first, equal ones by their digest; null role or text is empty; equal
rows are turns each by itself; a row without conversation id belongs to no conversation and is left out; texts of any
length are hashed whole; a conversation without turns is a member of the root only; other columns are
not read; an empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import earlier_ranges, numbered, ranged, written

BLOCK = 4                # turns in a block
LANES = 8                # of 32 bits in a prefix digest
LARGE_PARENTS = 10_000   # parents whose children are joined by broadcast, at most
PIECE_IDS = 8192


def short(*parts: Column) -> Column:
    """128 bits of SHA-256, as hex."""
    return F.substring(F.sha2(F.concat_ws(":", *parts).cast("binary"), 256), 1, 32)


def prefix_key(lanes: list[Column]) -> Column:
    return short(*[x.cast("string") for x in lanes])


#: Key of the root, the prefix of no block.
ROOT = hashlib.sha256(":".join("0" * LANES).encode()).hexdigest()[:32]


def turn_rows(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv, at, digest, chars), written: each turn's place from 0, the digest of role and text, and the text's length."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    narrow = conversations.select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                                  short(F.octet_length(role).cast("string"), F.concat(role, text)).alias("digest"),
                                  F.length(text).cast("long").alias("chars")).where("conv IS NOT NULL")
    rows = numbered(written(narrow, "trie-turns"), ["conv"], ["turn", "digest"], "trie-turns")
    return written(rows.select("conv", "at", "digest", "chars"), "trie-turns")


def blocks(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written (conv, blk, t, p, d, next, chars_on, last, _range) of each block, and (conv, _range) with no hot key.

    ``t`` holds the block's (digest, chars); ``p`` and ``next`` are the keys of the prefixes before and after it,
    ``chars_on`` the characters from its start to the end of the conversation.
    """
    turn = F.struct((F.col("at") % BLOCK).alias("i"), "digest", "chars")
    cut = turns.groupBy("conv", F.floor(F.col("at") / BLOCK).alias("blk")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    own = F.sha2(F.concat_ws(":", F.col("blk").cast("string"), F.array_join(F.col("t.digest"), ":")).cast("binary"), 256)
    names = [f"l{k}" for k in range(LANES)]
    cut = written(cut.withColumn("full", own).withColumns(
        {f"l{k}": F.conv(F.substring("full", 8 * k + 1, 8), 16, 10).cast("long") for k in range(LANES)}
        | {"c": F.aggregate("t", F.lit(0).cast("long"), lambda n, x: n + x["chars"])}), "trie-cut")
    placed = ranged(cut, ["conv", "blk"], "trie-ranges")
    sums = placed.groupBy("conv", "_range").agg(*[F.sum(x).alias(x) for x in [*names, "c"]], F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv")
    starts = written(sums.select("conv", "_range", *[earlier_ranges(x, ["conv"]).alias(f"before_{x}") for x in [*names, "c"]],
                                 F.sum("c").over(whole).alias("chars"), F.sum("n").over(whole).alias("blocks")), "trie-starts")
    upto = Window.partitionBy("conv", "_range").orderBy("blk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = placed.withColumns({f"upto_{x}": F.sum(x).over(upto) for x in [*names, "c"]}).join(starts, ["conv", "_range"])
    after = [F.col(f"before_{x}") + F.col(f"upto_{x}") for x in names]
    out = run.select("conv", "_range", "blk", F.transform("t", lambda x: F.struct(x["digest"], x["chars"])).alias("t"),
                     prefix_key([a - F.col(x) for a, x in zip(after, names, strict=True)]).alias("p"),
                     F.substring("full", 1, 32).alias("d"), prefix_key(after).alias("next"),
                     (F.col("chars") - F.col("before_c") - F.col("upto_c") + F.col("c")).alias("chars_on"),
                     (F.col("blk") == F.col("blocks") - 1).alias("last"))
    return written(out, "trie-blocks"), starts.select("conv", "_range")


def node_key(j: Column) -> Column:
    """Key of the node of the first ``j`` turns of a block (p, next, t); the whole of a full block is the next prefix."""
    inner = short(F.col("p"), F.array_join(F.slice(F.col("t.digest"), F.lit(1), j), ":"))
    return F.when(j == 0, F.col("p")).when(j == BLOCK, F.col("next")).otherwise(inner)


def kinds(cut: DataFrame) -> DataFrame:
    """Each different block after each prefix, written, with how many conversations have it and the smallest of them.

    ``lone`` tells that no sibling block stands beside it.
    """
    counts = cut.groupBy("p", "d").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"))
    one = written(cut.select("p", "d", "conv", "blk", "t", "next").join(counts, ["p", "d", "conv"]), "trie-kinds")
    single = (one.groupBy("p").agg(F.min("d").alias("d"), F.max("d").alias("_d")).where("d = _d")
              .select("p", "d", F.lit(True).alias("lone")))
    return written(one.join(single, ["p", "d"], "left").withColumn("lone", F.col("lone").isNotNull()), "trie-kinds")


def by_turn(kind: DataFrame, values: dict[str, Column], merge: dict) -> DataFrame:
    """One row for each node of the blocks: ``values`` (over j, the turn's number from 1), merged where siblings diverge."""
    rows = kind.withColumn("j", F.explode(F.sequence(F.lit(1), F.size("t"))))
    rows = rows.select("lone", node_key(F.col("j")).alias("key"), *[c.alias(k) for k, c in values.items()])
    shared = rows.where(~F.col("lone")).groupBy("key").agg(*[f(k).alias(k) for k, f in merge.items()])
    return rows.where("lone").select("key", *values).unionByName(shared)


def ended(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv): SHA-256 of each node's ids, ascending and joined by commas."""
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, own in b.groupby("key", sort=True):
                ids = own["conv"].tolist()
                rows += [(key, int(own["_place"].iloc[k]), ",".join(map(str, ids[k:k + PIECE_IDS]))) for k in range(0, len(ids), PIECE_IDS)]
            yield pd.DataFrame(rows, columns=["key", "place", "ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, h = None, None
        for b in batches:
            done = []
            for key, ids in zip(b["key"], b["ids"], strict=True):
                if key != now:
                    if h:
                        done.append((now, h.hexdigest()))
                    now, h = key, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["key", "ends_sha256"])
        if h:
            yield pd.DataFrame([(now, h.hexdigest())], columns=["key", "ends_sha256"])

    placed = ranged(written(ends, "trie-ends"), ["key", "conv"], "trie-ends")
    pieces = placed.select("key", "conv", "_place").mapInPandas(join, "key string, place long, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "place").mapInPandas(digest, "key string, ends_sha256 string")


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` (key, parent, conv, n_children, ...) with ``parent_conv``, the name of the parent."""
    least = max(1000, -(-nodes.count() // LARGE_PARENTS))  # so many nodes have at most LARGE_PARENTS parents with more children
    named = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"), "n_children")
    large = named.where(F.col("n_children") > least).drop("n_children")
    tagged = nodes.join(F.broadcast(large), "parent", "left")
    rest = named.where(F.col("n_children") <= least).drop("n_children")
    return tagged.where("parent_conv IS NOT NULL").unionByName(
        tagged.where("parent_conv IS NULL").drop("parent_conv").join(rest, "parent", "left").select(*tagged.columns))


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """(key, parent, depth, conv, parent_conv, n_convs, n_children, n_leaves, saved, ends_sha256) of each node.

    ``turns`` is a written table (conv, at, digest, chars), ``at`` gapless from 0; ``members`` (conv) has every conversation once,
    also those without turns.  ``conv`` is the smallest member; ``saved`` the characters that sharing saves in the subtree.
    """
    cut, ranges = blocks(turns)
    kind = kinds(cut)
    depth = (F.col("blk") * BLOCK + F.col("j")).cast("long")
    inner = by_turn(kind, {"parent": node_key(F.col("j") - 1), "depth": depth, "conv": F.col("conv"), "n_convs": F.col("n_convs"),
                           "chars": F.get(F.col("t.chars"), F.col("j") - 1)},
                    {"parent": F.min, "depth": F.min, "conv": F.min, "n_convs": F.sum, "chars": F.min})
    top = (members.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
           .select(F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
                   "conv", "n_convs", F.lit(0).cast("long").alias("chars")))
    plain = written(inner.unionByName(top), "trie-nodes")
    below = plain.where("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(plain.join(below, "key", "left").fillna(0, ["n_children"]), "trie-nodes")

    # what a conversation names: characters, and whether its end is a leaf
    named = nodes.where("depth > 0").groupBy("conv").agg(
        F.sum("chars").alias("u"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    owned = ranges.join(named, "conv", "left").fillna(0, ["u", "leaf"])
    on = [F.greatest(F.col("chars_on") - F.col("u") - sum((F.coalesce(F.get("t.chars", F.lit(i)), F.lit(0)) for i in range(k)), F.lit(0)),
                     F.lit(0)) for k in range(BLOCK)]
    shared = cut.join(owned, ["conv", "_range"]).groupBy("p", "d").agg(
        F.sum("leaf").alias("n_leaves"), *[F.sum(x).alias(f"s{k}") for k, x in enumerate(on)])
    shared = written(kind.select("p", "d", "t", "next", "lone").join(shared, ["p", "d"]), "trie-shared")
    values = {"n_leaves": F.col("n_leaves"), "saved": F.array(*[f"s{k}" for k in range(BLOCK)])[F.col("j") - 1]}
    sums = by_turn(shared, values, dict.fromkeys(values, F.sum)).unionByName(
        shared.where(F.col("p") == ROOT).groupBy(F.col("p").alias("key")).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("s0").alias("saved")))

    ends = cut.where("last").select(node_key(F.size("t")).alias("key"), "conv").unionByName(
        members.join(turns.where("at = 0"), "conv", "left_anti").select(F.lit(ROOT).alias("key"), "conv"))
    out = with_parents(nodes).join(sums, "key", "left").join(ended(ends), "key", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("key", "parent", "depth", "conv", "parent_conv", "n_convs", "n_children",
                      F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
                      F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
