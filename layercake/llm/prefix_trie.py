"""Prefix trie of conversations by adaptive radix trees.

A turn's id is 16 bytes (the beginning of the SHA-256 of its role and text), so
a conversation is a key of 16 bytes a turn, big end first. Keys are range-
partitioned and sorted with the conversation id as tie-break, so even a
third of all conversations being the same is spread over tasks. Each task
reads its sorted keys in blocks of bounded size and builds one adaptive radix
tree a block: inner nodes hold 4, 16, 48 or 256 children and grow, single-child
paths are compressed, and only byte depths that end a turn emit a node.

A prefix range of sorted keys that lies inside a block is complete. Only nodes
on the paths of a block's first and last key may go on in another block; these
are emitted as partial rows under a hash of their prefix. Counts of partial
rows add up, except where two neighbouring blocks share a path: there
the shared part was counted twice, and one correction row a shared node, made
from the two keys at the boundary, takes it out again. No step goes level by level.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layercake.llm.common import ship
from layercake.session import materialize

#: Bytes of a turn's id.
WIDTH = 16
#: Most keys and bytes of keys in one tree.
BLOCK_KEYS, BLOCK_BYTES = 50_000, 16_000_000
#: Partial nodes that may be broadcast (rows of two hashes and a number).
BROADCAST_ROWS = 500_000
_SALTS = 32
_WORD = r"[^\x20\x09-\x0D]+"


# --- the tree -----------------------------------------------------------------------------------------------------


class _Small:
    """Up to ``limit`` children in byte order: the layouts of 4 and 16."""

    __slots__ = ("limit", "bytes", "nodes")

    def __init__(self, limit: int = 4):
        self.limit, self.bytes, self.nodes = limit, bytearray(), []

    def get(self, byte: int):
        i = bisect_left(self.bytes, byte)
        return self.nodes[i] if i < len(self.bytes) and self.bytes[i] == byte else None

    def put(self, byte: int, node):
        """Sets a child; returns the layout that holds it, a larger one if this was full."""
        i = bisect_left(self.bytes, byte)
        if i < len(self.bytes) and self.bytes[i] == byte:
            self.nodes[i] = node
            return self
        if len(self.nodes) == self.limit:
            larger = _Small(16) if self.limit == 4 else _Indexed()
            for b, n in zip(self.bytes, self.nodes):
                larger = larger.put(b, n)
            return larger.put(byte, node)
        self.bytes.insert(i, byte)
        self.nodes.insert(i, node)
        return self

    def __iter__(self):
        return iter(self.nodes)


class _Indexed:
    """Up to 48 children behind an index of 256 bytes (0: none)."""

    __slots__ = ("index", "nodes")

    def __init__(self):
        self.index, self.nodes = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node):
        if self.index[byte]:
            self.nodes[self.index[byte] - 1] = node
            return self
        if len(self.nodes) == 48:
            larger = _Full()
            for b, at in enumerate(self.index):
                if at:
                    larger.nodes[b] = self.nodes[at - 1]
            return larger.put(byte, node)
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return self

    def __iter__(self):
        return (self.nodes[at - 1] for at in self.index if at)


class _Full:
    """A child for every byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node):
        self.nodes[byte] = node
        return self

    def __iter__(self):
        return (n for n in self.nodes if n is not None)


def shared_bytes(a: bytes, b: bytes) -> int:
    """How many first bytes two keys have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


class Node:
    """``prefix``: the compressed bytes below the parent's byte; ``rows``: numbers of the keys that end here; ``row``: a key through here."""

    __slots__ = ("prefix", "kids", "rows", "row")

    def __init__(self, prefix: bytes, row: int):
        self.prefix, self.kids, self.rows, self.row = prefix, _Small(), [], row


class AdaptiveRadixTree:
    """Keys with their row numbers; a key may be a prefix of another, and keys may repeat."""

    def __init__(self):
        self.root = Node(b"", 0)

    def insert(self, key: bytes, row: int) -> None:
        node, above, at = self.root, None, 0
        while True:
            p = node.prefix
            if not key.startswith(p, at):
                n = shared_bytes(key[at : at + len(p)], p)
                split = Node(p[:n], node.row)
                split.kids = split.kids.put(p[n], node)
                node.prefix = p[n + 1 :]
                above.kids = above.kids.put(key[at - 1], split)
                node, p = split, split.prefix
            at += len(p)
            if at == len(key):
                node.rows.append(row)
                return
            child = node.kids.get(key[at])
            if child is None:
                leaf = Node(key[at + 1 :], row)
                leaf.rows.append(row)
                node.kids = node.kids.put(key[at], leaf)
                return
            node, above, at = child, node, at + 1


def prefix_hashes(key: bytes) -> list[bytes]:
    """A hash of each turn-aligned prefix, the empty one first."""
    out = [b"\0" * 16]
    for at in range(0, len(key), WIDTH):
        out.append(hashlib.blake2b(out[-1] + key[at : at + WIDTH], digest_size=16).digest())
    return out


NOTHING = hashlib.sha256(b"").hexdigest()
COMPLETE, PARTIAL, ENDS, BOUNDARY = range(4)
_BLOCK = (
    "kind int, depth bigint, node binary, parent binary, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "gross bigint, once bigint, ends string, last binary, words array<int>"
)
_ARROW = pa.schema([
    ("kind", pa.int32()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("gross", pa.int64()), ("once", pa.int64()), ("ends", pa.string()),
    ("last", pa.binary()), ("words", pa.list_(pa.int32())),
])


def block_rows(keys: list[bytes], convs: list[int], words: list[list[int]]):
    """Rows of ``_BLOCK`` for sorted keys: nodes, ends of partial nodes, and the block's boundary.

    ``gross`` sums, over the nodes of a subtree, words times conversations; ``once`` sums words.
    """
    tree = AdaptiveRadixTree()
    for row, key in enumerate(keys):
        tree.insert(key, row)
    order, ends_at, above = [tree.root], [0], [-1]
    for i, node in enumerate(order):  # grows while it is read: parents come before children
        for kid in node.kids:
            order.append(kid)
            above.append(i)
            ends_at.append(ends_at[i] + 1 + len(kid.prefix))
    size = len(order)
    n, low, first, last = [0] * size, [None] * size, [len(keys)] * size, [-1] * size
    heads, leaves, gross, once = [0] * size, [0] * size, [0] * size, [0] * size
    below = [None] * size  # of the node itself, before its edge: (children, gross, once)
    for i in range(size - 1, -1, -1):
        node, p = order[i], above[i]
        for row in node.rows:
            n[i] += 1
            low[i] = convs[row] if low[i] is None else min(low[i], convs[row])
        if node.rows:
            first[i], last[i] = min(first[i], node.rows[0]), max(last[i], node.rows[-1])
        below[i] = heads[i], gross[i], once[i]
        top = ends_at[p] // WIDTH if p >= 0 else 0
        here = ends_at[i] // WIDTH
        if here > top or p < 0:
            leaves[i] = leaves[i] or 1
            edge = sum(words[node.row][top:here])
            heads[i], gross[i], once[i] = 1, gross[i] + n[i] * edge, once[i] + edge
        if p >= 0:
            n[p] += n[i]
            low[p] = low[i] if low[p] is None else min(low[p], low[i])
            first[p], last[p] = min(first[p], first[i]), max(last[p], last[i])
            heads[p] += heads[i]
            leaves[p] += leaves[i]
            gross[p] += gross[i]
            once[p] += once[i]
    hashes = {True: prefix_hashes(keys[0]), False: prefix_hashes(keys[-1])}
    out = []
    edge_of = [None] * size  # of the nearest emitted node at or above: (lowest conversation, hash if partial)
    for i in range(size):
        node, p = order[i], above[i]
        up = edge_of[p] if p >= 0 else (None, None)
        top = ends_at[p] // WIDTH if p >= 0 else -1
        here = ends_at[i] // WIDTH
        if here == top:
            edge_of[i] = up
            continue
        partial = first[i] == 0 or last[i] == len(keys) - 1
        path = hashes[first[i] == 0] if partial else None
        children, g, o = below[i]
        rows = []
        for d in range(here, top, -1):  # from the deepest: sums grow towards the top of the edge
            w = words[node.row][d - 1] if d else 0
            g, o = g + n[i] * w, o + w
            rows.append((d, children, g, o))
            children = 1
        for d, children, g, o in reversed(rows):
            ends = NOTHING
            if d == here and node.rows:
                text = ",".join(str(convs[r]) for r in node.rows)
                if partial:
                    out.append((ENDS, d, path[d], None, convs[node.rows[0]], None, None, None, None, None, None, text, None, None))
                else:
                    ends = hashlib.sha256(text.encode()).hexdigest()
            if partial:
                out.append((PARTIAL, d, path[d], path[d - 1] if d else None, low[i], None, n[i], children, leaves[i], g, o, None, None, None))
            else:
                out.append((COMPLETE, d, None, up[1], low[i], None if up[1] else up[0], n[i], children, leaves[i], g, o, ends, None, None))
            up = low[i], path[d] if partial else None
        edge_of[i] = up
    out.append((BOUNDARY, 0, keys[0], None, convs[0], None, None, None, None, None, None, None, keys[-1], words[0]))
    return out


def corrections(before: bytes, key: bytes, words: list[int]):
    """``(node, children, leaves, once)`` to take out for two neighbouring blocks: last key of one, first key of the next."""
    shared = shared_bytes(before, key) // WIDTH
    hashes = prefix_hashes(key[: shared * WIDTH])
    over, once = [], 0
    for d in range(shared, -1, -1):
        once += words[d - 1] if d else 0
        over.append((hashes[d], int(d < shared), int(len(before) == shared * WIDTH), once))
    return over


# --- Spark --------------------------------------------------------------------------------------------------------


def conversation_keys(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, key, words)``: the ids of a conversation's turns one after another, and the words of each.

    Ordered by turn, null first; turns of equal number are ordered by their ids. Null role or text counts
    as empty, repeated rows stay turns of their own, rows without a conversation id take no part.
    """
    role_, text_ = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    own = F.substring(F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_).cast("binary"), 256), 1, 2 * WIDTH)
    rows = turns.select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), own.alias("id"), F.regexp_count(text_, F.lit(_WORD)).alias("n")).alias("t"),
    ).where("conv_id is not null")
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.unhex(F.array_join(F.col("t.id"), "")).alias("key"), F.col("t.n").alias("words"))


def regraft(keys: DataFrame, share: Column, every: int = 20) -> DataFrame:
    """Each conversation rebuilt on the first ``share`` (0 to 3) turns of the conversation whose id is ``conv_id - conv_id % every``.

    Its own turns after its first ``share`` follow; a base that is absent gives none, a shorter one all it has.
    """
    heads = keys.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.expr(f"substring(key, 1, {3 * WIDTH})").alias("head"), F.slice("words", 1, 3).alias("head_words")
    )
    own = keys.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "h": share.cast("int")})
    both = own.join(heads, "base", "left")
    return both.select(
        "conv_id",
        F.expr(f"concat(coalesce(substring(head, 1, h * {WIDTH}), cast('' as binary)), substring(key, h * {WIDTH} + 1))").alias("key"),
        F.expr("concat(coalesce(slice(head_words, 1, h), cast(array() as array<int>)), slice(words, h + 1, greatest(size(words) - h, 0)))").alias("words"),
    )


def nodes(keys: DataFrame) -> DataFrame:
    """Every node of the prefix trie of ``(conv_id, key, words)`` rows, one a conversation, with the digest columns of its members.

    An empty table has no node. The blocks are stored in the shared checkpoint
    folder, so range bounds stay as they are if an executor is lost.
    """
    spark = keys.sparkSession
    ship(spark)

    def trees(batches):
        held: tuple[list, list, list] = [], [], []
        size = 0
        for batch in batches:
            for key, conv, words in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "words"))):
                for part, value in zip(held, (key, conv, words)):
                    part.append(value)
                size += len(key)
                if len(held[0]) >= BLOCK_KEYS or size >= BLOCK_BYTES:
                    yield from _batches(block_rows(*held))
                    held, size = ([], [], []), 0
        if held[0]:
            yield from _batches(block_rows(*held))

    spread = keys.select("key", "conv_id", "words").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    blocks = materialize(spread.mapInArrow(trees, _BLOCK), "trie-blocks")

    def correct(batches):
        for batch in batches:
            rows = [r for b, k, w in zip(*(batch.column(c).to_pylist() for c in ("before", "node", "words"))) for r in corrections(b, k, w)]
            names = ["node", "n_children", "n_leaves", "once"]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), (pa.binary(), *[pa.int64()] * 3))], names)

    # one row a block, so a single ordered window over them is as small as the number of blocks
    bounds = blocks.where(F.col("kind") == BOUNDARY)
    pairs = bounds.select("node", "words", F.lag("last").over(Window.orderBy("node", "conv_id")).alias("before")).where("before is not null")
    over = pairs.mapInArrow(correct, "node binary, n_children bigint, n_leaves bigint, once bigint")
    sums = ("n_convs", "n_children", "n_leaves", "gross", "once")
    parts = blocks.where(F.col("kind") == PARTIAL).select("node", "parent", "depth", "conv_id", *sums)
    less = over.select("node", *[(-F.col(c)).alias(c) if c in over.columns else F.lit(0).cast("bigint").alias(c) for c in sums])
    merged = parts.unionByName(less, allowMissingColumns=True).groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in sums]
    )

    def digests(batches):
        """Streams the ends of each node in order; a node's state is one running hash."""
        current, state = None, None
        for batch in batches:
            found = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if node != current:
                    if current is not None:
                        found.append((current, state.hexdigest()))
                    current, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digest_batch(found)
        if current is not None:
            yield _digest_batch([(current, state.hexdigest())])

    chunks = blocks.where(F.col("kind") == ENDS).select("node", "conv_id", "ends")
    ends = chunks.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(digests, "node binary, ends string")
    merged = materialize(merged.join(ends, "node", "left"), "trie-shared")
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    complete = blocks.where(F.col("kind") == COMPLETE).select("parent", "depth", "conv_id", "parent_conv_id", *sums, "ends")
    shared = merged.select("parent", "depth", "conv_id", F.lit(None).cast("bigint").alias("parent_conv_id"), *sums, F.coalesce("ends", F.lit(NOTHING)).alias("ends"))
    open_ = complete.where("parent is not null").unionByName(shared)
    if merged.count() <= BROADCAST_ROWS:
        joined = open_.join(F.broadcast(above), "parent", "left")
    else:  # a parent's children may be a third of all rows: both sides are salted
        salted = above.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        joined = open_.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(_SALTS)).cast("int")).join(salted, ["parent", "salt"], "left")
    joined = joined.withColumn("parent_conv_id", F.col("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("gross") - F.col("once")).alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    return complete.where("parent is null").select(*columns).unionByName(joined.select(*columns))


def _digest_batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["node", "ends"])


def _batches(rows: list[tuple], step: int = 50_000):
    for at in range(0, len(rows), step):
        cut = list(zip(*rows[at : at + step]))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cut, _ARROW)], schema=_ARROW)


def rebuilt_nodes(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of all conversations, each rebuilt on the first crc32(id) % 4 turns of its base (see ``regraft``)."""
    keys = conversation_keys(turns, conv_id, turn, role, text)
    return nodes(regraft(keys, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4))
