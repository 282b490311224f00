"""The trie of conversation prefixes: a broadcast skeleton of splitter paths, and sorted shards for the rest.

Every conversation is rebuilt from the opening turns of its family and its own later turns; each distinct sequence of first
turns is a node. A conversation is one row, its path: the 16-byte digests of its turns, one after another. Rows are dealt to
shards by ranges of (path, conv_id). A node's conversations lie together in that order, so a node that reaches over the end of
a shard is a prefix of the splitter there. The prefixes of all splitters, the skeleton, are broadcast. A shard finishes every
node off the skeleton in one walk over its sorted rows that holds the open path only; of skeleton nodes it passes on one
partial aggregate each, and these are combined by a grouping and rolled up over the skeleton.

Copies of one conversation are told apart by conv_id, so a group of copies of any size is dealt over many shards; its node is
then on the skeleton. The ids that end in such a node travel as sorted, joined pieces of at most `PIECE` characters, and one
task hashes the pieces of a node in order, holding one at a time.

Bounds: the skeleton has at most `SKELETON` nodes, as splitters are left out beyond that (shards grow, results do not change).
Texts do not move: a turn is a digest of 16 bytes and a length. The turns of one conversation come together in one row, 24
bytes each, which bounds a conversation at some ten million turns. Turns are told apart by a 128-bit digest.

Defined results: null roles and texts are empty; a turn without a number comes first; turns of one number are ordered by
digest; repeated rows are turns of their own. Rows without conv_id belong to no conversation. The family of a negative id c is
c - c % 5 with the sign of c, as in SQL. An empty table has no conversations and so no nodes, not even a root. Columns but
these four are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platterflow.session import keep

FAMILY, HEADS = 5, 9
DIGEST = 16
# Nodes of the skeleton, shards, and the longest path that may be a splitter.
SKELETON, SHARDS, SPLITTER_TURNS, OVERSAMPLE = 1 << 18, 4096, 1024, 4
PIECE, ROWS = 1 << 16, 8192

NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string")
# What a shard returns: finished nodes (skeleton: number of the parent, or null), partial aggregates of skeleton nodes, pieces.
SHARD_ROW = f"kind int, skeleton bigint, {NODE}, n_bytes bigint, shard int, piece bigint, ids string"


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): digests of the rebuilt turns as one binary, and the UTF-8 bytes of their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    turns = conversations.filter(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("family"), conv.alias("conv_id"),
        F.struct(turn.isNotNull().alias("numbered"), F.coalesce(turn, F.lit(0)).alias("turn"),
                 F.unhex(digest).alias("digest"), F.octet_length(text).cast("bigint").alias("size")).alias("turn"))
    # One shuffle, by family: both the turns of a conversation and the conversations of a family are then together.
    own = turns.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    first = F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, HEADS - 1))
    heads = F.col("heads")
    opened = own.withColumns({
        "opening": F.coalesce(F.first(first, ignorenulls=True).over(Window.partitionBy("family")), F.slice("turns", 1, 0)),
        "heads": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")})
    later = F.slice("turns", heads + 1, F.greatest(F.size("turns") - heads, F.lit(0)))
    whole = F.concat(F.slice("opening", F.lit(1), heads), later)
    return opened.withColumn("whole", whole).select(
        "conv_id", F.unhex(F.array_join(F.transform("whole", lambda t: F.hex(t["digest"])), "")).alias("path"),
        F.transform("whole", lambda t: t["size"]).alias("sizes"))


class Skeleton:
    """The trie of the splitters' paths. Node 0 is the root; a node's number is larger than its parent's."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.parent, self.child, self.splitters = [-1], {}, []
        for path, conv in splitters:
            if len(self.parent) + len(path) // DIGEST > SKELETON:
                continue
            self.splitters.append((path, conv))
            node = 0
            for at in range(0, len(path), DIGEST):
                step = (node, path[at:at + DIGEST])
                if step not in self.child:
                    self.child[step] = len(self.parent)
                    self.parent.append(node)
                node = self.child[step]


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most `shards` - 1 keys that cut the stored rows about evenly, from a sample of bounded size.

    Any key is a right splitter; long paths are not taken, so that the sample stays small.
    """
    rows = paths.count()
    share = min(1.0, OVERSAMPLE * shards / max(rows, 1))
    sample = paths.filter(F.octet_length("path") <= SPLITTER_TURNS * DIGEST).select("path", "conv_id").sample(share, 42)
    keys = sorted((bytes(r.path), r.conv_id) for r in sample.limit(8 * OVERSAMPLE * shards).collect())
    return sorted({keys[len(keys) * i // shards] for i in range(1, shards)}) if keys else []


class _Open:
    """A node on the open path."""

    __slots__ = ("skeleton", "n", "least", "children", "leaves", "saved", "bytes", "ends", "closed")

    def __init__(self, skeleton: int, size: int):
        self.skeleton, self.bytes = skeleton, size
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends = [] if skeleton >= 0 else None  # a hash off the skeleton, from the first id on
        self.closed: list[tuple] = []


class _Walk:
    """One shard's rows in order; `rows` fills with SHARD_ROW tuples."""

    def __init__(self, shard: int, skeleton: Skeleton, piece: int):
        self.shard, self.skeleton, self.piece, self.rows = shard, skeleton, piece, []
        self.path, self.open, self.pieces, self.length = b"", [_Open(0, 0)], 0, 0

    def add(self, conv: int, path: bytes, sizes: list[int]) -> None:
        depth, shared = len(path) // DIGEST, 0
        most = min(depth, len(self.open) - 1)
        while shared < most and path[DIGEST * shared:DIGEST * shared + DIGEST] == self.path[DIGEST * shared:DIGEST * shared + DIGEST]:
            shared += 1
        self.close(shared)
        for at in range(shared, depth):
            above = self.open[-1].skeleton
            step = (above, path[DIGEST * at:DIGEST * at + DIGEST])
            self.open.append(_Open(self.skeleton.child.get(step, -1) if above >= 0 else -1, sizes[at]))
        self.path, node = path, self.open[-1]
        node.n += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if node.skeleton >= 0:
            node.ends.append(str(conv))
            self.length += len(node.ends[-1]) + 1
            if self.length > self.piece:
                self.pass_on(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(str(conv).encode())
        else:
            node.ends.update(f",{conv}".encode())

    def pass_on(self, node: _Open) -> None:
        """The ids that ended in a skeleton node so far, as a piece."""
        if node.ends:
            self.rows.append((2, node.skeleton, *[None] * 8, None, self.shard, self.pieces, ",".join(node.ends)))
            self.pieces, self.length, node.ends = self.pieces + 1, 0, []

    def close(self, depth: int) -> None:
        """Closes the nodes below `depth`."""
        while len(self.open) > depth + 1:
            node, parent = self.open.pop(), self.open[-1]
            if node.skeleton >= 0:
                self.partial(node, len(self.open))
                continue
            if not node.children:
                node.leaves = 1
            node.saved += (node.n - 1) * node.bytes
            ends = (node.ends or hashlib.sha256()).hexdigest()
            self.finish(node.closed, node.least, None)
            row = (node.least, len(self.open), node.n, node.children, node.leaves, node.saved, ends)
            if parent.skeleton >= 0:
                self.finish([row], None, parent.skeleton)
            else:
                parent.closed.append(row)
            parent.n += node.n
            parent.least = node.least if parent.least is None else min(parent.least, node.least)
            parent.children += 1
            parent.leaves += node.leaves
            parent.saved += node.saved

    def finish(self, nodes: list[tuple], parent_conv: int | None, skeleton: int | None) -> None:
        """Nodes whose parent is closed, or is on the skeleton."""
        self.rows += [(0, skeleton, n[0], n[1], parent_conv, *n[2:], None, self.shard, None, None) for n in nodes]

    def partial(self, node: _Open, depth: int) -> None:
        self.pass_on(node)
        self.rows.append((1, node.skeleton, node.least, depth, None, node.n, node.children, node.leaves, node.saved,
                          None, node.bytes, self.shard, None, None))

    def end(self) -> None:
        self.close(0)
        self.partial(self.open[0], 0)


def walked(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Deals the paths to shards by the skeleton's splitters and walks each shard."""
    shards, piece = len(skeleton.splitters) + 1, PIECE
    schema = pa.schema([
        (f.name, {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[f.dataType.simpleString()])
        for f in paths.sparkSession.createDataFrame([], SHARD_ROW).schema])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch["path"].to_pylist(), batch["conv_id"].to_pylist())
            shard = [bisect.bisect_right(skeleton.splitters, key) for key in keys]
            yield batch.append_column("shard", pa.array(shard, pa.int32()))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(column, f.type) for column, f in zip(zip(*rows), schema)], schema=schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: _Walk | None = None
        for batch in batches:
            for conv, path, sizes, shard in zip(*(batch[c].to_pylist() for c in ("conv_id", "path", "sizes", "shard"))):
                if at is None or at.shard != shard:
                    rows = at.rows if at else []
                    if at:
                        at.end()
                    at = _Walk(shard, skeleton, piece)
                    at.rows = rows
                at.add(conv, path, sizes)
                if len(at.rows) >= ROWS:
                    yield table(at.rows)
                    at.rows = []
        if at:
            at.end()
            for first in range(0, len(at.rows), ROWS):
                yield table(at.rows[first:first + ROWS])

    dealt = paths.mapInArrow(deal, "conv_id bigint, path binary, sizes array<bigint>, shard int")
    return dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(walk, SHARD_ROW)


def joined_ends(rows: DataFrame) -> DataFrame:
    """(skeleton, ends_sha256): the hash over a node's pieces in order, one piece in memory at a time."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            for skeleton, ids in zip(batch["skeleton"].to_pylist(), batch["ids"].to_pylist()):
                if skeleton != node:
                    if state:
                        yield pa.record_batch({"skeleton": [node], "ends_sha256": [state.hexdigest()]})
                    node, state = skeleton, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
        if state:
            yield pa.record_batch({"skeleton": [node], "ends_sha256": [state.hexdigest()]})

    pieces = rows.filter("kind = 2").select("skeleton", "shard", "piece", "ids")
    return pieces.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "piece").mapInArrow(
        digest, "skeleton bigint, ends_sha256 string")


def rolled_up(rows: DataFrame, skeleton: Skeleton) -> DataFrame:
    """(skeleton, node columns) of the skeleton's nodes: partial aggregates combined, then added up from the deepest node on.

    At most `SKELETON` rows reach the driver, one per node.
    """
    partial = rows.filter("kind = 1").groupBy("skeleton").agg(
        F.min("conv_id"), F.max("depth"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"),
        F.max("n_bytes")).collect()
    nodes = {r[0]: list(r[1:]) for r in partial}
    for number in sorted(nodes, reverse=True):  # children before their parents
        least, _, n, children, leaves, saved, size = nodes[number]
        if not children:
            nodes[number][4] = leaves = 1
        nodes[number][5] = saved = saved + (n - 1) * size
        above = nodes.get(skeleton.parent[number])
        if above:
            known = [x for x in (above[0], least) if x is not None]
            above[0] = min(known) if known else None
            above[2], above[3], above[4], above[5] = above[2] + n, above[3] + 1, above[4] + leaves, above[5] + saved
    found = [(number, least, depth, nodes[skeleton.parent[number]][0] if number else None, n, children, leaves, saved)
             for number, (least, depth, n, children, leaves, saved, _) in sorted(nodes.items())]
    columns = NODE.replace(", ends_sha256 string", "")
    return rows.sparkSession.createDataFrame(found, f"skeleton bigint, {columns}")


def prefix_nodes(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, the columns of NODE."""
    spark = conversations.sparkSession
    paths = keep(rebuilt(conversations))
    shards = min(shards or int(spark.conf.get("spark.sql.shuffle.partitions")), SHARDS)
    skeleton = Skeleton(splitters(paths, shards))
    rows = keep(walked(paths, skeleton))
    top = keep(rolled_up(rows, skeleton))
    names = [part.split()[0] for part in NODE.split(", ")]
    # As many rows as the skeleton has nodes.
    owners = F.broadcast(top.select("skeleton", F.col("conv_id").alias("owner")))
    finished = rows.filter("kind = 0").join(owners, "skeleton", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "owner"))
    ends = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    shared = top.join(F.broadcast(joined_ends(rows)), "skeleton", "left").withColumn("ends_sha256", ends)
    return finished.select(*names).unionByName(shared.select(*names))
