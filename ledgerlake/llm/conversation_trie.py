"""The prefix trie of conversations: what each shared beginning costs and saves.

A conversation is its turns' (role, text) in order of `turn`, null first; turns of one number are
ordered by role, then by digest. A null role or text is empty. A conversation's path is the 16-byte
digests of its turns, so that paths sorted as bytes are the trie in depth-first order.

Splitters, the paths of a few sampled conversations, cut the sorted paths into shards of bounded
size; equal paths are cut by conversation id, so that a conversation that very many have is spread
too. Only prefixes of splitters can have members in two shards. The trie of the splitters is sent to
all tasks. Each task sorts its shard and finishes all other nodes by itself; for the nodes of the
skeleton it sends partial sums, which are added up per node and then along the skeleton.

`rebuild` gives each conversation another one's first turns: of the first of every five, as many as
the checksum of its own id says; its own turns follow after as many.

The digest of a skeleton node's members is taken over their ids in order, which come as text in
chunks and are read as a stream; no list of them is ever held. A conversation's turns meet in one row
of about 60 bytes a turn while it is put together, texts never do. A null conversation id is left
out; turns that repeat stay. No conversations: no nodes. Texts are read once, however long. Only the
named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.sources.workspace import written

#: Path bytes of a shard; a task holds one, in arrays of about ten times that.
SHARD_BYTES = 8 << 20
#: The bound of what is sent to all tasks, whatever the input; beyond it shards grow instead.
SKELETON_BYTES = 64 << 20
#: Sampled conversations per shard, of which one becomes a splitter.
SAMPLED = 8
#: Ids of one chunk of text.
CHUNK_IDS = 8192

_DIGEST = 16
_EMPTY = hashlib.sha256(b"").hexdigest()


def paths(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """`conv_id` and `own`: per turn its digest in hex and the bytes of its text, in order."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said))
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), by.alias("role"), digest.alias("digest"),
        F.octet_length(said).alias("bytes")).alias("t")).filter("conv_id is not null")
    own = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"], t["bytes"]))
    return rows.groupBy("conv_id").agg(own.alias("own"))


def rebuild(own: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """Each conversation with the first turns of its group's first one before its own later turns."""
    own = written(own, "conversations")
    mine = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn(
        "taken", (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int"))
    heads = own.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, most).alias("head"))
    nothing = F.slice("own", 1, 0)
    first = F.when(F.col("head").isNull() | (F.col("taken") == 0), nothing).otherwise(
        F.slice("head", F.lit(1), F.col("taken")))
    rest = F.slice("own", F.col("taken") + 1, F.greatest(F.size("own"), F.lit(1)))
    return mine.join(heads, "base", "left").select("conv_id", F.concat(first, rest).alias("own"))


class Skeleton(NamedTuple):
    splitters: list[tuple[bytes, int]]
    """(path, conversation id), sorted: shard k holds what lies from splitter k - 1 up to splitter k."""
    nodes: list[np.ndarray]
    """Of each splitter, the number of its path's node at each depth; 0 is the root."""
    parents: np.ndarray


def _shared(a: bytes, b: bytes) -> int:
    """How many turns two paths have in common at their beginning."""
    n = min(len(a), len(b)) // _DIGEST
    if a[:n * _DIGEST] == b[:n * _DIGEST]:
        return n
    x, y = (np.frombuffer(p, np.uint64, n * 2).reshape(n, 2) for p in (a, b))
    return int(np.flatnonzero((x != y).any(axis=1))[0])


def skeleton(splitters: list[tuple[bytes, int]]) -> Skeleton:
    nodes: list[np.ndarray] = []
    parents, before = [-1], b""
    for path, _ in splitters:
        depth = len(path) // _DIGEST
        common = _shared(before, path) if nodes else 0
        known = nodes[-1][:common + 1] if nodes else np.zeros(1, np.int64)
        fresh = np.arange(len(parents), len(parents) + depth - common)
        nodes.append(np.concatenate([known, fresh]))
        parents.extend(nodes[-1][common:depth].tolist())
        before = path
    return Skeleton(splitters, nodes, np.array(parents))


def _splitters(rows: DataFrame, shard_bytes: int, skeleton_bytes: int) -> list[tuple[bytes, int]]:
    """Evenly spaced ones of a sample; fewer where they would be larger than the bound."""
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("path") + 40)).first()
    shards = -(-(size or 0) // shard_bytes)
    if shards < 2:
        return []
    wanted = min(SAMPLED * shards, max(1, 4 * skeleton_bytes * n // size))
    sample = sorted((bytes(r[0]), r[1]) for r in rows.filter(
        F.pmod(F.xxhash64("conv_id", F.lit(1)), F.lit(1 << 30)) < F.lit(int(wanted / n * (1 << 30)))
    ).select("path", "conv_id").collect())
    while len(sample) > 1:
        chosen = sample[::max(1, len(sample) // shards)]
        if sum(len(p) * 1.5 + 100 for p, _ in chosen) <= skeleton_bytes:
            return chosen
        shards //= 2
        if shards < 2:
            break
    return []


def _dealt(said):
    """Adds the shard of each path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = said.value.splitters
        for batch in batches:
            shard = [bisect_right(splitters, key) for key in
                     zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns],
                                             ["shard", *batch.schema.names])
    return run


class Shard(NamedTuple):
    ids: np.ndarray
    digests: np.ndarray
    """Two numbers a turn."""
    sizes: np.ndarray
    offsets: np.ndarray


def _read(batches: list[pa.RecordBatch]) -> Shard:
    table = pa.Table.from_batches(batches)
    raw = b"".join(x.as_buffer().to_pybytes() for x in table.column("path"))
    lengths = pa.compute.binary_length(table.column("path")).to_numpy().astype(np.int64) // _DIGEST
    sizes = table.column("sizes").combine_chunks()
    if isinstance(sizes, pa.ChunkedArray):
        sizes = pa.concat_arrays(sizes.chunks)
    return Shard(table.column("conv_id").to_numpy(), np.frombuffer(raw, np.uint64).reshape(-1, 2),
                 sizes.flatten().to_numpy().astype(np.int64), np.append(0, np.cumsum(lengths)))


def _common(shard: Shard) -> np.ndarray:
    """How many turns each path shares with the one before it; -1 for the first."""
    lengths = np.diff(shard.offsets)
    most = np.minimum(lengths[1:], lengths[:-1])
    k = np.arange(most.sum()) - np.repeat(np.cumsum(most) - most, most)
    a, b = (np.repeat(shard.offsets[i:len(lengths) - 1 + i], most) + k for i in (0, 1))
    differs = np.where((shard.digests[a] != shard.digests[b]).any(axis=1), k, np.repeat(most, most))
    out = np.zeros(len(lengths), np.int64)
    out[0] = -1
    some = np.flatnonzero(most)
    if len(some):
        out[some + 1] = np.minimum.reduceat(differs, (np.cumsum(most) - most)[some])
    return out


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value of each range, by tables of the least of every 1, 2, 4, ... values."""
    level = np.frexp((last - first).astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    table = values
    for k in range(int(level.max(initial=0)) + 1):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[first[own]], table[last[own] - (1 << k)])
        table = np.minimum(table[:-(1 << k)], table[1 << k:]) if len(table) > 1 << k else table
    return out


class Trie(NamedTuple):
    """All nodes of a shard in depth-first order, the root first."""
    depth: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    """The first of the node's paths, and the end of them; they are neighbours."""
    last: np.ndarray
    below: np.ndarray
    """The end of the node's subtree, in nodes."""
    bytes: np.ndarray
    start: np.ndarray
    """The first node that each path adds."""


def _trie(shard: Shard) -> tuple[Trie, np.ndarray]:
    """The nodes, and those on the last path by depth."""
    lengths, common = np.diff(shard.offsets), _common(shard)
    added = lengths - common
    start = np.append(0, np.cumsum(added))
    row = np.repeat(np.arange(len(lengths)), added)
    depth = np.arange(len(row)) - start[row] + common[row] + 1
    parent, last = np.arange(-1, len(row) - 1), np.full(len(row), len(lengths))
    path = np.zeros(int(lengths.max()) + 1, np.int64)
    length = -1
    for i, (shares, n, at) in enumerate(zip(common.tolist(), lengths.tolist(), start.tolist())):
        last[path[shares + 1:length + 1]] = i
        path[shares + 1:n + 1] = np.arange(at, at + n - shares)
        if n > shares and i:
            parent[at] = path[shares]
        length = n
    turn = shard.offsets[row] + depth - 1
    padded = np.append(shard.sizes, 0)
    return Trie(depth, parent, row, last, start[last], np.where(depth > 0, padded[turn], 0), start), path[:length + 1]


def _sums(values: np.ndarray, trie: Trie) -> np.ndarray:
    """The sum over each node's subtree."""
    total = np.append(0, np.cumsum(values))
    return total[trie.below] - total[:-1]


def _ids(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


_NODES = ("skeleton long, above long, part int, seq int, conv_id long, depth long, parent_conv_id long,"
          " n_convs long, n_children long, n_leaves long, saved_tokens long, bytes long, ends string")
_NAMES = [c.split()[0] for c in _NODES.split(", ")]


def _finished(number: int, shard: Shard, said: Skeleton) -> Iterator[pa.RecordBatch]:
    """A shard's nodes; those of the skeleton as partial sums, with members' ids in chunks of text.

    `skeleton` is the number of a skeleton node, else null; `above` is that of a parent in the skeleton.
    """
    trie, last_path = _trie(shard)
    n = len(trie.depth)
    mark = np.full(n, -1)
    mark[0] = 0
    for at, path, nodes in ((number - 1, np.arange(trie.start[1]), 0), (number, last_path, -1)):
        if 0 <= at < len(said.splitters):
            low, high = shard.offsets[nodes - 1 if nodes else 0], shard.offsets[nodes if nodes else 1]
            depth = _shared(said.splitters[at][0], shard.digests[low:high].tobytes())
            mark[path[:depth + 1]] = said.nodes[at][:depth + 1]
    own = mark < 0
    members = trie.last - trie.first
    children = np.bincount(trie.parent[1:][own[1:]], minlength=n)
    leaf = own & (np.bincount(trie.parent[1:], minlength=n) == 0)
    least = _least(shard.ids, trie.first, trie.last)
    above = np.where(own, mark[trie.parent], -1)
    ends = np.full(n, _EMPTY, object)
    ends[~own] = None
    chunks = []
    # paths that are equal are neighbours, and their node is the last that the first of them adds
    fresh = np.flatnonzero(np.diff(trie.start) > 0)
    if not np.diff(shard.offsets)[0]:
        fresh = fresh if len(fresh) and fresh[0] == 0 else np.append(0, fresh)
    same = np.append(fresh, len(shard.ids))
    for a, b in zip(same.tolist(), same[1:].tolist()):
        node = trie.start[a + 1] - 1
        if own[node]:
            ends[node] = hashlib.sha256(_ids(shard.ids[a:b]).encode()).hexdigest()
        else:
            for seq, low in enumerate(range(a, b, CHUNK_IDS)):
                chunks.append((int(mark[node]), seq, _ids(shard.ids[low:min(low + CHUNK_IDS, b)])))
    parent_id = least[trie.parent]
    columns = [pa.array(mark, mask=own), pa.array(above, mask=above < 0),
               pa.array(np.full(n, number, np.int32)), pa.nulls(n, pa.int32()), pa.array(least),
               pa.array(trie.depth), pa.array(parent_id, mask=~own | (above >= 0)), pa.array(members),
               pa.array(children), pa.array(_sums(leaf.astype(np.int64), trie)),
               pa.array(_sums(np.where(own, (members - 1) * trie.bytes, 0), trie)),
               pa.array(trie.bytes), pa.array(ends, pa.string())]
    whole = pa.RecordBatch.from_arrays(columns, _NAMES)
    yield from (whole.slice(at, 50_000) for at in range(0, n, 50_000))
    if chunks:
        text = dict(zip(("skeleton", "seq", "ends"), zip(*chunks)))
        kinds = dict(zip(_NAMES, (c.type for c in columns)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(text[c], kinds[c]) if c in text else pa.array([number] * len(chunks), pa.int32())
             if c == "part" else pa.nulls(len(chunks), kinds[c]) for c in _NAMES], _NAMES)


def _local(said):
    """Finishes one sorted shard after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []
        for batch in batches:
            shards = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if number is not None and shards[a] != number:
                    yield from _finished(number, _read(held), said.value)
                    held = []
                number = int(shards[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from _finished(number, _read(held), said.value)
    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(skeleton, ends): the digest of each node's chunks, which come in order."""
    node, digest = None, None
    for batch in batches:
        out = []
        for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != node:
                if node is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()),
                                          pa.array([x[1] for x in out], pa.string())], ["skeleton", "ends"])
    if node is not None:
        yield pa.RecordBatch.from_pydict({"skeleton": pa.array([node], pa.int64()),
                                          "ends": pa.array([digest.hexdigest()])})


_SKELETON = ("skeleton long, conv_id long, depth long, parent_conv_id long, n_convs long,"
             " n_children long, n_leaves long, saved_tokens long")


def _combined(partial: DataFrame, said: Skeleton) -> DataFrame:
    """The skeleton's nodes: partial sums per node, then from the deepest to the root.

    Children come before their parent, as all of them are deeper.
    """
    sums = partial.groupBy("skeleton").agg(
        F.min("conv_id"), F.max("depth"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"),
        F.sum("saved_tokens"), F.max("bytes"))
    rows = {r[0]: list(r) for r in sums.collect()}  # the skeleton has a bounded size
    # partial sums hold all finished nodes below; skeleton nodes add what they are themselves
    leaves, saved = dict.fromkeys(rows, 0), dict.fromkeys(rows, 0)
    for node in sorted(rows, key=lambda k: -rows[k][2]):
        own = rows[node]
        leaves[node] += own[4] == 0
        saved[node] += (own[3] - 1) * own[7]
        own[5] += leaves[node]
        own[6] += saved[node]
        if node:
            above = int(said.parents[node])
            rows[above][4] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    parent = {k: rows[int(said.parents[k])][1] if k else None for k in rows}
    return partial.sparkSession.createDataFrame(
        [(k, r[1], r[2], parent[k], *r[3:7]) for k, r in sorted(rows.items())], _SKELETON)


def trie(own: DataFrame, shard_bytes: int = SHARD_BYTES, skeleton_bytes: int = SKELETON_BYTES) -> DataFrame:
    """The nodes of the trie of `paths` (or of `rebuild`), from the root down.

    Columns: `conv_id` (smallest member), `depth`, `parent_conv_id` (null at the root), `n_convs`,
    `n_children`, `n_leaves`, `saved_tokens` (bytes of text that members share, over the subtree) and
    `ends_sha256` (of the ids of those that end there).
    """
    spark = own.sparkSession
    rows = written(own.select("conv_id", F.unhex(F.array_join("own.digest", "")).alias("path"),
                              F.col("own.bytes").alias("sizes")), "paths")
    said = skeleton(_splitters(rows, shard_bytes, skeleton_bytes))
    shared = spark.sparkContext.broadcast(said)
    dealt = rows.mapInArrow(_dealt(shared), "shard int, conv_id long, path binary, sizes array<int>")
    sorted_ = dealt.repartitionById(len(said.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    nodes = written(sorted_.mapInArrow(_local(shared), _NODES), "nodes")
    partial = nodes.filter("skeleton is not null and seq is null")
    chunks = nodes.filter("seq is not null")
    digests = (chunks.repartition("skeleton").sortWithinPartitions("skeleton", "part", "seq")
               .select("skeleton", "ends").mapInArrow(_digested, "skeleton long, ends string"))
    top = written(_combined(partial, said), "skeleton")
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    skeletal = top.join(digests, "skeleton", "left").select(
        *shown, F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"))
    parents = top.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("_above"))
    rest = nodes.filter("skeleton is null").join(F.broadcast(parents), "above", "left").select(
        *(F.coalesce("parent_conv_id", "_above").alias(c) if c == "parent_conv_id" else F.col(c) for c in shown),
        F.col("ends").alias("ends_sha256"))
    return skeletal.unionByName(rest)


def report(turns: DataFrame, **options) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuild(paths(turns)), **options)
