"""Prefix trie of conversations: padded turn-id matrices, sorted, with one aggregation for each depth.

1. Turns are numbered by conversation and the conversations rebuilt (see ``rebuilt``). A turn is the digest of its role
   and text, with the length of its text.
2. A conversation is a row of turn ids; one longer than ``WIDTH`` turns continues in further tiles, each named
   by a digest of what comes before. Rows are range-partitioned by (tile, what comes before, turn ids, id), so that every node is a run
   of rows, and a common first turn or thousands of equal conversations spread over partitions.
3. Each partition is cut into blocks of ``ROWS`` rows, written as matrices. In a block, padded turn ids are lexsorted; the change
   mask of neighbouring rows, OR-accumulated over the columns, marks where nodes start. A row ends a leaf where it ends and
   its successor leaves its node. Everything asked of a subtree is then a sum over its rows, taken
   by ``reduceat`` once a column: new children, leaves, bytes, bytes of nodes that start in the row.
4. Nodes that go beyond a block are told by the block's neighbours (first and last row of each partition, few), and
   their parts recombine by the digest of their path. What a row of a long conversation has in later tiles is added to
   it first, by running sums.

No task holds a conversation or a node, but that the ids ending at one node must go through one SHA-256: those of a node over several blocks
stream through a task as strings, a block's at a time.

Turns of a null conv_id belong to no conversation and are left out. A null turn comes first; equal turn numbers follow in the
order of the digest of role and text; repeated rows are turns like any other; a null role or text is empty. No conversation, no node.
Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import common
from mergewright.llm.running import running
from mergewright.sources.staging import stage

WIDTH, ROWS = 64, 8192
#: Rebuilding: conversations share the one at the multiple of ``SHARE`` before them, up to ``MOST - 1`` turns of it.
SHARE, MOST = 5, 9
NO_ENDS = hashlib.sha256(b"").hexdigest()
BLOCKS = ("shard int, number int, rows int, convs binary, lengths binary, more binary, tiles binary, befores binary, "
          "ids binary, bytes binary, before_lcp int, after_lcp int, head binary, tail binary")
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")


def numbered(turns: DataFrame) -> DataFrame:
    """conv, place (from 1), id (16 bytes) and bytes of every turn."""
    role, text = common.text_or_empty("role"), common.text_or_empty("text")
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"), F.lit(1).cast("long").alias("one"))
    return running(rows, "conv", [F.col("turn").asc_nulls_first(), F.col("id")], ["one"]).select(
        "conv", (F.col("before_one") + 1).alias("place"), "id", "bytes")


def rebuilt(turns: DataFrame, share: int = SHARE, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after rebuilding: the first h turns of the shared conversation, then own turns after h.

    ``h`` is crc32 of the decimal id, modulo ``most``; the shared conversation of c is ``c - c % share``.
    """
    rows = stage(numbered(turns), "numbered")
    counts = rows.groupBy("conv").agg(F.count("*").alias("n"))
    convs = stage(counts.withColumns({
        "shared": F.col("conv") - F.col("conv") % share,
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % most}), "counts")
    lead = convs.join(convs.select(F.col("conv").alias("shared"), F.col("n").alias("has")), "shared", "left").withColumn(
        "taken", F.least("h", F.coalesce("has", F.lit(0))))
    convs = stage(lead.select("conv", "shared", "h", "taken", (
        F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("turns")), "conversations")
    heads = rows.filter(F.col("place") < most).withColumnRenamed("conv", "shared")
    first = convs.filter("h > 0").join(heads, "shared").filter("place <= h").select("conv", "turns", "place", "id", "bytes")
    own = rows.join(convs, "conv").filter("place > h").select(
        "conv", "turns", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "id", "bytes")
    return first.unionByName(own), convs.select("conv", "turns")


def tiles(rows: DataFrame, convs: DataFrame, width: int) -> DataFrame:
    """One row per tile of ``width`` turns: conv, tile, before (digest of earlier tiles), more, ids, sizes."""
    cut = (rows.withColumn("tile", F.floor((F.col("place") - 1) / F.lit(width)).cast("long"))
           .groupBy("conv", "tile").agg(F.first("turns").alias("turns"),
                                        F.sort_array(F.collect_list(F.struct("place", "id", "bytes"))).alias("list")))
    joined = F.aggregate("list", F.lit(b"").cast("binary"), lambda held, t: F.concat(held, t["id"]))
    some = cut.select("conv", "tile", "turns", joined.alias("ids"), F.transform("list", lambda t: t["bytes"]).alias("sizes"))
    none = convs.filter("turns = 0").select("conv", F.lit(0).cast("long").alias("tile"), "turns", F.lit(b"").cast("binary").alias("ids"),
                                            F.array().cast("array<bigint>").alias("sizes"))
    some = stage(some.unionByName(none), "tiles")
    digest = F.md5(F.concat(F.col("tile").cast("string").cast("binary"), F.col("ids")))
    words = {f"w{i}": F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)}
    long = running(some.filter(F.col("turns") > width).withColumns(words), "conv", [F.col("tile")], list(words))
    before = F.when(F.col("tile") == 0, F.lit(b"\0" * 16).cast("binary")).otherwise(
        F.unhex(F.md5(F.concat_ws(",", *[F.col(f"before_{w}") for w in words]).cast("binary"))))
    columns = ["conv", "tile", "before", ((F.col("tile") + 1) * width < F.col("turns")).alias("more"), "ids", "sizes"]
    return (some.filter(F.col("turns") <= width).withColumn("before", F.lit(b"\0" * 16).cast("binary")).select(*columns)
            .unionByName(long.withColumn("before", before).select(*columns)))


def common_lead(a: bytes, b: bytes) -> int:
    """Turns that two rows (tile, before, ids) share; -1 in different tiles or after different beginnings."""
    if a[:24] != b[:24]:
        return -1
    n = min(len(a), len(b)) // 16 * 16 + 8
    x, y = (np.frombuffer(v[24:n], "V16") for v in (a, b))
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else len(x)


def blocks(cut: DataFrame, rows: int) -> DataFrame:
    """Sorted tiles as matrices of at most ``rows`` rows, in the order (shard, number).

    ``before_lcp`` and ``after_lcp`` tell the turns shared with the neighbouring rows; at the ends of a shard they are null
    and ``head`` and ``tail`` tell the row itself.
    """
    order = ["tile", "before", "ids", "more", "conv"]

    def run(batches):
        from pyspark import TaskContext

        common.forget_worker_cache()
        shard = TaskContext.get().partitionId()
        number, held, size, waiting = 0, [], 0, None

        def row(table, i):
            return (table["tile"][i].as_py().to_bytes(8, "big", signed=True) + table["before"][i].as_py()
                    + table["ids"][i].as_py())

        def block(tables):
            nonlocal number
            table = pa.Table.from_batches(tables).combine_chunks()
            sizes = table["sizes"].combine_chunks()
            lengths = np.diff(sizes.offsets.to_numpy()).astype("<i4")
            out = {"shard": shard, "number": number, "rows": table.num_rows,
                   "convs": table["conv"].to_numpy().astype("<i8").tobytes(), "lengths": lengths.tobytes(),
                   "more": table["more"].to_numpy(zero_copy_only=False).astype("u1").tobytes(),
                   "tiles": table["tile"].to_numpy().astype("<i8").tobytes(),
                   "befores": b"".join(table["before"].to_pylist()), "ids": b"".join(table["ids"].to_pylist()),
                   "bytes": sizes.flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                   "before_lcp": None, "after_lcp": None, "head": row(table, 0), "tail": row(table, table.num_rows - 1)}
            number += 1
            return out

        def emit(out, last):
            if out["before_lcp"] is not None:
                out["head"] = None
            if not last:
                out["tail"] = None
            return pa.RecordBatch.from_pylist([out], schema=schema)

        def push(tables):
            nonlocal waiting
            new = block(tables)
            if waiting is not None:
                shared = common_lead(waiting["tail"], new["head"])
                waiting["after_lcp"] = new["before_lcp"] = shared
                yield emit(waiting, False)
            waiting = new

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows - size)
                held.append(part)
                at, size = at + part.num_rows, size + part.num_rows
                if size == rows:
                    yield from push(held)
                    held, size = [], 0
        if size:
            yield from push(held)
        if waiting is not None:
            yield emit(waiting, True)

    schema = pa.schema([("shard", pa.int32()), ("number", pa.int32()), ("rows", pa.int32()),
                        *[(c, pa.binary()) for c in ("convs", "lengths", "more", "tiles", "befores", "ids", "bytes")],
                        ("before_lcp", pa.int32()), ("after_lcp", pa.int32()), ("head", pa.binary()), ("tail", pa.binary())])
    sorted_rows = cut.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(sorted_rows.mapInArrow(run, BLOCKS), "blocks")


def with_neighbours(made: DataFrame) -> DataFrame:
    """Fill in what blocks at the ends of shards share with the next shard's; one small row a shard is compared."""
    spark = made.sparkSession
    ends = made.filter("head is not null or tail is not null").select("shard", "number", "head", "tail").orderBy(
        "shard", "number").collect()
    known, last = {}, None
    for end in ends:
        key = (end["shard"], end["number"])
        if end["head"] is not None:
            shared = common_lead(last[1], bytes(end["head"])) if last else -1
            known.setdefault(key, [None, None])[0] = shared
            if last:
                known.setdefault(last[0], [None, None])[1] = shared
        if end["tail"] is not None:
            last = (key, bytes(end["tail"]))
    if last:
        known.setdefault(last[0], [None, None])[1] = -1
    told = spark.createDataFrame([(*k, *v) for k, v in known.items()], "shard int, number int, b int, a int")
    return made.join(F.broadcast(told), ["shard", "number"], "left").withColumns(
        {"before_lcp": F.coalesce("before_lcp", "b"), "after_lcp": F.coalesce("after_lcp", "a")}).drop("a", "b", "head", "tail")


def ranks(digests: bytes) -> np.ndarray:
    """Dense numbers of joined 16-byte digests, in the order of their bytes."""
    words = np.frombuffer(digests, ">u8").reshape(-1, 2)
    order = np.lexsort([words[:, 1], words[:, 0]])
    sorted_words = words[order]
    new = np.concatenate([[False], (sorted_words[1:] != sorted_words[:-1]).any(axis=1)]) if len(words) else np.zeros(0, bool)
    out = np.empty(len(words), np.int32)
    out[order] = np.cumsum(new)
    return out


class Matrix:
    """A block: sorted rows of turn ids, where nodes start, and what each row adds to them.

    Column j stands for the nodes after j turns of the tile; column 0 of tile 0 is the root.
    """

    def __init__(self, row: dict, width: int):
        n = row["rows"]
        lengths = np.frombuffer(row["lengths"], "<i4")
        self.n, self.lengths = n, lengths
        self.convs, self.tiles = np.frombuffer(row["convs"], "<i8"), np.frombuffer(row["tiles"], "<i8")
        self.more = np.frombuffer(row["more"], "u1").astype(bool)
        self.befores, self.raw = row["befores"], row["ids"]
        self.starts = np.cumsum(lengths, dtype=np.int64) - lengths
        wide = int(lengths.max(initial=0))
        self.wide, self.full = wide, wide == width
        at = np.repeat(np.arange(n), lengths), np.arange(int(lengths.sum())) - np.repeat(self.starts, lengths)
        # Turn ids as numbers in the order of their bytes, 0 where a row has ended.
        number = ranks(self.raw)
        ids = np.zeros((n, wide), np.int32)
        ids[at] = number + 1
        group = ranks(self.befores)
        order = np.lexsort([self.convs, self.more, *ids.T[::-1], group, self.tiles])
        assert (order == np.arange(n)).all(), "rows of a block are sorted"
        size = np.zeros((n, wide), np.int64)
        size[at] = np.frombuffer(row["bytes"], "<i8")
        change = np.zeros((n, wide + 1), bool)
        change[1:, 0] = (group[1:] != group[:-1]) | (self.tiles[1:] != self.tiles[:-1])
        change[1:, 1:] = ids[1:] != ids[:-1]
        change[0, min(row["before_lcp"] + 1, wide + 1):] = True
        self.mask = np.logical_or.accumulate(change, axis=1)
        valid = lengths[:, None] >= np.arange(wide + 1)
        valid[:, 0] &= self.tiles == 0
        self.valid, self.start = valid, self.mask & valid
        shared = np.append((~self.mask[1:]).sum(axis=1) - 1, row["after_lcp"])
        self.after = row["after_lcp"]
        self.leaf = (~self.more & (shared < lengths)).astype(np.int64)
        new = size * self.start[:, 1:]
        self.all_bytes, self.new_bytes = size.sum(axis=1), new.sum(axis=1)
        # Bytes from each column on that another conversation had first.
        self.saved = np.zeros((n, wide + 1), np.int64)
        self.saved[:, 1:] = np.cumsum((size - new)[:, ::-1], axis=1)[:, ::-1]
        self.saved[:, 0] = self.saved[:, 1] if wide else 0
        self.children = np.zeros((n, wide + 1), np.int64)
        self.children[:, :-1] = self.start[:, 1:]

    def add_later(self, later: list[dict]) -> None:
        """What rows have in later tiles."""
        for item in later:
            r = item["row"]
            self.children[r, -1] = item["child"]
            self.saved[r] += item["all_bytes"] - item["new_bytes"]
            self.leaf[r] = item["leaf"]

    def path(self, r: int, j: int) -> bytes:
        """A digest of the node of row r in column j."""
        lead = self.befores[16 * r:16 * r + 16] + self.raw[16 * int(self.starts[r]):16 * (int(self.starts[r]) + j)]
        return hashlib.blake2b(int(self.tiles[r]).to_bytes(8, "big") + lead, digest_size=16).digest()

    def nodes(self, j: int):
        """Runs of rows of the nodes in column j: (first rows, ends, columns of aggregates, rows that end there)."""
        cut = self.mask[:, j].copy()
        cut[0] = True
        first = np.flatnonzero(cut)
        stop = np.append(first[1:], self.n)
        sums = [np.add.reduceat(v, first) for v in (self.children[:, j], self.leaf, self.saved[:, j],
                                                    ((self.lengths == j) & ~self.more).astype(np.int64))]
        least = np.minimum.reduceat(self.convs, first)
        keep = self.valid[first, j]
        return first[keep], stop[keep], least[keep], [s[keep] for s in sums]

    def beyond(self, first: np.ndarray, stop: np.ndarray, j: int) -> np.ndarray:
        """Which runs belong to nodes that go on outside the block."""
        return (~self.start[first, j]) | ((stop == self.n) & (self.after >= j))

    def ends(self, first: int, count: int) -> str:
        return ",".join(map(str, self.convs[first:first + count].tolist()))


def later_tiles(made: DataFrame, width: int) -> DataFrame:
    """By (shard, number): for rows that go on in another tile, what they have in all later ones."""
    kind = ("long_row boolean, conv long, tile long, shard int, number int, row int, child long, new_bytes long, "
            "all_bytes long, leaf long")
    names = [c.split()[0] for c in kind.split(", ")]

    def run(batches):
        for row in common.rows_of(batches):
            m = Matrix(row, width)
            at, going = np.flatnonzero(m.tiles > 0), np.flatnonzero(m.more)
            rows = np.concatenate([at, going])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(len(rows)) < len(at)), pa.array(m.convs[rows]), pa.array(m.tiles[rows]),
                pa.array(np.full(len(rows), row["shard"], np.int32)), pa.array(np.full(len(rows), row["number"], np.int32)),
                pa.array(rows.astype(np.int32)),
                pa.array(m.start[rows, 1].astype(np.int64) if m.wide else np.zeros(len(rows), np.int64)),
                pa.array(m.new_bytes[rows]), pa.array(m.all_bytes[rows]), pa.array(m.leaf[rows])], names=names)

    told = stage(made.mapInArrow(run, kind), "long-rows")
    sums = ["new_bytes", "all_bytes", "leaf"]
    later = running(told.filter("long_row").select("conv", "tile", "child", *sums), "conv", [F.col("tile").desc()], sums)
    later = later.select("conv", (F.col("tile") - 1).alias("tile"), "child",
                         *[(F.col(s) + F.col(f"before_{s}")).alias(s) for s in sums])
    return (told.filter("not long_row").select("conv", "tile", "shard", "number", "row").join(later, ["conv", "tile"])
            .groupBy("shard", "number").agg(F.collect_list(F.struct("row", "child", *sums)).alias("later")))


def edge_nodes(made: DataFrame, width: int) -> DataFrame:
    """By (shard, number): the nodes that go beyond the block, with the values of the whole node."""
    kind = "shard int, number int, path binary, conv long, n_convs long, n_children long, n_leaves long, saved long, ends string"

    def run(batches):
        for row in common.rows_of(batches):
            m, out = matrix(row, width), []
            for j in range(m.wide + 1):
                first, stop, least, sums = m.nodes(j)
                for i in np.flatnonzero(m.beyond(first, stop, j)).tolist():
                    f, s = int(first[i]), int(stop[i])
                    children, leaves, saved, ending = (int(v[i]) for v in sums)
                    out.append({"shard": row["shard"], "number": row["number"], "path": m.path(f, j), "conv": int(least[i]),
                                "n_convs": s - f, "n_children": children, "n_leaves": leaves, "saved": saved,
                                "ends": m.ends(f, ending) if ending else None})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    def digest(batches):
        path, sha = None, None
        for batch in batches:
            done = []
            for p, ends in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if p != path:
                    if path is not None:
                        done.append({"path": path, "sha": sha.hexdigest()})
                    path, sha = p, hashlib.sha256(ends.encode())
                else:
                    sha.update(b"," + ends.encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("path", pa.binary()), ("sha", pa.string())]))
        if path is not None:
            yield pa.RecordBatch.from_pylist([{"path": path, "sha": sha.hexdigest()}],
                                             schema=pa.schema([("path", pa.binary()), ("sha", pa.string())]))

    schema = pa.schema([("shard", pa.int32()), ("number", pa.int32()), ("path", pa.binary()),
                        *[(c, pa.int64()) for c in ("conv", "n_convs", "n_children", "n_leaves", "saved")], ("ends", pa.string())])
    parts = stage(made.mapInArrow(run, kind), "edge-parts")
    whole = parts.groupBy("path").agg(F.min("conv").alias("conv"), *[
        F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")])
    shas = (parts.filter("ends is not null").select("path", "shard", "number", "ends").repartition("path")
            .sortWithinPartitions("path", "shard", "number").mapInArrow(digest, "path binary, sha string"))
    values = stage(whole.join(shas, "path", "left").withColumn("sha", F.coalesce("sha", F.lit(NO_ENDS))), "edge-nodes")
    return parts.select("shard", "number", "path").join(values, "path").groupBy("shard", "number").agg(
        F.collect_list(F.struct("path", "conv", "n_convs", "n_children", "n_leaves", "saved", "sha")).alias("edges"))


def matrix(row: dict, width: int) -> Matrix:
    m = Matrix(row, width)
    m.add_later(row.get("later") or [])
    return m


def all_nodes(made: DataFrame, width: int) -> DataFrame:
    """Every node once, from the block where it starts.

    The parent of the first nodes of a later tile lies in another block: ``parent_conv_id`` is null there, and rows with a null
    ``n_convs`` tell for each conversation that goes on the node it leaves its tile at.
    """
    def run(batches):
        for row in common.rows_of(batches):
            m = matrix(row, width)
            edges = {bytes(e["path"]): e for e in row["edges"] or []}
            above = None
            for j in range(m.wide + 1):
                first, stop, least, (children, leaves, saved, ending) = m.nodes(j)
                starts, n_convs = m.start[first, j], stop - first
                shas = [hashlib.sha256(m.ends(f, e).encode()).hexdigest() if e else NO_ENDS
                        for f, e in zip(first.tolist(), ending.tolist(), strict=True)]
                for i in np.flatnonzero(m.beyond(first, stop, j)).tolist():
                    e = edges[m.path(int(first[i]), j)]
                    least[i], n_convs[i], children[i], leaves[i], saved[i], shas[i] = (
                        e["conv"], e["n_convs"], e["n_children"], e["n_leaves"], e["saved"], e["sha"])
                here = np.full(m.n, -1, np.int64)
                for_rows = np.repeat(np.arange(len(first)), stop - first)
                rows = np.concatenate([np.arange(f, s) for f, s in zip(first, stop, strict=True)]) if len(first) else for_rows
                here[rows] = least[for_rows]
                known = np.zeros(len(first), bool) if j == 0 else (m.tiles[first] == 0) | (j > 1)
                parent = pa.array(above[first] if above is not None else np.zeros(len(first), np.int64), mask=~known)
                at = np.flatnonzero(starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(least), pa.array(m.tiles[first] * width + j), parent, pa.array(n_convs), pa.array(children),
                    pa.array(leaves), pa.array(saved), pa.array(shas, pa.string())], schema=schema).take(pa.array(at))
                above = here
            going = np.flatnonzero(m.more)
            if len(going):
                none = pa.nulls(len(going), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(m.convs[going]), pa.array((m.tiles[going] + 1) * width), pa.array(above[going]), none, none, none,
                    none, pa.nulls(len(going), pa.string())], schema=schema)

    schema = pa.schema([*[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                    "saved_tokens")], ("ends_sha256", pa.string())])
    told = stage(made.mapInArrow(run, NODES), "nodes")
    leaving = told.filter("n_convs is null").select("conv_id", (F.col("depth") + 1).alias("depth"),
                                                    F.col("parent_conv_id").alias("left_at"))
    nodes = told.filter("n_convs is not null")
    orphan = F.col("parent_conv_id").isNull() & (F.col("depth") > 0)
    return nodes.filter(~orphan).unionByName(
        nodes.filter(orphan).join(leaving, ["conv_id", "depth"]).withColumn("parent_conv_id", F.col("left_at"))
        .select(*nodes.columns))


def trie(turns: DataFrame, width: int = WIDTH, rows: int = ROWS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    made = with_neighbours(blocks(tiles(*rebuilt(turns), width), rows))
    made = stage(made.join(later_tiles(made, width), ["shard", "number"], "left"), "blocks-with-later")
    return all_nodes(made.join(edge_nodes(made, width), ["shard", "number"], "left"), width)


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations."""
    return trie(common.table(spark, folder, "conversations"))


OP12_SQL = r"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first,
    md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as place
  from conversations where conv_id is not null),
c as (
  select conv_id, list(struct_pack(role := role, text := text) order by place) as own,
         xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''),
           lambda x: [ord(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end),
           4294967295) % 9 as h
  from t group by conv_id),
r as (
  select c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) as turns
  from c left join c b on b.conv_id = c.conv_id - c.conv_id % 5),
p as (select conv_id, turns, unnest(range(0, len(turns) + 1)) as depth from r),
g as (
  select turns[1:depth] as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
         string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = len(turns)) as ends
  from p group by all),
k as (select path[1:depth - 1] as above, depth - 1 as at, count(*) as n_children from g where depth > 0 group by all),
n as (
  select g.*, coalesce(k.n_children, 0) as n_children,
         case when g.depth = 0 then 0 else (g.n_convs - 1) * strlen(g.path[g.depth].text) end as own_saved
  from g left join k on k.at = g.depth and k.above = g.path),
s as (
  select a.path, a.depth, count(*) filter (where b.n_children = 0) as n_leaves, sum(b.own_saved)::bigint as saved_tokens
  from n a join n b on b.depth >= a.depth and b.path[1:a.depth] = a.path group by all)
select n.conv_id, n.depth, u.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens,
       sha256(coalesce(n.ends, '')) as ends_sha256
from n join s on s.depth = n.depth and s.path = n.path
left join n u on n.depth > 0 and u.depth = n.depth - 1 and u.path = n.path[1:n.depth - 1]
"""
