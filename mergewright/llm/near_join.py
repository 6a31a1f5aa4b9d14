"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

1. Each text becomes a set of word shingles (see ``shingles``), a digest of the set and a
   signature. Texts with the same set are copies: one class, one row from here on.
2. A forest has ``TRIES`` prefix tries; each sorts the classes by ``LONGEST`` of their ``HASHES`` hash values. Beginning with
   whole prefixes, those that share one are linked; prefixes are then shortened value by value, a bucket whose
   members already lie in one candidate group is passed over, and the others go on until a pair at the threshold itself
   is missed with a chance of ``MISSED`` at most: at 0.8, down to 4 values. That holds for every class, whatever else the
   corpus holds. Subtries of the shortest prefix are the buckets that classes are dealt by, so one shuffle serves all
   lengths. Signatures drop chance meetings, and what is left is told as a
   forest of links, one row a class, never as pairs.
3. Linked classes form candidate groups (connected components). The shingle sets
   of a group meet in blocks, and all pairs of a group, hence all candidate pairs, are
   verified exactly. A task tells for each class how many rows it links to, and a forest of links.
4. Components of verified links are the classes of the result.

Groups and buckets larger than a block are cut into blocks, and each pair of blocks
is a task's work of its own, so no task holds a group; nothing is capped or sampled. Every iteration
ends in a written table. Empty texts (no words) are copies of each other
and linked to nothing else; where one row of a class is kept, only those equal but for white space are. Null ids and repeated rows are rows like any other.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import common, exact_dedup, shingles
from mergewright.sources.staging import stage

HASHES = 128
THRESHOLD = 0.8
#: Chance to miss a pair at the threshold, of the order of what ``CHANCE`` drops.
MISSED = 1e-6
#: Tries, and values of their longest prefixes. Up to HASHES // TRIES values, prefixes of different tries are independent.
TRIES, LONGEST = 32, 8
#: Estimated similarity below which a meeting is taken for chance: over 4 deviations below the threshold.
CHANCE = 0.62
#: Rows of a block; a block of a group also has so many shingles a row at most, on average.
BUCKET_BLOCK, GROUP_BLOCK, SHINGLES_PER_ROW = 2048, 1024, 512
SIGNED = "row long, doc_id long, text_key binary, n_shingles int, digest binary, signature binary"


def text_key() -> F.Column:
    return F.unhex(F.md5(common.text_or_empty("text").cast("binary")))


def wordless_digest(text: str) -> bytes:
    """The digest of a text without words, for itself: equal but for white space, as in exact dedup."""
    return hashlib.blake2b(text.translate(dict.fromkeys(map(ord, common.WHITE))).encode(), digest_size=16, person=b"wordless").digest()


def sign(docs: DataFrame, apart: bool = False) -> DataFrame:
    """One row per row of ``docs``: digest of its shingle set and its signature.

    Texts without words have one digest, or with ``apart`` that of their own text.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       text_key().alias("text_key"), common.text_or_empty("text").alias("text"))

    def run(batches):
        common.forget_worker_cache()
        a, b = shingles.permutations(HASHES)
        for batch in batches:
            for part in common.slices(batch, "text"):
                sets = shingles.shingle_sets(part.column("text"))
                digests = [wordless_digest(part.column("text")[i].as_py()) if apart and not len(s)
                           else hashlib.blake2b(s.tobytes(), digest_size=16).digest() for i, s in enumerate(sets)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("row", "doc_id", "text_key")),
                     pa.array([len(s) for s in sets], pa.int32()),
                     pa.array(digests, pa.binary()),
                     pa.array([shingles.minhash(s, a, b).tobytes() for s in sets], pa.binary())],
                    names=["row", "doc_id", "text_key", "n_shingles", "digest", "signature"])

    return rows.mapInArrow(run, SIGNED)


def representatives(signed: DataFrame) -> DataFrame:
    """One row per distinct shingle set: rep, copies, smallest doc_id, one of its texts, signature."""
    return (signed.groupBy("digest")
            .agg(F.min("row").alias("rep"), F.count("*").alias("copies"), F.min("doc_id").alias("min_doc"),
                 F.max("n_shingles").alias("n_shingles"), F.min(F.struct("row", "text_key", "signature")).alias("one"))
            .select("digest", "rep", "copies", "min_doc", "n_shingles", "one.text_key", "one.signature"))


def blocks(members: DataFrame, sizes: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Deal the rows of each group to pairs of blocks: adds ``left``, ``right`` and ``own`` (the row's block).

    ``sizes`` has the keys and the group's ``size``. A group of at most a block is one pair of a block with itself.
    """
    n = F.ceil(F.col("size") / F.lit(block)).cast("int")
    dealt = (members.join(sizes, keys).withColumn("own", F.pmod(F.xxhash64("rep"), n).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1))))
    return (dealt.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other"))
            .drop("size", "other"))


def runs(batches, keys: list[str]):
    """Rows of each run of equal keys, as one batch; the input is sorted by the keys."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if key != last and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Forest:
    """Candidate groups of the rows of a block: ``group[i]`` is the first row of row i's group."""

    def __init__(self, n: int):
        self.group = np.arange(n)

    def link_rows(self, i: int, others: np.ndarray) -> None:
        """Link row i with all others."""
        groups = np.unique(self.group[np.append(others, i)])
        if len(groups) > 1:
            self.group[np.isin(self.group, groups[1:])] = groups[0]


def missed(s: float, depth: int, tries: int = TRIES) -> float:
    """Chance of a pair of similarity s to share no prefix of ``depth`` in any trie."""
    return (1 - s ** depth) ** tries


def shortest_prefix(threshold: float, most: float = MISSED) -> int:
    """The longest prefix that misses a pair at the threshold with a chance of ``most`` at most, 1 if none does.

    Tries of prefixes up to ``HASHES // TRIES`` share no hash function, so their chances multiply.
    """
    return next((d for d in range(HASHES // TRIES, 1, -1) if missed(threshold, d) <= most), 1)


def grow(signatures: np.ndarray, trie: int, shortest: int, apart: np.ndarray | None = None, longest: int = LONGEST) -> np.ndarray:
    """Groups of rows that share a prefix of one trie, by their first row.

    Rows are sorted by their prefixes of ``longest`` values. Beginning with those, prefixes are shortened value by value; at each
    length, rows that share one and are not yet in one group are compared by their whole signatures, and a run of rows that already
    lies in one group is passed over. ``apart`` tells blocks of which only rows of different ones are compared.
    """
    n = len(signatures)
    prefix = signatures[:, (trie * (HASHES // TRIES) + np.arange(longest)) % HASHES]
    order = np.lexsort(prefix.T[::-1])
    change = np.ones((n, longest), bool)
    change[1:] = prefix[order[1:]] != prefix[order[:-1]]
    new = np.logical_or.accumulate(change, axis=1)
    forest = Forest(n)
    for depth in range(longest, shortest - 1, -1):
        starts = np.flatnonzero(new[:, depth - 1])
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
            if b - a < 2:
                continue
            run = np.sort(order[a:b])
            if (forest.group[run] == forest.group[run[0]]).all():
                continue
            for at, i in enumerate(run[:-1].tolist()):
                rest = run[at + 1:]
                rest = rest[forest.group[rest] != forest.group[i]]
                if apart is not None:
                    rest = rest[apart[rest] != apart[i]]
                if len(rest):
                    forest.link_rows(i, rest[(signatures[rest] == signatures[i]).mean(axis=1) >= CHANCE])
    return forest.group


def meet(members: DataFrame, sizes: DataFrame, shortest: int) -> DataFrame:
    """Links of classes that meet in a trie: rep, root."""
    keys = ["trie", "bucket", "left", "right"]
    dealt = (blocks(members, sizes, ["bucket"], BUCKET_BLOCK).select(*keys, "own", "rep", "signature").repartition(*keys)
             .sortWithinPartitions(*keys, "rep"))

    def run(batches):
        common.forget_worker_cache()
        for table in runs(batches, keys):
            rep, own = table["rep"].to_numpy(), table["own"].to_numpy()
            n = len(rep)
            if n < 2:
                continue
            same_block = table["left"][0].as_py() == table["right"][0].as_py()
            sig = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u2").reshape(n, HASHES)
            root = grow(sig, table["trie"][0].as_py(), shortest, None if same_block else own)
            moved = np.flatnonzero(root != np.arange(n))
            if len(moved):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[moved], pa.int64()), pa.array(rep[root[moved]], pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def candidate_links(reps: DataFrame, threshold: float = THRESHOLD, most: float = MISSED, shortest: int | None = None) -> DataFrame:
    """Links between classes that met; a pair at the threshold is missed with a chance of ``most`` at most.

    Classes are dealt by the shortest prefix that any of them is shortened to, so a task holds whole subtries. ``shortest`` sets
    that length by hand.
    """
    signed = reps.filter("n_shingles > 0").select("rep", "signature")
    shortest = shortest or shortest_prefix(threshold, most)
    step = HASHES // TRIES
    # A prefix longer than a trie's own hash functions goes on in those of the next one.
    value = F.concat("signature", F.substring("signature", 1, 2 * LONGEST))
    filed = signed.select("rep", F.explode(F.sequence(F.lit(0), F.lit(TRIES - 1))).alias("trie"), value.alias("value")).select(
        "rep", "trie", F.xxhash64("trie", F.substring("value", F.col("trie") * (2 * step) + 1, F.lit(2 * shortest))).alias("bucket"))
    filed = stage(filed, "filed")
    sizes = stage(filed.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    shared = filed.join(sizes.select("bucket"), "bucket")
    return stage(meet(shared.join(signed, "rep"), sizes, shortest), "links").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): alternating large-star and small-star steps.

    Each step links a node's neighbours to the least of them. Minima are staged, so the joins are between two
    shuffled tables, which adaptive execution can split at hot nodes.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
                  "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        edges = stage(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .filter("a <> b").distinct(), "edges")
        least = stage(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = edges.join(least, "a")
        edges = stage(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
        if not unfinished(edges):
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))


def unfinished(edges: DataFrame) -> bool:
    """Whether some node has two links upward, or is linked both upward and from below."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return bool(ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
                .filter("up > 1 or (up > 0 and down > 0)").take(1))


def cells_by_size(members: DataFrame, threshold: float) -> DataFrame:
    """Deal the classes of each group to cells of two blocks: adds ``left``, ``right`` and ``own``.

    A group of one block is a cell by itself. The classes of a larger one are first told apart by the size of their sets, in steps of the
    threshold: sets more than one step apart cannot be similar, so their blocks never meet.
    """
    # Long texts count as several rows, so that a block's shingles are bounded as its rows are.
    weight = F.greatest(F.count("*"), F.ceil(F.sum("n_shingles") / F.lit(SHINGLES_PER_ROW))).cast("long")
    large = stage(members.groupBy("component").agg(weight.alias("size")).filter(F.col("size") > GROUP_BLOCK), "large-groups")
    step = F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(-math.log(threshold)) + 1e-9).cast("long")
    small = members.join(large.select("component"), "component", "left_anti").withColumns(
        {c: F.lit(0).cast("long") for c in ("left", "right", "own")})
    rows = members.join(large.select("component"), "component").withColumn("step", step)
    blocks_of = stage(rows.groupBy("component", "step").agg(F.ceil(weight / F.lit(GROUP_BLOCK)).cast("long").alias("n")), "blocks-of-steps")
    own = F.col("step") * (1 << 20) + F.pmod(F.xxhash64("rep"), F.col("n"))
    near = blocks_of.select("component", F.col("step").alias("beside"), F.col("n").alias("others"))
    dealt = (rows.join(blocks_of, ["component", "step"]).withColumn("own", own)
             .withColumn("beside", F.explode(F.sequence(F.col("step") - 1, F.col("step") + 1)))
             .join(near, ["component", "beside"])
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
             .withColumn("other", F.col("other") + F.col("beside") * (1 << 20)))
    dealt = dealt.withColumns({"left": F.least("own", "other"), "right": F.greatest("own", "other")})
    return small.unionByName(dealt.select(*small.columns))


def verify(docs: DataFrame, reps: DataFrame, groups: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All pairs of each candidate group by their shingle sets: rep, root, and rows linked to."""
    members = stage(groups.select(F.col("node").alias("rep"), "component")
                    .join(reps.select("rep", "copies", "n_shingles", "text_key"), "rep"), "members")
    # Only texts that the members need, and few others that the filter takes in, are shuffled.
    wanted = exact_dedup.member_filter(members.select("text_key"))
    texts = (docs.select(text_key().alias("text_key"), common.text_or_empty("text").alias("text")).filter(wanted(F.col("text_key")))
             .groupBy("text_key").agg(F.first("text").alias("text")))

    def to_sets(batches):
        common.forget_worker_cache()
        for batch in batches:
            for part in common.slices(batch, "text"):
                sets = shingles.shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("component", "rep", "copies", "left", "right", "own")),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["component", "rep", "copies", "left", "right", "own", "shingles"])

    dealt = cells_by_size(members, threshold)
    with_sets = (dealt.join(texts, "text_key").select("component", "rep", "copies", "left", "right", "own", "text")
                 .mapInArrow(to_sets, "component long, rep long, copies long, left long, right long, own long, shingles binary"))
    dealt = with_sets.repartition("component", "left", "right").sortWithinPartitions("component", "left", "right", "rep")

    def run(batches):
        common.forget_worker_cache()
        for table in runs(batches, ["component", "left", "right"]):
            rep, own, copies = (table[c].to_numpy() for c in ("rep", "own", "copies"))
            sets = [np.frombuffer(b, "<u8") for b in table["shingles"].to_pylist()]
            one = table["left"][0].as_py() == table["right"][0].as_py()
            linked = similar_pairs(sets, threshold)
            links, forest = np.zeros(len(rep), np.int64), Forest(len(rep))
            for i, others in linked:
                if not one:
                    others = others[own[others] != own[i]]
                links[i] += copies[others].sum()
                np.add.at(links, others, copies[i])
                forest.link_rows(i, others)
            at = np.flatnonzero(links)
            if len(at):
                roots = rep[forest.group[at]]
                yield pa.RecordBatch.from_arrays([pa.array(rep[at], pa.int64()), pa.array(roots, pa.int64()),
                                                  pa.array(links[at], pa.int64())], names=["a", "b", "links"])

    return dealt.select("component", "left", "right", "own", "rep", "copies", "shingles").mapInArrow(
        run, "a long, b long, links long")


def similar_pairs(sets: list[np.ndarray], threshold: float, columns: int = 4096):
    """(i, later members similar to i) by exact intersection counts.

    Members are a 0/1 matrix over the shingles that two of them share; products
    of its column blocks count intersections. Sizes bound the scratch memory.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n == 2:
        common_count = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if common_count >= threshold * (sizes.sum() - common_count) - 1e-9:
            yield 0, np.array([1])
        return
    names, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(n), sizes)
    shared = count[number] > 1
    rank = np.cumsum(count > 1) - 1
    member, column = member[shared], rank[number[shared]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    both = np.zeros((n, n), np.float32)
    for start in range(0, int((count > 1).sum()), columns):
        a, b = np.searchsorted(column, [start, start + columns])
        dense = np.zeros((n, columns), np.float32)
        dense[member[a:b], column[a:b] - start] = 1
        both += dense @ dense.T
    for i in range(n - 1):
        c = both[i, i + 1:].astype(np.int64)
        # The same test as c / (a + b - c) >= threshold, without rounding a quotient.
        hit = np.flatnonzero(c >= threshold * (sizes[i] + sizes[i + 1:] - c) - 1e-9)
        if len(hit):
            yield i, hit + i + 1


def join(docs: DataFrame, threshold: float = THRESHOLD, most: float = MISSED, apart: bool = False) -> tuple[DataFrame, DataFrame]:
    """(signed rows, classes): a class row per shingle set that is linked to another: digest, root, links."""
    signed = stage(sign(docs, apart), "signed")
    reps = stage(representatives(signed), "representatives")
    groups = stage(components(candidate_links(reps, threshold, most)), "groups")
    verified = stage(verify(docs, reps, groups, threshold), "verified")
    classes = components(verified.select("a", "b"))
    links = verified.groupBy("a").agg(F.sum("links").alias("links"))
    linked = stage(classes.join(links, classes["node"] == links["a"]).select(F.col("node").alias("rep"), "component", "links"),
                   "linked")
    return signed, reps.join(linked, "rep", "left").select(
        "digest", "rep", "copies", "min_doc", "n_shingles", "text_key",
        F.coalesce("component", "rep").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))


def classes(docs: DataFrame, threshold: float = THRESHOLD, most: float = MISSED) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links.

    ``class_id`` is the smallest doc_id of the component, ``n_links`` the number of other rows at the threshold or above,
    exact copies included.
    """
    signed, reps = join(docs, threshold, most)
    reps = stage(reps, "classes")
    smallest = stage(reps.groupBy("root").agg(F.min("min_doc").alias("class_id")), "smallest")
    by_digest = stage(reps.join(smallest, "root").select("digest", "class_id", (
        F.col("links") + F.col("copies") - 1).alias("n_links")), "by-digest")
    return signed.select("doc_id", "digest").join(by_digest, "digest").select("doc_id", "class_id", "n_links")


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document."""
    return classes(common.table(spark, folder, "documents"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, most: float = MISSED) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each class, the row with most shingles, then smallest doc_id.

    Rows in no class with another are passed on unchanged; so are texts without words, but for repeats of the same text.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    signed, reps = join(docs, threshold, most, apart=True)
    reps = stage(reps, "classes")
    best = stage(reps.groupBy("root").agg(
        F.min(F.struct((-F.col("n_shingles")).alias("less"), "min_doc", "rep")).alias("best"),
        F.sum("copies").alias("rows")).filter("rows > 1"), "best")
    # By digest: whether it stays; by text: likewise, since equal texts have equal digests.
    chosen = stage(reps.join(best, "root").select("digest", "copies", (F.col("rep") == F.col("best.rep")).alias("stays")),
                   "chosen")
    verdicts = stage(signed.select("text_key", "digest").distinct().join(chosen, "digest").select(
        F.col("text_key").alias("__key"), F.col("digest").alias("__digest"), F.col("copies").alias("__copies"),
        F.col("stays").alias("__stays")), "verdicts")
    # Rows without a verdict pass straight through; the others, and some that the filter takes in, are shuffled once,
    # at every size in the same way.
    maybe = exact_dedup.member_filter(verdicts.select("__key"))
    keyed = docs.withColumn("__key", text_key()).withColumn("__maybe", maybe(F.col("__key")))
    judged = stage(keyed.filter("__maybe").join(verdicts.hint("merge"), "__key", "left").filter(
        "__stays is null or __stays").drop("__maybe", "__stays", "__key"), "judged")
    copies = (judged.filter("__copies > 1").groupBy("__digest")
              .agg(F.min_by(F.struct(*columns), F.struct(F.col("doc_id"), F.col("text"))).alias("kept")).select("kept.*"))
    return (keyed.filter(~F.col("__maybe")).select(*columns)
            .unionByName(judged.filter("__copies is null or __copies = 1").select(*columns)).unionByName(copies))


def near_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return keep_one(docs)


OP10_SQL = r"""
with recursive w as (
  select doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '),
                             lambda x: x <> '') as words from documents),
s as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingle from w),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id
      group by all),
l as (
  select x, y from c join n a on a.doc_id = x join n b on b.doc_id = y where c >= 0.8 * (a.n + b.n - c) - 1e-9
  union all
  select a.doc_id, b.doc_id from w a join w b on a.doc_id < b.doc_id and len(a.words) = 0 and len(b.words) = 0),
e as (select x, y from l union all select y, x from l),
r as (select doc_id, doc_id as other from w union select r.doc_id, e.y from r join e on r.other = e.x)
select w.doc_id, (select min(other) from r where r.doc_id = w.doc_id) as class_id,
       (select count(*) from e where e.x = w.doc_id) as n_links
from w
"""
