"""MinHash near-deduplication with sequential Bayesian verification.

1. A text becomes the set of its shingles (windows of ``WIDTH`` words), a digest of the set and a signature of
   ``HASHES`` values. Texts with the same set are one class from here on.
2. Signatures are cut into bands of ``BAND`` values. Classes that agree in a whole band are candidates. A pair at the
   threshold agrees in none with a chance of 5e-8 (``(1 - 0.8 ** 4) ** 32``).
3. The signatures of a candidate pair are compared batch by batch. After each batch the posterior chance that
   the pair reaches the threshold is known (uniform prior: binomial likelihood, beta posterior); a pair
   whose chance is below ``MISS`` is dropped. What is left ties classes into candidate groups.
4. Within a group the same comparison leaves few pairs, and these are verified on the full sets, without rounding.
   Pairs that verified links have joined already are not asked again: only the components count.
5. Components of verified links give the result.

Groups are dealt into blocks. First each block is verified by itself, then one class of each component found meets the
others', and last the classes outside a group's largest component meet all the group's, block by block. A group
of near copies thus costs as many comparisons as it has rows, whatever its size; no task holds a group, no pair is
emitted but one link for each class that joins another, and nothing is capped or sampled.

Null or wordless texts have an empty set, are linked with nothing, not with each other either. Rows with an
equal id are rows like any other. A null id is never the smallest; a component of null ids alone has a null id and all its rows
are kept. An empty table gives an empty result; other columns of ``docs`` are not read.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import common, exact_dedup, shingles
from mergewright.llm.near_join import components, runs, text_key
from mergewright.sources.staging import stage

WIDTH = 4
#: Links: ``100 * intersection >= PERCENT * union``.
PERCENT = 80
HASHES, BAND = 128, 4
#: Signature values compared between two looks at the posterior, and the chance below which a pair is given up.
BATCH, MISS = 32, 1e-7
#: Rows of a block of a bucket and of a group, and shingles that count as one row of a group's block.
BUCKET_BLOCK, GROUP_BLOCK, SHINGLES_PER_ROW = 4096, 1024, 512
#: Shingles looked up at a time.
LOOKUP = 1 << 21


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: words between blanks, A-Z lower-cased."""
    words = pc.replace_substring_regex(common.lower_ascii(texts), r"[\x20\x09-\x0D]+", " ")
    trimmed = pc.utf8_trim(words, " ")
    return shingles.window_sets(pc.split_pattern(trimmed, " "), WIDTH)


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """For each batch, the matches below which the posterior chance of reaching the threshold is under ``miss``.

    With a uniform prior, P(similarity >= t | m of n agree) = P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def likely(signatures: np.ndarray, i: int, others: np.ndarray, least: list[int]) -> np.ndarray:
    """Those of ``others`` whose signature comparison with row i is never given up."""
    agreed = np.zeros(len(others), np.int64)
    for turn, low in enumerate(least):
        at = slice(turn * BATCH, (turn + 1) * BATCH)
        agreed = agreed + (signatures[others, at] == signatures[i, at]).sum(axis=1)
        stays = agreed >= low
        others, agreed = others[stays], agreed[stays]
        if not len(others):
            break
    return others


def spread(n: int, linked) -> np.ndarray:
    """The first row of each row's component; ``linked(i, rest)`` gives the rows of ``rest`` linked with i.

    Breadth first: each row is asked once, against the rows that no component has reached yet.
    """
    first, rest = np.arange(n), np.arange(n)
    while len(rest):
        seed, rest = rest[0], rest[1:]
        queue = [seed]
        while queue and len(rest):
            hit = linked(queue.pop(), rest)
            if len(hit):
                first[hit] = seed
                queue.extend(hit.tolist())
                rest = np.setdiff1d(rest, hit, assume_unique=True)
    return first


class Sets:
    """Shingle sets of a block's rows in one array."""

    def __init__(self, blobs: list[bytes]):
        self.sizes = np.array([len(b) // 8 for b in blobs], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.flat = np.frombuffer(b"".join(blobs), "<u8")

    def of(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i] - self.sizes[i]:self.ends[i]]

    def similar(self, i: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Those of ``others`` with 100 * intersection >= percent * union; sizes alone rule out some."""
        own, out = self.of(i), []
        low, high = np.minimum(self.sizes[others], len(own)), np.maximum(self.sizes[others], len(own))
        others = others[100 * low >= percent * high]
        ends = np.cumsum(self.sizes[others])
        at = 0
        while at < len(others):
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] - self.sizes[others[at]] + LOOKUP, "right")))
            some = others[at:stop]
            values = np.concatenate([self.of(j) for j in some.tolist()])
            place = np.minimum(np.searchsorted(own, values), len(own) - 1)
            both = np.add.reduceat((own[place] == values).astype(np.int64),
                                   np.cumsum(self.sizes[some]) - self.sizes[some])
            out.append(some[100 * both >= percent * (self.sizes[some] + len(own) - both)])
            at = stop
        return np.concatenate(out) if out else others[:0]


def sign(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_shingles, digest of the set, signature."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       text_key().alias("text_key"), common.text_or_empty("text").alias("text"))

    def run(batches):
        common.forget_worker_cache()
        a, b = shingles.permutations(HASHES)
        for batch in batches:
            for part in common.slices(batch, "text"):
                sets = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("row", "doc_id", "text_key")),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array([shingles.minhash(s, a, b).tobytes() for s in sets], pa.binary())],
                    names=["row", "doc_id", "text_key", "n_shingles", "digest", "signature"])

    return rows.mapInArrow(run, "row long, doc_id long, text_key binary, n_shingles long, digest binary, signature binary")


def representatives(signed: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: rep, copies, smallest doc_id, one of its texts, signature."""
    return (signed.filter("n_shingles > 0").groupBy("digest")
            .agg(F.min("row").alias("rep"), F.count("*").alias("copies"), F.min("doc_id").alias("min_doc"),
                 F.first("n_shingles").alias("n_shingles"), F.min("text_key").alias("text_key"),
                 F.first("signature").alias("signature")))


def dealt(rows: DataFrame, sizes: DataFrame, key: str, block: int) -> DataFrame:
    """Deal the rows of each key to pairs of blocks: adds ``left``, ``right`` and ``side`` (the row's block).

    ``sizes`` has the key and its ``size``; a key of at most a block is one pair of a block with itself.
    """
    n = F.ceil(F.col("size") / F.lit(block)).cast("int")
    return (rows.join(sizes, key).withColumn("side", F.pmod(F.xxhash64("rep"), n).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumns({"left": F.least("side", "other"), "right": F.greatest("side", "other")}).drop("size", "other"))


def candidate_links(reps: DataFrame, least: list[int]) -> DataFrame:
    """Links (a, b) of classes that share a band and whose signatures stand the comparison."""
    signed = reps.select("rep", "signature")
    filed = stage(signed.select("rep", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)),
        lambda i: F.substring("signature", i * (2 * BAND) + 1, F.lit(2 * BAND)))).alias("band", "value"))
        .select("rep", F.xxhash64("band", "value").alias("bucket")), "bands")
    sizes = stage(filed.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    met = dealt(filed.join(sizes.select("bucket"), "bucket"), sizes, "bucket", BUCKET_BLOCK).join(signed, "rep")

    def run(batches):
        common.forget_worker_cache()
        for table in runs(batches, ["bucket", "left", "right"]):
            n = table.num_rows
            rep, side = table["rep"].to_numpy(), table["side"].to_numpy()
            one = table["left"][0].as_py() == table["right"][0].as_py()
            signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u2").reshape(n, HASHES)

            def linked(i, rest):
                return likely(signatures, i, rest if one else rest[side[rest] != side[i]], least)

            first = spread(n, linked)
            moved = np.flatnonzero(first != np.arange(n))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(rep[moved], pa.int64()), pa.array(rep[first[moved]], pa.int64())],
                                                 names=["a", "b"])

    return stage(met.select("bucket", "left", "right", "side", "rep", "signature").repartition("bucket", "left", "right")
                 .sortWithinPartitions("bucket", "left", "right", "rep").mapInArrow(run, "a long, b long"),
                 "candidate-links").distinct()


def with_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Add ``shingles`` to ``members``: only texts that the members need, and few others, are shuffled."""
    wanted = exact_dedup.member_filter(members.select("text_key"))
    texts = (docs.select(text_key().alias("text_key"), common.text_or_empty("text").alias("text"))
             .filter(wanted(F.col("text_key"))).groupBy("text_key").agg(F.first("text").alias("text")))
    names = [c for c in members.columns if c != "text_key"]

    def run(batches):
        common.forget_worker_cache()
        for batch in batches:
            for part in common.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names),
                     pa.array([s.tobytes() for s in shingle_sets(part.column("text"))], pa.binary())],
                    names=[*names, "shingles"])

    schema = ", ".join(f"{c} {members.schema[c].dataType.simpleString()}" for c in names) + ", shingles binary"
    return members.join(texts, "text_key").select(*names, "text").mapInArrow(run, schema)


def verified(cells: DataFrame, least: list[int], percent: int) -> DataFrame:
    """Links (a, b) within cells: rows of one cell (group, left, right) on different sides, of different parts.

    ``side`` is null where all rows of a cell may meet; ``part`` is the component a class is in already.
    """
    keys = ["group", "left", "right"]

    def run(batches):
        common.forget_worker_cache()
        for table in runs(batches, keys):
            n = table.num_rows
            if n < 2:
                continue
            rep, part = table["rep"].to_numpy(), table["part"].to_numpy()
            side = table["side"].to_numpy(zero_copy_only=False) if not table["side"].null_count else None
            signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u2").reshape(n, HASHES)
            sets = Sets(table["shingles"].to_pylist())

            def linked(i, rest):
                apart = part[rest] != part[i]
                if side is not None:
                    apart &= side[rest] != side[i]
                return sets.similar(i, likely(signatures, i, rest[apart], least), percent)

            first = spread(n, linked)
            moved = np.flatnonzero(first != np.arange(n))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(rep[moved], pa.int64()), pa.array(rep[first[moved]], pa.int64())],
                                                 names=["a", "b"])

    return (cells.select(*keys, "side", "part", "rep", "signature", "shingles").repartition(*keys)
            .sortWithinPartitions(*keys, "rep").mapInArrow(run, "a long, b long"))


def parts_of(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with ``part``: the component of the links that a class is in, else itself."""
    found = stage(components(links), "parts").select(F.col("node").alias("rep"), F.col("component").alias("found"))
    return (rows.drop("part").join(found, "rep", "left").withColumn("part", F.coalesce("found", "rep")).drop("found"))


def verify(docs: DataFrame, reps: DataFrame, groups: DataFrame, least: list[int], percent: int = PERCENT,
           block: int = GROUP_BLOCK) -> DataFrame:
    """Verified links that join exactly the classes which links of the candidate groups join."""
    members = groups.select(F.col("node").alias("rep"), F.col("component").alias("group")).join(
        reps.select("rep", "n_shingles", "text_key", "signature"), "rep")
    # Long texts count as several rows, so that a block's shingles are bounded as its rows are.
    weight = F.greatest(F.count("*"), F.ceil(F.sum("n_shingles") / F.lit(SHINGLES_PER_ROW))).cast("long")
    sizes = stage(members.groupBy("group").agg(weight.alias("size")), "group-sizes")
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    rows = stage(with_sets(docs, members.drop("n_shingles").join(sizes.withColumn("blocks", blocks).drop("size"), "group")
                           .withColumn("left", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))), "group-sets")
    rows = rows.withColumn("part", F.col("rep"))
    nothing = F.lit(None).cast("int")
    links = stage(verified(rows.withColumns({"right": F.col("left"), "side": nothing}), least, percent), "links-in-blocks")
    large = rows.filter("blocks > 1")
    if large.isEmpty():
        return links
    # One class of each component found in a block meets those of the other blocks.
    large = stage(parts_of(large, links), "large-groups")
    pivots = large.filter("part = rep")
    count = stage(pivots.groupBy("group").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("cells")), "pivot-counts")
    cells = pivots.drop("left").join(count, "group").withColumns({
        "left": F.pmod(F.xxhash64("rep", F.lit(1)), F.col("cells")).cast("int"), "side": nothing})
    links = links.unionByName(stage(verified(cells.withColumn("right", F.col("left")), least, percent), "links-of-pivots"))
    # The classes outside the largest component of their group meet all of the group.
    large = stage(parts_of(large, links), "large-groups")
    counted = large.groupBy("group", "part").agg(F.count("*").alias("n"))
    most = stage(counted.groupBy("group").agg(F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("total"))
                 .select("group", F.col("top.part").alias("main"), (F.col("total") - F.col("top.n")).alias("others"))
                 .filter("others > 0").withColumn("cells", F.ceil(F.col("others") / F.lit(block)).cast("int")), "main-parts")
    open_rows = large.join(most, "group")
    outside = (open_rows.filter("part <> main").withColumns({
        "left": F.pmod(F.xxhash64("rep", F.lit(2)), F.col("cells")).cast("int"), "side": F.lit(0)})
        .withColumn("right", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    inside = (open_rows.withColumns({"right": F.col("left"), "side": F.lit(1)})
              .withColumn("left", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))))
    return links.unionByName(stage(verified(outside.unionByName(inside.select(*outside.columns)), least, percent),
                                   "links-outside"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, miss: float = MISS, block: int = GROUP_BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    least = least_matches(percent, miss)
    signed = stage(sign(docs), "signed")
    reps = stage(representatives(signed), "representatives")
    groups = stage(components(candidate_links(reps, least)), "groups")
    classes = stage(components(verify(docs, reps, groups, least, percent, block)), "classes")
    joined = stage(reps.join(classes.withColumnRenamed("node", "rep"), "rep", "left").filter(
        "copies > 1 or component is not null").select(
        "digest", "min_doc", F.coalesce("component", "rep").alias("root")), "joined")
    smallest = stage(joined.groupBy("root").agg(F.min("min_doc").alias("component_id")), "smallest")
    by_digest = stage(joined.join(smallest, "root").select("digest", "component_id"), "by-digest")
    rows = signed.select("doc_id", "n_shingles", "digest")
    found = (rows.filter("n_shingles > 0").join(by_digest, "digest", "left")
             .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
    return (found.unionByName(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def op11_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return near_duplicates(common.table(spark, folder, "documents"))


OP11_SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') as words from documents),
s as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 4 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) end) as shingle from w),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id
      group by all),
l as (select x, y from c join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)),
e as (select x, y from l union all select y, x from l),
r as (select doc_id, doc_id as other from w union select r.doc_id, e.y from r join e on r.other = e.x)
select w.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id, w.doc_id = m.component_id as kept
from w left join n using (doc_id) join (select doc_id, min(other) as component_id from r group by doc_id) m using (doc_id)
"""
