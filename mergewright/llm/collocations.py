"""Phrases that occur more often than their parts let expect: exact counts by hashed tallies (PCY), length by length.

1. Each task cuts whole texts into pieces and words and writes blocks: numbers of words in a row of ``BLOCK_WORDS`` at most, with
   the block's vocabulary.
2. For each length from one word on, each task adds up all occurrences of phrases in one table of slots, by the phrase's hash; the tables of all
   tasks are summed. A phrase with ``support`` occurrences lies in a slot whose sum reaches it; only phrases of such slots are counted, in
   all blocks, exactly. What leaves a task is one table, whatever the number of blocks and of phrases; the number of tasks is fixed. A phrase of more
   words is only looked at where both parts that lack its first and its last word are known to be frequent everywhere.
3. Slots reach the tasks as a bitmap (16 MB at most), frequent phrases as a Bloom filter of bounded size (64 MB at most). Either may let a
   phrase in that is not frequent; it is counted exactly like the others and falls short of the support.
4. Cuts, scores and ranks are joins over the frequent phrases alone. Parts of a frequent phrase are frequent, so
   their counts are all there. Scores are computed in decimals of 38 digits.

In a block a phrase is told by the numbers of its words; across blocks by its text. A null language is ``und``, a null text
empty; repeated rows count each; ties of score and count go by the phrase's bytes; an empty table gives an empty result. Other columns are
not read. A text longer than a block runs on in the next one, with its last words repeated as context, so no phrase is lost or counted twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergewright.llm import common, exact_dedup
from mergewright.llm.shingles import MULTIPLIER, mix
from mergewright.sources.staging import stage

SUPPORT, LONGEST, TOP = 100, 5, 2000
BLOCK_WORDS = 2 << 20
#: Positions that are looked up or given out at a time, and shares of first words that are told apart one after the other.
LOOKUP, SHARES = 1 << 17, 16
BREAK = "\n"
#: Occurrences a slot is to hold on average, slots at least and at most, and the pieces in which a table of slots leaves its task.
SLOT_LOAD, LEAST_SLOTS, MOST_SLOTS, PIECES = 16, 1 << 16, 1 << 27, 64
#: Tasks that go through the blocks, for each core.
TASKS_PER_CORE = 4
#: Rows of counted phrases that a task adds up over its blocks before it gives them out.
HELD_ROWS = 1 << 17


def words_of(texts: pa.Array) -> pa.ListArray:
    """Words of each text, with a break (a line feed, in no word) at the end of each piece and of the text."""
    lowered = common.lower_ascii(texts)
    marked = pc.replace_substring_regex(lowered, r"[.,;:!?\x0A-\x0D]", " \n ")
    closed = pc.binary_join_element_wise(marked, *(pa.scalar(x, pa.large_string()) for x in (BREAK, " ")))
    return pc.split_pattern(pc.utf8_trim(pc.replace_substring_regex(closed, r"[\x20\x09]+", " "), " "), " ")


def packed(ids: np.ndarray, kind: type = np.int32) -> bytes:
    """Numbers, compressed: a batch of blocks on its way to a task is held several times over."""
    data = ids.astype(kind, copy=False).tobytes()
    return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def unpacked(data: bytes, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little")), kind)


class Filling:
    """A block in the making: word numbers (0: break) and the vocabulary of each language."""

    def __init__(self):
        self.known: dict[str, dict[str, int]] = {}
        self.words: list[str] = []
        self.langs: list[str] = []
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, codes: np.ndarray, dictionary: np.ndarray) -> None:
        """Words of texts of one language, as places in a dictionary."""
        some, inverse = np.unique(codes, return_inverse=True)
        known = self.known.setdefault(lang, {BREAK: 0})
        numbers = np.empty(len(some), np.int32)
        for i, word in enumerate(dictionary[some].tolist()):
            number = known.get(word)
            if number is None:
                number = known[word] = len(self.words) + 1
                self.words.append(word)
                self.langs.append(lang)
            numbers[i] = number
        self.ids.append(numbers[inverse])
        self.size += len(codes)

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        import xxhash

        names = list(dict.fromkeys(self.langs))
        place = {lang: i for i, lang in enumerate(names)}
        own = np.fromiter((place[x] for x in self.langs), np.int32, len(self.langs))
        hashes = b"".join(xxhash.xxh3_128_digest(f"{x}\n{w}") for x, w in zip(self.langs, self.words, strict=True))
        return pa.RecordBatch.from_arrays([
            pa.array([names], pa.list_(pa.string())), pa.array([own.tobytes()], pa.binary()), pa.array([hashes], pa.binary()),
            pa.array(["\n".join(self.words)], pa.large_string()).cast(pa.string()),
            pa.array([packed(np.concatenate(self.ids))], pa.binary())], schema=schema)


def blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks of word numbers: langs, word_langs, hashes (of language and word), words, ids."""
    schema = pa.schema([("langs", pa.list_(pa.string())), ("word_langs", pa.binary()), ("hashes", pa.binary()),
                        ("words", pa.string()), ("ids", pa.binary())])

    def run(batches):
        common.forget_worker_cache()
        filling = Filling()
        for batch in batches:
            for part in common.slices(batch, "text"):
                words = words_of(part.column("text"))
                coded = words.flatten().dictionary_encode()
                dictionary = coded.dictionary.to_numpy(zero_copy_only=False)
                codes = coded.indices.to_numpy()
                lengths = np.diff(words.offsets.to_numpy())
                langs = part.column("lang").dictionary_encode()
                own = np.repeat(langs.indices.to_numpy(), lengths)
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    some = codes[own == i]
                    at = 0
                    while at < len(some):
                        # All of it, or what the block still holds, cut at any word: the next block starts with the
                        # words before the cut as context (see ``Block``).
                        room = max(1, block_words - filling.size)
                        filling.add(lang, some[at:at + room], dictionary)
                        at += room
                        if filling.size >= block_words:
                            yield filling.row(schema)
                            filling = Filling()
                            common.free_memory()
                            if at < len(some):
                                lead = some[max(0, at - LONGEST + 1):at]
                                filling.add(lang, lead, dictionary)
                                filling.ids.append(np.array([-len(lead)], np.int32))
        if filling.size:
            yield filling.row(schema)

    return (docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        common.text_or_empty("text").alias("text"))
            .mapInArrow(run, "langs array<string>, word_langs binary, hashes binary, words string, ids binary"))


def staged_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks, written once, read by a fixed number of tasks, ``TASKS_PER_CORE`` for each core.

    A table of slots leaves each task and its size grows with the corpus; were there more tasks too, all tables together would grow with its square.
    """
    return stage(blocks(docs, block_words), "word-blocks").coalesce(
        TASKS_PER_CORE * docs.sparkSession.sparkContext.defaultParallelism)


class Block:
    """A block read back. ``counted[p]`` tells whether a phrase ending at position p belongs to this block."""

    def __init__(self, row: dict):
        self.langs = row["langs"]
        self.text, self.split = row["words"], None
        self.word_langs = np.frombuffer(row["word_langs"], np.int32)
        ids = unpacked(row["ids"])
        # A negative number says how many words before it are the end of the block before: phrases that end in them were counted there.
        mark = np.flatnonzero(ids < 0)
        self.lead = -int(ids[mark[0]]) if len(mark) else 0
        self.ids = np.delete(ids, mark) if len(mark) else ids
        n = len(self.word_langs)
        self.high, self.low = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        self.high[1:], self.low[1:] = np.frombuffer(row["hashes"], ">u8").reshape(-1, 2).T
        self.sizes = np.bincount(self.word_langs[self.ids[self.lead:][self.ids[self.lead:] > 0] - 1], minlength=len(self.langs))

    def hashes(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of the phrases of ``length`` words at positions ``at``."""
        words = [self.ids[at + k] for k in range(length)]
        return chained(np.stack([self.high[w] for w in words], axis=1), np.stack([self.low[w] for w in words], axis=1))

    def inside(self, slots: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """Whether the slots of the phrases at positions ``at`` are in a bitmap."""
        out = np.empty(len(at), bool)
        for a in range(0, len(at), LOOKUP):
            slot = slot_of(self.hashes(at[a:a + LOOKUP], length)[1], 8 * len(slots))
            out[a:a + LOOKUP] = (slots[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        return out

    def places(self, length: int, known: np.ndarray | None) -> np.ndarray:
        """Positions of all phrases of ``length`` words.

        With ``known``, a filter of the frequent phrases of one word less, only phrases whose two parts of that length are in it.
        """
        n = max(0, len(self.ids) - length + 1)
        ok = self.ids > 0
        fits = ok[:n].copy()
        for k in range(1, length):
            fits &= ok[k:n + k]
        fits[:max(0, self.lead - length + 1)] = False
        if length == 2 and known is not None:
            frequent = np.concatenate([[False], held(known, *self.word_hashes())])[self.ids]
            fits &= frequent[:n] & frequent[1:n + 1]
        elif known is not None:
            shorter = np.zeros(n + 1, bool)
            shorter[:n] = fits
            shorter[1:] |= fits
            for a in range(0, n + 1, LOOKUP):
                ask = np.flatnonzero(shorter[a:a + LOOKUP]) + a
                shorter[ask] = held(known, *self.hashes(ask, length - 1))
            fits &= shorter[:n] & shorter[1:]
        return np.flatnonzero(fits).astype(np.int32)

    def phrases(self, length: int, known: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of one occurrence of each distinct phrase of ``length`` words (see ``places``), and their numbers of occurrences.

        Phrases are told apart a share of the first words at a time, so scratch memory is a part of the block.
        """
        at = self.places(length, known)
        share = (self.ids[at] % SHARES).astype(np.int8)
        for i in range(SHARES):
            some = at[share == i]
            # Equal phrases get equal numbers: a phrase is its first words' number and its last word.
            number = self.ids[some].astype(np.int64)
            for k in range(1, length):
                number *= len(self.high)
                number += self.ids[some + k]
                if k < length - 1:
                    number = np.unique(number, return_inverse=True)[1]
            _, first, times = np.unique(number, return_index=True, return_counts=True)
            if len(first):
                yield some[first], times

    def word_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        return chained(self.high[1:, None], self.low[1:, None])

    def lang_of(self, at: np.ndarray) -> np.ndarray:
        return self.word_langs[self.ids[at] - 1]

    def texts(self, at: np.ndarray, length: int) -> pa.Array:
        if self.split is None:
            self.split = pc.split_pattern(pa.array([self.text]), "\n").flatten()
        columns = [self.split.take(pa.array(self.ids[at + k] - 1)) for k in range(length)]
        return pc.binary_join_element_wise(*columns, " ") if length > 1 else columns[0]


def chained(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each row of word hashes."""
    out_high = out_low = np.full(len(high), high.shape[1], np.uint64)
    for k in range(high.shape[1]):
        out_high = mix((out_high + high[:, k]) * MULTIPLIER)
        out_low = mix((out_low ^ low[:, k]) * MULTIPLIER)
    return out_high, out_low


def held(filter_bits: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Whether hashes are in a filter, with the bits of ``exact_dedup.positions``."""
    bits = np.uint64(8 * len(filter_bits))
    ok = np.ones(len(high), bool)
    for i in range(exact_dedup.HASHES):
        bit = (high + np.uint64(i) * (low | np.uint64(1))) % bits
        ok &= (filter_bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return ok


def keys_of(high: np.ndarray, low: np.ndarray) -> pa.Array:
    """Hashes as binaries of 16 bytes."""
    data = np.stack([high, low], axis=1).astype("<u8").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(high), [None, pa.py_buffer(np.arange(0, 16 * len(high) + 1, 16, dtype=np.int32)),
                                                          pa.py_buffer(data)])


def filter_of(keys: DataFrame, filter_bytes: int):
    """A broadcast Bloom filter of the column ``key``, of bounded size."""
    bits = exact_dedup.bits_for(keys.count(), filter_bytes)
    return keys.sparkSession.sparkContext.broadcast(exact_dedup.filter_bits(keys.select("key"), bits, "seen"))


def slots_for(words: int) -> int:
    """A power of two."""
    return min(max(LEAST_SLOTS, 1 << (words // SLOT_LOAD).bit_length()), MOST_SLOTS)


def slot_of(low: np.ndarray, slots: int) -> np.ndarray:
    return (low & np.uint64(slots - 1)).astype(np.int64)


def tallied(made: DataFrame, length: int, known, slots: int, support: int) -> DataFrame:
    """Occurrences of phrases by slot: piece, counts (``packed``); each task gives out its own table, in pieces. Sums stop at the type's end.

    Most counts are small: zstd's codes for them take a part of what the shuffle's own compression does.
    """
    kind, piece = np.uint8 if support < 256 else np.uint32, slots // PIECES

    def run(batches):
        common.forget_worker_cache()
        counts = None
        for row in common.rows_of(batches):
            block = Block(row)
            del row
            if counts is None:
                counts = np.zeros(slots, kind)
            at = block.places(length, known and known.value)
            for a in range(0, len(at), LOOKUP):
                slot, n = np.unique(slot_of(block.hashes(at[a:a + LOOKUP], length)[1], slots), return_counts=True)
                counts[slot] = np.minimum(counts[slot] + n, np.iinfo(kind).max)
            del block
            common.free_memory()
        for i in range(PIECES if counts is not None else 0):
            some = counts[i * piece:(i + 1) * piece]
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed(some, kind)], pa.binary())], names=["piece", "counts"])

    return made.mapInArrow(run, "piece int, counts binary")


def full_slots(made: DataFrame, length: int, known, slots: int, support: int):
    """A broadcast bitmap of the slots with ``support`` occurrences over all blocks."""
    kind, piece = np.uint8 if support < 256 else np.uint32, slots // PIECES

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for row in common.rows_of(batches):
            counts = unpacked(row["counts"], kind)
            had = sums.get(row["piece"])
            # The greatest number stands for all beyond it.
            sums[row["piece"]] = counts if had is None else np.where(counts > np.iinfo(kind).max - had, np.iinfo(kind).max, counts + had).astype(kind)
        for i, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([np.packbits(
                counts >= support, bitorder="little").tobytes()], pa.binary())], names=["piece", "bits"])

    out = np.zeros(slots // 8, np.uint8)
    merged = tallied(made, length, known, slots, support).repartition("piece").mapInArrow(add, "piece int, bits binary")
    # At once, 16 MB at most: row by row each partition would be a job of its own.
    for row in merged.collect():
        out[row["piece"] * piece // 8:(row["piece"] + 1) * piece // 8] = np.frombuffer(row["bits"], np.uint8)
    return made.sparkSession.sparkContext.broadcast(out)


def added_up(parts: list[pa.Table]) -> pa.Table:
    """One row per language and phrase."""
    # Arrow's threads would each hold a table and memory of their own.
    sums = pa.concat_tables(parts).group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")])
    return sums.rename_columns({"f_sum": "f"}).select(["lang", "phrase", "f"])


def counted_in_tasks(made: DataFrame, length: int, known, full, held_rows: int = HELD_ROWS) -> DataFrame:
    """Occurrences in a task's blocks of the phrases of full slots: lang, phrase, f.

    A task adds up its blocks, so a phrase leaves it once, not once a block, as long as ``held_rows`` rows hold its phrases.
    """
    def run(batches):
        common.forget_worker_cache()
        parts, rows = [], 0
        for row in common.rows_of(batches):
            block = Block(row)
            del row
            langs = pa.array(block.langs, pa.string())
            for at, counts in block.phrases(length, known and known.value):
                keep = block.inside(full.value, at, length)
                at, counts = at[keep], counts[keep]
                if len(at):
                    parts.append(pa.table([langs.take(pa.array(block.lang_of(at))), block.texts(at, length).cast(pa.string()),
                                           pa.array(counts.astype(np.int64))], names=["lang", "phrase", "f"]))
                    rows += len(at)
                if rows > held_rows:
                    parts = [added_up(parts)]
                    rows = parts[0].num_rows
                    # Too many different phrases: adding up each time would take more than it saves.
                    if rows > held_rows * 3 // 4:
                        yield from parts[0].to_batches()
                        parts, rows = [], 0
            del block
            common.free_memory()
            if len(parts) > 1:
                parts = [added_up(parts)]
                rows = parts[0].num_rows
        if parts:
            yield from added_up(parts).to_batches()

    return made.mapInArrow(run, "lang string, phrase string, f long")


def counted(made: DataFrame, length: int, known, full) -> DataFrame:
    """Occurrences in all blocks of the phrases of full slots: lang, phrase, f."""
    return counted_in_tasks(made, length, known, full).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def keyed(level: DataFrame) -> DataFrame:
    """The keys of phrases, as ``Block.hashes`` has them at their positions."""
    def run(batches):
        import xxhash

        common.forget_worker_cache()
        for batch in batches:
            out = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                values = [xxhash.xxh3_128_intdigest(f"{lang}\n{w}") for w in phrase.split(" ")]
                out.append((len(values), [v >> 64 for v in values], [v & 0xFFFFFFFFFFFFFFFF for v in values]))
            length = out[0][0] if out else 1
            words = (np.array([o[i] for o in out], np.uint64).reshape(-1, length) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([keys_of(*chained(*words))], names=["key"])

    return level.select("lang", "phrase").mapInArrow(run, "key binary")


def sizes(made: DataFrame) -> DataFrame:
    """Words of each language: lang, n."""
    def run(batches):
        for row in common.rows_of(batches):
            block = Block(row)
            yield pa.RecordBatch.from_arrays([pa.array(block.langs, pa.string()), pa.array(block.sizes.astype(np.int64))],
                                             names=["lang", "n"])

    return made.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, block_words: int = BLOCK_WORDS,
             filter_bytes: int = exact_dedup.FILTER_BYTES) -> tuple[DataFrame, DataFrame]:
    """(phrases, words): lang, words, phrase, f of all phrases with the support; lang, n."""
    if longest > LONGEST:
        raise ValueError(f"phrases of {LONGEST} words at most")
    made = staged_blocks(docs, block_words)
    by_lang = stage(sizes(made), "words-by-language")
    slots = slots_for(by_lang.agg(F.sum("n")).first()[0] or 0)
    found, known = None, None
    for length in range(1, longest + 1):
        full = full_slots(made, length, known, slots, support)
        level = stage(counted(made, length, known, full).filter(F.col("f") >= support), "frequent")
        full.unpersist()
        if known is not None:
            known.unpersist()
        rows = level.select("lang", F.lit(length).alias("words"), "phrase", "f")
        found = rows if found is None else found.unionByName(rows)
        known = filter_of(stage(keyed(level), "frequent-keys"), filter_bytes)
    return found, by_lang


def part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(phrases: DataFrame, by_lang: DataFrame) -> DataFrame:
    """Lowest-scoring cut of each phrase of two words or more: lang, words, phrase, a, l, r, n, score."""
    words = F.split("phrase", " ")
    cut = (phrases.filter("words > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
           .select("lang", "words", "phrase", F.col("f").alias("a"), "cut", part(words, 1, F.col("cut")).alias("first"),
                   part(words, F.col("cut") + 1, F.col("words") - F.col("cut")).alias("rest")))
    for name, column in (("first", "l"), ("rest", "r")):
        cut = cut.join(phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(column)), ["lang", name])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    cut = cut.join(by_lang, "lang").withColumn("top", wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)")).withColumn(
        "bottom", wide["l"] * wide["r"]).withColumn("score", F.expr("top div bottom"))
    return (cut.groupBy("lang", "words", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
            .select("lang", "words", "phrase", "a", "best.l", "best.r", "n", F.col("best.score").alias("score")))


def without_covered(rows: DataFrame, phrases: DataFrame) -> DataFrame:
    """Leave out phrases that a longer one holds as often as they occur.

    A phrase of one word more tells them all: if a longer one is as frequent, so is the one in between.
    """
    words, n = F.split("phrase", " "), F.col("words")
    cover = (phrases.filter("words > 2").select("lang", "f", F.explode(F.array(
        part(words, 1, n - 1), part(words, 2, n - 1))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("cover")))
    return rows.join(cover, ["lang", "phrase"], "left").filter("cover is null or cover < a").drop("cover")


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, longest: int = LONGEST,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    phrases, by_lang = frequent(docs, support, longest, block_words)
    best = stage(without_covered(scored(phrases, by_lang), phrases), "collocations")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Each language's strongest collocations over all documents."""
    return collocations(common.table(spark, folder, "documents"))


OP13_SQL = r"""
with p as (
  select coalesce(lang, 'und') as lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as words
  from (select lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents)),
n as (select lang, sum(len(words))::bigint as n from p group by lang),
g as (
  select lang, k, array_to_string(words[i:i + k - 1], ' ') as phrase
  from (select lang, words, k, unnest(range(1, len(words) - k + 2)) as i from p, (select unnest(range(1, 6)) as k))),
f as (select lang, k, phrase, count(*) as f from g group by all having count(*) >= 100),
c as (
  select lang, k, phrase, f as a, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') as first,
         array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') as rest
  from (select *, unnest(range(1, k)) as cut from f where k > 1)),
s as (
  select c.lang, c.k, c.phrase, c.a, c.cut, x.f as l, y.f as r, n.n,
         ((1000::hugeint * c.a * n.n) // (x.f::hugeint * y.f))::bigint as score
  from c join f x on x.lang = c.lang and x.phrase = c.first join f y on y.lang = c.lang and y.phrase = c.rest
  join n on n.lang = c.lang),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
v as (
  select lang, array_to_string(words[i:i + m - 1], ' ') as phrase, max(f) as f from (
    select lang, f, words, m, unnest(range(1, k - m + 2)) as i from (
      select lang, f, k, string_split(phrase, ' ') as words, unnest(range(2, k)) as m from f where k > 2)) group by all),
r as (
  select b.*, row_number() over (partition by b.lang order by score desc, a desc, encode(b.phrase)) as rank
  from b left join v on v.lang = b.lang and v.phrase = b.phrase where v.f is null or v.f < b.a)
select lang, rank, phrase, a, l, r, n, score from r where rank <= 2000
"""
