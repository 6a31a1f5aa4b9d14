"""Quality rules on documents, and a verdict on each host from the rules' failures.

Rules (``RULES``) ask for the number of words, words in repeated windows of eight words, repeated lines and signs. The first two are base
rules: a document that fails one is not kept. Failures of every rule are counted by host (here ``documents.source``). For
each rule a beta prior is fitted to all hosts' rates, by moments; a host's rate is shrunk towards it. A host is rejected, with all
its documents, if for some rule even the low end of its shrunk rate (``CERTAIN`` deviations below) is above ``LEAST_RATE``
and above what is usual among hosts, the prior's mean plus one deviation. So a small host is spared, and where all hosts are alike, none is rejected for
what all do.

Windows are compared by 64-bit hashes inside the row, so no word is ever shuffled:
windows of a text without repeats are only counted; else they are sorted. Counts are
staged, since they are used twice. The join of host verdicts is an equi-join on
the host, which adaptive execution broadcasts when it is small or splits where one
host is hot. A null text has no words; a null host is a host of its own; repeated rows count each; other columns are not
read, whatever their names. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import common
from mergewright.sources.staging import stage

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_REPEATED_LINES_PERCENT = 20
MAX_SIGNS_PER_100_WORDS = 10
WINDOW = 8
#: A host is never rejected for a rate up to this, nor for one that is not certain by so many deviations.
LEAST_RATE, CERTAIN = 0.25, 1.645
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def covered(starts: Column) -> Column:
    """Words covered by windows that begin at the given ascending positions."""
    steps = F.transform(starts, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - x, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)


def text_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts; ``text`` is replaced by nothing, other columns stay."""
    text = common.text_or_empty("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = (docs.withColumn("__words", words_of(text)).withColumn("__lines", lines)
            .withColumn("n_symbols", F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"))
            .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
            .withColumn("n_lines", F.size("__lines").cast("long")).drop("__lines", "text"))
    n = F.size("__words")
    grams = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                            lambda i: F.xxhash64(F.slice("__words", i, WINDOW))))
    counted = (base.withColumn("n_words", n.cast("long"))
               .withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
               .withColumn("__grams", F.coalesce(grams, F.array().cast("array<bigint>"))).drop("__words"))
    sorted_pairs = F.when(
        F.size(F.array_distinct("__grams")) < F.size("__grams"),
        F.sort_array(F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    marked = counted.withColumn("__pairs", sorted_pairs).drop("__grams")
    pairs = F.col("__pairs")
    same = F.filter(pairs, lambda p, j: (F.get(pairs, j + 1)["g"].eqNullSafe(p["g"]))
                    | (F.get(pairs, j - 1)["g"].eqNullSafe(p["g"])))
    starts = marked.withColumn("__starts", F.sort_array(F.transform(same, lambda p: p["i"]))).drop("__pairs")
    return (starts.withColumn("n_repeat_words", F.coalesce(covered(F.col("__starts")), F.lit(0)).cast("long"))
            .drop("__starts"))


#: What fails each rule; the base rules, and those that only count for a host.
RULES = {
    "short": lambda: F.col("n_words") < MIN_WORDS,
    "repeats": lambda: 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
    "lines": lambda: 100 * F.col("n_dup_lines") > MAX_REPEATED_LINES_PERCENT * F.col("n_lines"),
    "signs": lambda: 100 * F.col("n_symbols") > MAX_SIGNS_PER_100_WORDS * F.col("n_words"),
}
BASE = ("short", "repeats")


def prior(n: int, failed: int, hosts: int, square: float) -> tuple[float, float] | None:
    """(mean, strength) of a beta prior from totals and the sum of failed²/docs over hosts; none without two hosts and both outcomes.

    The mean is the overall rate, the strength follows from the spread of the hosts' rates beyond what chance gives.
    """
    if hosts < 2 or failed in (0, n):
        return None
    mean = failed / n
    spread = (square / n - mean * mean) / (mean * (1 - mean))
    chance = hosts / n
    share = min(max((spread - chance) / max(1 - chance, 1e-9), 1e-6), 0.999)
    return mean, 1 / share - 1


def host_verdicts(counts: DataFrame) -> DataFrame:
    """One row per host: host, ``<rule>_rate`` (shrunk) and ``host_rule``, the first rule it is rejected for.

    ``counts`` has host and ``<rule>_failed``. One row of sums over hosts gives the priors.
    """
    n = F.col("docs")
    hosts = stage(counts.groupBy("host").agg(F.count("*").alias("docs"), *[
        F.sum(F.col(f"{r}_failed").cast("long")).alias(r) for r in RULES]), "hosts")
    sums = hosts.agg(F.sum("docs").alias("n"), F.count("*").alias("hosts"), *[F.sum(r).alias(r) for r in RULES],
                     *[F.sum(F.col(r) * F.col(r) / n).alias(f"{r}_square") for r in RULES]).first()
    rates, rejected = {}, []
    for r in RULES:
        found = prior(sums["n"], sums[r], sums["hosts"], sums[f"{r}_square"]) if sums["n"] else None
        if found is None:
            rates[f"{r}_rate"] = F.col(r) / n
            continue
        mean, strength = found
        usual = mean + (mean * (1 - mean) / (strength + 1)) ** 0.5
        rate = (F.col(r) + F.lit(mean * strength)) / (n + F.lit(strength))
        low = rate - F.lit(CERTAIN) * F.sqrt(rate * (1 - rate) / (n + F.lit(strength + 1)))
        rates[f"{r}_rate"] = rate
        rejected.append(F.when(low > max(LEAST_RATE, usual), F.lit(r)))
    rule = F.coalesce(*rejected, F.lit(None).cast("string"))
    return hosts.select("host", *[c.alias(k) for k, c in rates.items()], rule.alias("host_rule"))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, counts, base_failed, shrunk rates of the host, host_rule, kept."""
    counted = text_counts(docs.select("doc_id", F.col(host).cast("string").alias("host"), "text"))
    counts = stage(counted.withColumns({f"{r}_failed": rule() for r, rule in RULES.items()}), "text-counts")
    verdicts = host_verdicts(counts).withColumnRenamed("host", "rated")
    failed = F.lit(False)
    for r in BASE:
        failed = failed | F.col(f"{r}_failed")
    return (counts.join(verdicts, F.col("host").eqNullSafe(F.col("rated")))
            .select("doc_id", "host", *COUNTS, failed.alias("base_failed"), *[f"{r}_rate" for r in RULES], "host_rule")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_rule").isNull()))


def op7_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judge(common.table(spark, folder, "documents")).select("doc_id", *COUNTS, "base_failed", "kept")


def _rule_sql(rule: str) -> str:
    """The hosts that one rule rejects."""
    return f"""
  select h.source from h, (
    select *, mean + sqrt(mean * (1 - mean) / (k + 1)) as usual from (
      select mean, 1 / least(greatest((spread / (mean * (1 - mean)) - chance) / greatest(1 - chance, 1e-9), 1e-6), 0.999) - 1 as k
      from (select sum({rule}) / sum(n) as mean, sum({rule} * {rule} / n) / sum(n) - (sum({rule}) / sum(n)) ** 2 as spread,
                   count(*) / sum(n) as chance, count(*) as hosts from h)
      where mean > 0 and mean < 1 and hosts >= 2)) q,
    lateral (select (h.{rule} + q.mean * q.k) / (h.n + q.k) as rate) x
  where rate - {CERTAIN} * sqrt(rate * (1 - rate) / (h.n + q.k + 1)) > greatest({LEAST_RATE}, usual)"""


OP7_SQL = r"""
with d as (select doc_id, source, coalesce(text, '') as t from documents),
w as (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
g as (select doc_id, i, list_slice(words, i, i + 7) as gram
      from (select doc_id, words, unnest(range(1, greatest(len(words) - 6, 1))) as i from w)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as c from g) where c > 1),
s as (select doc_id, sum(least(8, coalesce(nxt - i, 8))) as n_repeat_words
      from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from r) group by doc_id),
c as (select w.doc_id, source, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
             (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines,
             coalesce(n_repeat_words, 0)::bigint as n_repeat_words from w left join s using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from c),
h as (select source, count(*) as n, sum((n_words < 20)::int) as short, sum((100 * n_repeat_words > 30 * n_words)::int) as repeats,
             sum((100 * n_dup_lines > 20 * n_lines)::int) as lines, sum((100 * n_symbols > 10 * n_words)::int) as signs
      from b group by source),
bad as (""" + " union all".join(map(_rule_sql, RULES)) + r""")
select b.doc_id, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.base_failed,
       not b.base_failed and not exists (select 1 from bad where bad.source is not distinct from b.source) as kept
from b
"""
