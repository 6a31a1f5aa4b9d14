"""URL filter: rules, then a cascade of Bloom filters over the corpus's own keys.

The key universe is every domain suffix of every host in the corpus. Level 1
encodes the listed keys; level 2 encodes those unlisted keys of the universe
that level 1 takes for listed; level 3 those listed keys that level 2 takes in;
and so on until a level makes no mistake. A key is then judged by the first
level that lacks it, which is exact for every key of the universe: no join is
needed to ask. The filters are a written table of one row a level; a query takes each bitmap from
it once, by a scalar subquery, however many bits it asks for.

Size bound: the cascade holds some bits per listed key and per expected mistake, whatever
the size of the corpus; ``MAX_BYTES`` is checked as levels are built. Beyond it
build several cascades, each over a share of the list.

A null url, or one without ``://``, has an empty host and path; no rule fits it and it is
allowed. Repeated rows are judged each; other columns are not read, whatever their names; no pages give no rows. Only
DataFrame functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm import common
from mergewright.sources.staging import stage

MAX_BYTES = 64 << 20
#: Share of mistakes of the levels after the first.
LATER_RATE = 1 / 16
#: Bits of one bitmap of Spark's bitmap functions.
BUCKET = 32_768
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict): fixed values of the query.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Domain names whose domains the query lists.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_LABELS = 3


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    column = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    mark = F.instr(column, "://")
    rest = F.when(mark > 0, F.substring(column, mark + 3, F.length(column))).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def suffixes(host: Column, labels: int) -> Column:
    """The domains of a host with up to ``labels`` labels, the host itself if it has no more."""
    return F.array_remove(F.array_distinct(
        F.array(*[F.substring_index(host, ".", -i) for i in range(1, labels + 1)])), "")


@dataclass
class Cascade:
    """Levels as (bits, hashes, written table of the one bitmap)."""

    levels: list[tuple[int, int, DataFrame]] = field(default_factory=list)

    def in_level(self, key: Column, level: int) -> Column:
        bits, hashes, table = self.levels[level]
        bitmap = table.scalar()
        # Bits are looked up one after the other, until one is missing.
        found = F.lit(True)
        for at in reversed(bit_positions(key, level, bits, hashes)):
            byte = F.ascii(F.decode(F.substring(bitmap, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
            found = F.when(F.getbit(byte.cast("bigint"), (at % 8).cast("int")) == 1, found).otherwise(F.lit(False))
        return found

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level that lacks it decides."""
        n = len(self.levels)
        answer = F.lit(n % 2 == 1)
        for level in reversed(range(n)):
            answer = F.when(~self.in_level(key, level), F.lit(level % 2 == 1)).otherwise(answer)
        return answer

    def size(self) -> int:
        return sum(-(-bits // 8) for bits, _, _ in self.levels)


def bit_positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    size = F.lit(bits).cast("bigint")
    first, step = F.pmod(F.xxhash64(key, F.lit(level)), size), F.pmod(F.xxhash64(F.lit(level), key), size)
    return [(first + F.lit(i) * step) % size for i in range(hashes)]


def bitmap_of(keys: DataFrame, level: int, bits: int, hashes: int) -> DataFrame:
    """Bitmaps are built by aggregation; the driver puts the finished filter together, of a checked size, and writes it."""
    rows = (keys.select(F.explode(F.array(*bit_positions(F.col("key"), level, bits, hashes))).alias("at"))
            .groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bitmap")).collect())
    out = bytearray(-(-bits // BUCKET) * BUCKET // 8)
    for row in rows:
        start = (row.bucket - 1) * BUCKET // 8
        out[start:start + len(row.bitmap)] = row.bitmap
    spark = keys.sparkSession
    return stage(spark.createDataFrame([(bytes(out[:-(-bits // 8)]),)], "bitmap binary"), "bitmap")


def build(universe: DataFrame, listed: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """A cascade that tells keys of ``listed`` from all other keys of ``universe`` (both: a column ``key``).

    Repeated and null keys are allowed. Each later level covers a small share of the keys of
    the level before the last, so levels are few and each pass reads the staged keys once.
    """
    keys = stage(universe.select("key", F.lit(False).alias("listed"))
                 .unionByName(listed.select("key", F.lit(True).alias("listed")))
                 .filter("key is not null").groupBy("key").agg(F.max("listed").alias("listed")), "keys")
    counts = {row.listed: row["count"] for row in keys.groupBy("listed").count().collect()}
    inside, outside = counts.get(True, 0), counts.get(False, 0)
    cascade = Cascade()
    sides = {True: keys.filter("listed"), False: keys.filter("not listed")}
    side = True
    while inside:
        level = len(cascade.levels)
        rate = min(0.5, 0.5 * inside / max(outside, 1)) if level == 0 else LATER_RATE
        hashes = max(1, round(-math.log2(rate)))
        bits = max(64, math.ceil(inside * hashes / math.log(2)))
        if cascade.size() + bits // 8 > max_bytes:
            raise ValueError(f"the list needs a filter of more than {max_bytes} bytes: split it into several cascades")
        cascade.levels.append((bits, hashes, bitmap_of(sides[side], level, bits, hashes)))
        sides[not side] = sides[not side].filter(cascade.in_level(F.col("key"), level))
        inside, outside = sides[not side].count() if outside else 0, inside
        side = not side
    return cascade


def judge(pages: DataFrame, cascade: Cascade, labels: int,
          rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed: the longest fitting rule decides, else the cascade.

    A rule fits its host and all subdomains if the path starts with its path.
    """
    host, path = host_and_path("url")
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))

    def first_fit(value):
        chosen = F.lit(None).cast("string")
        for rule in reversed(ordered):
            fits = (((F.col("host") == rule[0]) | F.col("host").endswith(f".{rule[0]}"))
                    & F.col("path").startswith(rule[1]))
            chosen = F.when(fits, F.lit(value(rule))).otherwise(chosen)
        return chosen

    # Domain by domain: a scalar subquery cannot stand inside a function of an array's elements.
    listed = F.lit(False)
    for i in range(1, labels + 1):
        domain = F.substring_index("host", ".", -i)
        listed = listed | ((domain != "") & cascade.contains(domain))
    return (parsed.withColumn("rule", first_fit(lambda r: r[0] + r[1])).withColumn("listed", listed)
            .withColumn("verdict", F.coalesce(first_fit(lambda r: r[2]),
                                              F.when(F.col("listed"), "block").otherwise("allow"))))


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Judge every page's url; listed are the domains of three labels whose first is one of LISTED_NAMES."""
    pages = common.table(spark, folder, "pages").select("page_id", "url")
    universe = pages.select(F.explode(suffixes(host_and_path("url")[0], LISTED_LABELS)).alias("key"))
    is_listed = (F.size(F.split("key", r"\.")) == LISTED_LABELS) & F.substring_index("key", ".", 1).isin(*LISTED_NAMES)
    return judge(pages, build(universe, universe.filter(is_listed)), LISTED_LABELS)


OP1_SQL = r"""
with u as (
  select page_id, case when instr(coalesce(url, ''), '://') > 0
                       then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
r as (select *, case
  when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
  when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
  when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
  when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
  when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end as rule,
  regexp_matches(host, '^([^.]*[.])*(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)[.][^.]*[.][^.]*$')
    as listed from p)
select page_id, host, path, rule, listed,
  case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block'
       when rule in ('com/fr/', 'org/') then 'allow' when listed then 'block' else 'allow' end as verdict
from r
"""
