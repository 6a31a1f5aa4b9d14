"""Scalar functions on hand-made rows."""

import math
import re

import pytest
from pyspark.sql import functions as F

from mergewright.functions import (
    NA_TOKENS,
    block_text,
    clean_vin,
    log_distance,
    mileage_bin,
    norm_block,
    norm_compare,
    norm_linker,
    null_tokens,
    nulls_in_frame,
    to_number,
    to_year,
)
from mergewright.functions.distance import GAP_WEIGHT, SPACE_WEIGHT, affine_gap_arrays
from mergewright.functions.text import vin_characters
from mergewright.functions.similarity import (
    exact,
    jaro_winkler,
    jaro_winkler_arrays,
    jaro_winkler_at_least,
    linear,
)


def apply(spark, function, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    got = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in got]


def test_missing_tokens(spark):
    values = ["na", "NA", "n/a", "unknown", "None", "", "null", None, "Unknown", "N.A.", " na"]
    expected = [None] * 8 + ["Unknown", "N.A.", " na"]
    assert apply(spark, null_tokens, values) == expected
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, `a b` string")
    assert [r[1] for r in nulls_in_frame(frame).orderBy("i").collect()] == expected
    odd = nulls_in_frame(frame, ["Unknown", "it's", "a\\b"]).orderBy("i").collect()
    assert odd[8][1] is None and odd[0][1] == "na"
    assert len(NA_TOKENS) == len(set(NA_TOKENS)) == 21


def test_numbers(spark):
    values = ["1", " 2.5 ", "1e3", "-4", "+.5", "7d", "x", "", None, "NaN", "inf", "1,000", "5."]
    assert apply(spark, to_number, values) == [
        1.0, 2.5, 1000.0, -4.0, 0.5, None, None, None, None, None, None, None, 5.0]
    assert apply(spark, to_year, ["2015", "2015.0", "x", "99999999999", "2015.5"]) == [2015, 2015, None, None, None]


def test_mileage_bin(spark):
    values = ["9999", "10000", "-1", "inf", "x", None]
    assert apply(spark, lambda c: mileage_bin(to_number(c)), values) == [0, 1, -1, None, None, None]
    assert apply(spark, mileage_bin, [math.inf, math.nan, 25_000.0], "double") == [None, None, 2]


def test_norm_block(spark):
    values = ["F-150", "--", "  A  B ", None, "Škoda", ""]
    assert apply(spark, norm_block, values) == ["f 150", None, "a b", None, "koda", None]
    assert apply(spark, block_text, values) == ["f 150", "None", "a b", "nan", "koda", "None"]
    assert apply(spark, lambda c: block_text(c, "drop"), values)[1] is None
    with pytest.raises(ValueError):
        block_text(F.lit("x"), "other")


def test_norm_compare(spark):
    values = ["F-150", "--", None, " A \t B ", "a  b", "x　y"]
    assert apply(spark, norm_compare, values) == ["f150", "", "nan", "a b", "a b", "x y"]


def test_norm_linker(spark):
    values = ['"Foo  Bar"', "a\nb", "   ", None, "'It'", "\"'x'\"", "a \n b", '" "']
    assert apply(spark, norm_linker, values) == [
        "foo bar", "a b", None, None, "it", "x", "a   b", None]


def test_clean_vin(spark):
    vin = "1hgcm82633a004352"
    values = [vin, vin[:4] + "-" + vin[4:], vin[:16], vin + "x", None, "é" + vin]
    assert apply(spark, clean_vin, values) == [vin.upper(), vin.upper(), None, None, None, vin.upper()]


def one(spark, column):
    return spark.range(1).select(column.alias("r")).first()["r"]


def test_linear_and_exact(spark):
    def year(a, b, **options):
        return one(spark, linear(F.lit(a).cast("double"), F.lit(b).cast("double"), 5, **options))
    assert [year(2000, 2000 + d) for d in (0, 5, 10, 30)] == [1.0, 0.5, 0.0, 0.0]
    assert year(None, 2000) == 0.0 and year(2000, None, missing=0.25) == 0.25
    assert year(2000, 2002, offset=2.0) == 1.0 and year(2000, 2007, offset=2.0) == 0.5
    assert one(spark, exact(F.lit("a"), F.lit("a"))) == 1.0
    assert one(spark, exact(F.lit("a"), F.lit(None).cast("string"))) == 0.0


def test_log_distance(spark):
    assert one(spark, log_distance(F.lit(10.0), F.lit(1000.0))) == pytest.approx(2.0)
    assert one(spark, log_distance(F.lit(0.0), F.lit(1000.0))) is None


def plain_jaro_winkler(s, t):
    """Straight from the definition, one pair at a time."""
    if not s or not t:
        return 0.0
    window = max(max(len(s), len(t)) // 2 - 1, 0)
    used, left = set(), []
    for i, ch in enumerate(s):
        for j in range(max(0, i - window), min(len(t), i + window + 1)):
            if j not in used and t[j] == ch:
                used.add(j)
                left.append(ch)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [t[j] for j in sorted(used)]
    swaps = sum(a != b for a, b in zip(left, right)) // 2
    jaro = (m / len(s) + m / len(t) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(s), len(t)) and s[prefix] == t[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


WORDS = ["martha", "marhta", "dixon", "dicksonx", "", "a", "b", "civic", "civic lx", "f150",
         "f 150", "small ring", "small rings", "ring small", "aaaaaaaa", "aaaabaaa", "é è", "è é",
         "x" * 40, "x" * 20 + "y" * 20]
PAIRS = [(a, b) for a in WORDS for b in WORDS]


def test_jaro_winkler(spark):
    got = jaro_winkler_arrays([a for a, _ in PAIRS], [b for _, b in PAIRS])
    expected = [plain_jaro_winkler(a, b) for a, b in PAIRS]
    assert got.tolist() == pytest.approx(expected)
    assert plain_jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert plain_jaro_winkler("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)


def test_jaro_winkler_in_spark(spark):
    df = spark.createDataFrame(PAIRS + [(None, "a"), ("a", None)], "a string, b string")
    for threshold in (0.7, 0.9):
        rows = df.select("a", "b", jaro_winkler(F.col("a"), F.col("b")).alias("s"),
                         jaro_winkler_at_least(F.col("a"), F.col("b"), threshold).alias("t")).collect()
        for r in rows:
            if r["a"] is None or r["b"] is None:
                assert r["t"] == 0.0
            else:
                plain = plain_jaro_winkler(r["a"], r["b"])
                assert r["s"] == pytest.approx(plain)
                assert r["t"] == float(plain >= threshold), (r["a"], r["b"])


def plain_affine_gap(s, t):
    """Cheapest alignment by recursion over (i, j, kind of the last step)."""
    from functools import lru_cache

    @lru_cache(None)
    def cost(i, j, last):
        if i == 0 and j == 0:
            return 0.0
        best = math.inf
        if i and j:
            best = cost(i - 1, j - 1, "m") + (1.0 if s[i - 1] == t[j - 1] else 11.0)
        ways = [best] if last == "m" else [best + 0.0]
        if i:
            ways.append(gap(i, j, "s"))
        if j:
            ways.append(gap(i, j, "t"))
        return min(ways)

    @lru_cache(None)
    def gap(i, j, side):
        k, best = 1, math.inf
        while (i - k >= 0 if side == "s" else j - k >= 0):
            before = cost(i - k, j, "m") if side == "s" else cost(i, j - k, "m")
            best = min(best, before + GAP_WEIGHT + SPACE_WEIGHT * k)
            k += 1
        return best

    return cost(len(s), len(t), "m") / max(len(s) + len(t), 1)


def test_affine_gap():
    got = affine_gap_arrays([a for a, _ in PAIRS], [b for _, b in PAIRS])
    assert got.tolist() == pytest.approx([plain_affine_gap(a, b) for a, b in PAIRS])


def test_plain_and_other_texts_are_normalised_alike(spark):
    # Printable ASCII takes a shorter way; both must give the text that the definition gives.
    texts = ["", " ", "a  b", " A - b! ", "tab\there", "line\n", "x\n\ny", "caf\xe9 #1", "\xa0nb  sp　", "KK", "a~{}`^_[]\\|z",
             "\x7f\x1f!", "\xdf-1ı", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select(
        "i", norm_compare(F.col("t")).alias("t"), vin_characters(F.col("t")).alias("v")).orderBy("i").collect()
    space = "\t-\r\x1c-\x20\x85\xa0  -     　"
    for text, row in zip(texts, rows):
        kept = re.sub(f"[^a-z0-9{space}]", "", ("nan" if text is None else text).lower())
        assert row["t"] == re.sub(f"[{space}]+", " ", kept).strip(" ")
        assert row["v"] == (None if text is None else re.sub("[^A-Za-z0-9]", "", text).upper())


def test_scored_texts_are_kept_from_batch_to_batch():
    import pyarrow as pa

    from mergewright.functions.batches import scored_texts
    calls, kept = [], {}

    def score(left, right):
        calls.append(len(left))
        return affine_gap_arrays(left, right)

    texts = ["abc", None, "", "é ü", "abd", "abc", "x" * 120]
    left, right = [a for a in texts for _ in texts], texts * len(texts)
    for _ in range(2):
        got = scored_texts(pa.array(left), pa.array(right), score, kept)
        for a, b, far in zip(left, right, got):
            assert math.isnan(far) if a is None or b is None else far == pytest.approx(affine_gap_arrays([a], [b])[0])
    # The second time only pairs with the long text, which are not kept.
    assert len(kept) == 16 and sum(calls) == 25 + 9
