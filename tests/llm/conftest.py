import pytest
from pyspark.sql import functions as F

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def sentence(seed, n):
    state, out = seed + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2 ** 31
        out.append(WORDS[(state >> 8) % len(WORDS)])
    return " ".join(out)


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and blank texts, a long text, ties, repeated rows, clashing extra columns."""
    base = sentence(5, 60)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (None, "a null id and a few words more than five"), (5, sentence(9, 6000)),
            (6, base), (6, base), (7, base.replace(" ", "  ")), (8, base + " zulu"), (9, "x" * 5000), (10, None),
            (11, 'see token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" or 4785380592391139'), (12, "日本語 ünï ² \u00a0 end\n\n\n")]
    return (spark.createDataFrame([(i, t, "en" if i and i % 2 else None, None, len(t or "")) for i, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
            .withColumns({c: F.lit("clash") for c in ("row", "rep", "sha", "bucket", "label", "host", "score", "__x")}))


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)
