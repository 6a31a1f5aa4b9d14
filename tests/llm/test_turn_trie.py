import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from mergewright.llm import turn_trie
from mergewright.llm.running import running

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes from a dictionary of all beginnings of the rebuilt conversations."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn, role or "", text or ""))
    own = {}
    for conv, held in turns.items():
        held.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()))
        own[conv] = [t[1:] for t in held]
    built = {}
    for conv, held in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        shared = conv - abs(conv) % 5 * (1 if conv > 0 else -1)
        built[conv] = own.get(shared, [])[:h] + held[h:]
    nodes = {}
    for conv, held in built.items():
        for d in range(len(held) + 1):
            nodes.setdefault(tuple(held[:d]), []).append(conv)
    children, leaves, saved = {}, {}, {}
    for path in nodes:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, members in nodes.items():
        own_saved = (len(members) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] = saved.get(path[:d], 0) + own_saved
            leaves[path[:d]] = leaves.get(path[:d], 0) + (path not in children)
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), children.get(path, 0),
                    leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes_of(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                       "ends_sha256").collect()), key=repr)


def conversations(seed=3):
    r, rows = random.Random(seed), []
    for conv in [*range(-12, 41), 1000, 2003]:
        n = 23 if conv in (20, 22, 24, 31) else r.choice([1, 1, 2, 3, 4, 5, 8, 9, 14])
        rows += [(conv, i if r.random() < .95 else None, r.choice(["u", "a", None]), r.choice(["x", "y", None, "ü"]))
                 for i in range(n)]
    # Equal conversations, longer than a tile and more than a block.
    rows += [(conv, i, "u", f"same {i}") for conv in range(41, 60) for i in range(13)]
    # What has no conversation, and repeated rows.
    return [*rows, (None, 1, "u", "z"), (33, 2, "u", "again"), (33, 2, "u", "again")]


@pytest.mark.parametrize("width,rows", [(4, 7), (3, 1), (64, 8192)])
def test_nodes_equal_brute_force_whatever_tiles_and_blocks(spark, width, rows):
    data = conversations()
    assert nodes_of(turn_trie.trie(spark.createDataFrame(data, TURNS), width, rows)) == brute(data)


def test_clashing_columns_and_a_turnless_conversation(spark):
    # 6 has h = crc32("6") % 9 turns of conversation 5, which is absent; one own turn is fewer than h.
    data = [(6, 0, "u", "only"), (7, 0, None, None)]
    df = spark.createDataFrame(data, TURNS).withColumns({c: F.lit("clash") for c in ("conv", "id", "place", "bytes", "shard")})
    want = brute(data)
    assert nodes_of(turn_trie.trie(df)) == want
    assert any(depth == 0 for _, depth, *_ in want)


def test_empty_table(spark):
    assert turn_trie.trie(spark.createDataFrame([], TURNS)).count() == 0


def test_all_conversations_turnless(spark):
    turnless = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:4]
    data = [(c, 0, "u", "t") for c in turnless]
    assert nodes_of(turn_trie.trie(spark.createDataFrame(data, TURNS), rows=2)) == brute(data)


def test_running_sums_of_one_long_key(spark):
    rows = [(1 if i < 900 else i, i, i % 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, o long, v long").repartition(6)
    got = running(df, "k", [F.col("o")], ["v"]).collect()
    held = {}
    want = {}
    for k, o, v in rows:
        want[k, o] = held.get(k, 0)
        held[k] = want[k, o] + v
    assert {(r.k, r.o): r.before_v for r in got} == want
