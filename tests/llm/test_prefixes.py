import hashlib
import random
import zlib

import duckdb
import pytest
from compare import differences

from txnmill.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            pair = (role or "", text or "")
            digest = hashlib.md5(f"{len(pair[0])}:{pair[0]}{pair[1]}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, digest), pair))
    own = {c: [p for _, p in sorted(x)] for c, x in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path, ids in members.items():
        value = (len(ids) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] = leaves.get(path[:d], 0) + (path not in children)
            saved[path[:d]] = saved.get(path[:d], 0) + value
    out = set()
    for path, ids in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(built[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.add((min(ids), len(path), parent, len(ids), len(children.get(path, [])), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out, len(members)


def cases(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-3, 5), *range(98, 130), *range(200, 330, 3), 1000, 10**12, -(10**12) - 7]:
        n = rng.choice([0, 1, 2, 3, 7, 8, 9, 16, 17, 40])
        rows += [(c, rng.choice([t, t, t, None]) if t < 2 else t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "ccc \U0001f600", "é" * 30])) for t in range(n)]
    same = [("user", "hello"), ("assistant", "x" * 50), ("user", "again")] * 9
    for c in range(400, 440):
        rows += [(c, t, role, text) for t, (role, text) in enumerate(same[: rng.choice([27, 27, 20, 8])])]
    rows += [(None, t, "user", "nobody's") for t in range(30)]
    rows += [(5, t % 3, "user", "repeated") for t in range(12)]
    rng.shuffle(rows)
    return rows


def found(df):
    return {tuple(r[n] for n in NAMES) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_brute_force_and_sql(spark, seed):
    rows = cases(seed)
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "'x' AS conv", "2 AS n0")
    out = prefixes.trie(turns)
    expected, n = brute(rows)
    table = out.toArrow()
    assert table.num_rows == n == len(expected) and set(zip(*[table[c].to_pylist() for c in NAMES])) == expected
    con = duckdb.connect()
    con.register("conversations", spark.createDataFrame(rows, SCHEMA).toArrow())
    assert differences(table, con.execute(prefixes.oracle()).to_arrow_table()) == []


def test_one_long_conversation_and_many_equal_ones(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "SLICE", 4)
    monkeypatch.setattr(prefixes, "STRING", 64)
    rows = [(100, t, "user", f"t{t // 2}") for t in range(700)]
    rows += [(c, t, "user", f"same{t}") for c in range(1, 90) for t in range(2)]
    assert found(prefixes.trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)[0]


def test_numbers_across_range_partitions(spark):
    rows = [(1, t, "user", str(t)) for t in range(5000)] + [(2, None, "user", "n")] * 3
    placed = prefixes.numbered(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert sorted(r["pos"] for r in placed if r["conv"] == 1) == list(range(1, 5001))
    assert sorted(r["pos"] for r in placed if r["conv"] == 2) == [1, 2, 3]


def test_empty(spark):
    assert prefixes.trie(spark.createDataFrame([], SCHEMA)).count() == 0
