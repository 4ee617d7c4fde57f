import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import zfast

SCHEMA = "conv_id long, turn long, role string, text string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Every prefix of every rebuilt conversation, held as tuples of turns."""
    by = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            by[conv_id].append((turn is not None, turn or 0, said[:16], role, text))
    turns = {c: [t[3:] for t in sorted(r)] for c, r in by.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        begins = c - (abs(c) % 100) * (1 if c > 0 else -1)
        whole[c] = tuple(turns.get(begins, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        gain = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += gain
    out = Counter()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out[min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha] += 1
    return out


def got(df):
    return Counter(map(tuple, df.select(*OUT).collect()))


def made(seed, n, most, alphabet):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, most)):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(alphabet)))
    rng.shuffle(rows)
    return rows


def chain(digests):
    key, keys = zfast.ROOT, [zfast.ROOT]
    for d in digests:
        key = hashlib.blake2b(d, key=key, digest_size=16).digest()
        keys.append(key)
    return keys


def test_two_fattest():
    for a in range(40):
        for b in range(a + 1, 60):
            fat = max(range(a + 1, b + 1), key=lambda n: n & -n)
            assert zfast.two_fattest(a, b) == fat


@pytest.mark.parametrize("seed", range(6))
def test_exit_nodes_and_handles(seed):
    """Against plain comparison with all sequences so far; few look-ups; every handle finds its node."""
    rng = random.Random(seed)
    trie, seen = zfast.ZFastTrie(), []
    for i in range(400):
        seq = [bytes([rng.randint(0, 1)]) * 16 for _ in range(rng.randint(0, 40))]
        if seen and rng.random() < 0.7:
            seq = rng.choice(seen)[: rng.randint(0, 40)] + seq[: rng.randint(0, 5)]
        depth = max((next((d for d, (a, b) in enumerate(zip(seq, s)) if a != b), min(len(seq), len(s))) for s in seen), default=0)
        before = trie.look_ups
        node, found = trie.locate(chain(seq))
        assert found == depth and node.top < max(depth, 1) and depth <= max(node.extent, 0)
        assert trie.look_ups - before <= max(1, len(seq)).bit_length() + 1
        trie.insert_batch([(i, seq, [1] * len(seq))])
        seen.append(seq)
    nodes = trie.nodes()
    assert len(trie.handles) == len(nodes) - 1 and all(trie.handles[n.handle] is n for n in nodes[1:])
    assert all(n.parent.extent == n.top and (n.ends or len(n.below) > 1) for n in nodes[1:])


@pytest.mark.parametrize("per_range", [200_000, 40])
def test_all_prefixes(spark, per_range):
    """In one range, and in very many, where most prefixes are shared."""
    rows = made(1, 250, 7, ["a", "b"]) + [(1000 + c, t, "user", "long") for c in range(30) for t in range(25 + c % 4)]
    rows += [(2000 + c, 0, "user", "copy") for c in range(80)]
    seq = zfast.materialise(zfast.rebuilt(spark.createDataFrame(rows, SCHEMA)))
    assert got(zfast.trie(seq, per_range)) == plain(rows)


def test_deep_branches_over_many_ranges(spark):
    """A third of all conversations share more turns than ranges are cut by, and part below."""
    rng = random.Random(4)
    rows = [(c, t, "user", "same" if t < 20 else rng.choice("xyz")) for c in range(60) for t in range(20 + c % 9)]
    rows += [(c, t, "user", rng.choice("xyz")) for c in range(60, 180) for t in range(3)]
    seq = zfast.materialise(zfast.rebuilt(spark.createDataFrame(rows, SCHEMA)))
    assert got(zfast.trie(seq, 60)) == plain(rows)


def test_blocks_of_ids(spark, monkeypatch):
    monkeypatch.setattr(zfast, "IDS_PER_BLOCK", 7)
    rows = [(c, 0, "user", "copy") for c in range(150)]
    seq = zfast.materialise(zfast.rebuilt(spark.createDataFrame(rows, SCHEMA)))
    assert got(zfast.trie(seq, 50)) == plain(rows)


def test_edge_rows(spark):
    rows = [
        (None, 1, "user", "nobody's"), (None, None, None, None), (0, None, None, None), (0, None, "user", None), (0, 3, None, "x"), (0, 3, None, "x"),
        (0, 3, "user", "x"), (0, -2, "user", "éß日本\U0001f600"), (7, 1, "user", "a" * 100_000), (8, 1, "user", "a" * 100_000), (9, 0, "user", ""),
        (-5, 0, "user", "below zero"), (-105, 0, "user", "further"), (2**62, 1, "1:user", "x"), (2**62 + 1, 1, "", "1:userx"), (300, 0, "user", "x"),
    ] + [(301 + i, t, "user", "x") for i in range(99) for t in range(i % 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(zfast.prefixes(df)) == plain(rows)
    clashing = df.select("*", *[F.lit("own").alias(c) for c in ("key", "depth", "digests", "chars", "begins", "turns", "ends", "parent", "up", "of")])
    assert got(zfast.prefixes(clashing)) == plain(rows)
    empty = zfast.prefixes(df.limit(0))
    assert set(empty.columns) == set(OUT) and empty.count() == 0
    assert zfast.prefixes(df.where("conv_id IS NULL")).count() == 0
