"""The radix tree against a dictionary, the conversation trie against prefixes taken one by one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tabmill.llm import queries, radix, turntrie

SCHEMA = "conv_id long, turn int, role string, text string, depth string, key int, `a.b` int"


def test_radix_tree_equals_dictionary():
    rnd, rooms = random.Random(2), set()
    for letters in (1, 2, 5, 30, 200, 256):
        tree, want = radix.Tree(), {}
        for i in range(600):
            key = bytes(rnd.randrange(letters) for _ in range(rnd.choice([0, 1, 2, 2, 3, 9, 40])))
            tree.insert(key, i)
            want[key] = i
            if rnd.random() < 0.3:
                key += bytes(rnd.randrange(256) for _ in range(3))
                tree.insert(key, -i)
                want[key] = -i
        assert all(tree.find(key) == value for key, value in want.items())
        assert all(tree.find(key + b"zz") == want.get(key + b"zz") for key in want)
        assert sum(node.value is not None for _, _, node in tree.climb()) == len(want)
        rooms |= {node.room for _, _, node in tree.climb()}
    assert rooms == {4, 16, 48, 256}


def brute(rows, block=20, most=4):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [r[2:] for r in sorted(t)] for c, t in own.items()}
    full = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % most
        full[c] = tuple(turns.get(c - c % block, [])[:h] + t[h:])
    members = defaultdict(list)
    for c, t in full.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    out = []
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def subtree(node):
        words = len(node[-1][1].encode().split()) if node else 0
        leaves, saved = int(not children[node]), (len(members[node]) - 1) * words
        for kid in children[node]:
            a, b = subtree(kid)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if full[c] == node)))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), *subtree(node),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows):
    seqs = turntrie.sequences(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return sorted((tuple(r) for r in turntrie.nodes(queries.rebuilt(seqs)).collect()), key=str)


def made(rnd, convs, texts):
    rows = []
    for c in convs:
        hot = rnd.random() < 0.5
        for turn in range(rnd.randrange(1, 7)):
            text = "the very same first turn" if hot and turn < 2 else rnd.choice(texts)
            rows.append((c, turn, rnd.choice(["user", "bot"]) if turn > 1 else "user", text, "x", 1, 1))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_prefixes(spark, seed):
    rnd = random.Random(seed)
    rows = made(rnd, range(0, 150), ["a", "b c", "d e f", "", None])
    rows += [(200, 0, "user", "only", "x", 1, 1), (205, 0, "user", "other", "x", 1, 1), (233, 0, None, None, "x", 1, 1)]
    rows += [(300 + i, 0, "user", "copied", "x", 1, 1) for i in range(40)]                     # many ends of one node
    rows += [(5, None, "user", "before all", "x", 1, 1), (6, 1, "z", "tie", "x", 1, 1), (6, 1, "y", "tie", "x", 1, 1)]
    rows += [(400, t, "user", f"word {t % 3}", None, None, None) for t in range(120)]           # a long one, and its copy
    rows += [(420, t, "user", f"word {t % 3}", None, None, None) for t in range(120)]
    rows += [(None, 1, "user", "nobody", "x", 1, 1)] + rows[:5]                                 # no id; repeated rows
    got = trie(spark, rows)
    assert got == brute(rows)
    assert [r for r in got if r[1] == 0][0][4] > 3


def test_ids_beyond_one_piece_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(turntrie, "PIECE_BYTES", 50)
    rows = [(20 * i, 0, "user", "same" if i % 3 else "else", "x", 1, 1) for i in range(400)]
    assert trie(spark, rows) == brute(rows)


def test_no_conversations_have_no_nodes(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "nobody", "x", 1, 1)]) == []
