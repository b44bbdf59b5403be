"""The trie of conversations against one built from whole tuples."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

from tripstrata.llm import turntrie

SCHEMA = "conv_id long, turn long, role string, text string"


def built(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, mark, role, text))
    own = {conv: [t[3:] for t in sorted(said)] for conv, said in turns.items()}
    members, ends, children = defaultdict(list), defaultdict(list), Counter()
    for conv in sorted(own):
        share = zlib.crc32(str(conv).encode()) % 4
        leader = conv - int(math.fmod(conv, 20))
        path = tuple(own.get(leader, [])[:share] + own[conv][share:])
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
        ends[path].append(conv)
    children.update(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, who in members.items():
        words = len(re.findall(turntrie.WORD, path[-1][1])) if path else 0
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += (len(who) - 1) * words
    return sorted(
        (
            who[0], len(path), members[path[:-1]][0] if path else -1, len(who), children[path],
            leaves[path], saved[path], hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest(),
        )
        for path, who in members.items()
    )


def check(spark, rows, parts=3):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = turntrie.conversation_trie(table).collect()
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got) == built(rows)


def test_nulls_ties_repeated_rows_and_absent_leaders(spark):
    pick = random.Random(3)
    ids = [None, 0, 1, 5, 20, 25, 40, 41, -7, -20]
    check(
        spark,
        [
            (pick.choice(ids), pick.choice([None, 0, 0, 1, 2, 3, 4]), pick.choice([None, "", "u", "v"]), pick.choice([None, "", "a", "b c"]))
            for _ in range(150)
        ],
    )


def test_deep_conversations_cross_bands(spark):
    """One conversation holds most rows, so that it lies in several parts."""
    rows = [(60, i, "u", f"w{i // 7} x") for i in range(400)]
    rows += [(61, i, "u", f"w{i // 7} x") for i in range(250)] + [(62, 0, "u", "y")]
    check(spark, rows)


def test_many_equal_conversations(spark):
    rows = [(c, t, "u", f"{t} same") for c in range(300) for t in range(3)]
    check(spark, rows + [(c, 0, "u", str(c)) for c in range(300, 330)], parts=5)


def test_conversations_left_without_turns(spark):
    """One turn of its own, which the absent leader's would replace."""
    rows = [(c, 0, "u", "only") for c in range(1, 20)]
    assert any(zlib.crc32(str(c).encode()) % 4 for c in range(1, 20))
    check(spark, rows)


def test_long_texts_empty_tables_and_clashing_names(spark):
    long = "w " * 300_000
    check(spark, [(1, 0, "u", long), (2, 0, "u", long), (3, 0, "u" * 100_000, "x")])
    none = spark.createDataFrame([], SCHEMA)
    assert turntrie.conversation_trie(none).count() == 0
    odd = spark.createDataFrame([(20, 1, "u", "a b", 9, "z")], SCHEMA + ", depth int, digest string")
    assert turntrie.conversation_trie(odd).count() == 2
