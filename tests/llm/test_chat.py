import hashlib
import random

from quarry.llm import chat
from quarry.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck

ROWS = "conv_id long, turn long, role string, text string, tree string, place long"
NASTY = ["", None, "\\", "###", "####", "### user: ", "</turn>\n", "<</turn>", "\\### Assistant: </turn> ok", "#", "é漢🙂", "a\\</turn>\\", "x:y", "\n"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS).repartition(3)


def conversations(rows):
    """Turns of each conversation in order, by plain code."""
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:])
    found = {}
    for r in sorted(rows, key=key):
        found.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return found


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    out = {}
    for conv, turns in conversations(rows).items():
        learned = [t for r, t in turns if r == "assistant"]
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), sum(map(len, learned)), sha("".join(learned)))
    return out


def check(spark, rows):
    """The trees hold each beginning once, depth first, with right positions and intervals; reading them gives the turns."""
    nodes, ends = chat.prefix_trees(frame(spark, rows))
    got = chat.read_back(nodes, ends).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == plain(rows) and len(got) == len(plain(rows))
    given = conversations(rows)
    table = nodes.collect()
    assert len(table) == len({tuple(turns[:k + 1]) for turns in given.values() for k in range(len(turns))})
    trees = {}
    for n in table:
        trees.setdefault(bytes(n.tree), {})[n.place] = n
    assert len(trees) == len({turns[0] for turns in given.values()})
    for tree in trees.values():
        start = 0
        for place in range(len(tree)):
            n = tree[place]
            assert n.start == start and n.chars == len(n.text)
            start += n.chars
            inside = [tree[p] for r in n.attends for p in range(r.first, r.last + 1)]
            assert n.position == sum(x.chars for x in inside)
            assert [(r.start, r.end) for r in n.attends] == [(tree[r.first].start, tree[r.last].start + tree[r.last].chars) for r in n.attends]
            assert all(a.end < b.start for a, b in zip(n.attends, n.attends[1:]))
            if inside:  # a child comes before the next subtree starts: its parent's other descendants in between
                parent = max(x.place for x in inside)
                assert all(parent in [p for r in tree[q].attends for p in range(r.first, r.last + 1)] for q in range(parent + 1, place))
            else:
                assert place == 0
    by_end = {r.conv_id: trees[bytes(r.tree)][r.place] for r in ends.collect()}
    for conv, turns in given.items():
        tree = trees[bytes({r.conv_id: r.tree for r in ends.collect()}[conv])] if len(given) < 30 else None
        if tree:
            n = by_end[conv]
            path = [tree[p] for r in n.attends for p in range(r.first, r.last + 1)] + [n]
            assert [chat.parse_turn(x.text) for x in path] == turns
            assert sum(x.chars for x in path) == {r.conv_id: r.formatted_chars for r in got}[conv]


def test_edge_cases(spark):
    rows = [(k, t, role, NASTY[(k + t) % len(NASTY)]) for k in range(14) for t, role in enumerate(("system:", "user", "assistant", None))]
    rows += [(20, None, "assistant", "x"), (20, 1, "assistant", "x"), (20, 1, "assistant", "x"), (None, 0, "user", "x"), (None, 1, "assistant", "\\")]
    check(spark, rows)


def test_shared_beginnings(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(150):  # one hot first turn, many branches, copies, and conversations that begin others
        depth = rng.randint(1, 7)
        rows += [(conv, t, "assistant" if t % 2 else "user", "hello" if t == 0 and conv % 3 else rng.choice("ab") * 3) for t in range(depth)]
    rows += [(1000 + c, t, r, x) for c in range(40) for k, t, r, x in rows if k == 7]
    rows += [(5000, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(700)]
    check(spark, rows)


def test_empty(spark):
    nodes, ends = chat.prefix_trees(frame(spark, []))
    assert nodes.count() == 0 and ends.count() == 0 and chat.read_back(nodes, ends).count() == 0


def test_query(spark, sf):
    name = "op13_prefix_tree_chat"
    assert compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)[0] == []
    assert any(r.conv_id == -7 for r in QUERIES[name](spark, sf).collect())
