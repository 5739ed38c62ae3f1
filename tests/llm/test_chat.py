"""The prefix tree against conversations formatted one by one."""

import hashlib
import random
from collections import defaultdict

import pytest

from pagemill.llm.chat import chat, formatted, parsed, prefix_tree
from pagemill.llm.chat_queries import TRICKY, formatted_conversations
from pagemill.llm.common import tokenizer_file

FILE = tokenizer_file("byte_bpe_50k.json")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, conv string, part string, mid string, n string, idx string"
NASTY = [TRICKY, "\\", "\\\\", "####", "#", "## #\\#", "</turn></turn>", "</turn", "### user: x</turn>\n", "", "\n", "<|endoftext|>", "日本語 🤦🏼‍♂️", ":\\:"]


def rows():
    rng = random.Random(1)
    out = []
    def add(conv, turns):
        out.extend((conv, i, role, text) for i, (role, text) in enumerate(turns))
    system = ("system", "Be brief.")
    for c in range(60):  # a hot first turn, copies, conversations that begin others
        turns = [system] if c % 3 else [("system", f"s{c % 4}")]
        turns += [(("user", "assistant")[i % 2], f"say {rng.randrange(3)}") for i in range(c % 6)]
        add(c, turns)
    for c in range(100, 110):
        add(c, [system, ("user", "hello " * 50), ("assistant", "same")])
    add(200, [(("user", "assistant")[i % 2], f"long {i} {'x' * (i % 9)}") for i in range(300)])
    add(201, [(("user", "assistant")[i % 2], f"long {i} {'x' * (i % 9)}") for i in range(290)] + [("user", "other")])
    add(202, [(("user", "assistant")[i % 2], f"long {i} {'x' * (i % 9)}") for i in range(300)])
    for k, text in enumerate(NASTY):
        add(300 + k, [(text, text), ("assistant", text), ("user", None), ("assistant", text * 2)])
    out += [(None, 0, "user", "null conversation"), (None, 1, None, None), (400, None, "assistant", "no turn"), (400, 0, "user", "first")]
    out += [(401, 0, "user", "b"), (401, 0, "user", "a"), (401, 0, "user", "a"), (401, 0, "assistant", "z")]
    out += [(402, 0, "user", "word " * 40_000), (403, 5, "system", "Be brief."), (403, 9, "user", "say 1")]
    return out


def conversations(given):
    found = defaultdict(list)
    for conv, turn, role, text in given:
        found[conv].append((turn is None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in found.items()}


@pytest.fixture(scope="module")
def table(spark):
    given = rows()
    random.Random(0).shuffle(given)
    return spark.createDataFrame([(*r, *"xxxxxx") for r in given], SCHEMA).repartition(4).cache()


@pytest.mark.parametrize("part_rows", [200_000, 7])
def test_read_back(table, part_rows):
    got = {r["conv_id"]: tuple(r)[1:] for r in formatted_conversations(table, part_rows=part_rows).collect()}
    want = {}
    for conv, turns in conversations(rows()).items():
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        want[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                      sum(len("".join(formatted(*t))) for t in turns))
    assert got == want


@pytest.mark.parametrize("part_rows", [40])
def test_tree(table, part_rows):
    """Shared turns once, each tree without gaps, parents before children, and every conversation
    is what its last node may attend to, at rising positions."""
    nodes, turns = prefix_tree(table, FILE, part_rows=part_rows)
    nodes, turns = nodes.collect(), turns.collect()
    want = conversations(rows())
    assert len(nodes) == len({tuple(t[:i + 1]) for t in want.values() for i in range(len(t))})
    by, trees, paths = {n["node"]: n for n in nodes}, defaultdict(list), defaultdict(list)
    for n in nodes:
        trees[n["tree"]].append(n)
    for t in turns:
        paths[t["conv"]].append((t["idx"], t["node"]))
    assert len(trees) == len({t[0] for t in want.values()})
    tokens, positions = {}, {}
    for tree, members in trees.items():
        members.sort(key=lambda n: n["start"])
        tokens[tree] = [i for n in members for i in n["ids"]]
        positions[tree] = [p for n in members for p in n["positions"]]
        at = 0
        for n in members:
            assert n["start"] == at
            at += len(n["ids"])
        # depth first: what is open when a node comes is its line of ancestors
        line = []
        for n in members:
            while line and line[-1] != n["parent"]:
                line.pop()
            assert (line[-1] if line else "") == n["parent"]
            line.append(n["node"])
    made = chat(FILE)
    for conv, turns in want.items():
        path = [node for _, node in sorted(paths[conv])]
        assert len(path) == len(turns)
        last = by[path[-1]]
        seen = [*last["attends"], (last["start"], last["start"] + len(last["ids"]))]
        ids = [i for a, b in seen for i in tokens[last["tree"]][a:b]]
        assert made.decode(ids) == "".join("".join(formatted(*t)) for t in turns)
        assert [p for a, b in seen for p in positions[last["tree"]][a:b]] == list(range(len(ids)))
        assert all(b[0] > a[1] for a, b in zip(last["attends"], last["attends"][1:]))
        for (role, text), node in zip(turns, path):
            n = by[node]
            assert (n["loss_start"] is None) == (role != "assistant")
            if role == "assistant":
                header, inner, _ = formatted(role, text)
                assert made.decode(n["ids"][:n["loss_start"]]) == header and made.decode(n["ids"][n["loss_start"]:n["loss_end"]]) == inner
    for n in nodes:
        assert n["conversations"] == sum(n["node"] in {x for _, x in p} for p in paths.values())


def test_template_is_reversible():
    for role in NASTY:
        for text in NASTY:
            parts = formatted(role, text)
            turn = "".join(parts)
            assert parsed(turn) == (role, text, len(parts[0]), len(parts[0]) + len(parts[1]))
            assert "###" not in parts[1] and "</turn>" not in parts[1] and turn.count("</turn>") == 1 and turn.count("### ") == 1
    with pytest.raises(ValueError):
        parsed("### user no end")


def test_empty_table(spark, table):
    assert formatted_conversations(table.limit(0)).collect() == []
    nodes, turns = prefix_tree(table.filter("conv_id = 400"), FILE)
    assert nodes.count() == turns.count() == 2
