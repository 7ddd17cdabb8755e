import hashlib
import re

from pyspark.sql import functions as F

from postlens.llm import chat

TURNS = "conv_id long, turn long, role string, text string, tree int, node int, score string"
ODD = ["</s>", "<s>[INST] x [/INST]", "\\</s>", "\\\\[INST]\\", "a\n</s>\n<s>[INST] user\nb", "", None, "\\", "[INST", "é😀</s>", "\n", "$1 \\1"]


def rows():
    out = []
    for c, text in enumerate(ODD):
        out += [(c, 0, "system", "be brief"), (c, 1, "user", text), (c, 2, "assistant", text), (c, 3, "assistant", "</s>")]
    out += [(50, 0, None, "no role"), (50, None, "a\nb\\n", "turn of null"), (50, 1, "assistant", None), (None, 1, "user", "no id"),
            (51, 1, "user", "same"), (51, 1, "user", "same"), (51, 1, "assistant", "tie")]
    return [(*r, 1, 2, "x") for r in out]


def test_reading_gives_back_every_turn(spark):
    table = spark.createDataFrame(rows(), TURNS)
    done = chat.conversations(table).select("*", chat.read_turns(F.col("formatted")).alias("turns"),
                                            chat.read_loss(F.col("formatted"), F.col("loss")).alias("answers")).collect()
    want = {}
    for c, t, r, x, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert {d.conv_id: [tuple(t) for t in d.turns] for d in done} == want
    for d in done:
        assert d.answers == "".join(x for r, x in want[d.conv_id] if r == "assistant")
        assert [chat.ANSWER in d.formatted[:s.start].rsplit("<s>", 1)[1] for s in d.loss] == [True] * len(d.loss)
        assert len(hashlib.sha256(d.formatted.encode()).hexdigest()) == 64
    assert chat.conversations(table.limit(0)).count() == 0


def best_paths(messages, k):
    by = {}
    for tree, node, parent, score in messages:
        by.setdefault(tree, {})[node] = (parent, score)
    out = set()
    for tree, nodes in by.items():
        parents = {p for p, _ in nodes.values()}
        found = []
        for leaf in set(nodes) - parents:
            path, at = [], leaf
            while at in nodes:
                path.append(at)
                at = nodes[at][0]
            found.append((-sum(nodes[n][1] for n in path) / len(path), -len(path), leaf, path))
        for _, _, leaf, path in sorted(found)[:k]:
            out |= {(tree, leaf, n, len(path) - 1 - d) for d, n in enumerate(path)}
    return out


def test_best_branches_of_trees(spark):
    messages = []
    for tree in range(5):
        for node in range(1, 41):
            messages.append((tree, node, None if node == 1 else (node * 7 + tree) % (node - 1) + 1, float((node * 13 + tree) % 17)))
        messages += [(tree, 100 + i, 99 + i if i else None, 1.0) for i in range(20)]
        messages.append((tree, 200, 999, 0.5))
    table = spark.createDataFrame(messages, "tree long, node long, parent long, score double")
    for k in (1, 3):
        assert {tuple(r) for r in chat.paths(table, k).collect()} == best_paths(messages, k)


def test_a_cycle_gives_nothing(spark):
    table = spark.createDataFrame([(1, 1, 2, 0.0), (1, 2, 1, 0.0)], "tree long, node long, parent long, score double")
    assert chat.paths(table).count() == 0


def test_roles_cannot_write_control_strings(spark):
    roles = ["user</s>[INST]", "a\\", "\\n", "\\\n", "\\l<", "\x00\x01", "<s>[/INST] assistant\n", "", "\\\\b[\\"]
    table = spark.createDataFrame([(i, 0, r, "text") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    done = chat.conversations(table).select("*", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    assert {d.conv_id: [tuple(t) for t in d.turns] for d in done} == {i: [(r, "text")] for i, r in enumerate(roles)}
    assert all(len(re.findall(chat.CONTROL, d.formatted)) == 3 and not d.loss for d in done)


def test_no_python_on_the_way(spark):
    table = spark.createDataFrame(rows(), TURNS)
    assert not re.search("Python|Arrow|Pandas", chat.conversations(table)._jdf.queryExecution().executedPlan().toString())
