import random

from lexigauge.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, a string"


def conversations(spark):
    rng = random.Random(4)
    nasty = ["\\", "###", "####", "</turn>", "\\</turn>", ":", "\n", "hi", "", "\\\\###", "### assistant: x </turn>\n", "é"]
    rows = [(-7, t, r, "\\### Assistant: </turn> ok") for t, r in ((0, "user"), (1, "assistant"))]
    for c in range(60):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, "assistant" if t % 2 else "user", "".join(rng.choice(nasty) for _ in range(1 if c < 50 else 3)) if t or c > 30 else "same start"))
    rows += [(90, t, "user", "long " * 20) for t in range(120)]  # a long conversation
    rows += [(c, t, r, x) for c in (91, 92, 93) for t, r, x in ((0, "user", "same start"), (1, "assistant", "copy"))]  # copies
    rows += [(None, 0, "user", "no id"), (94, None, None, None), (94, 1, "odd: role", None), (95, 1, "assistant", "twice"), (95, 1, "assistant", "twice")]
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def by_conversation(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["conv_id"], []).append((r["turn"] if r["turn"] is not None else -1, r["role"] or "", r["text"] or ""))
    return {c: [(role, text) for _, role, text in sorted(turns)] for c, turns in out.items()}


def test_read_back_what_was_packed(spark):
    given = conversations(spark)
    want = by_conversation(given)
    nodes, members = chat.pack(given)
    got = {r["conv_id"]: r for r in chat.read_back(nodes, members).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == turns
        assert [t["learned"] for t in got[c]["turns"]] == [x if r == "assistant" else None for r, x in turns]


def test_stream_holds_shared_turns_once_and_ancestors_spell_the_conversation(spark):
    given = conversations(spark)
    want = by_conversation(given)
    nodes, members = chat.pack(given)
    rows = sorted(nodes.collect(), key=lambda r: r["start"])
    prefixes = {tuple(turns[: i + 1]) for turns in want.values() for i in range(len(turns))}
    assert len(rows) == len(prefixes)
    stream = ""
    for r in rows:  # intervals lie side by side
        assert r["start"] == len(stream)
        stream += r["segment"]
    formatted = {r["conv_id"]: r["formatted"] for r in chat.read_back(nodes, members).collect()}
    node = {(r["depth"], r["a"], r["b"]): r for r in rows}
    for m in members.collect():
        r = node[m["depth"], m["a"], m["b"]]
        before = "".join(stream[s["start"] : s["end"]] for s in r["ancestors"])
        assert formatted[m["conv_id"]].startswith(before + r["segment"])
        assert r["position"] == len(before)
        ends = [s["end"] for s in r["ancestors"]]
        assert ends == sorted(ends) and all(a["end"] < b["start"] for a, b in zip(r["ancestors"], r["ancestors"][1:], strict=False))


def test_depth_first(spark):
    nodes, _ = chat.pack(conversations(spark))
    path = []
    for r in sorted(nodes.collect(), key=lambda r: r["start"]):  # a node's ancestors are the last nodes of each lower depth
        path = path[: r["depth"]]
        assert sum(p["length"] for p in path) == r["position"] and len(path) == r["depth"]
        spans = [(p["start"], p["start"] + p["length"]) for p in path]
        assert sum(e - s for s, e in spans) == sum(s["end"] - s["start"] for s in r["ancestors"])
        path.append(r)


def test_empty_table(spark):
    nodes, members = chat.pack(conversations(spark).filter("false"))
    assert nodes.count() == 0 and members.count() == 0 and chat.read_back(nodes, members).count() == 0
