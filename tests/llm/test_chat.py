"""Exact round trip through the formatted text, turn order and loss flags."""

import hashlib
import random
import re

from tidewrack.llm import chat as C

TOKEN = re.compile(r"\\.|### (?:System|User|Assistant): |### Other=(?:\\.|[^\\:])*: | </turn>\n|.", re.DOTALL)


def parse(formatted):
    """(role, text) turns, from the whole formatted text alone."""
    turns, role, text = [], None, ""
    for token in TOKEN.findall(formatted):
        if len(token) > 1 and token.startswith("### ") and role is None:
            role, text = C.role_in(token), ""
        elif token == C.FOOTER:
            turns.append((role, text))
            role = None
        else:
            text += token[1:] if token[0] == "\\" else token
    assert role is None
    return turns


def fixture():
    rng = random.Random(4)
    atoms = ["\\", "### User: ", "### Assistant", "### Other=", "</turn>", " </turn>\n", "a", "é", "\n", " ", "#", "::", "\\\\"]
    text = lambda: "".join(rng.choice(atoms) for _ in range(rng.randint(0, 9)))
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 7)):
            role = ("system", "user", "assistant")[min(2, turn)] if conv % 2 and turn < 3 else rng.choice(["user", "assistant", "system", "to\\ol: x", None, ""])
            rows.append((conv, turn if conv % 9 else 0, role, rng.choice([text(), text(), None])))
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "yes"), (77, 0, "user", "q"), (77, 1, "assistant", "long " * 30_000), (78, 0, "user", "x"), (78, 0, "user", "x")]
    rows += [(79, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(5000)]
    return rows


def test_round_trip_and_digests(spark):
    rows = fixture()
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string").repartition(5)
    segments = C.format_chats(df)
    chats, masks = {}, {}
    for s in segments.collect():
        chats.setdefault(s.conv_id, []).append((s.turn_no, {"header": 0, "text": 1, "footer": 2}[s.part], s.text, s.loss))
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn, role or "", text or ""))
    assert chats.keys() == want.keys()
    got = {r.conv_id: r for r in C.read_back(segments).collect()}
    for conv, parts in chats.items():
        formatted = "".join(p[2] for p in sorted(parts))
        turns = [x[1:] for x in sorted(want[conv])]
        assert parse(formatted) == turns
        masked = "".join(t for r, t in turns if r == "assistant")
        assert C.unescape("".join(p[2] for p in sorted(parts) if p[3])) == masked
        r = got[conv]
        assert r.n_turns == len(turns) and r.formatted_chars == len(formatted) and r.loss_chars == len(masked)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(masked.encode()).hexdigest()
        roles = " ".join(a for a, _ in turns)
        unique = len({x[0] for x in want[conv]}) == len(turns)
        assert r.valid == (unique and all(a in C.TEMPLATE for a, _ in turns) and bool(re.fullmatch(r"(system )?user assistant( user assistant)*", roles))), roles


def test_empty_table(spark):
    assert C.read_back(C.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).collect() == []
