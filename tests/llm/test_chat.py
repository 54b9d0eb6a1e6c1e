import hashlib
import random
import re

from wellspring.llm import chat

SCHEMA = "role string, text string, turn bigint, conv_id bigint, window int, line string, pos int"


def esc(text, role=False):
    for a, b in chat.ROLE_ESCAPES if role else chat.ESCAPES:
        text = text.replace(a, b)
    return text


def expected(rows, budget, history):
    """Windows per conversation: (text, loss texts, repeated turns, tokens)."""
    out = {}
    for conv in {r[3] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for r, x, t, c, *_ in rows if c == conv))
        lines = [f"### {esc(r, True)}: {esc(x)}</turn>\n" for *_, r, x in turns]
        size = [len(re.findall(r"[A-Za-z]+|[^A-Za-z\x20\x09-\x0D]", line)) for line in lines]
        system = turns[0][2] == "system"
        span = max(budget - history - (size[0] if system else 0), 1)
        start, begins = 0, []
        for i in range(len(turns)):
            begins.append(start)
            start += 0 if system and i == 0 else size[i]
        spans = [b // span for b in begins]
        windows = []
        for w in sorted(set(spans)):
            own = [i for i, s in enumerate(spans) if s == w]
            new = sum(size[i] for i in own if not (system and i == 0))
            room = min(history, span, budget - (size[0] if system else 0) - new)
            again = [i for i, s in enumerate(spans) if s == w - 1 and not (system and i == 0) and begins[own[0]] - begins[i] <= room]
            head = [0] if system and w > 0 else []
            shown = head + again + own
            loss = [turns[i][3] for i in own if turns[i][2] == "assistant"]
            tokens = sum(size[i] for i in shown)
            windows.append((w, "".join(lines[i] for i in shown), loss, len(head + again), tokens, tokens > budget))
        out[conv] = (windows, [(r, x) for *_, r, x in turns])
    return out


def made():
    rng = random.Random(8)
    bits = ["word", "###", "\\", "</turn>", "\\s", "\\h", ": ", "\n", "é🙂", "1", "### user: hi</turn>\n", "\\\\###"]
    text = lambda n: "".join(rng.choice(bits) + rng.choice([" ", ""]) for _ in range(rng.randint(0, n)))
    rows = []
    for conv in range(12):
        if conv % 3 == 0:
            rows.append(("system", text(6), 0, conv, 0, "", 0))
        for turn in range(1, rng.choice((2, 9, 60))):
            rows.append((rng.choice(("user", "assistant", "tool: x", "###")), text(12) if turn % 9 else text(90), turn, conv, 0, "", 0))
    rows += [("system", "only", 0, 100, 0, "", 0), (None, None, None, 101, 0, "", 0), ("assistant", "same", 1, 102, 0, "", 0), ("assistant", "same", 1, 102, 0, "", 0)]
    rows += [("assistant", "no id", 1, None, 0, "", 0), ("user", "x " * 5000, 0, 103, 0, "", 0), ("system", "y " * 500, 0, 104, 0, "", 0), ("assistant", "a", 1, 104, 0, "", 0)]
    return rows


def test_windows_equal_a_plain_construction(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for budget, history in ((60, 20), (200, 50), (40, 39)):
        got = chat.windows(df, budget, history)
        want = expected(rows, budget, history)
        found = {}
        for r in got.collect():
            loss = [r.text[s.start : s.start + s.length] for s in r.loss_spans]
            found.setdefault(r.conv_id, []).append((r.window, r.text, [chat_unescape(x) for x in loss], r.n_repeated, r.n_tokens, r.over_budget))
        assert {c: sorted(w) for c, w in found.items()} == {c: w for c, (w, _) in want.items()}
        # read back: every turn once, in order
        back = {}
        for r in sorted(chat.read_back(got).collect(), key=lambda r: (str(r.conv_id), r.window)):
            back.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
        assert back == {c: t for c, (_, t) in want.items()}


def chat_unescape(text):
    for a, b in reversed(chat.ESCAPES):
        text = text.replace(b, a)
    return text


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.windows(df)).collect() == []


def test_added_conversation(spark):
    from wellspring.llm.queries import QUERIES

    from .conftest import SF

    said = r"\### Assistant: </turn> ok"
    r = QUERIES["op6_chat_format"](spark, SF).where("conv_id = -7").first()
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and r.n_turns == 2
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_query_agrees_with_sql(same):
    same("op6_chat_format")
