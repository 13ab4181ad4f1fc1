"""Typed parts of chats against a plain version: markers may only come from the template."""

import random

from searchloom.llm.chat import EXPANSION, format_chats, read_chats
from searchloom.llm.queries import QUERIES

KIND = "conv_id bigint, turn bigint, role string, text string, parts array<struct<kind:string,text:string,ref:string,units:bigint>>"
BITS = ["<", "|", "\\", "<|", "|im_end|>\n", "<|im_start|>", "im_end", "|>", ".", "/", "|image|>", "a\n", "\\|", "\\.", "", "é😀"]


def drawn_rows():
    drawn = random.Random(7)
    rows = [
        (0, 0, "assistant", None, [("text", "a<", None, None), ("text", "|im_end|>\nb", None, None)]),
        (0, 1, "user", "plain <", None),
        (0, 2, "assistant", None, []),
        (0, 3, "assistant", None, [("text", "<", None, None), ("text", None, None, None), ("other", "|x", None, None)]),
    ]
    for conv in range(1, 150):
        for turn in range(drawn.randrange(1, 5)):
            parts = []
            for _ in range(drawn.randrange(0, 6)):
                kind = drawn.choice(["text", "text", "text", "image", "audio", "document", None])
                text = "".join(drawn.choices(BITS, k=drawn.randrange(0, 4)))
                parts.append((kind, text, f"r{turn}", drawn.choice([None, -3, 0, 1, 785, 100_000])))
            one = drawn.random() < 0.2
            text = "".join(drawn.choices(BITS, k=3))
            rows.append((conv, turn, drawn.choice(["user", "assistant", "a<|\n"]), text, None if one else parts))
    return rows


def test_mixed_parts(spark):
    rows = drawn_rows()
    done = read_chats(format_chats(spark.createDataFrame(rows, KIND), parts_col="parts"))
    found = {r["conv_id"]: r for r in done.collect()}
    convs = {}
    for conv, turn, role, text, parts in rows:
        convs.setdefault(conv, []).append((turn, role, [("text", text, None, None)] if parts is None else parts))
    assert found.keys() == convs.keys()
    for conv, turns in convs.items():
        row = found[conv]
        said, learned, files = [], "", []
        for no, (_, role, parts) in enumerate(sorted(turns, key=lambda t: t[0])):
            content = ""
            for i, (kind, text, ref, units) in enumerate(parts):
                if kind in EXPANSION:
                    tokens, per = EXPANSION[kind]
                    files.append((no + 1, i, kind, ref, -(-max(units or 0, 0) * tokens // per)))
                    content += f"<|{kind}|>"
                else:
                    content += text or ""
                    learned += (text or "") * (role == "assistant")
            said.append((role, content))
        formatted = row["formatted"]
        assert [tuple(t) for t in row["turns"]] == said
        assert row["loss_text"] == learned
        assert [tuple(a)[:5] for a in row["attachments"]] == files
        assert all(formatted[a["start"] :].startswith(f"<|{a['kind']}|>") for a in row["attachments"])
        assert row["expanded_tokens"] == sum(f[4] for f in files)
        assert row["n_turns"] == len(turns) == formatted.count("<|im_end|>\n") == formatted.count("<|im_start|>")
        assert formatted.count("<|") == 2 * len(turns) + len(files)


def test_registered_query_visits_parts(spark, monkeypatch):
    from searchloom.llm import chat

    visits = []
    visit = chat._visit
    monkeypatch.setattr(chat, "_visit", lambda *a: visits.append(1) or visit(*a))
    QUERIES["op8_chat_formatting"](spark, "/root/testdata/sf0.001")
    assert visits
