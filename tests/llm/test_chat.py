"""Chat formatting: every turn comes back from the formatted text alone."""

import hashlib
import random

import pytest

from tessera.llm import chat, queries

PIECES = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<\\|im_end|>", "<\\\\|im_start|>", "\\", "<", "|", ">", "<|", "|>", "im_end", "\n", "assistant", "user", " ", "é😀", "<|other|>"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_every_turn_comes_back():
    said = [*texts(4000, 1), *PIECES, ""]
    roles = [*texts(4000, 2), *PIECES, ""]
    for role, text in zip(roles, said):
        for r in (role, "assistant"):
            written = chat.formatted_turn(r, text)
            ((r2, t2, a, b),) = chat.parse(written)
            assert (r2, t2) == (r, text) and chat.unescape(written[a:b]) == text
            assert chat._CONTROL.findall(written) == [chat.START, chat.END]
    assert chat.formatted_turn("user", "plain <| text |>") == "<|im_start|>user\nplain <| text |><|im_end|>\n"  # only what conflicts is escaped


@pytest.mark.parametrize("bad", ["x", "<|im_start|>user\nhi", "<|im_start|>user<|im_end|>\n", "<|im_start|>user\na<|im_start|>b<|im_end|>\n", "<|im_start|>user\na<|endoftext|><|im_end|>\n", "<|im_start|>user\na<|im_end|>", "<|im_start|>user\na<|im_end|>\nx"])
def test_grammar_refuses(bad):
    with pytest.raises(chat.Malformed):
        list(chat.parse(bad))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id bigint, turn bigint, role string, text string, Text string, part int, loss int").repartition(3)


def expected(rows):
    conversations = {}
    for c, turn, role, text in rows:
        conversations.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for c, turns in conversations.items():
        turns.sort()
        loss = b"".join(t for _, _, r, t in turns if r == b"assistant")
        digest = hashlib.sha256(b"".join(r + b"\n" + t + b"\n" for _, _, r, t in turns)).hexdigest()
        out[c] = (len(turns), digest, len(loss.decode()), hashlib.sha256(loss).hexdigest())
    return out


@pytest.mark.parametrize("part", [60, 1 << 22])
def test_conversations(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART", part)
    rng = random.Random(3)
    rows = [(rng.randint(0, 30), rng.choice([None, 0, 1, 2, 3, 3]), rng.choice(["user", "assistant", "assistant", None, "a\nb", "s\\n"]), t) for t in texts(300, 4)]
    rows += [(None, 0, "assistant", "no id"), (None, 1, "user", None), (40, 0, "user", None), (41, 0, "assistant", ""), (42, 0, "assistant", "x" * 100_000)]
    rows += [(50, i, "assistant" if i % 2 else "user", f"turn {i} <|im_end|>") for i in range(2000)]  # most rows are one conversation
    rows += rows[:20]
    formatted = chat.format_turns(frame(spark, rows))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert got == expected(rows)
    parts = formatted.filter("conv_id = 50").orderBy("part").collect()
    assert [r.part for r in parts] == list(range(len(parts))) and (len(parts) > 1) == (part == 60)
    whole = "".join(r.formatted for r in parts)
    assert [t for _, t, *_ in chat.parse(whole)] == [f"turn {i} <|im_end|>" for i in range(2000)]


def test_no_conversations(spark):
    assert chat.read_back(chat.format_turns(frame(spark, []))).count() == 0


def test_query_has_the_intruder(spark):
    got = {r.conv_id: r for r in queries.op12_chat(spark, "/root/testdata/sf0.001").collect()}
    assert got[-1].n_turns == 2 and got[-1].loss_sha256 == hashlib.sha256(queries.INTRUDER.encode()).hexdigest()
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{queries.INTRUDER}\nassistant\n{queries.INTRUDER}\n".encode()).hexdigest()
