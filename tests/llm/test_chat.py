import hashlib
import json

import pytest

from tidewater.llm import chat as C

from .helpers import same_as_oracle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_oracle(spark, sf):
    same_as_oracle(spark, sf, "op7_chat_formatting")


def test_hostile_texts_come_back(spark):
    hard = ["", "\\", "</turn>", "\\</turn>\n### assistant: x", "####", "\\\\###\\", "a\n### user: b</turn>\n", "</turn></turn>", "é🙂", ": ", "x" * 50_000, "</tur", "#"]
    rows = [(1, n, role, t) for n, t in enumerate(hard) for role in ("user", "assistant")]
    rows += [(2, 0, "odd: ro\\le\n###</turn>", "t"), (2, None, None, None), (2, 5, "assistant", None), (None, 1, "user", "no id"), (3, 1, "b", "tie"), (3, 1, "a", "tie"), (3, 1, "a", "tie")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id long, turn long, role string, text string, piece string, loss_chars int")
    got = {r.conv_id: r for r in C.read_back(C.formatted(C.turns_of_table(df, "conv_id"))).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        g = got[conv]
        assert g.n_turns == len(turns) and g.turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
        assert g.loss_chars == len(learned) and g.loss_sha256 == sha(learned)
    assert C.read_back(C.formatted(C.turns_of_table(df.limit(0), "conv_id"))).count() == 0


def test_layouts_of_json_records(spark):
    records = [
        {"messages": [{"role": "user", "content": "q", "extra": 1}, {"role": "assistant", "content": "a"}], "id": 7},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"turns": [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}]},
        {"instruction": "q", "output": "a"},
        {"system": "s", "instruction": "q", "input": "i", "output": "a"},
        {"prompt": "q", "completion": "a", "score": 0.5},
        {"prompt": "q", "response": "a"},
        {"context": "c", "question": "q", "answer": "a"},
        {"role": "gpt", "text": "alone"},
        {"unknown": "x"},
        {"prompt": "q"},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(90, None), (91, "{broken")], "id long, record string")
    got = {}
    for r in C.turns_of_json(df, "id", "record").orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    qa = [("user", "q"), ("assistant", "a")]
    assert [[x[1:] for x in got[i]] for i in (0, 1, 2, 3, 5, 6)] == [qa] * 6
    assert [x[1:] for x in got[4]] == [("system", "s"), ("user", "q\n\ni"), ("assistant", "a")]
    assert [x[1:] for x in got[7]] == [("user", "c\n\nq"), ("assistant", "a")] and got[8] == [("turn rows", "assistant", "alone")]
    assert [got[i] for i in (9, 10, 90, 91)] == [[(None, None, None)]] * 4


def test_layouts_of_tables(spark):
    df = spark.createDataFrame([(1, "q", "a", 3), (2, "q", None, 3)], "id long, instruction string, output string, turn int")
    rows = [tuple(r) for r in C.turns_of_table(df, "id").orderBy("conv_id", "turn").collect()]
    assert rows == [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "q")]
    with pytest.raises(ValueError):
        C.turns_of_table(df.select("id"), "id")
    marks = C.layout_table()
    assert len({m for m in marks}) == len(marks) and C.fingerprint(["role", "text", "whatever"]) == C.fingerprint(["text", "role"])
