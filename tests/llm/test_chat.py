"""Chat windows: what is written can be read back."""

import hashlib

import numpy as np

from vigil.llm import chat


def _table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, windows string")


def test_escape_is_reversible():
    for t in [*chat.CONTROL, "\\", "\\<s>", "<\\s>", "<<s>>", "a\\\\[INST]", "".join(chat.CONTROL) * 2, "<", ""]:
        hidden = chat.escape(t)
        assert chat.unescape(hidden) == t
        assert not any(c in hidden for c in chat.CONTROL)


def test_spans_stay_in_budget_and_cover_each_turn_once():
    rng = np.random.default_rng(3)
    for _ in range(50):
        tokens = rng.integers(1, 90, rng.integers(1, 40))
        seen = []
        for shown, new, end in chat.spans(tokens, 100, 30):
            assert tokens[shown:new].sum() <= 30 and shown <= new < end
            assert tokens[shown:end].sum() <= 100 or end == new + 1
            seen += range(new, end)
        assert seen == list(range(len(tokens)))


def test_round_trip_of_odd_conversations(spark):
    rows = [(1, 0, "system", "Be brief. " * 5, "w"), (1, 1, "user", "</s>[INST] ok [/INST]", "w"), (1, 2, "assistant", None, "w"),
            (1, 3, "user", "more", "w"), (1, 4, "assistant", "x " * 3000, "w"), (1, 5, None, "no role", "w"),
            (2, 0, "assistant", "first", "w"), (2, 0, "assistant", "first", "w"), (3, 0, "system", "alone", "w"),
            (None, 0, "user", "no id", "w"), (4, 1, "assistant", "b\\", "w"), (4, 0, "user", "<|im_end|>", "w")]
    made = chat.format_windows(_table(spark, rows), budget=60, history=10)
    out = {r.conv_id: r for r in made.collect()}
    digest = {r.conv_id: r for r in chat.digests(made).collect()}
    assert set(out) == {1, 2, 3, 4, None}
    for conv in out:
        turns = sorted(((t, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        turns = [(r, x) for _, r, x in turns]
        got, loss = chat.read_back([w.asDict(recursive=True) for w in out[conv].windows])
        assert got == turns
        assert loss == "".join(x for r, x in turns if r == "assistant")
        assert digest[conv].n_turns == len(turns)
        assert digest[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
    # the system turn opens every window of its conversation
    assert len(out[1].windows) > 1 and all("system<|im_sep|>" in w.text for w in out[1].windows)


def test_empty_table(spark):
    assert chat.digests(chat.format_windows(_table(spark, []))).count() == 0
