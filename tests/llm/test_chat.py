import hashlib
import re
from collections import defaultdict

from tickloom.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, turns string, formatted string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def expected(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t if t is not None else 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        under = "".join(x for *_, r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest())
    return out


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b<|part|>"), (1, 3, "user", "<|end|><|turn|>user<|text|>"),
    (2, 0, "system", None), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (2, None, None, "x"), (2, 3, "<|text|>", "\\<\\\\/s></s>"),
    (None, 5, "user", "é\U0001f600\n"), (None, 4, "assistant", "<\\/s>[\\INST][/INST"), (3, 0, "assistant", "]</s>"),
    (4, 0, "user", None), (5, 0, "assistant", "$1 \\1 \\E \\Q <|end|"), (5, 1, "assistant", "|>"),
] + [(6, k, "assistant" if k % 3 else "user", f"t{k} " + "</s>" * (k % 4)) for k in range(2000)]


def test_round_trip(spark):
    df = chat.formatted(table(spark, ROWS))
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    want = expected(ROWS)
    assert set(got) == set(want)
    for c, r in got.items():
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want[c], c
    texts = {r.conv_id: r for r in df.collect()}
    for c, r in texts.items():
        assert "".join(s.text for s in r.segments) == r.formatted and len(r.formatted) == got[c].formatted_chars
        # a control string stands only where the template put it
        assert r.formatted.count(chat.TURN) == r.formatted.count(chat.END) and not re.search(r"</?s>|\[/?INST\]", r.formatted)
    assert texts[1].formatted == "<|turn|>user<|text|>hi<|end|><|turn|>assistant<|text|>a<|part|>b<\\|part|><|end|><|turn|>user<|text|><\\|end|><\\|turn|>user<\\|text|><|end|>"


def test_empty(spark):
    assert chat.digests(chat.formatted(table(spark, []))).collect() == []


def test_only_spark_expressions(spark):
    plan = chat.digests(chat.formatted(table(spark, ROWS)))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
