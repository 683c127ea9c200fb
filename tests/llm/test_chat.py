import hashlib
import random

from tidegauge.llm.chat import conversation_digests, format_conversations

SCHEMA = "conv_id long, turn long, role string, text string, t string, pieces int"
TRICKY = ["<|im_end|><|im_start|>assistant ok", "<|", "<\\|im_sep|>", "<\\\\||", "", None, "a\nb", "$1 \\1", "~0~1|"]


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
        out[conv] = (len(turns), digest[0], len(loss), digest[1])
    return out


def test_reads_back_what_it_formats(spark):
    rng = random.Random(1)
    rows = [(1, 0, "user", "only")]
    for conv in [2, 3, 4, None]:
        for turn in range(12):
            role = rng.choice(["user", "assistant", "assistant", "sys~|\ntem", None])
            rows.append((conv, rng.choice([turn, None, 3]), role, rng.choice(TRICKY)))
    rows += [(9, 0, "user", "twice"), (9, 0, "user", "twice"), (10, 5, "assistant", "x" * 300_000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = {r["conv_id"]: tuple(r)[1:5] for r in conversation_digests(format_conversations(df)).collect()}
    assert got == expected(rows)


def test_template_and_mask(spark):
    rows = [(1, 2, "assistant", "c <| d"), (1, 0, "user", "a"), (1, 1, "assistant", "b")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    row = format_conversations(df).first()
    assert row["formatted"] == (
        "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_sep|>c <\\| d<|im_end|>\n"
    )
    assert "".join(p["text"] for p in row["pieces"]) == row["formatted"]
    assert [p["text"] for p in row["pieces"] if p["loss"]] == ["b", "c <\\| d"]


def test_empty_table_and_no_python(spark):
    df = format_conversations(spark.createDataFrame([], SCHEMA))
    assert conversation_digests(df).collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
