"""Chat formatting: reversible escapes, masks, and typed parts."""

import hashlib
import random

from pyspark.sql import functions as F

from gridplace.llm.chat_format import PART, digest_chats, format_chats, parse_chats

from .rows import by_id

SCHEMA = "conv_id long, turn long, role string, text string, piece string, n string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def chats(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def odd_rows():
    rnd = random.Random(3)
    bits = ["\\", "#", "###", "### ", "</turn>", "</turn>\n", "<|", "|>", "<", "b", "h", "e", "l", "c", ":", ": ", "\n", "user", "é日😀", ""]
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "a: b###", None]), "".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 14)))) for c in range(40) for t in range(rnd.randrange(1, 6))]
    rows += [(None, 0, "user", "lost"), (50, None, "assistant", None), (50, 0, "assistant", "second"), (50, 0, "assistant", "second")]
    rows += [(60, t, "assistant", f"turn {t} ") for t in range(500)]
    return rows + [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def test_everything_is_read_back(spark):
    rows = odd_rows()
    convs = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    parsed = parse_chats(format_chats(chats(spark, rows)))
    got = {r.conv_id: r for r in parsed.collect()}
    assert set(got) == set(convs)
    for c, said in convs.items():
        assert sorted((t.role, t.text) for t in got[c].turns) == sorted(said)
        assert [t.role for t in got[c].turns if t.role != "assistant"] == [r for r, _ in said if r != "assistant"]
        assert list(got[c].loss_texts) == [t.text for t in got[c].turns if t.role == "assistant"]
    want = []
    for c, r in got.items():
        loss = "".join(r.loss_texts)
        want.append((c, len(r.turns), sha("".join(f"{t.role}\n{t.text}\n" for t in r.turns)), len(loss), sha(loss), len(r.formatted)))
    assert by_id(digest_chats(parsed).collect()) == by_id(want)
    assert parse_chats(format_chats(chats(spark, []))).collect() == []


def test_parts_become_placeholders(spark):
    part = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    assert part == PART
    content = [("text", "look ", None, None, None, None, None), ("image", None, "s3://i", 1024, 513, None, None), ("text", "<|image:0|> and", None, None, None, None, None),
               ("audio", None, "a", None, None, 2.1, None), None, ("document", None, "d", None, None, None, 3), (None, " end", None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", content), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, content array<{part}>")
    r = format_chats(df, text_col=None, parts_col="content").collect()[0]
    assert r.formatted == "### user: look <|image:0|>\\limage:0|> and<|audio:1|><|document:2|> end</turn>\n### assistant: </turn>\n"
    assert [(a.turn, a.ordinal, a.kind, a.ref, a.tokens) for a in r.attachments] == [(0, 0, "image", "s3://i", 4 * 256), (0, 1, "audio", "a", 53), (0, 2, "document", "d", 1536)]
    assert r.expanded_tokens == 1024 + 53 + 1536


def test_spans_are_code_points_of_the_whole(spark):
    df = chats(spark, [(1, 0, "user", "😀é"), (1, 1, "assistant", "日😀x"), (1, 2, "assistant", "")])
    r = format_chats(df).collect()[0]
    assert [r.formatted[s.start : s.end] for s in r.loss_spans] == ["日😀x", ""]


def test_no_python_in_the_plan(spark):
    plan = digest_chats(parse_chats(format_chats(chats(spark, odd_rows()))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
    assert plan.filter(F.col("n_turns") < 1).count() == 0
