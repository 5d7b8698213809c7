import hashlib

from pyspark.sql import functions as F

from demandlens.llm import chat


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_control_strings(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nok", "\\l\\\\n\\", "<", "|", "a\nb\n", "", None, "é<|image|>ü\\<", "<<||>>"]
    rows = [(c, t, r, x) for c, r in enumerate(["assistant", "user", "sys\ntem<|", None, "ass\\istant"]) for t, x in enumerate(nasty)]
    rows += [(9, 0, "user", "q"), (9, 1, "assistant", "ä<1"), (9, 2, "user", "r"), (9, 3, "assistant", "b\\"), (None, 0, "assistant", "n"), (None, None, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as conv", "2 as formatted", "3 as at")
    made = chat.format_chat(df.withColumn("parts", chat.text_parts(F.col("text"))))
    found = {r.conv_id: r for r in chat.digest(made).collect()}
    read = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert len(found) == 7
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is None, r[1] or 0))
        turns = [(r or "", x or "") for _, _, r, x in own]
        learned = "".join(x for r, x in turns if r == "assistant")
        assert [(t.role, t.text) for t in read[c].turns] == turns
        assert found[c].n_turns == len(turns)
        assert found[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for r, x in turns))
        assert (found[c].loss_chars, found[c].loss_sha256) == (len(learned), sha(learned))
        assert found[c].formatted_chars == len(read[c].formatted)


def test_typed_parts(spark):
    parts = [
        ("text", "look < here", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None),
        ("text", "and", None, None, None, None, None), ("audio", None, "b.wav", None, None, 1.5, None),
        ("document", None, None, None, None, None, 3), ("video", "?", "c.mp4", None, None, None, None), (None, "x", None, None, None, None, None),
    ]
    df = spark.createDataFrame([(1, 1, "assistant", parts), (1, 0, "user", None), (1, 2, "user", [])],
                               f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.format_chat(df).first()
    assert row.formatted == (
        "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nlook \\l here<|image|>and<|audio|><|document|><|other|><|other|><|im_end|>\n"
        "<|im_start|>user\n<|im_end|>\n"
    )
    assert [tuple(a) for a in row.attachments] == [
        (1, 1, "image", "a.png", 3), (1, 3, "audio", "b.wav", 38), (1, 4, "document", "", 768), (1, 5, "video", "c.mp4", 0), (1, 6, "", "", 0),
    ]
    assert [tuple(m) for m in row["mask"]] == [(1, len("<|im_start|>assistant\n"), len("look \\l here<|image|>and<|audio|><|document|><|other|><|other|>"))]
    assert chat.format_chat(df.limit(0)).collect() == []
