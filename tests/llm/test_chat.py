"""Perspective rotation of dialogues."""

from pyspark.sql import functions as F

from tallyrisk.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"


def test_rotation(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi 🙂"), (1, 2, "bob", "Hello"), (1, 3, "cem", ""),
            (1, 3, "ann", None), (2, 0, "system", "alone"), (3, 0, None, "who"), (None, 0, "x", "null id"),
            (4, 0, "u", "same"), (4, 0, "u", "same"), (4, None, "v", "first")]
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({"part": F.lit("clash"), "mask": F.lit(1)})
    got = {(r.conv_id, r.perspective): r for r in C.rotate(turns).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "cem"), (3, "unknown"), (None, "x"), (4, "u"), (4, "v")}
    ann = got[1, "ann"]
    assert ann.rendered == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi 🙂<|im_end|>\n"
        "<|im_start|>user name=bob\nHello<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
        "<|im_start|>user name=cem\n<|im_end|>\n")
    assert [ann.rendered[m.start:m.end] for m in ann["mask"]] == ["Hi 🙂<|im_end|>", "<|im_end|>"]
    assert got[4, "u"].n_turns == 3 and got[4, "u"].rendered.startswith("<|im_start|>user name=v\nfirst")
    for (_, who), r in got.items():
        heads = r.rendered.split("<|im_start|>assistant\n")
        assert len(heads) - 1 == len(r["mask"]) and f"name={who}\n" not in r.rendered


def test_long_conversation_is_cut_into_parts(spark):
    rows = [(7, i, "ab"[i % 2], f"t{i}") for i in range(1000)]
    got = C.rotate(spark.createDataFrame(rows, SCHEMA), part_turns=100).collect()
    assert len(got) == 20 and all(r.n_turns == 100 and len(r["mask"]) == 50 for r in got)
    text = "".join(r.rendered for r in sorted(got, key=lambda r: r.part) if r.perspective == "a")
    assert [f"t{i}<" in text for i in range(1000)] == [True] * 1000


def test_empty(spark):
    assert C.rotate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_parts_of_a_long_conversation_join_into_one_rendering(spark):
    long = [(7, 0, "system", "Be kind.")] + [(7, i, ["ann", "bo"][i % 3 == 0], f"t{i}") for i in range(1, 700)]
    untimed = [(None, None, "x", f"same {i % 5}") for i in range(600)] + [(None, 3, "y", "end")]
    got = C.rotate(spark.createDataFrame(long + untimed, SCHEMA)).collect()
    for conv, rows in ((7, long), (None, untimed)):
        rows = sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2], r[3]))
        for who in {r[2] for r in rows} - {"system"}:
            text, spans = "", []
            for _, _, role, said in rows:
                name = "assistant" if role == who else role if role == "system" else f"user name={role}"
                text += f"<|im_start|>{name}\n"
                if role == who:
                    spans.append((len(text), len(text) + len(said) + 10))
                text += f"{said}<|im_end|>\n"
            parts = sorted((r for r in got if r.conv_id == conv and r.perspective == who), key=lambda r: r.part)
            assert [r.part for r in parts] == [0, 1, 2]
            assert [r.n_turns for r in parts] == [256, 256, len(rows) - 512]
            assert "".join(r.rendered for r in parts) == text
            assert [(m.start, m.end) for r in parts for m in r["mask"]] == spans


def test_sql_holds_for_long_dialogues(spark):
    import duckdb

    from tallyrisk.llm import queries as Q

    rows = [(7, i, ["ann", "bo", "system"][i % 3], f"t{i}") for i in range(700)]
    rows += [(None, None, "x", f"same {i % 5}") for i in range(513)] + [(None, 3, None, None), (8, 0, "u", "Hi 🙂")]
    rows += [(9, 100_000 + i, "ab"[i % 2], "x") for i in range(256)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.execute(Q.ORACLE["op3_chat_rotation"]).fetchall()
    got = Q.rotation_digest(C.rotate(spark.createDataFrame(rows, SCHEMA)))
    got = got.select("conv_id", "perspective", "part", "n_turns", "rendered", "mask").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
