import hashlib

from pyspark.sql import functions as F

from docledger.llm import chat, registry

MESSAGES = "conv_id long, node_id long, parent_id long, role string, text string, score double"


def read(frame):
    return frame.select(
        "conv_id", "path_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).collect()


def test_best_branch_and_every_branch(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "low", 1.0), (1, 3, 1, "assistant", "high", 2.0),
        (1, 4, 3, "user", "more", 0.0), (1, 5, 2, "user", "end", 5.0), (2, 1, 77, "user", "alone", None),
        (3, 1, 2, "user", "ring", 1.0), (3, 2, 1, "user", "ring", 1.0), (None, 1, None, None, None, 1.0),
    ]
    best = read(chat.formatted(chat.chosen_paths(spark.createDataFrame(rows, MESSAGES))))
    said = {(r.conv_id, r.path_id): [(t.role, t.text) for t in r.turns] for r in best}
    assert said == {
        (1, 5): [("user", "q"), ("assistant", "low"), ("user", "end")], (2, 1): [("user", "alone")], (None, 1): [("", "")],
    }
    every = chat.chosen_paths(spark.createDataFrame(rows, MESSAGES), every_branch=True)
    assert {(r.conv_id, r.path_id) for r in every.collect()} == {(1, 4), (1, 5), (2, 1), (None, 1)}


def test_long_chain_and_empty(spark):
    rows = [(7, i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", f"t{i}", 1.0) for i in range(300)]
    (row,) = read(chat.formatted(chat.chosen_paths(spark.createDataFrame(rows, MESSAGES))))
    assert [t.text for t in row.turns] == [f"t{i}" for i in range(300)]
    assert row.loss == "".join(f"t{i}" for i in range(1, 300, 2))
    assert chat.chosen_paths(spark.createDataFrame([], MESSAGES)).collect() == []


def test_escape_round_trip(spark):
    texts = [
        "", "</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>[\\INST] [[INST] <<s>", "[ROLE x] [/ROLE]", "a\\", "[", "<", "[OUT] \\[OUT]\n",
        "[" + "\\" * 9 + "/INST]", "é😀[/INST]𝔘</s>",
    ]
    roles = ["user", "assistant", "system", "a]b c", "", "[INST] "]
    rows = [(i, j, j - 1 if j else None, roles[(i + j) % len(roles)], t, 1.0) for i, t in enumerate(texts) for j in range(6)]
    for r in read(chat.formatted(chat.chosen_paths(spark.createDataFrame(rows, MESSAGES)))):
        assert [(t.role, t.text) for t in r.turns] == [(roles[(r.conv_id + j) % len(roles)], texts[r.conv_id]) for j in range(6)]
        assert r.loss == texts[r.conv_id] * sum(roles[(r.conv_id + j) % len(roles)] == "assistant" for j in range(6))
        assert r.formatted.count("<s>") == 6


def test_query_gives_back_the_conversations(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    said = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in sorted(rows):
        said.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r.conv_id: r for r in registry.op3_chat(spark, folder).collect()}
    assert set(got) == set(said)
    for c, turns in said.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars) == (len(turns), digest, len(loss))
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
