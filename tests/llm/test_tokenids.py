import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from material import awkward, documents, prose
from tokenizers import Tokenizer

from docledger.llm import jaccard, langid, tokenids, words
from docledger.llm.words import scratch_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, ids, zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    return out


def odd_texts():
    return [
        "a  b", " lead", "trail ", "x \n y", "tab\t z", "it's  we'll I'm", "<|endoftext|> in <|endoftext|>text", "nul\0 char \0", "  wide   white",
        "é ß 😀 x　 y", "\x1c \x1d", "...  !! ?", " ", "\n", "  \n  ", "end  ", "don't 've 'll", "1 22 333 a1 b2",
    ]


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(tokenids, "BLOCK_BYTES", 2_000)
    rows = awkward() + [(5000 + i, t) for i, t in enumerate(odd_texts())] + [(9000 - i, prose(i, 60)) for i in range(300)]
    folder = tokenids.write_token_ids(documents(spark, rows), scratch_folder(spark, "ids"), PATH, shards=4)
    got = tokenids.read_token_ids(spark, folder, with_ids=True).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), len(x), c) for i, x, c in expected(rows))
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place and len(r.ids) == r.n_tokens and r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        place += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    header = spark.read.parquet(f"{folder}/header").first()
    assert header.width == 2 and header.end_id == 2
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.count() > 8 and {r[0] for r in blocks.select("dict_sha256").distinct().collect()} == {header.dict_sha256}
    (one,) = tokenids.read_document(spark, folder, 8990).collect()
    assert one.ids == expected([(8990, prose(10, 60))])[0][1]


def test_dictionary_helps_short_documents(spark):
    rows = [(i, prose(i, 25)) for i in range(1500)]
    docs = documents(spark, rows)
    folder = tokenids.write_token_ids(docs, scratch_folder(spark, "ids"), PATH)
    assert len(spark.read.parquet(f"{folder}/header").first().dictionary) > 1000
    with_dictionary = sum(len(r.payload) for r in spark.read.parquet(f"{folder}/blocks").collect())
    import zstandard

    alone = sum(len(zstandard.compress(np.array(ids, dtype="<u2").tobytes())) for _, ids, _ in expected(rows))
    assert with_dictionary < 0.8 * alone


def test_pieces_are_kept_in_bounded_tables(monkeypatch):
    monkeypatch.setattr(tokenids, "KNOWN_PIECES", 20)
    encoder = tokenids.PieceEncoder(PATH)
    texts = [prose(i, 30) for i in range(20)] + odd_texts()
    got = [np.frombuffer(x, dtype="<u2").tolist() for t in texts for x in encoder.encode([t])]
    assert got == [ids[:-1] for _, ids, _ in expected([(0, t) for t in texts])]
    assert len(encoder.known) + len(encoder.older) < 120


def test_pieces_met_once_stay_out_of_a_table_that_was_full(monkeypatch):
    monkeypatch.setattr(tokenids, "KNOWN_PIECES", 20)
    encoder = tokenids.PieceEncoder(PATH)
    encoder.encode([prose(1, 60)])
    encoder.encode([" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)) + " again again, again."])
    assert len(encoder.known) < 20
    encoder.encode(["say again, and again.### (again!! again) again"])
    assert " again" in encoder.known
    assert not any(piece[-1] in ".,#!)" and piece[-2:-1].isalpha() for piece in encoder.known)


def test_pieces_met_once_are_not_encoded_again(monkeypatch):
    monkeypatch.setattr(tokenids, "KNOWN_PIECES", 20)
    encoder = tokenids.PieceEncoder(PATH)
    encoder.encode([prose(1, 60)])
    long = "x" * 100
    texts = [f"a zebrawort 77, {long} b", f"a zebrawort (zebrawort) 77. {long} b"]
    first, learn, learned = encoder.encode(texts[:1]), encoder.learn, []
    monkeypatch.setattr(encoder, "learn", lambda pieces: learned.extend(map(str, pieces)) or learn(pieces))
    got = [np.frombuffer(x, dtype="<u2").tolist() for x in first + encoder.encode(texts[1:])]
    assert got == [ids[:-1] for _, ids, _ in expected(enumerate(texts))]
    assert " zebrawort" not in learned and " 77" not in learned
    assert " (zebrawort" in learned and f" {long}" in learned  # long pieces are not kept
    assert " zebrawort" in encoder.known and not any(len(piece) > tokenids.PIECE_BYTES for piece in encoder.known)


def test_letters_go_to_the_model_as_the_tokenizer_splits_them():
    tokenizer = Tokenizer.from_file(PATH)
    encoder = tokenids.PieceEncoder(PATH)
    assert encoder.bare is not None
    signs = [*"abZéßÿŉǆɏɐʰµªº日иה²½Ⅷ1,.'!-#)`{_", "'s", "b'", " ", " ", " ", "\n", "\u0301", "\0", "<|endoftext|>"]
    pick = random.Random(4)
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 40))) for _ in range(3000)]
    got = [np.frombuffer(x, dtype="<u2").tolist() for i in range(0, 3000, 250) for x in encoder.encode(texts[i : i + 250])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_wrong_dictionary_is_refused(spark):
    one = tokenids.write_token_ids(documents(spark, [(1, "a b")]), scratch_folder(spark, "ids"), PATH)
    other = tokenids.write_token_ids(documents(spark, [(i, prose(i, 25)) for i in range(900)]), scratch_folder(spark, "ids"), PATH)
    read = tokenids._frames(b"", spark.read.parquet(f"{other}/header").first().dict_sha256, 2, False)
    batch = spark.read.parquet(f"{one}/blocks").select("shard", "dict_sha256", "entries", "payload").toArrow().to_batches()
    with pytest.raises(ValueError, match="dictionary"):
        list(read(iter(batch)))


def test_empty(spark):
    folder = tokenids.write_token_ids(documents(spark, []).limit(0), scratch_folder(spark, "ids"), PATH)
    assert tokenids.read_token_ids(spark, folder).collect() == []


def test_other_operators_free_the_pieces_a_worker_keeps():
    """Tables of the tokenizer would else count against every later stage that its worker serves."""
    text = pa.array(["one two", None])
    for other in (
        lambda: list(jaccard._measured(4, 8)(iter([]))),
        lambda: list(jaccard._sets(4)(iter([]))),
        lambda: list(langid._accepts(langid.train([]))(iter([text]))),
        lambda: list(langid._counted(iter([]))),
    ):
        tokenids._encoder(public_tokenizers.path("byte_bpe_50k.json")).encode(["one two three"])
        assert tokenids._ENCODERS
        other()
        assert not tokenids._ENCODERS


def test_texts_become_python_strings_a_few_at_a_time():
    some = list(tokenids._some(pa.array(["a", None, "c", "d"])[1:], 2))
    assert some == [["", "c"], ["d"]]


def test_unused_memory_goes_back_between_texts_and_behind_the_last_batch(monkeypatch):
    """Copies of the tables of pieces, and idle workers of other operators, else count against an executor."""
    steps = []
    for module in (tokenids, words):
        monkeypatch.setattr(module, "hand_back", lambda: steps.append("back"))
    monkeypatch.setattr(tokenids, "TEXT_BYTES", 8)
    for texts in tokenids._some(pa.array(["aaaa bbbb", None, "cccc dddd"])):
        steps.append(texts)
    assert steps == [["aaaa bbbb"], "back", ["", "cccc dddd"], "back"]
    text = pa.array(["one two"])
    batch = pa.RecordBatch.from_pydict({"text": text, "node": pa.array([1]), "doc_id": pa.array([1]), "row_id": pa.array([1])})
    nothing = pa.RecordBatch.from_pydict({c: pa.array([], pa.int64()) for c in ("k", "key", "node", "n", "place", "part")})
    for task, given in (
        (langid._accepts(langid.train([])), text),
        (jaccard._sets(4), batch),
        (jaccard._met(85), nothing),
        (jaccard._crossing(85), nothing),
    ):
        steps.clear()
        list(task(iter([given])))
        assert steps == ["back", "back"]
    steps.clear()
    rows = langid._accepts(langid.train([]))(iter([text, text]))
    next(rows)
    assert steps == ["back"]
    rows.close()  # a task that is not read to its end
    assert steps == ["back", "back"]
