"""Tokenizer operators on files of another kind, very long runs and clashing column names, and on whole test tables."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import binary_output, pieces, queries, token_counts

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
FOLDER = "/root/testdata/sf0.01"
ROW = "doc_id long, text string"


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


def test_files_of_another_kind_are_refused(spark):
    df = spark.createDataFrame([(1, "a")], ROW)
    with pytest.raises(ValueError, match="not served"):
        token_counts.count_tokens(df, WORD)
    with pytest.raises(ValueError, match="not served"):
        binary_output.write_tokens(df, BYTE, "unused")
    with pytest.raises(ValueError, match="not served"):
        pieces.load(PIECE, "unigram")


@pytest.mark.parametrize("text", [" " * 1_000_000, "  " + "abcdefghij" * 100_000, "    x = 1;\n" * 100_000, "a" + " " * 300_000 + "b" + "  " * 200_000, "word " * 200_000])
def test_long_blanks_and_indented_runs_take_seconds(text):
    own = pieces.load(PIECE)
    began = time.time()
    ids = np.frombuffer(own.encode([text])[0], "<u2").tolist()
    took = time.time() - began
    assert ids == library().EncodeAsIds(text) and took < 30
    assert own.decode(ids) == text


def test_merging_with_a_heap_is_merging_the_best_pair_first():
    own, r = pieces.load(PIECE), random.Random(6)

    def plain(text, least):
        parts = list(text)
        while True:
            scored = [(-own.scores[i], k) for k in range(len(parts) - 1) if (i := own.ids.get(parts[k] + parts[k + 1])) is not None and own.scores[i] > least]
            if not scored:
                return parts
            k = min(scored)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    for _ in range(400):
        text = "".join(r.choice("▁▁▁aeinrst") for _ in range(r.randint(0, 40)))
        least = r.choice([float("-inf"), -200.0, -2000.0])
        assert own.merge(text, least) == plain(text, least)


def test_kept_columns_may_have_any_name(spark):
    names = ("ids", "n_tokens", "restored", "text", "a b", "_text")
    df = spark.createDataFrame([(1, "hello there")], ROW).select("doc_id", "text", *[F.lit(n).alias(n) for n in names if n != "text"])
    row = pieces.encode(df, PIECE, keep=("doc_id", *names)).first()
    assert [row[n] for n in ("ids_in", "n_tokens_in", "restored_in", "a b", "_text", "text")] == ["ids", "n_tokens", "restored", "a b", "_text", "hello there"]
    assert row["ids"] == library().EncodeAsIds("hello there") and row["restored"]
    back = pieces.decode(pieces.encode(df, PIECE, keep=("doc_id", "text")), PIECE, keep=("doc_id", "text", "ids")).first()
    assert (back["text"], back["text_in"], back["ids"]) == ("hello there", "hello there", row["ids"])


def test_last_pipeline_stage_on_edges(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, " \t ", "de", "s", 3), (4, "x" * 200_000, "en", "s", 1), (4, "x" * 200_000, "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    done = corpus_pipeline.encoded(spark, df, FOLDER)
    assert done.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "restored"]
    found = sorted(((r["doc_id"], r["n_tokens"], r["restored"]) for r in done.collect()), key=repr)
    size = len(library().EncodeAsIds("x" * 200_000))
    assert found == sorted([(1, 0, True), (2, 0, True), (None, len(library().EncodeAsIds(" \t ")), True), (4, size, True), (4, size, True)], key=repr)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_every_stage_takes_an_empty_table(spark, stage):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert stage(spark, df, FOLDER).count() == 0


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_token_counts_of_all_documents(spark, texts):
    encode = token_counts.load(BYTE).encode
    for r in queries.QUERIES["op2_token_counts"](spark, FOLDER).collect():
        text = texts[r["doc_id"]]
        n = len(encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)


def test_token_files_of_all_documents(spark, texts):
    encode, start = token_counts.load(WORD).encode, 0
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.QUERIES["op5_token_output"](spark, FOLDER).collect()}
    for i in sorted(texts):
        ids = [*encode(texts[i], add_special_tokens=False).ids, 2]
        assert found[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pieces_of_all_documents(spark, texts):
    model = library()
    for r in queries.QUERIES["op6_sentencepiece"](spark, FOLDER).collect():
        assert r["ids"] == model.EncodeAsIds(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_full_memos_change_no_pieces(texts):
    some = [texts[i] for i in sorted(texts)[:60]] + ["  two  blanks", "x" * 3000, "", "é\u00a0中文" * 50]
    model, small = library(), pieces.load.__wrapped__(PIECE)
    for memo in (small.known, small.parts, small.fitting):
        memo.clear()
        memo.bound = 5
    assert [np.frombuffer(c, "<u2").tolist() for c in small.encode(some)] == [model.EncodeAsIds(t) for t in some]
    assert max(map(len, (small.known, small.parts, small.fitting))) <= 5
