"""Token ids: pieces against whole texts, and what the files hold."""

import glob
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from fieldbalance.llm import tokens


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.public_vocabulary())


def pieces_of(tokenizer):
    return tokens._Pieces(tokenizer, 0)


def test_pieces_give_the_ids_of_the_whole_text(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "PIECES", 300)  # forgets often
    rnd = random.Random(5)
    parts = [" ", " ", " ", "  ", "\n", "\t", "\r\n", " ", " ", "\u0085", "\x1c", "a", "B7", "it's", "'ll", " 's",
             "12", "...", "a,", "word.", "Why?!", "é.", "x;y:", ",", "é", "ß", "中文", "🙂", "<|endoftext|>", "<|endof", "́", "​", "Q" * 90]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    pieces = pieces_of(tokenizer)
    for at in range(0, len(texts), 50):
        offsets, ids = pieces.tokens(texts[at:at + 50])
        for i, text in enumerate(texts[at:at + 50]):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_pieces_whose_bytes_do_not_add_up_are_encoded_one_by_one(tokenizer):
    pieces = pieces_of(tokenizer)
    pieces.bytes[tokenizer.token_to_id("e")] = 2
    text = "one two, three greener é. <|endoftext|> " + " ".join(f"w{i}e" for i in range(3000))
    want = tokenizer.encode(text, add_special_tokens=False).ids + [0]
    assert pieces.tokens([text, "", text])[1].tolist() == want + [0] + want


def test_only_tokenizers_that_cut_at_spaces_are_cut(tokenizer):
    assert tokens._cuts_at_spaces(tokenizer)
    other = Tokenizer.from_file(tokens.public_vocabulary())
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    assert not tokens._cuts_at_spaces(other)
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    assert not tokens._cuts_at_spaces(other)


def test_files_hold_the_encoding_asked_for_and_page_indexes(spark, tmp_path):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("words of "), F.col("id").cast("string")).alias("text"),
                                    F.lit(1).alias("n_tokens"))
    for encoding, wanted in (("delta", "DELTA_BINARY_PACKED"), ("dictionary", "RLE_DICTIONARY")):
        path = str(tmp_path / encoding)
        tokens.write_tokens(docs, path, tokens.public_vocabulary(), encoding=encoding, page_rows=100, files=2)
        for file in glob.glob(f"{path}/*.parquet"):
            group = pq.ParquetFile(file).metadata.row_group(0)
            columns = {c.path_in_schema: c for c in map(group.column, range(group.num_columns))}
            ids = next(c for name, c in columns.items() if name.startswith("ids"))
            assert wanted in ids.encodings
            assert ids.has_offset_index and columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
    one = tokens.read_tokens(spark, path).where("doc_id BETWEEN 1234 AND 1236")
    assert [r.doc_id for r in one.orderBy("doc_id").collect()] == [1234, 1235, 1236]
    narrow = tokens.read_tokens(spark, path, ("doc_id", "n_tokens")).where("doc_id = 7")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan and "EqualTo(doc_id,7)" in plan
