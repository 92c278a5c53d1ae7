"""Token ids in Parquet list columns with chosen encodings, row groups and page indexes."""

from __future__ import annotations

import json
import os
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbalance.llm.common import table
from fieldbalance.session import new_shared_path

END = 0


def public_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


#: A task remembers at most so many pieces, and so many of their characters.
PIECES = 500_000
PIECE_CHARACTERS = 16 << 20
#: Characters of text that leave a task together; a longer text leaves alone.
BATCH_CHARACTERS = 1 << 20


class _Uneven(Exception):
    """A space beside other white space, where a text may not be cut."""


#: Pieces that are encoded as one text.
TOGETHER = 1024
#: Marks that are a word of their own after a letter at the end of a piece.
MARKS = ".,;:!?"


class _Pieces(dict):
    """Token ids of texts, each piece between two spaces encoded once while it is held.

    Keys are pieces without the space before them, values eight times their place in
    `starts` and `sizes`, which cut `ids`, plus the number of a mark that follows. Place 0
    is the end of a document; texts that are not held have places below 0.
    """

    def __init__(self, tokenizer, end: int):
        import numpy as np
        self.tokenizer, self.end = tokenizer, end
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        added = json.loads(tokenizer.to_str())["added_tokens"]
        # A byte-level token has one character for each of its bytes.
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        for token in added:
            self.bytes[token["id"]] = len(token["content"].encode())
        marks = [m for m in MARKS if m in vocabulary and not any(m in t["content"] for t in added)]
        self.marks = {m: i for i, m in enumerate(marks, 1)}
        self.mark_ids = np.array([end] + [vocabulary[m] for m in marks], np.int32)
        self.forget()

    def forget(self) -> None:
        import numpy as np
        self.clear()
        self.new, self.alone, self.characters = [], [], 0
        self.ids, self.starts, self.sizes = np.array([self.end], np.int32), np.array([0]), np.array([1])

    def encode(self, texts: list[str]):
        import numpy as np
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __missing__(self, piece: str) -> int:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Uneven
        self.characters += len(piece)
        mark = self.marks.get(piece[-1])
        if mark and piece[-2:-1].isascii() and piece[-2:-1].isalpha():
            value = self[piece[:-1]] + mark
        else:
            self.new.append(" " + piece)
            value = 8 * (len(self.sizes) - 1 + len(self.new))
        self[piece] = value
        return value

    def not_held(self, text: str) -> int:
        self.alone.append(text)
        return -8 * len(self.alone)

    def places(self, text: str) -> list[int]:
        """A text as places: its first piece has no space before it. An uneven text stays whole."""
        if not text:
            return [0]
        head, *rest = text.split(" ")
        if rest and head and not head[-1].isspace():
            try:
                rest = list(map(self.__getitem__, rest))
                return [self.not_held(head), *rest, 0]
            except _Uneven:
                pass
        return [self.not_held(text), 0]

    def learn(self) -> None:
        """Encode the new pieces, many as one text; bytes of the ids tell where each ends."""
        import numpy as np
        ids, sizes = [self.ids], [self.sizes]
        for at in range(0, len(self.new), TOGETHER):
            some = self.new[at:at + TOGETHER]
            got, = self.encode(["".join(some)])
            ends = np.cumsum([len(p.encode()) for p in some])
            reached = np.cumsum(self.bytes[got])
            last = np.searchsorted(reached, ends)
            if len(got) and reached[-1] == ends[-1] and (reached[last] == ends).all():
                ids.append(got)
                sizes.append(np.diff(last, prepend=-1))
            else:
                each = self.encode(some)
                ids += each
                sizes.append(np.array([len(x) for x in each]))
        self.new = []
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def tokens(self, texts: list[str]):
        """(offsets, ids) of the texts one after the other, the end id after each."""
        import numpy as np
        if len(self) > PIECES or self.characters > PIECE_CHARACTERS:
            self.forget()
        found = [np.array(self.places(text)) for text in texts]
        if self.new:
            self.learn()
        # An encoding takes far more memory than its ids: some texts at a time.
        lists = []
        for at in range(0, len(self.alone), TOGETHER):
            lists += self.encode(self.alone[at:at + TOGETHER])
        self.alone = []
        sizes = np.concatenate([self.sizes, np.array([len(x) for x in lists], np.int64)])
        starts = np.concatenate([self.starts, np.cumsum(sizes)[len(self.sizes):] - sizes[len(self.sizes):]])
        pool = np.concatenate([self.ids, *lists])
        at = np.concatenate(found)
        mark, at = at & 7, at >> 3
        at = np.where(at < 0, len(self.sizes) - 1 - at, at)
        size = sizes[at] + (mark > 0)
        after = np.cumsum(size)
        # The place of a mark reads one id too far; it is set next.
        ids = pool.take(np.arange(after[-1]) + np.repeat(starts[at] - after + size, size), mode="clip")
        ids[after[mark > 0] - 1] = self.mark_ids[mark[mark > 0]]
        return np.concatenate([[0], after[np.cumsum([len(f) for f in found]) - 1]]), ids


def _cuts_at_spaces(tokenizer) -> bool:
    """Whether a space between two other characters always begins a new word of the tokenizer.

    So it is for the byte-level pattern; an added token must not hold or eat spaces.
    """
    parts = json.loads(tokenizer.to_str())
    before = parts["pre_tokenizer"] or {}
    return (before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before["add_prefix_space"] and parts["normalizer"] is None and parts["truncation"] is None
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                        for t in parts["added_tokens"]))


def write_tokens(docs: DataFrame, path: str, vocabulary: str, encoding: str = "delta",
                 row_group_bytes: int = 32 << 20, page_rows: int = 2000, end: int = END,
                 files: int | None = None) -> None:
    """Write doc_id, part, n_tokens, ids in ascending doc_id order.

    A null text counts as empty and has the end id only. Other columns are not
    written. Rows that share a doc_id all stay. A text of any length is encoded whole; an
    empty table gives no rows. encoding "delta" writes integers delta-packed, "dictionary"
    through a dictionary of ids. Where the tokenizer cuts at single spaces anyway, pieces
    between spaces are looked up and only new ones encoded, with the same ids.
    """
    def encode(batches):
        import numpy as np
        import pyarrow as pa
        from tokenizers import Tokenizer
        # Spark's tasks are the threads; more would only hold more memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(vocabulary)
        pieces = _Pieces(tokenizer, end)
        if not _cuts_at_spaces(tokenizer):
            pieces.places = lambda text: [pieces.not_held(text), 0] if text else [0]
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            at = 0
            while at < len(texts):
                stop, characters = at, 0
                while stop < len(texts) and (stop == at or characters + len(texts[stop]) <= BATCH_CHARACTERS):
                    characters += len(texts[stop])
                    stop += 1
                offsets, ids = pieces.tokens(texts[at:stop])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(at, stop - at), pa.array(np.diff(offsets)),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))],
                    ["doc_id", "n_tokens", "ids"])
                at = stop

    spark = docs.sparkSession
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count = files or max(spark.sparkContext.defaultParallelism, wanted.rdd.getNumPartitions())
    (wanted.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(encode, "doc_id long, n_tokens long, ids array<int>")
     .withColumn("part", F.spark_partition_id())
     .write.option("parquet.block.size", row_group_bytes)
     .option("parquet.page.row.count.limit", page_rows)
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("compression", "zstd").parquet(path))


def read_tokens(spark: SparkSession, path: str, columns=("doc_id", "n_tokens", "ids")) -> DataFrame:
    """Chosen columns of the files; filters on doc_id use the page indexes."""
    return spark.read.parquet(path).select(*columns)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    def digest(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            ids, ends = batch["ids"].values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), batch["ids"].offsets.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["part"], pa.array(np.diff(ends).astype(np.int64)),
                 pa.array([zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())],
                ["doc_id", "part", "n_tokens", "ids_crc32"])

    files = spark.read.parquet(path).select("part", "n_tokens").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per file.
    at = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.withColumn("offset", F.coalesce(F.sum("n").over(at), F.lit(0))).select("part", "offset")
    rows = read_tokens(spark, path, ("doc_id", "part", "ids")).mapInArrow(
        digest, "doc_id long, part int, n_tokens long, ids_crc32 long")
    before = Window.partitionBy("part").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
            .join(F.broadcast(offsets), "part")
            .select("doc_id", (F.col("offset") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_vocabulary())
    return token_index(spark, path)
