"""Substring dedup: an FM-index over a wavelet matrix per shard, searched backwards."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.llm.common import byte_words, dropped, shingle_hashes, stored, table, tasks, word_hashes

WINDOW = 35
#: Words of the k-gram that decides the shard of a window.
ANCHOR = 12
#: Different pieces of one anchor from which its windows are dealt out one by one.
HOT = 2000
SHARD_WORDS = 250_000
#: Rows that are turned at a time: what comes out is wider than a row.
ROWS = 500


#: Words at the end of a pattern whose range is looked up; the words before them are searched backwards.
RUN = 16


class FMIndex:
    """Index of word sequences for patterns of up to `depth` words."""

    def __init__(self, words, sizes, weights, depth: int):
        """`words` of all sequences one after the other, `sizes` words each."""
        import numpy as np
        sizes = np.asarray(sizes, np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        joined = np.zeros(int((sizes + 1).sum()), np.int64)
        inside = np.ones(len(joined), bool)
        inside[starts + sizes] = False
        _, code = np.unique(words, return_inverse=True)
        joined[inside] = code + 1
        self.text, self.starts, self.sizes = joined, starts, sizes
        n = len(joined)
        # Where depth words agree the order does not matter: no pattern is longer.
        rank, step = joined.copy(), 1
        order = np.argsort(rank) if depth < 2 else None
        self.run = 0
        while step < depth:
            key = rank * (n + 1)
            key[:-step or None] += rank[step:] + 1 if step < n else 0
            order = np.argsort(key)
            ordered = key[order]
            head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
            rank = np.empty(n, np.int64)
            rank[order] = np.repeat(np.arange(len(head) - 1), np.diff(head))
            step *= 2
            if step <= RUN:
                self.run, self.run_low, self.run_high = step, head[:-1][rank], head[1:][rank]
        weight_at = np.repeat(np.asarray(weights, np.int64), sizes + 1)
        self.weight = np.concatenate([[0], np.cumsum(weight_at[order])])
        bwt = joined[order - 1]
        symbols = int(joined.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(joined, minlength=symbols))])[:-1]
        # Per level: where each place goes to, first if its symbol's bit is 0, then if it is 1.
        self.levels, current = [], bwt
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = ((current >> bit) & 1).astype(bool)
            before = np.concatenate([[0], np.cumsum(ones)])
            self.levels.append((bit, np.concatenate([np.arange(n + 1) - before, n - before[-1] + before])))
            current = np.concatenate([current[~ones], current[ones]])
        self.base = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol, at):
        width = len(self.text) + 1
        for bit, steps in self.levels:
            at = steps.take(((symbol >> bit) & 1) * width + at, mode="clip")
        return at

    def repeated(self, length: int):
        """(piece, offset) of every run of `length` words that occurs at least twice."""
        import numpy as np
        counts = np.maximum(self.sizes - length + 1, 0)
        piece = np.repeat(np.arange(len(counts)), counts)
        offset = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = self.starts[piece] + offset
        both = np.repeat([[0], [len(self.text)]], len(piece), axis=1)
        # The last words of a pattern are a run whose range is known; the others are searched.
        known = self.run if self.run < length else 0
        if known:
            both = np.stack([self.run_low[at + length - known], self.run_high[at + length - known]])
        for j in range(length - known - 1, -1, -1):
            symbol = self.text[at + j]
            both = self._down(symbol, both) + (self.first[symbol] - self.base[symbol])
            # A range that holds one occurrence only can never hold another.
            alive = np.flatnonzero(self.weight[both[1]] - self.weight[both[0]] >= 2)
            if len(alive) < len(at):
                piece, offset, at, both = piece[alive], offset[alive], at[alive], both[:, alive]
        return piece, offset


def anchors(hashes, window: int, anchor: int, sizes=None):
    """(position, start, windows, grams) of runs of windows with the same leftmost least k-gram.

    `hashes` are the words of one text, or of many one after the other, `sizes` words
    each; then positions and starts count from the first word of all, and no run leaves its text.
    """
    import numpy as np
    if len(hashes) < window:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    grams = shingle_hashes(hashes, anchor)
    # Leftmost least of 2, 4, 8, ... grams, then of as many as a window holds.
    wide, least, at = window - anchor + 1, grams, np.arange(len(grams))
    reach = 1
    while reach < wide:
        step = min(reach, wide - reach)
        later = least[step:] < least[:-step]
        least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
        reach += step
    first = np.concatenate([[True], at[1:] != at[:-1]])
    if sizes is None:
        start = np.flatnonzero(first)
        return at[start], start, np.diff(np.append(start, len(at))), grams
    ends = np.cumsum(sizes)
    heads = ends - sizes
    inside = np.zeros(len(hashes) + 1, np.int32)
    whole = sizes >= window
    np.add.at(inside, heads[whole], 1)
    np.add.at(inside, ends[whole] - window + 1, -1)
    inside = np.cumsum(inside)[:len(at)] > 0
    first[heads[whole]] = True
    first &= inside
    start = np.flatnonzero(first)
    # A run ends where the next begins, or with the last window of its text.
    text = np.searchsorted(ends, start, side="right")
    after = np.minimum(np.append(start[1:], len(at)), ends[text] - window + 1)
    return at[start], start, after - start, grams


def _parts(batches, rows: int):
    return (b.iloc[i:i + rows] for b in batches for i in range(0, len(b), rows))


def _digest(words) -> bytes:
    import hashlib
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def repeats(rows: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT,
            shard_words: int = SHARD_WORDS) -> DataFrame:
    """(row, starts): window starts, in words, whose words also start somewhere else.

    Windows go to shards by their least k-gram, so that equal windows always meet and
    every piece is searched in one index only. Anchors seen once cannot repeat. Equal
    pieces are counted before they travel; anchors with many different pieces are dealt
    out window by window, equal windows counted again.
    """
    def segment(batches):
        import numpy as np
        import pandas as pd
        for batch in _parts(batches, ROWS):
            texts = [byte_words(text) for text in batch["text"]]
            sizes = np.array([len(words) for words in texts], np.int64)
            heads = np.cumsum(sizes) - sizes
            at, start, n, grams = anchors(word_hashes(list(chain.from_iterable(texts))), window, anchor, sizes)
            text = np.searchsorted(heads + sizes, start, side="right")
            yield pd.DataFrame({
                "row": batch["row"].to_numpy()[text], "anchor": grams[at].view(np.int64),
                "start": (start - heads[text]).astype(np.int32), "n": n.astype(np.int32)})

    segments = stored(rows.select("row", "text").mapInPandas(segment, "row long, anchor long, start int, n int"), "segments")
    met = stored(segments.groupBy("anchor").agg(F.sum("n").alias("n"), F.count("*").alias("times"))
                 .where("times > 1").select("anchor"), "anchors")
    wanted = (segments.join(met, "anchor").groupBy("row")
              .agg(F.collect_list(F.struct("anchor", "start", "n")).alias("segments")))

    def cut(batches):
        from hashlib import blake2b

        import numpy as np
        import pyarrow as pa
        sent = set()
        for part in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            texts = [byte_words(text) for text in part["text"].to_pylist()]
            sizes = np.array([len(words) for words in texts], np.int64)
            hashes = word_hashes(list(chain.from_iterable(texts))).view(np.int64)
            each = part["start"].value_lengths().to_numpy()
            start = part["start"].flatten()
            begin = np.repeat(np.cumsum(sizes) - sizes, each) + start.to_numpy()
            length = part["n"].flatten().to_numpy() + np.int64(window - 1)
            data = memoryview(hashes.tobytes())
            digests = [blake2b(data[8 * a:8 * (a + n)], digest_size=16).digest()
                       for a, n in zip(begin.tolist(), length.tolist())]
            known = np.zeros(len(digests), bool)
            for i, digest in enumerate(digests):
                if digest in sent:
                    known[i] = True
                elif len(sent) < 200_000:  # saves traffic only; a digest may be sent twice
                    sent.add(digest)
            length[known] = 0
            ends = np.cumsum(length)
            words = hashes.take(np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin + length - ends, length))
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part["row"].to_numpy(), each), pa.int64()), start, part["anchor"].flatten(),
                 pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(words), mask=pa.array(known))],
                ["row", "start", "anchor", "digest", "words"])

    pieces = stored(wanted.join(rows.select("row", "text"), "row").select(
        "row", "text", "segments.anchor", "segments.start", "segments.n").mapInArrow(
        cut, "row long, start int, anchor long, digest binary, words array<long>"), "pieces")
    dropped(segments, met)
    distinct = stored(pieces.groupBy("digest").agg(F.first("words", True).alias("words"), F.count("*").alias("times"),
                                                   F.first("anchor").alias("anchor")), "distinct-pieces")
    # The words of a piece are in distinct now.
    places = stored(pieces.select("row", "start", "digest"), "places")
    dropped(pieces)
    hot_anchors = stored(distinct.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"), "hot")
    cold = distinct.join(hot_anchors, "anchor", "left_anti").select("digest", "words", "times", F.col("anchor").alias("shard"))

    def windows(batches):
        import numpy as np
        import pandas as pd
        for batch in _parts(batches, ROWS):
            out = []
            for digest, words, times in zip(batch["digest"], batch["words"], batch["times"]):
                words = np.asarray(words)
                out += [(digest, o, _digest(words[o:o + window]), words[o:o + window], times)
                        for o in range(len(words) - window + 1)]
            yield pd.DataFrame(out, columns=["piece", "offset", "digest", "words", "times"])

    single = stored(distinct.join(hot_anchors, "anchor").select("digest", "words", "times").mapInPandas(
        windows, "piece binary, offset int, digest binary, words array<long>, times long"), "hot-windows")
    dealt = (single.groupBy("digest").agg(F.first("words").alias("words"), F.sum("times").alias("times"))
             .withColumn("shard", F.xxhash64("digest")))
    units = stored(cold.unionByName(dealt), "units")
    dropped(distinct, hot_anchors)
    total = units.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // shard_words))

    def search(batches):
        import numpy as np
        import pyarrow as pa
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        digest, words, times = (pa.concat_arrays([b[c] for b in held]) for c in ("digest", "words", "times"))
        del held
        index = FMIndex(words.flatten().to_numpy(), words.value_lengths().to_numpy(), times.to_numpy(), window)
        piece, offset = index.repeated(window)
        if len(piece):
            order = np.lexsort((offset, piece))
            piece, offset = piece[order], offset[order]
            heads = np.concatenate([[0], np.flatnonzero(np.diff(piece)) + 1])
            yield pa.RecordBatch.from_arrays(
                [digest.take(pa.array(piece[heads])), pa.ListArray.from_arrays(
                    pa.array(np.append(heads, len(piece)), pa.int32()), pa.array(offset, pa.int32()))],
                ["digest", "offsets"])

    found = stored(units.repartition(shards, "shard").select("digest", "words", "times").mapInArrow(
        search, "digest binary, offsets array<int>"), "found")
    dropped(units)
    of_hot = (single.select("piece", "offset", "digest").join(found.select("digest"), "digest")
              .groupBy(F.col("piece").alias("digest")).agg(F.collect_list("offset").alias("offsets")))
    per_piece = stored(found.unionByName(of_hot), "found-pieces")
    dropped(single, found)
    return (places.join(per_piece, "digest")
            .groupBy("row").agg(F.flatten(F.collect_list(F.transform("offsets", lambda o: o + F.col("start")))).alias("starts")))


def dedup(docs: DataFrame, window: int = WINDOW, **settings) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words joined by one space), spans (start, end
    in words, of what is removed) for every row.

    A null or empty text has no words; a text shorter than the window loses nothing.
    Repeated rows repeat each other, so that both lose what they share. Other columns
    are not read. An empty table gives no rows.
    """
    rows = stored(tasks(docs.select("doc_id", "text")).withColumn("row", F.monotonically_increasing_id()), "texts")
    starts = repeats(rows, window, **settings)

    def keep(batches):
        import numpy as np
        import pandas as pd
        for batch in _parts(batches, ROWS):
            out = []
            for doc_id, text, starts in zip(batch["doc_id"], batch["text"], batch["starts"]):
                words = byte_words(text)
                edge = np.zeros(len(words) + 1, np.int64)
                if starts is not None and len(starts):
                    starts = np.asarray(starts)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                gone = np.cumsum(edge)[:-1] > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                out.append((doc_id, len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g).decode("utf-8", "surrogatepass"),
                            [{"start": int(a), "end": int(b)} for a, b in turn.reshape(-1, 2)]))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "text", "spans"])

    return rows.join(starts, "row", "left").select("doc_id", "text", "starts").mapInPandas(
        keep, "doc_id long, n_words long, n_removed long, text string, spans array<struct<start:int,end:int>>")


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
