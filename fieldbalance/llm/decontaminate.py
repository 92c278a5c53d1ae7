"""Benchmark decontamination: size-partitioned MinHash containment, checked exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.llm.common import byte_words, shingle_hashes, split_among, stored, table, word_hashes

WORDS = 5
THRESHOLD = 0.8
PERMUTATIONS = 64
#: Items searched in one pass over the documents; bounds what the tasks hold.
BLOCK = 20_000
SMALLEST = 8


def _shingles(text: str | None, n: int):
    return shingle_hashes(word_hashes(byte_words(text, lower=True)), n)


def _constants(count: int):
    import numpy as np
    return np.random.default_rng(5).integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashed(shingles, odd):
    import numpy as np
    x = shingles * odd
    return x ^ (x >> np.uint64(31))


class Items:
    """A bounded block of items: shingle sets, and MinHash values by size class."""

    def __init__(self, rows, n: int, permutations: int, least: int):
        import numpy as np
        self.n, self.odd = n, _constants(permutations)
        self.sets = {}
        self.classes: dict[int, list[dict]] = {}
        # Items of fewer words, by their number: the whole sequence is the one shingle.
        self.short: dict[int, dict[int, list]] = {}
        longer = []
        for item_id, text in rows:
            length = len(byte_words(text))
            if length < least:
                continue
            shingles = np.unique(_shingles(text, n))
            if length < n:
                self.sets[item_id] = shingles
                self.short.setdefault(length, {}).setdefault(int(shingles[0]), []).append(item_id)
                continue
            longer.append(shingles)
            size = SMALLEST
            while size < len(shingles):
                size *= 2
            self.sets[item_id] = shingles
            tables = self.classes.setdefault(size, [{} for _ in self.odd])
            for i, odd in enumerate(self.odd):
                tables[i].setdefault(int(_hashed(shingles, odd).min()), []).append(item_id)
        held = np.unique(np.concatenate([*longer, np.zeros(0, np.uint64)]))
        self.mask = np.uint64((1 << max(16, int(16 * len(held)).bit_length())) - 1)
        self.known, self.marks = held, np.zeros(int(self.mask) + 1, bool)
        self.marks[held & self.mask] = True
        self.keys = {size: [np.array(sorted(t), np.uint64) for t in tables] for size, tables in self.classes.items()}

    def short_items(self, hashes) -> dict:
        """Items of fewer than n words that stand in a document, given the hashes of its words."""
        import numpy as np
        found = {}
        for length, held in self.short.items():
            if len(hashes) >= length:
                for value in np.intersect1d(shingle_hashes(hashes, length), np.array(list(held), np.uint64)):
                    found.update(dict.fromkeys(held[int(value)], 1.0))
        return found

    def touches(self, shingles) -> bool:
        """Whether any shingle is one of an item's; without one no MinHash value can agree."""
        import numpy as np
        near = shingles[self.marks[shingles & self.mask]]
        if not len(near):
            return False
        at = np.minimum(np.searchsorted(self.known, near), len(self.known) - 1)
        return bool((self.known[at] == near).any())

    def candidates(self, shingles) -> set:
        """Items that share a MinHash value with a window of their size class.

        Windows of two blocks of u shingles, one block apart: whoever holds a run
        of u shingles holds it in a window of at most 2u.
        """
        import numpy as np
        found = set()
        if not self.classes or not self.touches(shingles):
            return found
        largest = max(self.classes)
        for i, odd in enumerate(self.odd):
            mins = np.minimum.reduceat(_hashed(shingles, odd), np.arange(0, len(shingles), SMALLEST))
            size = SMALLEST
            while size <= largest:
                if size in self.classes:
                    windows = np.minimum(mins[:-1], mins[1:]) if len(mins) > 1 else mins
                    keys = self.keys[size][i]
                    at = np.minimum(np.searchsorted(keys, windows), len(keys) - 1)
                    for value in windows[keys[at] == windows]:
                        found.update(self.classes[size][i][int(value)])
                mins = np.minimum.reduceat(mins, np.arange(0, len(mins), 2))
                size *= 2
        return found


def contaminated(docs: DataFrame, items: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
                 permutations: int = PERMUTATIONS, block: int = BLOCK, least_words: int = WORDS) -> DataFrame:
    """doc_id, text_key (hash of the text), items (ids, ascending), containment (largest) per row with a hit.

    An item is found when at least `threshold` of its distinct shingles (case of A-Z
    ignored) stand in the document, the whole text counted. An item of fewer than `words`
    words is found when its whole sequence stands there. Items of fewer than `least_words`
    words, items without words or id and null texts take no part; a text of any length is searched whole; repeated rows are
    rows of their own. Items are searched in blocks of a fixed size, every block against
    all rows. Empty tables give no rows.
    """
    schema = "doc_id long, text_key long, items array<long>, containment double"
    spark = docs.sparkSession
    usable = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    blocks = max(1, -(-usable.count() // block))
    parts = []
    for number in range(blocks):
        rows = usable.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()
        shared = spark.sparkContext.broadcast([(r.item_id, r.text) for r in rows])

        def search(batches, shared=shared):
            import numpy as np
            import pandas as pd
            index = Items(shared.value, words, permutations, max(1, least_words))
            for batch in batches:
                out = []
                for doc_id, key, text in zip(batch["doc_id"], batch["text_key"], batch["text"]):
                    hashes = word_hashes(byte_words(text, lower=True))
                    shingles = shingle_hashes(hashes, words)
                    hits = index.short_items(hashes)
                    found = index.candidates(shingles)
                    if found:
                        whole = np.unique(shingles)
                        for item in found:
                            want = index.sets[item]
                            inside = np.isin(want, whole, assume_unique=True).sum()
                            if inside >= threshold * len(want) - 1e-9:
                                hits[item] = inside / len(want)
                    if hits:
                        out.append((doc_id, key, sorted(hits), max(hits.values())))
                yield pd.DataFrame(out, columns=["doc_id", "text_key", "items", "containment"])

        parts.append(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInPandas(search, schema))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least_words=1)


def clean(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of docs that hold no item, with their columns, whatever their names.

    Rows that share id and text go or stay together; null and empty texts stay.
    """
    found = stored(contaminated(docs, items, **settings).select(
        F.xxhash64("doc_id", "text_key").alias("h"), F.col("doc_id").alias("d"), F.col("text_key").alias("k")), "contaminated")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).withColumn(
        "_key", F.xxhash64("doc.doc_id", F.xxhash64("doc.text")))
    same = F.col("doc.doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("doc.text") == F.col("k"))
    # Few rows hold an item: nearly all others stay where they are.
    maybe, others = split_among(whole, "_key", found.select("h"))
    return others.unionByName(maybe.join(found, same, "left_anti")).select("doc.*")
