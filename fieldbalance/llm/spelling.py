"""Spelling variants of words through an index of variable-length grams."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.llm.common import stored, table

#: Runs of letters, as UTF-8: A-Z a-z and U+00C0 to U+00FF.
LETTERS = rb"(?:[a-z]|\xc3[\x80-\xbf])"
#: A gram held by more than one of this many gram places is extended, so at most this
#: many grams of one length are extended: the bound of the broadcast dictionary.
EXTENDED = 1 << 16
SHORTEST, LONGEST = 2, 6
HELD = 200_000


def run_counts(docs: DataFrame, min_length: int = 7, thin: int = 31) -> DataFrame:
    """(word, n): occurrences of letter runs of at least ``min_length`` code points over whole texts.

    Only A-Z are lowered. With h the crc32 of ``<doc_id>:<run>``, a run whose h ``thin``
    divides loses its code point h % length before it is counted, and counts if it is
    still long enough. A null text has no runs; a null id is written as nothing. Tasks
    count before they hand on, holding at most a fixed number of words at a time.
    """
    runs = LETTERS + b"{%d,}" % min_length

    def count(batches):
        find = re.compile(runs).findall
        held: dict[bytes, int] = {}

        def out():
            import pyarrow as pa
            return _batch(word=pa.array(list(held), pa.binary()).cast(pa.string()), n=pa.array(list(held.values()), pa.int64()))

        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = text.as_buffer().to_pybytes()
                if not text:
                    continue
                before = zlib.crc32(b"%s:" % doc_id.encode())
                once: dict[bytes, int] = {}
                for run in find(text.lower()):
                    once[run] = once.get(run, 0) + 1
                for run, n in once.items():
                    h = zlib.crc32(run, before)
                    if h % thin == 0:
                        word = run.decode("utf-8")
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                        run = word.encode("utf-8")
                    held[run] = held.get(run, 0) + n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _flat(words):
    """Code points of all words one after another, each between a start and an end mark,
    with the word each place belongs to, the place in it and the places left."""
    import numpy as np
    joined = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    of = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(codes)) - starts[of]
    return codes, sizes, starts, of, at, sizes[of] - at


def _slices(batches, most: int = 1 << 20):
    """(words, batch) of about as many code points at a time; a longer word comes alone."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        start = size = 0
        for i, word in enumerate(words):
            if size and size + len(word) > most:
                yield words[start:i], batch.slice(start, i - start)
                start, size = i, 0
            size += len(word)
        if size:
            yield words[start:], batch.slice(start)


def _batch(**columns):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(c) if not isinstance(c, pa.Array) else c for c in columns.values()],
                                      list(columns))


def _rolling(codes, left, longest: int):
    """For each length the code of the gram at every place; only places with enough left count."""
    import numpy as np
    factor = np.uint64(0x9E3779B97F4A7C15)
    value = np.zeros(len(codes), np.uint64)
    for length in range(1, longest + 1):
        value = (value + np.uint64(1)) * factor
        value[:len(codes) - length + 1] += codes[length - 1:] * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(31)
        yield length, value, left >= length


def gram_dictionary(words: DataFrame, extended: int = EXTENDED, longest: int = LONGEST):
    """Codes and counts of the grams that are to be extended, and the threshold they pass.

    All grams of SHORTEST to ``longest`` places of all words are counted; a gram stays
    in the dictionary if it fills more than one in ``extended`` of all places. That
    share bounds its size whatever the number of words.
    """
    import numpy as np

    def grams(batches):
        for words, _ in _slices(batches):
            codes, _, _, _, _, left = _flat(words)
            for length, value, fits in _rolling(codes, left, longest):
                if length >= SHORTEST:
                    got, n = np.unique(value[fits], return_counts=True)
                    yield _batch(gram=got.view(np.int64), n=n)

    places = words.agg(F.sum(F.length("word") + 2)).first()[0] or 0
    threshold = max(8, places // extended)
    kept = (words.mapInArrow(grams, "gram long, n long").groupBy("gram")
            .agg(F.sum("n").alias("n")).where(F.col("n") > threshold).toPandas())
    codes = kept["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(codes)
    return codes[order], kept["n"].to_numpy(np.int64)[order], threshold


def _decomposed(words, dictionary, longest: int):
    """The gram that starts at each place: the shortest that is not extended.

    Whether a gram goes on depends on its own characters alone, so an edit outside a
    gram leaves it as it is: it affects exactly the grams that span the edited place.
    """
    import numpy as np
    known, counts, threshold = dictionary
    codes, sizes, starts, of, at, left = _flat(words)
    gram, length_of = np.zeros(len(codes), np.uint64), np.zeros(len(codes), np.int64)
    cost = np.full(len(codes), np.inf)
    going = np.ones(len(codes), bool)
    for length, value, fits in _rolling(codes, left, longest):
        now = going & fits
        gram[now], length_of[now] = value[now], length
        if length < SHORTEST:
            continue
        if len(known):
            place = np.minimum(np.searchsorted(known, value), len(known) - 1)
            frequent = known[place] == value
            cost[now] = np.where(frequent, counts[place], threshold)[now]
        else:
            frequent = np.zeros(len(codes), bool)
            cost[now] = threshold
        going = now & frequent
    return gram, length_of, cost, sizes, starts, of, at


def _chosen(length_of, cost, sizes, starts):
    """For each word the places of two grams that do not overlap and have the shortest lists.

    One edit affects at most one of them, so a near word is in at least 2 - 1 = 1 of the two lists.
    """
    import numpy as np
    first, second = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        for part in np.array_split(mine, max(1, -(-len(mine) * int(size) // 2_000_000))):
            grid = starts[part][:, None] + np.arange(size)
            ends, price = length_of[grid] + np.arange(size), cost[grid]
            best, who = np.full((len(part), size + 1), np.inf), np.zeros((len(part), size + 1), np.int64)
            rows = np.arange(len(part))
            for p in range(size):
                end = ends[:, p]
                better = price[:, p] < best[rows, end]
                best[rows[better], end[better]] = price[better, p]
                who[rows[better], end[better]] = p
            for e in range(1, size + 1):
                worse = best[:, e] >= best[:, e - 1]
                best[worse, e], who[worse, e] = best[worse, e - 1], who[worse, e - 1]
            total = best[:, :size] + price
            right = total.argmin(axis=1)
            first[part], second[part] = who[rows, right], right
    return first, second


def _key(gram, at, size):
    import numpy as np
    mixed = gram ^ (at.astype(np.uint64) * np.uint64(0x94D049BB133111EB)) ^ (size.astype(np.uint64) << np.uint64(40))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def near_pairs(words: DataFrame, *, extended: int = EXTENDED, longest: int = LONGEST, min_length: int = 7) -> DataFrame:
    """(a, na, b, nb): every unordered pair of words that one inserted, deleted or replaced code point parts.

    ``words`` has (word, n), each word once, none under ``min_length`` code points. Every
    word posts the gram of each place under gram, place and length. It probes two grams
    that do not overlap (see ``_chosen``) for words of its own length at the same place,
    and for words one shorter at the same place (deletion to the right) or one before
    (deletion to the left). Lists are merged by a join and every candidate is verified
    by edit distance, so collisions of gram codes cost time only. ``longest`` may not
    exceed ``min_length``: every word must hold two grams side by side.
    """
    import numpy as np
    if longest > min_length:
        raise ValueError("grams may not be longer than the shortest word")
    words = stored(words.select("word", "n"), "op11-words")
    dictionary = gram_dictionary(words, extended, longest)

    def postings(batches):
        import pyarrow as pa
        for words, batch in _slices(batches):
            gram, length_of, _, sizes, _, of, at = _decomposed(words, dictionary, longest)
            long_enough = length_of >= SHORTEST
            of, at = of[long_enough], at[long_enough]
            yield _batch(key=_key(gram[long_enough], at, sizes[of]), b=batch.column("word").take(pa.array(of)),
                         nb=batch.column("n").take(pa.array(of)))

    def probes(batches):
        import pyarrow as pa
        for words, batch in _slices(batches):
            gram, length_of, cost, sizes, starts, _, _ = _decomposed(words, dictionary, longest)
            for place in _chosen(length_of, cost, sizes, starts):
                code, upto = gram[starts + place], place + length_of[starts + place]
                every = np.ones(len(words), bool)
                for shift, less, which in ((0, 0, every), (0, 1, upto < sizes), (1, 1, place > 0)):
                    yield _batch(key=_key(code[which], place[which] - shift, sizes[which] - less),
                                 a=batch.column("word").filter(pa.array(which)),
                                 na=batch.column("n").filter(pa.array(which)))

    index = words.mapInArrow(postings, "key long, b string, nb long")
    asked = words.mapInArrow(probes, "key long, a string, na long")
    longer = F.length("a") > F.length("b")
    return (asked.join(index, "key").where((longer | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
            .select("a", "na", "b", "nb").distinct())


def variants(words: DataFrame, ratio: int = 10, **index) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of (word, n).

    The form is the near word of largest n, ties by code point, if its n is at least
    ``ratio`` times the word's, else null; the root is where following forms ends, the
    word itself without a form. Counts grow ``ratio``-fold at each step, which bounds
    the steps. A word's near words are bounded by the alphabet, not by the table. An
    empty table gives no rows; rows without a word are left out; columns other than
    word and n are not read. Repeated words are an error of the caller.
    """
    words = stored(words.where("word IS NOT NULL").select("word", "n"), "op11-counts")
    pairs = stored(near_pairs(words, **index), "op11-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("m")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    fits = -F.col("best.m") >= ratio * F.col("n")
    rows = stored(words.join(best, "word", "left").select(
        "word", F.when(fits, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, -F.col("best.m")).alias("form_n")), "op11-forms")
    step = rows.where("form IS NOT NULL").select(F.col("word").alias("at"), F.col("form").alias("next"))
    roots = stored(step.select(F.col("at").alias("start"), F.col("next").alias("root")), "op11-roots")
    while True:
        moved = roots.join(step, F.col("root") == F.col("at"), "left")
        if moved.where("next IS NOT NULL").isEmpty():
            break
        roots = stored(moved.select("start", F.coalesce("next", "root").alias("root")), "op11-roots")
    return (rows.join(roots, F.col("word") == F.col("start"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(run_counts(table(spark, sf_dir, "documents")).where("n >= 2"))
