"""N-gram Jaccard join with adaptive multi-match prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbalance.llm.common import (byte_words, dropped, maybe_among, shingle_hashes, stored, table, tasks,
                                     word_hashes)

#: Counters of the shingle frequency sketch; any counts give the same result.
COUNTERS = 1 << 18
LONGEST = 4
#: Cost of checking a candidate pair, in scanned postings.
CHECK_COST = 50.0
#: A class of equal sets above this share of all rows is searched by one of its rows.
HEAVY = 10_000
#: 64-bit words of a parity bitmap, and of a second one that sets of at least LARGE have.
WORDS = 16
WIDE_WORDS = 64
LARGE = 2000
#: Rows of a token that meet all its others before every pair does, turn by turn.
HUBS = (8, 64)
#: Sets compared side by side when links are counted: a task holds two such blocks.
BLOCK = 256


def shingle_set(text: str | None, n: int):
    """Sorted distinct shingles of a text, A-Z in lower case."""
    import numpy as np
    return np.unique(shingle_hashes(word_hashes(byte_words(text, lower=True)), n))


def parity(s, words: int):
    """Bitmap of a set: bit i tells whether an odd number of its hashes falls on i."""
    import numpy as np
    odd = np.bincount((s % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def _may_link(x: str, y: str, percent: int) -> Column:
    """False only for pairs that do not link, from their sizes and bitmaps alone.

    Bitmaps differ in at most one bit for each shingle that one set has alone, and sets
    that link have at most (100 - percent) / (100 + percent) of both sizes alone.
    """
    most = (100 - percent) * (F.col(f"{x}.n_shingles") + F.col(f"{y}.n_shingles"))
    bits = [F.bit_count(F.col(f"{x}.bits")[i].bitwiseXOR(F.col(f"{y}.bits")[i])) for i in range(WORDS)]
    wide = F.aggregate(F.zip_with(f"{x}.wide", f"{y}.wide", lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                       F.lit(0), lambda total, one: total + one)
    large = F.least(f"{x}.n_shingles", f"{y}.n_shingles") >= LARGE
    return ((100 + percent) * sum(bits[1:], bits[0]) <= most) & (~large | ((100 + percent) * wide <= most))


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id that has a link: the smallest id reachable over links (a, b).

    Ids without a link are their own root and take no part in the rounds, which end in
    stored tables. Every round hands the smallest known root to both ends of a link and
    then follows roots to their own roots, so chains halve.
    """
    links = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    root = stored(links.groupBy(F.col("a").alias("id")).agg(F.first("a").alias("root")), "roots")
    while True:
        near = (links.join(root.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("root").alias("near")))
        step = stored(root.join(near, root["id"] == near["a"], "left")
                      .select("id", F.col("root").alias("old"), F.least("root", "near").alias("root")), "roots")
        # Whoever was a root may have learnt of a smaller one from any of its members.
        told = step.groupBy(F.col("old").alias("id")).agg(F.min("root").alias("told"))
        step = step.join(told, "id", "left").select("id", "old", F.least("root", "told").alias("root"))
        step = stored(step, "roots")
        jump = step.select(F.col("id").alias("root"), F.col("root").alias("next"))
        now = stored(step.join(jump, "root", "left")
                     .select("id", F.least("root", F.coalesce("next", "root")).alias("root"), "old"), "roots")
        changed = now.where("root <> old").limit(1).count()
        dropped(root, step)
        root = now.select("id", "root")
        if not changed:
            dropped(links)
            return root


def _links_of(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, links): to how many rows each of members (id, root, copies) links, sets as (id, set).

    Links never leave a component, so its members are compared with each other: blocks of
    BLOCK sets, two of them in a task, however large the component is. Small components
    share a task. Only counts leave it, no pairs. The work is the square of a component.
    """
    sizes = members.groupBy("root").agg(F.count("*").alias("size")).where("size > 1")
    total = members.count()
    bins = max(1, total // BLOCK)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = (members.join(sizes, "root").withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
              .withColumn("bin", F.when(F.col("blocks") > 1, F.col("root"))
                          .otherwise(-1 - F.pmod(F.xxhash64("root"), F.lit(bins))))
              .select("id", "root", "copies", "block", "bin", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")))
    placed = placed.select("id", "root", "copies", "block", "bin", F.least("block", "other").alias("low"),
                           F.greatest("block", "other").alias("high"))

    def counted(group):
        import numpy as np
        import pandas as pd
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        found = []
        for _, part in group.groupby("root", sort=False):
            held = [np.asarray(s) for s in part["set"]]
            length = np.array([len(s) for s in held])
            ends = np.concatenate([[0], np.cumsum(length)[:-1]])
            tokens, place = np.unique(np.concatenate(held), return_inverse=True)
            copies, block = part["copies"].to_numpy(), part["block"].to_numpy()
            marked = np.zeros(len(tokens), bool)
            for i in range(len(held)):
                mine = place[ends[i]:ends[i] + length[i]]
                marked[mine] = True
                both = np.add.reduceat(marked[place], ends, dtype=np.int64)
                marked[mine] = False
                near = 100 * both >= percent * (length + length[i] - both)
                near[i] = False
                # A pair of one block is counted where its block stands alone.
                near &= block != block[i] if low < high else True
                found.append((part["id"].iloc[i], int(copies[near].sum())))
        return pd.DataFrame(found, columns=["id", "links"])

    met = placed.join(sets, "id")
    return (met.groupBy("bin", "low", "high").applyInPandas(counted, "id long, links long")
            .groupBy("id").agg(F.sum("links").alias("links")))


def near_in_size(postings: DataFrame, percent: int) -> DataFrame:
    """The postings (token, n_shingles, ...) without those whose token has no other of nearly that size.

    Sets that link have sizes within the threshold of each other; in order of size, whoever has
    such a row has one next to it.
    """
    by_size = Window.partitionBy("token").orderBy("n_shingles")
    size = F.col("n_shingles")
    return (postings.withColumns({"_less": F.lag("n_shingles").over(by_size), "_more": F.lead("n_shingles").over(by_size)})
            .where((100 * F.col("_less") >= percent * size) | (100 * size >= percent * F.col("_more")))
            .drop("_less", "_more"))


def _search(numbered: DataFrame, n: int, percent: int, longest: int, count_links: bool = True) -> DataFrame:
    """row, doc_id, n_shingles, root, n_links of (row, doc_id, text); root is null without words.

    ``n_links`` is how many other rows a row links to, all of them; null unless asked for.

    Rows are the nodes, so ids may repeat or be missing. Of a class of equal sets that
    holds more than one in HEAVY of all rows, one row takes part in the search and the
    others follow it: at most HEAVY classes, which is what is broadcast.
    """
    def shingled(batches):
        import hashlib

        import pandas as pd
        # Sets are wider than texts: some texts at a time.
        for part in (b.iloc[i:i + 500] for b in batches for i in range(0, len(b), 500)):
            sets = [shingle_set(t, n) for t in part["text"]]
            yield pd.DataFrame({"row": part["row"], "doc_id": part["doc_id"], "n_shingles": [len(s) for s in sets],
                                "key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                                "bits": [parity(s, WORDS) for s in sets],
                                "wide": [parity(s, WIDE_WORDS) if len(s) >= LARGE else [] for s in sets],
                                "set": [s.view("int64") for s in sets]}, index=part.index)

    # Sets are made once; nothing below reads a text again.
    whole = stored(numbered.mapInPandas(
        shingled, "row long, doc_id long, n_shingles long, key binary, bits array<long>, wide array<long>, set array<long>"), "sets",
        row_group_bytes=16 << 20)
    rows = stored(whole.select("row", "doc_id", "n_shingles", "key", "bits", "wide"), "keys")
    total = rows.count()
    classes = rows.where("n_shingles > 0").groupBy("key").agg(
        F.min("row").alias("first"), F.count("*").alias("copies")).where(F.col("copies") > max(1, total // HEAVY))
    heavy = stored(classes, "heavy")

    def searched(df: DataFrame) -> DataFrame:
        return (df.where("n_shingles > 0").join(F.broadcast(heavy), "key", "left")
                .where("first IS NULL OR first = row").withColumnRenamed("row", "id"))

    one = searched(whole).select("id", "n_shingles", "set")
    # Sizes and ids come from the narrow table, which outlives the sets.
    nodes = searched(rows).select("id", "n_shingles", "bits", "wide")

    def sketch(batches):
        import numpy as np
        import pandas as pd
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            if len(batch):
                counts += np.bincount(np.concatenate(batch["set"].tolist()) & (COUNTERS - 1), minlength=COUNTERS)
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"slot": used, "n": counts[used]})

    import numpy as np
    got = one.select("set").mapInPandas(sketch, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(COUNTERS, np.int64)
    frequency[got["slot"]] = got["n"]
    shared = numbered.sparkSession.sparkContext.broadcast(frequency)  # COUNTERS numbers, whatever the input

    def prefixes(batches):
        import numpy as np
        import pandas as pd
        frequency = shared.value
        for batch in batches:
            tokens, matches = [], []
            for size, s in zip(batch["n_shingles"], batch["set"]):
                s = np.asarray(s)
                often = frequency[s & (COUNTERS - 1)]
                order = np.lexsort((s, often))
                base = size - -(-size * percent // 100)
                # A longer prefix scans more postings but asks for more matches.
                best, cost, added = 1, None, np.cumsum(often[order[:base + longest]], dtype=float)
                for k in range(1, min(longest, size - base) + 1):
                    scanned = added[base + k - 1]
                    this = scanned + CHECK_COST * scanned / k ** 2
                    if cost is None or this < cost:
                        best, cost = k, this
                # Half a hash is enough here: a collision only adds a candidate.
                tokens.append((s[order[:base + best]] >> 32).astype(np.int32))
                matches.append(best)
            if tokens:
                each = np.array([len(t) for t in tokens])
                yield pd.DataFrame({"id": np.repeat(batch["id"].to_numpy(), each), "token": np.concatenate(tokens),
                                    "n_shingles": np.repeat(batch["n_shingles"].to_numpy(), each),
                                    "matches": np.repeat(matches, each)})

    postings = stored(one.mapInPandas(prefixes, "id long, token int, n_shingles long, matches int"), "postings")
    held = postings.groupBy("token").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last")
    held = stored(held.select("token"), "held")
    # Most tokens of a prefix are its own: their postings meet nobody and travel no further.
    met = stored(maybe_among(postings, "token", held), "postings")
    dropped(postings)
    postings = met
    close = (100 * F.least("x.n_shingles", "y.n_shingles") >= percent * F.greatest("x.n_shingles", "y.n_shingles"))

    def checked(found: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) that link, both sets in hand, as a stored table."""
        pairs = stored(found, "candidates")
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        # Few sets are in any pair: nearly all others stay where they are.
        ends = stored(ends, "paired")
        sets = stored(maybe_among(one.select("id", "set"), "id", ends).join(ends, "id"), "paired-sets")
        left = pairs.join(sets.withColumnsRenamed({"id": "a", "set": "s"}), "a")
        pair = left.join(sets.withColumnsRenamed({"id": "b", "set": "t"}), "b")
        # One pair at a time, inside the JVM: a batch of pairs for Python holds thousands of sets twice.
        both = F.size(F.array_intersect("s", "t"))
        linked = stored(pair.where(100 * both >= percent * (F.size("s") + F.size("t") - both)).select("a", "b"), name)
        dropped(pairs, ends, sets)
        return linked

    # First each row against one hub per shared token; a group of copies costs its size.
    hub = Window.partitionBy("token").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stars = (postings.withColumns({"hub": F.first("id").over(hub), "hub_size": F.first("n_shingles").over(hub),
                                   "hub_matches": F.first("matches").over(hub)})
             .where("id <> hub").where(
                 100 * F.least("n_shingles", "hub_size") >= percent * F.greatest("n_shingles", "hub_size"))
             .groupBy(F.col("hub").alias("a"), F.col("id").alias("b"))
             .agg(F.count("*").alias("shared"), F.first(F.least("matches", "hub_matches")).alias("least"))
             .where("shared >= least").select("a", "b"))
    # Bitmaps are small: sets are fetched only for pairs whose bitmaps are close, too.
    stars = (stars.join(nodes.alias("x"), F.col("a") == F.col("x.id")).join(nodes.alias("y"), F.col("b") == F.col("y.id"))
             .where(_may_link("x", "y", percent)).select("a", "b"))
    links = checked(stars, "first-links")

    def still_apart(postings: DataFrame, root: DataFrame) -> DataFrame:
        """The postings of tokens in more than one component, with root, bitmap and rows of the token."""
        rooted = (postings.select("id", "token", "n_shingles", "matches").join(root, "id", "left")
                  .withColumn("root", F.coalesce("root", "id")))
        mixed = (rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("many"))
                 .where("low < high").select("token", "many"))
        mixed = stored(mixed, "mixed")
        met = near_in_size(rooted.join(mixed, "token"), percent)
        met = stored(met.join(nodes.select("id", "bits", "wide"), "id"), "apart")
        dropped(mixed)
        return met

    def pairs_of(xs: DataFrame, ys: DataFrame, once: Column) -> DataFrame:
        """(a, b, shared, least): pairs of different components by the tokens on which they meet."""
        return (xs.alias("x").join(ys.alias("y"), (F.col("x.token") == F.col("y.token")) & once
                                   & (F.col("x.root") != F.col("y.root")) & close & _may_link("x", "y", percent))
                .groupBy(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
                .agg(F.count("*").alias("shared"), F.first(F.least("x.matches", "y.matches")).alias("least")))

    # Then against some more hubs, so that a large loose group holds together before all pairs meet.
    apart = postings
    for hubs_each in HUBS:
        root = components(links)
        # Components only grow: whoever met only its own stays out of the later rounds.
        before, apart = apart, still_apart(apart, root)
        dropped(before, root)
        large = apart.where(F.col("many") > hubs_each)  # in the others all pairs are fewer
        place = F.row_number().over(Window.partitionBy("token").orderBy(F.xxhash64("id", F.lit(hubs_each)), "id"))
        hubs = large.withColumn("place", place).where(F.col("place") <= hubs_each).drop("place")
        # A hub need not be one on every shared token: nothing is asked of their number.
        more = pairs_of(large, hubs, F.col("x.id") != F.col("y.id")).select("a", "b")
        links = links.unionByName(checked(more, "more-links"))
    # Then all pairs of rows that are still apart.
    root = components(links)
    before, apart = apart, still_apart(apart, root)
    dropped(before, root)
    rest = pairs_of(apart, apart, F.col("x.id") < F.col("y.id")).where("shared >= least").select("a", "b")
    rest = checked(rest, "second-links")
    dropped(held, apart)
    final = components(links.unionByName(rest))
    # A row finds its component by itself, or by the first of its heavy class.
    found = rows.join(F.broadcast(heavy), "key", "left").select(
        "row", "doc_id", "n_shingles", F.coalesce("first", "row").alias("id"),
        (F.coalesce("copies", F.lit(1)) - 1).alias("equal"))
    found = found.join(final, "id", "left").withColumn(
        "root", F.when(F.col("n_shingles") > 0, F.coalesce("root", "id")))
    if count_links:
        weight = heavy.select(F.col("first").alias("id"), "copies")
        members = stored(final.join(F.broadcast(weight), "id", "left")
                         .select("id", "root", F.coalesce("copies", F.lit(1)).alias("copies")), "members")
        # Few sets are in any component: nearly all others stay where they are.
        sets = maybe_among(one.select("id", "set"), "id", members.select("id"))
        degree = stored(_links_of(members, sets, percent), "degrees")
        found = found.join(degree, "id", "left").withColumn(
            "n_links", F.when(F.col("n_shingles") > 0, F.coalesce("links", F.lit(0)) + F.col("equal")).otherwise(0))
    else:
        found = found.withColumn("n_links", F.lit(None).cast("long"))
    answer = stored(found.select("row", "doc_id", "n_shingles", "root", "n_links"), "answer")
    dropped(whole)
    dropped(rows, heavy, links, rest)
    return answer


def _numbered(docs: DataFrame, *columns) -> DataFrame:
    return tasks(docs.select(*columns)).withColumn("row", F.monotonically_increasing_id())


def _smallest(answer: DataFrame) -> DataFrame:
    """(root, first): of each component the smallest id, a missing one last, and its row."""
    return answer.where("root IS NOT NULL").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))


def similar(docs: DataFrame, n: int = 4, percent: int = 85, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links per row.

    Two rows link when 100 * intersection >= percent * union of their shingle sets.
    Null and empty texts have no shingles and link with nothing: their component is
    their own id. Rows that share a doc_id, or have none, are rows of their own; a
    component's id is the smallest of its ids that is not null, null if all are. Links
    counts every other row that the row links with, copies too. A text of any length is one set. An empty table gives no rows; other columns are
    not read.
    """
    answer = _search(_numbered(docs, "doc_id", "text"), n, percent, longest)
    ids = _smallest(answer).select("root", F.col("first.doc_id").alias("least"))
    return (answer.join(ids, "root", "left")
            .select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
                    .alias("component_id"), "n_links"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents"))


def first_of_each(docs: DataFrame, n: int = 4, percent: int = 85, longest: int = LONGEST) -> DataFrame:
    """One row per component, that of the smallest doc_id (a missing one last, then the
    first as read), with the columns of docs, whatever their names.

    Rows whose text has no words link with nothing and stay, repeated ones too.
    """
    whole = stored(_numbered(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "whole",
                   compression="zstd")
    answer = _search(whole.select("row", "doc.doc_id", "doc.text"), n, percent, longest, count_links=False)
    stay = _smallest(answer).select(F.col("first.row").alias("row")).unionByName(
        answer.where("root IS NULL").select("row"))
    return whole.join(stay, "row", "left_semi").select("doc.*")
