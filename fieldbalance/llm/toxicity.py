"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or."""

import math
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.llm.common import LOWER, stored, table, words_of

#: Labelled documents the model is fitted on; more are left out by a hash of their id.
TRAINING_ROWS = 4000
#: Letters of the word beginnings that stand for words with other endings.
STEMS = (5, 7)
_stop = re.compile(r"[^.!?\n]+")
_edge = ".,;:!?\"'()[]{}<>*#%&$"


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the stretches between sentence ends."""
    return [m.span() for m in _stop.finditer(text)] if text else []


def features(sentence: str) -> set[str]:
    """Words in lower case, edge punctuation off, and their stems of 5 and 7 letters."""
    words = {w for w in (w.strip(_edge) for w in words_of(sentence.translate(LOWER))) if w}
    return words | {w[:n] + "*" for n in STEMS for w in words if len(w) > n}


def bags(texts: list[str]) -> list[list[set[str]]]:
    """The features of every sentence that has any, per text."""
    return [[f for a, b in sentences(t) if (f := features(t[a:b]))] for t in texts]


def fit(texts: list[str], labels: list[int], least_docs: int = 4, **how) -> dict:
    """A model of texts at hand; see ``fit_ids``."""
    seen: dict[str, int] = {}
    found = bags(texts)
    for bag in found:
        for word in set().union(*bag):
            seen[word] = seen.get(word, 0) + 1
    words = sorted(w for w, n in seen.items() if n >= least_docs)
    number = {w: i for i, w in enumerate(words)}
    return fit_ids(words, [[[number[w] for w in s if w in number] for s in bag] for bag in found], labels, **how)


def fit_ids(words: list[str], docs: list, labels: list[int], epochs: int = 150, rate: float = 0.3,
            l2: float = 2e-5) -> dict:
    """Word weights, bias and leak that make the noisy-or of sentences fit the labels.

    A document is a list of sentences and a sentence a list of places in ``words``.
    """
    import numpy as np
    y = np.array(labels, float)
    sizes = np.array([len(s) for d in docs for s in d], np.int64)
    doc_of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    sent_of, s = np.repeat(np.arange(len(sizes)), sizes), len(sizes)
    flat = [np.asarray(x, np.int64) for d in docs for x in d]
    word_of = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    del flat
    # Start from the log-odds of a word in toxic against other documents, shrunk to none.
    held = np.unique(doc_of[sent_of] * max(len(words), 1) + word_of)
    in_doc, word = held // max(len(words), 1), held % max(len(words), 1)
    positive = 0.5 + np.bincount(word[y[in_doc] > 0], minlength=len(words))
    negative = 0.5 + np.bincount(word[y[in_doc] <= 0], minlength=len(words))
    base = (y.sum() + 1) / (len(y) + 2)
    odds = np.log(positive / negative) - np.log(base / (1 - base))
    weight = np.where(odds > 1.5, odds, 0.0)
    bias, leak, memory, bias_memory = -6.0, 0.01, np.full(len(weight), 1e-3), 1e-3
    for _ in range(epochs if s and 0 < y.sum() < len(y) else 0):
        z = bias + np.bincount(sent_of, weight[word_of], minlength=s)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = (1 - leak) * np.exp(np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y)))
        # d log-likelihood / d log(1 - p_s), the same for every sentence of a document.
        pull = np.where(y > 0, none / np.maximum(1 - none, 1e-6), -1.0)
        slope = pull[doc_of] * p
        gradient = np.bincount(word_of, slope[sent_of], minlength=len(weight)) / len(y) - l2 * weight
        memory += gradient ** 2
        weight = weight + rate * gradient / np.sqrt(memory)
        g = slope.sum() / len(y)
        bias_memory += g * g
        bias = min(-2.0, bias + rate * g / np.sqrt(bias_memory))
    kept = {w: float(weight[i]) for i, w in enumerate(words) if abs(weight[i]) > 1e-4}
    return {"weights": kept, "bias": float(bias), "leak": leak}


def sentence_scores(model: dict, text: str | None) -> list[tuple[int, int, float]]:
    out = []
    for a, b in sentences(text):
        z = model["bias"] + sum(model["weights"].get(w, 0.0) for w in features(text[a:b]))
        out.append((a, b, 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))))
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, least_docs: int = 4) -> dict:
    """A model from labelled documents; at most `rows`, those smallest by a hash of doc_id.

    Only doc_id and toxic of labels and text of docs are read; null labels take no part,
    a null text is empty. Without labels of both kinds every score is the leak. Texts
    are cut into sentences and words in the tasks: one pass counts the documents of
    each word, one turns sentences into word numbers, and those reach the driver.
    """
    import numpy as np
    wanted = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # At most `rows` labels, so the side that is broadcast has a bound.
    got = stored(docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
                 .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows)
                 .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic"), "op4-training")
    # One sorted row group comes out of the limit; texts are dealt out again for the tasks.
    spread = got.repartition(max(1, rows // 250), "doc_id")

    def words_in(batches):
        import pandas as pd
        for batch in batches:
            for bag in bags(batch["text"].tolist()):
                yield pd.DataFrame({"word": pd.Series(list(set().union(*bag)), dtype=object)})

    often = (spread.mapInPandas(words_in, "word string").groupBy("word").agg(F.count("*").alias("n"))
             .where(F.col("n") >= least_docs).select("word").collect())
    words = sorted(r.word for r in often)
    shared = docs.sparkSession.sparkContext.broadcast(words)  # bounded by the training rows

    def numbered(batches):
        import pandas as pd
        number = {w: i for i, w in enumerate(shared.value)}
        for batch in batches:
            found = [[np.array([number[w] for w in s if w in number], np.int32) for s in bag]
                     for bag in bags(batch["text"].tolist())]
            yield pd.DataFrame({"toxic": batch["toxic"], "doc_id": batch["doc_id"],
                                "sizes": [np.array([len(s) for s in d], "<i4").tobytes() for d in found],
                                "ids": [np.concatenate([*d, np.zeros(0, np.int32)]).astype("<i4").tobytes() for d in found]})

    docs_, labels_ = [], []
    for r in (spread.mapInPandas(numbered, "toxic long, doc_id long, sizes binary, ids binary")
              .orderBy("doc_id", "ids").collect()):
        ids, ends = np.frombuffer(r.ids, "<i4"), np.cumsum(np.frombuffer(r.sizes, "<i4"))
        docs_.append(np.split(ids, ends[:-1]) if len(ends) else [])
        labels_.append(int(r.toxic > 0))
    return fit_ids(words, docs_, labels_)


def score(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted and spans (start, end, score of offending sentences) per row.

    Null and empty texts score the leak and have no spans. Rows stay as they are, repeated
    ones too; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training rows

    def run(batches):
        import pandas as pd
        model = shared.value
        for batch in batches:
            scores, spans = [], []
            for text in batch["text"]:
                none, found = 1 - model["leak"], []
                for a, b, p in sentence_scores(model, text):
                    none *= 1 - p
                    if p >= threshold:
                        found.append({"start": a, "end": b, "score": p})
                scores.append(min(1.0, max(0.0, 1 - none)))
                spans.append(found)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores,
                                "predicted": [int(s >= threshold) for s in scores], "spans": spans})

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, score double, predicted int, spans array<struct<start:int,end:int,score:double>>")


def accepted(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score below the threshold, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([1 - (1 - model["leak"]) * math.prod(1 - p for _, _, p in sentence_scores(model, t)) for t in texts])

    return docs.where(toxic("text") < threshold)


def held_out(column: str = "doc_id"):
    """Whether a row's label is kept from training; a row without an id has no label to keep."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trained(spark: SparkSession, sf_dir: str) -> dict:
    """The model of the labels that are not held out."""
    return train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out()))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"), trained(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
