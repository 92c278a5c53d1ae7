"""Operators against brute force over the small tables and made-up edge cases."""

import hashlib
import html as references
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from fieldbalance.llm import chat, decontaminate, html, license, mixing, ngram_join, substring, tokens, topk, toxicity
from fieldbalance.llm.common import words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rows(sf_dir, name):
    return duckdb.sql(f"select * from '{sf_dir}/{name}.parquet'").df()


@pytest.fixture(scope="module")
def odd_docs(spark):
    common = " ".join(f"w{i}" for i in range(60))
    data = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one", "en", "a", 3),
            (5, common, "en", "b", 1), (5, common, "en", "b", 1), (6, "x y " + common + " z", None, None, 2),
            (7, "ha " * 300, "en", "b", 900), (8, "v" * 50_000, "en", "c", 50_000), (9, common.upper(), "en", "c", 1),
            (10, "one", "en", "a", 3)]
    return spark.createDataFrame([(*d, 1, 2, 3) for d in data], DOCS + ", row long, set long, size long")


def brute_repeats(texts, w):
    all_words = [words_of(t) for t in texts]
    seen = Counter(tuple(x[i:i + w]) for x in all_words for i in range(len(x) - w + 1))
    out = []
    for x in all_words:
        gone = set()
        for i in range(len(x) - w + 1):
            if seen[tuple(x[i:i + w])] > 1:
                gone.update(range(i, i + w))
        out.append((len(x), len(gone), " ".join(v for i, v in enumerate(x) if i not in gone)))
    return out


def brute_groups(docs, n=4, percent=85):
    sets = []
    for _, text in docs:
        x = words_of(lower(text or ""))
        k = min(n, len(x))
        sets.append({tuple(x[i:i + k]) for i in range(len(x) - k + 1)} if x else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                if 100 * len(a & b) >= percent * len(a | b):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs))


def test_substring(spark, sf_dir):
    docs = rows(sf_dir, "documents")
    want = {d: (n, g, hashlib.sha256(k.encode()).hexdigest())
            for d, (n, g, k) in zip(docs.doc_id, brute_repeats(docs.text, 35))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.op1_substring(spark, sf_dir).collect()}
    assert got == want
    assert any(g for _, g, _ in want.values())


@pytest.mark.parametrize("hot", [0, 2000])
def test_substring_edges(spark, odd_docs, hot):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = sorted((d, *b) for (d, _), b in zip(docs, brute_repeats([t for _, t in docs], 35)))
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in substring.dedup(odd_docs, hot=hot).collect())
    assert got == want
    assert substring.dedup(odd_docs.limit(0)).count() == 0


def test_html(spark, sf_dir):
    model = html.train(html.labelled_pages())
    cases = spark.createDataFrame([
        (1, None, None), (2, "u", ""), (3, "u", "<html><body><nav>a</nav></body></html>"),
        (4, "u", "<body><nav><a href=x>menu</a></nav><article><h1>Head &amp; more</h1><p>one\n two<br>three"
                 "<script>x()</script></p><div class='comments'><p>Bad comment here</p></div></article><footer>f</footer>")],
        "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract(cases, model).collect()}
    assert got == {1: ("", 0), 2: ("", 0), 3: ("", 0), 4: ("Head & more\n\none two three", 26)}
    for r in html.op2_html(spark, sf_dir).collect():
        assert r.n_chars == len(r.text) and "track(" not in r.text


def test_html_open_elements(spark):
    model = html.train(html.labelled_pages())
    article = "<article><h1>Title of it</h1><p>" + "plain words of a story " * 9 + "</p></article>"
    want = "Title of it\n\n" + ("plain words of a story " * 9).strip()
    pages = ["<html><head><title>x</title><body>" + article, "<head><meta charset=utf-8>" + article,
             "<body><svg><title>x</title><path>" + article, "<body><select><option>one" + article,
             "<head><style>a {}</style><script>b</script></head>" + article,
             "<body><svg><foreignObject><p>no</p></foreignObject></svg>" + article]
    df = spark.createDataFrame([(i, None, p) for i, p in enumerate(pages)] * 2, "page_id long, url string, html string")
    got = html.extract(df.selectExpr("*", "1 as text", "2 as n_chars"), model).collect()
    assert sorted((r.page_id, r.text) for r in got) == sorted((i, want) for i in range(len(pages)) for _ in range(2))
    assert html.extract(df.limit(0), model).count() == 0
    long = spark.createDataFrame([(1, "u", "<body><nav>menu</nav>" + article * 400)], "page_id long, url string, html string")
    assert html.extract(long, model).first().text == "\n\n".join([want] * 400)


def test_html_equals_the_articles(spark):
    """Pages of the table hold one article without boilerplate in it: its blocks, cut by pattern."""
    sf = "/root/testdata/sf0.01"
    want = {}
    for page_id, page in rows(sf, "pages")[["page_id", "html"]].itertuples(index=False):
        inner = re.search("<article>(.*)</article>", page, re.S).group(1)
        inner = re.sub("<!--.*?-->", "", inner, flags=re.S)
        blocks = re.split("</?(?:h1|p)>", re.sub("</?b>", "", inner).replace("<br>", " "))
        blocks = [" ".join(references.unescape(b).split()) for b in blocks]
        want[page_id] = "\n\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in html.op2_html(spark, sf).collect()} == want


def brute_leaks(docs, items):
    def sh(t):
        x = words_of(lower(t or ""))
        return {tuple(x[i:i + 5]) for i in range(len(x) - 4)}
    items = {i: sh(t) for i, t in items}
    return {d: hits for d, t in docs for s in [sh(t)]
            for hits in [sorted(i for i, w in items.items() if w and len(w & s) >= 0.8 * len(w))] if hits}


def test_decontaminate(spark, sf_dir):
    docs, items = rows(sf_dir, "documents"), rows(sf_dir, "benchmark")
    want = brute_leaks(zip(docs.doc_id, docs.text), list(zip(items.item_id, items.text)))
    got = {r.doc_id: list(r["items"]) for r in decontaminate.op3_decontaminate(spark, sf_dir).collect()}
    assert got == want and want


def test_decontaminate_edges(spark, odd_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "w1 w2 w3 w4 w5 w6 w7"), (4, "one"), (None, "w1 w2 w3 w4 w5")],
                                  "item_id long, text string")
    for block in (1, 100):
        got = sorted((r.doc_id, list(r["items"])) for r in decontaminate.contaminated(odd_docs, items, block=block).collect())
        assert got == [(5, [3]), (5, [3]), (6, [3]), (9, [3])]
    assert decontaminate.contaminated(odd_docs, items.limit(0)).count() == 0
    assert sorted(r.doc_id for r in decontaminate.clean(odd_docs, items).collect()) == [1, 2, 3, 4, 7, 8, 10]


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"  # the small tables hold out six toxic documents only
    got = {r.doc_id: r for r in toxicity.op4_toxicity(spark, sf_dir).collect()}
    labels = rows(sf_dir, "labels")
    held = [(int(t), got[d].predicted) for d, t in zip(labels.doc_id, labels.toxic) if got[d].held_out]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert sum(a == b for a, b in held) / len(held) > 0.9
    toxic = [b for a, b in held if a]
    assert sum(toxic) / len(toxic) > 0.8


def test_toxicity_edges(spark, odd_docs):
    model = {"weights": {"bad": 12.0}, "bias": -6.0, "leak": 0.01}
    one = spark.createDataFrame([(1, "Fine here. A bad one! Fine.", "en", "s", 1)], DOCS)
    r = toxicity.score(one, model).first()
    assert r.predicted == 1 and len(r.spans) == 1 and "bad" in "Fine here. A bad one! Fine."[r.spans[0].start:r.spans[0].end]
    assert toxicity.score(odd_docs, model).count() == 11
    assert toxicity.accepted(odd_docs, model).columns == odd_docs.columns
    empty = toxicity.train(odd_docs, odd_docs.selectExpr("doc_id", "cast(null as int) toxic"))
    assert toxicity.score(odd_docs, empty).where("predicted = 1").count() == 0


def test_ngram_join(spark, sf_dir):
    docs = rows(sf_dir, "documents")
    want = brute_groups(list(zip(docs.doc_id, docs.text)))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.op5_ngram_join(spark, sf_dir).collect())
    assert got == want
    assert any(d != c for d, _, c in want)


def test_ngram_join_chains(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(60):
        x = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 6)):
            x[at] = f"n{rng.integers(0, 40)}"
        docs.append((int(1000 - i), " ".join(x), "en", "a", 1))
    docs += [(3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, "Same", "en", "a", 0), (6, "same", "en", "a", 0)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar(spark.createDataFrame(docs, DOCS)).collect())
    assert got == brute_groups([(d[0], d[1]) for d in docs])


def brute_links(docs, n=4, percent=85):
    sets = []
    for _, text in docs:
        w = lower(text or "").split()
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return sorted((d, sum(bool(s) and i != j and 100 * len(s & t) >= percent * len(s | t) for j, t in enumerate(sets)))
                  for i, ((d, _), s) in enumerate(zip(docs, sets)))


@pytest.mark.parametrize("block", [256, 7])
def test_ngram_join_counts_every_link(spark, monkeypatch, block):
    """Links inside a component too, which other links had joined before."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = np.random.default_rng(2)
    docs = []
    for i in range(40):
        x = [f"w{k}" for k in range(120)]
        for at in rng.integers(0, 120, rng.integers(0, 6)):
            x[at] = f"n{rng.integers(0, 40)}"
        docs.append((i, " ".join(x), "en", "a", 1))
    docs += [(50 + i, docs[3][1], "en", "a", 1) for i in range(6)]
    docs += [(70, None, "en", "a", 0), (71, "", "en", "a", 0), (72, "alone", "en", "a", 0)]
    got = sorted((r.doc_id, r.n_links) for r in ngram_join.similar(spark.createDataFrame(docs, DOCS)).collect())
    assert got == brute_links([(d[0], d[1]) for d in docs])


def test_ngram_join_edges(spark, odd_docs):
    assert ngram_join.similar(odd_docs).count() == 11
    assert ngram_join.similar(odd_docs.limit(0)).count() == 0
    assert sorted(r.doc_id for r in ngram_join.first_of_each(odd_docs).collect()) == [1, 2, 3, 4, 5, 7, 8]  # 6 shares 57 of 60 shingles with 5


def test_mixing(spark, sf_dir):
    got = mixing.op6_mix(spark, sf_dir).toPandas()
    docs = rows(sf_dir, "documents")
    sizes = {d: len(words_of(t)) for d, t in zip(docs.doc_id, docs.text)}
    assert dict(zip(got.doc_id, got["size"])) == sizes
    assert (got.taken <= 2 * got["size"]).all()
    by = got.merge(docs[["doc_id", "source"]], on="doc_id").groupby("source").agg(
        taken=("taken", "sum"), target=("target", "first"), whole=("source_size", "first"), size=("size", "sum"))
    assert (by.whole == by["size"]).all()
    assert ((by.taken - by.target).abs() <= np.maximum(20, 0.01 * by.target)).all()
    again = mixing.op6_mix(spark, sf_dir).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))


def test_mixing_edges(spark, odd_docs):
    assert mixing.mix(odd_docs).count() == 11
    assert mixing.mix(odd_docs.limit(0)).count() == 0
    assert mixing.mixed(odd_docs).columns == odd_docs.columns
    assert mixing.targets({"a": 10, "b": 90}, {"a": 3, "b": 1}, 1.5, 2) == {"a": 20, "b": 130.0}
    take = mixing.fit([3, 5, 7], [4, 4, 4], 31, 1000)
    assert sum(a * b for a, b in zip([3, 5, 7], take)) == 31


def test_license(spark):
    files = spark.createDataFrame([
        (1, "a/LICENSE", True, "Released under the MIT License."), (2, "a/b/x.py", False, "code"),
        (3, "a/b/y.py", False, "# Licensed under the Apache License, Version 2.0.\ncode"), (4, "c/z", False, None),
        (5, None, None, ""), (2, "a/b/x.py", False, "code")], "row long, path string, is_license boolean, text string")
    got = sorted((r.row, r.effective_license or "", r.inherited_from or "") for r in license.inherit(license.scan(files)).collect())
    assert got == [(1, "MIT", ""), (2, "MIT", "a"), (2, "MIT", "a"), (3, "Apache-2.0", ""), (4, "", ""), (5, "", "")]
    assert license.inherit(license.scan(files.limit(0))).count() == 0


def brute_license(text, is_license):
    """Best (similarity, name) of a text by cosine over all its passages."""
    def vector(t):
        return Counter(re.findall(license.TERM, t.lower()))
    names, texts = zip(*license.TEMPLATES)
    held = [vector(t) for t in texts]
    idf = lambda w: 1 + np.log((len(held) + 1) / (1 + sum(w in h for h in held)))
    length = lambda v: np.sqrt(sum((n * idf(w)) ** 2 for w, n in v.items()))
    plain = re.sub(license.COMMENT, "", (text or "").replace("\r\n", "\n"))
    units = plain.split("\n") + ([" ".join(plain.split())] if is_license else [])
    for paragraph in re.split(r"\n\s*\n", plain):
        paragraph = " ".join(paragraph.split())
        units += [paragraph] + re.split(r"(?<=[.!?;])\s+(?=[A-Z\"(])", paragraph)
    found = [(0.0, "")]
    for unit in set(units):
        if re.search(license.NOTICE, unit) and not re.search(license.DENIAL, unit):
            v = vector(unit)
            for name, h in zip(names, held):
                dot = sum(n * h[w] * idf(w) ** 2 for w, n in v.items())
                found.append((min(1.0, round(float(dot / (length(v) * length(h))), 9)) if v else 0.0, name))
    top = max(f[0] for f in found)
    return (top, min(n for s, n in found if s == top)) if top >= license.THRESHOLD else (0.0, "")


def test_license_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = rows(sf, "documents")
    docs = docs[docs.text.fillna("").str.contains(license.NOTICE) | (docs.doc_id % 20 == 0)]
    got = {r.doc_id: (r.license or "", r.similarity) for r in license.op7_license(spark, sf).collect()}
    assert len(got) == len(rows(sf, "documents"))
    for doc_id, text in docs[["doc_id", "text"]].itertuples(index=False):
        top, name = brute_license(text, doc_id % 50 < 5)
        assert got[doc_id][0] == name and abs(got[doc_id][1] - top) < 1e-8, doc_id
    assert sum(bool(name) for name, _ in got.values()) >= 30


def test_license_notices(spark):
    long = {name: text for name, text in license.TEMPLATES if len(text) > 200}
    wrap = lambda text, mark: "\n".join(mark + text[i:i + 60] for i in range(0, len(text), 60))
    words = re.split(r"(?<= )", long["GPL-3.0"])
    cases = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + long["MIT"] + "\n\nNo more."),
        ("GPL-3.0", "# " + "".join(words[:12]) + "\n# " + "".join(words[12:30]) + "\n# " + "".join(words[30:]) + "\nx = 1"),
        ("MIT", "// SPDX-License-Identifier: mit\nint x;"), ("GPL-3.0", "# SPDX-License-Identifier: GPL-3.0-or-later"),
        ("Zlib", "# SPDX-License-Identifier: Zlib"), ("Apache-2.0", "code\r\n\r\n# Licensed under the Apache\r\n# License, Version 2.0.\r\n"),
        ("MIT", "Prose stands here. Released under the MIT License. And goes on."), ("", "This is not released under the MIT License."),
        ("", "A licence to fish is needed at the lake."), ("", wrap("x" * 300, "# ")), ("", None), ("", " \n"),
        ("Apache-2.0", "word " * 200_000 + "\n\n" + long["Apache-2.0"] + "\n\n" + "word\n" * 1000),
        # Both tags count 1: the first name.
        ("Apache-2.0", "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0")]
    df = spark.createDataFrame([(i, f"d/{i}", False, text) for i, (_, text) in enumerate(cases)] * 2,
                               "row long, path string, is_license boolean, text string")
    df = df.selectExpr("*", "1 as term", "2 as unit", "3 as name", "4 as dir", "5 as given")
    got = license.inherit(license.scan(df)).collect()
    assert sorted((r.row, r.license or "") for r in got) == sorted((i, name) for i, (name, _) in enumerate(cases) for _ in range(2))


def test_chat(spark, sf_dir):
    t = rows(sf_dir, "conversations")
    want = {}
    turns = list(t.sort_values(["conv_id", "turn"])[["conv_id", "role", "text"]].itertuples(index=False))
    turns += [(-7, "user", "\\### Assistant: </turn> ok"), (-7, "assistant", "\\### Assistant: </turn> ok")]
    for c, role, text in turns:
        n, said, loss = want.get(c, (0, "", ""))
        text = text or ""
        want[c] = (n + 1, said + f"{role}\n{text}\n", loss + (text if role == "assistant" else ""))
    for r in chat.op8_chat(spark, sf_dir).collect():
        n, said, loss = want.pop(r.conv_id)
        assert (r.n_turns, r.loss_chars) == (n, len(loss))
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert not want


def test_chat_windows(spark):
    turns = [(1, 0, "system", "be good")] + [(1, i, "assistant" if i % 2 == 0 else "user", f"t{i} " * 10) for i in range(1, 9)]
    turns += [(2, 0, None, None), (None, None, "a: b", "\\\\m \\e")]
    w = chat.windows(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), budget=25, history=1)
    ones = w.where("conv_id = 1").orderBy("window").collect()
    assert len(ones) > 2 and all(r.text.startswith("### system: be good</turn>\n") for r in ones)
    read = chat.read_turns(w).orderBy("conv_id", "window").collect()
    assert [(x.role, x.text) for r in read if r.window is not None for x in r.turns if x.role == "a: b"] == [("a: b", "\\\\m \\e")]
    assert sum(len(r.losses) for r in read) == 4


@pytest.mark.parametrize("budget, history", [(25, 1), (25, 0), (40, 3)])
def test_chat_windows_keep_their_budget(spark, budget, history):
    rng = np.random.default_rng(budget + history)
    turns = [(c, i, "system" if i == 0 and c % 2 else ["user", "assistant"][i % 2],
              " ".join(["w"] * int(rng.choice([0, 1, 3, 9, 20, 60])))) for c in range(40) for i in range(int(rng.integers(1, 14)))]
    turns += turns[:3] + [(50, i, ["user", "assistant"][i % 2], "a b") for i in range(3000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 as window", "2 as items")
    made = chat.windows(df, budget, history)
    read = {(r.conv_id, r.window): r.turns for r in chat.read_turns(made).collect()}
    got, longest = {}, 0
    for r in sorted(made.collect(), key=lambda r: (r.conv_id, r.window)):
        own = read[r.conv_id, r.window]
        got.setdefault(r.conv_id, []).extend((t.role, t.text) for t in own)
        n = sum(len(words_of(p.split(": ", 1)[1].replace("</turn>", ""))) for p in r.text.split("### ")[1:])
        assert n == r.n_words and r.n_repeated - r.n_system <= history
        longest = max(longest, r.n_repeated - r.n_system)
        if n > budget:
            assert len(own) - (own[0].role == "system") <= 1 and r.n_repeated == r.n_system
    assert longest == history
    want = {}
    for c, _, role, text in sorted(turns):
        want.setdefault(c, []).append((role, text))
    assert got == want
    assert chat.windows(df.limit(0)).count() == 0 == chat.read_turns(chat.windows(df.limit(0))).count()


def test_tokens(spark, sf_dir):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokens.public_vocabulary())
    start = 0
    got = {r.doc_id: r for r in tokens.op9_tokens(spark, sf_dir).collect()}
    for d, text in sorted(zip(*[rows(sf_dir, "documents")[c] for c in ("doc_id", "text")])):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_tokens_edges(spark, odd_docs, tmp_path):
    tokens.write_tokens(odd_docs, str(tmp_path / "t"), tokens.public_vocabulary(), encoding="dictionary")
    got = tokens.token_index(spark, str(tmp_path / "t")).collect()
    assert len(got) == 11 and [r.n_tokens for r in got if r.doc_id in (1, 2)] == [1, 1]
    tokens.write_tokens(odd_docs.limit(0), str(tmp_path / "e"), tokens.public_vocabulary())
    assert tokens.token_index(spark, str(tmp_path / "e")).count() == 0


def test_topk(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = topk.op10_topk(spark, sf_dir).collect()
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(
        con.execute("select query_id, rank, vec_id, score from (" + topk.OP10_SQL + ")").fetchall())


def test_topk_edges(spark):
    v = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)] + [(20, None), (21, [None, 1.0]), (22, [float("nan"), 1.0]), (23, [])],
                              "vec_id long, embedding array<float>")
    v = topk.clean_vectors(v, "vec_id", "embedding")
    for block in (1, 10):
        got = topk.top_k(v, v.where("vec_id in (0, 3)"), 5, block).collect()
        assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == (
            [(0, i, i) for i in range(1, 6)] + [(3, i + 1, x) for i, x in enumerate([0, 1, 2, 4, 5])])
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0
    few = topk.top_k(v.where("vec_id < 3"), v.where("vec_id = 0"), 5).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]


def test_topk_large_values_lengths_and_clashes(spark):
    rows_ = [(0, [3.0e6, -1.0]), (1, [2.0e6, 5.0]), (2, [-4.0e6, 0.25]), (2, [1.0, 1.0]), (3, [1.0]), (4, [2.0])]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>").selectExpr("*", "1 as q", "2 as low", "3 as v")
    v = topk.clean_vectors(df, "vec_id", "embedding")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(v, v.where("vec_id in (0, 3)")).collect())
    n = {i: [int(256 * x) for x in x] for i, x in enumerate(x for _, x in rows_)}
    dot = lambda a, b: sum(x * y for x, y in zip(n[a], n[b]))
    assert got == [(0, 1, 1, dot(0, 1)), (0, 2, 2, dot(0, 3)), (0, 3, 2, dot(0, 2)), (3, 1, 4, dot(4, 5))]
    for large in (1e30, 1e16):
        bad = spark.createDataFrame([(0, [large, 1.0]), (1, [large, 1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="too large|64 bits"):
            b = topk.clean_vectors(bad, "vec_id", "embedding")
            topk.top_k(b, b).collect()


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == start.columns, name
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in docs.collect())
    assert all(r.n_tokens == len(r.ids) and r.ids[-1] == 0 for r in out)


def test_ngram_join_repeated_and_missing_ids(spark):
    """Ids do not name rows: two texts under one id, and none at all, both with twins."""
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcd"}
    data = [(1, text["a"]), (1, text["b"]), (2, text["a"]), (3, text["b"]), (None, text["c"]), (5, text["c"]), (6, text["c"]),
            (None, text["d"]), (None, text["d"]), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 0, 7, 8) for d, t in data], DOCS + ", row long, root long")
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.similar(docs).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (None, 5), (5, 5), (6, 5), (None, None), (None, None), (None, None)],
                         key=str)
    kept = ngram_join.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, (r.text or "-")[:1]) for r in kept.collect()), key=str) == sorted(
        [(1, "a"), (1, "b"), (5, "c"), (None, "d"), (None, "-")], key=str)


def test_ngram_join_heavy_and_light_classes(spark, monkeypatch):
    """Copies of a large class follow one row, those of a small one are searched; the result is the same."""
    texts = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(5)]
    docs = [(i, texts[i % 5] + (" more" if i % 7 == 0 else "")) for i in range(100)]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], DOCS)
    want = brute_groups(docs)
    for heavy in (1, 20, 10_000):
        monkeypatch.setattr(ngram_join, "HEAVY", heavy)
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar(df).collect()) == want


def test_short_items_and_clashing_names(spark, odd_docs):
    items = spark.createDataFrame([(1, "Alpha beta"), (2, "beta"), (3, "alpha beta gamma delta"), (4, ""), (5, None),
                                   (6, "one two three four five six")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x ALPHA  beta y", 1, 2, 3), (2, "alpha x beta", 1, 2, 3), (3, "alpha", 1, 2, 3),
                                  (4, "z alpha beta gamma delta", 1, 2, 3), (5, None, 1, 2, 3), (6, "", 1, 2, 3),
                                  (7, "go one two three four five six", 1, 2, 3)],
                                 "doc_id long, text string, d long, k long, doc long")
    got = {r.doc_id: r["items"] for r in decontaminate.contaminated(docs, items, least_words=1).collect()}
    assert got == {1: [1, 2], 2: [2], 4: [1, 2, 3], 7: [6]}
    kept = decontaminate.clean(docs, items, least_words=1)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 5, 6]
    named = odd_docs.withColumnsRenamed({"row": "_row", "set": "_time", "size": "doc"})
    mixed = mixing.mixed(named)
    assert mixed.columns == named.columns and {r["_row"] for r in mixed.collect()} == {1}


def test_ngram_join_checks_pairs_without_python_batches(spark, monkeypatch):
    plans, stored = {}, ngram_join.stored

    def kept(df, name, **settings):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stored(df, name, **settings)

    monkeypatch.setattr(ngram_join, "stored", kept)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words, "x"]), " ".join(words[:30]), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.similar(docs).collect()}
    assert got == {0: (0, 1), 1: (0, 1), 2: (2, 0), 3: (3, 0)}
    # A batch of pairs holds thousands of whole sets in memory, each as often as it is paired.
    assert {"first-links", "second-links"} <= set(plans)
    assert not any("MapInPandas" in plans[name] for name in ("first-links", "second-links"))


def test_ngram_join_fetches_no_sets_for_far_pairs(spark, monkeypatch):
    """Texts of common passages share many frequent tokens; their bitmaps tell that they do not link."""
    found, stored = {}, ngram_join.stored

    def kept(df, name, **settings):
        table = stored(df, name, **settings)
        found[name] = found.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(ngram_join, "stored", kept)
    rng = np.random.default_rng(4)
    passages = [" ".join(f"p{i}w{k}" for k in range(20)) for i in range(30)]
    docs = [(i, " ".join(passages[k] for k in rng.permutation(30)[:14])) for i in range(60)]
    # Large sets, two of them near each other.
    long = [f"l{k}" for k in range(2200)]
    docs += [(100, " ".join(long)), (101, " ".join([*long[:2150], "x"])), (102, " ".join(long[:1100] + [f"m{k}" for k in range(1100)]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar(df).collect())
    assert got == brute_groups(docs)
    assert found["candidates"] < 30  # of 1,770 pairs that share tokens


def test_ngram_join_bitmaps_differ_at_most_as_sets_do():
    rng = np.random.default_rng(5)
    for _ in range(200):
        both, left, right = (rng.integers(0, 1 << 63, rng.integers(0, 300)).astype(np.uint64) for _ in range(3))
        x, y = np.union1d(both, left), np.union1d(both, right)
        for words in (ngram_join.WORDS, ngram_join.WIDE_WORDS):
            bits = ngram_join.parity(x, words) ^ ngram_join.parity(y, words)
            assert len(bits) == words and np.bitwise_count(bits.view("u8")).sum() <= len(np.setxor1d(x, y))


def test_substring_turns_some_rows_at_a_time():
    import pandas as pd
    batch = pd.DataFrame({"row": range(1203)})
    parts = list(substring._parts([batch, batch.iloc[:0]], substring.ROWS))
    assert [len(p) for p in parts] == [500, 500, 203] and pd.concat(parts).equals(batch)


@pytest.mark.parametrize("window", [5, 16, 17, 35])
def test_index_finds_what_repeats_after_a_looked_up_run(window):
    import numpy as np
    rng = np.random.default_rng(3)
    base = rng.integers(-9, 9, 200)
    pieces = [base[a:a + n].copy() for a, n in ((0, 60), (20, 50), (90, 40), (100, 70), (150, window))]
    pieces[1][33] = 77
    times = [1, 1, 1, 1, 2]
    index = substring.FMIndex(np.concatenate(pieces), [len(p) for p in pieces], times, window)
    assert index.run == min(16, 1 << (window - 1).bit_length())
    seen = {}
    for p, n in zip(pieces, times):
        for o in range(len(p) - window + 1):
            key = tuple(p[o:o + window].tolist())
            seen[key] = seen.get(key, 0) + n
    want = [(i, o) for i, p in enumerate(pieces) for o in range(len(p) - window + 1)
            if seen[tuple(p[o:o + window].tolist())] > 1]
    got = zip(*(x.tolist() for x in index.repeated(window)))
    assert sorted(got) == want and want


def test_anchors_of_many_texts_are_those_of_each():
    import numpy as np
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 4, n).astype(np.uint64) for n in (0, 3, 34, 35, 36, 0, 400, 12, 35, 90, 34)]
    sizes = np.array([len(t) for t in texts])
    heads = np.cumsum(sizes) - sizes
    at, start, n, grams = substring.anchors(np.concatenate(texts), 35, 12, sizes)
    want = []
    for text, head in zip(texts, heads):
        if len(text) < 35:
            continue
        own = substring.shingle_hashes(text, 12)
        least = [s + int(np.argmin(own[s:s + 24])) for s in range(len(text) - 34)]
        for s, place in enumerate(least):
            if s and least[s - 1] == place:
                want[-1][2] += 1
            else:
                want.append([head + place, head + s, 1, int(own[place])])
    assert [list(x) for x in zip(at.tolist(), start.tolist(), n.tolist(), grams[at].tolist())] == want


def test_postings_without_another_of_nearly_that_size_go(spark):
    rows = spark.createDataFrame([(1, 1, 100), (1, 2, 84), (1, 3, 200), (2, 4, 100), (2, 5, 85), (2, 6, 300),
                                  (3, 7, 50), (4, 8, 9), (4, 9, 9)], "token int, id long, n_shingles long")
    assert sorted(r.id for r in ngram_join.near_in_size(rows, 85).collect()) == [4, 5, 8, 9]


def test_rows_split_by_their_keys(spark):
    from fieldbalance.llm.common import split_among
    rows = spark.range(1000).selectExpr("IF(id = 7, NULL, id) AS k")
    maybe, others = split_among(rows, "k", spark.range(100, 120).toDF("h"))
    held, rest = [r.k for r in maybe.collect()], [r.k for r in others.collect()]
    assert set(range(100, 120)) <= set(held) and len(held) < 100
    assert sorted(held + rest, key=str) == sorted([None if i == 7 else i for i in range(1000)], key=str)


def test_few_contaminated_rows_shuffle_no_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, None), (None, "a b c d e f g"), (3, "x y z")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    got = decontaminate.clean(docs, items, least_words=1)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(2, None), (3, "x y z")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "_mask" in plan
