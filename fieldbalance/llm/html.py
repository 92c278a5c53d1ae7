"""Main text of pages: sum-product message passing over the DOM tree."""

from __future__ import annotations

import math
import random
import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.llm.common import table

# HTML element names by their role in the tree.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template head title svg math iframe object select textarea".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody "
            "td tfoot th thead tr ul".split())
CLOSES_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
                 "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
#: Elements that may stand in an open head; any other start tag ends it.
IN_HEAD = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Foreign or form content that a block inside it ends, unless an element of INSIDE lies between.
ENDS_AT_BLOCK = {"svg", "math", "select"}
INSIDE = {"foreignobject", "desc", "annotation-xml"}
_word = re.compile(r"[a-z]+")


class Tree(HTMLParser):
    """Nodes in page order: parent, tag, names of class, id and role, pieces of text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.names = [-1], ["#root"], [set()]
        self.pieces: list[tuple[int, str | None]] = []
        self.stack = [0]
        self.feed(html)
        self.close()

    def _leave(self, tag):
        """A head, drawing or selection left open ends where the body goes on."""
        if self.tag[self.stack[-1]] == "head" and tag not in IN_HEAD:
            self.stack.pop()
        if tag in BLOCK and tag != "hr":
            for i in range(len(self.stack) - 1, 0, -1):
                if self.tag[self.stack[i]] in INSIDE:
                    return
                if self.tag[self.stack[i]] in ENDS_AT_BLOCK:
                    del self.stack[i:]
                    return

    def handle_starttag(self, tag, attrs):
        self._leave(tag)
        if tag in BLOCK:
            self._pop({"p"}, {"button", "table", "#root"} | (BLOCK - {"p"}))
        if tag in CLOSES_ITSELF:
            self._pop({tag} | ({"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else set()),
                      CLOSES_ITSELF[tag])
        if tag in BLOCK:
            self.pieces.append((self.stack[-1], None))
        names = {w for key, value in attrs if key in ("class", "id", "role") and value
                 for w in _word.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())}
        names |= {"hidden"} if any(k == "hidden" or (k == "style" and v and "display:none" in v.replace(" ", "").lower())
                                   for k, v in attrs) else set()
        self.parent.append(self.stack[-1])
        self.tag.append(tag)
        self.names.append(names)
        if tag == "br":
            self.pieces.append((self.stack[-1], " "))
        if tag not in VOID:
            self.stack.append(len(self.tag) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def _pop(self, tags, stop):
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[i]]
            if tag in tags:
                self.pieces.append((self.stack[i], None))
                del self.stack[i:]
                return
            if tag in stop:
                return

    def handle_endtag(self, tag):
        # A close tag without its open one says nothing.
        for i in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[i]] == tag:
                del self.stack[i:]
                break
        if tag in BLOCK:
            self.pieces.append((self.stack[-1], None))

    def handle_data(self, data):
        if data.strip():
            self._leave("")
        if not any(self.tag[i] in SILENT for i in self.stack):
            self.pieces.append((self.stack[-1], data))


def node_features(tree: Tree) -> list[list[str]]:
    """Tag, names, amount of own and inner text and share of links of every node."""
    n = len(tree.tag)
    chars, linked = [0] * n, [0] * n
    for node, text in tree.pieces:
        if text:
            size = len(text.strip())
            chars[node] += size
            if tree.tag[node] == "a":
                linked[node] += size
    for i in range(n - 1, 0, -1):
        chars[tree.parent[i]] += chars[i]
        linked[tree.parent[i]] += chars[i] if tree.tag[i] == "a" else linked[i]
    out = []
    for i in range(n):
        share = linked[i] / chars[i] if chars[i] else 0
        out.append([f"tag {tree.tag[i]}", f"chars {min(4, int(math.log(1 + chars[i], 6)))}",
                    f"links {'most' if share > .6 else 'some' if share > .2 else 'few'}"]
                   + [f"name {w}" for w in sorted(tree.names[i])])
    return out


def train(pages: list[tuple[str, set]]) -> dict:
    """Potentials from labelled pages: (html, names that mark what is not main text).

    A node is boilerplate if it or a node above it carries one of those names.
    """
    seen: dict[str, list[float]] = {}
    pair = [[1.0, 1.0], [1.0, 1.0]]
    total = [1.0, 1.0]
    for html, in_boilerplate in pages:
        tree = Tree(html)
        label = []
        for i in range(len(tree.tag)):
            above = label[tree.parent[i]] if i else 1
            label.append(0 if above == 0 or tree.names[i] & in_boilerplate else 1)
            if i:
                pair[above][label[i]] += 1
        for i, features in enumerate(node_features(tree)):
            total[label[i]] += 1
            for f in features:
                if f[5:] not in in_boilerplate:
                    seen.setdefault(f, [0.5, 0.5])[label[i]] += 1
    log_odds = {f: math.log(c[1] / (total[1] + 1)) - math.log(c[0] / (total[0] + 1)) for f, c in seen.items()}
    return {"unary": log_odds, "pair": [[math.log(v / sum(row)) for v in row] for row in pair]}


def marginals(tree: Tree, model: dict) -> list[float]:
    """Probability of main text per node: messages up the tree, then down."""
    n, pair, unary = len(tree.tag), model["pair"], model["unary"]
    local = [[0.0, max(-12.0, min(12.0, sum(unary.get(f, 0.0) for f in fs)))] for fs in node_features(tree)]
    local[0] = [0.0, 6.0]
    add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
    up = [list(x) for x in local]
    message: list = [None] * n
    for i in range(n - 1, 0, -1):
        message[i] = [add(pair[p][0] + up[i][0], pair[p][1] + up[i][1]) for p in (0, 1)]
        up[tree.parent[i]][0] += message[i][0]
        up[tree.parent[i]][1] += message[i][1]
    belief = [list(up[0])] + [None] * (n - 1)
    for i in range(1, n):
        rest = [belief[tree.parent[i]][p] - message[i][p] for p in (0, 1)]
        belief[i] = [up[i][y] + add(rest[0] + pair[0][y], rest[1] + pair[1][y]) for y in (0, 1)]
        shift = max(belief[i])
        belief[i] = [b - shift for b in belief[i]]
    return [1 / (1 + math.exp(max(-60.0, min(60.0, b[0] - b[1])))) for b in belief]


def main_text(html: str | None, model: dict, threshold: float = 0.5) -> str:
    if not html:
        return ""
    tree = Tree(html)
    content = marginals(tree, model)
    blocks, current = [], []
    for node, text in tree.pieces + [(0, None)]:
        if text is None:
            block = " ".join("".join(current).split())
            if block:
                blocks.append(block)
            current = []
        elif content[node] >= threshold:
            current.append(text)
    return "\n\n".join(blocks)


# Names that the labelled pages use.
BOILERPLATE = [
    ("nav", ""), ("nav", "menu"), ("header", "site header"), ("footer", ""), ("footer", "site footer"), ("aside", ""),
    ("aside", "sidebar"), ("div", "ad"), ("div", "advert banner"), ("div", "ads advertisement sponsored promo"),
    ("div", "cookie notice consent"), ("div", "notice alert gdpr popup modal"), ("form", ""), ("form", "search newsletter subscribe"),
    ("section", "comments"), ("div", "comment list replies"), ("ul", "menu navigation"), ("div", "related share social"),
    ("div", "breadcrumb breadcrumbs"), ("div", "navbar topbar menu"), ("div", "footer copyright legal"), ("div", "widget sidebar"),
    ("div", "reader comments"), ("ol", "comments comment"), ("div", "header masthead"), ("div", "hidden"), ("button", "")]
CONTENT = [("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "main content"), ("div", "post body"),
           ("div", "article text"), ("section", "entry content"), ("article", "story")]


def labelled_pages(count: int = 400, seed: int = 3) -> list[tuple[str, set]]:
    """Labelled pages made by rule: boilerplate of every kind around and inside an article."""
    rng = random.Random(seed)

    def prose(low, high):
        return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(1, 9)))
                        for _ in range(rng.randint(low, high))).capitalize() + "."

    def junk():
        tag, names = rng.choice(BOILERPLATE)
        inner = rng.choice([
            lambda: prose(2, 30),
            lambda: "".join(f"<p>{prose(3, 40)}</p>" for _ in range(rng.randint(1, 4))),
            lambda: "<ul>" + "".join(f'<li><a href="/x">{prose(1, 3)}</a></li>' for _ in range(rng.randint(2, 8))) + "</ul>",
            lambda: f"<h3>{prose(1, 4)}</h3><p>{prose(4, 40)}</p>",
            lambda: f'<div><span>{prose(1, 4)}</span><p>{prose(4, 30)}</p><a href="/y">{prose(1, 2)}</a></div>',
            lambda: f"<label>{prose(1, 3)}</label><input><button>{prose(1, 2)}</button>"])()
        return f'<{tag} class="{names} zzjunk">{inner}</{tag}>'

    def block():
        return rng.choice([
            lambda: f"<p>{prose(3, 90)}</p>", lambda: f"<p>{prose(3, 90)}</p>", lambda: f"<p>{prose(8, 60)} <b>{prose(1, 4)}</b></p>",
            lambda: f'<p>{prose(8, 60)} <a href="/z">{prose(1, 4)}</a> <em>{prose(1, 9)}</em></p>', lambda: f"<h2>{prose(1, 7)}</h2>",
            lambda: f"<p><b>{prose(2, 40)}<br><p>{prose(3, 60)}</p>",
            lambda: "<ul>" + "".join(f"<li>{prose(2, 20)}</li>" for _ in range(rng.randint(1, 6))) + "</ul>",
            lambda: f"<blockquote><p>{prose(4, 40)}</p></blockquote>", lambda: f"<pre><code>{prose(3, 30)}</code></pre>",
            lambda: f"<table><tr><th>{prose(1, 3)}</th><td>{prose(1, 9)}</td></tr></table>",
            lambda: f"<figure><figcaption>{prose(3, 12)}</figcaption></figure>", lambda: f"<div>{prose(5, 60)}</div>",
            lambda: f"<section><h3>{prose(1, 6)}</h3><p>{prose(5, 50)}</p></section>",
            lambda: f"<ol><li><p>{prose(3, 30)}</p></li></ol>", lambda: f"<dl><dt>{prose(1, 3)}</dt><dd>{prose(2, 20)}</dd></dl>"])()

    pages = []
    for _ in range(count):
        tag, names = rng.choice(CONTENT)
        inside = [f"<h1>{prose(2, 9)}</h1>"] + [block() for _ in range(rng.randint(1, 12))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            inside.insert(rng.randint(1, len(inside)), junk())
        body = "".join(junk() for _ in range(rng.randint(1, 5))) + f'<{tag} class="{names}">' + "".join(inside) + f"</{tag}>"
        body += "".join(junk() for _ in range(rng.randint(1, 5)))
        if rng.random() < .3:
            body = f'<div class="page wrapper container">{body}</div>'
        pages.append((f"<html><head><title>x</title></head><body>{body}</body></html>", {"zzjunk"}))
    return pages


def extract(pages: DataFrame, model: dict) -> DataFrame:
    """page_id, url, text, n_chars per row; null, empty and contentless pages have an empty text.

    A head left open ends at the first element or text of the body, an open svg, math or
    select at the next block; an open script, style or template hides the rest. Very long
    pages are read whole, one at a time. Repeated rows and ids stay rows of their own, other
    columns are not read, an empty table gives no rows.
    """
    def run(batches):
        for batch in batches:
            text = [main_text(h, model) for h in batch["html"]]
            yield batch[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string, n_chars long")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), train(labelled_pages()))
