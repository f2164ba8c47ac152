"""Main text of web pages by a tree-structured graphical model over the page's elements.

Every block element is a node that is content or not. A node's potential comes from its own features, an edge's from how
parents and children agree; messages up and down the tree give each node's exact marginal. Potentials are fitted to a
bounded sample of pages whose own markup marks the article.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfields.llm.arrays import unused

#: Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset("""a abbr acronym audio b bdi bdo big br canvas cite code data del dfn em font i img ins kbd map mark math object q rp
    rt ruby s samp small span strike strong sub sup svg time tt u var video wbr""".split())
#: Elements whose own elements are no HTML and stand in the line of text.
FOREIGN = frozenset(["svg", "math"])
SILENT = frozenset("script style title head template iframe noembed noframes annotation annotation-xml desc metadata".split())
#: What a start tag ends, if it is open: the tag and how far up to look.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
KEEPS_P = INLINE | {"button", "input", "label", "select", "option", "textarea", "img", "script", "style", "template", "noscript", "iframe"}

TAG_GROUPS = {
    "article": {"article", "main"}, "nav": {"nav", "menu"}, "header": {"header"}, "footer": {"footer"}, "aside": {"aside"},
    "form": {"form", "button", "select", "option", "label", "textarea", "fieldset", "legend", "datalist", "dialog"},
    "paragraph": {"p", "blockquote", "pre"}, "heading": {"h1", "h2", "h3", "h4", "h5", "h6"}, "list": {"ul", "ol", "li", "dl", "dt", "dd"},
    "table": {"table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}, "box": {"div", "section", "center", "body", "html"},
    "figure": {"figure", "figcaption"}}
#: Words in class, id or role that tell what an element is for.
NAME_GROUPS = {
    "named_advert": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner adsense",
    "named_menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs skip",
    "named_edge": "header masthead topbar footer bottom copyright contentinfo colophon",
    "named_side": "sidebar aside rail related recommended recommendations more widget complementary trending popular tags share social",
    "named_notice": "cookie cookies consent gdpr notice alert popup modal overlay toast message warning paywall newsletter subscribe",
    "named_comment": "comment comments commentlist discussion disqus reply replies respond reader",
    "named_form": "form search login signup signin register",
    "named_content": "content article post entry story body main text prose"}
NAME_GROUPS = {k: frozenset(v.split()) for k, v in NAME_GROUPS.items()}
FEATURES = ["bias", *[f"tag_{g}" for g in TAG_GROUPS], *NAME_GROUPS, "linked", "no_text", "short_text", "long_text", "sentence", "hidden"]
BIT = {name: 1 << i for i, name in enumerate(FEATURES)}
#: Where weights start from, and stay where the sample has nothing to say.
PRIOR = {"tag_article": 2, "tag_nav": -5, "tag_header": -3, "tag_footer": -5, "tag_aside": -5, "tag_form": -5, "tag_paragraph": 1.5,
         "tag_heading": 1, "named_advert": -5, "named_menu": -4, "named_edge": -4, "named_side": -4, "named_notice": -5, "named_comment": -6,
         "named_form": -3, "named_content": 1, "linked": -2.5, "short_text": -0.5, "long_text": 1.5, "sentence": 0.5, "hidden": -6}
#: Tags that label a sample page; each sample page is learnt from twice, once without them, so that other signs count.
LABEL_TAGS = BIT["tag_article"] | BIT["tag_nav"] | BIT["tag_header"] | BIT["tag_footer"] | BIT["tag_aside"]
UNWANTED = frozenset("nav menu header footer aside form button select dialog".split())
UNWANTED_NAMES = frozenset().union(*(v for k, v in NAME_GROUPS.items() if k != "named_content"))

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
GROUP_OF = {tag: BIT[f"tag_{g}"] for g, tags in TAG_GROUPS.items() for tag in tags}
NAME_BITS = {word: sum(BIT[g] for g, words in NAME_GROUPS.items() if word in words) for word in frozenset().union(*NAME_GROUPS.values())}


BEGINS = BIT["tag_article"] | BIT["tag_box"]


def begins(bits: int) -> int:
    return int(bits & BEGINS > 0)


class Tree:
    """Block elements in page order: ``parent``, ``tag``, attribute ``names`` and ``bits``; ``runs`` of text with their node."""

    def __init__(self, page: str):
        self.parent, self.tag, self.names, self.bits = [-1], ["html"], [frozenset()], [BIT["bias"] | GROUP_OF["html"]]
        self.chars, self.linked = [0], [0]
        self.runs: list[tuple[int, str]] = []
        self._open: list[tuple[str, int]] = [("html", 0)]  # every open element, with its block element
        self._text: list[str] = []
        self._silent = self._links = self._foreign = 0
        self._parse(page)
        self._flush()

    def _flush(self) -> None:
        """End the run of text; it belongs to the innermost block element."""
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text = []
            if text:
                self.runs.append((self._open[-1][1], text))

    def _say(self, text: str) -> None:
        if text and not self._silent:
            node = self._open[-1][1]
            n = len(text) - text.count(" ")
            self.chars[node] += n
            if self._links:
                self.linked[node] += n
            self._text.append(text)

    def _pop_to(self, depth: int) -> None:
        while len(self._open) > depth:
            name, _ = self._open[-1]
            if name not in INLINE and not self._foreign:
                self._flush()
            self._open.pop()
            self._foreign -= name in FOREIGN
            self._silent -= name in SILENT
            self._links -= name == "a"

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and any(x == name for x, _ in self._open):
            return
        if self._foreign or name in FOREIGN:
            if not attributes.rstrip().endswith("/"):
                self._open.append((name, self._open[-1][1]))
                self._foreign += name in FOREIGN
                self._silent += name in SILENT
            return
        if name not in KEEPS_P:
            for d in range(len(self._open) - 1, 0, -1):
                if self._open[d][0] == "p":
                    self._pop_to(d)
                    break
                if self._open[d][0] in ("td", "th", "table", "button", "li", "div", "section", "article", "form"):
                    break
        if name in CLOSES:
            ends, up_to = CLOSES[name]
            for d in range(len(self._open) - 1, 0, -1):
                if self._open[d][0] in ends:
                    self._pop_to(d)
                    break
                if self._open[d][0] in up_to:
                    break
        if name == "br" or name == "hr" or name == "img":
            self._say(" ")
        if name in VOID:
            return
        if name in INLINE:
            self._open.append((name, self._open[-1][1]))
            self._links += name == "a"
            return
        self._flush()
        node, names, hidden = len(self.parent), [], False
        for k, v in ATTRIBUTE.findall(attributes):
            k, v = k.lower(), v.strip("\"'")
            if k in ("class", "id", "role"):
                names += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", html.unescape(v)).lower())
            elif k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and re.search(r"display\s*:\s*none", v):
                hidden = True
        bits = BIT["bias"] | GROUP_OF.get(name, 0) | (BIT["hidden"] if hidden else 0)
        for word in names:
            bits |= NAME_BITS.get(word, 0)
        self.parent.append(self._open[-1][1])
        self.tag.append(name)
        self.names.append(frozenset(names))
        self.bits.append(bits)
        self.chars.append(0)
        self.linked.append(0)
        self._open.append((name, node))
        self._silent += name in SILENT

    def _end(self, name: str) -> None:
        for d in range(len(self._open) - 1, 0, -1):
            if self._open[d][0] == name:
                self._pop_to(d)
                return
            if self._open[d][0] in FOREIGN or name in INLINE and self._open[d][0] not in INLINE and not self._foreign:
                return
        if name in ("br", "p"):
            self._say(" ")

    def _parse(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            lt = page.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                self._say(html.unescape(page[at:lt]))
            if lt == n:
                return
            at = lt
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                at = n if end < 0 else end + 3
                continue
            follows = page[at + 1 : at + 3]
            if follows[:1] in ("!", "?") or follows[:1] == "/" and not follows[1:].isalpha():
                end = page.find(">", at)
                at = n if end < 0 else end + 1
                continue
            m = TAG.match(page, at)
            if m is None:
                if not (follows[:1].isascii() and follows[:1].isalpha() or follows[:1] == "/"):
                    self._say("<")
                    at += 1
                    continue
                end = page.find(">", at)
                if end < 0:
                    return  # a tag that never ends
                m = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>").match(page, at)
            at, name = m.end(), m[2].lower()
            if m[1]:
                self._end(name)
                continue
            self._start(name, m[3])
            if name in RAW:
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                at = n if stop is None else stop.start()

    def features(self) -> list[int]:
        """Bits of every node, with those that its text gives; texts of descendants count for links and length."""
        chars, linked, out = self.chars[:], self.linked[:], self.bits[:]
        ends = [False] * len(out)
        for node, text in self.runs:
            ends[node] = ends[node] or text[-1] in ".!?。！？…\"'”»)"
        for i in range(len(out) - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            linked[self.parent[i]] += linked[i]
        for i, bits in enumerate(out):
            n = self.chars[i]
            if linked[i] * 2 > chars[i]:
                bits |= BIT["linked"]
            bits |= BIT["no_text"] if not n else BIT["short_text"] if n < 40 else BIT["long_text"] if n >= 200 else 0
            if ends[i]:
                bits |= BIT["sentence"]
            out[i] = bits
        return out

    def labels(self) -> list[int] | None:
        """Content or not by the page's own markup; None where it marks no article."""
        for mark in ("article", "main"):
            if mark in self.tag:
                break
        else:
            return None
        inside, bad = [0] * len(self.tag), [0] * len(self.tag)
        for i, tag in enumerate(self.tag):
            p = self.parent[i]
            inside[i] = tag == mark or (inside[p] if p >= 0 else 0)
            bad[i] = tag in UNWANTED or bool(self.names[i] & UNWANTED_NAMES) or (bad[p] if p >= 0 else 0)
        return [int(a and not b) for a, b in zip(inside, bad, strict=True)]


@dataclass(frozen=True)
class TreeModel:
    """Log-odds of each feature, the share of content nodes, and a child's chance to be content if its parent is not, or is.

    That chance differs between the elements in which content may begin (``BEGINS``, the second pair) and others.
    """

    weights: tuple[float, ...]
    share: float
    below: tuple[tuple[float, float], tuple[float, float]]

    def marginals(self, tree: Tree) -> list[float]:
        """Log-odds of each node to be content: messages up the tree, then down."""
        base = math.log(self.share / (1 - self.share))
        found = tree.features()
        up = [sum(w for i, w in enumerate(self.weights) if bits >> i & 1) - base for bits in found]
        below = [self.below[begins(bits)] for bits in found]
        message = [0.0] * len(up)
        for i in range(len(up) - 1, 0, -1):
            odds, (off, on) = math.exp(max(-40.0, min(40.0, up[i]))), below[i]
            message[i] = math.log(((1 - on) + on * odds) / ((1 - off) + off * odds))
            up[tree.parent[i]] += message[i]
        out = up[:]
        out[0] += base
        for i in range(1, len(out)):
            odds, (off, on) = math.exp(max(-40.0, min(40.0, out[tree.parent[i]] - message[i]))), below[i]
            out[i] = up[i] + math.log((off + on * odds) / ((1 - off) + (1 - on) * odds))
        return out

    def text(self, page: str) -> str:
        """Runs of text in content nodes, in page order."""
        tree = Tree(page)
        odds = self.marginals(tree)
        return "\n\n".join(text for node, text in tree.runs if odds[node] > 0)


#: Pages that a model is fitted to at most, and how many nodes they weigh against the prior: pages of one make repeat
#: themselves, and signs that they lack must keep their say.
SAMPLE_PAGES, SAMPLE_WEIGHT = 2_000, 150.0


def fit(pages: DataFrame, page: str = "html", key: str = "page_id", sample: int = SAMPLE_PAGES) -> TreeModel:
    """A model from at most ``sample`` of ``pages`` that mark their article: those with the smallest hash of key and page.

    Only counts of feature sets come to the driver. Without such pages, or with an empty table, the prior is the model.
    """
    order = F.pmod(F.xxhash64(F.col(key), F.col(page)), F.lit(1 << 40))
    marked = pages.where(F.col(page).rlike("(?i)<(article|main)\\b")).select(F.col(page).alias("_page"), order.alias("_order"))
    # Few more than the sample pass the bound on the hash, so no task gathers the best of all tasks.
    bound = math.ceil((1 << 40) * min(1.0, 1.3 * sample / max(1, marked.count())))
    chosen = marked.where(F.col("_order") < bound).orderBy("_order", "_page").limit(sample)

    def run(batches):
        for batch in batches:
            bits, label, above = [], [], []
            for text in batch.column("_page").to_pylist():
                tree = Tree(text)
                labels = tree.labels()
                if labels is None:
                    continue
                for i, b in enumerate(tree.features()):
                    for hide in (0, LABEL_TAGS):
                        bits.append(b & ~hide | (BIT["tag_box"] if b & hide else 0))
                        label.append(labels[i])
                        above.append(labels[tree.parent[i]] if i else -1)
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.int64()), pa.array(label, pa.int32()), pa.array(above, pa.int32())], names=["bits", "label", "above"])

    counts = chosen.mapInArrow(run, "bits long, label int, above int").groupBy("bits", "label", "above").count().collect()
    rows = [(r["bits"], r["label"], r["above"], r["count"]) for r in sorted(counts)]
    # What the prior holds: children by kind, parent's label and own label.
    agree = np.array([[[600.0, 3.0], [15.0, 400.0]], [[200.0, 20.0], [20.0, 100.0]]])
    scale = SAMPLE_WEIGHT / max(SAMPLE_WEIGHT, sum(n for *_, n in rows))
    for bits, label, above, n in rows:
        if above >= 0:
            agree[begins(bits), above, label] += n * scale
    below = agree[:, :, 1] / agree.sum(axis=2)
    content = 100.0 + scale * sum(n for _, y, _, n in rows if y)
    total = 250.0 + scale * sum(n for *_, n in rows)
    prior = np.array([PRIOR.get(f, 0.0) for f in FEATURES])
    weights = prior.copy()
    if rows:
        x = np.array([[b >> i & 1 for i in range(len(FEATURES))] for b, *_ in rows], dtype=float)
        y, n = np.array([r[1] for r in rows], dtype=float), np.array([r[3] * scale for r in rows])
        for _ in range(25):  # Newton steps; a normal prior around PRIOR
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(weights)), x.T @ (n * (y - p)) - (weights - prior))
            weights = weights + step
            if abs(step).max() < 1e-8:
                break
    return TreeModel(tuple(float(w) for w in weights), float(content / total), tuple(map(tuple, below.tolist())))


def extract(pages: DataFrame, model: TreeModel, page: str = "html", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all but ``page`` and ``text`` by default) and the main ``text`` of each page (null page: empty).

    Character references are decoded, white space inside a block becomes one space, blocks are joined by an empty line.
    Repeated rows stay; an empty table gives no rows. A very long page is parsed whole. A column of ``pages`` named as the
    result gives way to it.
    """
    from pyspark.sql import types as T

    names = [c for c in pages.columns if c != page] if keep is None else keep
    names = [c for c in names if c.lower() != text.lower()]
    inner = unused("_page", names)
    schema = T.StructType([*[pages.schema[c] for c in names], T.StructField(text, T.StringType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [model.text(p or "") for p in part.column(inner).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, text])

    return pages.select(*names, F.col(page).alias(inner)).mapInArrow(run, schema)
