"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements with the text blocks as leaves. Every node is content or not. A node's
own potential sums what its tag, the words of its class, id and role, and the shape of its text speak for; the
potential between parent and child is the probability that a child of a content node, by that node's tag, is content
too, while children of other nodes hardly ever are. Messages go up the tree and down again (sum-product, which is exact
on trees), and the blocks whose marginal is above one half are the text.

Potentials are logarithms of smoothed counts over labelled pages: a block counts as content if it is a line, or
the beginning, of the page's document. No tag or name has a potential of its own: what is not learnt says nothing.
Training pages show little of the furniture that sites have, so each is learnt from twice, as it is and furnished:
with menus, notices, forms, comments and the like, of usual tags and names, put around and into its article, whose own
element gets usual names too (``furnished``). A cue of an element that is nearly always content, or nearly never,
counts once for every text below it and ``STRENGTH`` times besides; the others, and the shape of single texts, say little.
At most ``SAMPLE`` pages are learnt from; extraction looks at one page at a time, the whole of it, with work in
proportion to its length, broken markup included.

Null pages are empty; an empty page, or one without content, has the text ``''``. Broken markup is read as browsers do: open
paragraphs end at the next block, stray end tags are dropped, what is left open ends with its parent.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from random import Random

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from shelfsense.shared import settled

#: Pages to learn from at most, and the share of nodes (one in so many) that a cue must be seen in.
SAMPLE, LEAST_SEEN = 2_000, 100_000
#: What one plain cue may speak for content and against it, and the chance of content below furniture (logarithms).
#: Many leaves of one subtree speak alike, so each may say little for itself.
FOR, AGAINST, BELOW = 0.1, 0.3, -1e12
#: Log-odds from which a cue of an element is decisive, and how often it counts then, the texts below it aside.
DECISIVE, STRENGTH = 2.5, 20.0
#: Pseudo-counts of a tag's share of children that are not content.
PRIOR_COUNT = 20

# Inline elements of HTML, elements whose text is not shown, elements without an end.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
HIDDEN = frozenset("script style head title noscript template textarea iframe object svg canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element (left) ends where one of these (right) begins.
ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
#: Usual names of furniture and of articles, and elements of furniture, to furnish training pages with.
FURNITURE = (
    "nav navbar navigation menu header masthead footer sidebar ad ads advert advertisement adverts banner promo "
    "sponsor sponsored cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription "
    "form search login signup comment comments respond replies reply discussion share sharing social related recommended "
    "breadcrumb breadcrumbs widget toolbar pagination pager copyright legal disclaimer"
).split()
CONTENT = "article main content post entry story".split()
SETTINGS = (
    "<div>%s</div>",
    "<div><p>%s</p></div>",
    "<section><p>%s</p></section>",
    "<ul><li>%s</li></ul>",
    "<ol><li>%s</li></ol>",
    "<table><tr><td>%s</td></tr></table>",
    "<h2>%s</h2>",
    "<h3>%s</h3>",
    "<blockquote><p>%s</p></blockquote>",
    "<section><div><p>%s</p></div></section>",
    "<div><div><p>%s</p></div></div>",
    "<pre>%s</pre>",
    "<figure><figcaption>%s</figcaption></figure>",
)
ELEMENTS = "nav header footer aside form menu dialog fieldset".split()

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_OPEN_COMMENT = re.compile(r"<!--.*\Z|<[!?].*\Z", re.S)
_NAMES = re.compile(r"(?:\s|\"|'|^)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_PARAGRAPH = re.compile(r"<p>([^<]*+)</p>")


@lru_cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?![a-z0-9])[^>]*+>", re.I)


@dataclass
class Tree:
    """Nodes in the order of the page, each behind its parent."""

    parent: list[int] = field(default_factory=list)
    cues: list[list[str]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)  # of leaves

    def add(self, parent: int, cues: list[str], text: str | None = None) -> int:
        self.parent.append(parent)
        self.cues.append(cues)
        self.text.append(text)
        return len(self.parent) - 1


def _leaf_cues(text: str, linked: int) -> list[str]:
    words = len(text.split())
    return [
        f"words:{min(6, words.bit_length())}",
        f"end:{text[-1] in '.!?…»”'}",
        f"linked:{min(3, 4 * linked // max(1, len(text)))}",
    ]


def parse(page: str) -> Tree:
    tree, stack = Tree(), []  # of (tag, node)
    buffer: list[str] = []
    linked = in_link = 0
    root = tree.add(-1, ["tag:root"])

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                tree.add(stack[-1][1] if stack else root, _leaf_cues(text, linked), text)
            buffer.clear()
        linked = 0

    at, end, last = 0, len(page), page.rfind(">")
    depth: Counter = Counter()  # how often a tag is open
    unclosed: set[str] = set()  # tags without an end tag from here on
    while at < end:
        # behind the last bracket that closes there is no tag, but there may be a comment left open
        token = _TOKEN.search(page, at) if at <= last else _OPEN_COMMENT.search(page, at)
        upto = token.start() if token else end
        if upto > at:
            buffer.append(page[at:upto])
            if in_link:
                linked += upto - at
        if not token:
            break
        at = token.end()
        tag = (token[2] or token[5] or "").lower() if token.re is _TOKEN else ""
        if not tag:
            continue  # a comment
        closing, attributes = token[1] or token[4], token[3] or token[6] or ""
        if tag in HIDDEN and not closing:
            if not attributes.endswith("/"):
                close = None if tag in unclosed else _end_of(tag).search(page, at, last + 1)
                if not close:
                    unclosed.add(tag)
                if close or tag in ("script", "style", "textarea", "title"):
                    at = close.end() if close else end
            buffer.append(" ")
        elif tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                buffer.append(" ")
        elif closing:
            flush()
            in_link = 0
            while depth[tag]:
                found, _ = stack.pop()
                depth[found] -= 1
                if found == tag:
                    break
        else:
            flush()
            in_link = 0
            while stack and (stack[-1][0] == "p" or tag in ENDS.get(stack[-1][0], ())):
                depth[stack.pop()[0]] -= 1
            found = " ".join("".join(x) for x in _NAMES.findall(attributes)).lower() if attributes else ""
            cues = [f"tag:{tag}", *(f"name:{w}" for w in set(_WORD.findall(found)))]
            node = tree.add(stack[-1][1] if stack else root, cues)
            if tag not in VOID and not attributes.endswith("/"):
                stack.append((tag, node))
                depth[tag] += 1
    flush()
    return tree


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


@dataclass(frozen=True)
class Model:
    """Log-odds of plain and of decisive cues, of the root, and by tag the chance that a child of a content node is none."""

    cues: dict[str, float]
    decisive: dict[str, float]
    prior: float
    leaves: dict[str, float]

    def potentials(self, tree: Tree) -> list[float]:
        """The log-odds of every node by its own cues."""
        texts = [0 if t is None else 1 for t in tree.text]
        for i in range(len(texts) - 1, 0, -1):
            texts[tree.parent[i]] += texts[i]
        return [
            sum(self.cues.get(c, 0.0) + self.decisive.get(c, 0.0) * (STRENGTH + n) for c in cues)
            for cues, n in zip(tree.cues, texts, strict=True)
        ]

    def loss(self, cues: list[str]) -> float:
        return self.leaves.get(cues[0], self.leaves[""])

    def marginals(self, tree: Tree) -> list[float]:
        """The probability of each node to be content, by messages to the root and back."""
        n = len(tree.parent)
        links = [(math.log(1 - a), math.log(a)) for a in map(self.loss, tree.cues)]  # below each node
        up = [0.0] * n
        below = self.potentials(tree)  # with the messages of the children
        below[0] += self.prior
        for i in range(n - 1, 0, -1):
            stays, goes = links[tree.parent[i]]
            up[i] = _log_sum(stays + below[i], goes) - _log_sum(BELOW + below[i], 0.0)
            below[tree.parent[i]] += up[i]
        belief = below[:]
        for i in range(1, n):
            stays, goes = links[tree.parent[i]]
            above = belief[tree.parent[i]] - up[i]
            belief[i] += _log_sum(stays + above, BELOW) - _log_sum(goes + above, 0.0)
        return [1 / (1 + math.exp(-max(-500.0, min(500.0, b)))) for b in belief]

    def extract(self, page: str) -> str:
        tree = parse(page)
        found = self.marginals(tree)
        return "\n".join(t for t, p in zip(tree.text, found, strict=True) if t is not None and p > 0.5)


def labelled(tree: Tree, document: str) -> list[bool | None]:
    """Per node whether most of its text is of the document; None without text."""
    lines = {" ".join(line.split()) for line in document.split("\n")}
    whole = " ".join(document.split())
    score = [0] * len(tree.parent)
    seen = [False] * len(tree.parent)
    for i in range(len(tree.parent) - 1, -1, -1):
        if tree.text[i] is not None:
            text = tree.text[i]
            score[i] = len(text) if text in lines or len(text) > 20 and whole.startswith(text) else -len(text)
            seen[i] = True
        if i and seen[i]:
            score[tree.parent[i]] += score[i]
            seen[tree.parent[i]] = True
    return [score[i] > 0 if seen[i] else None for i in range(len(score))]


def furnished(page: str, document: str, seed: int) -> str:
    """The page with more furniture, its texts made of the document's words in another order.

    The article's paragraphs are put into other elements. Elements and names come in turn, a third of the names behind another word. Rarely, names of furniture are among
    those of the article, as they are in categories and formats.
    """
    pick = Random(seed)
    words = document.split()[:400] or ["word"]

    def text(n: int) -> str:
        return html.escape(" ".join(pick.choice(words) for _ in range(n)) + pick.choice(["", ".", "!"]))

    def inside() -> str:
        links = "".join(f"<li><a href=/{i}>{text(pick.randint(1, 4))}</a></li>" for i in range(pick.randint(2, 6)))
        paragraphs = "".join(f"<p>{text(pick.randint(4, 40))}</p>" for _ in range(pick.randint(1, 4)))
        boxed = f"<div><p>{text(12)}</p></div><section><div>{text(9)}</div></section>"
        quoted = f"<blockquote><p>{text(8)}</p></blockquote><pre>{text(5)}</pre><figure><figcaption>{text(4)}</figcaption></figure>"
        table = f"<table><tr><td>{text(2)}</td><td>{text(3)}</td></tr></table><ol><li>{text(6)}</li></ol>"
        fields = f"<label>{text(1)}</label><input name=q><button>{text(1)}</button><select><option>{text(1)}</select>"
        heading = pick.choice(["", f"<h1>{text(3)}</h1>", f"<h2>{text(3)}</h2>", f"<h3>{text(2)}</h3>"])
        return heading + pick.choice([f"<ul>{links}</ul>", paragraphs, boxed, quoted, table, paragraphs + fields, text(8)])

    def piece(n: int) -> str:
        if n % 3 == 0:
            tag = ELEMENTS[n // 3 % len(ELEMENTS)]
            return f"<{tag}>{inside()}</{tag}>"
        name = FURNITURE[n % len(FURNITURE)]
        before = pick.choice(CONTENT) if pick.random() < 0.2 else pick.choice(["category", "format", "tag", "has"])
        name = name if pick.random() < 0.67 else f"{before}-{name}"
        tag = pick.choice(["div", "section", "div", "ul"])
        content = inside()
        return f"<{tag} {pick.choice(['class', 'id'])}={name}>" + (f"<li>{content}</li>" if tag == "ul" else content) + f"</{tag}>"

    pieces = [piece(seed + 7 * i) for i in range(9)]
    names = pick.sample(CONTENT, pick.randint(0, 2)) + pick.choices(["category", "format", "tag", "has"], k=1)
    if pick.random() < 0.02:
        names.append("tag-" + pick.choice(FURNITURE))
    opened = f'<main class="{names[0]}"><article class="{" ".join(names)}">'
    # into the article behind its first paragraphs, around it at both ends
    head, found, tail = page.partition("<article>")
    if found:
        # paragraphs of the article stand in other elements as well
        tail = _PARAGRAPH.sub(lambda m: pick.choice(SETTINGS) % m[1] if pick.random() < 0.7 else m[0], tail)
        cut = tail.find("</p>") + 4 if "</p>" in tail else 0
        tail = tail[:cut] + pieces[0] + pieces[1] + tail[cut:]
        page = head + opened + tail.replace("</article>", "</article></main>", 1)
    start = page.find("<body>") + 6 if "<body>" in page else 0
    end = page.rfind("</body>") if "</body>" in page else len(page)
    return page[:start] + "".join(pieces[2:5]) + page[start:end] + "".join(pieces[5:]) + page[end:]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches (html, text) -> (cue, label, n)."""
    for batch in batches:
        counts: Counter = Counter()
        for page, document in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page, document = page or "", document or ""
            for version in (page, furnished(page, document, zlib.crc32(page.encode("utf-8", "replace")))):
                tree = parse(version)
                labels = labelled(tree, document)
                for i, label in enumerate(labels):
                    if label is not None:
                        counts.update((cue, label) for cue in tree.cues[i])
                        counts["nodes", label] += 1
                        if i and labels[tree.parent[i]]:
                            counts["below " + tree.cues[tree.parent[i]][0], label] += 1
        rows = [(cue, label, n) for (cue, label), n in counts.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.bool_(), pa.int64()))], ["cue", "label", "n"]
        )


def model_of(counts: dict[tuple[str, bool], int]) -> Model:
    """Potentials from counts of (cue, label)."""
    seen = Counter(counts)
    total = {label: seen["nodes", label] + 100 for label in (True, False)}
    odds, decisive = {}, {}
    for cue in {cue for cue, _ in seen if ":" in cue and " " not in cue}:
        x = math.log((seen[cue, True] + 1) / total[True]) - math.log((seen[cue, False] + 1) / total[False])
        if cue.startswith(("tag:", "name:")) and abs(x) >= DECISIVE:
            decisive[cue] = x
        else:
            odds[cue] = max(-AGAINST, min(FOR, x))
    # the children of a page's body are of all kinds, so other tags do not learn from it
    tags = {cue.split(" ", 1)[1] for cue, _ in seen if cue.startswith("below ")}
    usual = [t for t in tags if t not in ("tag:body", "tag:html", "tag:root")]
    lost, held = (sum(seen[f"below {t}", label] for t in usual) for label in (False, True))
    rate = min(0.1, (lost + 1) / (lost + held + 100))
    leaves = {"": max(1e-4, rate)}
    for tag in tags:
        lost, held = seen[f"below {tag}", False], seen[f"below {tag}", True]
        leaves[tag] = min(0.9, max(1e-4, (lost + PRIOR_COUNT * rate) / (lost + held + PRIOR_COUNT)))
    return Model(odds, decisive, math.log(total[True] / total[False]), leaves)


def learn(pairs: DataFrame) -> Model:
    """From labelled pages: ``pairs`` (html, text), the text being that of the page's document."""
    rows = pairs.select("html", "text").mapInArrow(_counted, "cue string, label boolean, n bigint")
    # a cue seen less often than once in LEAST_SEEN nodes says nothing, which bounds what comes to the driver
    summed = settled(rows.groupBy("cue", "label").agg(F.sum("n").alias("n")))
    nodes = summed.where("cue = 'nodes'").agg(F.sum("n")).first()[0] or 0
    often = summed.where(F.col("n") * LEAST_SEEN >= nodes)
    return model_of({(r.cue, r.label): r.n for r in often.collect()})


def pairs(pages: DataFrame, docs: DataFrame, number, sample: int = SAMPLE) -> DataFrame:
    """(html, text) of at most ``sample`` pages and their documents; ``number`` gives a page's doc_id."""
    wanted = (
        pages.select("page_id", number.alias("doc_id"))
        .where("page_id IS NOT NULL AND doc_id IS NOT NULL")
        .orderBy(F.xxhash64("page_id"), "page_id")
        .limit(sample)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")  # at most ``sample`` rows
    return pages.select("page_id", "html").join(F.broadcast(wanted.select("page_id")), "page_id", "left_semi").join(texts, "page_id")


def extract(pages: DataFrame, model: Model, column: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of every page as column ``name`` in place of the markup."""
    kept = pages.drop(name) if name != column else pages
    schema = StructType([*(f for f in kept.schema.fields if f.name != column), StructField(name, StringType())])
    at, arrow = kept.columns.index(column), to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([model.extract(page.as_py() or "") for page in batch.column(at)], pa.string())
            others = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*others, texts], schema=arrow)

    return kept.mapInArrow(run, schema)
