"""Problem 7: remains of HTML, Markdown, wiki and LaTeX markup.

Everything that may be markup is a node, and so is every line of text. A classifier's costs (how much a piece looks like
markup, by how much more often texts with markup have its type than texts without; how much a line looks like boilerplate)
are the capacities to the two terminals; edges between the two halves of a
pair, between neighbours of one kind, and between lines that are near in the text and under the same element, are as wide
as they belong together. The minimum cut labels each piece as markup or ordinary signs and each line as content or
boilerplate. Markup is then rendered to plain text that keeps headings ("# "), lists ("- "), code (fenced) and formulas ($).

Defined results: null or blank text gives no row; text without markup comes out unchanged; placeholders, sound annotations,
speaker labels, numbering, prices and file names are not markup; broken halves of a pair count by their own look.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Callable
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transquill.llm.residue import holes
from transquill.llm.rows import has_text, map_batches, map_rows

# Element names, and the classifier's log odds that a piece of a type is markup.
ELEMENTS = frozenset("a abbr address article aside audio b base blockquote body br button canvas caption center cite code col dd del details div dl dt em embed fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav noscript object ol option p param picture pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section summary table tbody tfoot thead title tr ul".split())
ODDS = {
    "tag": 6.0, "odd_tag": -3.0, "comment": 6.0, "entity": 6.0,
    "fence": 6.0, "code": 3.0, "heading": 3.0, "setext": 4.0, "strong": 5.0, "strong_": 3.0, "strike": 5.0, "emph": 1.5, "link": 6.0, "image": 6.0, "bullet": 0.6, "dash": 0.6, "number": -1.0, "quote": 2.0, "row": 2.5, "rule_row": 6.0, "hr": 1.0,
    "title": 6.0, "bold": 6.0, "italic": 4.0, "page": 5.0, "template": 6.0, "table": 6.0, "cells": 3.0, "site": 6.0, "item": 0.4, "magic": 6.0,
    "env": 6.0, "command": 5.0, "bare": 2.0, "path": -4.0, "display": 5.0, "math": 4.0, "item_tex": 4.0, "ref": 5.0,
}
#: Types that Markdown and wikis share.
EITHER = ("bullet", "number", "heading")
#: Texts that the stated odds are worth when they are fitted.
PRIOR_TEXTS = 20
PAIR, NEAR, FAR, LINE, LINKS = 3.0, 1.0, 0.3, 0.7, 3.5
# End of fixed values.

TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)((?:\s[^<>]*)?)(/?)>")
# (type, kind, pattern)
GRAMMAR: list[tuple[str, str, re.Pattern]] = [
    (t, k, re.compile(p, re.MULTILINE | (re.DOTALL if t in ("comment", "fence", "display") else 0)))
    for t, k, p in [
        ("comment", "html", r"<!--.*?-->|<!DOCTYPE[^>]*>"),
        ("tag", "html", TAG.pattern),
        ("entity", "html", r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"),
        ("fence", "markdown", r"^(?:```|~~~)[^\n`]*\n.*?(?:^(?:```|~~~)[ \t]*$|\Z)"),
        ("image", "markdown", r"!\[[^\[\]\n]*\]\([^()\s]+(?:\s\"[^\"\n]*\")?\)"),
        ("link", "markdown", r"(?<!!)\[[^\[\]\n]+\]\((?:https?:|/|#|\.|mailto:|www\.)[^()\s]*(?:\s\"[^\"\n]*\")?\)"),
        ("code", "markdown", r"(?<![A-Za-z0-9\u00c0-\u024f`\u0192\\])`(?=[^\s`])[^`\n\u0080-\u009f]*(?<=[^\s])`(?![A-Za-z0-9\u00c0-\u024f`])"),
        ("rule_row", "markdown", r"^\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$|^\|[ \t]*:?-{3,}:?[ \t]*\|[ \t]*$"),
        ("row", "markdown", r"^\|(?![-}|+])[^\n]*\|[ \t]*$"),
        ("heading", "markdown", r"^#{1,6}[ \t]+(?=[^\s#])"),
        ("setext", "markdown", r"(?<=\n)(?:={3,}|-{3,})[ \t]*$"),
        ("strong", "markdown", r"\*\*(?=[^\s*])[^*\n]+(?<=[^\s*])\*\*"),
        ("strong_", "markdown", r"(?<![A-Za-z0-9_])__(?=[^\s_])[^_\n]+(?<=[^\s_])__(?![A-Za-z0-9_])"),
        ("strike", "markdown", r"~~(?=\S)[^~\n]+(?<=\S)~~"),
        ("emph", "markdown", r"(?<![\w*\\])\*(?=[^\s*\d])[^*\n]+(?<=[^\s*])\*(?![\w*])|(?<![A-Za-z0-9_\\/.])_(?=[^\s_])[^_\n/\\\u0080-\u009f\u0192\u201a]+(?<=[^\s_])_(?![A-Za-z0-9_/.])"),
        ("quote", "markdown", r"^>[ \t](?=[^\s>])"),
        ("dash", "markdown", r"^[ \t]{0,3}[-+][ \t]+(?=[^\s-])"),
        ("bullet", "markdown", r"^[ \t]{0,3}\*[ \t]+(?=[^\s*])"),
        ("number", "markdown", r"^\d{1,3}[.)][ \t]+(?=\S)"),
        ("hr", "markdown", r"^(?:\*{3,}|_{3,}|(?:- ){2,}-)[ \t]*$"),
        ("title", "wiki", r"^(={2,6})[ \t]*[^=\n][^\n]*?[ \t]*\1[ \t]*$"),
        ("bold", "wiki", r"'''(?=[^'\s])[^'\n]+(?:'[^'\n]+)*'''"),
        ("italic", "wiki", r"(?<!')''(?=[^'\s])[^'\n]+''(?!')"),
        ("page", "wiki", r"\[\[[^\[\]\n]+\]\]"),
        ("template", "wiki", r"\{\{[^{}\n|]{1,60}(?:\|[^{}]*)\}\}|^\{\{[A-Z][^{}\n]{1,60}\}\}[ \t]*$"),
        ("table", "wiki", r"^\{\|[^\n]*$|^\|\}[ \t]*$|^\|[-+][^\n]*$"),
        ("cells", "wiki", r"^!(?!\[)[^\n]*?(?:!!|\|\|)[^\n]*$|^\|(?![-+}|])[^\n|]*\|\|[^\n]*$|^[!|][ \t][^\n|]*$"),
        ("site", "wiki", r"(?<!\[)\[https?://[^\s\]]+(?:[ ][^\]\n]*)?\](?!\()"),
        ("magic", "wiki", r"__(?:TOC|NOTOC|NOEDITSECTION|FORCETOC)__"),
        ("display", "latex", r"\$\$(?=[^$]*[\\^_={}])[^$]+\$\$|\\\[(?:(?!\\\[).)+?\\\]|\\\((?:(?!\\\().)+?\\\)|\\begin\{(?:equation|align|gather|math|displaymath)\*?\}(?:(?!\\begin\{(?:equation|align|gather|math|displaymath)).)+?\\end\{(?:equation|align|gather|math|displaymath)\*?\}"),
        ("math", "latex", r"(?<![\\$\w])\$(?=[^$\n]*(?:\\[A-Za-z]|[\^_]\{?[A-Za-z0-9]))[^$\n]+\$(?![\w$])"),
        ("env", "latex", r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?"),
        ("ref", "latex", r"~?\\(?:cite[a-z]*|ref|eqref|pageref|label|footnotemark|url)\{[^{}\n]*\}"),
        ("command", "latex", r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}"),
        ("item_tex", "latex", r"\\item\b(?:\[[^\]\n]*\])?[ \t]*"),
        ("bare", "latex", r"(?<![A-Za-z]:)(?<![\w\\])\\(?:[A-Za-z]{2,20})(?![A-Za-z\\{])|(?<=\S)[ \t]*\\\\[ \t]*$"),
    ]
]
HINTS = re.compile(r"</?[A-Za-z!]|&#?\w{1,31};|[`*~|\\]|__|(?<![A-Za-z0-9])_\S|''|\[\[|\{[{|]|\]\(|\[https?:|\$\$|\$[^$\n]*[\\^_]|^(?:#{1,6}[ \t]|>[ \t]|[ \t]{0,3}[-+][ \t]|-{3,}|={2,}|!)", re.MULTILINE)


#: What a text must hold for a grammar to be tried.
OPENED_BY = {
    "comment": ("<!",), "tag": ("<",), "entity": ("&",), "fence": ("```", "~~~"), "image": ("![",), "link": ("](",), "code": ("`",), "rule_row": ("---",), "row": ("|",), "heading": ("# ", "#\t"), "setext": ("===", "---"), "strong": ("**",), "strong_": ("__",), "strike": ("~~",),
    "emph": ("*", "_"), "quote": ("> ", ">\t"), "dash": ("- ", "+ ", "-\t", "+\t"), "bullet": ("* ", "*\t"), "number": (". ", ") ", ".\t", ")\t"), "hr": ("***", "___", "- -"), "title": ("==",), "bold": ("'''",), "italic": ("''",), "page": ("[[",), "template": ("{{",), "table": ("{|", "|}", "|-", "|+"),
    "cells": ("!", "|"), "site": ("[http",), "magic": ("__",), "display": ("$$", "\\[", "\\(", "\\begin"), "math": ("$",), "env": ("\\begin", "\\end"), "ref": ("\\",), "command": ("\\",), "item_tex": ("\\item",), "bare": ("\\",),
}
#: One of these stands in whatever the grammars match.
PARTS = ("<", "&", "`", "*", "_", "~", "|", "\\", "[", "{", "$", "''", "#", "==", "--", "- ", "-\t", "+ ", "+\t", "\n>", "\n!")


def hinted(text: str) -> bool:
    """Whether there may be markup; cheap."""
    return (any(p in text for p in PARTS) or text[:1] in ">!") and bool(HINTS.search(text))


@dataclass
class Piece:
    type: str
    kind: str
    start: int
    end: int
    odds: float
    pair: int = -1
    markup: bool = True


def min_cut(costs: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """costs: for each node what it costs to be content, and to be markup. True: markup. Ties are content."""
    n = len(costs)
    near: list[list[int]] = [[] for _ in range(n)]
    for a, b, _ in edges:
        near[a].append(b)
        near[b].append(a)
    out: list[bool | None] = [None] * n
    for root in range(n):
        if out[root] is not None:
            continue
        part, todo = [], [root]
        out[root] = False
        while todo:
            v = todo.pop()
            part.append(v)
            for w in near[v]:
                if out[w] is None:
                    out[w] = False
                    todo.append(w)
        signs = {costs[v][0] > costs[v][1] for v in part}
        if len(signs) == 1:  # nothing to cut
            for v in part:
                out[v] = next(iter(signs))
        else:
            for v, x in zip(part, _cut(part, costs, edges)):
                out[v] = x
    return [bool(x) for x in out]


def _cut(part: list[int], costs: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Dinic's maximum flow from markup to content; what is still reached from the source is markup."""
    at = {v: i for i, v in enumerate(part)}
    s, t = len(part), len(part) + 1
    graph: list[list[int]] = [[] for _ in range(t + 1)]
    to: list[int] = []
    cap: list[float] = []

    def add(a: int, b: int, x: float, back: float) -> None:
        for u, v, c in ((a, b, x), (b, a, back)):
            graph[u].append(len(to))
            to.append(v)
            cap.append(c)

    for v, i in at.items():
        as_content, as_markup = costs[v]
        low = min(as_content, as_markup)
        if as_content > low:
            add(s, i, as_content - low, 0.0)
        elif as_markup > low:
            add(i, t, as_markup - low, 0.0)
    for a, b, x in edges:
        if a in at:
            add(at[a], at[b], x, x)
    while True:
        level = [-1] * (t + 1)
        level[s] = 0
        todo = deque([s])
        while todo:
            u = todo.popleft()
            for e in graph[u]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    todo.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(len(part))]
        nxt = [0] * (t + 1)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if cap[e] <= 1e-9)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while nxt[u] < len(graph[u]):
                e = graph[u][nxt[u]]
                if cap[e] > 1e-9 and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(graph[u]):
                path.append(graph[u][nxt[u]])
                u = to[path[-1]]
            elif u == s:
                break
            else:
                level[u] = -1
                u = to[path.pop() ^ 1]


def candidates(text: str, odds_of: dict[str, float] = ODDS) -> list[Piece]:
    """All that may be markup, without overlaps; earlier grammars and longer pieces first."""
    taken: list[Piece] = []
    free = bytearray(len(text))
    for _, a, b in holes(text) if re.search(r"[{<%@$_*\[]", text) else ():
        free[a:b] = b"\1" * (b - a)
    for kind_type, kind, pattern in GRAMMAR:
        if not any(x in text for x in OPENED_BY[kind_type]):
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            if any(free[a:b]):
                continue
            odds = odds_of[kind_type]
            if kind_type == "tag":
                name = m[2].lower()
                if name not in ELEMENTS:
                    odds = odds_of["odd_tag"] + (4.0 if re.search(r"\w=[\"']", m[3]) else 0.0)
                if m[2].isupper() and len(m[2]) > 1 and name not in ELEMENTS:
                    continue
            elif kind_type == "entity" and m[0][1] != "#" and m[0][1:] not in html5:
                continue
            elif kind_type == "bare" and re.search(r"(?:[A-Za-z]:|\\\w+)$", text[max(0, a - 40) : a]):
                odds = odds_of["path"]
            elif kind_type == "command" and re.search(r"[A-Za-z]:$", text[max(0, a - 2) : a]):
                odds = odds_of["path"]
            taken.append(Piece(kind_type, kind, a, b, odds))
            free[a:b] = b"\1" * (b - a)
    return sorted(taken, key=lambda p: p.start)


class Reach:
    """How far the spans that begin up to a place reach; places are asked for in order."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.spans, self.at, self.far = sorted(spans), 0, -1

    def to(self, place: int) -> int:
        while self.at < len(self.spans) and self.spans[self.at][0] <= place:
            self.far = max(self.far, self.spans[self.at][1])
            self.at += 1
        return self.far


def graph(text: str, pieces: list[Piece]) -> tuple[list[tuple[int, int]], list[bool]]:
    """Labels the pieces; also the lines of text as (start, end), and whether each is boilerplate."""
    lines = [m.span() for m in re.finditer(r"[^\n]+", text)]
    costs = [(max(p.odds, 0.0), max(-p.odds, 0.0)) for p in pieces]
    edges: list[tuple[int, int, float]] = []
    opened: dict[str, list[int]] = {}
    inside: list[tuple[int, int, int]] = []
    last: dict[str, int] = {}
    for i, p in enumerate(pieces):
        if p.type == "tag" and (m := TAG.match(text, p.start)):
            name = m[2].lower()
            if m[1]:
                if opened.get(name):
                    j = opened[name].pop()
                    edges.append((j, i, PAIR))
                    inside.append((pieces[j].end, p.start, j))
            elif not m[4]:
                opened.setdefault(name, []).append(i)
        elif p.type == "env":
            name = text[p.start : p.end]
            key = "env" + name[name.index("{") :]
            if name.startswith("\\end") and opened.get(key):
                edges.append((opened[key].pop(), i, PAIR))
            elif name.startswith("\\begin"):
                opened.setdefault(key, []).append(i)
        if p.kind in last:
            j = last[p.kind]
            edges.append((j, i, NEAR if text.count("\n", pieces[j].end, p.start) <= 1 else FAR))
        last[p.kind] = i
    # a bullet may be of either kind: it goes with the kind that is there
    if any(p.kind == "wiki" and p.odds >= 3 for p in pieces) and not any(p.kind == "markdown" and p.odds >= 2.5 and p.type not in EITHER for p in pieces):
        after, right = [-1] * len(pieces), -1
        for i in range(len(pieces) - 1, -1, -1):
            after[i] = right
            right = i if pieces[i].kind == "wiki" else right
        left = -1
        for i, p in enumerate(pieces):
            if p.type in EITHER:
                p.kind = "wiki"
                near = [k for k in (left, after[i]) if k >= 0]
                if near:
                    edges.append((i, min(near, key=lambda k: abs(k - i)), NEAR))
            left = i if p.kind == "wiki" else left
    base = len(pieces)
    starts = [p.start for p in pieces]
    at = 0
    inside.sort()
    unseen = [(x, y) for x, y, i in inside if text[pieces[i].start : pieces[i].end].lower().startswith(("<script", "<style", "<nav"))]
    covered, in_unseen = Reach([(x, y) for x, y, _ in inside]), Reach(unseen)
    for k, (a, b) in enumerate(lines):
        while at < len(pieces) and pieces[at].end <= a:
            at += 1
        inner, links, j = 0, 0, at
        while j < len(pieces) and starts[j] < b:
            q = pieces[j]
            inner += min(b, q.end) - max(a, q.start)
            links += q.type in ("link", "site", "page") or q.type == "tag" and text[q.start : q.start + 2].lower() == "<a"
            j += 1
        words = len(text[a:b].split())
        odds = 6.0 if in_unseen.to(a) >= b else (LINKS if links >= 3 and inner > 0.8 * (b - a) else -2.0) - min(2.0, words / 10)
        costs.append((max(odds, 0.0), max(-odds, 0.0)))
        if k and text.count("\n", lines[k - 1][1], a) == 1:
            same = covered.to(lines[k - 1][0]) >= b
            edges.append((base + k - 1, base + k, LINE if same or not inside else LINE / 2))
    labels = min_cut(costs, edges)
    for p, markup in zip(pieces, labels):
        p.markup = markup
    return lines, labels[base:]


def rendered(text: str, p: Piece) -> str:
    """What a piece of markup leaves behind."""
    raw = text[p.start : p.end]
    if p.type == "tag":
        m = TAG.match(raw)
        name, closing = m[2].lower(), bool(m[1])
        if re.fullmatch("h[1-6]", name):
            return "\n" if closing else "\n" + "#" * int(name[1]) + " "
        if name == "li":
            return "" if closing else "\n- "
        if name == "pre":
            return "\n```\n"
        if name == "code":
            around = text[max(0, p.start - 6) : p.start].lower().endswith(("<pre>",)) or text[p.end : p.end + 6].lower() == "</pre>"
            return "" if around else "`"
        if name in ("td", "th"):
            return " | " if closing else ""
        return "\n" if name in BLOCKS or name == "br" else ""
    if p.type == "entity":
        return html.unescape(raw)
    if p.type in ("heading", "fence", "code", "number", "item"):
        return raw if p.kind == "markdown" else "- "
    if p.type in ("math", "display"):
        return raw if raw[0] == "$" else "$$" + (raw[raw.index("}") + 1 : raw.rindex("\\")] if raw.startswith("\\begin") else raw[2:-2]).strip() + "$$"
    if p.type in ("dash", "bullet", "item_tex"):
        return "- "
    if p.type in ("strong", "strong_", "strike"):
        return raw[2:-2]
    if p.type == "emph":
        return raw[1:-1]
    if p.type in ("link", "image"):
        return raw[raw.index("[") + 1 : raw.index("](")]
    if p.type == "row":
        return " | ".join(c.strip() for c in raw.strip().strip("|").split("|"))
    if p.type == "cells":
        return " | ".join(c.strip() for c in re.split(r"!!|\|\|", raw[1:]))
    if p.type == "title":
        level = len(raw) - len(raw.lstrip("="))
        return "#" * level + " " + raw.strip().strip("=").strip()
    if p.type in ("bold", "italic"):
        return raw.strip("'")
    if p.type == "page":
        return "" if re.match(r"\[\[(?:Category|Catégorie|Kategorie|Categoría|Categoria|File|Image|Fichier|Datei)\s*:", raw, re.IGNORECASE) else raw[2:-2].rsplit("|", 1)[-1]
    if p.type == "site":
        return raw[1:-1].split(" ", 1)[1] if " " in raw else ""
    if p.type == "env":
        return "$$" if re.search(r"\{(?:equation|align|gather|math|displaymath)\*?\}", raw) else ""
    if p.type == "command":
        name, inner = raw[1 : re.search(r"[^A-Za-z]", raw[1:]).start() + 1], raw[raw.index("{") + 1 : -1]
        levels = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4}
        return "#" * levels[name] + " " + inner + "\n" if name in levels else inner
    return ""


def clean(text: str, drop_code: bool = False, odds_of: dict[str, float] = ODDS) -> tuple[str, list[str]]:
    """The clean text and the kinds of markup that were in it; drop_code: without code and formulas too."""
    if not hinted(text):
        return text, []
    pieces = candidates(text, odds_of)
    if not pieces or all(p.odds <= 0 for p in pieces):
        return text, []
    lines, boilerplate = graph(text, pieces)
    kinds = sorted({p.kind for p in pieces if p.markup})
    if not kinds:
        return text, []
    marks = [p for p in pieces if p.markup]
    dead = [span for span, is_dead in zip(lines, boilerplate) if is_dead]
    starts = [a for a, _ in dead]

    def live(a: int, b: int) -> str:
        """The text from a to b without dead lines."""
        i = max(0, bisect_right(starts, a) - 1)
        parts = []
        while i < len(dead) and dead[i][0] < b:
            x, y = dead[i]
            if y > a:
                parts.append(text[a:x])
                a = max(a, min(y, b))
            i += 1
        return "".join(parts) + text[a:b]

    def is_dead(p: Piece) -> bool:
        i = bisect_right(starts, p.start) - 1
        return i >= 0 and p.end <= dead[i][1]

    out: list[str] = []
    at, skip = 0, 0
    for p in marks:
        if p.start < skip:
            at = max(at, p.end)
            continue
        out.append(live(at, p.start))
        raw = text[p.start : p.end].lower()
        if p.type == "tag" and raw.startswith(("<script", "<style")):
            end = re.compile("</" + raw[1:7].rstrip("> ")[:6], re.IGNORECASE).search(text, p.end)
            skip = end.start() if end else len(text)
            at = skip
            continue
        if p.type == "setext":
            body = "".join(out).rstrip("\n")
            head, _, line = body.rpartition("\n")
            out = [head + "\n" if head or body.startswith("\n") else "", "# " + line + "\n"]
            at = p.end
            continue
        if drop_code and p.type in ("fence", "code", "display", "math", "bare"):
            out.append(text[p.start + 1 : p.end - 1] if p.type == "code" and " " not in text[p.start : p.end] else " ")
        elif drop_code and p.type == "tag" and raw.startswith("<pre"):
            end = re.compile("</pre", re.IGNORECASE).search(text, p.end)
            skip = end.start() if end else len(text)
            at = skip
            continue
        elif not is_dead(p):
            out.append(rendered(text, p))
        at = p.end
    body = "".join(out) + live(at, len(text))
    return re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", body)).strip("\n"), kinds


def _types() -> Callable[[list[list]], list[tuple]]:
    def kernel(columns: list[list]) -> list[tuple]:
        seen: Counter = Counter()
        for t in columns[0]:
            seen.update({p.type for p in candidates(t)} if hinted(t) else ())
        return [("", len(columns[0])), *seen.items()]

    return kernel


def fit(mixed: DataFrame, plain: DataFrame, column: str = "text") -> dict[str, float]:
    """The classifier's log odds for each type of piece: how much more often texts that may hold markup have it than texts without.

    The stated odds are its prior, worth PRIOR_TEXTS texts; at most two rows for each type reach the driver.
    """
    counts: list[dict[str, int]] = []
    for corpus in (mixed, plain):
        rows = map_batches(corpus.where(has_text(column)), [column], _types, "type string, n bigint").groupBy("type").agg(F.sum("n").alias("n")).collect()
        counts.append({r["type"]: r["n"] for r in rows})
    return posterior_odds(*counts)


def posterior_odds(mixed: dict[str, int], plain: dict[str, int]) -> dict[str, float]:
    """From the texts with each type and, under '', all texts of both corpora; without texts on either side the stated odds."""
    if not mixed.get("") or not plain.get(""):
        return dict(ODDS)
    out = {}
    for kind, stated in ODDS.items():
        m, p = mixed.get(kind, 0), plain.get(kind, 0)
        ratio = math.log((m + 0.5) / (mixed[""] + 1)) - math.log((p + 0.5) / (plain[""] + 1))
        out[kind] = (PRIOR_TEXTS * stated + (m + p) * max(-6.0, min(6.0, ratio))) / (PRIOR_TEXTS + m + p)
    return out


def find_markup(texts: DataFrame, odds_of: dict[str, float] | None = None, key: str = "video_id", column: str = "text") -> DataFrame:
    """(key, kind, clean) for each kind of markup in a text; clean is the whole text without any of them. odds_of: the fitted classifier's, else the stated ones."""
    odds = odds_of or ODDS

    def start() -> Callable[..., list[tuple]]:
        def kernel(k, text):  # noqa: ANN001, ANN202
            new, kinds = clean(text, odds_of=odds)
            return [(k, kind, new) for kind in kinds]

        return kernel

    of = dict(texts.dtypes)[key]
    return map_rows(texts.where(has_text(column)), [key, column], start, f"`{key}` {of}, kind string, clean string")
