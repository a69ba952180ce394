"""Problem 2: markup left in texts (HTML, Markdown, wiki, LaTeX).

Each text is parsed into one tree whose inner nodes are markup of any of the four languages and whose
leaves are text. `p2_found` lists the languages of a tree's nodes; `clean` prints the tree as plain text
in which headings ("# "), list items ("- "), table rows (" | "), code (indented) and formulas (⟦ ⟧) differ.
Wrapper induction: the trees of one host are aligned with that host's reference tree by simple tree
matching; nodes whose text stays the same over the host's pages are template, the others are content.

Odd input: null and blank texts have no markup and are returned as they are; very long texts are parsed
whole (linear patterns); repeated rows give the same result; extra columns are kept by `cleaned`.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MEMO, explode_masks, flag_masks
from .unicode_forms import Tables

KINDS = ["html", "markdown", "wiki", "latex"]
# Element and command names of the languages.
TAGS = "a abbr b big blockquote body br caption center cite code col colgroup dd del div dl dt em font footer h1 h2 h3 h4 h5 h6 head header hr html i img input ins kbd label li link main meta nav ol option p pre q s samp script section select small span strike strong style sub sup svg table tbody td textarea tfoot th thead title tr tt u ul var"
ENTITIES = "nbsp amp lt gt quot apos mdash ndash hellip laquo raquo ordf ordm deg middot bull copy reg euro sect para times aacute eacute iacute oacute uacute agrave acirc ecirc ocirc atilde otilde ccedil Aacute Eacute Iacute Oacute Uacute Atilde Otilde Ccedil"
COMMANDS = "section subsection subsubsection paragraph chapter textbf textit texttt textsc text emph underline small footnotesize large Large tiny normalsize noindent footnote item hline cline frac sqrt times approx le leq ge geq neq rightarrow leftarrow Rightarrow to sum prod int cdot pm quad qquad hspace vspace label ref cite caption centering bf it tt rm sf newline linebreak newpage pagebreak maketitle title author date par multicolumn multirow toprule midrule bottomrule left right infty alpha beta gamma delta Delta sigma mu pi mathrm mathbf displaystyle bigskip medskip smallskip"

_tags = "|".join(sorted(TAGS.split(), key=len, reverse=True))
_ents = "|".join(ENTITIES.split())
_cmds = "|".join(sorted(COMMANDS.split(), key=len, reverse=True))
TOKEN = re.compile(
    r"(?P<h_comment><!--.*?(?:-->|\Z))"
    rf"|(?P<h_tag><(?P<close>/?)(?P<tag>(?i:{_tags}))\b(?:\s[^<>]*)?/?>)"
    rf"|(?P<h_ent>&(?:#\d{{2,6}}|#[xX][0-9a-fA-F]{{2,5}}|{_ents});)"
    r"|(?P<m_fence>^[ \t]*```[\w+-]*[ \t]*$)"
    r"|(?P<w_open>^\{\|[^\n]*$)|(?P<w_end>^\|\}[ \t]*$)|(?P<w_row>^\|-[^\n|]*$)"
    r"|(?P<w_head>^={2,6}[ \t]*[^=\s][^=]*+={2,6}[ \t]*$)"
    r"|(?P<w_link>\[\[[^\[\]]++\]\])|(?P<w_tpl>\{\{[^{}]++\}\})"
    r"|(?P<w_bold>'''(?=[^'])(?:[^']|'(?!''))+?''')|(?P<w_ital>(?<!')''(?=[^'\s])(?:[^'\n]|'(?!'))+?''(?!'))"
    r"|(?P<l_disp>\$\$.+?\$\$|\\\[.+?\\\]|\\\(.+?\\\))"
    r"|(?P<l_math>(?<![\w\\$R])\$(?=[^\s$])(?:(?=[^$\n]*[\\^_{}])[^$\n]++|[A-Za-z]\w*+)(?<!\s)\$(?![\w$]))"
    r"|(?P<l_env>\\(?:begin|end)\{(?P<env>\w+)\*?\}(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})?)"
    rf"|(?P<l_cmd>(?<!:)\\(?:(?:{_cmds})(?![A-Za-z])|[A-Za-z]{{2,20}}(?=\{{))\*?)"
    r"|(?P<l_esc>\\[%$&_{}])|(?P<l_brk>\\\\(?=\s|\Z|\[))"
    r"|(?P<m_img>!?\[(?:[^\[\]\n]|!\[[^\[\]\n]*+\]\([^()\s]++\))*+\]\([^()\s]++\)|!?\[[^\[\]]++\]\(#[^()\s]++\))"
    r"|(?P<m_code>`[^`\n]++`)"
    r"|(?P<m_bold>\*\*(?=[^\s*])(?:[^*]|\*(?!\*))++(?<=\S)\*\*)|(?P<m_strike>~~(?=\S)[^~]++(?<=\S)~~)|(?P<m_under>(?<!\w)__(?=[^\s_])[^_\n]++__(?!\w))"
    r"|(?P<m_head>^#{1,6}[ \t]+(?=\S))"
    r"|(?P<m_rule>^[ \t]*\|?[ \t]*:?-{2,}:?(?:[ \t]*\|[ \t]*:?-{2,}:?)+[ \t]*\|?[ \t]*$|^[ \t]*-{3,}(?:[ \t]+-{3,})+[ \t]*$|^[ \t]*\|[ \t]*:?-{2,}:?[ \t]*\|[ \t]*$)"
    r"|(?P<m_row>^[ \t]*\|(?![|}-])[^\n]*\|[ \t]*$)"
    r"|(?P<m_set>(?<=\S\n)={3,}[ \t]*$)"
    r"|(?P<m_quote>^>[ \t]+(?=\S))|(?P<m_task>^[ \t]*[-*+][ \t]+\[[ xX]\][ \t])",
    re.M | re.S,
)
MAYBE = re.compile(r"[<`~\\\[{]|\*\*|__|''|&[#a-zA-Z]|\$.*\$|^={2,}|^#|^>|---|^\s*\||\|\s*$|^\{", re.M | re.S)
BLOCK = {"p", "div", "tr", "table", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6", "br", "pre", "blockquote", "thead", "tbody", "dl", "dt", "dd"}
VOID = {"br", "hr", "img", "input", "meta", "link", "col"}
INVISIBLE = None


class Node:
    __slots__ = ("kind", "tag", "kids", "text")

    def __init__(self, kind: str, tag: str, text: str | None = None):
        self.kind, self.tag, self.text, self.kids = kind, tag, text, []

    def walk(self) -> Iterator["Node"]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed(n.kids))


def plain_signs(text: str) -> str:
    """Without invisible characters and full-width signs, which would hide markup."""
    if text.isascii():
        return text
    global INVISIBLE
    if INVISIBLE is None:
        t = Tables.get()
        INVISIBLE = {c: None for c in range(0x2100) if t.width[c] == 0} | {0xFEFF: None} | {c: int(t.to[c]) for c in range(0xFF01, 0xFF5F)} | {0x3000: 32, 0xA0: 32}
    return text.translate(INVISIBLE)


def parse(text: str) -> Node:
    """The tree of a text. Unclosed and stray elements are kept as nodes."""
    root = Node("", "root")
    stack, at = [root], 0
    wiki_list = "[[" in text or "{|" in text

    def leaf(s: str) -> None:
        if s:
            stack[-1].kids.append(Node("", "text", s))

    def put(kind: str, tag: str, inner: str | None = None, nested: bool = False) -> Node:
        n = Node(kind, tag)
        if inner is not None:
            n.kids = parse(inner).kids if nested and MAYBE.search(inner) else [Node("", "text", inner)]
        stack[-1].kids.append(n)
        return n

    text = plain_signs(text)
    for m in TOKEN.finditer(text):
        if m.start() < at:
            continue
        what, s = m.lastgroup, m.group()
        what = next(k for k, v in m.groupdict().items() if v is not None and k not in ("close", "tag", "env")) if what in ("close", "tag", "env") else what
        end = m.end()
        if what == "m_head":
            end_line = text.find("\n", end)
            end_line = len(text) if end_line < 0 else end_line
            body = text[end:end_line]
            leaf(text[at : m.start()])
            if s.rstrip() == "#" and wiki_list and re.match(r"[\d.,%\s]+$", body):
                put("wiki", "li", body)
            else:
                put("markdown", "h", body, True)
            at = end_line
            continue
        leaf(text[at : m.start()])
        at = end
        if what == "h_tag":
            tag = m.group("tag").lower()
            if m.group("close"):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag and stack[i].kind == "html":
                        del stack[i:]
                        break
                else:
                    put("html", "/" + tag)
            elif tag in VOID or s.endswith("/>"):
                put("html", tag)
            else:
                if tag in ("li", "tr", "td", "th", "p"):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag == tag or tag == "tr" and stack[i].tag in ("td", "th"):
                            del stack[i:]
                            break
                        if stack[i].tag in ("ul", "ol", "table"):
                            break
                stack.append(put("html", tag))
        elif what == "h_comment":
            put("html", "comment")
        elif what == "h_ent":
            put("html", "ent", html.unescape(s).replace("\xa0", " "))
        elif what == "m_fence":
            close = re.compile(r"^[ \t]*```[ \t]*$", re.M).search(text, end)
            put("markdown", "pre", text[end : close.start() if close else len(text)].strip("\n"))
            at = close.end() if close else len(text)
        elif what in ("w_open", "w_end", "w_row"):
            put("wiki", {"w_open": "table", "w_end": "/table", "w_row": "tr"}[what])
        elif what == "w_head":
            put("wiki", "h", s.strip().strip("=").strip(), True)
        elif what == "w_link":
            inner = s[2:-2].rpartition("|")[2]
            put("wiki", "link", "" if inner.startswith("Categoria:") else inner, True)
        elif what == "w_tpl":
            put("wiki", "tpl", s[2:-2].rpartition("|")[2], True)
        elif what in ("w_bold", "w_ital"):
            put("wiki", "b", s.strip("'"), True)
        elif what in ("l_disp", "l_math"):
            put("latex", "math", re.sub(r"^(\$\$?|\\[\[(])|(\$\$?|\\[\])])$", "", s).strip())
        elif what == "l_env":
            put("latex", s[1:4] + " " + m.group("env"))
        elif what == "l_cmd":
            put("latex", s.lstrip("\\").rstrip("*"))
        elif what == "l_esc":
            put("latex", "esc", s[1:])
        elif what == "l_brk":
            put("latex", "br")
        elif what == "m_img":
            put("markdown", "link", re.sub(r"^!?\[|\]\([^()]*\)$", "", s), True)
        elif what == "m_code":
            put("markdown", "code", s[1:-1])
        elif what in ("m_bold", "m_strike", "m_under"):
            put("markdown", "b", s[2:-2], True)
        elif what == "m_rule":
            put("markdown", "rule")
        elif what == "m_row":
            row = put("markdown", "tr")
            for cell in s.strip().strip("|").split("|"):
                td = Node("markdown", "td")
                td.kids = parse(cell.strip()).kids
                row.kids.append(td)
        elif what == "m_set":
            put("markdown", "setext")
        elif what == "m_quote":
            put("markdown", "quote")
        elif what == "m_task":
            put("markdown", "li")
    leaf(text[at:])
    return root


def kinds_of(text: str | None) -> int:
    """Bits of KINDS that the tree of a text has."""
    if not text:
        return 0
    flat = plain_signs(text)
    if not MAYBE.search(flat) or not TOKEN.search(flat):
        return 0
    out = 0
    for n in parse(flat).walk():
        if n.kind:
            out |= 1 << KINDS.index(n.kind)
    return out


def render(node: Node) -> str:
    out: list[str] = []

    def line() -> None:
        if out and not out[-1].endswith("\n"):
            out.append("\n")

    def go(n: Node, code: bool = False) -> None:
        if n.tag == "text":
            s = n.text or ""
            if any_latex:
                s = re.sub(r"(?<!\\)[{}]", "", s).replace("~", " ")
                if "tabular" in envs:
                    s = re.sub(r"\s*(?<!\\)&\s*", " | ", s)
            if wiki_table:
                s = re.sub(r"(?m)^\|(?![}|-])\s*", "", s).replace("||", " | ")
            if any_wiki:
                s = re.sub(r"(?m)^[*#;]+\s*", "- ", s)
                s = re.sub(r"(?m)^:+\s*", "  ", s)
            out.append(s)
        elif n.tag in ("h", "h1", "h2", "h3", "h4", "h5", "h6", "section", "subsection", "subsubsection", "chapter", "paragraph"):
            line()
            out.append("# ")
            for k in n.kids:
                go(k)
            if n.kids:
                out.append("\n")
        elif n.tag == "li" or n.tag == "item":
            line()
            out.append("- ")
            for k in n.kids:
                go(k)
        elif n.tag == "tr":
            line()
            cells = [k for k in n.kids if k.tag in ("td", "th")]
            if cells:
                out.append(" | ".join(flat(k) for k in cells) + "\n")
            else:
                for k in n.kids:
                    go(k)
        elif n.tag == "pre":
            line()
            out.append("".join("    " + x + "\n" for x in flat(n).split("\n")))
        elif n.tag == "math":
            out.append("⟦" + flat(n) + "⟧")
        elif n.tag in ("code",) and n.kind == "markdown":
            out.append("‹" + flat(n) + "›")
        elif n.tag in ("comment", "rule", "setext", "quote", "table", "/table") and not n.kids:
            pass
        elif n.tag in ("frac", "sqrt", "sum", "times", "le", "approx"):
            out.append(n.tag + " ")
        elif n.kind == "latex":
            if n.tag == "br" or n.tag[:3] in ("beg", "end"):
                line()
            for k in n.kids:
                go(k)
        else:
            if n.tag in BLOCK:
                line()
            for k in n.kids:
                go(k)
            if n.tag in BLOCK and n.kids:
                line()

    def flat(n: Node) -> str:
        return "".join(x.text or "" for x in n.walk() if x.tag == "text").strip("\n")

    nodes = list(node.walk())
    any_latex = any(n.kind == "latex" for n in nodes)
    any_wiki = any(n.kind == "wiki" for n in nodes)
    wiki_table = any(n.kind == "wiki" and n.tag == "table" for n in nodes)
    envs = {n.tag[4:] for n in nodes if n.kind == "latex" and n.tag[:4] in ("beg ", "end ")}
    go(node)
    text = re.sub(r"[ \t]+\n", "\n", "".join(out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def clean_text(text: str | None) -> str | None:
    """Plain text of a marked-up one; a text without markup is returned as it is."""
    return render(parse(text)) if kinds_of(text) else text


def clean_label(label: str | None) -> str | None:
    """A plain label: no markup, no outer blanks, lower case; blank becomes null."""
    if label is None:
        return None
    out = re.sub(r"^#+\s*|^[-\s]+", "", render(parse(label))).strip("⟦⟧‹› \n").lower()
    return out or None


def _map_column(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + "".join(f", `{out}` string" for out in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos: dict[str, dict] = {o: {} for o in columns}
        for b in batches:
            new = []
            for o, (src, fn) in columns.items():
                memo = memos[o]
                if len(memo) > MEMO:
                    memo.clear()
                vals = b.column(src).to_pylist()
                for v in set(vals) - memo.keys():
                    memo[v] = fn(v)
                new.append(pa.array([memo[v] for v in vals], pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *columns])

    return df.mapInArrow(run, schema)


def cleaned(df: DataFrame) -> DataFrame:
    """df with clean_text and plain_label beside text and raw_label."""
    return _map_column(df, {"clean_text": ("text", clean_text), "plain_label": ("raw_label", clean_label)})


def found(df: DataFrame, key: str = "artifact_id") -> DataFrame:
    """(artifact_id, field_name, markup_kind), of the latest delivery of every artifact."""
    masks = flag_masks(df, key, ["text", "raw_label"], lambda: lambda texts: [kinds_of(t) for t in texts], 8)
    return explode_masks(masks, ["text", "raw_label"], KINDS, 8, "markup_kind").withColumnRenamed("row_key", "artifact_id")


# ---- wrapper induction -------------------------------------------------------------------------


def flat_tree(root: Node) -> list:
    """[[depth, tag, text]...] in document order; texts squeezed."""
    out: list = []
    stack = [(root, 0)]
    while stack:
        n, d = stack.pop()
        if n.tag != "root":
            t = " ".join((n.text or "").split()) if n.tag == "text" else ""
            if n.tag != "text" or t:
                out.append([d, n.tag, t])
        stack.extend((k, d + 1) for k in reversed(n.kids))
    return out


def _nest(flat: list) -> list:
    """[index, tag, text, children, size, shape] trees of a flat tree; shape: equal for trees of equal tags."""
    root: list = [-1, "root", "", [], 1, 0]
    path = [(0, root)]
    every = [root]
    for i, (d, tag, text) in enumerate(flat):
        while path[-1][0] >= d:
            path.pop()
        n = [i, tag, text, [], 1, 0]
        path[-1][1][3].append(n)
        path.append((d, n))
        every.append(n)
    for n in reversed(every):  # children come after their parent
        n[4] = 1 + sum(k[4] for k in n[3])
        n[5] = hash((n[1], tuple(k[5] for k in n[3])))
    return root


def _twins(a: list, b: list, pairs: list) -> None:
    """The node pairs of two trees of one shape."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        pairs.append((x[0], y[0]))
        stack.extend(zip(x[3], y[3]))


def simple_tree_match(a: list, b: list) -> tuple[int, list]:
    """Size and node pairs of the largest order-keeping top-down matching of two trees.

    Trees of one shape match node by node. Otherwise the table over the two child sequences is filled; children of
    one shape at both ends are matched first, which loses nothing, so a long page costs what differs in it.
    """
    if a[1] != b[1]:
        return 0, []
    pairs: list = []
    if a[5] == b[5]:
        _twins(a, b, pairs)
        return a[4], pairs
    pairs.append((a[0], b[0]))
    x, y = a[3], b[3]
    lo, m, n = 0, len(x), len(y)
    while lo < m and lo < n and x[lo][5] == y[lo][5]:
        _twins(x[lo], y[lo], pairs)
        lo += 1
    while m > lo and n > lo and x[m - 1][5] == y[n - 1][5]:
        m, n = m - 1, n - 1
        _twins(x[m], y[n], pairs)
    x, y = x[lo:m], y[lo:n]
    if x and y:
        sub: dict = {}
        best = [[0] * (len(y) + 1)]
        for i, p in enumerate(x):
            row, up = [0], best[-1]
            for j, q in enumerate(y):
                w = 0
                if p[1] == q[1]:
                    sub[i, j] = got = simple_tree_match(p, q)
                    w = got[0]
                row.append(max(up[j + 1], row[j], up[j] + w))
            best.append(row)
        i, j = len(x), len(y)
        while i and j:
            w = sub.get((i - 1, j - 1), (0, []))
            if w[0] and best[i][j] == best[i - 1][j - 1] + w[0]:
                pairs += w[1]
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return len(pairs), pairs


#: Tasks over which the pages of a host are spread.
SALT = 32


def induce_wrappers(df: DataFrame, host: list[str], share: float = 0.6, least: int = 3) -> DataFrame:
    """(row_key, host, template, content): every marked-up page split by its host's wrapper.

    df: row_key, text and the host columns. A host is those columns and the tree's tag outline; its
    reference page is the one with the smallest key. Pages meet the reference under (host, salt), so that a host with a
    third of all pages is spread over SALT tasks; only (host, node, equal, matched) counts are grouped, with partial
    aggregation. A node is template where at least `share` of at least `least` aligned pages have the reference's
    text there. Trees are aligned whole, whatever their size.
    """
    tree_type = T.StructType([T.StructField("row_key", T.LongType()), T.StructField("host", T.StringType()), T.StructField("tree", T.StringType())])

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            keys, hosts, out = [], [], []
            for r in rows:
                if kinds_of(r["text"]):
                    flat = flat_tree(parse(r["text"]))
                    outline = ">".join(dict.fromkeys(x[1] for x in flat if x[1] != "text"))
                    keys.append(r["row_key"])
                    hosts.append("|".join(str(r[h]) for h in host) + "|" + hashlib.sha1(outline.encode()).hexdigest())
                    out.append(json.dumps(flat, ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(hosts, pa.string()), pa.array(out, pa.string())], names=["row_key", "host", "tree"])

    pages = df.select("row_key", "text", *host).filter("text is not null").mapInArrow(trees, tree_type)
    ref = pages.groupBy("host").agg(F.min(F.struct("row_key", "tree"))["tree"].alias("ref"))
    spread = ref.select("host", "ref", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    pages = pages.withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(SALT)).cast("int"))
    both = pages.join(spread, ["host", "salt"]).drop("salt")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, nodes, same = [], [], []
            trees: dict[str, tuple] = {}
            for i, (tree, ref) in enumerate(zip(b.column("tree").to_pylist(), b.column("ref").to_pylist())):
                a, r, pairs = _aligned(tree, ref, trees)
                for x, y in pairs:
                    if x >= 0 and a[x][1] == "text":
                        at.append(i)
                        nodes.append(y)
                        same.append(int(a[x][2] == r[y][2]))
            yield pa.RecordBatch.from_arrays([b.column("host").take(pa.array(at, pa.int64())), pa.array(nodes, pa.int32()), pa.array(same, pa.int32())], names=["host", "node", "same"])

    votes = both.select("host", "tree", "ref").mapInArrow(align, "host string, node int, same int").groupBy("host", "node").agg(F.sum("same").alias("same"), F.count("*").alias("n"))
    wrap = votes.groupBy("host").agg(F.collect_set(F.when((F.col("same") >= share * F.col("n")) & (F.col("n") >= least), F.col("node"))).alias("fixed"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            template, content = [], []
            trees: dict[str, tuple] = {}
            for tree, ref, fixed in zip(b.column("tree").to_pylist(), b.column("ref").to_pylist(), b.column("fixed").to_pylist()):
                a, r, pairs = _aligned(tree, ref, trees)
                fix = set(fixed or [])
                stay = {x for x, y in pairs if y in fix and x >= 0 and a[x][2] == r[y][2]}
                texts = [(x, n[2]) for x, n in enumerate(a) if n[1] == "text"]
                template.append("\n".join(t for x, t in texts if x in stay))
                content.append("\n".join(t for x, t in texts if x not in stay))
            yield pa.RecordBatch.from_arrays([b.column("row_key"), b.column("host"), pa.array(template, pa.string()), pa.array(content, pa.string())], names=["row_key", "host", "template", "content"])

    done = both.join(wrap, "host", "left").select("row_key", "host", "tree", "ref", "fixed")
    return done.mapInArrow(split, "row_key long, host string, template string, content string")


def _aligned(tree: str, ref: str, known: dict[str, tuple]) -> tuple[list, list, list]:
    a = json.loads(tree)
    if ref not in known:
        r = json.loads(ref)
        known[ref] = (r, _nest(r))
    r, nested = known[ref]
    return a, r, simple_tree_match(_nest(a), nested)[1]
