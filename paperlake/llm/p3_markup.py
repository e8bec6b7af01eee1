"""Problem 3: HTML, Markdown, wiki and LaTeX sources to clean text that keeps headings, lists, code and formulas.

A document is read once, as a stream of events: HTML by the standard library's parser, the line-based
formats by line rules. HTML is given per line its ratio of text to tags; the ratios are smoothed with a
Gaussian and split at a threshold, and lines below it without structure of their own (menus, footers) are
left out of the text. What stands in comments, scripts, styles or code blocks is not counted as structure.

Null, empty and blank sources have no elements and give null or empty text; plain text is left as it is.
Repeated ids count once.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TAG = re.compile(r"</?(?:p|li|ul|ol|h[1-6]|div|span|em|b|i|strong|sup|sub|a|pre|code|html|body|head|table|tr|td|th|math|mi|msub|mn|br|script|style|annotation|blockquote|title)(?:\s[^<>]*)?/?>|<!--", re.I)
_HTML = re.compile(r"</(?:p|li|ul|ol|h[1-6]|div|span|em|b|strong|sup|sub|a|pre|code|html|body|table|tr|td|th)\s*>|<(?:p|li|h[1-6]|div|html|body|pre|td|span|br|em|b)(?:\s[^<>]*)?/?>", re.I)
_TEX = re.compile(r"\\(?:sub)*section\*?[\[{]|\\(?:begin|end|emph|textbf|textit|texttt|cite|ref|label|footnote|documentclass|item|underline|paragraph)\b|\{\\(?:it|bf|em|tt)\b|\\\\\s*$|``[^`\n]+''|(?<=\w)~(?=[\w\\])", re.M)
_WIKI = re.compile(r"^={2,6}[^=\n].*[^=\n]={2,6}\s*$|'''?[^'\n]+'''?|\[\[[^\]\n]+\]\]|\{\{[^}\n]+\}\}|^\{\||<(?:source|syntaxhighlight|ref|nowiki)\b", re.M | re.I)
_MD = re.compile(r"^#{1,6}\s+\S|^(?:```|~~~)|^\S.*\n(?:={3,}|-{3,})\s*$|\*\*[^*\s][^*\n]*\*\*|~~[^~\s][^~\n]*~~|(?<!`)`[^`\s][^`\n]*`(?!`)|\]\([^)\s]+\)|\[\^\w+\]|(?<![\w*])[_*][^\s_*][^_*\n]*[_*](?![\w*])|^\s*\|?(?:\s*:?-{3,}:?\s*\|)+", re.M)
_LIST = re.compile(r"^\s*(?:[-*+]|\d{1,3}[.)])\s+(?=\S)(?!\d+\s*-\s*$)")
_MATH = re.compile(r"\$\$.+?\$\$|\\\[.+?\\\]|\\\(.+?\\\)|(?<![\\$\w])\$(?=[^\s$])(?:\\.|[^$\\\n])+?(?<=[^\s\\])\$(?![\d$])", re.S)
_TEXMATH = re.compile(r"\$\$.+?\$\$|\\\[.+?\\\]|\\\(.+?\\\)", re.S)  # formulas between delimiters in HTML text
_ANY = re.compile(r"[<>\\$`*#_~=\[{]|^\s*(?:[-+]|\d{1,3}[.)])\s", re.M)
ELEMENTS = ("heading", "list_item", "code", "formula")


def source_format(text: str) -> str | None:
    """'html', 'tex', 'wiki', 'md' or None for plain text."""
    if not _ANY.search(text):
        return None
    bare = re.sub(r"<!--.*?-->", "", text, flags=re.S)
    fenced = re.sub(r"^(```|~~~).*?^\1", "```", bare, flags=re.S | re.M)  # code of other languages isn't evidence
    outside = re.sub(r"<(pre|source|syntaxhighlight)\b.*?</\1>|\\begin\{(verbatim|lstlisting)\}.*?\\end\{\2\}", "", fenced, flags=re.S)
    score = {
        "html": len(_HTML.findall(outside)),
        "tex": len(_TEX.findall(outside)),
        "wiki": 2 * len(_WIKI.findall(bare)),
        "md": len(_MD.findall(fenced)),
    }
    best = max(score, key=lambda k: score[k])
    if score[best]:
        return best
    if re.search(r"<pre\b|\\begin\{(?:verbatim|lstlisting)\}", bare):
        return "html" if "<pre" in bare else "tex"
    if "<!--" in text or _MATH.search(text):
        return "md"
    lists = [x for x in text.split("\n") if _LIST.match(x) and not re.fullmatch(r"\s*-\s*\d+\s*-\s*", x)]
    return "md" if len(lists) >= 2 else None


class _Html(HTMLParser):
    """Events of an HTML source: elements, and the text of its blocks with the line where each begins."""

    SKIP = {"script", "style", "head", "noscript"}
    BLOCK = {"p", "div", "li", "ul", "ol", "table", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "body", "html", "section"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements: list[str] = []
        self.blocks: list[tuple[str, str, int]] = []
        self.buf: list[str] = []
        self.kind, self.at, self.skip, self.pre, self.math, self.annotation = "text", 1, 0, 0, 0, None

    def flush(self, kind="text"):
        text = "".join(self.buf)
        text = text.strip("\n") if self.kind == "code" else re.sub(r"\s+", " ", text).strip()
        if text:
            self.blocks.append((self.kind, text, self.at))
            if self.kind != "code" and "\\" in text or "$$" in text:
                self.elements += ["formula"] * len(_TEXMATH.findall(text))
        self.buf, self.kind, self.at = [], kind, self.getpos()[0]

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skip += tag != "head"
        elif self.skip:
            return
        elif tag == "pre":
            self.pre += 1
            if self.pre == 1:
                self.elements.append("code")
                self.flush("code")
        elif self.pre:
            return
        elif re.fullmatch(r"h[1-6]", tag):
            self.elements.append("heading")
            self.flush("heading" + tag[1])
        elif tag == "li":
            self.elements.append("list_item")
            self.flush("list_item")
        elif tag == "math":
            self.math += 1
            if self.math == 1:
                self.elements.append("formula")
                self.buf.append(" $")
        elif tag == "annotation" and self.math:
            self.annotation = len(self.buf)
        elif tag == "br":
            self.buf.append(" ")
        elif tag in ("td", "th"):
            self.buf.append("\t")
        elif tag in self.BLOCK:
            self.flush()

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - (tag != "head"))
        elif self.skip:
            return
        elif tag == "pre":
            if self.pre == 1:
                self.flush()
            self.pre = max(0, self.pre - 1)
        elif self.pre:
            return
        elif tag == "math":
            if self.math == 1:
                self.buf.append("$ ")
            self.math = max(0, self.math - 1)
        elif tag in self.BLOCK:
            self.flush()

    def handle_data(self, data):
        if not self.skip:
            self.buf.append(data)


def content_lines(source: str, sigma: float = 1.5) -> set[int]:
    """Lines (from 1) of the content regions: ratio of text to tags, smoothed, above the threshold."""
    lines = source.split("\n")
    ratio = [len(_TAG.sub("", x).strip()) / max(1, len(_TAG.findall(x))) for x in lines]
    reach = int(3 * sigma)
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    smooth = []
    for i in range(len(lines)):
        part = [(kernel[d + reach], ratio[i + d]) for d in range(-reach, reach + 1) if 0 <= i + d < len(lines)]
        smooth.append(sum(k * r for k, r in part) / sum(k for k, _ in part))
    mean = sum(smooth) / max(1, len(smooth))
    low, high = [x for x in smooth if x < mean], [x for x in smooth if x >= mean]
    for _ in range(8):  # two clusters in one dimension
        if not low or not high:
            return set(range(1, len(lines) + 1))
        cut = (sum(low) / len(low) + sum(high) / len(high)) / 2
        low, high = [x for x in smooth if x < cut], [x for x in smooth if x >= cut]
    cut = min(cut, sum(low) / max(1, len(low)) * 2 + 1)
    return {i + 1 for i, x in enumerate(smooth) if x >= cut or ratio[i] >= 40}


def read_html(source: str) -> tuple[list[str], list[tuple[str, str, int]]]:
    p = _Html()
    try:
        p.feed(source)
        p.close()
    except AssertionError:  # a broken declaration: what was read so far counts
        pass
    p.flush()
    return p.elements, p.blocks


def read_lines(source: str, kind: str) -> tuple[list[str], list[tuple[str, str, int]]]:
    """Elements and blocks of a Markdown, wiki or LaTeX source."""
    text = source.replace("\r\n", "\n").replace("\r", "\n")
    if kind != "tex":
        text = _hide_comments(text, kind)
    lines = text.split("\n")
    elements: list[str] = []
    blocks: list[tuple[str, str, int]] = []
    para: list[str] = []
    start = 1
    end = None  # pattern that ends the code block or displayed formula being read
    mode, body, fence_at, in_list, blank = "", [], 1, False, True

    def flush():
        nonlocal para
        if para:
            t = "\n".join(para)
            n = len(_MATH.findall(t))
            if kind == "wiki":
                n += len(re.findall(r"<math\b", t))
            elements.extend(["formula"] * n)
            blocks.append(("text", t, start))
            para = []

    def add(element, content, at):
        flush()
        elements.append(element)
        blocks.append((element, content, at))
        n = len(_MATH.findall(content)) + (len(re.findall(r"<math\b", content)) if kind == "wiki" else 0)
        if element in ("list_item", "heading"):
            elements.extend(["formula"] * n)

    i = 0
    while i < len(lines):
        line, at = lines[i], i + 1
        i += 1
        if end is not None:
            m = end.search(line)
            if not m:
                body.append(line)
                continue
            body.append(line[: m.start()])
            add(mode, "\n".join(body).strip("\n"), fence_at)
            end, rest = None, line[m.end() :]
            if not rest.strip():
                continue
            line = rest
        if kind == "tex":
            line = re.sub(r"(?<!\\)((?:\\\\)*)%.*$", r"\1", line)
        opened = None
        if kind == "md":
            m = re.match(r"^\s{0,8}(`{3,}|~{3,})[^`]*$", line)
            if m:
                opened = ("code", re.compile(rf"^\s*{m[1][0]}{{{len(m[1])},}}\s*$"), "")
        elif kind == "wiki":
            m = re.search(r"<(pre|source|syntaxhighlight)\b[^>]*>", line, re.I)
            if m:
                if line[: m.start()].strip():
                    para.append(line[: m.start()])
                opened = ("code", re.compile(rf"</{m[1]}\s*>", re.I), line[m.end() :])
        else:
            m = re.search(r"\\begin\{(verbatim|lstlisting|minted)\*?\}(?:\[[^\]]*\])?(?:\{[^}]*\})?", line)
            if m:
                if line[: m.start()].strip():
                    para.append(line[: m.start()])
                opened = ("code", re.compile(r"\\end\{" + m[1] + r"\*?\}"), line[m.end() :])
            else:
                m = re.search(r"\\begin\{(equation|align|displaymath|eqnarray|gather|multline|math)(\*?)\}", line)
                if m:
                    if line[: m.start()].strip():
                        para.append(line[: m.start()])
                    opened = ("formula", re.compile(r"\\end\{" + m[1] + re.escape(m[2]) + r"\}"), line[m.end() :])
        if opened is None:
            s = line.strip()
            m = re.match(r"^\s*(\$\$|\\\[)", line) if kind in ("md", "tex") else None
            if m and not re.search(re.escape("$$" if m[1] == "$$" else "\\]"), line[m.end() :]):
                opened = ("formula", re.compile(re.escape("$$" if m[1] == "$$" else "\\]")), line[m.end() :])
            elif kind == "wiki" and (m := re.search(r"<math\b[^>]*>", line, re.I)) and not re.search(r"</math>", line[m.end() :], re.I):
                if line[: m.start()].strip():
                    para.append(line[: m.start()])
                opened = ("formula", re.compile(r"</math>", re.I), line[m.end() :])
        if opened:
            flush()
            mode, end, tail = opened
            fence_at, body = at, ([tail] if tail.strip() else [])
            if tail and (m := end.search(tail)):
                body = [tail[: m.start()]]
                add(mode, body[0], at)
                end = None
                if tail[m.end() :].strip():
                    lines[i - 1] = tail[m.end() :]
                    i -= 1
            blank = False
            continue
        if not s:
            flush()
            blank = True
            continue
        if kind == "md":
            if m := re.match(r"^ {0,3}(#{1,6})\s+(.*?)\s*#*\s*$", line):
                add("heading", m[2], at)
                in_list = False
            elif i < len(lines) and re.match(r"^(?:={2,}|-{2,})\s*$", lines[i]) and not para and not _LIST.match(line) and "|" not in line:
                add("heading", s, at)
                i += 1
                in_list = False
            elif re.match(r"^(?: {4}|\t)", line) and blank and not in_list:
                code = [line]
                while i < len(lines) and (re.match(r"^(?: {4}|\t)", lines[i]) or not lines[i].strip() and i + 1 < len(lines) and re.match(r"^(?: {4}|\t)", lines[i + 1])):
                    code.append(lines[i])
                    i += 1
                add("code", "\n".join(code), at)
            elif (m := _LIST.match(line)) and not re.fullmatch(r"\s*[-*_](?:\s*[-*_]){2,}\s*", line):
                item = [line[m.end() :]]
                add("list_item", " ".join(item), at)
                in_list = True
            else:
                if not line.startswith(" "):
                    in_list = in_list and not blank
                if not para:
                    start = at
                para.append(line)
        elif kind == "wiki":
            if m := re.match(r"^(={1,6})\s*(.+?)\s*\1\s*$", s):
                add("heading", m[2], at)
            elif m := re.match(r"^[*#]+\s*(?=\S)", line):
                add("list_item", line[m.end() :], at)
            else:
                if not para:
                    start = at
                para.append(line)
        else:
            if m := re.match(r"^\s*\\(?:part|chapter|(?:sub)*section|paragraph)\*?\s*(?:\[[^\]]*\])?\{(.*?)\}(.*)$", line):
                add("heading", m[1], at)
                if m[2].strip() and not re.fullmatch(r"\s*\\label\{[^}]*\}\s*", m[2]):
                    start = at
                    para.append(m[2])
            elif re.match(r"^\s*\\item\b", line):
                for part in re.split(r"\\item\b(?:\s*\[[^\]]*\])?", line)[1:]:
                    add("list_item", part.strip(), at)
            else:
                if not para:
                    start = at
                para.append(line)
        blank = False
    if end is not None:  # never closed
        add(mode, "\n".join(body).strip("\n"), fence_at)
    flush()
    return elements, blocks


def _hide_comments(text: str, kind: str) -> str:
    """Comments outside of code are removed; their line feeds stay."""
    code = r"^(?P<f>`{3,}|~{3,})[^\n]*\n.*?(?:^(?P=f)[`~]*\s*$|\Z)|`[^`\n]+`" if kind == "md" else r"<(?P<f>pre|source|syntaxhighlight)\b.*?</(?P=f)>"
    return re.sub(rf"(?P<code>{code})|<!--.*?(?:-->|\Z)", lambda m: m[0] if m["code"] else "\n" * m[0].count("\n"), text, flags=re.S | re.M)


def elements(text: str | None) -> list[str]:
    """The elements of a source in order, 'any' first; nothing for plain text."""
    kind = source_format(text) if text and text.strip() else None
    if kind is None:
        return []
    return ["any", *(read_html(text)[0] if kind == "html" else read_lines(text, kind)[0])]


def _inline(t: str, kind: str) -> str:
    """Text of a block without inline markup; formulas stay."""
    kept: list[str] = []

    def keep(m):
        kept.append(m[0])
        return f"\x00{len(kept) - 1}\x00"

    t = _MATH.sub(keep, t)
    if kind == "md":
        t = re.sub(r"!?\[([^\]\n]*)\]\([^)\n]*\)", r"\1", t)
        t = re.sub(r"\[\^\w+\](?::\s*)?", "", t)
        t = re.sub(r"(?<!`)`([^`\n]+)`(?!`)", r"\1", t)
        t = re.sub(r"(\*{1,3}|~~)(?=\S)([^*~\n]+?)(?<=\S)\1", r"\2", t)
        t = re.sub(r"(?<!\w)(_{1,3})(?=\S)([^_\n]+?)(?<=\S)\1(?!\w)", r"\2", t)
    elif kind == "wiki":
        t = re.sub(r"<ref\b[^>]*>.*?</ref>|<ref\b[^>]*/>|\{\{cite\|[^}]*\}\}", "", t, flags=re.S)
        t = re.sub(r"\{\{[^{}|]*\|([^{}]*)\}\}", r"\1", t)
        t = re.sub(r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", r"\1", t)
        t = re.sub(r"\[https?://\S+ ([^\]]*)\]", r"\1", t)
        t = re.sub(r"'{2,5}", "", t)
        t = re.sub(r"<math\b[^>]*>(.*?)</math>", r"$\1$", t, flags=re.S)
        t = re.sub(r"</?[a-zA-Z][^<>\n]*>", "", t)
    else:
        t = re.sub(r"\\(?:begin|end)\{[^}]*\}(?:\[[^\]]*\])?|\\documentclass(?:\[[^\]]*\])?\{[^}]*\}|\\usepackage(?:\[[^\]]*\])?\{[^}]*\}", "", t)
        t = re.sub(r"~?\\(?:cite|ref|label)\w*(?:\[[^\]]*\])?\{[^}]*\}|\\footnote\{[^}]*\}", "", t)
        for _ in range(4):
            t = re.sub(r"\\[a-zA-Z]+\*?\{([^{}]*)\}", r"\1", t)
            t = re.sub(r"\{\\[a-z]+\s+([^{}]*)\}", r"\1", t)
        t = re.sub(r"``([^`']*)''", r'"\1"', t)
        t = re.sub(r"\\([%&_#${}])", r"\1", t)
        t = re.sub(r"(?<=\S)~(?=\S)", " ", t).replace("\\\\", "")
    return re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m[1])], t)


def convert(text: str | None) -> str | None:
    """Clean text of a source: '# ' headings, '- ' items, fenced code, formulas between dollars."""
    kind = source_format(text) if text and text.strip() else None
    if kind is None:
        return text
    if kind == "html":
        blocks = read_html(text)[1]
        content = content_lines(text)
        blocks = [b for b in blocks if b[0] != "text" or b[2] in content or any(x in content for x in (b[2] - 1, b[2] + 1)) and len(b[1]) > 60]
    else:
        blocks = read_lines(text, kind)[1]
    out, before = [], ""
    for what, t, _ in blocks:
        if what not in ("code", "formula") and kind != "html":
            t = _inline(t, kind).strip("\n")
        if what.startswith("heading"):
            t = "# " + t
        elif what == "list_item":
            t = "- " + t
        elif what == "code":
            t = f"```\n{t}\n```"
        elif what == "formula" and kind != "html":
            t = f"$${t.strip()}$$"
        if t.strip():
            out.append(("\n" if what == before == "list_item" else "\n\n") + t if out else t)
            before = what
    return "".join(out)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/core_documents.parquet").select("id", F.col("raw_content").alias("text"))


def found(docs: DataFrame) -> DataFrame:
    """docs (id, text) -> (id, element, seq)."""

    def run(batches):
        for b in batches:
            ids, els, seqs = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                count: dict[str, int] = {}
                for e in elements(t) if i is not None else ():
                    count[e] = count.get(e, 0) + 1
                    ids.append(i)
                    els.append(e)
                    seqs.append(count[e])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(els, pa.string()), pa.array(seqs, pa.int32())], names=["id", "element", "seq"])

    return docs.select("id", "text").mapInArrow(run, "id bigint, element string, seq int").distinct()


def converted(docs: DataFrame) -> DataFrame:
    """docs (id, text) -> (id, text) without markup."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([convert(t) for t in b.column(1).to_pylist()], pa.string())], names=["id", "text"])

    return docs.select("id", "text").mapInArrow(run, "id bigint, text string")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """(id, element, seq) of all core_documents with markup."""
    return found(documents(spark, sf))


def p3_converted(spark: SparkSession, sf: str) -> DataFrame:
    """(id, text) of all core_documents, markup removed."""
    return converted(documents(spark, sf))
