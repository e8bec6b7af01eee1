"""TeX papers to plain text and sections. Comments end at the line's end unless their sign is escaped; arguments are read
with their braces balanced. Null and empty sources have no sections."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Environments that are no running text, displayed formulas, wrappers whose content stays, references
#: that go, escapes in the order they are undone.
DROPPED = ["figure", "figure*", "table", "table*", "tikzpicture", "algorithm", "algorithmic", "lstlisting", "verbatim", "thebibliography"]
DISPLAYED = ["equation", "align", "gather", "multline"]
WRAPPERS = ["textbf", "textit", "emph", "texttt", "textrm", "textsf", "textsc", "underline", "mbox"]
REFERENCES = ["cite", "citep", "citet", "citealp", "ref", "eqref", "autoref", "label"]
ESCAPES = [("\\%", "%"), ("\\&", "&"), ("\\_", "_"), ("\\#", "#"), ("\\$", "$"), ("\\{", "{"), ("\\}", "}"), ("~", " "), ("``", '"'), ("''", '"'), ("---", "—"), ("--", "–")]
LEVELS = {"section": 1, "subsection": 2, "subsubsection": 3}
BODY = "Document Body"

_COMMENT = re.compile(r"(?<!\\)((?:\\\\)*)%[^\n]*")
_GONE = re.compile(r"\\begin\{(" + "|".join(map(re.escape, sorted(DROPPED, key=len, reverse=True))) + r")\}.*?\\end\{\1\}", re.S | re.I)
_FORMULA = re.compile(r"\\begin\{(" + "|".join(DISPLAYED) + r")(\*?)\}.*?\\end\{\1\2\}|\\\[.*?\\\]|\$\$.*?\$\$", re.S)
_INLINE = re.compile(r"(?<!\\)\$(.+?)(?<!\\)\$", re.S)
_LINK = re.compile(r"\\href\s*\{[^{}]*\}\s*\{([^{}]*)\}|\\url\s*\{([^{}]*)\}")
_REFERENCE = re.compile(r"\\(?:" + "|".join(REFERENCES) + r")\s*(?:\[[^\]]*\]\s*)*\{[^{}]*\}")
_WRAPPER = re.compile(r"\\(?:" + "|".join(WRAPPERS) + r")\s*\{([^{}]*)\}")
_HEADING = re.compile(r"\\(section|subsection|subsubsection)\*?\s*(?:\[[^\]]*\]\s*)?(?=\{)")


def uncommented(tex: str) -> str:
    return _COMMENT.sub(r"\1", tex)


def braced(tex: str, at: int) -> tuple[str, int] | None:
    """What the braces that open at a position hold, and the position after them; null if they never close."""
    depth = 0
    for m in re.compile(r"[{}]").finditer(tex, at):
        depth += 1 if m[0] == "{" else -1
        if depth == 0:
            return tex[at + 1 : m.start()], m.end()
    return None


def argument(tex: str, command: str) -> str:
    """The first argument of the first such command."""
    m = re.search(rf"\\{re.escape(command)}\s*(?:\[[^\]]*\]\s*)?(?=\{{)", tex)
    got = braced(tex, m.end()) if m else None
    return got[0] if got else ""


def plain(tex: str) -> str:
    """Running text; displayed formulas become lines [EQUATION]."""
    t = _GONE.sub("\n\n", uncommented(tex))
    t = _INLINE.sub(r"\1", _FORMULA.sub("\n\n[EQUATION]\n\n", t))
    t = _LINK.sub(lambda m: m[1] if m[1] is not None else m[2], t)
    t = re.sub(r"\\(?:begin|end)\{[^{}]*\}", "\n", _REFERENCE.sub(" ", t))
    for _ in range(5):
        t, n = _WRAPPER.subn(r"\1", t)
        if not n:
            break
    for a, b in ESCAPES:
        t = t.replace(a, b)
    t = re.sub(r"\\[A-Za-z@]+\*?(?:\[[^\]]*\])?", " ", t).replace("{", "").replace("}", "")
    t = re.sub(r"\n[ \t]+", "\n", re.sub(r"[ \t]+", " ", t))
    return re.sub(r"\n{3,}", "\n\n", t).strip()


def squeezed(t: str) -> str:
    return " ".join(t.split())


def paragraphs(tex: str) -> list[tuple[str, str]]:
    """(type, text) of the paragraphs of a piece of TeX."""
    parts = (squeezed(p) for p in re.split(r"\n\s*\n", plain(tex)))
    return [("equation" if p == "[EQUATION]" else "paragraph", p) for p in parts if p]


def sections(source: str | None) -> list[tuple[str, int, list[tuple[str, str]]]]:
    """(heading, level, paragraphs). What stands before the first heading is BODY, without title and abstract; so is a
    source without headings. Sections may be empty."""
    if not source:
        return []
    tex = uncommented(source)
    heads = []
    for m in _HEADING.finditer(tex):
        got = braced(tex, m.end())
        name = squeezed(plain(got[0])) if got else ""
        if name:
            heads.append((m.start(), got[1], name, LEVELS[m[1]]))
    first = heads[0][0] if heads else len(tex)
    before = tex[:first]
    begin = re.search(r"\\begin\{document\}", before)
    before = before[begin.end() :] if begin else before
    if heads:
        before = re.sub(r"\\begin\{abstract\}.*?\\end\{abstract\}", " ", before, flags=re.S | re.I)
        m = re.search(r"\\title\s*(?=\{)", before)
        got = braced(before, m.end()) if m else None
        before = before[: m.start()] + before[got[1] :] if got else before
    out = [(BODY, 1, p)] if (p := paragraphs(before)) else []
    ends = [h[0] for h in heads[1:]] + [len(tex)]
    return out + [(name, level, paragraphs(tex[at:end])) for (_, at, name, level), end in zip(heads, ends)]


def title(source: str) -> str:
    return squeezed(plain(argument(uncommented(source), "title")))


def abstract(source: str) -> str:
    m = re.search(r"\\begin\{abstract\}(.*?)\\end\{abstract\}", uncommented(source), re.S | re.I)
    return squeezed(plain(m[1])) if m else ""


@F.pandas_udf(StringType())
def plain_tex(c: pd.Series) -> pd.Series:
    return c.map(plain, na_action="ignore")


def tex_blocks(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, pos, type, level, text, in_bibliography): headings and paragraphs of TeX sources, as of HTML ones."""

    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k = 0
                for heading, level, parts in sections(t):
                    for kind, lv, x in [("heading", level + 1, heading), *((kind, 0, x) for kind, x in parts)]:
                        rows.append((i, k, kind, lv, x, False))
                        k += 1
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[ident, "pos", "type", "level", "text", "in_bibliography"])

    return df.select(ident, text).mapInArrow(run, f"{ident} bigint, pos int, type string, level int, text string, in_bibliography boolean")
