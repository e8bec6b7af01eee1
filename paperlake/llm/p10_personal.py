"""Problem 10: personal items in free text, found and replaced by typed placeholders.

Anchor expansion: one Aho-Corasick automaton finds at-signs and their disguises, plus signs and beginnings of digit
groups, cues of identity numbers, street words, cues of names, initials, and the listed parts of names and their
beginnings. Local parsers then expand each anchor to the whole item and check it: an e-mail address must have a domain,
a phone a country code or the grouping of a numbering plan, an identity number a cue before it (or a form with
a valid date or checkable blocks), a street a number on its right side, a name two parts in one of the usual orders.
Names missing from the list are known by the beginnings and endings that listed names share, wherever
one of these beginnings, an initial, a listed part or a cue stands. Longer items go before shorter ones, and items don't overlap.

Null text stays null; empty and blank texts have no items. Repeated rows count once. White space inside an item
may be a line break; found_text has it as one space.
"""

from __future__ import annotations

import re
from collections import Counter
from string import ascii_uppercase

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}
#: Format limits of an address: signs before its at-sign (64, and what a disguise adds) and after it (255 and the same).
LOCAL, DOMAIN = 90, 280
NAMES = 1_000_000  # more listed name parts than this are refused: the list is broadcast

_LOCAL = r"[A-Za-z0-9](?:[\w.+-]*\w)?"
_EMAIL = re.compile(rf"{_LOCAL}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{{2,}}")
_HIDDEN = re.compile(
    rf"{_LOCAL}(?:\s?[(\[{{]\s?(?:at|AT)\s?[)\]}}]\s?|\s+AT\s+|\s+at\s+(?=[\w-]+\s+dot\s)|\s?@\s?(?=[\w-]+\s?[(\[{{]))"
    r"[A-Za-z0-9-]+(?:(?:\.|\s?[(\[{]\s?(?:dot|DOT)\s?[)\]}]\s?|\s+DOT\s+|\s+dot\s+)[A-Za-z0-9-]+)+"
)
_EXT = re.compile(r"\s?(?:x|ext\.?|extension|Durchwahl|poste|anexo)\s?\d{1,5}(?![\w/-]|\.\d)")
_AFTER = re.compile(r"[\w/-]|\.\d")  # what can't follow the end of a number
_GROUP = re.compile(r"\((\d{1,5})\)|(\d+)")
_GAP = re.compile(r"[ \n\t\u00a0][(]?|[.\-/]")
_CALL = re.compile(r"(?:\b(?:tel|tél|phone|telephone|telefon|teléfono|téléphone|mobile|cell|fax|call|dial|ring|desk|hotline|whatsapp|sms|appeler|anrufen|llamar|reach)\b|@|[(\[{]\s?at\s?[)\]}]|\bdot\b|\bcontact\w*\b)[\s\S]{0,40}$", re.I)
#: What announces a person's number.
_ID_CUES = [
    "social security", "SSN", "national insurance", "tax id", "tax number", "taxpayer", "TIN", "passport", "identity number", "identity card", "identity no", "national id", "ID", "id number", "id no", "id card", "badge", "driver's license", "driving licence",
    "Ausweis", "Personalausweis", "Reisepass", "Steuernummer", "Steuer-ID", "Sozialversicherungsnummer", "Pièce d'identité", "carte d'identité", "passeport", "sécurité sociale", "numéro fiscal", "DNI", "NIE", "NIF", "pasaporte", "documento", "identidad", "seguridad social",
]
_ID_LINK = re.compile(r"(?:[\s:#(=,]|\b(?:no|nr|num|number|nummer|card|code|is|was|lautet|est|es)\b\.?|n[°º.]|№)*", re.I)
#: Forms of identity numbers in groups, and the single word: 6 to 14 signs, of which at least 5 are digits.
_ID_FORMS = re.compile(r"(?:\d{3}-\d{2}-\d{4}|\d{3}\s\d{2}\s\d{4}|\d{3}\.\d{3}\.\d{3}-\d{1,2}|\d{2}\s\d{3}\s\d{3}\s\d|\d{3}\s\d{3}\s\d{3}|\d{6}[-+]\d{4}|\d{4}-\d{4}|(?=(?:[A-Z]*\d){5})[A-Z\d]{6,14})(?![\w/-]|\.\d)")
#: Forms that need no cue: blocks of a social security number, dotted groups with a check part, a birth date with a serial part.
_ID_PLAIN = re.compile(r"(?:(?!000|666|9\d\d)\d{3}-(?!00)\d{2}-(?!0000)\d{4}|\d{3}\.\d{3}\.\d{3}-\d{1,2}|\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])[-+]\d{4})(?![\w/-]|\.\d)")
_NOT_PERSON = re.compile(r"(?:Order|Part|Report|Run|Serial|Build|Checksum|Unit|Lot|Ticket|Batch|Drawing|No\. of|Invoice|Contract|Item|Model|Asset|Case|Bestellung|Pedido|Commande)\s+(?:no\.?\s+|number\s+|#)?$", re.I)
_UP = r"[A-ZÄÖÜÉÁÍÓÚÑ][\w'’äöüßéáíóúñ-]*"
_STREET_EN = r"(?:Street|Road|Avenue|Lane|Drive|Blvd|Boulevard|Terrace|Court|Place|Way|Close|Square|Crescent|Row|Walk|(?:St|Rd|Ave|Ln|Dr|Blvd|Ct|Sq)\b\.?)"
_STREET = re.compile(
    rf"(?<![\w.-])\d{{1,5}}[A-Z]?,?\s(?:{_UP}\s){{1,3}}{_STREET_EN}(?!\w)"
    rf"|(?<![\w.-])\d{{1,5}}[A-Za-z]?,?\s(?:rue|avenue|boulevard|place|chemin|quai|impasse)\s(?:(?:de|du|des|la|le)\s){{0,2}}{_UP}"
    rf"|(?<!\w){_UP}(?:straße|strasse|weg|platz|gasse|allee|ring|damm)\s\d{{1,5}}[A-Za-z]?(?!\w|\.\d)"
    rf"|(?<!\w)(?:Calle|Avenida|Plaza|Paseo|Camino|Via|Rua)\s(?:(?:de|del|la|las|los)\s){{0,2}}{_UP},?\s\d{{1,5}}[A-Za-z]?(?!\w|\.\d)"
)
_STREET_WORDS = ["Street", "Road", "Avenue", "Lane", "Drive", "Blvd", "Boulevard", "Terrace", "Court", "Place", "Way", "Close", "Square", "Crescent", "Row", "Walk", "St", "Rd", "Ave", "Ln", "Dr", "Ct", "Sq", "rue", "avenue", "boulevard", "place", "chemin", "quai", "impasse", "straße", "strasse", "weg", "platz", "gasse", "allee", "ring", "damm", "Calle", "Avenida", "Plaza", "Paseo", "Camino", "Via", "Rua"]
_NO_STREET = re.compile(r"(?:Table|Figure|Fig\.|Another|Section|Unit|Part|Bay|Chapter|Run|Test)\s+$")
_CUES = ["To:", "From:", "Contact ", "Contacter ", "Dr.", "Dra.", "Prof.", "Mr.", "Ms.", "Mrs.", "Mme ", "Herr ", "Frau ", "Sr.", "Sra.", "Signed:", "Thanks to ", "Prepared by ", "Present:", "Regards,", "Best wishes", "Cc:", "-- ", "issued to ", "request of ", "gate by ", "shift (", "We met ", "the review, ", "reimbursement for ", "As ", "nombre de ", "présentée par ", "Rückfragen an ", "Consultas a ", "gehört "]
_NAME_PART = r"[A-Z][\w'’éèáíóúñäöüß-]+"
_AT = ["@", "(at)", "[at]", "{at}", "(AT)", "[AT]", " AT ", " at "]
_EDGES = " \n\t\u00a0(:;,|=#\"'[°ºª"  # what can stand before a number


class NameParts:
    """Listed parts of names, and what unlisted ones share with them."""

    def __init__(self, given: set[str], family: set[str]):
        self.given, self.family = given, family
        self.heads, self.tails = {}, {}
        for kind, parts in (("given", given), ("family", family)):
            heads = Counter(p[:n] for p in parts for n in (2, 3, 4) if len(p) > n + 1)
            tails = Counter(p[-n:] for p in parts for n in (2, 3, 4, 5) if len(p) > n + 1)
            self.heads[kind] = {h for h, n in heads.items() if n >= 4}
            self.tails[kind] = {t for t, n in tails.items() if n >= 4}

    def like(self, word: str, kind: str) -> bool:
        """A word made of a beginning and an ending of listed parts, with at most four letters between."""
        if len(word) < 4:
            return False
        heads, tails = self.heads[kind], self.tails[kind]
        for h in (4, 3, 2):
            if word[:h] in heads:
                for t in (5, 4, 3, 2):
                    if word[-t:] in tails and 0 <= len(word) - h - t <= (4 if kind == "family" else 0):
                        return True
        return False

    def is_given(self, word: str) -> bool:
        w = word.capitalize() if word.isupper() else word
        return w in self.given

    def is_family(self, word: str) -> bool:
        w = word.capitalize() if word.isupper() else word
        return w in self.family

    def maybe(self, word: str, kind: str) -> bool:
        w = word.capitalize() if word.isupper() else word
        return w in (self.given if kind == "given" else self.family) or self.like(w, kind)


def is_phone(plus: bool, groups: list[str], gaps: list[str], ext: bool, before: str) -> bool:
    """Whether groups of digits (some in brackets) with the signs between them are a phone number."""
    g = [x.strip("()") for x in groups]
    digits, size = "".join(g), [len(x) for x in g]
    n = len(digits)
    if plus:
        return 8 <= n <= 15 and len(g) > 1 or 10 <= n <= 15
    if len(set(x if x != "\n" else " " for x in gaps if x)) > 2:
        return False
    if size[-3:] == [3, 3, 4] and (len(g) == 3 or len(g) == 4 and g[0] == "1") and "/" not in gaps:
        return g[-3][0] in "23456789"
    if groups[0].startswith("("):
        return len(g) == 3 and size == [3, 3, 4]
    if n == 10 and len(g) == 1 and digits[0] in "23456789" and digits[3] in "23456789":
        return ext or bool(_CALL.search(before))
    if size == [3, 4] and gaps == ["-"]:
        return ext or bool(_CALL.search(before[-14:]))
    if digits[0] == "0" and n >= 9:
        if digits[1] == "0":
            return 10 <= n <= 15 and len(g) > 1 and "-" not in gaps
        if size == [2] * 5 or n == 10 and len(g) == 1 and bool(_CALL.search(before)):
            return True
        if gaps == ["/"] and 3 <= size[0] <= 5:
            return 9 <= n <= 14
        return len(g) in (2, 3) and 10 <= n <= 11 and 3 <= size[0] <= 5 and min(size) >= 3 and all(x in " \n\u00a0" for x in gaps)
    return False


_INITIAL = r"[A-Z]\."
_FORWARD = re.compile(rf"({_NAME_PART}|{_INITIAL})(?:\s({_INITIAL}))?\s({_NAME_PART})")
_BACKWARD = re.compile(rf"([A-Z][A-Z'’ÉÄÖÜ-]{{2,}})(,?)\s({_NAME_PART}|{_INITIAL})(?:\s({_INITIAL}))?")
_BACKMIXED = re.compile(rf"({_NAME_PART}),\s({_NAME_PART}|{_INITIAL})")


class Finder:
    """Spans of personal items in a text."""

    def __init__(self, parts: NameParts):
        self.parts = parts
        self.automaton = ahocorasick.Automaton()
        for kind, words in (("cue", _CUES), ("street", _STREET_WORDS), ("at", _AT)):
            for w in words:
                self.automaton.add_word(w, (kind, len(w)))
        for w in _ID_CUES:
            for form in {w, w[:1].upper() + w[1:], w.upper()}:
                self.automaton.add_word(form, ("id", len(form)))
        for d in range(10):
            for edge in _EDGES:
                self.automaton.add_word(f"{edge}{d}", ("number", 1))
            self.automaton.add_word(f"+{d}", ("number", 2))
        heads = parts.heads["given"] | parts.heads["family"]
        for w in parts.given | parts.family | heads | {f"{c}." for c in ascii_uppercase}:
            for form in {w, w.upper()}:
                street = self.automaton.get(form, ("",))[0] == "street"
                if street or form not in self.automaton:
                    self.automaton.add_word(form, ("both" if street else "name", len(form)))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind), in order, without overlaps."""
        found: list[tuple[int, int, str]] = []
        names: list[int] = []
        streets: list[int] = []
        at: list[int] = []
        numbers: list[int] = [0] if text[:1].isdigit() else []
        cues: list[int] = []
        for end, (kind, n) in self.automaton.iter(text.replace("\n", " ")):
            if kind == "at":
                at.append(end)
            elif kind == "number":
                numbers.append(end + 1 - n)
            elif kind == "id":
                if end + 1 >= n and (end + 1 == n or not text[end - n].isalnum()):
                    cues.append(end + 1)
            elif kind != "cue":
                if kind in ("street", "both"):
                    streets.append(end + 1 - n)
                if kind in ("name", "both"):
                    names.append(end + 1 - n)
            else:
                names.append(-(end + 2))  # what comes after a cue
        for p in at:  # an address has at most LOCAL signs before its at-sign, and a domain of bounded length after it
            lo, hi = max(0, p - LOCAL), min(len(text), p + DOMAIN)
            for pattern in (_EMAIL, _HIDDEN):
                for m in pattern.finditer(text, lo, hi):
                    whole = m.start() > lo or lo == 0 or not re.match(r"[\w.+-]", text[lo - 1])
                    if m.start() <= p < m.end() and whole:
                        found.append((m.start(), m.end(), "email"))
        found = list(dict.fromkeys(found))
        taken = sorted(found)
        for s in streets:
            found += self._street(text, s)
        people = self._names(text, names, taken)
        found += self._identities(text, cues, numbers, people)
        found += self._phones(text, numbers, {e for _, e, _ in people})
        found += people
        found.sort(key=lambda x: (x[0], x[0] - x[1]))
        order = {"email": 0, "address": 1, "phone": 2, "id_number": 3, "name": 4}
        out: list[tuple[int, int, str]] = []
        for x in found:
            if out and x[0] < out[-1][1]:
                y = out[-1]
                if (order[x[2]], y[1] - y[0] - x[1] + x[0]) < (order[y[2]], 0) and x[2] != "name":
                    out[-1] = x
                continue
            out.append(x)
        return out

    def _identities(self, text: str, cues: list[int], numbers: list[int], people):
        for c in cues:
            if c < len(text) and text[c].isalnum():
                continue  # the cue is the beginning of another word
            if _NOT_PERSON.search(text[max(0, c - 30) : c] + " "):
                continue
            link = _ID_LINK.match(text, c)
            m = _ID_FORMS.match(text, link.end())
            if m and link.end() > c:
                yield (m.start(), m.end(), "id_number")
        for _, e, _ in people:  # a number in brackets after a name
            gap = re.compile(r"\s?\(").match(text, e)
            m = gap and _ID_FORMS.match(text, gap.end())
            if m and text[m.end() : m.end() + 1] == ")":
                yield (m.start(), m.end(), "id_number")
        for a in numbers:
            m = _ID_PLAIN.match(text, a)
            if m and not _NOT_PERSON.search(text[max(0, a - 24) : a]):
                yield (m.start(), m.end(), "id_number")

    def _phones(self, text: str, numbers: list[int], people: set[int]):
        """From each beginning of a digit group the longest run of groups that is a phone number."""
        done = 0
        for a in numbers:
            if a < done:
                continue
            if text[a] != "+" and a and text[a - 1] == "(":
                a -= 1
            if a > 1 and text[a - 1] == "+":
                continue
            groups, gaps, ends = [], [], []
            at = a + (text[a] == "+")
            while len(groups) < 8:
                m = _GROUP.match(text, at)
                if not m:
                    break
                groups.append(m[0])
                ends.append(m.end())
                gap = _GAP.match(text, m.end()) if text[m.end() : m.end() + 1] != "(" else None
                if text[m.end() : m.end() + 1] == "(":
                    gaps.append("")
                    at = m.end()
                    continue
                if not gap:
                    break
                gaps.append(gap[0][0])
                at = m.end() + (1 if gap[0][-1] == "(" or len(gap[0]) == 1 else len(gap[0]))
            for k in range(len(groups), 0, -1):
                end = ends[k - 1]
                ext = _EXT.match(text, end)
                if not ext and _AFTER.match(text, end):
                    continue
                before = text[max(0, a - 70) : a]
                if any(e in people for e in range(a - 5, a)):
                    before = "phone "  # it stands beside a name
                if is_phone(text[a] == "+", groups[:k], gaps[: k - 1], bool(ext), before) and not _NOT_PERSON.search(before[-24:]):
                    done = ext.end() if ext else end
                    yield (a, done, "phone")
                    break

    def _street(self, text: str, at: int):
        lo = max(0, at - 45)
        for m in _STREET.finditer(text, lo, min(len(text), at + 60)):
            if m.start() <= at < m.end():
                if _NO_STREET.search(text[max(0, m.start() - 12) : m.start()]):
                    continue
                after = text[m.end() : m.end() + 24]
                if m[0][0].isdigit() and re.match(r"\s(?:units|tests|hits|runs|[A-Z][a-z]+\s(?:Court|Road|Drive|Street)?\s?(?:tests|units))\b", after):
                    continue
                yield (m.start(), m.end(), "address")

    def _names(self, text: str, at: list[int], taken):
        p, out, seen = self.parts, [], set()
        starts: set[int] = set()
        for a in at:
            if a < 0:
                m = re.compile(r"\s*").match(text, -a - 1)
                starts.add(m.end())
                continue
            # the part itself, or one or two words before it
            if a and (text[a - 1].isalnum() or text[a - 1] in "@._-+"):
                continue
            starts.add(a)
            back = re.search(rf"(?:({_NAME_PART}|{_INITIAL})\s)?({_NAME_PART}|{_INITIAL}),?\s$", text[max(0, a - 40) : a])
            if back:
                base = max(0, a - 40)
                starts.add(base + back.start(2))
                if back[1]:
                    starts.add(base + back.start(1))
        covered = 0
        for s in sorted(starts):
            if s in seen or s < covered:
                continue
            seen.add(s)
            if s and (text[s - 1].isalnum() or text[s - 1] in "@._-+"):
                continue
            end = self._name_at(text, s)
            if end and not any(x[0] < end and s < x[1] for x in taken):
                out.append((s, end, "name"))
                covered = end
        return out

    def _name_at(self, text: str, s: int) -> int | None:
        p = self.parts

        def whole(end):
            return end >= len(text) or not (text[end].isalnum() or text[end] in "@_" or text[end] in ".+-" and end + 1 < len(text) and text[end + 1].isalnum())

        m = _BACKWARD.match(text, s)
        if m and p.maybe(m[1], "family") and whole(m.end()):
            initial = re.fullmatch(_INITIAL, m[3])
            if (initial and m[2]) or not initial and p.maybe(m[3], "given") and not m[3].isupper():
                return m.end(4) if m[4] and not re.match(rf"\s{_NAME_PART}", text[m.end(4) :]) else m.end(3)
        m = _FORWARD.match(text, s)
        if m and whole(m.end()):
            initial = re.fullmatch(_INITIAL, m[1])
            last = m[3]
            if initial:
                if p.maybe(last, "family"):
                    return m.end()
            elif p.maybe(m[1], "given") and p.maybe(last, "family") and (p.is_given(m[1]) or p.is_family(last) or p.like(last, "family")):
                return m.end()
        m = _BACKMIXED.match(text, s)
        if m and whole(m.end()) and p.is_family(m[1]) and p.is_given(m[2]):
            nxt = re.match(rf"\s({_NAME_PART})", text[m.end() :])
            if not (nxt and p.maybe(nxt[1], "family")):
                return m.end()
        return None


def finder(rows: list[tuple[str, str]]) -> Finder:
    given = {n.strip() for n, k in rows if n and k == "given" and len(n.strip()) > 1}
    family = {n.strip() for n, k in rows if n and k == "family" and len(n.strip()) > 1}
    return Finder(NameParts(given, family))


def replaced(text: str | None, f: Finder) -> str | None:
    if not text:
        return text
    out, at = [], 0
    for s, e, kind in f.spans(text):
        out += [text[at:s], KINDS[kind]]
        at = e
    return "".join([*out, text[at:]])


def _shared(spark: SparkSession, names: DataFrame):
    listed = names.select("name_part", "part_kind").where("name_part is not null").distinct()
    rows = [tuple(r) for r in listed.limit(NAMES + 1).collect()]
    if len(rows) > NAMES:
        raise ValueError(f"the list of names has more than {NAMES} parts")
    rows.sort(key=str)
    return spark.sparkContext.broadcast(rows)


def found(docs: DataFrame, names: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, kind, found_text), each item of a text once."""
    shared = _shared(docs.sparkSession, names)

    def run(batches):
        f = finder(shared.value)
        for b in batches:
            rows = set()
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t and i is not None:
                    rows.update((i, kind, re.sub(r"\s+", " ", t[s:e])) for s, e, kind in f.spans(t))
            cols = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], names=["doc_id", "kind", "found_text"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, kind string, found_text string").distinct()


def masked(docs: DataFrame, names: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, text) with placeholders."""
    shared = _shared(docs.sparkSession, names)

    def run(batches):
        f = finder(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([replaced(t, f) for t in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string")


def _tables(spark: SparkSession, sf: str):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/person_names.parquet")


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, kind, found_text)."""
    return found(*_tables(spark, sf))


def p10_masked(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text) of every document with placeholders."""
    return masked(*_tables(spark, sf))
