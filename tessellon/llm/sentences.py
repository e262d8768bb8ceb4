"""Sentences of texts in many languages and scripts, by a finite transducer.

A lexer with bounded context turns the text into tagged symbols: a full stop with the class of what stands before
it (abbreviation of some kind, initial, ordinal, number, word) and after it (small letter, digit, what may start a
sentence), other marks with what follows, a quotation or bracket that opens or closes, the end of a unit. The rules
over these classes are compiled into the tables of a transducer, which reads the symbols; its states say whether
the place lies in a quotation and what led into it, beside a count of open brackets, and it emits a cut where a
sentence ends. A quotation or bracket opens only if its close follows in the same unit, however far off.

A text is split into chunks; each chunk is read from all states at once, which gives its state-transition function
(brackets: the count after is max(before + a, b)). The functions are composed by a prefix scan, and every chunk is then
read from the one state it really starts in. Short texts are one chunk; chunk size changes no result.

Case decides most Latin, Greek and Cyrillic cuts; a text in one case throughout is told apart, and for
it, as for scripts without case, a quotation ends the sentence only where a colon or comma leads into it.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import pandas as pd

#: Texts of more characters are split into chunks of about this size, which go to all tasks.
CHUNK_CHARS = 1 << 18
#: Characters to either side of a place that the lexer may look at.
_CONTEXT = 300

# Abbreviations, in lower case and without the last full stop.
# Never the end of a sentence:
NEVER = set(
    "dr prof mr mrs ms mme mlle hr fr sr sra srta dra dres st ste univ dept gen gov rev hon cf vgl vs viz bzw evtl ggf inkl sog usf i.e e.g z.b d.h u.a o.ä "
    "p.ex p.ej т.е т.к см ср проф акад доц им ул тыс млн млрд руб δρ κ κα π.χ δηλ βλ καθ д-р г-н д ед ee д-ра гл ed eds ex ej د أ م डॉ श्री सं ดร approx ca aprox env d'env περ abb tab tabl".split()
)
# Only before a number no end:
BEFORE_NUMBER = set("no nos nr núm num fig figs sect sec ch cap chap kap art eq ref vol pp pg p pág pag s v vers рис табл стр с вып п гл σελ εικ πιν αρ jan feb mar apr jun jul aug sep sept oct nov dec".split())
# No end before a small letter or number, an end before a capital:
OFTEN_END = set("etc usw al inc corp ltd co bros jr spp sp ssp subsp var a.m p.m u.s u.k b.i.d t.i.d q.i.d uu др пр г гг т.д т.п κ.λπ κλπ λπ μ.μ π.μ".split())
# Words before a German ordinal.
ORDINAL_AFTER = set("der die das dem den des am vom zum zur im beim ab bis seit ein eine einem einer jeder jede jedes".split())

_OPEN_OF = {"“": 2, "„": 3, "«": 4, "「": 5, "『": 6}
_CLOSE_OF = {"”": 2, "»": 4, "」": 5, "』": 6}
_CLOSER = {1: '"', 2: "”", 3: "“”", 4: "»", 5: "」", 6: "』"}
_PARENS_OPEN, _PARENS_CLOSE = "(（[［", ")）]］"
_CLOSING = "".join(dict.fromkeys("".join(_CLOSER.values()) + _PARENS_CLOSE))
# Marks that end a sentence whatever follows (Devanagari, Arabic, Urdu, Armenian, Ethiopic, Burmese, Khmer, Mongolian, Tibetan, Canadian syllabics).
_ALWAYS = "।॥؟۔։።፧။។៕᠃᠉༎᙮"
_TERMS = ".!?…。！？｡;\u037e‼⁇⁈⁉" + _ALWAYS
_CJK_TERMS = "。！？｡"
_MARKUP = r"</?[A-Za-z][^<>\n]*>"
_TAIL = re.compile(rf"(?:[\"”’'»」』）)\]］*_​⁠\xad]|[\s]?»|{_MARKUP})*")
_HEAD = re.compile(rf"(?:[\"“„«‘'‹「『（(\[［¿¡*_​⁠\xad\-–—]|«\s|{_MARKUP}|[^\w\s.,;:!?\"'()])*")
_EVENT = re.compile(rf"[{re.escape(_TERMS)}]+|[\"“”„«»「」『』()（）\[\]［］]|[^\S\n\r\u2028\u2029\x0b\x0c\x85]*[\n\r\u2028\u2029\x0b\x0c\x85]\s*")
_EVENT_THAI = re.compile(_EVENT.pattern + r"|\s+")
_BREAK = re.compile("\r\n|[\n\r\u2028\u2029\x0b\x0c\x85]")
_BLANK_LINE = re.compile("(?:\r\n|[\n\r\u2028\u2029\x0b\x0c\x85])[^\\S\n\r]*(?:\r\n|[\n\r\u2028\u2029\x0b\x0c\x85])")
_THAI = re.compile("[฀-๿]")
_LETTERS = re.compile(r"[^\W\d_]+")
_TOKEN_END = re.compile(r"[^\s(\[{\"„“«‘「『（”»]+$")
_NO_SPACE_START = re.compile(r"(?:[^\W\d_a-zа-яα-ω])(?:[^\W\d_])+(?=[\s\-,']|$)|[A-Z](?=\s[a-z])")
_DOTTED = re.compile(r"(?:[^\W\d_]{1,3}\.)+[^\W\d_]{1,3}")
_NO, _YES, _LED = range(3)  # how a closing quotation may end the sentence: not, always, if a colon or comma leads into it


#: What may stand before a full stop, and what after the white space behind it: nothing that starts a sentence, a digit,
#: a start that case (or the end) tells, another start.
_LEFT = ("none", "indic", "never", "before_number", "letter_before_number", "often_end", "unit", "capital_unit", "initial", "dotted", "list_number", "ordinal", "word")
_RIGHT = ("held", "digit", "told", "open")


def _stop_ends(left: str, right: str, case: int) -> bool:
    """Whether a full stop between these classes ends a sentence; ``case``: see ``case_of``."""
    if right == "held" or left in ("indic", "never", "letter_before_number", "initial", "dotted", "list_number", "ordinal"):
        return False
    if left == "before_number":
        return right != "digit"
    if left == "often_end":
        return not case and right != "digit"
    return left != "capital_unit" or case == 2


def _build() -> tuple[dict, np.ndarray, np.ndarray]:
    """The transducer. States: (quotation 0-6, led into or not); what is emitted also depends on the brackets open: 0, 1 or more."""
    states = [(q, led) for q in range(7) for led in (0, 1)]
    number = {s: i for i, s in enumerate(states)}
    names: list[tuple] = [("end",), ("unit",)]
    names += [("stop", left, right, case) for left in _LEFT for right in _RIGHT for case in range(3)]
    names += [("dots", right, cjk, case) for right in _RIGHT for cjk in (False, True) for case in range(3)]
    names += [("mark", right) for right in _RIGHT]
    names += [("open", t, led) for t in range(1, 7) for led in (0, 1)]
    names += [("close", t, how) for t in range(1, 7) for how in (_NO, _YES, _LED)]
    names += [("high", led, how) for led in (0, 1, None) for how in (_NO, _YES, _LED)]  # “ opens, or closes „
    names += [("in",)] + [("out", how) for how in (_NO, _YES)]
    delta, emit = np.zeros((len(states), len(names)), np.int8), np.zeros((len(states), len(names), 3), bool)
    for (s, (q, led)), (e, name), p in itertools.product(enumerate(states), enumerate(names), range(3)):
        to, out, outside = (q, led), False, q == 0 and p == 0
        what = name[0]
        closes = p == 0 and (name[-1] == _YES or (name[-1] == _LED and led == 1))
        if what == "end":
            out = outside
        elif what == "stop":
            out = outside and _stop_ends(*name[1:])
        elif what == "dots":
            out = outside and name[1] != "held" and not name[3] and (name[1] != "open" or not name[2])
        elif what == "mark":
            out = outside and name[1] != "held"
        elif what == "unit":
            to, out = (0, 0), True
        elif what == "open" and q == 0:
            to = (name[1], name[2])
        elif what == "close" and q == name[1]:
            to, out = (0, 0), closes
        elif what == "high":
            if q == 3:
                to, out = (0, 0), closes
            elif q == 0 and name[1] is not None:
                to = (2, name[1])
        elif what == "out":
            out = p == 1 and q == 0 and name[1] == _YES
        delta[s, e], emit[s, e, p] = number[to], out
    return {n: i for i, n in enumerate(names)}, delta, emit


EVENTS, DELTA, EMIT = _build()
_DELTA, _EMIT = DELTA.tolist(), EMIT.tolist()
_UNIT, _IN, _OUT = EVENTS["unit",], EVENTS["in",], (EVENTS["out", _NO], EVENTS["out", _YES])
START = 0


def case_of(text: str) -> int:
    """0: mixed, 1: small letters only, 2: capitals only (judged on texts with 20 cased letters or more)."""
    low, up = text.upper() != text, text.lower() != text
    if low and up:
        return 0
    return 0 if sum(c.isalpha() and c.upper() != c.lower() for c in text) < 20 else 1 if low else 2


def _starts(text: str, at: int, case: int) -> tuple[bool, bool]:
    """Whether what follows the white space at ``at`` begins a sentence; whether case told so."""
    at = _HEAD.match(text, at).end()
    if at >= len(text):
        return True, True
    c = text[at]
    if c.isspace():
        return True, False
    if c.isalpha() and c.lower() != c.upper():
        if case:
            return True, False
        if c.isupper() or c.istitle():
            return True, True
        word = _LETTERS.match(text, at).group()
        return word.lower() != word, True
    return (c not in ",;:.!?…%)]»”，、：；"), c.isdigit()


def _right(text: str, after: int, case: int) -> str:
    """Class of what follows the white space at ``after``."""
    at = _skip(text, after)
    start, told = _starts(text, at, case)
    if not start:
        return "held"
    return "digit" if _digit_after(text, at) else "told" if told else "open"


def _digit_after(text: str, at: int) -> bool:
    at = _HEAD.match(text, at).end()
    return text[at : at + 1].isdigit()


def _left(text: str, i: int, case: int) -> str:
    """Class of the token that ends before the full stop at ``i``."""
    m = _TOKEN_END.search(text, max(0, i - 60), i)
    token = m.group().lstrip("'*_") if m else ""
    if not token:
        return "none"
    if "ऀ" <= token[-1] <= "ॿ":
        return "indic"
    low = token.lower()
    if low in NEVER:
        return "never"
    if low in BEFORE_NUMBER:
        return "letter_before_number" if len(low) == 1 else "before_number"
    if low in OFTEN_END:
        return "often_end"
    single, digits = len(token) == 1 and token.isalpha(), token.isdigit()
    if single or digits:
        start = i - len(m.group())
        before = _TOKEN_END.search(text[max(0, start - 40) : start].rstrip())
        before = before.group() if before else ""
        if single:
            if low in ("д", "п") and before.lower() == "т.":
                return "often_end"
            if re.fullmatch(r"\d+(?:[.,]\d+)*", before) is None:
                return "initial"
            return "unit" if token.islower() else "capital_unit"
        if len(token) <= 3:
            line = text.rfind("\n", max(0, i - 200), i)
            if (line >= 0 or i <= 200) and not text[line + 1 : i - len(token)].strip() and (line < 0 or not text[max(0, line - 200) : line].strip() or _BLANK_LINE.search(text, max(0, line - 40), i)):
                return "list_number"
            if before.lower() in ORDINAL_AFTER:
                return "ordinal"
    elif _DOTTED.fullmatch(token):
        return "dotted"
    return "word"


def _skip(text: str, at: int) -> int:
    n = len(text)
    while at < n and text[at].isspace():
        at += 1
    return at


def _no_space(text: str, i: int, j: int, case: int) -> bool:
    """A mark with no white space after it that ends a sentence all the same: ``maintains.The index``."""
    if case or not _NO_SPACE_START.match(text, j):
        return False
    if text[i] != ".":
        return True
    m = _TOKEN_END.search(text, max(0, i - 200), i)
    token = m.group() if m else ""
    if "/" in token and (":/" in token or "www" in token):
        return False
    tail = re.search(r"[^\W_]+\)?$", token)
    if token[-1:] == ")" or text[i - 1 : i] in ")]»”":
        return True
    if not tail or len(tail.group()) < 2 or tail.group().lower() in NEVER | BEFORE_NUMBER | OFTEN_END:
        return False
    return tail.group().isdigit() or (tail.group() != tail.group().upper()) or ":" in token


def _ended(text: str, at: int, floor: int) -> bool:
    """Whether a mark stands right before the closing quotation or bracket at ``at``."""
    k = at
    while k > floor and (text[k - 1] in "\"”’'»」』）)]*_" or (text[at] == "»" and text[k - 1].isspace())):
        k -= 1
    if k <= floor or text[k - 1] not in _TERMS or text[k - 1] in ";\u037e":
        return False
    if text[k - 1] == "." and text[at] in _PARENS_CLOSE:
        m = _TOKEN_END.search(text, max(0, k - 61), k - 1)
        return not (m and m.group().lower() in NEVER | BEFORE_NUMBER | OFTEN_END)
    return True


def _closing(text: str, at: int, case: int) -> int:
    """How the closing quotation at ``at``, with a mark before it, may end the sentence."""
    after = _TAIL.match(text, at + 1).end()
    if after >= len(text):
        return _YES
    if text[after].isspace():
        start, by_case = _starts(text, _skip(text, after), case)
        return _NO if not start else _YES if by_case else _LED
    if text[after] in ",;:，、：；.!?。！？…":
        return _NO
    c = text[after]
    if c.isalpha() and c.lower() != c.upper() and not _is_cjk(text[max(0, at - 2) : at]):
        return _YES if c.isupper() and not case and _NO_SPACE_START.match(text, after) else _NO
    return _LED


def _is_cjk(s: str) -> bool:
    return any("　" <= c <= "鿿" or "！" <= c <= "｠" for c in s)


def _closers(text: str) -> str:
    """The closing quotations and brackets that occur in a text."""
    return "".join(c for c in _CLOSING if c in text)


def events(text: str, case: int, lo: int = 0, hi: int | None = None, ahead: str = "") -> list[tuple[int, int]]:
    """(event, cut) for marks between ``lo`` and ``hi``; the cut is where a sentence would end.

    ``ahead``: the closing marks behind ``hi`` that lie in the unit open there.
    """
    hi = len(text) if hi is None else hi
    out: list[tuple[int, int]] = []
    E, thai = EVENTS, bool(_THAI.search(text))
    n = len(text)
    blanks = [m.start() for m in _BLANK_LINE.finditer(text, lo, hi)]
    last: dict[str, int] = {}  # of each closing mark in the unit at hand
    unit_end, bi = -1, 0

    def closed(marks: str, i: int) -> bool:
        nonlocal unit_end, bi
        while unit_end <= i:
            unit_end = blanks[bi] if bi < len(blanks) else hi + 1
            bi += 1
            last.clear()
        for c in marks:
            if c not in last:
                last[c] = n if unit_end > hi and c in ahead else text.rfind(c, i + 1, min(unit_end, hi))
            if last[c] > i:
                return True
        return False

    for m in (_EVENT_THAI if thai else _EVENT).finditer(text, lo):
        i, j = m.span()
        if i >= hi:
            break
        c = text[i]
        if c.isspace():
            if len(_BREAK.findall(m.group())) > 1:
                out.append((_UNIT, i))
            elif thai and i and j < n:
                a, b = re.search(r"\S*$", text[max(0, i - 80) : i]).group(), re.match(r"\S{0,80}", text[j : j + 80]).group()
                if _THAI.search(a) or _THAI.search(b):
                    out.append((E["end",], i))
        elif c in _TERMS:
            after = _TAIL.match(text, j).end()
            mark = m.group()
            symbol = None
            if after >= n or any(x in _CJK_TERMS for x in mark):
                symbol = ("end",)
            elif mark.strip(";\u037e") == "":
                if text[after].isspace() and i and "Ͱ" <= text[i - 1] <= "῿":
                    symbol = ("mark", _right(text, after, case))
            elif text[after].isspace():
                if mark == ".":
                    right = _right(text, after, case)
                    symbol = ("stop", "word" if right == "held" else _left(text, i, case), right, case)
                elif mark.strip(".…") == "":
                    symbol = ("dots", _right(text, after, case), _is_cjk(text[max(0, i - 1) : i]), case)
                else:
                    symbol = ("mark", _right(text, after, case))
            elif mark.strip(_ALWAYS) == "" or ((mark == "." or mark.strip("!?") == "") and after == j and _no_space(text, i, j, case)):
                symbol = ("end",)
            if symbol is not None:
                out.append((E[symbol], after))
        else:
            how = lambda: _closing(text, i, case) if _ended(text, i, max(0, i - 60)) else _NO
            led = lambda: int(re.search(r"[:：,，]\s*$", text[max(0, i - 4) : i]) is not None)
            cut = _TAIL.match(text, i + 1).end()
            if c == '"':
                left, right = i == 0 or text[i - 1].isspace() or text[i - 1] in "(（[:：", i + 1 < n and not text[i + 1].isspace()
                if left and right:
                    if closed('"', i):
                        out.append((E["open", 1, led()], i))
                else:
                    out.append((E["close", 1, how()], cut))
            elif c == "“":
                out.append((E["high", led() if closed("”", i) else None, how()], cut))
            elif c in _OPEN_OF:
                t = _OPEN_OF[c]
                if closed(_CLOSER[t], i):
                    out.append((E["open", t, led()], i))
            elif c == "”":
                out.append((E["close", 2, how()], cut))
                out.append((E["close", 3, how()], cut))
            elif c in _CLOSE_OF:
                out.append((E["close", _CLOSE_OF[c], how()], cut))
            elif c in _PARENS_OPEN:
                if closed(_PARENS_CLOSE[_PARENS_OPEN.index(c)], i):
                    out.append((_IN, i))
            else:
                ends = _ended(text, i, max(0, i - 60)) and (cut >= n or (text[cut].isspace() and _starts(text, _skip(text, cut), case)[0]) or (_is_cjk(text[i]) and not text[cut].isspace()) or _no_space(text, i, cut, case))
                out.append((E["out", _YES if ends else _NO], cut))
    return out


#: A transition function: where each state leads, and the brackets open after, max(before + a, b) with (a, b), or b where a unit ended (a is null).
Function = tuple[list[int], int | None, int]


def transition(found: list[tuple[int, int]]) -> Function:
    """The state-transition function of a run of events."""
    at = np.arange(len(_DELTA), dtype=np.int8)
    a: int | None = 0
    b = 0
    for e, _ in found:
        at = DELTA[at, e]
        if e == _UNIT:
            a, b = None, 0
        elif e == _IN:
            a, b = a if a is None else a + 1, b + 1
        elif e in _OUT:
            a, b = a if a is None else a - 1, max(0, b - 1)
    return at.tolist(), a, b


def then(f: Function, g: Function) -> Function:
    """``f``, then ``g``."""
    to = [g[0][s] for s in f[0]]
    if g[1] is None:
        return to, None, g[2]
    return to, None if f[1] is None else f[1] + g[1], max(f[2] + g[1], g[2])


def compose(functions: list[Function]) -> list[Function]:
    """Inclusive prefix scan of transition functions, in log steps."""
    scan, step = list(functions), 1
    while step < len(scan):
        scan = [scan[k] if k < step else then(scan[k - step], scan[k]) for k in range(len(scan))]
        step *= 2
    return scan


def entries(functions: list[Function]) -> list[tuple[int, int]]:
    """(state, brackets open) at the start of each chunk."""
    scan = compose(functions)[:-1]
    return [(START, 0), *((f[0][START], f[2] if f[1] is None else max(f[1], f[2])) for f in scan)]


def cuts(found: list[tuple[int, int]], state: int = START, depth: int = 0) -> list[int]:
    out: list[int] = []
    for e, cut in found:
        if _EMIT[state][e][min(depth, 2)]:
            out.append(cut)
        state = _DELTA[state][e]
        if e == _UNIT:
            depth = 0
        elif e == _IN:
            depth += 1
        elif e in _OUT and depth:
            depth -= 1
    return out


def spans(text: str, at: list[int], lo: int = 0, hi: int | None = None) -> list[tuple[int, int, bool]]:
    """(begin, end, new) of the pieces between the cuts, without white space around them; ``new``: a cut stands before it.
    A cut behind the last piece is told by an empty piece."""
    out, begin, new, hi = [], lo, False, len(text) if hi is None else hi
    for end in [*sorted(set(at)), hi]:
        piece = text[begin:end]
        body = piece.strip()
        if body:
            b = begin + len(piece) - len(piece.lstrip())
            out.append((b, b + len(body), new))
            new = False
        if end != hi or end in at:
            new = True
        begin = max(begin, end)
    if new:
        out.append((hi, hi, True))
    return out


def chunks_of(text: str, size: int) -> list[tuple[int, int, str]]:
    """(start, end, closing marks ahead) of the chunks of a text."""
    starts = chunk_starts(text, size)
    bounds = list(zip(starts, [*starts[1:], len(text)]))
    out, ahead = [], ""
    for a, b in reversed(bounds):
        out.append((a, b, ahead))
        blank = _BLANK_LINE.search(text, a, b)
        own = _closers(text[a : blank.start() if blank else b])
        ahead = own if blank else "".join(set(own) | set(ahead))
    return out[::-1]


def sentences(text: str | None, size: int = CHUNK_CHARS) -> list[tuple[int, int]]:
    if not text or not text.strip():
        return []
    case, parts = case_of(text), chunks_of(text, size)
    found = [events(text, case, a, b, ahead) for a, b, ahead in parts]
    starts = entries([transition(f) for f in found]) if len(parts) > 1 else [(START, 0)]
    at = [c for f, (state, depth) in zip(found, starts) for c in cuts(f, state, depth)]
    return [(b, e) for b, e, _ in spans(text, at) if b < e]


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pandas as pd

    for pdf in batches:
        ids, no, begin, end = [], [], [], []
        for doc, text in zip(pdf["_id"], pdf["_text"]):
            for k, (b, e) in enumerate(sentences(text)):
                ids.append(doc), no.append(k), begin.append(b), end.append(e)
        yield pd.DataFrame({"_id": pd.Series(ids, dtype=pdf["_id"].dtype), "sent_no": np.array(no, np.int32), "begin_pos": np.array(begin, np.int32), "end_pos": np.array(end, np.int32)})


_SPACE_BORDER = re.compile(r"\s[^\s»]")
_LETTER_BORDER = re.compile(r"[^\W_][^\W_]")


def chunk_starts(text: str, size: int) -> list[int]:
    """Starts of chunks, where no mark before them can have its tail of closing marks behind them: after white space, else
    between two letters, and not inside mark-up. Where there is no such place the chunk is longer."""
    out, at = [0], size
    while at < len(text):
        place = None
        for border, end in ((_SPACE_BORDER, at + size), (_LETTER_BORDER, len(text))):
            for m in border.finditer(text, at, min(len(text), end)):
                here = m.start() + 1
                opened = text.rfind("<", max(0, here - _CONTEXT), here)
                if opened < 0 or text.find(">", opened, here) >= 0:
                    place = here
                    break
            if place:
                break
        if place is None:
            break
        out.append(place)
        at = place + size
    return out


def _splitter(size: int):
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        for pdf in batches:
            for doc, text in zip(pdf["_id"], pdf["_text"]):
                case, rows = case_of(text), []
                for k, (a, b, ahead) in enumerate(chunks_of(text, size)):
                    left = max(0, a - _CONTEXT)
                    rows.append((doc, k, case, left, a - left, b - left, ahead, text[left : b + _CONTEXT]))
                yield pd.DataFrame(rows, columns=["_id", "chunk", "letter_case", "base", "lo", "hi", "ahead", "piece"])

    return split


def _chunk_events(row) -> list[tuple[int, int]]:
    return events(row.piece, row.letter_case, row.lo, row.hi, row.ahead)


def _functions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pandas as pd

    for pdf in batches:
        rows = []
        for r in pdf.rename(columns={"_id": "doc"}).itertuples(index=False):
            to, a, b = transition(_chunk_events(r))
            rows.append((r.doc, r.chunk, to, a, b))
        yield pd.DataFrame({"_id": [r[0] for r in rows], "chunk": [r[1] for r in rows], "f": [r[2] for r in rows], "a": pd.array([r[3] for r in rows], "Int64"), "b": [r[4] for r in rows]})


def _emit_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pandas as pd

    for pdf in batches:
        rows = []
        for r in pdf.rename(columns={"_id": "doc"}).itertuples(index=False):
            at = cuts(_chunk_events(r), int(r.state), int(r.depth))
            rows += [(r.doc, r.chunk, k, r.base + b, r.base + e, int(new)) for k, (b, e, new) in enumerate(spans(r.piece, at, r.lo, r.hi))]
        yield pd.DataFrame(rows, columns=["_id", "chunk", "k", "b", "e", "fresh"])


def _long(docs: DataFrame, chunk_chars: int, id_type: str) -> DataFrame:
    """Sentences of long texts. Chunks go to all tasks; only their transition functions (a few dozen bytes a chunk) are
    gathered per text, and places of pieces, never text, are put together to sentences."""
    spread = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chunks = docs.mapInPandas(_splitter(chunk_chars), f"_id {id_type}, chunk long, letter_case int, base long, lo long, hi long, ahead string, piece string").repartition(spread, "_id", "chunk")
    fs = chunks.mapInPandas(_functions, f"_id {id_type}, chunk long, f array<int>, a long, b long")
    listed = fs.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "f", "a", "b"))).alias("fs"))

    @F.udf("array<struct<state: int, depth: long>>", useArrow=True)
    def entry_states(fs):
        return [(int(s), int(d)) for s, d in entries([([int(x) for x in f["f"]], None if f["a"] is None else int(f["a"]), int(f["b"])) for f in fs])]

    states = listed.select("_id", F.posexplode(entry_states("fs")).alias("chunk", "s")).select("_id", F.col("chunk").cast("bigint").alias("chunk"), "s.state", "s.depth")
    pieces = chunks.join(states, ["_id", "chunk"]).mapInPandas(_emit_chunks, f"_id {id_type}, chunk long, k int, b long, e long, fresh int")
    order = Window.partitionBy("_id").orderBy("chunk", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = pieces.withColumn("s", F.sum("fresh").over(order)).where("b < e").groupBy("_id", "s").agg(F.min("b").alias("b"), F.max("e").alias("e"))
    number = F.row_number().over(Window.partitionBy("_id").orderBy("b")) - 1
    return whole.select("_id", number.alias("sent_no"), F.col("b").cast("int").alias("begin_pos"), F.col("e").cast("int").alias("end_pos"))


def split_sentences(docs: DataFrame, key: str, text: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """key, sent_no (from 0), begin_pos, end_pos (code points, end exclusive): one row per sentence.

    Null and blank texts have none. Repeated rows give repeated sentences. Columns other than the two are
    ignored. The key must be unique among texts longer than ``chunk_chars``.
    """
    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    short = rows.where(F.length("_text") <= chunk_chars).mapInPandas(_read, f"_id {id_type}, sent_no int, begin_pos int, end_pos int")
    # which texts are long shows in the plan's own scan: nothing is read before the query runs
    out = short.unionByName(_long(rows.where(F.length("_text") > chunk_chars), chunk_chars, id_type))
    return out.withColumnRenamed("_id", key)
