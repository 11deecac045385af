r"""Personal information in free text, found and replaced by typed placeholders.

Method. A semi-Markov conditional random field. Candidate segments of each kind (e-mail address, phone number, identity
number, street address, name of a person) are all runs of at most MAX_TOKENS tokens about an anchor of the kind: an
at-sign, a number, a word for a street, a word that is or may be a name. A segment is scored by features of the segment as
a whole (its layout, the classes of its words, its length) and of its neighbourhood, and a pair of neighbouring segments
by their kinds. Dynamic programming over the boundaries of the segments chooses the best set that does not overlap,
boundaries and kinds jointly; a token outside of all segments scores nothing. The weights are trained by gradient ascent
on the exact conditional likelihood, with the partition sum from the same lattice, over sentences that
`training_examples` makes from a seed and the name list. A word counts as a name by the list, by an ending that several
listed names share, or, unlisted, by what stands before it, by a title, or as one of several words in capitals.

Null gives null, an empty text stays empty, texts are read whole. Tokens have any length, so no address is cut. Repeated
rows count once. Overlapping readings: the better scored wins. Text outside of segments is kept as it is.
"""

from __future__ import annotations

import functools
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.llm import lexicon as L

KINDS = ("email", "phone", "id_number", "address", "person")
#: Tokens of a segment, at most; words of a name; words before a segment that may say what it is.
MAX_TOKENS, MAX_NAME, CUE_WORDS = 16, 4, 5
#: Neighbouring segments are this near or have no influence on each other.
NEAR = 12

_CJK = "぀-ヿ㐀-鿿가-힯"
_WORD = re.compile(rf"[^\W\d_{_CJK}]+(?:[’'ʼ-](?![sS]\b)[^\W\d_{_CJK}]+)*|[{_CJK}]+")
_NUMBER = re.compile(r"(?:tel:)?[+(]?(?:[A-Z]{1,3}[ -]|[A-Z]{1,5})?\d(?:[ .()/ –-]{0,3}[0-9A-Z])+")
_GROUP = re.compile(r"[0-9A-Z]+")
_AT = re.compile(r" ?[(\[{] ?at ?[)\]}] ?|@", re.I)
_DOT = r"(?:\.| ?[(\[{] ?dot ?[)\]}] ?)"
_LOCAL_END = re.compile(r"[\w%+-](?:[\w.%+-]*[\w%+-])?\Z", re.A)
_LABEL = re.compile(rf"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?|{_DOT}", re.I)
_TOKEN = re.compile(rf"\d+[A-Za-z]?(?:[/-]\d+[A-Za-z]?)?(?![^\W_{_CJK}])|[^\W\d_{_CJK}]+(?:[’'-][^\W\d_{_CJK}]+)*|[^\w\s]|\w")
_HAN_STREET = re.compile(r"(?:路|街|大道|巷|胡同|弄)\d+(?:-\d+)?号(?:\d+(?:号楼|楼|单元|室|层))*")
_JA_STREET = re.compile(r"\d+丁目(?:\d+番地?|\d+[-−‐])?(?:\d+号?)?|\d+[-−‐]\d+(?:[-−‐]\d+)?")
_CJK_BEFORE = (
    ("name", re.compile(r"(?:我叫|我是|姓名|联系人|名字是|名叫|私は|私の名前は|名前は|氏名|担当は|担当者は|連絡先は?)[:： 　]*\Z")),
    ("phone", re.compile(r"(?:电话|手机|手机号|電話|電話番号|携帯|携帯番号|联系方式|连絡先)[号码は是为：: 　]*\Z")),
    ("id", re.compile(r"(?:身份证|护照|驾照|驾驶证|税号|旅券|パスポート|免許証|マイナンバー|証明書)[号码番号はの是为：: 　]*\Z")),
    ("place", re.compile(r"(?:地址|住址|住在|家住|寄到|住所|自宅|届け先)[はにを是为：: 　]*\Z")),
    ("count", re.compile(r"(?:订单|版本|工单|序号|行号|注文|バージョン|行番号|チケット)[号码番号は是：: 　]*\Z")),
)
_CJK_NAME_END = re.compile(r"さん|様|先生|女士|小姐|氏")

Span = tuple[int, int, str, tuple[str, ...]]


class Names:
    """Known names, endings that mark a word as like a name, and the class of any word."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.given = {n.lower() for n, k in rows if k == "given"}
        self.family = {n.lower() for n, k in rows if k == "family"}
        self.ends = {}
        for kind, names in (("f", self.family), ("g", self.given)):
            for e, n in Counter(x[-4:] for x in names if len(x) >= 6).items():
                if n >= 4:
                    self.ends.setdefault(e, kind)
        self.classes: dict[str, str] = {}

    def kind(self, word: str) -> str:
        """F, G known; f, g by ending; empty otherwise."""
        w = word.lower()
        if w in self.family:
            return "F"
        if w in self.given:
            return "G"
        return self.ends.get(w[-4:], "") if len(w) >= 5 else ""

    def of(self, word: str) -> str:
        """One letter: F G f g names, T title, P particle, I initial, q a word before names, S street, C and U in capitals,
        Z of a script without capitals, l any other."""
        c = self.classes.get(word)
        if c is None:
            if len(self.classes) > 200_000:
                self.classes.clear()
            c = self.classes[word] = self._class(word)
        return c

    def _class(self, word: str) -> str:
        low = word.lower()
        if "぀" <= word[0] <= "힯":
            return "Z"
        if k := self.kind(word):
            return k
        if low in L.TITLES and (word[0].isupper() or len(word) > 3):
            return "T"
        if low in L.PARTICLES and word == low:
            return "P"
        if len(word) == 1:
            return "I" if word.isupper() else "l"
        if low in L.PERSON:
            return "q"
        if low in L.STREETS or low.endswith(L.STREET_ENDS) and len(low) > 6 and word[0].isupper():
            return "S"
        if low in L.COMMON:
            return "l"
        return "U" if word.isupper() else "C" if word[0].isupper() else "l"


_CORE = re.compile(r"[FGfg]|(?<=T)[CU]|(?<=[qP])C|(?<=ql)C|C(?=[CP])|(?<=I)C|(?<=C)C")


class _Text:
    """A text with its words, found once."""

    def __init__(self, text: str, names: Names):
        self.text = text
        self.words = [m.span() for m in _WORD.finditer(text)]
        said = [text[a:b] for a, b in self.words]
        self.classes = "".join(map(names.of, said))
        self.said = said
        self.ends = [b for _, b in self.words]
        self._low: set[str] | None = None

    @property
    def low(self) -> set[str]:
        """The words that also stand in small letters."""
        if self._low is None:
            self._low = {w for w in self.said if w[0].islower()}
        return self._low

    def cue(self, at: int) -> str:
        """What the words before a position say, the nearest first."""
        i, edge = bisect_right(self.ends, at) - 1, at
        for j in range(i, max(-1, i - CUE_WORDS), -1):
            a, b = self.words[j]
            gap = self.text[b:edge]
            if "\n" in gap or len(gap) > 8 or any(x + " " in gap for x in ".!?;"):
                break
            w = self.said[j]
            if self.classes[j] == "Z":
                got = next((k for k, p in _CJK_BEFORE if p.search(w)), None)
                if got:
                    return got
                edge = a
                continue
            low = w.lower()
            if low in L.PHONE:
                return "phone"
            if low in L.IDENTITY:
                return "id"
            if low in L.COUNTED:
                return "count"
            if low in L.PLACE:
                return "place"
            if low in ("id", "number", "code"):
                return "label" if not self.text[b:at].strip(" :#=") else "far_label"
            edge = a
        return "none"


def _edge(c: str) -> str:
    if not c:
        return "end"
    if c in "\n\r":
        return "line"
    if c.isspace():
        return "space"
    if c.isdigit():
        return "digit"
    if c.isalpha():
        return "cjk" if c >= "぀" else "letter"
    return c if c in "@:/.-_=+#%" else "punct"


def propose(text: str, names: Names) -> list[Span]:
    """(start, end, kind, features) of all candidate segments."""
    out: dict[tuple[int, int, str], tuple[str, ...]] = {}
    t = _Text(text, names)
    if "@" in text or "at)" in text or "at]" in text or "AT)" in text or "at }" in text or "at )" in text:
        _mails(t, out)
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() >= 6:
            _numbers(t, m.start(), m.end(), out)
    if "S" in t.classes:
        for i, c in enumerate(t.classes):
            a, b = t.words[i]
            if c == "S" and not text[a - 1 : a].isdigit() and not text[b : b + 1].isdigit():
                _addresses(t, i, out)
    if "Z" in t.classes:
        _east(t, out)
    seen: set[int] = set()
    for m in _CORE.finditer(t.classes):
        _people(t, m.start(), names, out, seen)
    return [(a, b, k, f) for (a, b, k), f in out.items()]


def _mails(t: _Text, out: dict) -> None:
    text = t.text
    for m in _AT.finditer(text):
        left = m.start()
        while left and (text[left - 1].isascii() and text[left - 1].isalnum() or text[left - 1] in "_.%+-"):
            left -= 1
        local = _LOCAL_END.search(text, left, m.start())
        if not local:
            continue
        a, at, labels, dots, size = local.start(), m.end(), 0, 0, 2
        while size < MAX_TOKENS:
            x = _LABEL.match(text, at)
            if not x:
                break
            if x.group()[0].isalnum():
                labels += 1
            elif labels == dots:
                break
            else:
                dots += 1
                at = x.end()
                continue
            at, size = x.end(), size + 1
            if labels < 2:
                continue
            last = x.group()
            after = text[at : at + 1]
            more = _LABEL.match(text, at)
            f = (
                "plain" if m.group() == "@" else "spelled", "after:" + (_edge(after) if after != "." or text[at + 1 : at + 2].isalnum() else "stop"), "git" if local.group().lower() == "git" else "user", f"labels:{min(labels, 5)}",
                "top:" + ("digits" if last.isdigit() else "mixed" if not last.isalpha() else "short" if len(last) < 2 else "word" if len(last) < 14 else "long"), "version" if text[m.end() : m.end() + 1].isdigit() else "name",
                "path" if re.match(r":[\w~/]", text[at : at + 2]) or after == "/" else "no_path", "more" if more and (more.group().strip() == "." or "ot" in more.group()) and _LABEL.match(text, more.end()) else "whole",
            )
            out[a, at, "email"] = f


_MASK = str.maketrans("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "9" * 10 + "A" * 26)


def _numbers(t: _Text, a: int, b: int, out: dict) -> None:
    text = t.text
    if sum(c.isdigit() for c in text[a:b]) < 4:
        return
    groups = [m.span() for m in _GROUP.finditer(text, a, b)]
    cues: dict[int, str] = {}
    if text.startswith("tel:", a):
        groups = [g for g in groups if g[0] >= a + 4]
    for i, (s, _) in enumerate(groups):
        for s0 in (s, s - 1):
            if s0 < s and (s0 < a or text[s0] not in "+("):
                continue
            if s0 == s and s > a and text[s - 1] == "+":
                continue
            if s0 < s and text[s0] == "(" and s0 > a and text[s0 - 1] == "+":
                continue
            for j in range(i, min(len(groups), i + MAX_TOKENS)):
                e = groups[j][1]
                if text[e : e + 1] == ")" and "(" in text[s0:e] and ")" not in text[s0:e]:
                    if j == len(groups) - 1 or j == i:
                        continue
                piece = text[s0:e]
                if text[groups[j][0] : e].isalpha() and e - groups[j][0] > 3:
                    break
                if piece.count("(") != piece.count(")"):
                    continue
                digits = sum(map(str.isdigit, piece))
                if not 4 <= digits <= 20 or digits < 6 and (j > i or len(piece) < 8):
                    continue
                if j > i and text[groups[j][0] : e].isalpha() and e - groups[j][0] > 1 and text[groups[j][0] - 1].isspace():
                    continue  # a word after a number
                if s0 not in cues:
                    cues[s0] = t.cue(s0)
                mask = piece.translate(_MASK)
                left, right = _edge(text[s0 - 1 : s0]) if s0 else "end", _edge(text[e : e + 1])
                if left == "+":
                    left = "sign"
                if left in ("digit", "letter") and s0 > 0 or right in ("digit", "letter"):
                    continue
                if right in (".", "-", ":", "/") and not text[e + 1 : e + 2].isalnum():
                    right = "punct"
                if left in (".", "-", ":", "/") and not (s0 > 1 and text[s0 - 2].isalnum()):
                    left = "punct"
                part = ("more" if j < len(groups) - 1 else "") + ("before" if i else "") or "whole"
                start = s0 - 4 if text[max(0, s0 - 4) : s0].lower() == "tel:" else s0
                link = "tel" if start < s0 else "no_tel"
                for kind, f in zip(("phone", "id_number"), _number_features(mask, cues[s0], left, right, part, digits, link), strict=True):
                    if kind == "id_number" or "A" not in mask:  # no letters in a phone number
                        out[start if kind == "phone" else s0, e, kind] = f


@functools.lru_cache(maxsize=50_000)
def _number_features(mask: str, cue: str, left: str, right: str, part: str, digits: int, link: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    sizes = [len(x) for x in _GROUP.findall(mask)]
    first = "+" if mask[0] == "+" else "(" if mask[0] == "(" else "A" if mask[0] == "A" else "9"
    seps = "".join(sorted(set(re.sub(r"[9A]", "", mask.lstrip("+(")))))
    letters = mask.count("A")
    where = "none" if not letters else "first" if mask.rstrip("9 .-")[-1] == "A" and "9" not in mask.rstrip("9 .-") else "last" if mask.lstrip("9 .-")[0] == "A" and "9" not in mask.lstrip("9 .-") else "mixed"
    shape = "-".join(map(str, sizes))
    known = cue if cue in ("phone", "id", "count", "label", "far_label") else "none"
    base = [f"first:{first}", f"digits:{min(digits, 16)}", f"groups:{min(len(sizes), 8)}", f"seps:{seps}", f"letters:{where}:{min(letters, 4)}", f"cue:{known}", f"left:{left}", f"right:{right}", f"part:{part}", f"cue:{known}:{part}"]
    single = max(sizes) >= digits
    phone = (*base, f"shape:{first}{shape}:{seps}", f"cue:{known}:{first}:{'one' if single else 'many'}", f"{first}:{digits}", link, f"big:{max(sizes) > 7 and first != '+'}", f"letters:{letters > 0}:{first}")
    ident = (*base, f"mask:{mask if len(mask) < 24 else 'long'}", f"cue:{known}:{where}", f"cue:{known}:{'one' if single else 'many'}", f"mask:{mask if len(mask) < 24 else 'long'}:{known != 'count'}", f"one:{single}:{where}:{digits}")
    return phone, ident


def _token_class(w: str) -> str:
    if w[0].isdigit():
        return "N"
    low = w.lower()
    if low in L.STREETS:
        return "S"
    if low in L.UNITS:
        return "U"
    if not w[0].isalpha():
        return "," if w == "," else "." if w in ".:" else "º" if w in "ºª°" else "x"
    if low.endswith(L.STREET_ENDS) and len(low) > 6 and w[0].isupper():
        return "S"
    if low in L.PARTICLES and w == low:
        return "P"
    return "W" if w[0].isupper() and low not in L.COMMON else "w"


def _addresses(t: _Text, i: int, out: dict) -> None:
    """All runs of tokens about a word for a street that hold a number; they end at lines and at odd signs."""
    text, half = t.text, MAX_TOKENS // 2
    lo = t.words[max(0, i - half)][0]
    mid = t.words[i][0]
    line = text.rfind("\n", lo, mid)
    lo = line + 1 if line >= 0 else lo
    if lo:  # a number before the first word
        head = re.search(r"(?<![\w.,-])\d+[A-Za-z]?(?:[/-]\d+)?(?:,? )?\Z", text[max(0, lo - 12) : lo])
        lo = lo - len(head.group()) if head else lo
    toks: list[tuple[int, int, str]] = []
    at, hub, after = lo, -1, 0
    while after < MAX_TOKENS:
        m = _TOKEN.search(text, at)
        if not m or "\n" in text[at : m.start()] or m.start() - at > 2:
            break
        c = _token_class(m.group())
        if c == "." and toks and toks[-1][2] in "wN":
            c = "x"  # the end of a sentence
        if c == "x" or m.group()[0] >= "぀":
            if m.start() >= mid:
                break
            toks, hub = [], -1
        else:
            toks.append((m.start(), m.end(), c))
            if m.start() == mid:
                hub = len(toks) - 1
        after += m.start() >= mid
        at = m.end()
    if hub < 0 or not any(c == "N" for _, _, c in toks):
        return
    word = text[toks[hub][0] : toks[hub][1]]
    joined = word.lower() not in L.STREETS
    for s in range(max(0, hub - half), hub + 1):
        if toks[s][2] not in "NSUW" or s and toks[s][2] == "W" and hub == s:
            continue
        for e in range(hub, min(len(toks), s + MAX_TOKENS)):
            kinds = "".join(c for _, _, c in toks[s : e + 1])
            if kinds[-1] in ",Pw" or "N" not in kinds or kinds[-1] == "U" and kinds[-2:-1] != "N":
                continue
            if kinds[-1] == "." and toks[e - 1][2] not in "SU":
                continue
            a, b = toks[s][0], toks[e][1]
            prev = text[a - 1 : a]
            if prev and (prev.isalnum() and prev < "぀" or prev in "@_/\\"):
                continue
            body = re.sub(r"([Ww])\1+", r"\1\1", kinds)
            nxt = toks[e + 1][2] if e + 1 < len(toks) and toks[e + 1][0] - b <= 1 else "end"
            if nxt == "," and e + 2 < len(toks):
                nxt += toks[e + 2][2]
            cue = t.cue(a)
            numbers = [text[x:y] for x, y, c in toks[s : e + 1] if c == "N"]
            zipped = any(4 <= len(n) <= 6 for n in numbers)
            before = toks[s - 1][2] if s and a - toks[s - 1][1] <= 1 else "start"
            core = re.sub(r"[,.º]", "", body)
            small = any(c == "w" for c in kinds)
            lang = "joined" if joined else word.lower()
            name_near = hub > s and toks[hub - 1][2] in "WP" and s < hub or hub < e and toks[hub + 1][2] in "WP.N"
            f = (
                f"layout:{core[:9]}", f"first:{kinds[:2]}", f"last:{kinds[-2:]}", f"next:{nxt}", f"last:{kinds[-1]}:{nxt}", f"cue:{'place' if cue == 'place' else 'none'}", f"small:{small}:{cue == 'place'}", f"zip:{zipped}", f"n:{min(len(kinds), 10)}", f"before:{before}",
                f"word:{lang}", f"word:{lang}:{small}", f"commas:{kinds.count(',')}", f"near:{bool(name_near)}", f"numbers:{min(len(numbers), 4)}", f"low:{word[0].islower()}:{core[0]}", f"ends:{nxt in ('end', 'x', '.')}", f"smalls:{min(kinds.count('w'), 3)}",
            )
            out[a, b, "address"] = f


def _east(t: _Text, out: dict) -> None:
    """Names and addresses in scripts without spaces: runs of signs up to the sign that marks them."""
    text = t.text
    if "号" in text:
        _east_address(t, _HAN_STREET, "省市区县镇", "zh", out)
    if "丁目" in text or any(x in text for x in "市区町村"):
        _east_address(t, _JA_STREET, "都道府県市区町村", "ja", out)
    han = lambda c: "㐀" <= c <= "鿿" or "゠" <= c <= "ヿ"
    for m in _CJK_NAME_END.finditer(text):
        for n in range(2, 7):
            a = m.start() - n
            if a < 0 or not han(text[a]):
                break
            out[a, m.start(), "person"] = ("east", f"n:{n}", "suffix", "prev:" + ("edge" if not a or not han(text[a - 1]) else "run"), "kana" if text[a] <= "ヿ" else "han")
    for m in re.finditer(r"(?:我叫|我是|姓名是?|联系人是?|请联系|谢谢|感谢|名字是|名叫|私は|名前は|氏名は?|担当者?は|連絡先は?)[:： ]*", text):
        at = m.end()
        for n in range(2, 8):
            if at + n > len(text) or not han(text[at + n - 1]):
                break
            nxt = text[at + n : at + n + 1]
            out[at, at + n, "person"] = ("east", f"n:{n}", "cue", "next:" + ("edge" if not nxt or not han(nxt) else "的" if nxt in "的和" else "run"), "kana" if text[at] <= "ヿ" else "han")


def _east_address(t: _Text, p: re.Pattern, admin: str, lang: str, out: dict) -> None:
    text = t.text
    for m in p.finditer(text):
        for n in range(1 if lang == "zh" else 2, MAX_TOKENS + 1):
            a = m.start() - n
            if a < 0 or not "぀" <= text[a] <= "鿿":
                break
            part = text[a : m.start()]
            prev = text[a - 1 : a]
            edge = "edge" if not prev or not "぀" <= prev <= "鿿" else "cue" if prev in "在是址住到はにのを" else "admin" if prev in admin else "run"
            out[a, m.end(), "address"] = ("east", lang, f"edge:{edge}", f"admin:{min(3, sum(part.count(x) for x in admin))}", f"n:{n // 3}", "begins" if part[0] in admin + "在是址住到はにのを" else "name")


_GAP = re.compile(r"(?: {1,2}|, ?|\. ?| ?\n ?)\Z")


def _shape(words: list[str]) -> str:
    if all(w.isupper() for w in words):
        return "upper"
    if all(w.islower() for w in words):
        return "lower"
    return "title" if all(w[0].isupper() for w in words) else "mixed"


def _people(t: _Text, i: int, names: Names, out: dict, seen: set[int]) -> None:
    text, words, cls, n = t.text, t.words, t.classes, len(t.words)
    core = cls[i]
    for a in range(max(0, i - MAX_NAME + 1), i + 1):
        ok = True
        for b in range(a, min(n, a + MAX_NAME)):
            if b > a:
                gap = text[words[b - 1][1] : words[b][0]]
                if not _GAP.match(gap) or gap[0] == "." and cls[b - 1] not in "TI":
                    break
            if cls[b] not in "FGfgTIPCU" and not (cls[b] == "l" and t.said[b].islower() and len(t.said[b]) >= 4):
                ok = False
            if not ok:
                break
            if b < i or a * 1_000_000 + b in seen:
                continue
            seen.add(a * 1_000_000 + b)
            _person(t, a, b, core, out)


def _person(t: _Text, a: int, b: int, core: str, out: dict) -> None:
    text, words = t.text, t.words
    kinds = t.classes[a : b + 1]
    said = t.said[a : b + 1]
    if kinds[-1] in "TP" or kinds[0] == "P" or kinds.count("T") > 1 or "l" in kinds and (not any(k in "FGfg" for k in kinds) or _shape(said) != "lower" or len(said) != 2):
        return
    if any(k == "I" and text[words[a + j][1] : words[a + j][1] + 1] != "." for j, k in enumerate(kinds)):
        return
    s, e = words[a][0], words[b][1]
    gaps = [text[words[k][1] : words[k + 1][0]] for k in range(a, b)]
    commas = sum("," in g for g in gaps)
    if commas > 1 or commas and len(kinds) > 3:
        return
    prev, nxt = text[s - 1 : s] if s else "", text[e : e + 1]
    if prev and (prev.isdigit() or prev in "@_/\\" or prev == "." and s > 1 and text[s - 2].isalnum()) or nxt and nxt in "@_/+\\" or nxt == "." and text[e + 1 : e + 2].isalnum() or nxt.isdigit() or _AT.match(text, e):
        return
    if not any(k in "FGfg" for k in kinds) and "T" not in kinds:
        # unlisted words: a cue before, or several of them
        cue_near = a and t.classes[a - 1] in "qP" or a > 1 and t.classes[a - 2] == "q"
        if not cue_near and len(kinds) < 2 or kinds.count("C") + kinds.count("U") < 1:
            return
    if "l" in kinds and not (a and t.classes[a - 1] in "qP" or a > 1 and t.classes[a - 2] == "q"):
        return
    start = not s or bool(re.search(r"(?:^|[.!?:;|\n\"“(>*-])\s*\Z", text[max(0, s - 4) : s]))
    low = t.low
    plain = sum(w.lower() in low for w, k in zip(said, kinds, strict=True) if k in "FGCfg")
    j, cue = a - 1, "none"
    if j >= 0 and len(text[words[j][1] : s]) <= 4 and "\n" not in text[words[j][1] : s]:
        gap = text[words[j][1] : s]
        c = t.classes[j]
        if c == "Z":
            cue = "q" if _CJK_BEFORE[0][1].search(t.said[j]) else "east"
        elif c == "q":
            cue = ("naming" if t.said[j].lower() in L.NAMING else "q") + (":" if ":" in gap or "=" in gap or "(" in gap else "")
        elif c == "T":
            cue = "title"
        elif j and t.classes[j - 1] == "q" and not any(x in gap for x in ".;!?"):
            cue = "near_naming" if t.said[j - 1].lower() in L.NAMING else "near_q"
        elif not gap.strip() and t.said[j].islower():
            cue = "small"
        elif any(x in gap for x in ",;|("):
            cue = "list"
        elif not gap.strip():
            cue = "capital"
    follow = text[e : e + 2]
    if not follow or follow[0] in "\n\r":
        after = "end"
    elif follow[0].isspace():
        k = b + 1
        near = k < len(words) and words[k][0] - e <= 2
        after = "<" if follow[1:] in ("<", "(") else "street" if near and t.classes[k] == "S" else "capital" if near and t.said[k][0].isupper() else "small" if near else "other"
    else:
        after = follow[0] if follow[0] in ".,:;)|\"'>=" else "east" if follow[0] >= "぀" else "other"
    shape = _shape(said)
    size = len(kinds)
    cap = f"{kinds}:{shape}"
    known = sum(k in "FG" for k in kinds)
    f = [f"shape:{shape}", cap, f"cue:{cue}", f"cue:{cue}:{shape}:{'k' if known else 'u'}", f"cue:{cue}:{size}:{'k' if known else 'u'}", f"after:{after}", f"after:{after}:{size}:{known}", f"start:{start}:{kinds}", f"plain:{plain > 0}:{size}", f"comma:{commas}:{size}", f"n:{size}"]
    f += [f"shape:{shape}:{size}:{cue}", f"{shape}:{size}:{after}", f"alone:{size == 1}:{cue}:{after}"]
    if any("\n" in g for g in gaps):
        f.append("newline")
    out[s, e, "person"] = tuple(f)


def _score(span: Span, w: dict[str, float]) -> float:
    kind = span[2]
    return w.get(kind, 0.0) + sum(w.get(f"{kind}|{f}", 0.0) for f in span[3])


def _scores(spans: list[Span], w: dict[str, float]) -> list[float]:
    get = w.get
    out = []
    for _, _, kind, f in spans:
        key = (kind, f)
        v = _memo.get(key)
        if v is None:
            if len(_memo) > 300_000:
                _memo.clear()
            v = _memo[key] = get(kind, 0.0) + sum(get(f"{kind}|{x}", 0.0) for x in f)
        out.append(v)
    return out


_memo: dict[tuple, float] = {}


def _pull(w: dict[str, float], a: str, b: str) -> float:
    return w.get(f">{a}>{b}", 0.0)


def decode(spans: list[Span], w: dict[str, float], scores: list[float] | None = None) -> list[tuple[int, int, str]]:
    """The best set of spans that do not overlap, with the pull of neighbours on each other."""
    scores = [_score(s, w) for s in spans] if scores is None else scores
    pull = {(a, b): _pull(w, a, b) for a in KINDS for b in KINDS}
    most = max(0.0, *pull.values())
    least = min(0.0, *pull.values())
    # a span that cannot win by itself and all it may gain from neighbours is in no best set
    some = sorted(((s[1], s[0], s[2], v) for s, v in zip(spans, scores, strict=True) if v + 2 * most - least > 0))
    ends = [x[0] for x in some]
    best, came, upto = [], [], []  # of sets that end with span i; of sets within the first i spans
    for i, (_, a, kind, v) in enumerate(some):
        hi, lo = bisect_right(ends, a, 0, i), bisect_left(ends, a - NEAR, 0, i)
        top, at = upto[lo - 1] if lo else (0.0, -1)
        top, at = (top, at) if top > 0 else (0.0, -1)
        for j in range(lo, hi):
            x = best[j] + pull[some[j][2], kind]
            if x > top:
                top, at = x, j
        best.append(top + v)
        came.append(at)
        upto.append(max((best[i], i), upto[-1]) if upto else (best[i], i))
    out = []
    i = upto[-1][1] if upto and upto[-1][0] > 0 else -1
    while i >= 0:
        out.append((some[i][1], some[i][0], some[i][2]))
        i = came[i]
    return out[::-1]


def _marginals(spans: list[Span], sc: list[float], pull: dict[tuple[str, str], float]) -> tuple[list[float], dict[tuple[int, int], float]]:
    """The probability of each span, and of each two near neighbours, by forward and backward sums. Spans by end."""
    n = len(spans)
    ends = [s[1] for s in spans]
    fwd, bwd = [0.0] * n, [0.0] * n  # log sums of all that stands before, and after, a chosen span
    total = [0.0]  # of all sets within the first i spans
    links: list[tuple[int, int]] = []
    for i, (a, _, kind, _) in enumerate(spans):
        hi, lo = bisect_right(ends, a, 0, i), bisect_left(ends, a - NEAR, 0, i)
        terms = [total[lo]]
        for j in range(lo, hi):
            terms.append(fwd[j] + sc[j] + pull[spans[j][2], kind])
            links.append((j, i))
        fwd[i] = _lse(terms)
        total.append(_lse([total[-1], fwd[i] + sc[i]]))
    z = total[-1]
    # after: by starts, from the last
    order = sorted(range(n), key=lambda i: spans[i][0], reverse=True)
    starts = [-spans[i][0] for i in order]
    after = [0.0]
    near: dict[int, list[int]] = {}
    for j, i in links:
        near.setdefault(j, []).append(i)
    done = 0
    for i in order:  # a later start is worked off before it is needed, since it is no earlier than this span's end
        far = bisect_left(starts, -(spans[i][1] + NEAR), 0, done)
        terms = [after[far]]
        linked = set(near.get(i, ()))
        for k in range(far, done):
            o = order[k]
            if spans[o][0] >= spans[i][1]:
                terms.append(bwd[o] + sc[o] + (pull[spans[i][2], spans[o][2]] if o in linked else 0.0))
        bwd[i] = _lse(terms)
        after.append(_lse([after[-1], bwd[i] + sc[i]]))
        done += 1
    prob = [math.exp(min(0.0, fwd[i] + sc[i] + bwd[i] - z)) for i in range(n)]
    both = {(j, i): math.exp(min(0.0, fwd[j] + sc[j] + pull[spans[j][2], spans[i][2]] + sc[i] + bwd[i] - z)) for j, i in links}
    return prob, both


def _lse(x: list[float]) -> float:
    m = max(x)
    return m + math.log(sum(math.exp(v - m) for v in x))


def train(examples: list[tuple[str, list[tuple[int, int, str]]]], names: Names, rounds: int = 7, rate: float = 0.3, decay: float = 1e-3, seed: int = 5) -> dict[str, float]:
    """Weights by stochastic gradient ascent on the conditional log-likelihood."""
    rng = random.Random(seed)
    w: dict[str, float] = {}
    data = []
    for text, gold in examples:
        spans = sorted(propose(text, names), key=lambda x: (x[1], x[0]))
        if spans:
            g = set(gold)
            chosen = [i for i, s in enumerate(spans) if s[:3] in g]
            pairs = [(spans[i][2], spans[j][2]) for i, j in zip(chosen, chosen[1:], strict=False) if spans[j][0] - spans[i][1] <= NEAR]
            data.append((spans, [[s[2], *(f"{s[2]}|{x}" for x in s[3])] for s in spans], set(chosen), pairs))
    get = w.get
    for r in range(rounds):
        rng.shuffle(data)
        step = rate / (1 + 0.4 * r)
        for spans, feats, gold, pairs in data:
            sc = [sum(get(f, 0.0) for f in fs) for fs in feats]
            pull = {(a, b): get(f">{a}>{b}", 0.0) for a in KINDS for b in KINDS}
            prob, both = _marginals(spans, sc, pull)
            for i, p in enumerate(prob):
                g = (1.0 if i in gold else 0.0) - p
                if abs(g) > 1e-3:
                    for f in feats[i]:
                        v = get(f, 0.0)
                        w[f] = v + step * (g - decay * v)
            move: dict[tuple[str, str], float] = {}
            for k in pairs:
                move[k] = move.get(k, 0.0) + 1.0
            for (j, i), p in both.items():
                k = (spans[j][2], spans[i][2])
                move[k] = move.get(k, 0.0) - p
            for (a, b), g in move.items():
                if abs(g) > 1e-3:
                    v = get(f">{a}>{b}", 0.0)
                    w[f">{a}>{b}"] = v + step * (g - decay * v)
    return w


@functools.lru_cache(maxsize=4)
def _trained(rows: tuple[tuple[str, str], ...]) -> dict[str, float]:
    from chatlake.llm.pii_training import training_examples

    return train(training_examples(list(rows)), Names(list(rows)))


def find(text: str, names: Names, w: dict[str, float]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the personal information in a text."""
    spans = propose(text, names)
    return decode(spans, w, _scores(spans, w)) if spans else []


def redact_people(df: DataFrame, id_col: str, text_col: str, name_list: DataFrame) -> DataFrame:
    """(record_id, text, kinds): the records that mention anything, with placeholders, one row per id.

    `name_list` (name, kind) is the list of known names; it is read whole by the driver, and must be a bounded table.
    """
    rows = tuple(sorted({(r["name"], r["kind"]) for r in name_list.select("name", "kind").collect() if r["name"] and r["kind"]}))
    w = _trained(rows)
    src = df.filter(F.col(id_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(id_col).cast("string").alias("record_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = Names(list(rows))
        _memo.clear()  # scores of other weights
        for b in batches:
            out = []
            for i, t in zip(b["record_id"], b["text"], strict=True):
                got = find(t, names, w)
                if got:
                    new, at = [], 0
                    for s, e, k in got:
                        new += [t[at:s], f"[{k.upper()}]"]
                        at = e
                    out.append((i, "".join(new) + t[at:], sorted({k for _, _, k in got})))
            if out:
                yield pd.DataFrame(out, columns=["record_id", "text", "kinds"])

    return src.mapInPandas(run, "record_id string, text string, kinds array<string>").dropDuplicates(["record_id"])
