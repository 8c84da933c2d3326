"""Find personal information in free text and put typed placeholders in its place.

A labelled skip-chain conditional random field. The nodes of a text are its candidate
words and its candidate spans (numbers, emails, street addresses and short forms of
them); every node takes one of the labels O, EMAIL, PHONE, ID, ADDRESS, NAME. What a
node looks like and the words around it are features of its unary potential. Chain
edges join neighbouring words of a segment; skip edges join distant tokens of the same
text: the same spelling, a spelling that differs by one letter, mentions of one number
or address however written, and a name with the email built from it. Loopy message
passing over all edges, until no message moves any more, gives the label of every node,
so the labels of repeated or similar tokens agree over a document. All texts of an
Arrow batch are inferred together with array operations.

What is fitted, on the desk's name lexicon and a bounded sample of texts (``SAMPLE``
rows drawn by a hash from all sources): a letter-sequence model of names, weights of the
words around a name, and then all weights of the field, as the maximum of its
pseudo-likelihood over the sample under a Gaussian prior (``PRIOR``). The labels of the
sample are those of the lexicon and of unmistakable forms, elsewhere those of the field
under its prior. Everything else covers every text in full.

Defined results: null and empty texts have no findings; findings never overlap (an
address holds its numbers and names); texts of any length are taken whole; repeated
rows give repeated findings; an empty table gives none; other columns are ignored.
"""
from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.functions.deep_json import loads, well_formed
from veilspark.session import spread

#: Bound of the sample of texts that the field is fitted on, and of the lexicon.
SAMPLE, MAX_LEXICON = 8000, 100_000
TYPES = ("O", "EMAIL", "PHONE", "ID", "ADDRESS", "NAME")
O, EMAIL, PHONE, ID, ADDRESS, NAME = range(6)
#: Messages pass until none moves by more than this, or so many rounds were made.
STILL, MAX_ROUNDS = 1e-4, 1000

# Words of a street address, of institutions, and titles.
STREET = "Street St Road Rd Lane Ln Cross Main Nagar Towers Tower Temple Avenue Ave Block Colony Apartments Residency Gardens Garden Park Layout Extn Extension Mandir Chowk Marg Gali Bazaar Circle Sector Phase Stage Enclave Heights"
PLACE_TAIL = "Ext East West North South Layout Nagar Extension Town City Road"
INSTITUTION = "hospital clinic care centre center nursing home mission memorial district general medical institute college trust sanatorium"
TITLES = "mr mrs ms miss dr prof smt shri sri kum kumari master baby late"
# Words before a number that is not personal.
NOT_PERSONAL = "txn transaction lot batch bill invoice form serial receipt mrd ref query claim order model device icd row room page"
# Of these, words that may also stand before a number that is personal elsewhere in the text.
DOUBTFUL = "form ref query claim order row room page"
# Words before a span that speak for its type.
SPEAKS_FOR = {
    1: "mail email write cc via id",
    2: "phone ph tel mobile mob cell call sms whatsapp contact emergency number fax m",
    3: "aadhaar aadhar uid pan identity proof card vehicle van auto sticker patient",
    4: "lives stays resides address house from r/o",
}

_WORD = r"[^\W\d_][\ẁ-ͯऀ-ॣ॰-ॿ]*(?:['’][^\W\d_]+)*"
TOKEN = re.compile(rf" ?(?:{_WORD}|\d+|[^\w\s])|\s|.", re.S)
_DOMAIN = r"[\w-]+(?:\.[\w-]+|\s?[(\[]\s?(?:dot|DOT)\s?[)\]]\s?[\w-]+|\s(?:dot|DOT)\s[\w-]+)+"
_AT = re.compile(r"[@＠﹫]\s?|[(\[]\s?(?:at|AT|At)\s?[)\]]\s?|\s(?:at|AT)\s(?=[\w-]+(?:\s(?:dot|DOT)\s[\w-]+)+)")
_DOMAIN_RE = re.compile(_DOMAIN)
_LOCAL = re.compile(r"[\w.+'’\-\u0300-\u036F\u200B-\u200D\u2060\uFEFF\u00AD]")
_IDS = re.compile(
    r"(?<![\w])(?:(?P<pan>[A-Za-z]{5}\d{4}[A-Za-z])|(?P<vehicle>[A-Za-z]{2}[ -]?\d{2}[ -]?[A-Za-z]{1,2}[ -]?\d{4})|(?P<patient>[Pp]\d{6,12})|(?P<aadhaar>\d{4}(?P<s>[ -]?)\d{4}(?P=s)\d{4}))(?![\w])(?!-\d)"
)
_PHONE = re.compile(
    r"(?<![\w+./,-])(?:(?P<home>(?:\+|00)91[ -]?\(?\d{2,5}\)?[ -]?\d{3,5}[ -]?\d{2,5})|(?P<abroad>\+[1-9]\d{0,2}(?:[ .-]?\(?\d{2,5}\)?){2,5})|(?P<bracket>\(0\d{2,4}\)[ -]?\d{3,4}[ -]?\d{3,4})|(?P<trunk>0\d{2,4}-\d{6,8}|0\d{10})"
    r"|(?P<mobile>0?[6-9]\d{9})|(?P<grouped>[6-9]\d{4}[ -]\d{5}|\d{3}[.-]\d{3}[.-]\d{4})|(?P<country>91[6-9]\d{9}))(?![\w]|[-/.]\d)"
)
_HOUSE = r"(?:(?:House|Flat|Plot|Door|Shop|Villa|Bungalow|Apt|H|D|No)\.?\s?(?:no|No|NO|number|#)?\.?:?\s?|#\s?)"
_CAP = r"[^\W\d_a-z][\w'’̀-ͯ]*"
_ADDRESS = re.compile(
    rf"(?<![\w/.-])(?P<house>{_HOUSE})?\d+[A-Za-z]?(?:[-/]\d+[A-Za-z]?)?,?\s+(?:near\s+|opp\.?\s+|behind\s+)?(?:\d+(?:st|nd|rd|th)\s+)?(?:{_CAP}\s+)*(?:{'|'.join(STREET.split())})\b\.?"
    rf"(?:,\s*{_CAP}(?:\s(?:{'|'.join(PLACE_TAIL.split())})\b)?)*(?:,?\s*[-–]?\s*\d{{6}}\b)?"
)
_HAS_NUMBER = re.compile(r"\d")

# The weights of the field: their names, and the means of their prior.
WORD_WEIGHTS = {"letters": 0.55, "lexicon": 1.6, "capital": 0.4, "small": -0.6, "accent": 1.2, "context": 0.9, "institution": -8.1, "phrase": -8.1, "bias": -2.2}
SHAPES = {
    "email": (EMAIL, 5.0), "home": (PHONE, 3.5), "abroad": (PHONE, 3.5), "bracket": (PHONE, 3.5), "trunk": (PHONE, 3.5), "mobile": (PHONE, 3.5), "grouped": (PHONE, 3.5), "country": (PHONE, 1.5), "short phone": (PHONE, -0.5),
    "pan": (ID, 4.0), "vehicle": (ID, 4.0), "patient": (ID, 4.0), "aadhaar": (ID, 4.0), "house": (ADDRESS, 4.0), "address": (ADDRESS, 4.0), "short address": (ADDRESS, -0.5),
}
#: The word before a span: speaks for the type, for another type, may stand before any number, or before a number that is not personal.
BEFORE = {"for": 2.0, "other": -1.0, "doubt": -4.5, "against": -7.0}
EDGES = {"chain": 1.6, "same": 1.2, "similar": 0.6, "repeat": 4.0, "email": 0.6}
PRIOR = np.array([*WORD_WEIGHTS.values(), *(m for _, m in SHAPES.values()), *(0.0 if t == EMAIL and k in ("doubt", "against") else m for t in (EMAIL, PHONE, ID, ADDRESS) for k, m in BEFORE.items()), *EDGES.values()])
PLACE = {n: i for i, n in enumerate([*WORD_WEIGHTS, *SHAPES, *((t, k) for t in (EMAIL, PHONE, ID, ADDRESS) for k in BEFORE), *(("edge", e) for e in EDGES)])}
SHAPE_TYPE = {n: t for n, (t, _) in SHAPES.items()}
#: Standard deviation of the prior: the sample moves a weight by some tenths.
SPREAD = 0.3
NEVER = -60.0


def fold(word: str) -> str:
    """Lower case without accents."""
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word.lower()) if not "̀" <= c <= "ͯ")


def grams(word: str, size: int = 1 << 13) -> list[int]:
    """Hashed letter sequences of 2 to 4 of a folded word with its edges."""
    w = f"^{fold(word)}$"
    out = []
    for n in (2, 3, 4):
        for i in range(len(w) - n + 1):
            h = 2166136261
            for c in w[i : i + n]:
                h = ((h ^ ord(c)) * 16777619) & 0xFFFFFFFF
            out.append(h % size)
    return out


def logistic(rows: list[list[int]], labels: np.ndarray, size: int, weight: np.ndarray, l2: float, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression over rows of active features."""
    idx = np.array([i for r in rows for i in r], dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size), np.zeros(size)
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=w[idx], minlength=len(rows)) + b
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        grad = np.bincount(idx, weights=g[row], minlength=size) / weight.sum() + l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b -= 0.5 * g.sum() / weight.sum()
    return w, b


class Model:
    """Fitted parts of the field. Plain data, so that it travels with a task."""

    def __init__(self, lexicon: dict[str, str], letters: np.ndarray, letter_bias: float, common: dict[str, int], context: np.ndarray, context_bias: float, phrases: list[tuple[str, int, int]] = (), weights: np.ndarray = PRIOR):
        #: fixed phrases around a word that is also a name: (word, word before or -1, word after or -1)
        self.phrases = list(phrases)
        self.lexicon, self.letters, self.letter_bias = lexicon, letters, letter_bias
        self.common, self.context, self.context_bias = common, context, context_bias
        self.institution = set(INSTITUTION.split())
        self.weights = np.array(weights)
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[str, int] = {}
        self.own = []
        self.phrase_words = {w: i + 1 for i, w in enumerate(sorted({p[0] for p in self.phrases}))}
        code = len(self.common) + 16
        self.phrase_left = np.array(sorted({self.phrase_words[w] * code + a for w, a, _ in self.phrases if a >= 0}), dtype=np.int64)
        self.phrase_right = np.array(sorted({self.phrase_words[w] * code + b for w, _, b in self.phrases if b >= 0}), dtype=np.int64)
        self.kind, self.size, self.lead, self.word, self.score = [], [], [], [], []
        self.arrays = None

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("lexicon", "letters", "letter_bias", "common", "context", "context_bias", "institution", "phrases", "weights")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._reset()

    # token kinds
    OTHER, WORD, INITIAL, SPACE, COMMA, DOT, HYPHEN, QUOTE, BRACKET, SEPARATOR = range(10)

    def letter_score(self, word: str) -> float:
        return float(np.clip(self.letters[grams(word)].sum() + self.letter_bias, -6, 6))

    def add(self, token: str) -> int:
        """The number of a token spelling; its features are found once."""
        t = token.strip(" ")
        kind, features = self.OTHER, (0.0,) * 5
        low = fold(t)
        if t == "\x00":
            kind = self.SEPARATOR
        elif not t or t.isspace():
            kind = self.SPACE
        elif t in ",،":
            kind = self.COMMA
        elif t == ".":
            kind = self.DOT
        elif t in "-‐‑":
            kind = self.HYPHEN
        elif t in "\"“”":
            kind = self.QUOTE
        elif t in "'()[]":
            kind = self.BRACKET
        elif t[0].isalpha() and not any(c.isdigit() for c in t):
            known = low in self.lexicon
            if len(t) == 1 and t.isupper():
                kind = self.INITIAL
            elif (known or low not in self.common) and low not in self.institution and len(t) > 1:
                latin = low.isascii()
                s = self.letter_score(t) if latin else 0.5
                features = (max(s, -1.0), float(known), float(not t.islower()), float(t.islower() and latin), float(latin and not t.isascii() and not known))
                if latin and t.islower() and not known and s < 1:
                    kind = self.OTHER
                else:
                    kind = self.WORD
        i = len(self.kind)
        self.ids[token] = i
        self.kind.append(kind)
        self.size.append(len(token))
        self.lead.append(len(token) > 1 and token[0] == " ")
        self.word.append(self.common.get(low, 1 if kind in (self.WORD, self.INITIAL) else 0))
        self.score.append(features)
        self.own.append(self.phrase_words.get(low, 0))
        return i

    def numbers(self, tokens: list[str]) -> np.ndarray:
        ids, add = self.ids, self.add
        if len(ids) > 400_000:  # forget spellings, not results
            self._reset()
            ids = self.ids
        out = np.array([ids[t] if t in ids else add(t) for t in tokens], dtype=np.int32)
        if self.arrays is None or len(self.arrays[0]) != len(self.kind):
            self.arrays = (np.array(self.kind, np.int8), np.array(self.size, np.int32), np.array(self.lead, np.int8), np.array(self.word, np.int32), np.array(self.score, np.float32).reshape(-1, 5), np.array(self.own, np.int32))
        return out


@dataclass
class Span:
    """A candidate span: its place in the batch, its shapes (one for each type it may have) and its keys."""

    start: int
    end: int
    shapes: tuple[str, ...]
    text: int = -1
    before: str = ""
    keys: tuple[str, ...] = ()


def _local_start(text: str, stop: int) -> int:
    """Where the local part of an email that ends at ``stop`` starts."""
    start = stop
    while start and _LOCAL.match(text[start - 1]):
        start -= 1
    while start < stop and text[start] in ".'’-":
        start += 1
    return start


def patterns(text: str) -> list[Span]:
    """Candidate spans of one text, not overlapping."""
    strong, weak = [], []
    for m in _AT.finditer(text):
        domain = _DOMAIN_RE.match(text, m.end())
        stop = m.start() - (text[m.start() - 1 : m.start()] == " ")
        if domain and (start := _local_start(text, stop)) < stop:
            strong.append(Span(start, domain.end(), ("email",)))
    if _HAS_NUMBER.search(text):
        strong += [Span(m.start(), m.end(), ("house" if m.group("house") else "address",)) for m in _ADDRESS.finditer(text)]
        weak += [Span(m.start(), m.end(), (next(n for n in ("pan", "vehicle", "patient", "aadhaar") if m.group(n)),)) for m in _IDS.finditer(text)]
        weak += [Span(m.start(), m.end(), (m.lastgroup,)) for m in _PHONE.finditer(text)]
    # an email or address holds what lies in it; of two spans at one place both shapes are weighed, of others the first stays
    kept: list[Span] = []
    for f in sorted(strong, key=lambda f: (f.start, f.end)):
        if not kept or f.start >= kept[-1].end:
            kept.append(f)
    edges = [k.start for k in kept]
    free: list[Span] = []
    for f in sorted(weak, key=lambda f: (f.start, SHAPE_TYPE[f.shapes[0]] == PHONE)):
        i = bisect_right(edges, f.start) - 1
        if (i >= 0 and f.start < kept[i].end) or (i + 1 < len(kept) and f.end > kept[i + 1].start):
            continue
        if not free or f.start >= free[-1].end:
            free.append(f)
        elif (f.start, f.end) == (free[-1].start, free[-1].end):
            free[-1].shapes += f.shapes
    return sorted(kept + free, key=lambda f: f.start)


_OTHER_NUMBER, _DOUBTFUL = frozenset(NOT_PERSONAL.split()), frozenset(DOUBTFUL.split())
_SPEAKS_FOR = {k: frozenset(words.split()) for k, words in SPEAKS_FOR.items()}
_SPOKEN = frozenset().union(*_SPEAKS_FOR.values())


def word_before(text: str, at: int) -> str:
    """The word before a place, over white space, a mark and "no", however far it is."""

    def word(i: int) -> tuple[str, int]:
        j = i
        while j and text[j - 1].isalpha():
            j -= 1
        return text[j:i].lower(), j

    def skip(i: int, marks: str) -> int:
        while i and (text[i - 1].isspace() or text[i - 1] in marks):
            i -= 1
        return i

    w, j = word(i := skip(at, ".:#"))
    if w == "no":
        before, _ = word(skip(j, ":#"))
        return before or w
    # a full stop ends a sentence unless "no" stands before it
    return w if "." not in text[i:at] else ""


def relation(word: str, kind: int) -> str | None:
    """What the word before a span says of it (a name of ``BEFORE``)."""
    if word in _SPEAKS_FOR[kind]:
        return "for"
    if word in _OTHER_NUMBER:
        return "doubt" if word in _DOUBTFUL else "against"
    return "other" if word in _SPOKEN else None


_DOT = re.compile(r"\s?[(\[]\s?(?:dot|DOT)\s?[)\]]\s?|\s(?:dot|DOT)\s")
_PLACE = re.compile(rf"(\d+[A-Za-z]?(?:[-/]\d+[A-Za-z]?)?),?\s+(?:(?:near|opp\.?|behind)\s+)?({_CAP})")
_SHORT_PHONE = re.compile(r"(?<![\w+./,-])\d{3,5}[ -]?\d{3,4}(?![\w]|[-/.]\d)")
_SHORT_PLACE = re.compile(rf"(?<![\w/.-])\d+[A-Za-z]?(?:[-/]\d+[A-Za-z]?)?,?\s+{_CAP}")
_LETTERS = re.compile(r"[^\W\d_]{4,}")


def spelling(kind: int, span: str) -> str:
    """What mentions of one thing have in common however they are written: the blocking key of skip edges."""
    if kind == EMAIL:
        return "e" + re.sub(r"[\W_]", "", _DOT.sub(".", _AT.sub("@", span))).lower()
    if kind == ADDRESS and (m := _PLACE.search(span)):
        return "p" + f"{m.group(1)} {fold(m.group(2))}".lower()
    bare = re.sub(r"[\W_]", "", span).lower()
    # a number is one thing whatever its type; a country code or a leading 0 is left off
    return f"n{bare[-10:]}" if kind == PHONE else f"n{bare}"


def short_forms(text: str, spans: list[Span], base: int) -> list[Span]:
    """Short forms of the phone numbers and addresses found in a text.

    Only where a full form has the same key; any other would be a node without edges that is off.
    """
    out = []
    ends: dict[str, list[str]] = {}
    places = set()
    for f in spans:
        for shape, key in zip(f.shapes, f.keys):
            if SHAPE_TYPE[shape] == PHONE:
                ends.setdefault(key[-6:], []).append(key)
            elif SHAPE_TYPE[shape] == ADDRESS:
                places.add(key)
    if ends:
        for m in _SHORT_PHONE.finditer(text):
            digits = "".join(c for c in m.group() if c.isdigit())
            full = next((k for k in ends.get(digits[-6:], ()) if k.endswith(digits)), None)
            if full:
                out.append(Span(base + m.start(), base + m.end(), ("short phone",), keys=(full,)))
    if places:
        for m in _SHORT_PLACE.finditer(text):
            if (key := spelling(ADDRESS, m.group())) in places:
                out.append(Span(base + m.start(), base + m.end(), ("short address",), keys=(key,)))
    taken = sorted((f.start, f.end) for f in spans)
    free: list[Span] = []
    for f in sorted(out, key=lambda f: (f.start, f.end)):
        i = bisect_right(taken, (f.end, -1)) - 1  # the last span that starts before its end
        if (i < 0 or taken[i][1] <= f.start) and (not free or free[-1].end <= f.start):
            free.append(f)
    return free


def couplings(weights: np.ndarray) -> np.ndarray:
    """The log potential of each kind of edge for each pair of labels: equal labels attract; an email, the name it is built from."""
    w = weights[PLACE["edge", "chain"] :]
    out = w[:, None, None] * np.eye(len(TYPES))
    out[-1] = 0
    out[-1, EMAIL, NAME] = w[-1]
    return out


def propagate(unary: np.ndarray, a: np.ndarray, b: np.ndarray, kind: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Loopy sum-product: the belief of each node in each label, as log odds against O.

    Edge (a, b) of a kind has the log potential ``pairs[kind][label of a, label of b]``. Only
    messages whose node heard something new are sent again, until none moves by ``STILL``.
    """
    total = np.array(unary, dtype=np.float64)
    if not len(a):
        return total
    m = len(a)
    src, dst, back = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([np.arange(m) + m, np.arange(m)])
    tables = np.concatenate([pairs, pairs.transpose(0, 2, 1)])
    table = np.concatenate([kind, kind + len(pairs)])
    message = np.zeros((2 * m, unary.shape[1]))
    active = np.arange(2 * m)
    for _ in range(MAX_ROUNDS):
        x = (total[src[active]] - message[back[active]])[:, :, None] + tables[table[active]]
        top = x.max(1)
        new = top + np.log(np.exp(x - top[:, None, :]).sum(1))
        new -= new[:, :1]
        moved = np.abs(new - message[active]).max(1) > STILL
        if not moved.any():
            break
        active, new = active[moved], new[moved]
        np.add.at(total, dst[active], new - message[active])
        message[active] = new
        heard = np.zeros(len(total), dtype=bool)
        heard[dst[active]] = True
        active = np.flatnonzero(heard[src])
    return total


@dataclass
class Field:
    """The field of a batch of texts: word nodes first, then span nodes."""

    starts: np.ndarray
    tokens: list[str]
    n: np.ndarray
    kind: np.ndarray
    begin: np.ndarray
    ends: np.ndarray
    node: np.ndarray
    segment: np.ndarray
    first: np.ndarray
    last: np.ndarray
    around: tuple
    house: np.ndarray
    fixed: np.ndarray
    link: np.ndarray
    text_of: np.ndarray
    features: np.ndarray
    spans: list[Span]
    a: np.ndarray
    b: np.ndarray
    edge: np.ndarray

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of span nodes: (span, label, weight) for what adds to a label's potential."""
        who, label, weight = [], [], []
        for i, f in enumerate(self.spans):
            for shape in f.shapes:
                t = SHAPE_TYPE[shape]
                who.append(i), label.append(t), weight.append(PLACE[shape])
                r = relation(f.before, t)
                if r and not (shape.startswith("short") and r == "for"):
                    who.append(i), label.append(t), weight.append(PLACE[t, r])
        return np.array(who, np.int64), np.array(label, np.int64), np.array(weight, np.int64)

    def unary(self, weights: np.ndarray) -> np.ndarray:
        words = len(self.node)
        out = np.full((words + len(self.spans), len(TYPES)), NEVER)
        out[:, O] = 0
        out[:words, NAME] = self.features @ weights[: len(WORD_WEIGHTS)]
        who, label, weight = self.parts()
        if len(who):
            out[words + who, label] = 0
            np.add.at(out, (words + who, label), weights[weight])
        return out


def field_of(texts: list[str], model: Model) -> Field:
    """Nodes, features and edges of many texts."""
    parts = [t.replace("\x00", "�") for t in texts]
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in parts], out=starts[1:])
    whole = "\x00".join(parts) + "\x00"  # no pattern and no name goes over the separator
    spans = patterns(whole)
    for f, i in zip(spans, (np.searchsorted(starts, [f.start for f in spans], side="right") - 1).tolist()):
        f.text, f.keys = i, tuple(spelling(SHAPE_TYPE[x], whole[f.start : f.end]) for x in f.shapes)
    by_text: dict[int, list[Span]] = {}
    for f in spans:
        by_text.setdefault(f.text, []).append(f)
    for i, own in by_text.items():
        if any(SHAPE_TYPE[x] in (PHONE, ADDRESS) for f in own for x in f.shapes):
            for f in short_forms(parts[i], own, int(starts[i])):
                f.text = i
                spans.append(f)
    spans.sort(key=lambda f: (f.start, f.end))
    for f in spans:
        f.before = word_before(whole, f.start)
    tokens = TOKEN.findall(whole)
    n = model.numbers(tokens)
    kinds, sizes, leads, words, scores, owns = model.arrays
    kind, ends = kinds[n], np.cumsum(sizes[n], dtype=np.int64)
    begin = ends - sizes[n] + leads[n]
    # tokens inside pattern spans are no name candidates
    if spans:
        s0, e0 = np.array([s.start for s in spans]), np.array([s.end for s in spans])
        at = np.searchsorted(s0, begin, side="right") - 1
        kind = np.where((at >= 0) & (begin < e0[np.maximum(at, 0)]), Model.OTHER, kind)
    node = np.flatnonzero(kind == Model.WORD).astype(np.int64)
    # join nodes over what may stand inside a name: nothing, spaces, an initial, a comma, a hyphen, a quoted word
    gap = np.diff(node)
    joined = np.zeros(len(node), dtype=bool)  # joined to the node before
    comma = np.zeros(len(node), dtype=bool)
    if len(node) > 1:
        p, q = node[:-1], node[1:]
        k = lambda d: kind[np.minimum(p + d, len(kind) - 1)]
        spaced = leads[n][q] == 1
        joined[1:] = (gap == 1) & spaced
        joined[1:] |= (gap == 2) & (k(1) == Model.HYPHEN) & ~spaced
        joined[1:] |= (gap == 2) & (k(1) == Model.INITIAL) & spaced
        joined[1:] |= (gap == 3) & (k(1) == Model.INITIAL) & (k(2) == Model.DOT)
        joined[1:] |= (gap == 3) & (k(1) == Model.QUOTE) & (k(2) == Model.QUOTE)
        comma[1:] = (gap == 2) & (k(1) == Model.COMMA) & spaced
        # a nickname in quotes: word, quote, word, quote, word
        joined[1:] |= (gap == 2) & (k(1) == Model.QUOTE) & (spaced | (leads[n][p + 1] == 1))
    segment = np.cumsum(~joined) - 1
    count = int(segment[-1]) + 1 if len(node) else 0
    first = np.zeros(count, np.int64)
    last = np.zeros(count, np.int64)
    if count:
        last[segment] = node
        first[segment[::-1]] = node[::-1]

    # words around each segment, punctuation skipped for the second place
    def around(at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        one = at + step
        c = kind[np.clip(one, 0, len(kind) - 1)]
        skip = (c == Model.QUOTE) | (c == Model.BRACKET)
        one = np.where(skip | (c == Model.DOT) | (c == Model.INITIAL) if step < 0 else skip, one + step, one)
        one = np.clip(one, 0, len(kind) - 1)
        two = np.clip(one + step, 0, len(kind) - 1)
        w1, w2 = words[n[one]], words[n[two]]
        w2 = np.where((kind[one] == Model.SEPARATOR), 2, w2)
        return np.where(kind[one] == Model.SEPARATOR, 2, w1), w2

    size = len(model.common) + 8
    l1, l2 = around(first, -1)
    r1, r2 = around(last, 1)
    owner = kind[np.clip(last + 1, 0, len(kind) - 1)] == Model.OTHER
    nxt = [fold(tokens[i].strip()) if o else "" for i, o in zip(np.clip(last + 1, 0, len(kind) - 1), owner)]
    house = np.array([x in model.institution for x in nxt], dtype=bool)
    w = model.context
    left = w[l1] + w[size + l2]
    right = w[2 * size + r1] + w[3 * size + r2]
    # two segments parted by a comma may be one name, surname first: share the outer context
    pair = np.zeros(count, dtype=bool)
    if count > 1:
        by_comma = comma[np.searchsorted(segment, np.arange(1, count))]
        lengths = np.bincount(segment, minlength=count)
        pair[1:] = by_comma & (lengths[:-1] == 1) & (lengths[1:] <= 2)
        pair[1:] &= ~pair[:-1]
        left[1:] = np.where(pair[1:], left[:-1], left[1:])
        right[:-1] = np.where(pair[1:], right[1:], right[:-1])
    fixed = np.zeros(count, dtype=bool)
    if model.phrases and count:
        own, code = owns[n[first]], len(model.common) + 16
        fixed = (own > 0) & (first == last) & (np.isin(own * code + l1, model.phrase_left) | np.isin(own * code + r1, model.phrase_right))
    per = np.stack([np.clip(left + right + model.context_bias, -5, 5), house, fixed, np.ones(count)], 1) if count else np.zeros((0, 4))
    features = np.concatenate([scores[n[node]].astype(np.float64), per[segment]], 1)
    link = joined | (comma & pair[segment] if count else comma)
    text_of = np.searchsorted(starts, begin[node], side="right") - 1
    # edges: the chain, then tokens of one text that are spelled alike or nearly so, mentions of one thing, emails and names
    ends_of = np.flatnonzero(link)
    a, b, edge = (ends_of - 1).tolist(), ends_of.tolist(), [0] * len(ends_of)

    def join(i: int, j: int, what: int) -> None:
        a.append(i), b.append(j), edge.append(what)

    seen: dict[tuple[int, str], int] = {}
    near: dict[tuple[int, str], int] = {}
    for i, key in enumerate(zip(text_of.tolist(), (fold(tokens[t].strip()) for t in node))):
        if key in seen:
            join(seen[key], i, 1)
        elif len(key[1]) >= 5:  # alike: equal when each lacks at most one letter
            spelled = key[1]
            less = [(key[0], spelled), *((key[0], spelled[:x] + spelled[x + 1 :]) for x in range(len(spelled)))]
            for j in {near[x] for x in less if x in near}:
                join(j, i, 2)
            near.update((x, i) for x in less)
        seen[key] = i
    offset = len(node)
    for i, f in enumerate(spans):
        for key in set(f.keys):
            if (f.text, key) in near:
                join(near[f.text, key], offset + i, 3)
            near[f.text, key] = offset + i
        if f.shapes == ("email",):
            for part in set(map(fold, _LETTERS.findall(whole[f.start : f.end].partition("@")[0]))):
                if (f.text, part) in seen:
                    join(offset + i, seen[f.text, part], 4)
    return Field(starts, tokens, n, kind, begin, ends, node, segment, first, last, (l1, l2, r1, r2), house, fixed, link, text_of, features, spans, np.array(a, np.int64), np.array(b, np.int64), np.array(edge, np.int64))


def labels_of(f: Field, weights: np.ndarray) -> np.ndarray:
    """The label of every node: the one of the strongest belief."""
    return propagate(f.unary(weights), f.a, f.b, f.edge, couplings(weights)).argmax(1)


def analyse(texts: list[str], model: Model) -> list[tuple[int, int, int, int]]:
    """Findings of many texts: (text number, start, end, type), in order."""
    f = field_of(texts, model)
    y, words, starts = labels_of(f, model.weights), len(f.node), f.starts
    out = [(s.text, s.start - int(starts[s.text]), s.end - int(starts[s.text]), int(k)) for s, k in zip(f.spans, y[words:]) if k]
    # spans of names: runs of nodes that are on and joined
    on = y[:words] == NAME
    leads = model.arrays[2]
    for i in np.flatnonzero(on & ~(f.link & np.concatenate([[False], on[:-1]]))):
        j = i
        while j + 1 < words and on[j + 1] and f.link[j + 1]:
            j += 1
        s, e = int(f.begin[f.node[i]]), int(f.ends[f.node[j]])
        at = f.node[i] - 1  # a leading initial belongs to the name
        if at > 0 and f.kind[at] == Model.DOT and f.kind[at - 1] == Model.INITIAL:
            s = int(f.begin[at - 1])
        elif at >= 0 and f.kind[at] == Model.INITIAL and leads[f.n[f.node[i]]]:
            s = int(f.begin[at])
        t = int(f.text_of[i])
        out.append((t, s - int(starts[t]), e - int(starts[t]), NAME))
    out.sort()
    return out


def fit_weights(f: Field, given: np.ndarray, rounds: int = 200) -> np.ndarray:
    """All weights of the field: the maximum of its pseudo-likelihood and the prior.

    ``given`` has the label of each node, or -1 where the field under its prior labels it.
    Each distinct surrounding counts once. The lexicon gives labels, so its own weight is
    left to the prior: letters and context must tell a name without it.
    """
    words = len(f.node)
    y = np.where(given >= 0, given, labels_of(f, PRIOR))
    # potentials are linear in the weights: (node, label, weight, value)
    who, label, weight = f.parts()
    known = list(WORD_WEIGHTS).index("lexicon")
    used = [i for i in range(len(WORD_WEIGHTS)) if i != known]
    rows = [np.repeat(np.arange(words), len(used)), words + who]
    cols = [np.full(words * len(used), NAME), label]
    which = [np.tile(used, words), weight]
    value = [f.features[:, used].ravel(), np.ones(len(who))]
    for x, z in ((f.a, f.b), (f.b, f.a)):  # each neighbour pulls towards its own label, across types over an email edge
        cross = f.edge == len(EDGES) - 1
        to = np.where(cross, np.select([y[z] == EMAIL, y[z] == NAME], [NAME, EMAIL], O), y[z])
        on = ~cross | (to != O)
        rows.append(x[on]), cols.append(to[on]), which.append(PLACE["edge", "chain"] + f.edge[on]), value.append(np.ones(int(on.sum())))
    at, which, value = np.concatenate(rows) * len(TYPES) + np.concatenate(cols), np.concatenate(which).astype(np.int64), np.concatenate(value)
    able = f.unary(PRIOR) > NEVER
    # equal surroundings once
    digest = np.bincount(at // len(TYPES), weights=value * np.sin(which * 12.9898 + at % len(TYPES) * 78.233) * 43758.5453, minlength=len(y))
    _, one, many = np.unique(np.round(digest + y * 1e6, 6), return_index=True, return_counts=True)
    share = np.zeros(len(y))
    share[one] = 1 + np.log(many)
    share *= np.where(given >= 0, 1.0, 0.3)
    share *= min(1.0, 300 / max(1.0, share.sum()))  # the prior weighs as much as some hundred nodes
    w, m, v = PRIOR.copy(), np.zeros(len(PRIOR)), np.zeros(len(PRIOR))
    for t in range(1, rounds + 1):
        z = np.bincount(at, weights=w[which] * value, minlength=len(y) * len(TYPES)).reshape(-1, len(TYPES))
        z = np.where(able, z, NEVER)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= share[:, None]
        g = np.bincount(which, weights=p.ravel()[at] * value, minlength=len(w)) + (w - PRIOR) / SPREAD**2
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2
        w = w - 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    w[known] = PRIOR[known]
    return w


def fit(names: list[tuple[str, str]], texts: list[str]) -> Model:
    """The model from the name lexicon and a bounded sample of texts."""
    lexicon = {fold(n): k for n, k in names if n}
    small, title = Counter(), Counter()
    # the name of an institution says nothing about its words being ordinary
    house = re.compile(rf"({_WORD})(?=\s+(?i:{'|'.join(INSTITUTION.split())})\b)")
    for t in texts:
        for w in re.findall(_WORD, t):
            (title if w[:1].isupper() and not w.isupper() else small)[fold(w)] += 1
        title.subtract(fold(w) for w in house.findall(t) if w[:1].isupper() and not w.isupper())
    # ordinary words: seen several times in small letters or often with a capital, and in no list of names
    common = [w for w, c in small.items() if c >= (8 if w.isascii() else 16) and w not in lexicon] + [w for w, c in title.items() if c >= max(20, len(texts) // 400) and w not in lexicon and small[w] < 4]
    common += [w for w in TITLES.split() if w not in lexicon]
    # rarer words of other scripts are ordinary where they stand among ordinary words of their script
    base = {w for w in common if not w.isascii()}
    among: Counter = Counter()
    for t in texts:
        if not t.isascii():
            ws = [fold(w) for w in re.findall(_WORD, t)]
            among.update(w for a, w, b in zip(["", *ws], ws, [*ws[1:], ""]) if not w.isascii() and w not in base and (a in base or b in base))
    common += [w for w, n in among.items() if 3 <= small[w] < 16 and n > 0.6 * small[w] and w not in lexicon]
    # words that nearly always open a sentence are ordinary too: names stand in many places
    opens = Counter(fold(w) for t in texts for w in re.findall(rf"(?:^|[.?!:;/>\n।-])\s*({_WORD})", t))
    openers = [w for w, c in title.items() if 6 <= c and w not in lexicon and opens[w] > 0.9 * (c + small[w])]
    table = {w: i + 8 for i, w in enumerate(sorted(set(common)))}
    for i, p in enumerate([",", ".", ":", ";", "=", "(", ")", "-", "/", "<", ">", "?", "@", "&", "[", "]"]):
        table[p] = len(set(common)) + 8 + i
    positive = sorted(lexicon)
    negative = sorted({w for w in common if w.isascii() and len(w) > 2})
    rows = [grams(w) for w in positive + negative]
    labels = np.array([1.0] * len(positive) + [0.0] * len(negative))
    balance = np.where(labels > 0, 1.0 / max(1, len(positive)), 1.0 / max(1, len(negative))) * len(rows) / 2
    letters, bias = logistic(rows, labels, 1 << 13, balance, 2e-4) if rows else (np.zeros(1 << 13), 0.0)
    # rarer words in small letters are ordinary unless they are built like names
    rarer = [w for w, c in small.items() if 3 <= c < 8 and w.isascii() and w not in lexicon and w not in table and letters[grams(w)].sum() + bias < -1]
    rarer += [w for w in openers if w not in table and letters[grams(w)].sum() + bias < 1]
    for w in sorted(set(rarer)):
        table[w] = len(table) + 8
    model = Model(lexicon, letters, bias, table, np.zeros((len(table) + 8) * 4), 0.0)
    f, size = field_of(texts, model), len(table) + 8
    l1, l2, r1, r2 = f.around
    # each spelling counts once in each context, so one frequent phrase teaches little
    examples: dict[tuple, float] = {}
    names_of: dict[int, list[str]] = {}
    for i, s in zip(f.node.tolist(), f.segment.tolist()):
        names_of.setdefault(s, []).append(fold(f.tokens[i].strip()))
    # a word that fills most of the places beside one neighbour, again and again, is a fixed phrase and no name
    single = [(ws[0], int(l1[s]), int(r1[s])) for s, ws in names_of.items() if len(ws) == 1 and not f.house[s]]
    before, after, lefts, rights = Counter((w, a) for w, a, _ in single), Counter((w, b) for w, _, b in single), Counter(a for _, a, _ in single), Counter(b for _, _, b in single)
    phrases = [(w, a, -1) for (w, a), c in before.items() if a >= 8 and c >= 5 and c > 0.5 * lefts[a]] + [(w, -1, b) for (w, b), c in after.items() if b >= 8 and c >= 5 and c > 0.5 * rights[b]]
    stuck_left, stuck_right = {(w, a) for w, a, b in phrases if b < 0}, {(w, b) for w, a, b in phrases if a < 0}
    told: dict[int, float] = {}
    for s, ws in names_of.items():
        if f.house[s] or (ws[0], int(l1[s])) in stuck_left or (ws[-1], int(r1[s])) in stuck_right:
            told[s] = 0.0
            continue
        known = [w in lexicon for w in ws]
        label = 1.0 if all(known) else 0.0 if not any(known) and all(not w.isascii() or model.letter_score(w) < 0 for w in ws) else None
        if label is not None:
            examples[(" ".join(ws), int(l1[s]), int(l2[s]), int(r1[s]), int(r2[s]))] = label
        if label:
            told[s] = 1.0
    # ordinary words with a capital stand for what is not a name
    kinds = model.arrays[0]
    ids = model.numbers(f.tokens)
    words = model.arrays[3][ids]
    for i in range(2, len(f.tokens) - 2):
        if words[i] >= 8 and kinds[ids[i]] == Model.OTHER and f.tokens[i].strip()[:1].isupper():
            examples.setdefault((f.tokens[i], int(words[i - 1]), int(words[i - 2]), int(words[i + 1]), int(words[i + 2])), 0.0)
    if examples:
        rows = [[k[1], size + k[2], 2 * size + k[3], 3 * size + k[4]] for k in examples]
        labels = np.array(list(examples.values()))
        pos = max(1.0, labels.sum())
        balance = np.where(labels > 0, len(labels) / 2 / pos, len(labels) / 2 / max(1.0, len(labels) - pos))
        model.context, model.context_bias = logistic(rows, labels, size * 4, balance, 5e-4)
    model.phrases = phrases
    model._reset()
    # the weights of the field, on the whole sample
    f = field_of(texts, model)
    given = [{1.0: NAME, 0.0: O}.get(told.get(s), -1) for s in f.segment.tolist()]
    for x in f.spans:
        types = [SHAPE_TYPE[shape] for shape in x.shapes]
        says = {t: relation(x.before, t) for t in types}
        clear = [t for t in types if says[t] == "for" and not x.shapes[0].startswith("short")]
        if not clear and "against" in says.values() and EMAIL not in types:
            given.append(O)
        else:
            given.append(clear[0] if len(clear) == 1 else EMAIL if types == [EMAIL] else -1)
    model.weights = fit_weights(f, np.array(given, np.int64)) if given else PRIOR
    return model


def finder(model: Model, keep: int, every: bool = False):
    """A ``mapInArrow`` function: the first ``keep`` columns, the text after them and its findings.

    Texts without findings are left out unless ``every`` is set.
    """
    kind = pa.list_(pa.struct([("start_pos", pa.int32()), ("end_pos", pa.int32()), ("pii_type", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4000):
                b = whole.slice(at, 4000)
                texts = [x or "" for x in b.column(keep).to_pylist()]
                per: list[list] = [[] for _ in texts]
                for t, s, e, k in analyse(texts, model):
                    per[t].append({"start_pos": s, "end_pos": e, "pii_type": TYPES[k]})
                hit = [i for i, x in enumerate(per) if x or every]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(hit, pa.int64())) for c in b.columns[: keep + 1]), pa.array([per[i] for i in hit], type=kind)], names=[*b.schema.names[: keep + 1], "found"])

    return run


FOUND = "array<struct<start_pos:int,end_pos:int,pii_type:string>>"
FREE_TEXT = ("remarks", "clinical_summary", "discharge_advice")


def leaves(data) -> Iterator[tuple[str, str]]:
    """Texts under the free-text keys of one payload, with their paths; documents of any depth."""
    todo = [(data, "", "")]
    while todo:
        v, path, key = todo.pop()
        if isinstance(v, dict):
            todo += [(x, f"{path}.{k}" if path else k, k) for k, x in reversed(v.items())]
        elif isinstance(v, list):
            todo += [(v[i], f"{path}[{i}]", key) for i in range(len(v) - 1, -1, -1)]
        elif isinstance(v, str) and key in FREE_TEXT:
            yield path, v


def claim_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow``: (claim_no, page_pos, leaf_path, text) of every free-text entry."""
    for b in batches:
        ids, places, paths, texts = [], [], [], []
        for ident, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            try:
                doc = loads(text or "")
            except ValueError:
                continue
            pages = doc.get("pages") if isinstance(doc, dict) else None
            for i, page in enumerate(pages if isinstance(pages, list) else [pages]):
                data = page.get("extracted_data") if isinstance(page, dict) else None
                if isinstance(data, str):
                    try:
                        data = loads(data)
                    except ValueError:
                        data = None
                    data = data if isinstance(data, dict) else None
                for p, t in leaves(data):
                    ids.append(ident), places.append(i), paths.append(well_formed(p)), texts.append(well_formed(t))
        yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), pa.array(places, pa.int32()), pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["record_id", "page_pos", "leaf_path", "text"])


def drawn(df: DataFrame, id_col: str, most: int) -> DataFrame:
    """At most ``most`` rows, drawn by a hash of the id: a threshold cuts the rows first, so no task sorts more than a few thousand."""
    total = df.count()
    places = 1 << 40
    below = places if total <= most else int(places * most * 1.2 / total) + 1
    at = F.xxhash64(F.col(id_col).cast("string"))
    return df.filter(F.pmod(at, F.lit(places)) < below).orderBy(at, id_col).limit(most)


def fit_from(lexicon: DataFrame, texts: DataFrame, id_col: str, text_col: str, documents: DataFrame | None = None, sample: int = SAMPLE) -> Model:
    """Fit on the lexicon (a fixed table) and at most ``sample`` texts, drawn by a hash of their ids.

    ``documents`` (id, JSON) gives a tenth of them; a lexicon above ``MAX_LEXICON`` rows is refused.
    """
    names = [(r[0], r[1]) for r in lexicon.select("name_part", "name_kind").limit(MAX_LEXICON + 1).collect()]
    if len(names) > MAX_LEXICON:
        raise ValueError(f"the name lexicon has more than {MAX_LEXICON} rows")
    share = sample // 10 if documents is not None else 0
    rows = [r[1] for r in drawn(texts.select(id_col, text_col).filter(F.col(text_col) != ""), id_col, sample - share).collect()]
    if share:
        few = drawn(documents, documents.columns[0], share // 2).mapInArrow(claim_texts, "record_id bigint, page_pos int, leaf_path string, text string")
        rows += [r[0] for r in few.select("text").filter(F.col("text") != "").limit(share).collect()]
    return fit(names, rows)


def find(df: DataFrame, columns: list[str], text_col: str, model: Model, every: bool = False) -> DataFrame:
    """``columns``, the text and ``found`` for every row that holds personal information (or every row, null and empty texts too)."""
    picked = spread(df.select(*columns, F.col(text_col).alias("text")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema) + f", found {FOUND}"
    rows = picked if every else picked.filter(F.col("text").isNotNull() & (F.col("text") != ""))
    return rows.mapInArrow(finder(model, len(columns), every), schema)


def replace(text, found):
    """The text with a placeholder such as ``[PHONE]`` for each finding, as a Column."""
    first = F.substring(text, F.lit(1), F.element_at(found, 1)["start_pos"])
    tail = F.concat_ws(
        "",
        F.transform(
            found,
            lambda x, i: F.concat(
                F.lit("["), x["pii_type"], F.lit("]"), F.substring(text, x["end_pos"] + 1, F.coalesce(F.get(found, i + 1)["start_pos"], F.length(text)) - x["end_pos"])
            ),
        ),
    )
    return F.when(F.size(found) > 0, F.concat(first, tail)).otherwise(text)
