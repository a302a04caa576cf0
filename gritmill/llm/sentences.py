"""Sentence boundaries across languages and scripts.

Blank lines, list entries and headings cut a text into blocks. Within a block every stop mark with the closing marks after it is a
candidate (in Thai, every run of blanks), and a maximum-entropy model decides each from the tokens around it, their case, length,
digits and script, the mark, and whether a quotation or bracket is open. It is trained on reliable candidates: stops that a block's
end or a double blank confirms, and dots that a small letter, a comma, an abbreviation or an initial refutes. Abbreviations beyond
those that every text may use are learned from counts over the whole corpus.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents of the training sample at most, taken by the hash of their id: the bound of the only sampled step.
TRAINING_DOCUMENTS, TRAINING_LENGTH = 4_000, 20_000
HASH_BITS = 10
#: What makes a word with a dot an abbreviation: how often, and which share of its dots that end no block, something goes on after it;
#: and the share of block ends, in so many uses at least, below which it never ends a sentence. Words that qualify are kept, the most frequent of them at most.
LEAST_SEEN, GOES_ON, AT_END, SURE, MOST_LEARNED = 5, 0.4, 0.02, 50, 20_000

#: Abbreviations that stand before what they belong to, so that their dot never ends a sentence.
LEADING = frozenset(
    "dr mr mrs ms prof st sr sra srta dña ud uds m mm mme mlle me mgr hr fr frl nr no nos num núm art abs ziff kap bd abb fig figs sec sect ch chap pp p "
    "vol eq tab approx ca cf vgl bzw vs z d u s i e g ex ej pág págs av tel gen col lt sgt capt rev hon gov pres т е г д стр рис гл ул им проф акад см др "
    "د أ م डॉ श्री प्रो jan feb mar apr jun jul aug sep sept oct nov dec incl excl esp min max".split()
)
#: Abbreviations that may stand at a sentence's end.
TRAILING = frozenset("inc ltd co corp llc plc jr bros gmbh ag etc usw al u.s e.u u.k u.n a.m p.m a.d b.c ph.d u.s.a".split())
#: Month names that a day's number with a dot precedes.
MONTHS = frozenset(
    "januar jänner februar märz april mai juni juli august september oktober november dezember januari februari mars maj".split()
)
#: Words after a quotation that make it part of the running sentence, in scripts without case.
_SPEECH = re.compile("[^。！？!?\n]{0,24}?(?:问道|说道|答道|喊道|写道|问|说|道|答)")
_PARTICLE = re.compile("(?:と|って|は|が|を|も|の|に|で|という)")

_BLANK = r"[^\S\r\n]"
_BLOCK_END = re.compile(rf"(?>\r\n|\r|\n)(?:{_BLANK}*(?>\r\n|\r|\n))+")
_LIST = re.compile(rf"{_BLANK}*(?:[-*+•‣◦▪·]|(\d{{1,3}})[.)])(?={_BLANK})")
_HEADING = re.compile(rf"{_BLANK}*#{{1,6}}(?={_BLANK})")
_LINE = re.compile(r"[^\r\n]*(?>\r\n|\r|\n|$)")
_CLOSE = "\"”»“’'」』）)\\]】》"
_STOPS = re.compile(rf"(?:\.{{2,}}|…+|[.!?。！？．।॥؟۔‼⁇⁈⁉])[.!?。！？।؟…]*(?:{_BLANK}?»|[{_CLOSE}])*")
_THAI = re.compile("[ก-๛]")
_WIDE = frozenset("。！？．।॥؟۔‼⁇⁈⁉")
_PAIRS = {"“": "”", "„": "“”", "«": "»", "「": "」", "『": "』", "（": "）", "(": ")", "[": "]", "【": "】", "《": "》"}


def blocks(text: str) -> list[tuple[int, int]]:
    """Spans of blocks: between blank lines, at list entries and headings. Numbers open an entry if they go on from the last one."""
    out, first = [], 0
    for m in [*_BLOCK_END.finditer(text), None]:
        last = m.start() if m else len(text)
        start, number, fresh = first, None, True
        at = first
        while at < last:
            line = _LINE.match(text, at, last)
            end = max(line.end(), at + 1)
            entry = _LIST.match(text, at, last)
            if entry and entry[1] is not None:
                value = int(entry[1])
                if not (fresh or value == 1 or (number is not None and value == number + 1)):
                    entry = None
                else:
                    number = value
            heading = _HEADING.match(text, at, last)
            if (entry or heading) and not fresh:
                out.append((start, at))
                start = at
            if heading:
                out.append((start, min(end, last)))
                start = min(end, last)
                fresh = True
            else:
                fresh = False
            at = end
        out.append((start, last))
        first = m.end() if m else last
    return [(a, b) for a, b in out if text[a:b].strip()]


def open_spans(text: str, first: int, last: int) -> list[tuple[int, int]]:
    """Spans (opening mark, after the closing mark) of outermost quotations and brackets that are closed within the block."""
    stack: list[tuple[int, str]] = []
    out: list[tuple[int, int]] = []
    straight = -1
    for m in _OPENERS.finditer(text, first, last):
        c, i = m.group(), m.start()
        if c == '"':
            if straight >= 0:
                out.append((straight, i + 1))
                straight = -1
            else:
                straight = i
        elif stack and c in stack[-1][1]:
            out.append((stack.pop()[0], i + 1))
        elif c in _PAIRS:
            stack.append((i, _PAIRS[c]))
        else:
            # a closing mark of an outer opening drops what was left open inside
            for k in range(len(stack) - 1, -1, -1):
                if c in stack[k][1]:
                    out.append((stack[k][0], i + 1))
                    del stack[k:]
                    break
    out.sort()
    outer: list[tuple[int, int]] = []
    for a, b in out:
        if not outer or a >= outer[-1][1]:
            outer.append((a, b))
        elif b > outer[-1][1]:
            outer[-1] = (outer[-1][0], b)
    return outer


def _case(c: str) -> str:
    if not c:
        return "none"
    if c in "\"“„«「『（([《【‘":
        return "open"
    if c in "¿¡":
        return "upper"
    kind = unicodedata.category(c)
    return {"Lu": "upper", "Lt": "upper", "Ll": "lower", "Nd": "digit", "Lo": "uncased", "Lm": "uncased", "Pd": "dash"}.get(kind, "punct" if kind[0] == "P" else "sign")


_MARKS_BEFORE = "'’‘-–—*_`>#"
_RUN, _QUOTED = re.compile(r"\s+"), re.compile(r"[^\S\r\n]*>+")
_MARKS = re.compile(r"[.!?。！？．।॥؟۔‼⁇⁈⁉…]+")
_TOKEN, _WORD_ON, _CAPITAL, _FIGURES = re.compile(r"\S*"), re.compile(r"[^\W\d_]+['’]?[^\W\d_]*[,;:]?"), re.compile(r"[^\W\d_][a-zà-ÿа-я]"), re.compile(r"\d+(?:\.\d+)*$")
_OPENERS = re.compile("[“”„«»「」『』（）()\\[\\]【】《》\"]")
_PREVIOUS = re.compile(r"[^\s“”„«»「」『』（）()\[\]\"]+$")
_NEXT = re.compile(r"[^\s.,;:!?。，！？“”„«»「」()（）\"]{1,24}")


class Abbreviations:
    """Kind of each learned abbreviation, in lower case: ``leading`` ones never end a sentence, ``trailing`` ones may."""

    def __init__(self, kinds: dict[str, str] | None = None):
        self.kinds = kinds or {}

    def shape(self, bare: str) -> str | None:
        return "trailing" if bare in TRAILING else "leading" if bare in LEADING else self.kinds.get(bare)


NO_MORE = Abbreviations()


def _shape(p: str, nxt: str, known: Abbreviations) -> str:
    """What stands before a dot."""
    bare = p.lower().lstrip("'’‘-–—*_`>#").rstrip(".")
    if (kind := known.shape(bare)) is not None:
        return kind
    if len(p) == 1 and p.isalpha():
        return "initial" if p.isupper() else "letter"
    if p[-1:].isdigit():
        return "ordinal" if nxt.lower() in MONTHS and p.isdigit() and len(p) <= 2 else "number"
    if "." in bare and len(bare) <= 6:
        return "dotted"
    return "word" if any(c.isalnum() for c in p) else "none"


class Candidate:
    """A stop with its closing marks: ``end`` is after them; the text after it may go on at once or after blanks."""

    __slots__ = ("after", "closers", "end", "inside", "marks", "next", "previous", "span_open", "start", "wide_gap")

    def key(self, known: Abbreviations = NO_MORE) -> tuple:
        """All that the model knows but the words: (kind, shape, case, gap, inside, closed, attributed, place in a token, length)."""
        p, marks, nxt = self.previous, self.marks, self.next
        case = _case(self.after[:1])
        # a word like xyzOS opens a sentence in spite of its small letter
        if case == "lower" and nxt[:1].islower() and any(c.isupper() for c in nxt[1:]):
            case = "camel"
        gap = "gap" if self.wide_gap else "tight"
        dot = marks == "."
        kind = "dot" if dot else "wide" if not _WIDE.isdisjoint(marks) else "ellipsis" if marks.startswith("..") or "…" in marks else "mark"
        shape = _shape(p, nxt, known) if dot else "word"
        attributed = False
        if self.closers and self.span_open and case in ("uncased", "upper") and not dot:
            attributed = bool(_PARTICLE.match(self.after) or (not self.wide_gap and kind == "wide" and marks[-1] not in "。" and _SPEECH.match(self.after)))
        place = None
        if dot and gap == "tight" and case not in ("none", "uncased", "open"):
            # within an address, a name or a number?
            token = _TOKEN.match(self.after).group()
            plain = len(p) > 1 and p[-1].islower() and p.isalpha() and case == "upper" and _WORD_ON.fullmatch(token.split(".")[0] or "x") is not None
            closed = bool(self.closers) and case == "upper"
            number = shape == "number" and case == "upper" and _CAPITAL.match(self.after) is not None and _FIGURES.match(p) is not None
            place = "joined" if plain or closed or number else "address"
        return kind, shape, case, gap, self.inside, bool(self.closers), attributed, place, min(len(p), 6)

    def words(self) -> tuple[str, str]:
        return f"p{self.previous.lower().lstrip(_MARKS_BEFORE)[-12:]}", f"n{self.next[:12].lower()}"

    def features(self, known: Abbreviations = NO_MORE) -> list[str]:
        return [*key_features(self.key(known)), *(word_feature(w) for w in self.words())]

    def reliable(self, block_ends: bool, known: Abbreviations = NO_MORE) -> int | None:
        """1 for a boundary, 0 for none, null if nothing tells."""
        kind, shape, case, _, inside, _, attributed, place, _ = self.key(known)
        if kind == "blank":
            return 1 if case in ("thai", "letter") else 0
        if inside or attributed or place == "address":
            return 0
        if block_ends:
            return 0 if shape in ("initial", "leading") else 1
        if shape in ("leading", "initial", "ordinal"):
            return 0
        if self.wide_gap and case == "lower":
            return 0
        if self.after[:1] in (",", ";", ":", "،", "，", "、"):
            return 0
        if place == "joined":
            return 1
        if self.marks[-1] in _WIDE and case in ("uncased", "upper", "digit", "open"):
            return 1
        return None


class Blank(Candidate):
    """A run of blanks in Thai: the sentence before it ends at ``start``, the next one begins at ``end``."""

    __slots__ = ()

    def key(self, known: Abbreviations = NO_MORE) -> tuple:
        c, p = self.after[:1], self.previous[-1:]
        case = "thai" if _THAI.match(c) else "letter" if c.isalpha() else "digit" if c.isdigit() else "other"
        shape = "after thai" if _THAI.match(p) else "after letter" if p.isalpha() else "after digit" if p.isdigit() else "after other"
        return "blank", shape, case, "gap", False, False, False, None, min(len(self.previous), 6)


def key_features(key: tuple) -> list[str]:
    kind, shape, case, gap, inside, closed, attributed, place, length = key
    out = ["bias", f"k={kind}", f"kc={kind},{case},{gap}", f"s={shape}", f"sc={shape},{case},{gap}", f"len={length}"]
    if inside:
        out.append("inside")
    if closed:
        out += ["closed", f"closed={case}"]
    if attributed:
        out.append("attributed")
    if place:
        out.append(place)
    return out


def word_feature(word: str) -> str:
    return f"#{zlib.crc32(word.encode()) % (1 << HASH_BITS)}"


def is_thai(block: str) -> bool:
    """Whether most letters of a block are Thai."""
    letters = len(_THAI.findall(block))
    return letters > 0 and 2 * letters > sum(c.isalpha() or unicodedata.category(c)[0] == "M" for c in block)


def blanks(text: str, first: int, last: int) -> list[Candidate]:
    """Candidates of a Thai block: runs of blanks after its list mark, heading mark or quotation mark."""
    marker = _LIST.match(text, first, last) or _HEADING.match(text, first, last) or _QUOTED.match(text, first, last)
    out = []
    for m in _RUN.finditer(text, marker.end() + 1 if marker else first, last):
        c = Blank()
        c.start, c.end, c.marks, c.closers, c.inside, c.span_open, c.wide_gap = m.start(), m.end(), " ", "", False, False, True
        c.previous, c.after = text[max(first, m.start() - 8) : m.start()], text[m.end() : m.end() + 8]
        c.next = c.after
        out.append(c)
    return out


def _last_word(piece: str) -> str:
    """What stands before a mark, back to a blank, a quotation mark or a bracket."""
    if not piece or piece[-1].isspace():
        return ""
    word = piece.split()[-1]
    return word if word.isalnum() else (_PREVIOUS.search(word) or [""])[0]


def candidates(text: str, first: int, last: int) -> list[Candidate]:
    body_end = first + len(text[first:last].rstrip())
    spans = open_spans(text, first, body_end)
    out, k = [], 0
    # the number of a list entry is no candidate
    entry = _LIST.match(text, first, last)
    begin = entry.end() if entry else first
    for m in _STOPS.finditer(text, begin, body_end):
        c = Candidate()
        raw = m.group()
        marks = raw if len(raw) == 1 else _MARKS.match(raw).group()
        end = m.end()
        # opening marks look like closing ones in some languages: “ opens unless a span closes there
        inside, span_open = False, False
        end_marks = m.start() + len(marks)
        closes = end_marks
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        if k < len(spans) and spans[k][0] < m.start():
            a, b = spans[k]
            if b <= end:
                closes, span_open = b, True
                # further closing marks and stops belong to it
                while closes < end and text[closes] in "\"”»’'」』）)]】》":
                    closes += 1
            else:
                inside = True
                closes = end_marks
        else:
            while closes < end and text[closes] in "”»’'」』）)]】》":
                closes += 1
        c.start, c.end, c.marks, c.closers, c.inside, c.span_open = m.start(), closes, marks, text[end_marks:closes].strip(), inside, span_open
        c.previous = _last_word(text[max(first, m.start() - 40) : m.start()])
        rest = text[closes : min(closes + 80, body_end)]
        stripped = rest.lstrip()
        c.wide_gap = len(stripped) < len(rest) or not rest
        c.after = stripped
        c.next = (_NEXT.match(stripped) or [""])[0]
        out.append(c)
    return out


class Model:
    """Weights of binary features; a boundary where their sum is positive. Sums per key and weights per word are kept, up to a bound."""

    KEPT = 1 << 17

    def __init__(self, weights: dict[str, float], known: Abbreviations = NO_MORE):
        self.weights, self.known = weights, known
        self._keys: dict[tuple, float] = {}
        self._words: dict[str, float] = {}

    def __reduce__(self):
        return Model, (self.weights, self.known)

    def is_boundary(self, c: Candidate) -> bool:
        key = c.key(self.known)
        score = self._keys.get(key)
        if score is None:
            if len(self._keys) > self.KEPT:
                self._keys.clear()
            score = self._keys[key] = sum(self.weights.get(f, 0.0) for f in key_features(key))
        for word in c.words():
            own = self._words.get(word)
            if own is None:
                if len(self._words) > self.KEPT:
                    self._words.clear()
                own = self._words[word] = self.weights.get(word_feature(word), 0.0)
            score += own
        return score > 0


def _examples(text: str, known: Abbreviations) -> list[tuple[list[str], int]]:
    out = []
    spans = blocks(text)
    for n, (a, b) in enumerate(spans):
        if is_thai(text[a:b]):
            out += [(c.features(), c.reliable(False)) for c in blanks(text, a, b)]
            continue
        body_end = a + len(text[a:b].rstrip())
        for c in candidates(text, a, b):
            ends = c.end >= body_end
            if ends and not c.inside:
                # what follows a block's end stands in for the next sentence
                follow = text[spans[n + 1][0] : spans[n + 1][1]].lstrip()[:80] if n + 1 < len(spans) else ""
                if _LIST.match(follow) or follow[:1] in "#>":
                    follow = ""
                c.after, c.wide_gap, c.next = follow, True, (_NEXT.match(follow) or [""])[0]
            label = c.reliable(ends, known)
            if label is not None:
                if label and c.after and c.key(known)[2] == "lower":
                    continue
                out.append((c.features(known), label))
    return out


def train(texts: list[str], rounds: int = 300, known: Abbreviations = NO_MORE) -> Model:
    """Maximum-entropy fit by scaled gradient steps. Without examples, every stop before a blank is a boundary."""
    examples = [e for t in texts for e in _examples(t, known)]
    # every shape is known from these, whatever the sample holds; they also pin the cases that no block's end shows
    for case in ("upper", "open", "camel", "digit", "uncased", "none", "sign"):
        for kind, shape in (("dot", "word"), ("dot", "trailing"), ("dot", "number"), ("mark", "word"), ("wide", "word")):
            examples += [(["bias", f"k={kind}", f"kc={kind},{case},gap", f"s={shape}", f"sc={shape},{case},gap"], 1)] * 20
            examples += [(["bias", f"k={kind}", f"kc={kind},{case},gap", f"s={shape}", f"sc={shape},{case},gap", "inside"], 0)] * 20
        for shape in ("leading", "initial", "letter", "ordinal", "dotted"):
            examples += [(["bias", "k=dot", f"kc=dot,{case},gap", f"s={shape}", f"sc={shape},{case},gap"], 0)] * 20
        examples += [(["bias", "k=dot", f"kc=dot,{case},tight", "s=word", f"sc=word,{case},tight", "address"], 0)] * 20
    for kind in ("dot", "mark", "ellipsis", "wide"):
        for shape in ("word", "trailing", "number"):
            examples += [(["bias", f"k={kind}", f"kc={kind},lower,gap", f"s={shape}", f"sc={shape},lower,gap"], 0)] * 20
    examples += [(["bias", "k=dot", "kc=dot,upper,tight", "s=word", "sc=word,upper,tight", "joined"], 1)] * 20
    for case, label in (("thai", 1), ("letter", 1), ("digit", 0), ("other", 0)):
        examples += [(["bias", "k=blank", f"kc=blank,{case},gap", f"s=after {x}", f"sc=after {x},{case},gap"], label) for x in ("thai", "letter", "digit", "other")] * 20
    names = {f: i for i, f in enumerate(dict.fromkeys(f for e, _ in examples for f in e))}
    rows = np.repeat(np.arange(len(examples)), [len(e) for e, _ in examples])
    columns = np.array([names[f] for e, _ in examples for f in e])
    y = np.array([label for _, label in examples], np.float64)
    # hashed words are only a correction
    scale = np.array([0.15 if f[0] == "#" else 1.0 for f in names])
    w, squares = np.zeros(len(names)), np.full(len(names), 1e-8)
    for _ in range(rounds):
        z = np.bincount(rows, w[columns], len(examples))
        error = (1 / (1 + np.exp(-z)) - y) / len(examples)
        gradient = np.bincount(columns, error[rows], len(names)) + 1e-6 * w
        squares += gradient**2
        w -= 0.5 * scale * gradient / np.sqrt(squares)
    return Model({f: float(w[i]) for f, i in names.items()}, known)


def sentence_spans(text: str | None, model: Model) -> list[tuple[int, int]]:
    """Units of a text as (first code point, after the last); none for null and blank texts."""
    if not text or text.isspace():
        return []
    out = []

    def add(a: int, b: int) -> None:
        piece = text[a:b]
        left = len(piece) - len(piece.lstrip())
        if left < len(piece):
            out.append((a + left, a + len(piece.rstrip())))

    for first, last in blocks(text):
        at = first
        if is_thai(text[first:last]):
            for c in blanks(text, first, last):
                if model.is_boundary(c):
                    add(at, c.start)
                    at = c.end
        else:
            for c in candidates(text, first, last):
                if model.is_boundary(c):
                    add(at, c.end)
                    at = c.end
        add(at, last)
    return out


@lru_cache(1)
def _empty_model() -> Model:
    return train([], 200)


def learn_abbreviations(documents: DataFrame, text: str) -> Abbreviations:
    """Abbreviations by how words with a dot go on, counted over all documents; at most MOST_LEARNED, the most frequent ones.

    Texts are split at dots, so only the few characters around each dot meet a regular expression. Counts are combined before the
    shuffle; the thresholds leave few words of a corpus. Words with dots within them need no learning.
    """
    pieces = F.split(text, r"\.")
    around = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("before"), F.slice(pieces, F.lit(2), F.size(pieces) - 1).alias("after"))
    dots = documents.where(F.col(text).contains(".")).select(F.explode(around).alias("x")).select(F.right("x.before", F.lit(10)).alias("before"), F.substring("x.after", 1, 6).alias("after"))
    word = F.lower(F.regexp_extract("before", r"[^\p{L}\p{N}.@/_-](\p{L}{1,8})$", 1))
    after = F.col("after")
    use = F.when(after.rlike(r"^[ \t\r]*(?:\n[ \t\r]*\n|$)"), "end").when(after.rlike(r"^(?:[ \t]+[\p{Ll}\p{Nd}]|[,;:)])"), "on").when(after.rlike(r"^\s+[\p{Lu}\p{Lt}]"), "new")
    counts = dots.select(word.alias("word"), use.alias("use")).where("word <> '' and use is not null").groupBy("word").agg(*[F.count_if(F.col("use") == u).alias(u) for u in ("on", "new", "end")])
    kept = counts.where((F.col("on") >= LEAST_SEEN) & (F.col("on") >= GOES_ON * (F.col("on") + F.col("new"))))
    rows = kept.orderBy(F.col("on").desc(), "word").limit(MOST_LEARNED).collect()
    return Abbreviations({r.word: "leading" if r.on + r.new + r.end >= SURE and r.end < AT_END * (r.on + r.new + r.end) else "trailing" for r in rows})


def fit(documents: DataFrame, identifier: str, text: str, bound: int = TRAINING_DOCUMENTS) -> Model:
    """A model from at most ``bound`` documents, chosen by the hash of their id; from the fixed examples alone if there are none."""
    # texts longer than TRAINING_LENGTH are no training examples, which bounds the sample's size too
    rows = documents.where(F.length(text) <= TRAINING_LENGTH).select(F.xxhash64(F.col(identifier).cast("string")).alias("h"), F.col(text).alias("t"))
    sample = [r.t for r in rows.orderBy("h", "t").limit(bound).collect()]
    return train(sample, known=learn_abbreviations(documents, text)) if sample else _empty_model()


def split_sentences(documents: DataFrame, identifier: str, text: str, model: Model) -> DataFrame:
    """(identifier, start_at, end_at) of every unit of every document; repeated rows and null identifiers stay; no shuffle."""
    kind = dict(documents.dtypes)[identifier]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sentence_spans(t, model) for t in batch.column(1).to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            flat = [s for x in found for s in x]
            starts, ends = (np.array([s[i] for s in flat], np.int32) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(starts), pa.array(ends)], [identifier, "start_at", "end_at"])

    return documents.select(identifier, text).mapInArrow(run, f"`{identifier}` {kind}, start_at int, end_at int")
