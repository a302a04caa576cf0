"""Broken prompt and response pairs.

A multi-label linear classifier over hashed word n-grams of the answer and features of the pair. It is trained here on answers of the
corpus and on copies of them broken on purpose (emptied, cut, copied from the prompt, swapped with an answer of another language,
refused). Exact conditions (a label, a part of one, an unfinished sentence, the share of the prompt that is repeated, a language that
nobody asked for) are features beside others, not decisions. Each label's score is calibrated and its threshold set on pairs that
the weights have not seen, with families of refusals that are kept apart for it. Copies and languages are checked exactly afterwards.
"""

from __future__ import annotations

import itertools
import json
import random
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.llm import phrases
from gritmill.llm.words import words

DEFECTS = ("empty", "truncated", "refusal", "copied", "other_language")
_ORDER = ("empty", "copied", "refusal", "other_language", "truncated")
#: Defects that decide whatever else a pair looks like.
FIRST = ("empty", "copied")
#: Pairs of the training sample at most, taken by the hash of their key, characters of one of them, and pairs of each kind (one word, or
#: more) of which broken copies are made: the bounds of the only sampled step.
TRAINING_PAIRS, TRAINING_LENGTH, BROKEN_FROM = 3_000, 100_000, 500
#: Where the slots of facts, of the answer's make-up, of cues and of hashed n-grams end. What words are there decides on refusals, what
#: they are made of also on other languages; on the other defects they hardly add to the facts, so they are learned slowly.
FACT_SLOTS, MAKE_UP_SLOTS, CUE_SLOTS, DIMENSIONS = 1 << 10, 1 << 12, 1 << 13, 1 << 15
RATES = {"refusal": (1.0, 1.0, 0.1), "other_language": (1.0, 0.01, 0.01)}
#: Pairs of the corpus that a first round scores so high as refusals are no negatives of the next round.
SUSPICION = -2.0
#: Part of the prompt or its record that makes a copy.
COPIED_SHARE = 0.7

#: The labels that answers may name; those of a prompt's own list and those frequent in the sample count too.
LABELS = frozenset(
    "benign malicious phishing benign_url vulnerable_dependency vulnerable_code non_vulnerable_code malicious_package attack_technique attack_pattern "
    "vulnerability_advisory malicious_prompt benign_prompt jailbreak_prompt ai_security_risk exploit_incident intrusion anomaly unknown".split()
)
#: Words for null.
NULL_WORDS = frozenset("none null nan nil na nat undefined void empty missing".split())
_IDENTIFIER = re.compile(r"(?:CVE-\d{4}-\d{4,}|CWE-\d{1,5}|CAPEC-\d{1,4}|GHSA(?:-[0-9a-z]{4}){3}|T\d{4}(?:\.\d{3})?|(?:TA|S|G|M)\d{4})", re.IGNORECASE)
_PART_OF_IDENTIFIER = re.compile(r"(?:C|CV|CVE|CVE-|CVE-\d{1,4}|CVE-\d{4}-\d{0,3}|CW|CWE|CWE-|CA|CAPE?C?-?|GHSA?(?:-[0-9a-z]{0,4}){0,3}|T|T\d{1,3}|T\d{4}\.\d{0,2}|TA\d{0,3}|[SGM]\d{1,3})", re.IGNORECASE)
_ENDS_WELL = re.compile(r"(?:[.!?。！？।؟۔…]|[^\W\d_]\.?\s?[\U0001F300-\U0001FAFF☀-➿]️?)[\s\"”»“’'」』）)\]]*$")
_INSTRUCTED = re.compile(r"[a-z][a-z_]+(?=\s*[,;?.|\]]|$)")

#: Small words that tell languages in Latin script apart.
SMALL_WORDS = {
    "en": "the of and to in which so that with from by is are this for on an as it be or not at its was were has have will can i i'm do does you we they my your there if any all more than when who what about a an under over into through after before",
    "de": "der die das und ein eine im bei ohne auf mit dem den des nach vor ist nicht für von zu alle trotz während innerhalb über sich wird wurde auch am in jede durch",
    "fr": "le la les des du un une sans dans pour avec par sur et est que après avant malgré lors pendant en au aux ce cette qui ne pas sont a",
    "es": "el la los las del un una con por sin para en al y que tras antes de después muchas mucha pocos durante es se no su ha lo como",
    "it": "il lo gli della delle di che con per una sono nel alla dopo la le senza alcun durante i un è non da del si",
    "pt": "o os uma do da dos das com por sem para em ao não que as durante depois qualquer a é um no na se foi",
    "nl": "de het een en van in op met zonder voor na is niet door bij naar dat die zijn alle",
    "pl": "w i na z do nie bez po się przez oraz jest są że od dla za po żadnej",
    "sv": "och i att det som en på är av för med utan under efter den inte till",
    "tr": "ve bir bu için ile olarak de da sonra boyunca olmadan",
}
_SMALL = {k: frozenset(v.split()) for k, v in SMALL_WORDS.items()}
_SCRIPTS = {"ja": "[ぁ-ヿ]", "ko": "[가-힣]", "zh": "[一-鿿]", "ru": "[а-яёА-ЯЁ]", "ar": "[ء-ي]", "hi": "[ऀ-ॣ]", "th": "[ก-๎]", "el": "[α-ωΑ-Ωά-ώ]", "he": "[א-ת]"}
_SCRIPTS = {k: re.compile(v) for k, v in _SCRIPTS.items()}
#: How prompts name the language they want.
LANGUAGE_NAMES = {
    "en": "english|englisch|anglais|inglés", "de": "german|deutsch|allemand|alemán", "fr": "french|französisch|français|francés", "es": "spanish|spanisch|espagnol|español",
    "it": "italian|italienisch|italiano", "pt": "portuguese|portugiesisch|português", "nl": "dutch|niederländisch|nederlands", "pl": "polish|polnisch|polski", "sv": "swedish|schwedisch|svenska", "tr": "turkish|türkisch|türkçe",
    "ru": "russian|russisch|russe|ruso|русск\\w+", "zh": "chinese|mandarin|chinesisch|chinois|chino|中文|汉语", "ja": "japanese|japanisch|japonais|japonés|日本語", "ko": "korean|koreanisch|한국어", "ar": "arabic|arabisch|arabe|árabe|العربية",
    "hi": "hindi|हिन्दी|हिंदी", "th": "thai|ไทย", "el": "greek|griechisch", "he": "hebrew|hebräisch",
}
_ASK = r"(?:answer|repl(?:y|ies)|respon[ds]\w*|write|written|use|using|translate\w*|return|output|state|explain|language|please|must be|should be|antwort\w*|schreib\w*|répon\w+|rédige\w*|écri\w+|respond\w*|contest\w+|escrib\w+|ответ\w*|напиш\w*|用|以|请|回答|答え|書)"
_ASKED = {k: re.compile(rf"{_ASK}[^.!?\n]{{0,60}}?(?:{v})|(?:\b(?:in|into|auf|en|au|to|на)\s+(?:\w+\s+){{0,2}}(?:{v}))|(?:{v})(?:で|[^.!?\n]{{0,20}}\b(?:please|only|answer|reply|response))", re.IGNORECASE) for k, v in LANGUAGE_NAMES.items()}

_NAMED = re.compile("|".join(LANGUAGE_NAMES.values()), re.IGNORECASE)


def asks_for(prompt: str, language: str | None = None) -> bool:
    """Whether a prompt asks for a language, or for any."""
    return _NAMED.search(prompt) is not None and any(p.search(prompt) for k, p in _ASKED.items() if language is None or k == language)


#: Words that refusals are made of, by kind and in many languages; features of the classifier, alone and with each other within a sentence.
CUES = {
    "first": r"\b(?:i|i'm|i'd|i've|i'll|me|my|we|our|us|ich|mir|mich|meine?[rnms]?|je|j'|moi|nous|yo|mis?|puedo|debo|tengo|lamento|siento|estoy|posso|sono|devo|eu|estou|recuso|ik|mij|jag|mogę|muszę|mi|я|мне|мной|мои|мой|нам|yanıtlayamam|olamam)\b|我|私|저|죄송|أستطيع|يمكنني|لي |أنا|علي|मैं|मुझे|ฉัน|ผม|申し訳|お答え",
    "cannot": r"\b(?:cannot|can't|can not|could not|couldn't|unable|not able|won't|will not|would not|must not|may not|shall not|not (?:able|permitted|allowed|going|prepared|supposed|in a position|something|possible|to)|do not|don't|nothing|never|kann|darf|nicht|ne|pas|impossible|no|non|não|niet|nie|inte|kan|не|нельзя|запрещено|yanıtlayamam|olamam)\b|无法|不能|不便|ません|없습니다|لا |नहीं|ไม่|ได้",
    "refuse": r"declin|refus|\breject|\bdenied|abstain|\bpass on|opt out|rather not|prefer (?:to|not)|unwilling|keep out|stay away|skip|verweiger|ablehn|rechaz|negar|rifiut|recus|weiger|odmów|отказ|拒绝|控え|거절|رفض|मना|ปฏิเสธ",
    "sorry": r"\b(?:sorry|apolog\w+|afraid|regret\w*|unfortunately|sadly|tut mir leid|leider|désolée?|malheureusement|lo siento|lamento|perdón|disculpe|mi dispiace|spiacente|purtroppo|desculpe|sinto muito|infelizmente|het spijt|helaas|przykro|niestety|tyvärr|üzgünüm|maalesef|извините|простите|к сожалению)\b|抱歉|对不起|申し訳|すみません|죄송|عذرا|آسف|للأسف|أعتذر|क्षमा|खेद|माफ|ขออภัย|ขอโทษ",
    "task": r"\b(?:requests?|questions?|quer(?:y|ies)|answer\w*|assist\w*|help\w*|comply|provide|discuss\w*|respond\w*|repl(?:y|ies)|topics?|comment\w*|label|judge|engage|fulfill?|such (?:material|content|things)|frage|anfrage|antwort\w*|helfen|beantworten|répondre|demande|aider|responder|ayudar\w*|solicitud|pregunta|rispondere|domanda|aiutar\w*|ajudar|pedido|vraag|verzoek|helpen|pomóc|odpowied\w+|pytanie|ответ\w*|вопрос\w*|помочь)\b|回答|问题|请求|帮助|答え|質問|依頼|답변|요청|الإجابة|الرد|المساعدة|उत्तर|मदद|ตอบ|ช่วย|คำขอ",
    "policy": r"\b(?:polic(?:y|ies)|guidelines?|rules?|allowed?|permit\w*|appropriate|inappropriate|comfortable|at ease|scope|remit|supposed|instructed|prepared|harm\w*|safety|sensitive|richtlinien|regeln|gestatten|erlauben|autoris\w+|autoriz\w+|permitido|permesso|запрещено)\b|允许|規則|अनुमति",
    "self": r"\b(?:an? ai|ai model|language model|an assistant|chatbot|automated system|ki|sprachmodell|ia|modelo de lenguaje|модел\w+)\b|人工智能|语言模型",
    "else": r"something else|anything else|another (?:\w+ )?(?:question|topic)|consult|professional|an expert|rephrase|understanding|patience",
    "you": r"\b(?:you|your|ihnen|sie|vous|usted|le|ти|вам)\b|您",
}
_CUES = {k: re.compile(v) for k, v in CUES.items()}
_SENTENCE = re.compile(r"[.!?。！？।؟\n]+\s*")


def language_of(text: str) -> str | None:
    """Language of a text of some length; null if it can't be told."""
    letters = sum(map(str.isalpha, text))
    if not letters:
        return None
    if not text.isascii():
        for name, pattern in _SCRIPTS.items():
            if len(pattern.findall(text)) * 5 > letters:
                return name
    tokens = re.findall(r"[^\W\d_]+", text.lower())
    scores = {k: sum(map(small.__contains__, tokens)) for k, small in _SMALL.items()}
    best = max(scores, key=scores.get)
    return best if scores[best] >= 2 and scores[best] * 12 >= len(tokens) else None


def in_order_share(part: list[str], whole: list[str]) -> float:
    """Share of ``part`` that occurs in ``whole`` in the same order (longest common subsequence, bit-parallel)."""
    if not part:
        return 0.0
    masks: dict[str, int] = {}
    for i, w in enumerate(part):
        masks[w] = masks.get(w, 0) | (1 << i)
    full = (1 << len(part)) - 1
    v = full
    for w in whole:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return (len(part) - v.bit_count()) / len(part)


_BLANK = re.compile(r"\s")
_NO_WORD = re.compile("[^a-z0-9]+")


def bare(text: str) -> str:
    """Without blanks, marks, symbols and invisible characters; lower case."""
    if text.isascii():
        return _NO_WORD.sub("", text.lower())
    return "".join(c for c in text if unicodedata.category(c)[0] in "LN").lower()


class Prompt:
    """A prompt with the record in it and the instruction around it; what is needed of them is found once."""

    def __init__(self, text: str, record: str, instruction: str):
        self.text, self.record, self.instruction = text, record, instruction
        self._words: tuple[list[str], ...] | None = None
        self._languages: set[str] | None = None

    def words(self) -> tuple[list[str], ...]:
        if self._words is None:
            own = units(self.record)
            self._words = (own,) if self.record == self.text else (own, units(self.text))
        return self._words

    def languages(self) -> set[str]:
        if self._languages is None:
            self._languages = {x for x in {language_of(t) for t in {self.instruction, self.record}} if x} or {"en"}
        return self._languages

    def labels(self) -> set[str]:
        """Labels of a list in the instruction."""
        return set(_INSTRUCTED.findall(self.instruction)) if self.instruction != self.record and self.instruction.count(",") > 1 else set()


class Pair:
    """A prompt with one answer. ``broken`` says that the answer's JSON breaks off."""

    __slots__ = ("answer", "broken", "prompt")

    def __init__(self, prompt: Prompt, answer: str | None, broken: bool = False):
        self.prompt, self.answer, self.broken = prompt, (answer or "").strip(), broken


_UNSPACED = re.compile("[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff]")


def units(text: str) -> list[str]:
    """Words, or single characters of words in scripts without blanks."""
    found = words(text)
    if text.isascii() or not _UNSPACED.search(text):
        return found
    return [c for w in found for c in (w if _UNSPACED.search(w) else (w,))]


def cover_of(pair: Pair, answer_words: list[str]) -> float:
    """The larger share of the record or the prompt that the answer repeats in order; 0 where it is surely below a half."""
    best, there = 0.0, set(answer_words)
    for part in pair.prompt.words():
        if 2 * sum(map(there.__contains__, part)) > len(part):
            best = max(best, in_order_share(part, answer_words))
    return best


class Features:
    """Facts and features of pairs, given the labels and the usual words of the sample."""

    def __init__(self, labels: frozenset[str], usual: frozenset[str]):
        self.labels, self.usual = labels, usual
        self.parts = frozenset(x[:k] for x in labels for k in range(1, len(x))) - labels
        self._one = lru_cache(1 << 14)(self._one_word)

    def __reduce__(self):
        return Features, (self.labels, self.usual)

    def _one_word(self, answer: str) -> tuple[bool, ...]:
        """Of an answer without blanks: empty, label, identifier, part of one of these."""
        squeezed, low = bare(answer), answer.lower().strip("\"'`“”.")
        label, identifier = low in self.labels, _IDENTIFIER.fullmatch(answer.strip("\"'`")) is not None
        part = not label and not identifier and (low in self.parts or _PART_OF_IDENTIFIER.fullmatch(answer) is not None)
        return not squeezed or squeezed in NULL_WORDS, label, identifier, part and bool(squeezed)

    def facts(self, pair: Pair) -> dict:
        a = pair.answer
        one, squeezed = _BLANK.search(a) is None, ""
        if one:
            empty, label, identifier, part = self._one(a)
            if not (empty or label or identifier) and (own := pair.prompt.labels()):
                low = a.lower().strip("\"'`“”.")
                label = low in own
                part = not label and (part or any(x.startswith(low) for x in own))
        else:
            squeezed = bare(a)
            empty, label, identifier, part = not squeezed or squeezed in NULL_WORDS, False, False, False
        f = {"empty": empty, "label": label, "identifier": identifier, "part": part, "one": one, "broken": pair.broken, "cover": 0.0, "foreign": False, "unfinished": False, "size": 1, "tongue": None}
        if not (empty or label or identifier or part):
            answer_words = units(a)
            f["size"] = len(answer_words)
            f["cover"] = cover_of(pair, answer_words) if len(answer_words) >= 4 else 0.0
            f["unfinished"] = not one and not _ENDS_WELL.search(a)
            if len(squeezed or bare(a)) >= 6:
                f["tongue"] = tongue = language_of(a)
                f["foreign"] = tongue is not None and tongue not in pair.prompt.languages() and not asks_for(pair.prompt.text, tongue)
        return f

    def of(self, pair: Pair, f: dict) -> list[str]:
        out = ["bias", f"made of {min(int(np.log2(f['size'] + 1)), 7)}", f"cover={min(int(f['cover'] * 10), 10)}"]
        out += [k for k in ("empty", "label", "identifier", "part", "unfinished", "broken", "one", "foreign") if f[k]]
        if not (f["empty"] or f["part"] or f["unfinished"] or f["broken"]):
            out.append("whole")
        if f["empty"] or f["label"] or f["identifier"] or f["part"] or f["cover"] >= COPIED_SHARE:
            # the words of a copy tell nothing
            return out
        lower = pair.answer.lower().replace("’", "'")
        w = re.findall(r"[^\W\d_\u0900-\u0e7f\u3040-\u9fff]+(?:'[^\W\d_]+)?", lower)
        content = [x for x in re.findall(r"\b[^\W\d_]{5,}", pair.answer) if not x[:1].isupper()]
        known = sum(map(self.usual.__contains__, content))
        usual = f"usual={4 * known // len(content)}" if content else "usual=none"
        small = 8 * sum(map(_SMALL["en"].__contains__, w)) // max(1, len(w))
        tongue = "unknown" if f["tongue"] is None else "foreign" if f["foreign"] else "wanted"
        out += [f"made of {x}" for x in (f"{usual}, english={f['tongue'] == 'en'}", f"tongue={tongue}", f"{tongue}, english={min(small, 3)}", f"{tongue}, {usual}", f"sentences={min(4, len(_SENTENCE.split(lower.strip())))}")]
        any_cue = False
        for sentence in _SENTENCE.split(lower):
            cues = [k for k, pattern in _CUES.items() if pattern.search(sentence)]
            for n in (1, 2, 3):
                out += [f"cues={'+'.join(x)}" for x in itertools.combinations(cues, n)]
            any_cue |= bool(cues)
            if "first" in cues and ("cannot" in cues or "refuse" in cues):
                out.append(f"cues=i do not, {usual}")
        if not any_cue:
            out.append("cues=none")
        out += [f"3$ {x}" for x in w[-2:] if f["unfinished"]] + [f"1{x}" for x in w] + [f"2{x} {y}" for x, y in zip(w, w[1:])] + [f"3{x} {y} {z}" for x, y, z in zip(w, w[1:], w[2:])]
        # scripts without blanks go by runs of four characters
        for run in re.findall(r"[\u0900-\u0e7f\u3040-\u9fff]{4,}", lower):
            out += [f"3{run[k : k + 4]}" for k in range(len(run) - 3)]
        if w:
            out.append(f"1^ {' '.join(w[:2])}")
        return out

    def slots(self, pair: Pair, f: dict) -> list[int]:
        return list({_slot(x) for x in self.of(pair, f)})


@lru_cache(1 << 18)
def _slot(feature: str) -> int:
    first, end = (CUE_SLOTS, DIMENSIONS) if feature[0] in "123" else (MAKE_UP_SLOTS, CUE_SLOTS) if feature.startswith("cues=") else (FACT_SLOTS, MAKE_UP_SLOTS) if feature.startswith("made of ") else (0, FACT_SLOTS)
    return first + zlib.crc32(feature.encode()) % (end - first)


class Classifier:
    """Scores are calibrated log odds less the threshold's: positive means the defect."""

    def __init__(self, features: Features, weights: np.ndarray, slope: np.ndarray, offset: np.ndarray):
        self.features, self.weights, self.slope, self.offset = features, weights, slope, offset

    def scores(self, slots: list[list[int]]) -> np.ndarray:
        firsts = np.cumsum([0, *(len(s) for s in slots[:-1])])
        return np.add.reduceat(self.weights[:, np.concatenate(slots)], firsts, axis=1).T * self.slope + self.offset

    def defects(self, pairs: list[Pair], slack: float = 0.0) -> list[str | None]:
        """The label of each pair over its threshold less ``slack``: empty or copied before others, else that of the highest score.

        Copies, and languages that are the prompt's or asked for, are checked exactly.
        """
        if not pairs:
            return []
        facts = [self.features.facts(p) for p in pairs]
        scores = self.scores([self.features.slots(p, f) for p, f in zip(pairs, facts)]) + slack
        out: list[str | None] = []
        for row, f in zip(scores.tolist(), facts):
            wrong = {"copied": f["cover"] < COPIED_SHARE, "other_language": f["tongue"] is not None and not f["foreign"]}
            over = {d: z for d, z in zip(DEFECTS, row) if z > 0 and not wrong.get(d, False)}
            if "refusal" in over:
                # a refusal in another language is both
                over.pop("other_language", None)
            out.append(next((d for d in FIRST if d in over), max(over, key=over.get, default=None)))
        return out


def _fit(slots: list[list[int]], y: np.ndarray, counts: np.ndarray, rounds: int) -> np.ndarray:
    """Weights of one logistic model per label, by scaled gradient steps. ``counts`` masks labels an example says nothing about."""
    rows, columns = np.repeat(np.arange(len(slots)), [len(s) for s in slots]), np.concatenate(slots)
    firsts = np.cumsum([0, *(len(s) for s in slots[:-1])])
    w = np.zeros((len(DEFECTS), DIMENSIONS))
    for k in range(len(DEFECTS)):
        kind = np.searchsorted([FACT_SLOTS, MAKE_UP_SLOTS, CUE_SLOTS], np.arange(DIMENSIONS), "right")
        rate = 0.3 * np.array([1.0, *RATES.get(DEFECTS[k], (0.02, 0.01, 0.01))])[kind]
        squares = np.full(DIMENSIONS, 1e-10)
        balance = counts[:, k] * np.where(y[:, k] > 0, 0.5 / max(1, y[:, k].sum()), 0.5 / max(1, (1 - y[:, k]).sum()))
        for _ in range(rounds):
            z = np.add.reduceat(w[k][columns], firsts)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[:, k]) * balance
            gradient = np.bincount(columns, error[rows], DIMENSIONS) + 1e-6 * w[k]
            squares += gradient**2
            w[k] -= rate * gradient / np.sqrt(squares)
    return w


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset: log odds by Platt's smoothed targets, less those of the threshold of best F1, halfway to the next score."""
    if not len(z) or y.sum() == 0 or y.sum() == len(y):
        return 1.0, 0.0 if len(z) and y.sum() else -1e9
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    centre, scale = z.mean(), z.std() or 1.0
    u, a, b = (z - centre) / scale, 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30)))
        a -= 0.5 * float(((p - target) * u).mean())
        b -= 0.5 * float((p - target).mean())
    slope = max(a, 1e-6) / scale
    order = np.argsort(-z, kind="stable")
    f1 = 2 * np.cumsum(y[order]) / (np.arange(1, len(z) + 1) + y.sum())
    # of equally good thresholds the middle one
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    s = np.append(z[order], z.min() - 1)
    cut = (s[best[0]] + s[best[-1] + 1]) / 2
    return slope, -slope * cut


def _broken_on_purpose(pair: Pair, others: list[str], features: Features, rng: random.Random, held_out: bool) -> list[tuple[Pair, str, frozenset[str]]]:
    """(broken pair, its defect, labels it says nothing about)."""
    make = lambda answer, broken=False: Pair(pair.prompt, answer, broken)
    unsure = frozenset(("truncated", "other_language"))
    out = [(make(rng.choice(["", "  ", "\n", "null", "None", "N/A", "nan", "-", "...", "…", "{}", "[]", '""', "​", "n/a", "NIL", "undefined", "?", "--"])), "empty", frozenset())]
    out.append((make(phrases.refusal(rng, held_out)), "refusal", unsure))
    source = pair.prompt.record if rng.random() < 0.7 else pair.prompt.text
    if len(units(source)) >= 8:
        text = source[: int(len(source) * rng.uniform(0.86, 1))] if rng.random() < 0.3 else source
        out.append((make(rng.choice([str, str.upper, str.lower, lambda t: f"Answer: {t}", lambda t: f"“{t}”", lambda t: "  ".join(t.split())])(text)), "copied", frozenset(("truncated", "other_language", "refusal"))))
    tongue, asked = rng.choice(phrases.LANGUAGES), asks_for(pair.prompt.text)
    for answer in (phrases.statement(tongue, rng), *([rng.choice(others)] if others else [])):
        if answer and not asked and (language_of(answer) or tongue) not in pair.prompt.languages():
            out.append((make(answer), "other_language", frozenset()))
    a, f = pair.answer, features.facts(pair)
    if f["label"] or f["identifier"]:
        # a part that is a label itself is no defect
        cut = make(a[: rng.randint(1, max(1, len(a) - 1))])
        now = features.facts(cut)
        if not (now["label"] or now["identifier"]):
            out.append((cut, "truncated", frozenset()))
        if rng.random() < 0.3:
            out.append((make(a[: rng.randint(0, len(a))], True), "truncated", frozenset()))
    elif len(a.split()) > 4:
        cut = a[: rng.randint(len(a) // 3, len(a) - 2)].rstrip() + rng.choice(["", "", ",", ":", " (see", " because", " and the", " which", " **"])
        if not _ENDS_WELL.search(cut):
            out.append((make(cut, rng.random() < 0.3), "truncated", frozenset()))
    return out


def _may_refuse(answer: str) -> bool:
    """Whether a sentence has cues that refusals have together: no negative to learn from, though it need not be one."""
    for sentence in _SENTENCE.split(answer.lower().replace("’", "'")):
        cues = {k for k, pattern in _CUES.items() if pattern.search(sentence)}
        if {"first", "self"} & cues and {"cannot", "refuse"} & cues or len(cues & {"sorry", "task", "policy", "refuse", "cannot", "self", "else"}) > 1:
            return True
    return False


def _sample_features(pairs: list[Pair], rng: random.Random) -> Features:
    """Labels and usual words of the sample: answers of one word seen in several pairs, words of several answers without refusing ones."""
    ones = Counter(p.answer.lower() for p in pairs if re.fullmatch(r"[a-z]+(?:_[a-z]+)*", p.answer.lower()))
    frequent = {x for x, n in ones.items() if n >= max(5, len(pairs) // 300)}
    # a frequent cut is rarer than what it is a part of
    labels = LABELS | {x for x in frequent - NULL_WORDS if not any(y != x and y.startswith(x) and n >= ones[x] for y, n in ones.items()) and not any(y != x and y.startswith(x) for y in LABELS)}
    usual: Counter = Counter()
    for p in pairs:
        if " " in p.answer and not _may_refuse(p.answer) and language_of(p.answer) == "en":
            usual.update({x for x in re.findall(r"\b[^\W\d_]{5,}", p.answer) if not x[:1].isupper()})
    return Features(frozenset(labels), frozenset(x for x, n in usual.items() if n >= 3))


def train(pairs: list[Pair], seed: int = 42) -> Classifier:
    """Clean-looking pairs and look-alikes are negatives and the stuff that broken ones are made of.

    A fifth of the pairs, with all that is made of them, is kept for calibration. Later rounds leave out pairs that earlier ones suspect.
    """
    rng = random.Random(seed)
    features = _sample_features(pairs, rng)
    facts = [features.facts(p) for p in pairs]
    odd = lambda f: f["empty"] or f["part"] or f["unfinished"] or f["broken"] or f["foreign"] or f["cover"] >= COPIED_SHARE
    clean = [p for p, f in zip(pairs, facts) if not odd(f) and not (" " in p.answer and _may_refuse(p.answer))]
    if not clean:
        prompt = Prompt("Pick one label. Record: the loader copies the key.", "the loader copies the key.", "Pick one label.")
        clean = [Pair(prompt, a) for a in ("benign", "CVE-2020-12345", "The loader moves another token of the host.") for _ in range(20)]
    # answers in other languages than English, to be swapped with others
    others = [p.answer for p, f in zip(pairs, facts) if f["size"] >= 4 and f["tongue"] not in (None, "en") and f["cover"] < COPIED_SHARE]
    sets: list[list[tuple[Pair, str | None, frozenset[str]]]] = [[], []]
    made = Counter()
    for i, p in enumerate(clean):
        held = i % 5 == 0
        own = sets[held]
        own.append((p, None, frozenset(("corpus",))))
        made[" " in p.answer] += 1
        if made[" " in p.answer] > BROKEN_FROM:
            continue
        own += _broken_on_purpose(p, others, features, rng, held)
        if i % 2 == 0:
            text = phrases.lookalike(rng)
            own.append((Pair(p.prompt, text if rng.random() < 0.6 or " " not in p.answer else f"{text} {p.answer}"), None, frozenset(("other_language", "truncated"))))
        if i % 5 == 0:
            # a language that the prompt asks for
            tongue = rng.choice(phrases.LANGUAGES)
            name = LANGUAGE_NAMES[tongue].split("|")[0].capitalize()
            ask = rng.choice([f"Answer in {name}.", f"Please reply in {name}.", f"The answer must be in {name}.", f"Use {name} for the answer.", f"{name} only, please."])
            own.append((Pair(Prompt(f"{p.prompt.text} {ask}", p.prompt.record, f"{p.prompt.instruction} {ask}"), phrases.statement(tongue, rng)), None, frozenset(("truncated",))))
    prepared = [[(f, features.slots(p, f)) for p, f in ((p, features.facts(p)) for p, _, _ in own)] for own in sets]
    model = None
    for _ in range(2):
        z = []
        for own, ready in zip(sets, prepared):
            keep = np.ones(len(own), bool)
            if model is not None:
                keep = ~np.array(["corpus" in unsure for _, _, unsure in own]) | (model.scores([s for _, s in ready])[:, DEFECTS.index("refusal")] <= SUSPICION)
            y = np.array([[float(label == k) for k in DEFECTS] for _, label, _ in own])
            counts = np.array([[float(k not in unsure or label == k) for k in DEFECTS] for _, label, unsure in own])
            z.append(([s for (_, s), k in zip(ready, keep) if k], y[keep], counts[keep]))
        w = _fit(*z[0], 60)
        slots, y, counts = z[1] if z[1][0] else z[0]
        plain = Classifier(features, w, np.ones(len(DEFECTS)), np.zeros(len(DEFECTS))).scores(slots)
        fitted = [_calibrate(plain[counts[:, k] > 0, k], y[counts[:, k] > 0, k]) for k in range(len(DEFECTS))]
        model = Classifier(features, w, np.array([a for a, _ in fitted]), np.array([b for _, b in fitted]))
    return model


def _loads(text):
    try:
        return json.loads(text), True
    except (TypeError, ValueError):
        return None, False


def benchmark_pair(prompt: str | None, answer: str | None) -> Pair:
    p = prompt or ""
    return Pair(Prompt(p, p, p), answer)


def _answers(content: str | None) -> list[tuple[str | None, bool]]:
    """(answer, breaks off) that a reply or target holds: the answer and the label of its JSON, or the text itself."""
    if content is None or not content.strip():
        return [(None, False)]
    value, fine = _loads(content)
    if fine and isinstance(value, dict):
        own = value.get("answer", value.get("label"))
        out = [(own if isinstance(own, str) or own is None else json.dumps(own, ensure_ascii=False), False)]
        if isinstance(value.get("label"), str) and value["label"] != own:
            out.append((value["label"], False))
        return out
    if fine:
        return [(value if isinstance(value, str) else content, False)]
    if content.lstrip()[:1] in "{[":
        found = re.search(r'"answer"\s*:\s*"((?:[^"\\]|\\.)*)', content)
        return [(found[1] if found else content, True)]
    return [(content, False)]


def chat_pairs(messages: str | None, target: str | None) -> list[Pair]:
    """The last user turn with the reply after it, and with the target. Messages that can't be read have an answer that breaks off."""
    value, fine = _loads(messages)
    turns = [m for m in value if isinstance(m, dict)] if isinstance(value, list) else []
    at = max((i for i, m in enumerate(turns) if m.get("role") == "user"), default=None)
    prompt = turns[at].get("content") if at is not None else None
    if not fine and messages:
        found = re.findall(r'\{"content": "((?:[^"\\]|\\.)*)", "role": "user"', messages)
        prompt = _loads(f'"{found[-1]}"')[0] if found else None
    prompt = prompt if isinstance(prompt, str) else ""
    instruction, _, rest = prompt.partition("\n\nRecord:\n")
    inner, _ = _loads(rest[: rest.rfind("}") + 1])
    record = inner.get("benchmark_input") if isinstance(inner, dict) else None
    record = record if isinstance(record, str) and record else rest or prompt
    replies: list[tuple[str | None, bool]]
    if not fine and messages and messages.strip():
        tail = messages[messages.rfind('"role": "user"') :]
        found = re.search(r'\\"answer\\"\s*:\s*\\"((?:[^"\\]|\\(?!"))*)', tail)
        replies = [(found[1] if found else tail, True)]
    else:
        reply = next((m.get("content") for m in turns[at + 1 :] if m.get("role") == "assistant"), None) if at is not None else None
        replies = _answers(reply if isinstance(reply, str) or reply is None else json.dumps(reply))
    whole = Prompt(prompt, record, instruction)
    return [Pair(whole, a, broken) for a, broken in dict.fromkeys([*replies, *_answers(target)])]


def defective(benchmark: DataFrame, chats: DataFrame, bound: int = TRAINING_PAIRS) -> DataFrame:
    """(table_name, row_key, defect) of the defective pairs, one row per key: of several the first in the order of _ORDER.

    Null answers and answers of blanks only are empty; a null prompt is an empty one. Rows without a key are left out. Rows are scored
    where they are read; only the defective ones are shuffled.
    """
    b = benchmark.select(F.lit("gold_benchmark").alias("table_name"), F.col("record_id").alias("row_key"), F.col("input_text").alias("a"), F.col("expected_output").alias("b"))
    c = chats.select(F.lit("sft_examples").alias("table_name"), F.col("example_id").alias("row_key"), F.col("messages_json").alias("a"), F.col("target_json").alias("b"))
    rows = b.unionByName(c).where("row_key is not null")

    def read(name: str, x: str | None, y: str | None) -> list[Pair]:
        return [benchmark_pair(x, y)] if name == "gold_benchmark" else chat_pairs(x, y)

    short = rows.where(F.coalesce(F.length("a"), F.lit(0)) + F.coalesce(F.length("b"), F.lit(0)) < TRAINING_LENGTH).withColumn("h", F.xxhash64("table_name", "row_key"))
    sample = sorted(set(short.orderBy("h", "row_key", "a", "b").limit(bound).collect()), key=str)
    model = train([p for r in sample for p in read(r.table_name, r.a, r.b)])
    shared = benchmark.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                read_ = [read(n, x, y) for n, x, y in zip(*(part.column(i).to_pylist() for i in (0, 2, 3)))]
                sizes = [len(x) for x in read_]
                found = shared.value.defects([p for x in read_ for p in x])
                hits = [(i, d) for i, d in zip(np.repeat(np.arange(len(sizes)), sizes).tolist(), found) if d]
                at = pa.array([i for i, _ in hits], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array([_ORDER.index(d) for _, d in hits], pa.int32())], ["table_name", "row_key", "place"])

    done = rows.mapInArrow(run, "table_name string, row_key string, place int")
    return done.groupBy("table_name", "row_key").agg(F.get(F.array(*[F.lit(d) for d in _ORDER]), F.min("place")).alias("defect"))
