"""Sentence units across languages and scripts (problem 9).

A document is first laid out: list items, table rows and headings that stand alone are units of their own; the other
lines of a block are one stretch of prose. In prose a boundary may stand between any two words, and every gap is decided.
A hidden-event n-gram model decides: its n-grams count words and boundaries alike, and forward-backward posteriors over
all gaps of a stretch say how probable a boundary is given all the words around. What marks, line ends, white space and
letter case say beforehand enters as prior odds: places that one of these points to have odds of their own (candidates),
all others low ones (plain_odds), which the words may outweigh.

The model is fitted without labels by hard expectation maximisation (a boundary counts where its posterior is 0.5 or
more) to all documents: its first counts come from the starts and ends of blocks, where boundaries are certain, and from
the priors. One pass over the texts counts their words and n-grams by the priors and stores each text as it is laid out;
a round of the fit decides all gaps of the stored texts and adds what that changes in the counts. The workers get a model
of the commonest n-grams by these full counts (MOST_WORDS, MOST_GRAMS), so that no text is taken apart twice. Words are
cased, rare ones are classed by shape; digits are one class; scripts without spaces are taken by characters.

Defined results: null, empty and blank texts have no units; units begin and end without white space and cover all other
characters; offsets are code points. Equal texts are divided alike. Empty tables give no rows.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import read, stored
from callmill.llm.common import in_slices, map_texts

ROUNDS, ORDER, RARE = 2, 4, 5
#: What the model that is sent to the workers may hold: the words and n-grams with the highest counts over all documents.
MOST_WORDS, MOST_GRAMS = 100_000, 600_000
#: Answers of the model that a worker keeps, of contexts and of n-grams; different keys that a worker counts at once.
KEPT, COUNTED = 400_000, 300_000
#: Words that are decided at once; stretches and places of them that are taken side by side.
WORDS_AT_ONCE, SIDE_BY_SIDE, CELLS = 200_000, 512, 200_000
#: Kinds of what is counted, and of texts that are laid out.
WORD, GRAM, DOUBT, DOC = 0, 1, 2, 3
#: White space as units see it.
_SPACE = r"[\s​﻿\x1c-\x1f\x85]"
_LETTERS = r"[^\W\d_฀-໿぀-ヿ㐀-䶿一-鿿가-힯豈-﫿]|[̀-ͯ҃-ً҇-ٟऀ-ॣ॰-෿\xad]"
_TOKEN = re.compile(
    r"(?:https?://|www\.)[^\s，。、]+|(?:19|20)\d\d(?=[.](?:19|20)\d\d\b)|\d+(?:[.,]\d+)*|(?:" + _LETTERS + r")+(?:[-'’](?:" + _LETTERS + r")+)*|[฀-໿]{1,3}|\.{2,}|…+|" + _SPACE + r"+|.",
    re.S,
)
_BLANK = re.compile(_SPACE)
# End marks by how sure they are, and what closes or opens with a sentence.
SURE, LIKELY, OPEN_ENDED = "。！？।॥؟۔", "!?", ".…"
MARKS = SURE + LIKELY + OPEN_ENDED
STOPS = frozenset(MARKS + "„")
CLOSERS, OPENERS = "\"'”’»)]}」』】）》", "“‘«([{「『【（《„¿¡"
_SPACELESS = re.compile(r"[฀-໿]")
_BREAKS = re.compile(r"[\r\n฀-໿]")
#: Prior log-odds of a boundary before a capital in a stretch without end marks.
UNMARKED = -2.0
#: Prior log-odds of a boundary between two words of which nothing says so: before a capital after a small word, elsewhere, and before a mark.
PLAIN_CAPITAL, PLAIN, CLOSED = -5.0, -9.0, -12.0
_ITEM = re.compile(r"[ \t]*(?:[-•*–▪◦‣·]|\(?\d{1,3}[.)]|\(?[a-z]\))[ \t]+\S")
_NUMBERED = re.compile(r"[ \t]*\(?\d{1,3}[.)][ \t]")
_ROW = re.compile(r"\t| \| ")
_FINAL = re.compile(r"[" + re.escape(MARKS) + r"][" + re.escape(CLOSERS + "“") + r"]*$")
START, END = "<s>", "</s>"
#: Classes of rare words by their shape.
SHAPES = ("<cap>", "<low>", "<other>")
#: Longest line without an end mark that is a heading where it stands alone.
HEADING = 120


def lines_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of each line without the white space at its ends; start = end for a blank one."""
    out, at = [], 0
    for line in re.split(r"(\r\n|\n|\r| | |\f)", text):
        if line in ("\r\n", "\n", "\r", " ", " ", "\f"):
            at += len(line)
            continue
        kept = re.sub(r"^" + _SPACE + "+|" + _SPACE + "+$", "", line)
        start = at + (line.find(kept) if kept else 0)
        out.append((start, start + len(kept)))
        at += len(line)
    return out


def layout(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whole): stretches in order; whole ones are units as they are."""
    out: list[tuple[int, int, bool]] = []
    block: list[tuple[int, int]] = []

    def close() -> None:
        prose: list[tuple[int, int]] = []

        def flush() -> None:
            if prose:
                start, end = prose[0][0], prose[-1][1]
                one = text[start:end]
                heading = len(prose) == 1 and len(block) == 1 and len(one) <= HEADING and not _FINAL.search(one) and not _SPACELESS.search(one)
                out.append((start, end, heading))
                prose.clear()

        for n, (a, b) in enumerate(block):
            line = text[a:b]
            item = _ITEM.match(line)
            if item and _NUMBERED.match(line) and prose and not re.search(r"[.!?:;。]\W*$", text[prose[-1][0] : prose[-1][1]]):
                item = None  # a number at the head of a wrapped line
            if item or _ROW.search(line):
                flush()
                out.append((a, b, True))
            else:
                prose.append((a, b))
        flush()
        block.clear()

    for a, b in lines_of(text):
        if a == b:
            close()
        else:
            block.append((a, b))
    close()
    return out


class _Classes(dict):
    """token -> its class, None for white space: digits and addresses are one each. What was asked lately is kept."""

    def __missing__(self, t: str) -> str | None:
        if len(self) > KEPT:
            self.clear()
        found = self[t] = None if _BLANK.match(t) else "#" if t[0].isdigit() else "www" if "/" in t or t.startswith("www.") else t
        return found


_CLASS = _Classes()


def tokens(text: str) -> list[tuple[str, int, int]]:
    """(class, start, end) of each token; white space is none."""
    pieces = _TOKEN.findall(text)
    return [(c, end - len(p), end) for p, end in zip(pieces, accumulate(map(len, pieces))) if (c := _CLASS[p]) is not None]


def candidates(text: str, toks: list[tuple[str, int, int]]) -> list[tuple[int, float]]:
    """(number of tokens before, prior log-odds) of each place where a sentence may end inside the stretch."""
    out, open_low = [], 0
    n, i = len(toks), 0
    if not _BREAKS.search(text):
        # only marks can end a sentence here
        stops = [k for k, (t, _, _) in enumerate(toks) if t[0] in STOPS]
        if not any(toks[k][0] != "„" for k in stops):
            return unmarked(text, toks)
    else:
        stops = range(n)
    following = iter(stops)
    while i < n - 1:
        i = next((k for k in following if k >= i), n)
        if i >= n - 1:
            break
        t = toks[i][0]
        open_low += t == "„"
        if t[0] in MARKS:
            j = i
            marks = ""
            while j < n and toks[j][0][0] in MARKS and (j == i or toks[j][1] == toks[j - 1][2] or t in LIKELY):
                marks += toks[j][0]
                j += 1
            while j < n and toks[j][1] == toks[j - 1][2] and (toks[j][0][0] in CLOSERS or toks[j][0] == "“" and open_low > 0):
                open_low -= toks[j][0] == "“"
                j += 1
            if j >= n:
                break
            gap = toks[j][1] > toks[j - 1][2]
            head = toks[j][0]
            before = toks[i - 1][0] if i else ""
            first = text[toks[j][1]]
            quoted = toks[j - 1][0] in CLOSERS + "“" and toks[j - 1][0] not in ")]）】"
            if quoted and marks[0] in SURE + LIKELY:
                odds = 0.2  # who said it may follow
            elif marks[0] in SURE:
                odds = 4.0
            elif marks[0] in LIKELY:
                odds = 2.5
            elif "…" in marks or len(marks) > 1:
                odds = -1.5
            else:
                # a long word in lower case is rarely shortened, a short one or one with a capital often
                plain = before.islower() or before != "#" and before.lower() == before.upper()
                odds = 3.0 if len(before) > 3 and plain or before in ("%", *CLOSERS) else 1.5 if len(before) > 2 and plain else 2.0 if len(before) > 5 and before.istitle() else 0.0 if len(before) < 4 and before != "#" else 0.6
                # a word alone is no sentence: one of the two places around it is none
                if out and out[-1][0] == i - 1 and out[-1][1] < odds:
                    out[-1] = (i - 1, out[-1][1] - 2.0)
                elif i <= 1 or out and out[-1][0] == i - 1:
                    odds -= 2.0
            if first.islower():
                odds -= 7.0
            elif first in ",;:，、；：،؛-—–%" or first in CLOSERS and gap and first not in "\"'":
                odds -= 7.0
            elif not gap and marks[0] in ".!?…":
                # a missing gap: a word must have ended before, and a new one or a number must begin
                if not (first.isupper() or first.isdigit() or first in OPENERS or ord(first) > 0x2E80) or len(before) < 2 and not before == "#" and before not in CLOSERS + "%":
                    i = j
                    continue
                odds -= 0.5
            elif len(before) == 1 and before.isalpha() and ord(before) < 0x0E00:
                odds -= 3.0
            elif first.isdigit() and marks == ".":
                odds -= 0.5 if re.match(r"(?:19|20)\d\d\b", text[toks[j][1] :]) else 4.0
            if "\n" in text[toks[j - 1][2] : toks[j][1]]:
                odds += 0.5
            out.append((j, odds))
            i = j
            continue
        between = text[toks[i][2] : toks[i + 1][1]]
        if between:
            line = "\n" in between or "\r" in between
            spaceless = bool(_SPACELESS.match(text[toks[i + 1][1]]) or _SPACELESS.match(text[toks[i][2] - 1]))
            first = text[toks[i + 1][1]]
            if spaceless and not first in CLOSERS and not text[toks[i][2] - 1] in OPENERS:
                last = text[toks[i][2] - 1]
                odds = -4.0 if first.isdigit() or first in OPENERS else 0.0 if last.isdigit() or last in "%." else 1.5
                if i + 2 < n and toks[i + 2][0] == "." and len(toks[i + 1][0]) < 4:
                    odds = -3.0  # a shortened word begins no sentence
                out.append((i + 1, odds + line))
            elif line:
                closed = toks[i][0][0] in CLOSERS
                out.append((i + 1, -6.0 if first.islower() else -2.5 + closed))
        i += 1
    return out


def unmarked(text: str, toks: list[tuple[str, int, int]]) -> list[tuple[int, float]]:
    """The candidates of a stretch of one line without any end mark: before a word with a capital that follows one without."""
    words = [t for t, _, _ in toks]
    return [(j, UNMARKED) for j in range(2, len(words) - 1) if words[j][0].isupper() and words[j - 1].islower() and len(words[j]) > 1]


class Model:
    """Counts of n-grams of words and boundaries, smoothed by falling back to shorter ones. Rare words count by their shape."""

    def __init__(self, vocabulary: frozenset = frozenset()):
        self.vocabulary = vocabulary
        self.follow: dict = defaultdict(float)
        self.total: dict = defaultdict(float)
        self.kinds: dict = defaultdict(float)
        self.words = 1.0
        self.forget()

    def forget(self) -> None:
        """Drops the answers that are kept."""
        self.known: dict = {}
        self.folded: dict = {}
        self.contexts: dict = {}
        self.pasts: dict = {}
        self.singles: dict = {}
        self.table = np.zeros((1024, 7))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "folded", "contexts", "pasts", "singles", "table")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.forget()

    def fold(self, word: str) -> str:
        if word in self.vocabulary or not word[0].isalpha():
            return word
        return "<cap>" if word[0].isupper() else "<low>" if word[0].islower() else "<other>"

    def fold_all(self, marks: list[str]) -> list[str]:
        """The words folded; the latest answers are kept."""
        if len(self.folded) > KEPT:
            self.folded.clear()
        for w in set(marks).difference(self.folded):
            self.folded[w] = self.fold(w)
        return [self.folded[w] for w in marks]

    def freeze(self) -> Model:
        """As plain dictionaries, without what was seen at most once and a half beyond single words."""
        self.forget()
        f = {k: v for k, v in self.follow.items() if v > 1.5 or not k[0]}
        self.follow, self.total, self.kinds = f, dict(self.total), dict(self.kinds)
        self.words = max(2.0, self.kinds.get((), 1.0))
        return self

    def log(self, history: tuple, word: str) -> float:
        """Log-probability of the word after the history; the latest answers are kept."""
        key = (history, word)
        found = self.known.get(key)
        if found is None:
            if len(self.known) > KEPT:
                self.known.clear()
            found = self.known[key] = self._log(history, word)
        return found

    def _log(self, history: tuple, word: str) -> float:
        """Witten-Bell: a history lends its word as much as it has seen different words."""
        p = 0.2 / self.words
        for k in range(len(history), -1, -1):
            h = history[k:]
            n = self.total.get(h)
            if n is None:
                if not h:
                    continue
                break
            d = self.kinds[h]
            p = (self.follow.get((h, word), 0.0) + d * p) / (n + d)
        return math.log(p)


def plain_odds(before: str, word: str) -> float:
    """Prior log-odds of a boundary between two words where nothing points to one."""
    if before[0] in OPENERS or not (word[0].isalnum() or word[0] in OPENERS or word in SHAPES):
        return CLOSED
    return PLAIN_CAPITAL if (word == "<cap>" or word[0].isupper()) and (before == "<low>" or before[0].islower()) else PLAIN


def _lent(follow: dict, past: tuple | None, word: str, p: float) -> float:
    """The word's probability after a history, of the one after the next shorter history."""
    return p if past is None else (follow.get((past[0], word), 0.0) + past[1] * p) / past[2]


def _after(model: Model, pasts: tuple, word: str, alone: float) -> tuple[float, float, float]:
    """The word's probability as a sentence's second word, third word and later one: as by model.log, shorter histories taken once."""
    one, two, three, first, second = pasts
    follow = model.follow
    p1 = _lent(follow, one, word, alone)
    p2 = _lent(follow, two, word, p1)
    return _lent(follow, first, word, p1), _lent(follow, second, word, p2), _lent(follow, three, word, p2)


def _past(model: Model, a: str, b: str, c: str) -> tuple:
    """(history, kinds, total + kinds) of each history that ends with the words a, b, c, the probability of an end after each, and how many there are."""
    total, kinds = model.total, model.kinds
    pasts = tuple((h, d := kinds[h], total[h] + d) if h in total else None for h in ((c,), (b, c), (a, b, c), (START, c), (START, b, c)))
    return pasts, _after(model, pasts, END, math.exp(model.log((), END))), 3 if a else 2 if b else 1


def context(model: Model, a: str, b: str, c: str, word: str) -> tuple[float, ...]:
    """What a word after the words a, b, c (empty ones aren't there) weighs with a boundary before it and without one.

    Three numbers each, by how many words the sentence has so far (1, 2, or more), and the prior of a boundary where no
    other is told; all relative to the longest history's weight without a boundary. The end of a stretch has none.
    """
    past = model.pasts.get((a, b, c))
    if past is None:
        past = model.pasts[a, b, c] = _past(model, a, b, c)
    pasts, (e1, e2, e3), most = past
    if word == END:
        k1, k2, k3, start, odds = e1, e2, e3, 0.0, 0.0
    else:
        one = model.singles.get(word)
        if one is None:
            one = model.singles[word] = math.exp(model.log((), word)), math.exp(model.log((START,), word))
        alone, start = one
        k1, k2, k3 = _after(model, pasts, word, alone)
        k1, k2, k3 = k1 * (1 - min(0.999999, e1)), k2 * (1 - min(0.999999, e2)), k3 * (1 - min(0.999999, e3))
        odds = math.exp(plain_odds(c, word))
    if most == 3:
        return e1 * start / k3, e2 * start / k3, e3 * start / k3, k1 / k3, k2 / k3, 1.0, odds
    if most == 2:
        return e1 * start / k2, e2 * start / k2, 0.0, k1 / k2, 1.0, 0.0, odds
    return e1 * start / k1, 0.0, 0.0, 1.0, 0.0, 0.0, odds


def contexts(model: Model, stretches: list[list[str]]) -> list[np.ndarray]:
    """The place in model.table of each gap's context, one after each word of each stretch; the latest contexts are kept."""
    known, out, new = model.contexts, [], []
    if len(known) > KEPT:
        known.clear()
        model.pasts.clear()
        model.singles.clear()
    for words in stretches:
        row = ["", "", *words, END]
        keys = [*zip(row, row[1:], row[2:], row[3:])]
        found = [*map(known.get, keys)]
        if None in found:
            for k, key in enumerate(keys):
                if found[k] is None:
                    if (n := known.get(key)) is None:
                        known[key] = n = len(known) + 1  # the first row is for places beyond a stretch
                        new.append(context(model, *key))
                    found[k] = n
        out.append(np.array(found, np.int32))
    n = len(known) + 1
    if n > len(model.table):
        model.table = np.concatenate([model.table, np.zeros((n, 7))])
    model.table[0] = [0, 0, 0, 1, 1, 1, 0]
    if new:
        model.table[n - len(new) : n] = new
    return out


def chances(stretches: list[tuple[list[str], list[tuple[int, float]]]], model: Model) -> list[np.ndarray]:
    """Forward-backward over every gap between the words (in the model's words) of each stretch: the probability of a boundary.

    The first number is of the gap after the first word. gaps tell the prior log-odds of some places; all others have
    plain_odds. The state at a gap is how many words the sentence has so far, as far as the model's order reaches.
    """
    rows, out = contexts(model, [words for words, _ in stretches]), [np.zeros(0)] * len(stretches)
    order = sorted((k for k in range(len(stretches)) if len(rows[k]) > 1), key=lambda k: -len(rows[k]))
    for first in range(0, len(order), SIDE_BY_SIDE):
        some = order[first : first + SIDE_BY_SIDE]
        wide = len(rows[some[0]])
        for k in range(0, len(some), max(1, CELLS // wide)):
            few = some[k : k + max(1, CELLS // wide)]
            at = np.zeros((len(rows[few[0]]), len(few)), np.int32)
            for i, which in enumerate(few):
                at[: len(rows[which]), i] = rows[which]
            weights = model.table[at]
            odds = weights[:, :, 6]
            for i, which in enumerate(few):
                for j, o in stretches[which][1]:
                    odds[j - 1, i] = math.exp(o)
            begun, kept = weights[:, :, :3] * odds[:, :, None], weights[:, :, 3:6]
            for i, p in enumerate(_forward_backward(begun, kept).T):
                out[few[i]] = p[: len(rows[few[i]]) - 1]
    return out


def _forward_backward(begun: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """(gap, stretch) -> probability of a boundary, from weights (gap, stretch, words so far)."""
    steps, n, _ = begun.shape
    forward, f = np.zeros((steps, n, 3)), np.zeros((n, 3))
    f[:, 0] = 1
    for t in range(steps):
        to, g = forward[t], f * kept[t]
        to[:, 0] = (f * begun[t]).sum(1)
        to[:, 1] = g[:, 0]
        to[:, 2] = g[:, 1] + g[:, 2]
        to /= to.sum(1)[:, None]
        f = to
    out, back = np.zeros((steps, n)), np.ones((n, 3))
    for t in range(steps - 1, -1, -1):
        x = forward[t] * back
        out[t] = x[:, 0] / x.sum(1)
        back = begun[t] * back[:, :1] + kept[t] * back[:, [1, 2, 2]]
        back /= back.max(1)[:, None]
    return out


def posteriors(marks: list[str], gaps: list[tuple[int, float]], model: Model) -> list[float]:
    """The probability of a boundary at the given places of a stretch, of which every gap may hold one."""
    found = chances([(marks, gaps)], model)[0]
    return [float(found[j - 1]) for j, _ in gaps]


def untouched(marks: list[str], gaps: list[tuple[int, float]]) -> Iterator[tuple]:
    """The n-grams of a stretch that are the same whatever is decided at its candidates, each with its longest history."""
    reach = ORDER - 1
    row = (START, *marks, END)
    last, n = 0, len(marks) + 1
    # the words that a candidate touches are itself and the next ones within reach
    for low, high in [*((j, j + reach) for j, _ in gaps), (n, n)]:
        for i in range(last, min(low, reach - 1)):
            yield row[: i + 2]
        first = max(last, reach - 1) - reach + 1
        if first + reach - 1 < low:
            yield from zip(*(row[first + k : low - reach + 1 + k] for k in range(reach + 1)))
        last = max(last, high)


def grams_of(marks: list[str], ends: Iterable[int]) -> Iterator[tuple]:
    """The n-grams of a stretch that is divided after so many words, each with its longest history."""
    low = 0
    for high in (*ends, len(marks)):
        yield from untouched(marks[low:high], [])
        low = high


def likely(gaps: list[tuple[int, float]]) -> list[int]:
    """Where the priors alone put boundaries."""
    return [j for j, o in gaps if o > 0.25]


def doubted(marks: list[str], gaps: list[tuple[int, float]]) -> Iterator[tuple]:
    """The n-grams of the other reading around places where the prior is in doubt; they count half as long as there is no model."""
    for j, o in gaps:
        if abs(o) < 1.25:
            for k in range(j, min(len(marks), j + ORDER - 1)):
                yield *(marks[max(0, k - ORDER + 1) : k] if o > 0.25 else (START, *marks[j:k])), marks[k]


def changes(stretches: Iterable[tuple[list[str], list[tuple[int, float]], list[int]]]) -> Counter:
    """By how much the decided boundaries change the counts of n-grams against those of the priors alone."""
    out: Counter = Counter()
    for words, gaps, ends in stretches:
        if ends != (first := likely(gaps)):
            out.update(grams_of(words, ends))
            out.subtract(Counter(grams_of(words, first)))
    return out


def laid(text: str, words: Counter, grams: Counter, doubts: Counter) -> list[tuple]:
    """A text's units and stretches in order, and its words and n-grams by the priors added to the counts.

    A unit is (start, end), a stretch (start, end, words, steps from each word's start to its end and on, candidates).
    """
    out: list[tuple] = []
    for a, b, whole in layout(text):
        if whole:
            out.append((a, b))
            continue
        toks = tokens(text[a:b])
        gaps = candidates(text[a:b], toks)
        marks = [t for t, _, _ in toks]
        words.update(marks)
        grams.update(grams_of(marks, likely(gaps)))
        doubts.update(doubted(marks, gaps))
        out.append((a, b, " ".join(marks), np.diff(np.array([x for t in toks for x in t[1:]], np.int32), prepend=np.int32(0)).tobytes(), gaps))
    return out


def tally(text: str, out: Counter) -> list[tuple]:
    """Adds what a text has of each kind; keys are words with spaces between, as no word holds one. Gives the text laid out."""
    words, grams, doubts = Counter(), Counter(), Counter()
    doc = laid(text, words, grams, doubts)
    out.update(counts(words, grams, doubts))
    return doc


def counts(words: Counter, grams: Counter, doubts: Counter) -> dict[tuple[int, str], int]:
    return {(WORD, w): n for w, n in words.items()} | {(GRAM, " ".join(g)): n for g, n in grams.items()} | {(DOUBT, " ".join(g)): n for g, n in doubts.items()}


def suffixes(gram: tuple) -> Iterator[str]:
    """The n-gram with its history and each shorter one."""
    return (" ".join(gram[k:]) for k in range(len(gram)))


def fold_counts(kind: int, key: str, model: Model) -> Iterator[tuple[int, str]]:
    """A counted n-gram in the model's words, with all shorter ones."""
    return ((kind, g) for g in suffixes(tuple(w if w in (START, END) else model.fold(w) for w in key.split(" "))))


def decided(docs: Iterable[list[tuple]], model: Model) -> Iterator[tuple[list[tuple], list[tuple]]]:
    """Each text that is laid out and, of each of its stretches, the words in the model's words, the candidates and where it is divided."""

    def run() -> Iterator[tuple[list[tuple], list[tuple]]]:
        found = iter([[j + 1 for j in np.flatnonzero(p >= 0.5).tolist()] for p in chances([x for _, own in held for x in own], model)])
        for doc, own in held:
            yield doc, [(words, gaps, next(found)) for words, gaps in own]

    held, n = [], 0
    for doc in docs:
        own = [(model.fold_all(x[2].split(" ") if x[2] else []), x[4]) for x in doc if len(x) > 2]
        held.append((doc, own))
        n += sum(len(words) for words, _ in own)
        if n > WORDS_AT_ONCE:
            yield from run()
            held, n = [], 0
    yield from run()


def fit(texts: list[str]) -> Model:
    """The model of texts at hand; fit_all is the same over a table."""
    seen: Counter = Counter()
    docs = [tally(t, seen) for t in texts]
    model, fixed = Model(frozenset(w for (kind, w), n in seen.items() if kind == WORD and n >= RARE)), Counter()
    for (kind, key), n in seen.items():
        if kind != WORD:
            for k in fold_counts(kind, key, model):
                fixed[k] += n
    last = None
    for _ in range(ROUNDS + 1):
        new = Model(model.vocabulary)
        sums: Counter = Counter({key: n for (kind, key), n in fixed.items() if kind == GRAM})
        if last:
            for gram, n in changes(x for _, own in decided(docs, last) for x in own).items():
                for g in suffixes(gram):
                    sums[g] += n
        else:
            for (kind, key), n in fixed.items():
                sums[key] += n / 2 if kind == DOUBT else 0
        for g, n in sums.items():
            if n > 0:
                *h, word = g.split(" ")
                new.follow[tuple(h), word] = n
                new.total[tuple(h)] += n
                new.kinds[tuple(h)] += 1
        last = new.freeze()
    return last


def _summed(df: DataFrame, f, keys: str, number: str, *text: str) -> DataFrame:
    """f(batch) -> (key tuple, number) pairs; their sums by key, added up in the workers before the shuffle."""
    names = [x.split()[0] for x in keys.split(", ")]
    types = {"int": pa.int32(), "string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}
    schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in (*keys.split(", "), f"n {number}")])

    def out(sums: dict) -> pa.RecordBatch:
        columns = [*zip(*sums), list(sums.values())] if sums else [[] for _ in schema]
        return pa.record_batch([pa.array(c, x.type) for c, x in zip(columns, schema)], schema=schema)

    def run(batches):
        sums: dict = defaultdict(int)
        for batch in in_slices(batches, *text):
            for key, n in f(batch):
                sums[key] += n
                if len(sums) > COUNTED:
                    yield out(sums)
                    sums.clear()
        yield out(sums)

    return df.mapInArrow(run, f"{keys}, n {number}").groupBy(*names).agg(F.sum("n").cast(number).alias("n"))


def _least(sums: DataFrame, most: int, least: float) -> float:
    """What a sum n must exceed to be sent: least, or more where more than `most` sums are above that."""
    step = F.floor(F.log2("n") * 4).cast("int")
    found = {r.s: r["count"] for r in sums.where(F.col("n") > least).groupBy(step.alias("s")).count().collect()}
    held = 0
    for s in sorted(found, reverse=True):
        held += found[s]
        if held > most:
            # all of this step go, so that equal weights fare alike
            return 2 ** ((s + 1) / 4) * (1 - 1e-9)
    return least


def _model(grams: DataFrame, vocabulary: frozenset) -> Model:
    """The model of the n-grams' sums that are sent. Histories keep the totals of all that followed them."""
    split = grams.select(F.when(F.instr("key", " ") > 0, F.expr("substring(key, 1, length(key) - length(substring_index(key, ' ', -1)) - 1)")).otherwise("").alias("h"), F.substring_index("key", " ", -1).alias("w"), "n")
    histories = stored(split.groupBy("h").agg(F.sum("n").alias("n"), F.count("*").cast("double").alias("kinds")), "histories")
    model, words, past = Model(vocabulary), {}, {}

    def tuple_of(h: str) -> tuple:
        if h not in past:
            past[h] = tuple(words.setdefault(w, w) for w in h.split(" ")) if h else ()
        return past[h]

    for batch in histories.where((F.col("n") > _least(histories, MOST_GRAMS, 0.0)) | (F.col("h") == "")).toArrow().to_batches():
        for h, n, kinds in zip(*(c.to_pylist() for c in batch.columns)):
            model.total[tuple_of(h)], model.kinds[tuple_of(h)] = n, kinds
    for batch in split.where((F.col("n") > _least(split.where("h <> ''"), MOST_GRAMS, 1.5)) | (F.col("h") == "")).toArrow().to_batches():
        for h, w, n in zip(*(c.to_pylist() for c in batch.columns)):
            model.follow[tuple_of(h), words.setdefault(w, w)] = n
    model.follow, model.total, model.kinds = dict(model.follow), dict(model.total), dict(model.kinds)
    model.words = max(2.0, model.kinds.get((), 1.0))
    return model


def lay_out(rows: DataFrame) -> DataFrame:
    """kind, key, n, id, doc of rows(id, _text), stored: the counts of words and n-grams, and each text laid out."""
    schema = pa.schema([("kind", pa.int32()), ("key", pa.string()), ("n", pa.int64()), ("id", pa.int64()), ("doc", pa.binary())])

    def said(found: dict) -> pa.RecordBatch:
        kinds, keys = zip(*found) if found else ((), ())
        none = pa.nulls(len(found), pa.int64())
        return pa.record_batch([pa.array(kinds, pa.int32()), pa.array(keys, pa.string()), pa.array(found.values(), pa.int64()), none, pa.nulls(len(found), pa.binary())], schema=schema)

    def run(batches):
        words, grams, doubts = Counter(), Counter(), Counter()
        for batch in in_slices(batches, "_text"):
            docs = []
            for text in batch.column("_text").to_pylist():
                plain = pickle.dumps(laid(text, words, grams, doubts), 5)
                docs.append(len(plain).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True))
                if len(words) + len(grams) + len(doubts) > COUNTED:
                    yield said(counts(words, grams, doubts))
                    words, grams, doubts = Counter(), Counter(), Counter()
            n = len(docs)
            yield pa.record_batch([pa.array([DOC] * n, pa.int32()), pa.nulls(n, pa.string()), pa.array([len(d) for d in docs], pa.int64()), batch.column("id").cast(pa.int64()), pa.array(docs, pa.binary())], schema=schema)
        yield said(counts(words, grams, doubts))

    return stored(rows.select("id", "_text").mapInArrow(run, "kind int, key string, n bigint, id bigint, doc binary"), "layout")


def fit_all(laid_out: DataFrame) -> Model:
    """The model of all texts that lay_out has counted."""
    context = laid_out.sparkSession.sparkContext
    seen = stored(laid_out.where(F.col("kind") != DOC).groupBy("kind", "key").agg(F.sum("n").alias("n")), "tally")
    common = seen.where((F.col("kind") == WORD) & (F.col("n") >= RARE)).orderBy(F.desc("n"), "key").limit(MOST_WORDS)
    bare = Model(frozenset(r.key for r in common.select("key").collect()))
    shared = context.broadcast(bare)

    def folding(batch: pa.RecordBatch):
        for kind, key, n in zip(*(batch.column(c).to_pylist() for c in ("kind", "key", "n"))):
            for k in fold_counts(kind, key, shared.value):
                yield k, n

    folded = stored(_summed(seen.where(F.col("kind") != WORD), folding, "kind int, key string", "bigint", "key"), "folded")
    fixed = folded.where(F.col("kind") == GRAM).select("key", F.col("n").cast("double").alias("n"))
    added = folded.where(F.col("kind") == DOUBT).select("key", (F.col("n") / 2).alias("n"))
    docs, last = laid_out.where(F.col("kind") == DOC).select("doc"), None
    for n in range(ROUNDS + 1):
        if n:
            sent = context.broadcast(last)

            def counting(batch: pa.RecordBatch, sent=sent):
                for _, own in decided(read_docs(batch), sent.value):
                    for gram, n in changes(own).items():
                        if n:
                            for g in suffixes(gram):
                                yield (g,), n

            added = _summed(docs, counting, "key string", "double", "doc")
        sums = fixed.union(added).groupBy("key").agg(F.sum("n").alias("n"))
        last = _model(stored(sums.where("n > 0"), "grams"), bare.vocabulary)
    return last


def read_docs(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """The texts of a batch as they were laid out."""
    return (pickle.loads(pa.decompress(d[8:], int.from_bytes(d[:8], "little"), codec="zstd", asbytes=True)) for d in (x.as_py() for x in batch.column("doc")))


def units_of(doc: list[tuple], own: list[tuple]) -> list[tuple[int, int]]:
    """(start, end) of the sentence units of a text that is laid out and decided."""
    out: list[tuple[int, int]] = []
    stretches = iter(own)
    for a, b, *said in doc:
        start = a
        if said and (ends := next(stretches)[2]):
            at = np.cumsum(np.frombuffer(said[1], np.int32)) + a
            for end, following in zip(at[[2 * j - 1 for j in ends]].tolist(), at[[2 * j for j in ends]].tolist()):
                out.append((start, end))
                start = following
        out.append((start, b))
    return out


def units(text: str | None, model: Model) -> list[tuple[int, int]]:
    """(start, end) of the sentence units."""
    return [u for x in decided([laid(text or "", Counter(), Counter(), Counter())], model) for u in units_of(*x)]


def sentence_units(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, char_start, char_end of each unit of each text."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    laid_out = lay_out(rows)
    model = df.sparkSession.sparkContext.broadcast(fit_all(laid_out))
    schema = pa.schema([(key, pa.int64()), ("char_start", pa.int32()), ("char_end", pa.int32())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(i, *u) for i, x in zip(batch.column("id").to_pylist(), decided(read_docs(batch), model.value)) for u in units_of(*x)]
        return pa.record_batch([pa.array([f[k] for f in found], x.type) for k, x in enumerate(schema)], schema=schema)

    docs = laid_out.where(F.col("kind") == DOC).select("id", "doc")
    return map_texts(docs, "doc", f"`{key}` bigint, char_start int, char_end int", run)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentence units of every document."""
    return sentence_units(read(spark, sf_dir, "documents"), "doc_id", "text")
