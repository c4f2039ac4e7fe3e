"""Personal data by a semi-Markov conditional random field on top of fixed patterns.

The patterns (the base) always stand. The field labels the rest: a segmentation of a window of
tokens into ordinary tokens and entities of up to ``MAX_TOKENS`` tokens, each entity scored as a
whole by its features (digits, letters, marks, spaces, what stands left and right, checksums, cue
words). Dynamic programming chooses boundaries and types together; an entity is added if it is in
the best segmentation, touches no base span, and has at least ``sure`` of the probability mass.
An entity must hold a seed (a digit, an @, or a written-out at or dot), so text without seeds outside
base spans needs no programming, and windows are cut where no entity could reach across. A window
is handled in blocks of ``BLOCK`` tokens: only sums per token are kept across blocks, so a text that is
all digits needs little more memory than any other, with the same result as in one piece.

Weights are learnt by maximum likelihood on a bounded sample: windows around base spans of the
corpus (their spans also rewritten as people write them: other separators, no prefix, "at" and
"dot") and made-up numbers that are no personal data. A few hundred weights are broadcast.

Defined results: a null or empty text has no spans (and stays null when redacted); repeated rows are
treated alike; an empty table gives no rows; other columns pass through ``redacted`` untouched.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import tidied

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 24
BLOCK = 2048  # tokens whose segments are held at once
_REACH = 160  # characters of context on either side of a seed; entities and cues lie within it

Span = tuple[int, int, int]  # kind, start, end

# Fixed patterns. The look-behind and possessive forms match what the plain ones do, without their restarts.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SEED = re.compile(r"[0-9]+|@|[\[({]\s*at\s*[\])}]|\bdot\b", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and place."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            end = host.end()
            found.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _octets(m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, m.start(), m.end()))
        if "+" in text:
            found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return found


# --- tokens and features of segments ---------------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
# Words before a number that tell what it is.
_CUES = {
    "phone": 1, "call": 1, "tel": 1, "fax": 1, "mobile": 1, "cell": 1, "card": 2, "visa": 2, "mastercard": 2, "credit": 2,
    "ip": 3, "host": 3, "address": 3, "server": 3, "email": 4, "mail": 4, "contact": 4, "write": 4,
}
_DIGIT_STEPS = np.searchsorted([1, 4, 7, 9, 10, 11, 12, 13, 16, 17, 20], np.arange(400), side="right")
_SIZES = {
    "digits": 12, "letters": 5, "at": 3, "dots": 5, "dashes": 5, "plus": 3, "parens": 4, "other": 3, "spaces": 6, "ends": 16,
    "left": 5, "right": 6, "tokens": 8, "check": 3, "words": 4, "cue": 5,
    "loose": 4,
}
_BASES = dict(zip(_SIZES, np.cumsum([0, *_SIZES.values()])[:-1].tolist(), strict=True))
N_FEATURES = sum(_SIZES.values())


@dataclass
class Window:
    """Tokens of a stretch of text, and the features of every segment that may be an entity."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each segment: its first token
    last: np.ndarray  # and the token after its last
    features: np.ndarray  # a row of feature numbers per segment
    n: int  # tokens


def _kind(token: str) -> int:
    return 0 if token[0].isalpha() else 1 if "0" <= token[0] <= "9" else 2 if token[0] == "+" else 3


def _tokens(text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens of text[start:end]."""
    places = np.fromiter((x for m in _TOKEN.finditer(text, start, end) for x in m.span()), np.int64).reshape(-1, 2)
    return places[:, 0].copy(), places[:, 1].copy()


def _union(fixed: list[Span]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that the spans cover together, in order."""
    joined: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in fixed):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    both = np.array(joined, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def window(text: str, start: int, end: int, fixed: list[Span]) -> Window:
    """The window of text[start:end]; segments touch no ``fixed`` span."""
    starts, ends = _tokens(text, start, end)
    return _segments(text, starts, ends, _union(fixed), 0, len(starts))


def _segments(text: str, all_starts: np.ndarray, all_ends: np.ndarray, covered: tuple[np.ndarray, np.ndarray], low_token: int, high_token: int) -> Window:
    """The window with the segments whose first token is one of low_token:high_token."""
    origin = max(0, low_token - 4)  # features look at three tokens before a segment and two after it
    starts, ends = (x[origin : high_token + MAX_TOKENS + 2] for x in (all_starts, all_ends))
    words = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    n = len(words)
    kinds = np.array([_kind(w) for w in words], np.int64)
    low = [w.lower() for w in words]
    marks = {k: np.array([w == k for w in words], bool) for k in "@.-+()"}
    said = {k: np.array([w == k for w in low], bool) for k in ("at", "dot")}
    spaced = np.append(starts[1:] > ends[:-1], False) if n else np.zeros(0, bool)  # a space after the token
    joining = said["at"] | said["dot"] | np.array([w in "[](){}" for w in words], bool)
    loose = spaced & ~(joining | np.append(joining[1:], False)) if n else spaced  # a space between words of no address
    seed = (kinds == 1) | marks["@"] | said["dot"]
    for i in np.flatnonzero(said["at"]):
        seed[i] |= 0 < i < n - 1 and words[i - 1] in "[({" and words[i + 1] in "])}"
    before_end = np.searchsorted(covered[0], ends)  # stretches that begin before the token's end
    taken = np.append(-1, covered[1])[before_end] > starts

    def upto(values: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(values)])

    size = np.where(kinds == 1, ends - starts, 0)
    own_tokens = np.arange(low_token - origin, high_token - origin)
    first, last = np.repeat(own_tokens, MAX_TOKENS), (own_tokens[:, None] + np.arange(1, MAX_TOKENS + 1)).ravel()
    keep = last <= n
    first, last = first[keep], last[keep]
    keep = (upto(seed)[last] > upto(seed)[first]) & (upto(taken)[last] == upto(taken)[first])
    first, last = first[keep], last[keep]

    def within(values: np.ndarray) -> np.ndarray:
        sums = upto(values)
        return sums[last] - sums[first]

    digits, letters, spaces = within(size), within(kinds == 0), within(spaced) - spaced[last - 1] if n else within(spaced)
    opened, closed, dots, dashes, ats = (within(marks[k]) for k in "().-@")
    plus = within(marks["+"])
    other = (last - first) - letters - within(kinds == 1) - opened - closed - dots - dashes - ats - plus
    glued_left = (first > 0) & (starts[first] == ends[np.maximum(first - 1, 0)]) if n else keep[:0]
    glued_right = (last < n) & ~spaced[last - 1] if n else keep[:0]
    left_kind, after = kinds[np.maximum(first - 1, 0)] if n else first, np.minimum(last, n - 1)
    stop = np.array([w in ".,;:!?" for w in words], bool)
    open_stop = (stop & (np.append(starts[1:] > ends[:-1], True))) if n else stop  # a full stop before a space
    right = np.where(glued_right, np.where(open_stop[after], 1, 2 + kinds[after]), 0) if n else first
    cue = np.array([_CUES.get(w, 0) for w in low], np.int64)
    before = np.zeros(len(first), np.int64)
    for back in (3, 2, 1):
        at = first - back
        own = np.where(at >= 0, cue[np.maximum(at, 0)] if n else 0, 0)
        before = np.where(own > 0, own, before)
    check = np.zeros(len(first), np.int64)
    whole = letters + other + opened + closed + ats + plus == 0
    for i in np.flatnonzero(whole & (digits >= 13) & (digits <= 19) & (dots == 0)):
        check[i] = luhn("".join(w for w in words[first[i] : last[i]] if w[0].isdigit()))
    for i in np.flatnonzero(whole & (last - first == 7) & (dots == 3) & (spaces == 0)):
        own = words[first[i] : last[i]]
        check[i] = 2 * (all(w[0].isdigit() for w in own[::2]) and _octets(own[::2]))
    columns = {
        "digits": _DIGIT_STEPS[np.minimum(digits, 399)], "letters": np.searchsorted([1, 2, 3, 5], letters, side="right"),
        "at": np.minimum(ats, 2), "dots": np.minimum(dots, 4), "dashes": np.minimum(dashes, 4),
        "plus": np.where(plus == 0, 0, np.where(marks["+"][first] & (plus == 1), 1, 2)) if n else first,
        "parens": np.where(opened != closed, 3, np.minimum(opened, 2)), "other": np.minimum(other, 2),
        "spaces": np.searchsorted([1, 2, 3, 4, 7], spaces, side="right"), "ends": kinds[first] * 4 + kinds[last - 1] if n else first,
        "left": np.where(glued_left, 1 + left_kind, 0), "right": right,
        "tokens": np.searchsorted([2, 3, 4, 6, 8, 9, 13], last - first, side="right"), "check": check,
        "words": np.minimum(within(said["at"]), 1) + 2 * np.minimum(within(said["dot"]), 1), "cue": before,
        "loose": np.minimum(within(loose) - loose[last - 1], 3) if n else first,
    }
    features = np.stack([_BASES[k] + np.asarray(v, np.int64) for k, v in columns.items()], axis=1)
    return Window(all_starts, all_ends, first + origin, last + origin, features, len(all_starts))


# --- the field -------------------------------------------------------------------------------


def scores_of(w: Window, weights: np.ndarray) -> np.ndarray:
    """Score of each segment (rows) as each kind; ordinary tokens score 0."""
    total = np.zeros((len(w.features), weights.shape[1]))
    for column in w.features.T:
        total += weights[column]
    return total + weights[-1]


def _log_sum(values: np.ndarray) -> float:
    top = values.max()
    return float(top + np.log(np.exp(values - top).sum()))


def _grouped(tokens: np.ndarray, low: int, high: int) -> list[np.ndarray]:
    """For each of the tokens low:high, which of ``tokens`` are it."""
    order = np.argsort(tokens, kind="stable")
    return np.split(order, np.searchsorted(tokens[order], np.arange(low, high + 1)))[1:-1]


def _kinds_together(scores: np.ndarray) -> np.ndarray:
    return np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)


def _go_ahead(w: Window, scores: np.ndarray, ahead: np.ndarray, low: int, high: int) -> None:
    """Log sums up to the tokens low + 1 to high, by all segments that end there."""
    best = _kinds_together(scores)
    for j, own in enumerate(_grouped(w.last, low + 1, high + 1), low + 1):
        ahead[j] = _log_sum(np.append(ahead[w.first[own]] + best[own], ahead[j - 1])) if len(own) else ahead[j - 1]


def _go_behind(w: Window, scores: np.ndarray, behind: np.ndarray, low: int, high: int) -> None:
    """Log sums from the tokens low to high - 1, by all segments that begin there."""
    best = _kinds_together(scores)
    for j, own in zip(range(high - 1, low - 1, -1), reversed(_grouped(w.first, low, high)), strict=True):
        behind[j] = _log_sum(np.append(behind[w.last[own]] + best[own], behind[j + 1])) if len(own) else behind[j + 1]


def _passes(w: Window, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log sums of all segmentations up to, and from, each token."""
    ahead, behind = np.zeros(w.n + 1), np.zeros(w.n + 1)
    _go_ahead(w, scores, ahead, 0, w.n)
    _go_behind(w, scores, behind, 0, w.n)
    return ahead, behind


class _Path:
    """The best segmentation up to each token: its score, and the segment that ends there, if one does."""

    def __init__(self, n: int):
        self.top, self.segment, self.first = np.zeros(n + 1), np.full(n + 1, -1), np.zeros(n + 1, np.int64)
        self.kind, self.score = np.zeros(n + 1, np.int64), np.zeros(n + 1)

    def go(self, w: Window, scores: np.ndarray, low: int, high: int) -> None:
        kind, value = scores.argmax(axis=1), scores.max(axis=1)
        for j, own in enumerate(_grouped(w.last, low + 1, high + 1), low + 1):
            self.top[j] = self.top[j - 1]
            if len(own):
                sums = self.top[w.first[own]] + value[own]
                if sums.max() > self.top[j]:
                    i = own[sums.argmax()]
                    self.top[j], self.segment[j], self.first[j], self.kind[j], self.score[j] = sums.max(), i, w.first[i], kind[i], value[i]

    def ends(self) -> list[int]:
        """Where the segments of the best segmentation end."""
        found, j = [], len(self.top) - 1
        while j > 0:
            if self.segment[j] < 0:
                j -= 1
            else:
                found.append(j)
                j = int(self.first[j])
        return found[::-1]


def _best(w: Window, scores: np.ndarray) -> list[tuple[int, int]]:
    """Segments and kinds of the best segmentation."""
    path = _Path(w.n)
    path.go(w, scores, 0, w.n)
    return [(int(path.segment[j]), int(path.kind[j])) for j in path.ends()]


def _windows(text: str, fixed: list[Span]) -> Iterator[tuple[int, int]]:
    """Stretches around seeds outside the fixed spans; those within reach of each other are one."""
    bounds = sorted((a, b) for _, a, b in fixed)
    start = end = -1
    at = 0
    for m in _SEED.finditer(text):
        while at < len(bounds) and bounds[at][1] <= m.start():
            at += 1
        if at < len(bounds) and bounds[at][0] < m.end():
            continue
        if start >= 0 and m.start() - _REACH > end:
            yield start, end
            start = -1
        if start < 0:
            start = max(0, m.start() - _REACH)
        end = min(len(text), m.end() + _REACH)
    if start >= 0:
        yield start, end


def added_spans(text: str, fixed: list[Span], weights: np.ndarray, sure: float) -> list[Span]:
    """Entities the field finds outside the fixed spans."""
    found, covered = [], _union(fixed)
    for start, end in _windows(text, fixed):
        # a word cut by the window's edge is left out
        while 0 < start < end and text[start - 1].isalnum() and text[start].isalnum():
            start += 1
        while start < end < len(text) and text[end - 1].isalnum() and text[end].isalnum():
            end -= 1
        starts, ends = _tokens(text, start, end)
        n = len(starts)

        def scored(low: int, high: int) -> tuple[Window, np.ndarray]:
            w = _segments(text, starts, ends, covered, low, high)
            return w, scores_of(w, weights)

        if n <= BLOCK:
            whole = scored(0, n)
            blocks = [(0, n)] if len(whole[1]) and whole[1].max() > 0 else []
        else:
            whole, blocks = None, [(low, min(n, low + BLOCK)) for low in range(0, n, BLOCK)]
        path, ahead, behind = _Path(n), np.zeros(n + 1), np.zeros(n + 1)
        for low, high in blocks:
            w, scores = whole or scored(max(0, low - MAX_TOKENS), high)  # all segments that end in the block
            path.go(w, scores, low, high)
            if whole is None or path.top[-1] > 0:
                _go_ahead(w, scores, ahead, low, high)
        best = path.ends()
        if best:
            for low, high in reversed(blocks):
                _go_behind(*(whole or scored(low, high)), behind, low, high)
            for j in best:
                first = int(path.first[j])
                if ahead[first] + path.score[j] + behind[j] - ahead[-1] >= np.log(sure):
                    found.append((int(path.kind[j]), int(starts[first]), int(ends[j - 1])))
    return found


# --- learning --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    sample_windows: int = 400  # windows of the corpus learnt from, at most
    rounds: int = 8
    rate: float = 0.5
    sure: float = 0.85
    seed: int = 11


def _rewritten(kind: int, text: str, r: random.Random) -> str:
    """The same entity as people also write it."""
    if kind == 0:
        at, dot = r.choice([("@", "."), (" (at) ", "."), ("[at]", "."), (" [at] ", " [dot] "), (" (at) ", " dot "), (" at ", " dot ")])
        return text.replace("@", at).replace(".", dot) if at != "@" else text
    digits = "".join(_DIGIT.findall(text))
    if kind == 2:
        return r.choice([" ", "-", ""]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == 3 and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{digits[:-10]} {a} {b} {c}", f"+{digits[:-10]}.{a}.{b}.{c}", text])
    return text


def _made_up(r: random.Random) -> tuple[int, str]:
    """An entity, or (kind -1) a number that is none."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    name = lambda: "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(3, 8)))
    kind = r.choice([-1, -1, -1, -1, 0, 1, 2, 3])
    if kind == 0:
        return 0, _rewritten(0, f"{name()}{r.choice(['', '.' + d(2), '.' + name()])}@{name()}.{r.choice(['com', 'org', 'example.com'])}", r)
    if kind == 1:
        return 1, ".".join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        body = r.choice("3456") + d(14)
        return 2, _rewritten(2, next(body + c for c in "0123456789" if luhn(body + c)), r)
    if kind == 3:
        return 3, _rewritten(3, f"+{r.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}", r)
    body = d(15)
    return -1, r.choice([
        next(body + c for c in "0123456789" if not luhn(body + c)), d(r.randint(1, 8)), d(r.randint(9, 12)), f"{d(4)}-{d(2)}-{d(2)}",
        f"{d(2)}:{d(2)}", f"{d(1)}.{d(1)}.{d(1)}", f"{r.randint(256, 999)}.{d(2)}.{d(2)}.{d(1)}", f"{d(2)}.{d(2)}", f"{name()}{d(3)}{name()}{d(2)}",
        f"{d(3)}-{d(2)}", f"{d(3)} {d(3)}", f"({d(4)})", f"{d(1)},{d(3)},{d(3)}", f'"{d(8)}{name()}{d(4)}"', f"{name()} at {name()}", "dot", f"@{name()}",
        f"{d(1)} {d(1)} {d(2)} {d(1)}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(2)} - {d(3)} - {d(2)}",
    ])


def _examples(snippets: list[tuple[str, str, str, int]], s: Settings) -> Iterator[tuple[str, list[Span]]]:
    """Texts with their entities: windows of the corpus as they are, rewritten, and with made-up numbers."""
    r = random.Random(s.seed)
    plain = [("the best of the day was here and ", "", " for all of them to see in the end", -1)]
    cues = ["", "", "", "call ", "tel: ", "card ", "ip ", "email ", "mail: ", "server "]
    for left, own, right, kind in snippets or plain:
        if kind >= 0:
            yield left + own + right, [(kind, len(left), len(left) + len(own))]
            new, left2 = _rewritten(kind, own, r), left + r.choice(cues)
            yield left2 + new + right, [(kind, len(left2), len(left2) + len(new))]
        made, new = _made_up(r)
        yield left + new + right, [(made, len(left), len(left) + len(new))] if made >= 0 else []
    for _ in range(s.sample_windows):
        left, _, right, _ = r.choice(snippets or plain)
        made, new = _made_up(r)
        left = left + r.choice(cues)
        yield left + new + right, [(made, len(left), len(left) + len(new))] if made >= 0 else []


def fit(snippets: list[tuple[str, str, str, int]], s: Settings = Settings()) -> np.ndarray:
    """Weights by AdaGrad on the log-likelihood of the right segmentations."""
    known = []
    for text, spans in _examples(snippets, s):
        w = window(text, 0, len(text), [])
        if not len(w.first):
            continue
        gold = []
        for kind, a, b in spans:
            at = np.flatnonzero((w.starts[w.first] == a) & (w.ends[w.last - 1] == b))
            gold.extend((int(i), kind) for i in at)
        if len(gold) == len(spans):
            known.append((w, gold))
    weights, squares = np.zeros((N_FEATURES + 1, len(KINDS))), np.full((N_FEATURES + 1, len(KINDS)), 1e-6)
    weights[-1] = -1.0
    order = random.Random(s.seed)
    for _ in range(s.rounds):
        order.shuffle(known)
        for w, gold in known:
            scores = scores_of(w, weights)
            ahead, behind = _passes(w, scores)
            mass = -np.exp(ahead[w.first][:, None] + scores + behind[w.last][:, None] - ahead[-1])
            for i, kind in gold:
                mass[i, kind] += 1.0
            step = np.zeros_like(weights)
            rows = np.flatnonzero(np.abs(mass).max(axis=1) > 1e-6)
            np.add.at(step, w.features[rows].ravel(), np.repeat(mass[rows], w.features.shape[1], axis=0))
            step[-1] = mass.sum(axis=0)
            step -= 1e-3 * weights
            squares += step * step
            weights += s.rate * step / np.sqrt(squares)
    return weights


def _snippets(docs: DataFrame, text_col: str, s: Settings) -> list[tuple[str, str, str, int]]:
    """Base spans with some text around, a bounded sample by hash of that text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, str, str, int]] = []
            for value in batch.column(0):
                text = value.as_py() or ""
                spans = base_spans(text)
                for kind, a, b in spans:
                    near = [x for x in spans if x != (kind, a, b) and x[1] < b + 60 and x[2] > a - 60]
                    if not near and b - a <= 100:
                        rows.append((text[max(0, a - 60) : a], text[a:b], text[b : b + 60], kind))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in columns[:3]], pa.array(columns[3], pa.int32())], names=["l", "own", "r", "kind"])

    found = docs.select(text_col).mapInArrow(tidied(cut), "l string, own string, r string, kind int")
    once = found.groupBy("own", "kind").agg(F.min(F.struct("l", "r")).alias("c"))
    chosen = once.select("c.l", "own", "c.r", "kind").orderBy(F.xxhash64("own"), "own", "kind").limit(s.sample_windows)
    return [tuple(row) for row in chosen.collect()]


def learned(docs: DataFrame, text_col: str = "text", s: Settings = Settings()) -> np.ndarray:
    return fit(_snippets(docs, text_col, s), s)


# --- on tables -------------------------------------------------------------------------------

_SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("base", T.BooleanType())]))
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def all_spans(text: str, weights: np.ndarray, sure: float) -> list[tuple[Span, bool]]:
    """Base and added spans with whether they are base, by kind and start."""
    base = base_spans(text)
    added = added_spans(text, base, weights, sure)
    return sorted([(s, True) for s in base] + [(s, False) for s in added], key=lambda x: x[0])


def personal_spans(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """``spans`` of every whole text, by kind and start, in code points, ends exclusive."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType([docs.schema[id_col], T.StructField("spans", _SPANS)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"kind": KINDS[k], "start": a, "end": b, "base": base} for (k, a, b), base in all_spans(t.as_py() or "", sent.value, s.sure)]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPANS_ARROW)], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidied(find), schema)


def redact(text: str, spans: list[tuple[Span, bool]]) -> str:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets."""
    out, end = [], 0
    for kind, a, b in sorted((s for s, _ in spans), key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{KINDS[kind].upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame, text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """The documents with personal data of their texts replaced; all other columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(learned(docs, text_col, s))
    place = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(place)
            new = [None if t is None else redact(t, all_spans(t, sent.value, s.sure)) for t in (v.as_py() for v in old)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(new, old.type))

    return docs.mapInArrow(tidied(clean), docs.schema)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """Per document: counts of base spans, ``base_sha256`` of them, and ``spans``, all of them as text."""
    found = personal_spans(docs, learned(docs, text_col, s), id_col, text_col, s)
    base = F.filter("spans", lambda x: x["base"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    counts = [_count(base, kind) for kind in KINDS]
    return found.select(F.col(id_col), *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _count(spans, kind: str):
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
