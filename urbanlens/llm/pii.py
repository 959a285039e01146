r"""Personal data: patterns, and a character-level bidirectional LSTM with a CRF that adds what the patterns miss.

Patterns find e-mail addresses, IP addresses, payment cards and phone numbers of the usual form (``base_spans``). What they miss (a card behind a phone
number, an address written with ``(at)``, a number without its ``+``) the tagger adds. It reads classes of characters, runs an LSTM in either direction over a window,
scores the tags ``O, B-kind, I-kind`` of each character, and a CRF joins them: a tag inside a span can only follow one of its kind.
It is trained in numpy, from the spans that the patterns mark in a bounded sample of documents, and from variants of these
spans (other separators, two numbers in a row); what has digits and is no personal data is in the windows as well.

Every text is covered by windows of ``WINDOW`` characters that overlap by half. Each of the four kinds has a digit or an ``@``, so a window with neither
has no span, by definition, and is not scored. A window's tags are decoded by Viterbi, a span's confidence is the least marginal probability of its characters'
tags. Then the windows' spans are reconciled over the whole text: those cut off by a window's edge go (the next window has them whole),
equal ones are one, each must pass its kind's check (Luhn, parts up to 255, number of digits), those that touch a span of the patterns
go, and of the rest the set without overlaps and with the largest confidence stays.

One pass without a shuffle; the model is a broadcast of a few kilobytes; a task holds one slice of rows and a batch of windows. The fitting sample is bounded by
``docs`` documents and ``windows`` windows of each kind.

Edge cases: null and empty texts have no spans; positions are code points of the whole text; texts of any length are read in windows; without labelled
spans (an empty table) the patterns are all there is; repeated rows get the same answer; rows with a null id are scored and not learned from;
other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import returning_memory
from urbanlens.llm.conv import Adam

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window (the next begins at its middle), sizes of the network, confidence from which a span counts.
WINDOW, DIM, HIDDEN, SURE = 128, 8, 16, 0.6
_STEP = WINDOW // 2
#: Windows scored at once, and rows whose windows are gathered.
_BATCH, _ROWS = 256, 256

# --- fixed values: the patterns' forms
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
#: What every span holds: a digit, an ``@``, or an address that is written out as ``_LOOKS`` allows it.
_TRIGGER = re.compile(r"[0-9@]|(?:\(at\)|\[at\]|(?<= )at(?= )) ?[A-Za-z0-9-]+ ?(?:\.|\(dot\)|\[dot\]|\[\.\]|(?<= )dot(?= )) ?[A-Za-z0-9-]")
#: What an added span must look like; separators are freer than in the patterns.
_LOOKS = {"email": re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]|(?<= )at(?= )) ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]|\[\.\]|(?<= )dot(?= )) ?[A-Za-z0-9-]+)+"),
          "ip": re.compile(r"[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(\.\)) ?[0-9]{1,3}){3}"),
          "card": re.compile(r"[0-9]+(?:[ ./-][0-9]+)*"), "phone": re.compile(r"(?:\+|00|\()?[0-9][ ()./0-9-]+[0-9]")}
# ---


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, the cross sum a multiple of ten."""
    total = sum(map(int, digits[-1::-2])) + sum(x // 5 + 2 * x % 10 for x in map(int, digits[-2::-2]))
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the patterns' matches, leftmost and without overlap in each kind; matches that fail their check go."""
    out, at, free = [], text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at  # what precedes the @: back to the first other character or the last address
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, 0, m.end()))
                free = m.end()
        at = text.find("@", at + 1)
    if _DIGIT.search(text):
        if "." in text:
            out += ((m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += ((m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15)
    return sorted(out)


def shapes(text: str) -> list[tuple[int, int, int]]:
    """What the tagger learns: the patterns' spans, and numbers that only fail Luhn's check, which no tagger can see."""
    return sorted({*base_spans(text), *((m.start(), 2, m.end()) for m in _CARD.finditer(text) if 14 <= sum(map(str.isdigit, m[0])) <= 19)})


def plausible(kind: int, span: str) -> bool:
    """Whether an added span can be of its kind."""
    if not _LOOKS[KINDS[kind]].fullmatch(span):
        return False
    digits = re.sub("[^0-9]", "", span)
    if kind == 1:
        return all(int(p) <= 255 for p in re.findall("[0-9]+", span))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 10 <= len(digits) <= 15 and len(digits) < len(span)


# --- the tagger

_CLASSES = [*"@.-+()_%:=\"/[]{}<>#&*,;!?'$|~\\ ", "\n"]
#: Class of each code point below 256: 0 is no character, then digits, small and capital letters, others, letters beyond ASCII, the classes above.
_CLASS = np.full(257, 4, np.uint8)
for _i in range(128, 257):
    _CLASS[_i] = 5
for _first, _last, _k in (("0", "9", 1), ("a", "z", 2), ("A", "Z", 3)):
    _CLASS[ord(_first):ord(_last) + 1] = _k
for _k, _c in enumerate(_CLASSES):
    _CLASS[ord(_c)] = 6 + _k
N_CLASSES, N_TAGS = 6 + len(_CLASSES), 1 + 2 * len(KINDS)


def classes(text: str) -> np.ndarray:
    """The classes of a window's characters, filled with 0."""
    out = np.zeros(WINDOW, np.uint8)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out[:len(points)] = _CLASS[np.minimum(points, 256)]
    return out


def tags(spans: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(WINDOW, np.int64)
    for start, kind, end in spans:
        out[start:end] = 2 + 2 * kind
        out[start] = 1 + 2 * kind
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Tagger:
    """Embedded classes, an LSTM forth and one back, a linear layer to the tags' scores, a linear-chain CRF."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.5, (N_CLASSES, DIM)).astype(np.float32)
        self.inward = [rng.normal(0, DIM ** -0.5, (DIM, 4 * HIDDEN)).astype(np.float32) for _ in range(2)]
        self.along = [rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN)).astype(np.float32) for _ in range(2)]
        self.bias = [np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)].astype(np.float32) for _ in range(2)]  # a gate that starts open
        self.out, self.out_bias = rng.normal(0, 0.1, (2 * HIDDEN, N_TAGS)).astype(np.float32), np.zeros(N_TAGS, np.float32)
        self.moves, self.start = np.zeros((N_TAGS, N_TAGS)), np.zeros(N_TAGS)
        #: A tag inside a span comes after one of its kind alone.
        self.barred = np.array([[j > 0 and j % 2 == 0 and i not in (j, j - 1) for j in range(N_TAGS)] for i in range(N_TAGS)])
        self.barred_start = np.array([j > 0 and j % 2 == 0 for j in range(N_TAGS)])

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.inward, *self.along, *self.bias, self.out, self.out_bias, self.moves, self.start]

    def _lstm(self, ids: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """States ``(places, windows, HIDDEN)``; ``keep`` gets what the gradient needs, place by place in reading order."""
        table = self.embedding @ self.inward[way] + self.bias[way]
        n, length = ids.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        states = np.zeros((length, n, HIDDEN), np.float32)
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            z = table[ids[:, t]] + h @ self.along[way]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, before, h_before, tc))
        return states

    def scores(self, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
        """``(places, windows, tags)``."""
        kept = [[] if keep is not None else None for _ in range(2)]
        states = np.concatenate([self._lstm(ids, w, kept[w]) for w in range(2)], axis=2)
        if keep is not None:
            keep.extend([kept, states])
        return (states @ self.out + self.out_bias).astype(np.float64)

    def _chain(self, scores: np.ndarray) -> tuple[np.ndarray, ...]:
        """Transition and start scores, and the chain's forward and backward values as probabilities that are scaled at each place: ``forth * back`` is a tag's marginal."""
        moves, start = np.where(self.barred, -1e4, self.moves), np.where(self.barred_start, -1e4, self.start)
        step, top = np.exp(moves), scores.max(axis=2, keepdims=True)
        local = np.exp(scores - top)
        forth, back, scale = np.empty_like(scores), np.ones_like(scores), np.empty(scores.shape[:2])
        here = np.exp(start) * local[0]
        for t in range(len(scores)):
            if t:
                here = (forth[t - 1] @ step) * local[t]
            scale[t] = here.sum(axis=1)
            forth[t] = here / scale[t][:, None]
        for t in range(len(scores) - 2, -1, -1):
            back[t] = ((local[t + 1] * back[t + 1]) @ step.T) / scale[t + 1][:, None]
        return moves, start, step, local, forth, back, scale, (np.log(scale) + top[:, :, 0]).sum(axis=0)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags of each window by Viterbi, and the marginal probability of each: ``(windows, places)``."""
        scores = self.scores(ids)
        moves, start, _, _, forth, back, _, _ = self._chain(scores)
        best, came = start + scores[0], np.zeros(scores.shape, np.int64)
        for t in range(1, len(scores)):
            ways = best[:, :, None] + moves
            came[t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[t]
        path = np.empty(scores.shape[:2], np.int64)
        path[-1] = best.argmax(axis=1)
        for t in range(len(scores) - 1, 0, -1):
            path[t - 1] = np.take_along_axis(came[t], path[t][:, None], axis=1)[:, 0]
        sure = np.take_along_axis(forth * back, path[:, :, None], axis=2)[:, :, 0]
        return path.T, sure.T

    def gradients(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log likelihood of the tags, and its gradient by each of ``parameters``."""
        keep, n = [], len(ids)
        scores = self.scores(ids, keep)
        (kept, states), gold = keep, gold.T
        moves, start, step, local, forth, back, scale, total = self._chain(scores)
        likely = start[gold[0]] + np.take_along_axis(scores, gold[:, :, None], axis=2)[:, :, 0].sum(axis=0) + moves[gold[:-1], gold[1:]].sum(axis=0)
        d_scores = forth * back
        d_start = d_scores[0].sum(axis=0) - np.bincount(gold[0], minlength=N_TAGS)
        d_moves = -np.bincount((gold[:-1] * N_TAGS + gold[1:]).ravel(), minlength=N_TAGS ** 2).reshape(N_TAGS, N_TAGS).astype(float)
        after = local[1:] * back[1:] / scale[1:, :, None]
        d_moves += step * np.tensordot(forth[:-1], after, axes=([0, 1], [0, 1]))
        np.put_along_axis(d_scores, gold[:, :, None], np.take_along_axis(d_scores, gold[:, :, None], axis=2) - 1, axis=2)
        d_scores = (d_scores / n).astype(np.float32)
        d_states = d_scores @ self.out.T
        d_out = np.tensordot(states, d_scores, axes=([0, 1], [0, 1]))
        one_hot = np.eye(N_CLASSES, dtype=np.float32)[ids.T.ravel()]
        d_embedding, d_in, d_along, d_bias = np.zeros_like(self.embedding), [], [], []
        for way in range(2):
            d_all = np.empty((len(scores), n, 4 * HIDDEN), np.float32)
            d_a, dh, dc = np.zeros_like(self.along[way]), np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for t, i, f, o, g, before, h_before, tc in reversed(kept[way]):
                dh = dh + d_states[t][:, way * HIDDEN:(way + 1) * HIDDEN]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                d_all[t] = dz
                d_a += h_before.T @ dz
                dh, dc = dz @ self.along[way].T, dc * f
            d_table = one_hot.T @ d_all.reshape(-1, 4 * HIDDEN)
            d_in.append(self.embedding.T @ d_table)
            d_embedding += d_table @ self.inward[way].T
            d_along.append(d_a)
            d_bias.append(d_table.sum(axis=0))
        return float((total - likely).mean()), [d_embedding, *d_in, *d_along, *d_bias, d_out, d_scores.sum(axis=(0, 1)), np.where(self.barred, 0, d_moves / n), d_start / n]

    def fit(self, texts: list[str], spans: list[list[tuple[int, int, int]]], steps: int = 300, batch: int = 48, rate: float = 0.01, seed: int = 1) -> Tagger:
        """Learn from windows and their spans, in batches of equal parts of each kind (and of windows without a span), half of them as variants."""
        rng = np.random.default_rng(seed)
        groups = [[i for i, s in enumerate(spans) if any(k == kind for _, k, _ in s)] for kind in range(len(KINDS))] + [[i for i, s in enumerate(spans) if not s]]
        groups = [g for g in groups if g]
        adam, parameters = Adam(self.parameters(), rate), self.parameters()
        for step in range(steps):
            chosen = [int(rng.choice(groups[k % len(groups)])) for k in range(batch)]
            pairs = [variant(texts[i], spans[i], rng) if rng.random() < 0.5 else (texts[i], spans[i]) for i in chosen]
            ids, gold = np.stack([classes(t[:WINDOW]) for t, _ in pairs]), np.stack([tags(s) for _, s in pairs])
            _, gradient = self.gradients(ids.astype(np.intp), gold)
            norm = float(np.sqrt(sum((g * g).sum() for g in gradient)))
            adam.rate = rate * (1 - 0.9 * step / steps)
            adam.step([(g * min(1.0, 5 / max(norm, 1e-9))).astype(p.dtype) for g, p in zip(gradient, parameters, strict=True)])
        return self


def variant(text: str, spans: list[tuple[int, int, int]], rng: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """The window with its spans written in other ways, some followed by one more number, and the spans' new places."""
    out, at, placed = "", 0, []

    def put(kind: int, span: str) -> None:
        nonlocal out
        if len(out) + len(span) < WINDOW:
            placed.append((len(out), kind, len(out) + len(span)))
        out += span

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def rewritten(kind: int, span: str) -> str:
        way = rng.integers(0, 4)
        if kind == 0:
            name, _, host = span.partition("@")
            dot = (".", ".", "[.]", " dot ")[way]
            return name + ("(at)", " @ ", "[at]", " at ")[way] + host.replace(".", dot)
        if kind == 1:
            return span.replace(".", (".", " . ", "[.]", "(.)")[way])
        if kind == 2:
            n = re.sub("[^0-9]", "", span)
            return ("", " ", ".", "-")[way].join([n[:4], n[4:8], n[8:12], n[12:]])
        return (span[1:], "00" + span[1:], re.sub(r"^\+[0-9]+ ?", "", span), span.replace(" ", "."))[way]

    for start, kind, end in spans:
        if start < at:
            continue
        out += text[at:start]
        at = end
        put(kind, rewritten(kind, text[start:end]) if rng.random() < 0.7 else text[start:end])
        if kind >= 2 and rng.random() < 0.4:
            out += " "
            if rng.random() < 0.5:
                put(2, digits(16))
            else:
                put(3, f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}")
    return out + text[at:], placed


# --- windows of a text

def window_starts(text: str) -> Iterator[int]:
    """Starts of the windows that hold a digit, an ``@`` or the middle of an address that is written out, ascending."""
    last, m = -1, _TRIGGER.search(text)
    while m:
        cell = m.start() // _STEP
        for k in (cell - 1, cell):
            if k > last and (k >= 0 and (k == 0 or k * _STEP + _STEP < len(text))):
                yield k * _STEP
                last = k
        m = _TRIGGER.search(text, (cell + 1) * _STEP)


def window_spans(path: np.ndarray, sure: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """``(start, kind, end, confidence)`` of the spans that one window's tags spell."""
    for start in np.flatnonzero(path % 2 == 1).tolist():
        end = start + 1
        while end < len(path) and path[end] == path[start] + 1:
            end += 1
        yield start, int(path[start]) // 2, end, float(sure[start:end].min())


def reconciled(text: str, found: list[tuple[int, int, int, float]], base: list[tuple[int, int, int]], sure: float = SURE) -> list[tuple[int, int, int, float]]:
    """Of all windows' spans the plausible ones clear of ``base``, without overlaps, of the largest total confidence."""
    best: dict[tuple[int, int, int], float] = {}
    ends = sorted(base, key=lambda s: s[2])
    reach, most = [s[2] for s in ends], []
    low = len(text) + 1
    for s in reversed(ends):  # the leftmost start among spans that end here or later
        low = min(low, s[0])
        most.append(low)
    most.reverse()
    for start, kind, end, p in found:
        while start < end and text[end - 1] in " \t\n.,;:":
            end -= 1
        while start < end and text[start] in " \t\n":
            start += 1
        after = bisect_right(reach, start)
        if p >= sure and plausible(kind, text[start:end]) and not (after < len(most) and most[after] < end):
            best[start, kind, end] = max(p, best.get((start, kind, end), 0.0))
    spans = sorted((end, start, kind, p) for (start, kind, end), p in best.items())
    stops, total, chosen = [s[0] for s in spans], [0.0], []
    for i, (end, start, _, p) in enumerate(spans):
        k = bisect_right(stops, start, 0, i)
        take = total[k] + p
        chosen.append(k if take > total[-1] else -1)
        total.append(max(take, total[-1]))
    out, i = [], len(spans)
    while i > 0:
        if chosen[i - 1] >= 0:
            end, start, kind, p = spans[i - 1]
            out.append((start, kind, end, p))
            i = chosen[i - 1]
        else:
            i -= 1
    return out[::-1]


def find_in(texts: list[str], tagger: Tagger | None, sure: float = SURE) -> list[tuple[list, list]]:
    """For each text the patterns' spans and the added ones."""
    base = [base_spans(t) for t in texts]
    found: list[list] = [[] for _ in texts]
    held: list[tuple[int, int]] = []

    def score() -> None:
        ids = np.stack([classes(texts[i][at:at + WINDOW]) for i, at in held]).astype(np.intp)
        path, marginal = tagger.decode(ids)
        for (i, at), p, m in zip(held, path, marginal, strict=True):
            if p.any():
                n = len(texts[i])
                for start, kind, end, confidence in window_spans(p, m):
                    if (start or not at) and (end < WINDOW or at + WINDOW >= n):  # else a window's edge cuts it
                        found[i].append((at + start, kind, min(at + end, n), confidence))
        held.clear()

    if tagger is not None:
        for i, t in enumerate(texts):
            for at in window_starts(t):
                held.append((i, at))
                if len(held) == _BATCH:
                    score()
        if held:
            score()
    return [(b, reconciled(t, f, b, sure) if f else []) for t, f, b in zip(texts, found, base, strict=True)]


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", docs_read: int = 8000, windows: int = 400, steps: int = 300) -> Tagger | None:
    """A tagger from at most about ``docs_read`` documents (by a hash of the id) and ``windows`` windows of each kind; None if they have no span."""
    import pyarrow as pa
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    share = min(1.0, docs_read / max(1, rows.count()))
    rows = rows.filter((F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1e6)) & F.col("text").rlike("[0-9@]"))
    schema = pa.schema([("id", pa.int64()), ("at", pa.int64()), ("kind", pa.int32()), ("text", pa.string()), ("spans", pa.list_(pa.list_(pa.int32())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"], strict=True):
                text, out = text.as_py(), []
                base = shapes(text)
                for at in window_starts(text):
                    own = [(s - at, k, e - at) for s, k, e in base if at <= s and e <= at + WINDOW]
                    if any(s < at + WINDOW and e > at and not (at <= s and e <= at + WINDOW) for s, _, e in base):
                        continue  # cut by the edge
                    out.append((doc_id, at, own[0][1] if own else len(KINDS), text[at:at + WINDOW], [list(x) for x in own]))
                    if len(out) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    found = rows.mapInArrow(returning_memory(run), "id long, at long, kind int, text string, spans array<array<int>>")
    first = Window.partitionBy("kind").orderBy(F.xxhash64("id", "at"), "id", "at")
    sample = found.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= windows).orderBy("kind", "n").select("text", "spans").collect()  # bounded
    spans = [[tuple(s) for s in r.spans] for r in sample]
    return Tagger().fit([r.text for r in sample], spans, steps) if any(spans) else None


SPANS = "array<struct<start:int,kind:string,end:int,base:boolean,confidence:double>>"


def find(docs: DataFrame, tagger: Tagger | None, *, id_col: str = "doc_id", text_col: str = "text", sure: float = SURE) -> DataFrame:
    """``id, spans`` for every row: by start, then kind as listed in ``KINDS``; ``base`` for those of the patterns (confidence 1)."""
    import pyarrow as pa
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("base", pa.bool_()), ("confidence", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(first, _ROWS)
                out = []
                for base, added in find_in(batch["text"].to_pylist(), shared.value, sure):
                    spans = sorted([(s, k, e, True, 1.0) for s, k, e in base] + [(s, k, e, False, p) for s, k, e, p in added])
                    out.append([{"start": s, "kind": KINDS[k], "end": e, "base": b, "confidence": p} for s, k, e, b, p in spans])
                yield pa.RecordBatch.from_arrays([batch["id"].cast(pa.int64()), pa.array(out, pa.list_(kind))], names=["id", "spans"])

    return rows.mapInArrow(returning_memory(run), f"id long, spans {SPANS}").withColumnRenamed("id", id_col)


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
