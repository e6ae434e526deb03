"""Personal data: fixed patterns, and a linear-chain CRF over word shapes that adds what they miss.

The base spans (email, ip, card, phone) come from fixed patterns with checks. The conditional random field is
trained here, by gradient descent on the exact likelihood, from the small labelled table in ``pii_labels.txt``, and
finds forms the patterns do not know: phone numbers without a country code, addresses spelled with "at" and "dot".
Its spans are added where they hold what their kind needs (:func:`plausible`); base spans stay.

In the model only a token with a digit or ``@``, or one of the five words of "name at host dot end", can have a
label other than O. A text thus falls apart at all other tokens into short chains, which are decoded exactly by
Viterbi, many at a time in numpy arrays, each chain whole. Every step is linear in the length of a text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from importlib import resources

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.common import documents, free_name

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match starts where a run of digits does; elsewhere in a run it would fail in the same way.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


#: The local part is found backwards from each "@": a pattern that starts at every word would be quadratic.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    """The matches of EMAIL, leftmost and without overlap."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    return found


def address_parts(found: str) -> bool:
    """Whether four runs of digits are at most 255 each, with any number of zeros before."""
    parts = [p.lstrip("0") for p in found.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind."""
    out = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if address_parts(m[0]):
            out.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), m.end(), 3))
    out.sort(key=lambda s: (s[0], s[2]))
    return [(a, b, KINDS[k]) for a, b, k in out]


# --- the labelled table ---------------------------------------------------------------------------------------

LABELS = ("O", "B-email", "I-email", "B-ip", "I-ip", "B-card", "I-card", "B-phone", "I-phone")
CUES = frozenset(["at", "dot", "(at)", "[at]", "(dot)", "[dot]", "ext", "ext."])
MARK = re.compile(r"\{(\w+) ([^}]*)\}|(\S+)")


def labelled() -> list[list[tuple[str, str]]]:
    """The stored sentences as lists of (token, label): each kind of personal data in several forms, and near misses."""
    out = []
    for line in resources.files("provenant.llm").joinpath("pii_labels.txt").read_text("utf-8").splitlines():
        sentence = []
        for kind, inside, word in MARK.findall(line):
            sentence += [(w, f"{'I' if i else 'B'}-{kind}") for i, w in enumerate(inside.split())] if kind else [(word, "O")]
        out.append(sentence)
    return out


# --- the model ------------------------------------------------------------------------------------------------

N_FEATURES = 1 << 12


MARKED = re.compile(r"[0-9@]\S*")
SPELLED = re.compile(r"(?<!\S)(\S+)[ \t]+(\(at\)|\[at\]|at)[ \t]+(\S+)[ \t]+(\(dot\)|\[dot\]|dot)[ \t]+(\S+)", re.I)


def free(word: str) -> bool:
    """Whether a token may by itself have another label than O."""
    return bool(MARKED.search(word))


def free_tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the tokens of a text that may have another label than O, in order."""
    out = []
    for m in MARKED.finditer(text):
        start = m.start()
        while start and not text[start - 1].isspace():
            start -= 1
        out.append((start, m.end()))
    low = text if "dot" in text else text.lower()
    if "dot" in low:
        for m in SPELLED.finditer(text):
            out += [m.span(g) for g in range(1, 6)]
        out = sorted(set(out))
    return out


def shape(word: str) -> str:
    """Letters as a, capitals as A, digits as 9; runs of a letter class are cut to one, runs of digits to their length."""
    word = re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", word)
    word = re.sub(r"a+", "a", re.sub(r"A+", "A", word))
    return re.sub(r"[0-9]+", lambda m: f"9{min(len(m[0]), 20)}", word)


def crc(feature: str) -> int:
    import zlib

    return zlib.crc32(feature.encode()) % N_FEATURES


def remembered(features_of):
    """A cache for words of usual length: long ones are rare and would fill the memory."""
    cached = lru_cache(maxsize=200_000)(features_of)
    return lambda word, *side: (cached if len(word) <= 64 else features_of)(word, *side)


@remembered
def own_features(word: str) -> tuple[int, ...]:
    core = word.strip(".,;:!?\"'")
    low, digits = core.lower(), sum(c.isdigit() for c in core)
    return tuple(map(crc, (f"s={shape(core)}", f"c={low if low in CUES else ''}", f"n={min(digits, 20)}", f"dots={core.count('.')}", f"p={core[:1] in '(+['}", f"at={'@' in core}", f"d={core.isdigit()}")))


@remembered
def near_features(word: str, side: str) -> tuple[int, ...]:
    core = word.strip(".,;:!?\"'")
    low = core.lower()
    return (crc(f"{side}s={shape(core) if free(word) else '-'}"), crc(f"{side}c={low if low in CUES else ''}"))


def features(words: list[str], i: int) -> tuple[int, ...]:
    return own_features(words[i]) + near_features(words[i - 1], "<") + near_features(words[i + 1], ">")


N_OWN = 11


def logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


class Crf:
    """Weights of features by label, of transitions, and which transitions the labels allow."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, np.where(ALLOWED, move, -1e4)

    def viterbi(self, feats: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of chains padded to one length; feats: chains x length x N_OWN. O stands on both sides."""
        scores = self.emit[feats].sum(2)
        n, steps, k = scores.shape
        best, back = scores[:, 0] + self.move[0], np.zeros((n, steps, k), np.int8)
        last = np.where((lengths == 1)[:, None], best + self.move[:, 0], 0.0)
        for t in range(1, steps):
            through = best[:, :, None] + self.move
            back[:, t] = through.argmax(1)
            best = through.max(1) + scores[:, t]
            last = np.where((lengths == t + 1)[:, None], best + self.move[:, 0], last)
        out, at = np.zeros((n, steps), np.int8), last.argmax(1)
        for t in range(steps - 1, -1, -1):
            inside = t < lengths
            out[inside, t] = at[inside]
            at = np.where(inside, back[np.arange(n), t, at], at)
        return out


ALLOWED = np.array([[not b.startswith("I-") or a[2:] == b[2:] for b in LABELS] for a in LABELS])


def padded(rows: list[list[tuple[int, ...]]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    feats = np.zeros((len(rows), lengths.max(), N_OWN), np.int32)
    for i, r in enumerate(rows):
        feats[i, : len(r)] = r
    return feats, lengths


@lru_cache(maxsize=2)
def trained(steps: int = 60, rate: float = 0.3, decay: float = 1e-5) -> Crf:
    """Gradient ascent (Adam) on the exact log-likelihood of the labelled table; the same on every machine."""
    rows, gold = [], []
    for sentence in labelled():
        text, starts = " ".join(w for w, _ in sentence), {}
        for i, (w, _) in enumerate(sentence):
            starts[sum(len(x) + 1 for x, _ in sentence[:i])] = i
        for words, spans in free_chains(text):
            rows.append([features(words, i) for i in range(1, len(words) - 1)])
            gold.append([LABELS.index(sentence[starts[a]][1]) for a, _ in spans])
    feats, lengths = padded(rows)
    n, steps_t, k = len(rows), feats.shape[1], len(LABELS)
    y = np.zeros((n, steps_t), int)
    for i, g in enumerate(gold):
        y[i, : len(g)] = g
    inside = np.arange(steps_t) < lengths[:, None]
    seen_emit = np.zeros((N_FEATURES, k))
    for t in range(N_OWN):
        np.add.at(seen_emit, (feats[..., t][inside], y[inside]), 1)
    seen_move = np.zeros((k, k))
    np.add.at(seen_move, (0, y[:, 0]), 1)
    np.add.at(seen_move, (y[np.arange(n), lengths - 1], 0), 1)
    both = inside[:, 1:]
    np.add.at(seen_move, (y[:, :-1][both], y[:, 1:][both]), 1)
    emit, move = np.zeros((N_FEATURES, k)), np.zeros((k, k))
    first, second = [np.zeros_like(emit), np.zeros_like(move)], [np.zeros_like(emit), np.zeros_like(move)]
    for step in range(1, steps + 1):
        m = np.where(ALLOWED, move, -1e4)
        s = emit[feats].sum(2)
        alpha = np.zeros((n, steps_t, k))
        alpha[:, 0] = s[:, 0] + m[0]
        for t in range(1, steps_t):
            nxt = logsum(alpha[:, t - 1][:, :, None] + m, 1) + s[:, t]
            alpha[:, t] = np.where(inside[:, t][:, None], nxt, alpha[:, t - 1])
        z = logsum(alpha[:, -1] + m[:, 0], 1)
        beta = np.zeros((n, steps_t, k))
        beta[:, -1] = m[:, 0]
        move_p = np.zeros((k, k))
        for t in range(steps_t - 2, -1, -1):
            onward = m + (s[:, t + 1] + beta[:, t + 1])[:, None, :]
            go = inside[:, t + 1]
            beta[:, t] = np.where(go[:, None], logsum(onward, 2), m[:, 0])
            if go.any():
                move_p += np.exp(alpha[go, t][:, :, None] + onward[go] - z[go, None, None]).sum(0)
        post = np.exp(alpha + beta - z[:, None, None]) * inside[..., None]
        move_p[0] += post[:, 0].sum(0)
        move_p[:, 0] += post[np.arange(n), lengths - 1].sum(0)
        emit_p = np.zeros_like(emit)
        for t in range(N_OWN):
            for label in range(k):
                emit_p[:, label] += np.bincount(feats[..., t][inside], post[..., label][inside], N_FEATURES)
        for w, grad, i in ((emit, (seen_emit - emit_p) / n - decay * emit, 0), (move, (seen_move - move_p) / n - decay * move, 1)):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.99 * second[i] + 0.01 * grad**2
            w += rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return Crf(emit, move)


# --- decoding -------------------------------------------------------------------------------------------------

#: Tokens of chains that are decoded together; a longer chain is decoded alone.
BATCH = 1 << 15


def word_before(text: str, at: int) -> str:
    """The last word before a place."""
    size = 64
    while True:
        part = text[max(0, at - size) : at]
        words = part.split()
        if size >= at or len(words) > 1 or (words and part[0].isspace()):
            return words[-1] if words else ""
        size *= 4


def word_after(text: str, at: int) -> str:
    """The first word from a place on."""
    size = 64
    while True:
        part = text[at : at + size]
        words = part.split()
        if at + size >= len(text) or len(words) > 1 or (words and part[-1].isspace()):
            return words[0] if words else ""
        size *= 4


def free_chains(text: str) -> list[tuple[list[str], list[tuple[int, int]]]]:
    """Chains of a text as (words with one neighbour on each side, spans of the inner words)."""
    chains, run = [], []
    for a, b in free_tokens(text):
        if run and (between := text[run[-1][1] : a]) and (not between.isspace() or "\n" in between):
            chains.append(run)
            run = []
        run.append((a, b))
    if run:
        chains.append(run)
    return [([word_before(text, run[0][0]), *(text[x:y] for x, y in run), word_after(text, run[-1][1])], run) for run in chains]


def batches_of(jobs: list) -> Iterator[list]:
    """Jobs, by length of their chain, in parts of at most ``BATCH`` tokens when padded, one job at least."""
    part: list = []
    for job in sorted(jobs, key=lambda j: len(j[1])):
        if part and (len(part) + 1) * len(job[1]) > BATCH:
            yield part
            part = []
        part.append(job)
    if part:
        yield part


def crf_spans(model: Crf, texts: list[str]) -> list[list[tuple[int, int, str]]]:
    """Spans of the model in each text."""
    jobs = []
    for i, text in enumerate(texts):
        for words, spans in free_chains(text):
            jobs.append((i, spans, [features(words, j) for j in range(1, len(words) - 1)]))
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for part in batches_of(jobs):
        labels = model.viterbi(*padded([f for _, _, f in part]))
        for (i, spans, _), row in zip(part, labels, strict=True):
            a = None
            for j in range(len(spans) + 1):
                label = LABELS[row[j]] if j < len(spans) else "O"
                if a is not None and not label.startswith("I-"):
                    x, y = spans[a][0], spans[j - 1][1]
                    kept = texts[i][x:y].rstrip(".,;:!?\"'*#$%&")
                    if kept:
                        out[i].append((x, x + len(kept), LABELS[row[a]][2:]))
                    a = None
                if label.startswith("B-"):
                    a = j
    return out


def plausible(kind: str, found: str) -> bool:
    """An added span must have what its kind needs at the least."""
    n = len(NOT_DIGIT.sub("", found))
    if kind == "phone":
        return 7 <= n <= 15 and not re.search(r"[A-Za-z@]", found)
    if kind == "email":
        words = re.findall(r"\w+", found.lower())
        return "@" in found or ("at" in words and "dot" in words[words.index("at") :])
    if kind == "card":
        return 12 <= n <= 19 and luhn(NOT_DIGIT.sub("", found))
    return bool(re.fullmatch(r"[0-9]+(\.[0-9]+){3}", found)) and address_parts(found)


def all_spans(base: list[tuple[int, int, str]], extra: list[tuple[int, int, str]], text: str) -> list[tuple[int, int, str]]:
    """Base spans, and the model's that overlap none of them."""
    starts, ends = [], []  # the base spans' union
    for a, b, _ in sorted(base):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def free_place(a: int, b: int) -> bool:
        i = bisect_left(starts, b) - 1  # the last one that starts before the span's end
        return i < 0 or ends[i] <= a

    add = [s for s in extra if free_place(s[0], s[1]) and plausible(s[2], text[s[0] : s[1]])]
    return sorted(base + add, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one, the first's."""
    out, end = [], 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[end:a], f"<{kind.upper()}>"]
        end = max(end, b)
    return "".join(out) + text[end:]


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with base_spans, spans (strings) and masked_text.

    Defined results: a null text is an empty one, without spans; repeated rows are searched each; columns called
    like a result are replaced, all others are kept; an empty table gives an empty table; a text is searched whole,
    however long, and its chains are decoded whole; ties of the model go to the first label.
    """

    model = trained()  # a bounded table, a fixed number of steps: some 300 KB, sent with the function
    column = free_name(docs)

    @F.pandas_udf("base_spans string, spans string, masked_text string")
    def search(texts: pd.Series) -> pd.DataFrame:
        rows = []
        texts = texts.tolist()
        for at in range(0, len(texts), 500):
            part = texts[at : at + 500]
            for t, extra in zip(part, crf_spans(model, part), strict=True):
                base = base_spans(t)
                every = all_spans(base, extra, t)
                rows.append((joined(base), joined(every), masked(t, every)))
        return pd.DataFrame(rows, columns=["base_spans", "spans", "masked_text"])

    out = docs.drop("base_spans", "spans", "masked_text")
    out = out.withColumn(column, search(F.coalesce(F.col(text), F.lit(""))))
    return out.select(*[c for c in out.columns if c != column], f"{column}.*")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(documents(spark, sf_dir))
    counts = [F.regexp_count("base_spans", F.lit(f"{k}:")).cast("long").alias(f"n_{k}") for k in KINDS]
    n_spans = F.regexp_count("spans", F.lit(":[0-9]+:")).cast("long").alias("n_spans")
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans", n_spans)
