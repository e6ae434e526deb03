import hashlib
import random
import re
import time

import pytest

from provenant.llm import pii
from provenant.llm.pii import EMAIL, KINDS, base_spans, crf_spans, emails, find_pii, free_chains, labelled, masked, trained

WORDS = "the a and call mail me write to under or from is was his her number phone order page year in of on version chapter item total price weeks euros table see figure room looked met".split()
NAMES = "anna ben carla dimitri elena farid grace hugo ines jonas kim lena marco nina omar paula".split()
HOSTS = "mail post example company school".split()


def generated(n_sentences, seed) -> list[list[tuple[str, str]]]:
    """Sentences of (token, label), made by rule: none of them is in the table that the model is trained on."""
    rng = random.Random(seed)
    d = lambda n: "".join(rng.choices("0123456789", k=n))

    def mark(kind: str, text: str) -> list[tuple[str, str]]:
        return [(w, f"{'I' if i else 'B'}-{kind}") for i, w in enumerate(text.split())]

    def entity() -> list[tuple[str, str]]:
        name, host, end = rng.choice(NAMES), rng.choice(HOSTS), rng.choice(["com", "org", "net"])
        at, dot = rng.choice([("at", "dot"), ("(at)", "(dot)"), ("[at]", "[dot]")])
        return rng.choice([
            lambda: mark("email", f"{name}{d(rng.choice([0, 1, 2]))}@{host}.{end}"),
            lambda: mark("email", f"{name}{d(2)} {at} {host}{d(1)} {dot} {end}"),
            lambda: mark("ip", ".".join(str(rng.randrange(256)) for _ in range(4))),
            lambda: mark("card", " ".join(d(4) for _ in range(4))),
            lambda: mark("card", d(16)),
            lambda: mark("phone", f"({d(3)}) {d(3)}-{d(4)}"),
            lambda: mark("phone", f"{d(3)}-{d(3)}-{d(4)}"),
            lambda: mark("phone", f"+{d(2)} {d(3)} {d(7)}"),
            lambda: mark("phone", f"+1 ({d(3)}) {d(3)}-{d(4)}"),
        ])()

    def other() -> list[tuple[str, str]]:
        text = rng.choice([
            d(1), d(2), d(3), d(4), d(5), d(6), f"{d(1)}.{d(1)}", f"{d(1)}.{d(1)}.{d(1)}", f"{d(2)}%", f"{d(2)}:{d(2)}", f"{d(3)},{d(3)}", f"{d(4)}-{d(2)}-{d(2)}",
            f"({d(4)})", f"v{d(1)}.{d(2)}", f"{d(2)}-{d(2)}", f"{d(3)} {d(3)}", f"{d(4)} {d(2)} {d(1)}", "at", "at dot", f"at {d(2)}", f"{d(2)} at {d(1)}", "ext", f"#{d(5)}",
            f"@{rng.choice(NAMES)}", "".join(rng.choices("0123456789abcdef", k=rng.choice([8, 24, 40]))), f"{d(9)}", f"{d(20)}",
        ])
        return [(w, "O") for w in text.split()]

    out = []
    for _ in range(n_sentences):
        sentence: list[tuple[str, str]] = []
        for _ in range(rng.randrange(1, 4)):
            sentence += [(w, "O") for w in rng.choices(WORDS, k=rng.randrange(1, 5))]
            sentence += entity() if rng.random() < 0.5 else other()
        out.append(sentence + [(w, "O") for w in rng.choices(WORDS, k=rng.randrange(3))])
    return out


def texts(n=1500):
    rng = random.Random(1)
    parts = ["a", "b.c", "@", ".", "-", "x@y.zz", "12", "4", "255", "256", " ", "+", "(", ")", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 123-4567", "é", "\n", "٣"]
    return ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(n)]


def test_emails_are_the_matches_of_the_pattern():
    for text in texts(5000):
        assert emails(text) == [m.span() for m in EMAIL.finditer(text)], text


def test_base_spans():
    text = "Mail a.b+c@x-y.example.com, 10.0.0.256 or 10.0.0.255; 4111-1111 1111 1111, not 4111111111111112; +1 (555) 123-4567."
    assert [(text[a:b], k) for a, b, k in base_spans(text)] == [
        ("a.b+c@x-y.example.com", "email"), ("10.0.0.255", "ip"), ("4111-1111 1111 1111", "card"), ("+1 (555) 123-4567", "phone"),
    ]
    assert base_spans("") == [] and base_spans("a" * 200_000) == []


def test_model_on_held_out_sentences():
    model, right, wrong, missed = trained(), 0, 0, 0
    sentences, known = generated(400, seed=99), {" ".join(w for w, _ in s) for s in labelled()}
    assert len(known) > 100 and not known & {" ".join(w for w, _ in s) for s in sentences}
    found = crf_spans(model, [" ".join(w for w, _ in s) for s in sentences])
    for sentence, spans in zip(sentences, found, strict=True):
        gold, at = set(), 0
        for w, label in sentence:
            if label.startswith("B-"):
                gold.add((at, label[2:]))
            at += len(w) + 1
        got = {(a, k) for a, _, k in spans}
        right, wrong, missed = right + len(gold & got), wrong + len(got - gold), missed + len(gold - got)
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9


def test_viterbi_equals_enumeration():
    import itertools

    import numpy as np

    model = trained()
    for words, _ in free_chains("call (123) 456-7890 or +1 22\n12 at 5 dot 3 now"):
        feats = [pii.features(words, i) for i in range(1, len(words) - 1)]
        if len(feats) > 5:
            continue
        got = model.viterbi(*pii.padded([feats, feats[:1]]))[0][: len(feats)]
        e = model.emit[np.array(feats)].sum(1)
        score = lambda p: model.move[0, p[0]] + sum(e[i, x] for i, x in enumerate(p)) + sum(model.move[a, b] for a, b in itertools.pairwise(p)) + model.move[p[-1], 0]  # noqa: E731, B023
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(feats)), key=score)
        assert tuple(got) == best


def test_added_spans_and_masking(spark):
    text = "Ring (212) 555-0123 or write to anna7 at post dot org, or b@c.de. Table 12 of 300."
    rows = [(1, text, "x"), (1, text, "y"), (2, None, None), (None, "", "z"), (3, "plain words only " * 50_000, "")]
    out = {(r.doc_id, r.spans): r for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()}
    (found,) = [r for r in out.values() if r.doc_id == 1]
    assert [s.split(":")[0] for s in found.spans.split(",")] == ["phone", "email", "email"]
    assert found.base_spans in found.spans
    assert found.masked_text == "Ring <PHONE> or write to <EMAIL>, or <EMAIL>. Table 12 of 300."
    assert all(r.spans == "" and r.masked_text == r.text or not r.text for r in out.values() if r.doc_id != 1)
    assert masked("abcdef", [(1, 3, "ip"), (2, 4, "card")]) == "a<IP>ef"


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in pii.op6_pii(spark, "/root/testdata/sf0.001").collect():
        base = contract_spans(docs[r.doc_id] or "")
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[2] == k for s in base) for k in KINDS]
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def contract_spans(text):
    """The base spans as the contract states them, without the module's patterns."""
    digits = lambda s: [c for c in s if c in "0123456789"]

    def passes_luhn(s):
        total = 0
        for i, c in enumerate(reversed(digits(s))):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: max(map(int, s.split("."))) <= 255),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and passes_luhn(s)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    out = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m[0])]
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


def test_base_spans_equal_the_contract():
    for text in texts(5000):
        assert base_spans(text) == contract_spans(text), text


def test_legal_texts_that_look_like_numbers():
    odd = ["0" * 5000 + "1.1.1.1", "call ip 10.0.0.² now", "1.2.3.4.5.6.7.8.9", "10.0.0.٣", "١" * 30, "1." * 3000, "9" * 5000 + ".1.1.1"]
    model = trained()
    for text, extra in zip(odd, crf_spans(model, odd), strict=True):
        base = base_spans(text)
        every = pii.all_spans(base, extra, text)
        assert set(base) <= set(every)
    assert base_spans(odd[0]) == [(0, 5007, "ip")]


@pytest.mark.parametrize("text", ["7" * 1_000_000, "7." * 500_000, "+1 " * 300_000, "a@" * 500_000, "1@1" * 300_000, "a" * 1_000_000, "+1" + " " * 1_000_000, "1.2.3.4 " * 100_000, "at dot " * 100_000])
def test_long_texts_take_linear_time(text):
    start = time.perf_counter()
    base_spans(text)
    assert time.perf_counter() - start < 3
    start = time.perf_counter()
    pii.all_spans(base_spans(text), crf_spans(trained(), [text])[0], text)
    assert time.perf_counter() - start < 60


def test_long_chains_are_decoded_whole():
    text = "12 " * 5000 + "(212) 555-0123 " + "7 " * 5000
    (chain,) = free_chains(text)
    assert len(chain[1]) == 10_002
    model, words = trained(), chain[0]
    feats = [pii.features(words, i) for i in range(1, len(words) - 1)]
    got = model.viterbi(*pii.padded([feats]))[0].tolist()
    best, paths = {0: 0.0}, []  # a plain search, label by label
    for f in feats:
        e = model.emit[list(f)].sum(0)
        step = {k: max((v + model.move[a, k], a) for a, v in best.items()) for k in range(len(pii.LABELS))}
        paths.append({k: a for k, (_, a) in step.items()})
        best = {k: v + e[k] for k, (v, _) in step.items()}
    at = max(best, key=lambda k: best[k] + model.move[k, 0])
    want = []
    for p in reversed(paths):
        want.append(at)
        at = p[at]
    assert got == want[::-1]
    far = "x" * 5000 + " " * 5000
    assert pii.word_before(far + "1", 10_000) == "x" * 5000 and pii.word_after(far + "y z", 5000) == "y"


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a@b.cc", 5, 6)], "doc_id long, text string, __pii int, __provenant0 int")
    row = find_pii(docs).first()
    assert (row["__pii"], row["__provenant0"], row.base_spans) == (5, 6, "email:0:6")
