import random
from collections import Counter

from provenant.llm import license_scan as scans
from provenant.llm.license_scan import WORD, compiled, license_scan, op3_license_scan
from provenant.llm.license_templates import MIT, TEMPLATES


def best_dice(template, text):
    """Largest coefficient over all stretches, by trying them all."""
    grams = lambda t: list(zip((w := WORD.findall(t.lower())), w[1:]))
    want, have, best = Counter(grams(template)), grams(text), 0.0
    n = sum(want.values())
    for i in range(len(have)):
        left, shared = dict(want), 0
        for j in range(i, len(have)):
            if left.get(have[j]):
                left[have[j]] -= 1
                shared += 1
            best = max(best, 2 * shared / (n + j - i + 1))
    return best


def test_best_stretch_equals_brute_force():
    rng = random.Random(6)
    for _ in range(150):
        words = [rng.choice("abcde") for _ in range(rng.randrange(4, 14))]
        text = [rng.choice("abcde") for _ in range(10)] + [w if rng.random() < 0.9 else "x" for w in words] + [rng.choice("abcde") for _ in range(10)]
        template, text = " ".join(words), " ".join(text)
        got = compiled((("T", template),), 0.8).scan(text)
        want = best_dice(template, text)
        assert (max((d for _, d, _, _ in got), default=0) == want) if want >= 0.8 else not got, (template, text)


def test_whole_texts_and_notices(spark):
    changed = MIT.replace("sublicense", "license").replace("furnished", "given").replace('"AS IS"', "as is")
    rows = [
        (1, f"Some prose here.\n{changed}\nMore prose."), (2, "Licensed under CC BY-NC 4.0.\nfoo"), (3, None), (4, ""), (5, "The license of a pub."),
        (6, "Text.\nLicensed under the Apache License, Version 2.0.\nText. Released under the MIT License.\n"), (6, "Released under the MIT License."), (None, "released under the mit license"),
        (7, "word " * 200_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "text")
    got = sorted((str(r.doc_id), r.license) for r in license_scan(docs).collect())
    assert got == sorted([("1", "MIT"), ("2", "CC-BY-NC-4.0"), ("6", "Apache-2.0"), ("6", "MIT"), ("6", "MIT"), ("None", "MIT")])
    assert license_scan(docs.limit(0)).count() == 0


def test_every_template_finds_itself():
    scan = compiled(tuple(TEMPLATES), 0.85).scan
    for name, text in TEMPLATES:
        assert [(n, d) for n, d, _, _ in scan(f"Before it. {text} After it.")] == [(name, 1.0)]


def test_sibling_versions_are_told_apart():
    scan = compiled(tuple(TEMPLATES), 0.85).scan
    head = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License for more details. You should have received a copy of the GNU {1}General Public License along with this {0}; if not, see <http://www.gnu.org/licenses/>."
    for name, *parts in [("GPL-2.0", "program", "", "2"), ("GPL-3.0", "program", "", "3"), ("AGPL-3.0", "program", "Affero ", "3"), ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-3.0", "library", "Lesser ", "3"), ("LGPL-2.0", "library", "Library ", "2")]:
        assert [n for n, *_ in scan(f"Foo. {head.format(*parts)} Bar.")] == [name]
        assert [n for n, *_ in scan(f"Foo. This {parts[0]} is licensed under the GNU {parts[1]}General Public License, version {parts[2]}. Bar.")] == [name]
    rng = random.Random(3)
    for name, text in TEMPLATES[-14:]:  # full texts with some words changed
        words = [w if rng.random() < 0.98 else "x" for w in text.split()]
        (found, d, a, b), = scan("Foo. " + " ".join(words) + " Bar.")
        assert found == name and d > 0.9 and b - a > 0.9 * len(words)


def test_long_runs_equal_short_ones(monkeypatch):
    rng = random.Random(9)
    for _ in range(150):
        words = [rng.choice("abcdef") for _ in range(rng.randrange(4, 40))]
        text = " ".join(rng.choice("abcdefgh") if rng.random() < 0.2 else w for w in (words + words[:5]) * 3)
        scan = compiled(((str(rng.random()), " ".join(words)),), 0.7).scan
        got = []
        for wide in (0, 10**6):
            monkeypatch.setattr(scans, "WIDE", wide)
            got.append(scan(text))
        assert got[0] == got[1]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    marks = ("Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.", "GNU General Public License, version 3.")
    assert {r.doc_id for r in op3_license_scan(spark, "/root/testdata/sf0.01").collect()} == {i for i, t in texts.items() if any(m in t for m in marks)}


def test_query_equals_brute_force(spark):
    """Each row's coefficient is that of its stretch, and no text of the table holds a better one of a one-line template."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    grams = lambda words: Counter(zip(words, words[1:], strict=False))
    by_name = {}
    for name, text in TEMPLATES:
        by_name.setdefault(name, []).append(grams(WORD.findall(text.lower())))
    dice = lambda a, b: 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))
    rows = op3_license_scan(spark, "/root/testdata/sf0.001").collect()
    assert rows
    for r in rows:
        found = grams(WORD.findall(texts[r.doc_id].lower())[r.start_word : r.end_word])
        assert abs(max(dice(t, found) for t in by_name[r.license]) - r.dice) < 1e-9 and r.dice >= scans.LEAST
    hit = {r.doc_id for r in rows}
    for i, text in texts.items():
        words = WORD.findall(text.lower())
        for template in (t for ts in by_name.values() for t in ts if 3 <= sum(t.values()) <= 12):
            n = sum(template.values())
            if i not in hit and set(template) & set(zip(words, words[1:], strict=False)):
                assert all(dice(template, grams(words[a : a + n + 1])) < scans.LEAST for a in range(len(words)))
