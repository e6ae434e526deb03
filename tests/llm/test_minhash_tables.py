import random

import numpy as np

from provenant.llm import components, minhash
from provenant.llm.minhash import candidate_groups, confirmed_components, distinct_sets, near_duplicates, signatures
from tests.llm.test_minhash import brute, edited, sample


def tables_of(monkeypatch):
    """What is written from now on: each table's columns."""
    found, one = [], minhash.written
    for module in (minhash, components):
        monkeypatch.setattr(module, "written", lambda spark, df: found.append(df.columns) or one(spark, df))
    return found


def test_a_level_writes_one_table(spark, monkeypatch):
    rng = random.Random(3)
    base = [str(rng.randrange(5000)) for _ in range(60)]
    rows = sample(6, 20, 8, 14) + [(1000 + i, edited(rng, base, rng.randrange(25))) for i in range(60)]  # far members meet again
    tables = tables_of(monkeypatch)
    out = near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == brute(rows)
    levels = sum("hub" in columns for columns in tables)
    assert 2 <= levels <= minhash.LEVELS + 1
    # Signatures, classes, candidate groups, sets, sizes of groups, links and their components: all small groups.
    assert len(tables) <= levels + 7


def test_repeated_rows_are_one_class(spark):
    rows = [(5, "a b c"), (5, "a b c"), (5, "d e f"), (9, "d e f"), (3, "a b c")]
    signed = signatures(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    classes = distinct_sets(signed, "digest", "n_shingles")
    assert sorted(r.node for r in classes.collect()) == [3, 5]
    assert {len(r.bands) for r in classes.collect()} == {minhash.BANDS}
    assert candidate_groups(spark, classes).count() == 0


def test_only_links_are_labelled(spark):
    rows = [(1, [1, 2, 3]), (2, [1, 2, 3, 4]), (3, [9]), (4, [1, 8, 9])]
    sets = [(node, 1, np.array(shingles, np.uint64).tobytes()) for node, shingles in rows]
    labels = confirmed_components(spark, spark.createDataFrame(sets, "node long, label long, shingles binary"), 75)
    assert sorted(map(tuple, labels.collect())) == [(1, 1), (2, 1)]
