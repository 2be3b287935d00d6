"""Odd rows that every operator must stand."""

import random

import pytest

SMALL = "/root/testdata/sf0.001"
# Names the operators use inside, as further columns of the input.
CLASHES = "size slot shard part seq row hash n node value key words copy copies root kept base added spans score target label".split()
DDL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def words(seed, count, vocabulary=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(count)]


def odd_texts():
    """Ids and texts with nulls, empties, repeats, near copies and one very long text."""
    rows = [(None, None), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One two"), (6, "éa ñ ÀB 漢字 🎉")]
    rows += [(7, "MIT License mit license"), (7, "MIT License mit license"), (8, "mail a.b@c.example.org +1 (743) 555-3824 and 1.2.3.4")]
    base = words(1, 120, 10**6)
    for i in range(12):
        changed = list(base)
        changed[10 * i % 120] = f"x{i}"
        rows.append((20 + i, " ".join(changed[: 120 - i % 3])))
    rows += [(40 + i, " ".join(words(100 + i, 5 + 7 * i))) for i in range(30)]
    rows += [(90, " ".join(base)), (91, " ".join(base)), (None, " ".join(base)), (92, "a " * 60_000 + "z"), (93, "x" * 300_000)]
    return rows


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """The odd documents as a table on disk, with clashing columns."""
    rows = [(i, t, "en", None if k % 7 == 0 else f"s{k % 5}", len(t or ""), *["other"] * len(CLASHES)) for k, (i, t) in enumerate(odd_texts())]
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, odd):
    return odd.limit(0)
