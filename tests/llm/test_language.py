"""The language model: counts against a plain version, probabilities that sum to one, exact seatings."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import SMALL, empty, odd  # noqa: F401
from pyspark.sql import functions as F

from waterline.llm import language
from waterline.llm.tables import read


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def plain(docs):
    rows = [(r.doc_id, tokens(r.text)) for r in docs.select("doc_id", "text").collect()]
    counts = Counter(t for i, ts in rows if not held_out(i) for t in ts)
    total, words = sum(counts.values()), len(counts)
    out = []
    for i, ts in rows:
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (words + 1))) for t in ts)
        out.append((i, held_out(i), len(ts), sum(counts[t] > 0 for t in ts), total, round(base, 5)))
    return Counter(out)


@pytest.fixture(scope="module")
def scored(spark):
    docs = read(spark, SMALL, "documents")
    return docs, language.score_documents(docs).collect()


def test_counts_and_base(scored, odd, empty):
    docs, got = scored
    for docs, got in ((docs, got), (odd, language.score_documents(odd).collect())):
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == plain(docs)
        assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    assert language.score_documents(empty).count() == 0


def test_held_out_texts_are_likelier_than_by_single_words(scored):
    held = [r for r in scored[1] if r.held_out]
    assert len(held) > 10 and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_chunks_and_reruns_change_nothing(scored, monkeypatch):
    docs, got = scored
    monkeypatch.setattr(language, "CHUNK_TOKENS", 3000)
    again = language.score_documents(docs.repartition(5)).collect()
    assert {r.doc_id: round(r.score, 6) for r in again} == {r.doc_id: round(r.score, 6) for r in got}


def test_without_training_texts(spark):
    ids = [i for i in range(200) if held_out(i)][:3]
    got = language.score_documents(spark.createDataFrame([(i, "a b\na") for i in ids], "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.n_tokens == 4 and r.base_score == 0 and abs(r.score) < 1e-9 for r in got)


def test_probabilities_sum_to_one(spark):
    """Known words and the outcome of all others share each context's probability."""
    names = [b"", b"a", b"ab", b"abc", b"b", b"ba", b"xyz"]
    contexts = [97, 98, 256]
    draw = np.random.default_rng(5)
    counts = draw.integers(0, 90, size=(len(names), len(contexts)))
    counts[0] += 1
    counts[-1] = 0
    rows = [(n, [(c, int(k)) for c, k in zip(contexts, ks, strict=True)]) for n, ks in zip(names, counts, strict=True)]
    words = spark.createDataFrame(rows, "word binary, contexts array<struct<context int, train long>>").withColumn("key", F.xxhash64("word"))
    model, samples = language.learn(words)
    got = [(c, s) for r in words.mapInArrow(language._scores(model, samples), language.SCORES).collect() for c, s in zip(r.word_contexts, r.word_scores, strict=True)]
    # the last word is in no training text: it stands for all such
    for context in contexts:
        assert sum(10**score for c, score in got if c == context) == pytest.approx(1.0, abs=1e-9)


def test_spelling_sums_to_one():
    codes = (np.array([256 * 257 + 256, 256 * 257 + 97, 97 * 257 + 98]) * 257)[:, None] + np.arange(5)
    model = language.Spelling(codes.ravel(), np.arange(1, 16) ** 3)
    every = np.arange(257)
    for context in (256 * 257 + 256, 97 * 257 + 98, 3 * 257 + 4, 5 * 257 + 97):
        assert np.exp(model.log(context * 257 + every)).sum() == pytest.approx(1.0)
    none = language.Spelling(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    assert np.exp(none.log(every)).tolist() == pytest.approx([1 / 257] * 257)


def partitions(customers):
    if not customers:
        yield []
        return
    for rest in partitions(customers - 1):
        for i in range(len(rest)):
            yield [*rest[:i], rest[i] + 1, *rest[i + 1 :]]
        yield [*rest, 1]


@pytest.mark.parametrize("customers", [2, 4, 6])
def test_tables_are_drawn_from_their_distribution(customers):
    """Against all seatings of the customers, each by the product of its steps."""
    discount, strength, others, chance = 0.6, 1.0, 3, 0.4
    weight = np.zeros(customers + 1)
    for seats in partitions(customers):
        opened = math.prod((strength + discount * (others + i)) * chance for i in range(len(seats)))
        weight[len(seats)] += opened * math.prod(n - discount for size in seats for n in range(1, size))
    draws = 40_000
    keys = np.random.default_rng(1).integers(0, 2**63, draws).astype(np.uint64)
    got = language.draw_tables(np.full(draws, customers), np.full(draws, math.log(chance)), np.full(draws, others), discount, strength, language.log_stirling(discount), keys, 5)
    assert np.abs(np.bincount(got, minlength=customers + 1) / draws - weight / weight.sum()).max() < 0.01


@pytest.mark.parametrize(("customers", "chance", "others"), [(65, 0.02, 50), (100, 0.5, 50), (1000, 0.3, 1000), (65, 0.9, 20), (4000, 0.2, 50), (4000, 0.002, 5000)])
def test_tables_of_many_customers(customers, chance, others):
    """The limit against the mean of the exact distribution, by the recursion over customers."""
    discount, strength, most = 0.7, 1.0, 900
    ways, t = np.full(most + 2, -np.inf), np.arange(most + 2)
    ways[0] = 0.0
    for n in range(customers):
        stay = np.where(n - discount * t > 0, np.log(np.maximum(n - discount * t, 1e-300)), -np.inf)
        ways = np.logaddexp(ways + stay, np.concatenate([[-np.inf], ways[:-1]]))
    weight = ways + np.concatenate([[0], np.cumsum(np.log(strength + discount * (others + t[:-1])) + math.log(chance))])
    weight = np.exp(weight - weight[1:].max())
    weight[0] = 0.0
    mean = (weight * t).sum() / weight.sum()
    keys = np.random.default_rng(2).integers(0, 2**63, 4000).astype(np.uint64)
    full = [np.full(4000, x) for x in (customers, math.log(chance), others)]
    got = language.draw_tables(*full, discount, strength, language.log_stirling(discount), keys, 5)
    assert got.min() >= 1 and got.max() <= customers
    assert got.mean() == pytest.approx(mean, rel=0.06)


def test_packed_places():
    for places in ([5], [0, 0, 3, 70_000, 2**31], [7] * 1000):
        assert language.unpack(language.pack(np.array(places, dtype=np.int64))).tolist() == sorted(places)


def test_spelled_words_do_not_see_each_other():
    names = [b"", b"a", b"abc", b""]
    codes, starts = language.spelled(np.frombuffer(b"".join(names), dtype=np.uint8), np.array([0, 0, 1, 4, 4]))
    want = [tuple(itertools.chain([256, 256], n, [256])) for n in names]
    assert starts.tolist() == [0, 1, 3, 7]
    assert codes.tolist() == [(w[i] * 257 + w[i + 1]) * 257 + w[i + 2] for w in want for i in range(len(w) - 2)]


def test_contexts_are_whole_words(spark):
    """Two words with the same last byte foretell different words."""
    held, train = ([i for i in range(900) if held_out(i) == kind] for kind in (True, False))
    rows = [(i, "xa p" if n % 2 else "ya q") for n, i in enumerate(train)]
    asked = dict(zip(("xa p", "xa q", "ya q", "ya p"), held, strict=False))
    docs = spark.createDataFrame(rows + [(i, t) for t, i in asked.items()], "doc_id long, text string")
    got = {r.doc_id: r.score for r in language.score_documents(docs).collect()}
    for likely, other in (("xa p", "xa q"), ("ya q", "ya p")):
        assert got[asked[likely]] > got[asked[other]] + 1.5
        assert got[asked[likely]] == pytest.approx(math.log10(0.5), abs=0.1)


def test_tables_given_the_gamma_variable():
    """The exact distribution of the tables of one and of many customers, each table weighing the same."""
    discount, weighs = 0.6, 1.7
    stirling = language.log_stirling(discount)
    for customers in (3, 30, 200):
        weight = np.exp(stirling[customers, 1 : customers + 1] + np.arange(1, customers + 1) * math.log(weighs) - stirling[customers].max())
        keys = np.random.default_rng(3).integers(0, 2**63, 40_000).astype(np.uint64)
        got = language.draw_apart(np.full(40_000, customers), np.full(40_000, math.log(weighs)), discount, stirling, keys, 9)
        share = np.bincount(got, minlength=customers + 1)[1:] / 40_000
        assert np.abs(share - weight / weight.sum()).max() < 0.01


def test_gamma_draws():
    for shape in (0.3, 1.0, 40.0):
        got = np.exp(language.log_gamma(np.full(100_000, shape), np.arange(100_000).astype(np.uint64), 3))
        assert got.mean() == pytest.approx(shape, rel=0.03) and got.var() == pytest.approx(shape, rel=0.05)


def test_parameters_are_drawn_around_those_that_made_the_seatings():
    discount, strength, draw = 0.6, 5.0, np.random.default_rng(4)
    tables, cells = [], np.zeros((language.EXACT + 1, language.EXACT + 1), dtype=np.int64)
    for _ in range(150):
        sizes = []
        for n in range(200):
            chances = np.array([*[s - discount for s in sizes], strength + discount * len(sizes)]) / (strength + n)
            at = draw.choice(len(chances), p=chances)
            sizes[at:] = [sizes[at] + 1, *sizes[at + 1 :]] if at < len(sizes) else [1]
        tables.append(len(sizes))
        for size in sizes:
            cells[size, 1] += size > 1
    held, got = np.unique(tables, return_counts=True), [(1.0, 0.5)]
    for _ in range(200):
        log_x = np.log(draw.beta(got[-1][0] + 1, 199, size=150)).sum()
        got.append(language.draw_parameters(*got[-1], *held, log_x, cells, language.log_stirling(got[-1][1]), draw))
    mean = np.mean(got[50:], axis=0)
    assert mean[0] == pytest.approx(strength, rel=0.25) and mean[1] == pytest.approx(discount, abs=0.04)
