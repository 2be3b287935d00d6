"""Operators on documents against plain Python versions, on odd rows and empty tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_rows import SMALL, empty, odd  # noqa: F401

import corpus_pipeline
from waterline.llm import fingerprints, licenses, mixing, neardup, packing, pii, quality, queries, sharding
from waterline.llm.tables import n_words, read


def plain(df):
    return [tuple(r) for r in df.collect()]


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


TREE, GROWN = sharding.even_tree(range(8)), sharding.even_tree(range(9))


def test_sharding(odd, empty, spark):
    for docs in (odd, read(spark, SMALL, "documents")):
        got = sharding.shard_documents(docs, TREE, GROWN).collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
            (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts(docs)
        )
        slots, places = defaultdict(list), defaultdict(set)
        for r in got:
            assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
            slots[r.shard].append(r.slot)
            places[r.doc_id].add(r.shard)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert all(len(s) == 1 for s in places.values())
    assert sharding.shard_documents(empty, TREE, GROWN).count() == 0


@pytest.mark.parametrize("shards", [1, 5, 7, 8, 9, 10, 12])
def test_a_new_shard_takes_rows_only_into_itself(spark, shards):
    rows = spark.range(20_000)
    for name, n in (("a", shards), ("b", shards + 1)):
        rows = sharding.with_shard(rows, rows["id"], sharding.even_tree(range(n)), name)
    moves = {(r.a, r.b): r["count"] for r in rows.groupBy("a", "b").count().collect()}
    assert {b for a, b in moves if a != b} == {shards}
    # equal shards before and after
    for place, n in ((0, shards), (1, shards + 1)):
        sizes = Counter()
        for pair, count in moves.items():
            sizes[pair[place]] += count
        assert len(sizes) == n and all(abs(size - 20_000 / n) < 6 * (20_000 / n) ** 0.5 for size in sizes.values())


def test_sharding_weights_and_empty_nodes(spark):
    leaves = [sharding.Leaf(0, "r", "a", 2.0), sharding.Leaf(1, "r", "b", 1.0), sharding.Leaf(2, "s", "a", 1.0), sharding.Leaf(3, "t", "a", 0.0)]
    rows = spark.range(20_000)
    # a fixed weight of a node without shards that count draws nothing; that of s is twice its shard's
    rows = sharding.with_shard(rows, rows["id"], sharding.Tree(tuple(leaves), {"t": 9.0, "s": 2.0}), "a")
    sizes = {r.a: r["count"] for r in rows.groupBy("a").count().collect()}
    assert set(sizes) == {0, 1, 2}
    assert all(abs(sizes[k] / 20_000 - share) < 0.02 for k, share in {0: 0.4, 1: 0.2, 2: 0.4}.items())


def test_changes_stay_below_the_changed_node(spark):
    leaves = TREE.leaves
    heavy = tuple(sharding.Leaf(x.shard, x.region, x.rack, 3.0 if x.shard == 2 else 1.0) for x in leaves)
    held = {"region0": 4.0, "region1": 4.0, "region0/rack0": 2.0, "region0/rack1": 2.0, "region1/rack0": 2.0, "region1/rack1": 2.0}
    rows = spark.range(20_000)
    rows = sharding.with_shard(rows, rows["id"], sharding.Tree(leaves, held), "a")
    rows = sharding.with_shard(rows, rows["id"], sharding.Tree(heavy, held), "b")
    moves = {(r.a, r.b): r["count"] for r in rows.groupBy("a", "b").count().collect()}
    assert {k for k in moves if k[0] != k[1]} == {(3, 2)}
    shares = Counter()
    for (_, b), n in moves.items():
        shares[b] += n
    assert abs(shares[2] / (shares[2] + shares[3]) - 0.75) < 0.02 and abs(shares[0] / 20_000 - 0.125) < 0.02


@pytest.fixture(scope="module")
def whole_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_packing(odd, empty, spark, whole_tokenizer):
    for docs in (odd, read(spark, SMALL, "documents")):
        got = packing.pack_documents(docs, queries.tokenizer_path(), block_tokens=50_000).collect()
        want = Counter()
        for doc_id, text in texts(docs):
            ids = np.array([*whole_tokenizer.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
            want[(doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
            for r in got:
                if r.doc_id == doc_id and r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) != r.ids_crc32:
                    assert sum(t == doc_id for t, _ in texts(docs)) > 1
        pieces, room = Counter(), defaultdict(list)
        for r in got:
            pieces[r.doc_id] += r.length
            room[r.sequence_id].append((r.offset, r.length))
        assert pieces == sum((Counter({k[0]: k[1] * n}) for k, n in want.items()), Counter())
        for parts in room.values():
            ends = np.cumsum([0, *[n for _, n in sorted(parts)]])
            assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 2048
        used = sum(pieces.values())
        assert len(room) <= used / 2048 + 1 + used // 50_000 + docs.rdd.getNumPartitions()
    assert packing.pack_documents(empty, queries.tokenizer_path()).count() == 0


def test_packing_balances_cost():
    lengths = np.random.default_rng(1).lognormal(5.5, 1.0, 3000).astype(int) + 1
    pieces = packing.pack_lengths(lengths)
    covered = defaultdict(int)
    for doc, _, size, _, _ in pieces:
        covered[doc] += size
    assert [covered[i] for i in range(len(lengths))] == lengths.tolist()
    totals = Counter()
    for _, _, size, sequence, _ in pieces:
        totals[sequence] += size
    assert sum(2048 - n for n in totals.values()) < 2048 and max(totals.values()) == 2048


def test_mixing(odd, empty):
    got = mixing.with_copies(odd.select("doc_id", "source", n_words(odd["text"]).alias("words")), n_words_column()).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
    targets = plain_targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    biggest = max(r.size for r in got)
    assert all(abs(taken[s] - targets[s]) <= biggest for s in sizes)
    assert sorted(got, key=str) == sorted(mixing.with_copies(odd.select("doc_id", "source", n_words(odd["text"]).alias("words")).repartition(7), n_words_column()).collect(), key=str)
    rows = mixing.mix(odd, n_words(odd["text"]))
    assert rows.columns == odd.columns and rows.count() == sum(r.copies for r in got)
    assert mixing.mix(empty, n_words(empty["text"])).count() == 0


def n_words_column():
    from pyspark.sql import functions as F

    return F.col("words")


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = dict(zip(names, [(3, 1, 2)[i % 3] for i in range(len(names))], strict=True))
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        per = left / sum(weight[s] for s in free)
        full = [s for s in free if 2 * sizes[s] <= per * weight[s]]
        for s in full or free:
            out[s] = 2 * sizes[s] if full else per * weight[s]
        left -= sum(out[s] for s in full)
        free -= set(full or free)
    return out


def plain_components(docs, size, percent=80):
    sets, labels = [], []
    for doc_id, text in docs:
        w = text.encode().lower().split()
        k = min(size, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    for i, (doc_id, _) in enumerate(docs):
        labels.append((doc_id, len(sets[i]), least[find(i)] if sets[i] else doc_id))
    return Counter(labels)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(odd, spark, size):
    docs = odd if size == 4 else read(spark, SMALL, "documents")
    got = neardup.link_documents(docs, size, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(texts(docs), size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_with_a_family_around_no_member(spark):
    """Copies of a text that is not there: no member is linked with all others."""
    import random

    rows = []
    for i in range(60):
        draw = random.Random(i)
        rows.append((i, " ".join(f"p{j}" if draw.random() > 0.04 else f"q{draw.random()}" for j in range(100))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.repartition(4, "doc_id")
    got = neardup.link_documents(docs, 4, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 4)


def test_one_of_each_group_stays(odd, empty):
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    got = Counter(r.doc_id for r in kept.select("doc_id").collect())
    # both texts without id or words are one document, as are the repeated rows of 7
    assert got[7] == 1 and got[20] == 1 and not any(got[i] for i in (90, 91)) and got[40] == 1
    assert neardup.keep_one(empty).count() == 0


def test_components(spark):
    import random

    draw = random.Random(3)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)]
    edges = [e for e in edges if e[0] != e[1]]
    got = {r.node: r.root for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = list(range(600))
    for _ in range(600):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert all(got.get(x, x) == root[x] for x in range(600))


def test_fingerprints(odd, empty, spark):
    for docs, unique in ((odd, False), (read(spark, SMALL, "documents"), True)):
        got = fingerprints.compare_documents(docs).collect()
        assert len(got) == docs.count()
        assert all(0 <= v <= 1 for r in got for v in (r.near_edited, r.near_next))
        if unique:
            listed = sorted(texts(docs), reverse=True)
            by_id = {r.doc_id: r for r in got}
            equal = defaultdict(set)
            for i, (doc_id, text) in enumerate(listed):
                following = listed[(i + 1) % len(listed)][1]
                third = len(text) // 3
                edited = text[: len(text) - third] + following[:third]
                assert by_id[doc_id].n_chars == len(text)
                assert by_id[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
                equal[text].add(by_id[doc_id].fingerprint)
            assert all(len(f) == 1 for f in equal.values())
            assert np.mean([r.near_edited for r in got]) > 5 * np.mean([r.near_next for r in got])
    assert fingerprints.compare_documents(empty).count() == 0


def test_quality(odd, empty, spark):
    labels = read(spark, SMALL.replace("0.001", "0.01"), "labels")
    docs = read(spark, SMALL.replace("0.001", "0.01"), "documents")
    got = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got}
    assert all(got[i].held_out == held[i] and got[i].predicted == int(got[i].score >= 0.3) for i in got)
    truth = {r.doc_id: r.quality for r in labels.collect() if held[r.doc_id]}
    assert np.mean([got[i].predicted == q for i, q in truth.items()]) > 0.95
    odd_scores = quality.score_documents(odd, labels.limit(0)).collect()
    assert len(odd_scores) == odd.count() and all(r.score == 0.5 for r in odd_scores)
    assert quality.keep_good(odd, labels.limit(0)).columns == odd.columns
    assert quality.score_documents(empty, labels).count() == 0


def test_trees_walk_like_their_definition():
    draw = np.random.default_rng(0)
    rows = draw.normal(size=(500, 6))
    labels = (rows[:, 0] + rows[:, 1] ** 2 > 0.5).astype(float)
    forest = quality.fit(rows, labels)
    total = np.full(500, forest.start)
    for f, t, v in zip(forest.features, forest.thresholds, forest.values, strict=True):
        for i, row in enumerate(rows):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total[i] += v[node - len(f)]
    assert np.allclose(forest.score(rows), 1 / (1 + np.exp(-total)))
    assert np.mean((forest.score(rows) > 0.5) == labels) > 0.97


def test_pii_expressions():
    import re

    cases = [
        "x@y.z a.b@c.d@e.f @a.b c@d.e.", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4 1.2.3", "4012888888881881 4012-8888 8888-1881 1234567890123456",
        "+1 (743) 555-3824 +12 +1 555 +49 30 1234567890123", "a" * 5000 + "@" + "b" * 50, "9" * 3000, "é+1 234 567 89é u@v.w",
    ]
    exact = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ]

    def valid(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == 1:
            return all(int(p) <= 255 for p in match.split("."))
        if kind == 2:
            odd_sum = sum(sum(map(int, str(int(d) * (1 + i % 2)))) for i, d in enumerate(digits[::-1]))
            return 16 <= len(digits) <= 19 and odd_sum % 10 == 0
        return kind == 0 or 8 <= len(digits) <= 15

    for text in cases:
        want = [(k, m.start(), m.end()) for k, e in enumerate(exact) for m in re.finditer(e, text) if valid(k, m[0])]
        assert pii.base_spans(text) == want


def test_pii(odd, empty, spark):
    got = {r.doc_id: r for r in pii.find_documents(odd).collect()}
    assert got[8].n_email == got[8].n_ip == got[8].n_phone == 1 and got[8].spans == "email:5:22,ip:45:52,phone:23:40"
    assert got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    masked = {r.doc_id: r for r in pii.mask_documents(odd).collect()}
    assert masked[8].text == "mail [EMAIL] [PHONE] and [IP]" and masked[8].n_chars == 29
    assert masked[1].text is None and pii.mask_documents(odd).columns == odd.columns
    assert pii.find_documents(empty).count() == 0 and pii.mask_documents(empty).count() == 0


def test_cues_find_what_the_expressions_miss(spark):
    rows = [(i, f"some words Phone: +1 (743) 555-38{i:02d} and more") for i in range(20)]
    rows += [(50, "here Phone: 743.555.1234 again"), (51, "note: this Phone: is out")] + [(60 + i, f"mark: item{i} rest") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_documents(docs).collect()}
    assert got[50].spans == "phone:12:24" and got[50].n_phone == 0
    assert got[51].spans == "" and got[60].spans == "" and got[3].n_phone == 1


def test_licenses(odd, empty, spark):
    import re

    for docs in (odd, read(spark, SMALL, "documents")):
        got = licenses.scan_documents(docs).collect()
        want = Counter()
        for doc_id, text in texts(docs):
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
            places = sorted((i, label) for phrase, label in licenses.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())
            ends = (places[0][0], places[-1][0]) if places else (None, None)
            want[(doc_id, len(w), len(places), *ends, ",".join(sorted({x for _, x in places})))] += 1
        assert Counter(tuple(r)[:6] for r in got) == want
        assert all(set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} and 0 <= r.score <= 1 for r in got)
    assert licenses.scan_documents(empty).count() == 0


def test_license_rules(spark):
    assert len(licenses.rules()) > 300
    cases = {
        "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
        "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
        "under the GNU Lesser General Public License v2.1": "gpl,lgpl-2.1",
        "Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa-4.0",
        "a gplv2 module": "gpl-2.0",
        "no such thing": "",
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan_documents(docs).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_pipeline_stages(odd, spark, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "personal_data", "mix", "pack"]
    docs = read(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "pack":
            assert out.columns == docs.columns
            path = str(tmp_path / name)
            out.write.parquet(path)
            docs = spark.read.parquet(path)
    assert out.count() > 0


def found_spans(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.spans for r in pii.find_documents(docs).collect()}


def test_contexts_of_plain_words_find_what_the_expressions_miss(spark):
    rows = [(i, f"{w} then call me on +1 (743) 555-38{i:02d}, {w}") for i, w in enumerate("abcdefghijklmnopqrst")]
    rows += [(30 + i, f"the +1 (743) 555-39{i:02d} the") for i in range(9)]
    rows += [(50, "we call me on 743.555.1234, ok"), (51, "in the 2024 the end"), (52, "the " + " the ".join(f"word{'x' * i}" for i in range(40)))]
    got = found_spans(spark, rows)
    assert got[50] == "phone:14:26" and got[51] == "" and got[52] == ""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.mask_documents(docs).collect()}[50] == "we call me on [PHONE], ok"


def test_words_beside_a_context_count_against_it():
    pool = {"<on": {"<on", "<me on"}, ">or": {">or"}}
    assert pii.slot_words("Call me on monday or on 743.555.1234 or x@y or bob", pool) == {("<on", "monday"), ("<me on", "monday"), (">or", "monday")}


def test_discovered_identifiers_make_further_cues(spark):
    rows = [(i, f"{w} Phone: +1 (743) 555-38{i:02d} {w}") for i, w in enumerate("abcdefghijklmnopqrstuvwxyzäöüß")]
    rows += [(100 + i, f"{w} Phone: 743.555.12{i:02d} {w}") for i, w in enumerate("abcdef")]
    rows += [(200 + i, f"{w}{w} Mobile: 743.555.12{i:02d} {w}{w}") for i, w in enumerate("abcdef")]
    # a colon alone announces nothing
    rows += [(1000 + i, f"{w} note: plain{w} {w}") for i, w in enumerate("abcdefghijklmnopqrstuvwxyzäöüß")]
    got = found_spans(spark, [*rows, (300, "xy Mobile: 743.555.1299 xy")])
    assert got[100] == "phone:9:21" and got[300] == "phone:11:23"
    # four different numbers are not enough
    few = [r for r in rows if r[0] < 104 or 200 <= r[0] < 204 or r[0] >= 1000]
    assert found_spans(spark, [*few, (300, "xy Mobile: 743.555.1299 xy")])[300] == ""


def test_cues_announce_whole_values(spark):
    rows = [(i, f"{w} Tel: +1 (743) 555-38{i:02d} {w}") for i, w in enumerate("abcdefghijklmnopqrstuvwxyzäöüß")]
    rows += [(200 + i, f"{w} Mail: {w}{w}@x.org {w}") for i, w in enumerate("abcdefghijklmnopqrst")]
    values = {50: "0171 555 0100", 51: "(030) 1234 567", 52: "0171-555 0100", 53: "0" * 100, 54: "(0171) 555.01 00"}
    rows += [(i, f"q{i} Tel: {v}, so") for i, v in values.items()]
    rows += [(60, "see (Tel: 0171 555 0111) 5 times"), (61, "q Tel: 0171 555 0122 2nd floor"), (70, f"q Mail: {'y' * 100}@host 5")]
    got = found_spans(spark, rows)
    assert all(got[i] == f"phone:9:{9 + len(v)}" for i, v in values.items())
    assert got[60] == "phone:10:23" and got[61] == "phone:7:20" and got[70] == "email:8:113"


def test_large_lexicons_stay_sharp(spark):
    from pyspark.sql import functions as F

    terms = spark.range(120_000).select("id", F.xxhash64("id").alias("term"))
    bits = fingerprints.lexicon_bits(terms.filter("id < 60000"))
    rows = terms.select((F.col("id") < 60_000).alias("held"), fingerprints._in_lexicon(F.col("term"), F.lit(bits), 4 * len(bits)).alias("found"))
    found = {r.held: r.share for r in rows.groupBy("held").agg(F.avg(F.col("found").cast("int")).alias("share")).collect()}
    assert found[True] == 1 and found[False] < 0.0045


def test_pipeline_rows_against_a_plain_chain(spark, whole_tokenizer):
    docs = read(spark, SMALL, "documents")
    scores = {r.doc_id: r.score for r in quality.score_documents(docs, read(spark, SMALL, "labels")).collect()}
    sources = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    chosen = [(i, t) for i, t in texts(docs) if scores[i] >= 0.3]
    kept = {i for i, _, component in plain_components(chosen, 5) if i == component}
    hidden = {i: pii.masked(t, pii.base_spans(t)) for i, t in chosen if i in kept}
    assert 0 < len(kept) < len(chosen) < len(scores) and any("[CARD]" in t or "[IP]" in t for t in hidden.values())
    sizes, words = defaultdict(int), {i: len(t.encode().split()) for i, t in hidden.items()}
    for i, n in words.items():
        sizes[sources[i]] += n
    table = spark.createDataFrame([(i, sources[i], n) for i, n in words.items()], "doc_id long, source string, words long")
    copies = {r.doc_id: r.copies for r in mixing.with_copies(table, n_words_column()).collect()}
    taken = Counter()
    for i, n in copies.items():
        taken[sources[i]] += n * words[i]
    targets = plain_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= max(words.values()) for s in sizes)

    ids = {i: np.array([*whole_tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4") for i, t in hidden.items()}
    covered = {i: np.zeros(len(x), dtype=int) for i, x in ids.items()}
    for r in corpus_pipeline.run(spark, SMALL).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(part.tobytes()) == r.ids_crc32
        covered[r.doc_id][r.start : r.start + r.length] += 1
    assert all((covered[i] == copies[i]).all() for i in ids)


def test_contexts_are_held_against_all_rows(spark, monkeypatch):
    """Words beside a context refute it wherever they stand, with contexts in one part or in several."""
    said = [f"we call me on 743.555.{1000 + i} now" for i in range(3)] + [f"we call me on +1 743 555 {3000 + i} now" for i in range(20)]
    others = "monday tuesday friday sunday easter time top cue air line board stage".split()
    for at_once in (50_000, 2):
        monkeypatch.setattr(pii, "AT_ONCE", at_once)
        assert "phone" in found_spans(spark, list(enumerate(said)))[0]
        against = [f"{w} we call me on {w} now {w}" for w in others]
        assert "phone" not in found_spans(spark, list(enumerate(said + against)))[0]


def test_contexts_reach_as_far_as_their_words():
    far = "announced" + " " * 5000 + "x" * 70_000
    assert pii._contexts(far + " 1.2.3.4", len(far) + 1, len(far) + 8)[:2] == ["<" + "x" * 70_000, "<announced " + "x" * 70_000]
    assert pii._contexts("5 % 1.2.3.4 %", 4, 11) == ["<0 %"]
    assert pii.cue_rows("y" * 100 + "     :     1.2.3.4", [(1, 111, 118)])[0][0] == "y" * 100 + ":"
