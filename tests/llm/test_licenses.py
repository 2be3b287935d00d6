"""License rules against a plain version that compares every detection with every other."""

import random
import re
import time

import pytest
from odd_rows import SMALL, odd  # noqa: F401

from waterline.llm import licenses
from waterline.llm.tables import read


def plain(text):
    words = re.findall(licenses.WORD, "".join(c.lower() if c.isascii() else c for c in text or ""))
    body = " " + " ".join(words) + " "
    spans = [(m.start(), m.end(), p, label) for label, p, e in licenses.rules() for m in re.finditer(f" {e}(?= )", body, re.ASCII)]
    own = set()
    for x in spans:
        held = [y for y in spans if y[0] <= x[0] and y[1] >= x[1]]
        if not any(y[2] > x[2] or (y[2] == x[2] and y[1] - y[0] > x[1] - x[0]) for y in held):
            own.add((x[3], x[2]))
    base = sorted({label for phrase, label in licenses.BASE if f" {phrase} " in body})
    doubt = 1.0
    for _, p in own:
        doubt *= 1 - licenses.CONFIDENCE[p]
    doubt = min(doubt, 1 - licenses.CONFIDENCE[licenses.NAME]) if base else doubt
    return ",".join(base), ",".join(sorted(set(base) | {label for label, _ in own})), pytest.approx(1 - doubt)


def mixtures():
    """Texts of pieces of names, notices and texts, in any order."""
    draw = random.Random(8)
    pieces = [e for _, _, e in licenses.rules() if not re.search(r"[\[({?.]", e)]
    pieces += ["released under the terms of the", "license", "GNU Lesser General Public License v2.1", "SPDX-License-Identifier: MIT", "Permit submission", "unter der MIT-Lizenz"]
    return [(i, " ".join(draw.choice(pieces) for _ in range(draw.randrange(1, 7)))) for i in range(300)]


def test_labels(spark, odd):
    for docs in (odd, read(spark, SMALL, "documents"), spark.createDataFrame(mixtures(), "doc_id long, text string")):
        want = sorted(((r.doc_id, *plain(r.text)) for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        got = sorted(((r.doc_id, r.base_labels, r.labels, r.score) for r in licenses.scan_documents(docs).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        assert got == want


def test_every_rule_has_a_gate_and_an_anchor():
    for _, _, expression in licenses.rules():
        assert re.search(rf"(?<![a-z0-9]){licenses._gate(expression)}(?![a-z0-9])", expression)
        assert re.fullmatch("[a-z0-9 ]{2,}", licenses._anchor(expression))


def test_many_notices_in_one_text(spark):
    """A text of 38,000 words, all notices: cost follows its length."""
    notice = "this file is licensed under the mit license and the apache license version 2 0 see the text here "

    def seconds(times):
        docs = spark.createDataFrame([(1, notice * times)], "doc_id long, text string")
        started = time.perf_counter()
        row = licenses.scan_documents(docs).collect()[0]
        assert (row.n_base, row.labels) == (2 * times, "apache,apache-2.0,mit")
        return time.perf_counter() - started

    seconds(10)
    few = min(seconds(10), seconds(10))
    assert seconds(2000) < few + 3
