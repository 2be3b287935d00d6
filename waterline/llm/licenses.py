"""License scan: ordered signature rules over a text's words.

A rule is a regular expression over the words, joined by single spaces, that names a license. A rule
is tried only where the text holds its anchor, the longest literal part of the expression. Where detections overlap, one
that lies inside another of higher priority (or of equal priority and longer) is suppressed, so the
full name of a license silences the shorter names within it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.llm.tables import LOWER, UPPER
from waterline.sources.staging import materialise

# Runs of ASCII letters and digits and of anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The phrases every scan looks for, with their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Licenses by SPDX identifier, the names they go by, phrases
# of their own texts, and addresses; all as words, `|` parting alternatives.
LICENSES = (
    ("mit", "mit license|mit licence|mit licensed|the mit license mit|expat license", "permission is hereby granted free of charge to any person obtaining a copy of this software", "opensource org licenses? mit"),
    ("apache-2.0", "apache license version 2(?: 0)?|apache 2(?: 0)? license|apache software license version 2(?: 0)?|asl 2 0", "you may not use this file except in compliance with the license", "apache org licenses license 2 0"),
    ("apache-1.1", "apache software license version 1 1|apache license version 1 1|apache license 1 1", "this product includes software developed by the apache software foundation", "apache org licenses license 1 1"),
    ("gpl-1.0", "gnu general public license v(?:ersion )?1|gnu gpl v(?:ersion )?1|gplv1", "version 1 of the gnu general public license", "gnu org licenses gpl 1 0"),
    ("gpl-2.0", "gnu general public license v(?:ersion )?2|gnu gpl v(?:ersion )?2|gplv2", "either version 2 of the license or at your option any later version", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", "gnu general public license v(?:ersion )?3|gnu gpl v(?:ersion )?3|gplv3", "either version 3 of the license or at your option any later version", "gnu org licenses gpl 3 0"),
    ("lgpl-2.0", "gnu library general public license v(?:ersion )?2|gnu lgpl v(?:ersion )?2|lgplv2", "version 2 of the gnu library general public license", "gnu org licenses (?:old licenses )?lgpl 2 0"),
    ("lgpl-2.1", "gnu lesser general public license v(?:ersion )?2 1|gnu lgpl v(?:ersion )?2 1|lgplv2 1", "either version 2 1 of the license or at your option any later version", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu lesser general public license v(?:ersion )?3|gnu lgpl v(?:ersion )?3|lgplv3", "version 3 of the gnu lesser general public license", "gnu org licenses lgpl 3 0"),
    ("agpl-3.0", "gnu affero general public license v(?:ersion )?3|gnu agpl v(?:ersion )?3|agplv3", "version 3 of the gnu affero general public license", "gnu org licenses agpl 3 0"),
    ("bsd-2-clause", "bsd 2 clause(?: simplified)? license|simplified bsd license|two clause bsd license|freebsd license", "redistributions in binary form must reproduce the above copyright notice this list of conditions", "opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "bsd 3 clause(?: new or revised)? license|new bsd license|modified bsd license|three clause bsd license", "neither the name of the copyright holder nor the names of its contributors may be used", "opensource org licenses? bsd 3 clause"),
    ("bsd-4-clause", "bsd 4 clause license|original bsd license|four clause bsd license|bsd style license", "all advertising materials mentioning features or use of this software must display", "spdx org licenses bsd 4 clause"),
    ("0bsd", "bsd zero clause license|zero clause bsd|0bsd license", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software", "opensource org licenses? 0bsd"),
    ("isc", "isc license|internet systems consortium license|isc licence", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided", "opensource org licenses? isc"),
    ("mpl-1.1", "mozilla public license v(?:ersion )?1 1|mozilla public license 1 1|mpl 1 1", "the contents of this file are subject to the mozilla public license version 1 1", "mozilla org mpl 1 1"),
    ("mpl-2.0", "mozilla public license v(?:ersion )?2(?: 0)?|mozilla public license 2 0|mpl 2 0", "this source code form is subject to the terms of the mozilla public license", "mozilla org mpl 2 0"),
    ("epl-1.0", "eclipse public license v(?:ersion )?1(?: 0)?|eclipse public license 1 0|epl 1 0", "made available under the terms of the eclipse public license v1", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse public license v(?:ersion )?2(?: 0)?|eclipse public license 2 0|epl 2 0", "made available under the terms of the eclipse public license 2 0", "eclipse org legal epl 2 0"),
    ("cddl-1.0", "common development and distribution license(?: version 1(?: 0)?)?|cddl 1 0|cddl license", "the terms of the common development and distribution license", "opensource org licenses? cddl"),
    ("cpl-1.0", "common public license(?: version)?(?: 1 0)?|cpl 1 0|cpl license", "the terms of the common public license", "opensource org licenses? cpl1 0"),
    ("eupl-1.2", "european union public licen[cs]e v(?:ersion )?1 2|eupl 1 2|eupl license", "licensed under the eupl", "joinup ec europa eu .{0,40}eupl"),
    ("artistic-1.0", "artistic license(?: version)? 1 0|perl artistic license|original artistic license", "the intent of this document is to state the conditions under which a package may be copied such that", "opensource org licenses? artistic license 1 0"),
    ("artistic-2.0", "artistic license(?: version)? 2 0|the artistic license 2|artistic 2 0", "this license establishes the terms under which a given free software package may be copied modified", "opensource org licenses? artistic license 2 0"),
    ("zlib", "zlib license|zlib libpng license|zlib licence", "this software is provided as is without any express or implied warranty in no event", "opensource org licenses? zlib"),
    ("bsl-1.0", "boost software license(?: version)?(?: 1 0)?|boost license|bsl 1 0", "distributed under the boost software license", "boost org license 1 0"),
    ("busl-1.1", "business source license(?: version)?(?: 1 1)?|busl 1 1|bsl 1 1", "use of this software is governed by the business source license", "mariadb com bsl11"),
    ("unlicense", "the unlicense|unlicense license|unlicense", "this is free and unencumbered software released into the public domain", "unlicense org"),
    ("wtfpl", "do what the .{1,8} you want to public license|wtfpl license|wtfpl", "you just do what the .{1,8} you want to", "wtfpl net"),
    ("cc0-1.0", "cc0 1 0(?: universal)?|creative commons zero|cc0 public domain dedication", "to the extent possible under law .{0,60}waived all copyright", "creativecommons org publicdomain zero 1 0"),
    ("cc-by-3.0", "creative commons attribution 3 0|cc by 3 0|creative commons by 3 0", "creative commons attribution 3 0 .{0,20}license", "creativecommons org licenses by 3 0"),
    ("cc-by-4.0", "creative commons attribution 4 0|cc by 4 0|creative commons by 4 0", "creative commons attribution 4 0 international license", "creativecommons org licenses by 4 0"),
    ("cc-by-sa-3.0", "creative commons attribution share ?alike 3 0|cc by sa 3 0|creative commons by sa 3 0", "creative commons attribution sharealike 3 0 .{0,20}license", "creativecommons org licenses by sa 3 0"),
    ("cc-by-sa-4.0", "creative commons attribution share ?alike 4 0|cc by sa 4 0|creative commons by sa 4 0", "creative commons attribution sharealike 4 0 international license", "creativecommons org licenses by sa 4 0"),
    ("cc-by-nc-4.0", "creative commons attribution non ?commercial 4 0|cc by nc 4 0|creative commons by nc 4 0", "creative commons attribution noncommercial 4 0 international license", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nd-4.0", "creative commons attribution no ?deriv(?:ative)?s 4 0|cc by nd 4 0|creative commons by nd 4 0", "creative commons attribution noderivatives 4 0 international license", "creativecommons org licenses by nd 4 0"),
    ("ofl-1.1", "sil open font license(?: version)?(?: 1 1)?|open font license|ofl 1 1", "this font software is licensed under the sil open font license", "scripts sil org ofl"),
    ("odbl-1.0", "open database license(?: v(?:ersion )?1 0)?|odc open database license|odbl 1 0", "made available under the open database license", "opendatacommons org licenses odbl"),
    ("psf-2.0", "python software foundation license(?: version 2)?|psf license(?: agreement)?|python license 2 0", "the psf hereby grants licensee", "docs python org .{0,20}license"),
    ("php-3.01", "php license(?: version)? 3 01|the php license|php license", "this product includes php software freely available", "php net license"),
    ("ruby", "ruby license|the ruby licence|ruby s license", "you may redistribute ruby in either source form", "ruby lang org .{0,20}license"),
    ("postgresql", "postgresql license|postgresql licence|the postgresql license", "postgresql database management system formerly known as postgres", "postgresql org about licen[cs]e"),
    ("openssl", "openssl license|openssl ssleay license|openssl licence", "this product includes software developed by the openssl project", "openssl org source license"),
    ("w3c", "w3c software (?:notice and )?license|w3c license|w3c software and document license", "w3c software and document notice and license", "w3 org consortium legal"),
    ("ms-pl", "microsoft public license|ms pl license|microsoft permissive license", "microsoft public license ms pl", "opensource org licenses? ms pl"),
    ("sspl-1.0", "server side public license(?: version)?(?: 1)?|sspl 1 0|sspl license", "the terms of the server side public license", "mongodb com licensing server side public license"),
    ("elastic-2.0", "elastic license(?: version)? 2(?: 0)?|elastic license v2|elv2 license", "subject to the elastic license 2 0", "elastic co licensing elastic license"),
)
# Kinds of signature in order of priority, with the confidence of a detection.
TAG, NOTICE, TEXT, ADDRESS, NAME, FAMILY = 6, 5, 4, 3, 2, 1
CONFIDENCE = {TAG: 1.0, NOTICE: 0.95, TEXT: 0.95, ADDRESS: 0.85, NAME: 0.8, FAMILY: 0.6}
VERBS = "licensed|released|distributed|available|published|redistributed|covered|provided"
# Families: names that leave the version open.
FAMILIES = (
    ("apache", "apache license|apache licence"),
    ("gpl", "general public license|general public licence"),
    ("bsd", "bsd license|bsd licence"),
    ("mpl", "mozilla public license"),
    ("epl", "eclipse public license"),
    ("cc", "creative commons license|creative commons licence"),
)


_SYNTAX = re.compile(r"\([^()]*\)\??|\[[^]]*\]|\.\{[^}]*\}|[\w ]\?")


def _literals(expression: str) -> list[str]:
    """Texts that every match of the expression holds, blanks at its ends included."""
    text, before = f" {expression} ", None
    while text != before:
        # groups may hold groups
        text, before = _SYNTAX.sub("\n", text), text
    return text.split("\n")


def _anchor(expression: str) -> str:
    """The longest of the literal texts."""
    return max(_literals(expression), key=len)


def _gate(expression: str) -> str:
    """A whole word of every match: ``license`` where the expression has it, or the longest."""
    words = [w for text in _literals(expression) for w in re.findall(r"(?<= )[a-z0-9]+(?= )", text)]
    return "license" if "license" in words else max(words, key=len)


def rules() -> list[tuple[str, int, str]]:
    """(label, priority, expression) of every rule; some nine per license."""
    out = []
    for label, names, phrase, address in LICENSES:
        identifier = " ".join(re.findall(r"[a-z0-9]+", label))
        signatures = [(TAG, f"spdx license identifier {identifier}(?: only| or later)?"), (TEXT, phrase), (ADDRESS, address)]
        for name in _alternatives(names):
            signatures.append((NOTICE, f"(?:{VERBS}) under (?:the )?(?:terms of )?(?:the )?{name}"))
            signatures.append((NAME, name))
        out += [(label, priority, e) for priority, e in signatures]
    for label, names in FAMILIES:
        out += [(label, FAMILY, name) for name in names.split("|")]
    return out


def _alternatives(names: str) -> list[str]:
    """Split at the bars that stand in no group."""
    parts, depth, current = [], 0, ""
    for ch in names:
        depth += (ch == "(") - (ch == ")")
        if ch == "|" and not depth:
            parts.append(current)
            current = ""
        else:
            current += ch
    return [*parts, current]


def _rule_table() -> Column:
    """The rules as one constant; a detection starts and ends with whole words."""

    def quoted(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    listed = []
    for number, (label, priority, expression) in enumerate(rules()):
        fields = {"rule": number, "label": quoted(label), "priority": priority, "anchor": quoted(_anchor(expression)), "pattern": quoted(f" {expression}(?= )")}
        listed.append(f"named_struct({', '.join(f"'{name}', {value}" for name, value in fields.items())})")
    return F.expr(f"array({', '.join(listed)})")


# Rules that match, with the lengths of the gaps before their matches and of the matches. Few rules of
# a text get as far as their pattern.
_HITS = """
transform(
  filter(rule_table, r -> contains(body, r.anchor) and rlike(body, r.pattern)),
  r -> named_struct(
    'rule', r.rule, 'label', r.label, 'priority', r.priority,
    'gaps', transform(split(body, r.pattern, -1), x -> char_length(x)),
    'sizes', transform(regexp_extract_all(body, r.pattern, 0), x -> char_length(x))))
"""


def _detections(hits: DataFrame) -> DataFrame:
    """``(row, label, priority)`` of the detections that nothing suppresses.

    Spans are sorted by start, longer ones first; running maxima of the ends before them, one per
    priority, tell what holds a span. Both windows stay within the one shuffle by row.
    """
    spans = hits.repartition("row").select("row", F.explode("hits").alias("h")).select("row", "h.rule", "h.label", "h.priority", F.posexplode(F.arrays_zip(F.slice("h.gaps", 1, F.size("h.sizes")), "h.sizes")).alias("i", "m"))
    sizes = spans.select("row", "rule", "label", "priority", "i", F.col("m.0").alias("gap"), F.col("m.sizes").alias("size"))
    upto = Window.partitionBy("row", "rule").orderBy("i")
    placed = sizes.withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(upto)).withColumn("start", F.col("stop") - F.col("size"))
    order = ("start", F.desc("stop"), F.desc("priority"))
    before = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    for p in CONFIDENCE:
        placed = placed.withColumn(f"p{p}", F.max(F.when(F.col("priority") == p, F.struct("stop", (-F.col("start")).alias("from")))).over(before))
    suppressed = F.lit(False)
    for p in CONFIDENCE:
        higher = (F.col("priority") < p) & (F.col(f"p{p}.stop") >= F.col("stop"))
        wider = (F.col(f"p{p}.stop") > F.col("stop")) | ((F.col(f"p{p}.stop") == F.col("stop")) & (-F.col(f"p{p}.from") < F.col("start")))
        suppressed = suppressed | F.coalesce(higher | ((F.col("priority") == p) & wider), F.lit(False))
    return placed.filter(~suppressed).select("row", "label", "priority")


def scan_documents(docs: DataFrame) -> DataFrame:
    """Licenses of every document; one row per row of ``docs``.

    Base phrases are counted wherever their words stand in a row; their labels always stay. ``score``
    is 1 minus the product of the doubts of the labels found: 0.8 for a base phrase or name, more for
    a notice, a text or a tag. Rules run only on texts that hold their anchor, a phrase of whole words.
    Of equal spans the one of higher priority stays. Detections of a text are compared by sorting, so a
    text of many notices costs no more per notice.

    Nulls: a null text is an empty one, without words; null ids stay. Repeated rows are scanned
    alike. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    words = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    rows = docs.select("doc_id", words.alias("words"))
    # most texts have no word on licenses at all, and need no body
    gates = sorted({_gate(expression) for _, _, expression in rules()} | {"license"})
    subject = F.arrays_overlap("words", F.array(*[F.lit(g) for g in gates]))
    body = F.when(subject, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), body.alias("body"))

    def places(phrase: str) -> Column:
        return F.coalesce(F.regexp_count(F.col("body"), F.lit(f" {phrase}(?= )")), F.lit(0)).cast("long")

    def words_of(text: Column) -> Column:
        return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))

    firsts, lasts, counts, found = [], [], [], []
    for phrase, label in BASE:
        mark, size = f" {phrase} ", len(phrase.split())
        here = F.contains("body", F.lit(mark))
        # spaces before the phrase, its own included, are one more than the words before it
        firsts.append(F.when(here, words_of(F.substring_index("body", mark, 1))))
        lasts.append(F.when(here, F.col("n_words") - size - F.greatest(F.lit(0), words_of(F.substring_index("body", mark, -1)))))
        counts.append(places(phrase))
        found.append(F.when(here, F.lit(label)))
    base = F.array_sort(F.array_compact(F.array(*found)))
    rows = rows.withColumn("rule_table", F.when(F.col("body").isNotNull(), _rule_table()))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", base.alias("base"), sum(counts[1:], counts[0]).alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
        F.when(F.col("body").isNotNull(), F.expr(_HITS)).alias("hits"),
    )
    rows = materialise(rows, "license-hits")
    kept = _detections(rows.filter(F.size("hits") > 0).select("row", "hits"))
    kept = kept.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("label", "priority"))).alias("own"))
    rows = rows.drop("hits").join(kept, "row", "left").withColumn("own", F.coalesce("own", F.array().cast("array<struct<label:string,priority:int>>")))
    doubts = {p: 1 - c for p, c in CONFIDENCE.items()}
    by_priority = F.create_map(*[F.lit(x) for p, d in doubts.items() for x in (p, float(d))])
    doubt = F.aggregate("own", F.lit(1.0), lambda d, s: d * F.element_at(by_priority, s["priority"]))
    base_doubt = F.when(F.size("base") > 0, F.lit(doubts[NAME])).otherwise(F.lit(1.0))
    labels = F.array_sort(F.array_union("base", F.transform("own", lambda s: s["label"])))
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        (1 - F.least(doubt, base_doubt)).alias("score"),
    )
